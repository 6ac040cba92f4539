"""Token ids in blocks coded by a static range asymmetric numeral system.

A block holds whole documents and is decoded by itself. Its symbols are dealt over ``LANES``
states in turn; a state that would overflow first gives up 32 bits. Frequencies of all ids are
counted over the whole corpus and shared by all blocks. Every ``CHECKPOINT`` rounds the block
notes the decoder's states and its place in the stream, so stretches between checkpoints decode
side by side; the CRC-32 of the ids tells whether a block was read right.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import buffers
from .tables import new_path, opened, release, shared, written

#: Fixed values of the file format.
VERSION = 1
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 512
CHECKPOINT = 128
BLOCK_IDS = 1 << 18

U64 = np.uint64
END_ID = 2


class Frequencies:
    """Scaled frequencies of the ids that occur; they add up to 2**SCALE_BITS."""

    def __init__(self, symbols: np.ndarray, scaled: np.ndarray):
        self.symbols, self.scaled = symbols.astype(np.int64), scaled.astype(np.int64)

    @classmethod
    def of(cls, counts: dict[int, int]) -> Frequencies:
        symbols = np.array(sorted(counts), np.int64)
        if not len(symbols):
            return cls(symbols, symbols)
        n = np.array([counts[s] for s in symbols.tolist()], np.float64)
        if len(symbols) > 1 << (SCALE_BITS - 1):
            raise ValueError("more different ids than the format has frequencies for")
        # One for each id, the rest in proportion; what rounding leaves goes to the most frequent.
        scaled = 1 + np.floor(n / n.sum() * ((1 << SCALE_BITS) - len(symbols))).astype(np.int64)
        scaled[np.argmax(n)] += (1 << SCALE_BITS) - scaled.sum()
        return cls(symbols, scaled)

    def tables(self):
        """Start and width of each id's range, and the id of each slot."""
        size = int(self.symbols.max(initial=0)) + 1
        width, start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        width[self.symbols] = self.scaled
        start[self.symbols] = np.cumsum(self.scaled) - self.scaled
        return start, width, np.repeat(self.symbols, self.scaled).astype(np.int32)

    def to_json(self) -> str:
        return json.dumps({"version": VERSION, "scale_bits": SCALE_BITS, "lanes": LANES, "ids": self.symbols.tolist(), "scaled": self.scaled.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Frequencies:
        have = json.loads(text)
        if (have["version"], have["scale_bits"], have["lanes"]) != (VERSION, SCALE_BITS, LANES):
            raise ValueError("another version of the format")
        return cls(np.array(have["ids"], np.int64), np.array(have["scaled"], np.int64))


def encode_block(ids: np.ndarray, tables) -> tuple[bytes, bytes, bytes]:
    """The 32-bit words in decoding order, and for each checkpoint its states and its place in the words."""
    start, width, _ = tables
    rounds = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, U64)
    words: list[np.ndarray] = []
    states: list[np.ndarray] = []
    after: list[int] = []
    given, shift = 0, U64(63 - SCALE_BITS)
    for t in range(rounds - 1, -1, -1):
        s = ids[t * LANES : (t + 1) * LANES]
        f, c, x = width[s], start[s], state[: len(s)]
        full = x >= f << shift
        words.append((x[full] & U64(0xFFFFFFFF)).astype("<u4"))
        given += len(words[-1])
        x = np.where(full, x >> U64(32), x)
        q = x // f
        state[: len(s)] = (q << U64(SCALE_BITS)) + (x - q * f) + c
        if t % CHECKPOINT == 0:
            states.append(state.copy())
            after.append(given)
    words.reverse(), states.reverse(), after.reverse()
    places = np.array([given - a for a in after], "<u4")
    return b"".join(w.tobytes() for w in words), b"".join(s.astype("<u8").tobytes() for s in states), places.tobytes()


def decode_block(n: int, words: bytes, states: bytes, places: bytes, tables) -> np.ndarray:
    """All ids of a block; the stretches between checkpoints advance together."""
    start, width, slots = tables
    word = np.concatenate([np.frombuffer(words, "<u4"), np.zeros(1, "<u4")]).astype(U64)
    at = np.frombuffer(places, "<u4").astype(np.int64)
    state = np.frombuffer(states, "<u8").astype(U64).reshape(len(at), LANES)
    out = np.zeros((len(at), CHECKPOINT, LANES), np.int32)
    left = n - np.arange(len(at)) * CHECKPOINT * LANES
    mask = U64((1 << SCALE_BITS) - 1)
    lane = np.arange(LANES)
    for t in range(min(CHECKPOINT, -(-n // LANES))):
        slot = state & mask
        s = slots[slot.astype(np.int64)]
        out[:, t] = s
        x = width[s] * (state >> U64(SCALE_BITS)) + slot - start[s]
        live = lane < (left - t * LANES)[:, None]
        empty = (x < LOW) & live
        rank = np.cumsum(empty, 1)
        take = np.minimum(at[:, None] + rank - 1, len(word) - 1)
        x = np.where(empty, x << U64(32) | word[take], x)
        state = np.where(live, x, state)
        at = at + rank[:, -1]
    return out.reshape(-1)[:n]


#: Marks the tokenizer always parts from a letter beside them: those of ASCII but the apostrophe (of 's) and what special tokens hold.
MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


#: a-z, and the letters of U+00C0 to U+02AF: without two signs, and the one that gets a combining dot in lower case.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x2B0) if c not in (0xD7, 0xF7, 0x130))


def _letter_pairs() -> np.ndarray:
    """Lookup table by lead (from 0xC3 on) and second byte: is this one of ``LETTERS``?"""
    table = np.zeros((8, 256), bool)
    pairs = np.frombuffer(LETTERS[26:].encode(), np.uint8).reshape(-1, 2)
    table[pairs[:, 0] - 0xC3, pairs[:, 1]] = True
    return table


def letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Is this byte of one of ``LETTERS``?"""
    found = (data >= 0x61) & (data <= 0x7A)
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xCA))
    if len(lead):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        lead = lead[_letter_pairs()[data[lead] - 0xC3, data[lead + 1]] & ~edge[lead + 1]]
        found[lead] = found[lead + 1] = True
    return found


def units(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans the tokenizer treats one by one: words, cut where letters and ``MARKS`` meet."""
    starts, ends, at = buffers.word_spans(data, offsets, buffers.separators())
    if not len(starts):
        return starts, ends, at
    mark = ~buffers.separators(bytes(set(range(256)) - set(MARKS)))[data]
    cut = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    cut[edge - 1] = False
    cuts = np.flatnonzero(cut) + 1
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, offsets)


#: Words a worker remembers take so many bytes at most; past it, it starts anew. So many words go to the tokenizer at a time.
KEPT_BYTES = 32 << 20
AT_ONCE = 4096
#: Words of letters in one text for the tokenizer.
IN_A_TEXT = 64


class WordIds:
    """Ids of whole texts by a tokenizer that lowers case and never joins across white space: each word once per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known = buffers.Kept()
        # A word of letters only is one piece: white space and lower case are all there is to see to. Where the
        # model marks the last token of a piece, many such words can be one text.
        self.spaced, self.last = Tokenizer(self.tokenizer.model), None
        self.spaced.normalizer = normalizers.Lowercase()
        self.spaced.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for word, i in vocabulary.items() if word.endswith(suffix)]] = True
            # Only for a tokenizer that treats every single letter alike both ways.
            data = " ".join(LETTERS).encode()
            spans = buffers.word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]), buffers.separators())[:2]
            ways = [way(np.frombuffer(data, np.uint8), *spans) for way in (self.one_by_one, self.together)]
            if not all(np.array_equal(x, y) for x, y in zip(*ways, strict=True)):
                self.last = None

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """The one this Python worker keeps from task to task. Code of tasks is new each time, so it hangs on a library's module."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_words_of_worker", {})
        if path not in kept:
            kept[path] = cls(path)
        own = kept[path]
        fresh = cls.__new__(cls)
        fresh.__dict__ = own.__dict__
        return fresh

    def one_by_one(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words, each a text for the tokenizer."""
        words = [data[s:e].tobytes().decode(errors="replace") for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        sizes, ids = [], []
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            own = e.ids
            sizes.append(len(own))
            ids += own
        return np.array(sizes, np.int64), np.array(ids, np.int32)

    def together(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ``LETTERS``, ``IN_A_TEXT`` of them in a text; a word ends with a token of ``last``."""
        sizes = ends - starts
        closed = np.cumsum(sizes + 1)  # a blank behind each
        body = np.full(closed[-1], 0x20, np.uint8)
        inner = buffers.places(sizes)
        body[np.repeat(closed - sizes - 1, sizes) + inner] = data[np.repeat(starts, sizes) + inner]
        edges = [0, *closed[IN_A_TEXT - 1 : -1 : IN_A_TEXT].tolist(), len(body)]
        texts = [body[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.spaced.encode_batch_fast(texts, add_special_tokens=False)])
        last = np.flatnonzero(self.last[ids])
        if len(last) != len(starts):
            return self.one_by_one(data, starts, ends)
        return np.diff(last, prepend=-1), ids

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and how many each has."""
        if b"<|" not in data.tobytes():  # special tokens are told by case
            data = buffers.lower_ascii()[data]
        letter = letters(data, offsets)
        starts, ends, at = units(data, offsets, letter)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        hashes, first, inverse = np.unique(buffers.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self.known.nbytes > KEPT_BYTES:
            self.known = buffers.Kept()
        others = np.cumsum(np.concatenate([[0], ~letter]), dtype=np.int32)
        plain = (others[ends[first]] == others[starts[first]]) & (self.last is not None)

        def encode(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            new_plain, sizes, values = plain[new], np.zeros(len(new), np.int64), []
            order = np.concatenate([np.flatnonzero(new_plain), np.flatnonzero(~new_plain)])
            border = int(new_plain.sum())
            for way, a, b in ((self.together, 0, border), (self.one_by_one, border, len(new))):
                for k in range(a, b, AT_ONCE):
                    some = order[k : min(k + AT_ONCE, b)]
                    places = first[new[some]]
                    sizes[some], ids = way(data, starts[places], ends[places])
                    values.append(ids)
            # Back from the order of work to that of the words.
            flat, done = np.concatenate(values), sizes[order]
            begin = np.empty(len(new), np.int64)
            begin[order] = np.cumsum(done) - done
            return sizes, flat[np.repeat(begin, sizes) + buffers.places(sizes)]

        table, begin, size = self.known.runs(hashes, encode, np.ones(len(hashes), bool))
        counts = size[inverse]
        ids = table[np.repeat(begin[inverse], counts) + buffers.places(counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[at[1:]] - total[at[:-1]]


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids``: little-endian unsigned 32-bit ids of each row's text and the end id.

    ``tokenizer`` is a file of the tokenizers library that lowers case, parts letters from
    punctuation, splits on white space and adds no special tokens. NULL and empty texts have the end id alone.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = WordIds.of_worker(tokenizer)
        for batch, data, offsets in buffers.slices(batches, "text", 1 << 20):
            ids, counts = words(data, offsets)
            n = batch.num_rows
            closed = np.full(len(ids) + n, end_id, "<u2" if max(ids.max(initial=0), end_id) < 1 << 16 else "<u4")
            closed[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
            width = closed.dtype.itemsize
            ends = np.concatenate([[0], np.cumsum(counts + 1)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(n, width), pa.int32()),
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(closed)]),
                ],
                names=["doc_id", "width", "ids"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, width int, ids binary")


def _ids(body: bytes, width: int) -> np.ndarray:
    return np.frombuffer(body, f"<u{width}")


@buffers.lean
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for width, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            have = np.bincount(_ids(body, width), minlength=len(total))
            have[: len(total)] += total
            total = have
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some], pa.int64())], names=["id", "n"])


BLOCK = "shard int, block bigint, first bigint, n bigint, crc32 bigint, doc_ids array<{id}>, lengths array<bigint>, words binary, states binary, places binary"


def write_ids(ids: DataFrame, path: str) -> Frequencies:
    """Write ids (as ``token_ids`` gives them) below ``path``, in ascending ``doc_id`` order (NULL first).

    Rows that repeat an id are ordered by their token ids. ``path/blocks`` holds the blocks,
    ``path/frequencies`` the shared table. Blocks end at document borders: a document larger
    than a block is a block of its own.
    """
    spark = ids.sparkSession
    rows = written(ids, "ids")
    counts = rows.mapInArrow(_counted, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = Frequencies.of({r["id"]: r["n"] for r in counts})
    spark.createDataFrame([(table.to_json(),)], "body string").coalesce(1).write.text(f"{path}/frequencies")
    handle = shared(spark, table)
    kind = ids.schema["doc_id"].dataType.simpleString()

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tables, shard, block, first = opened(Frequencies, handle).tables(), TaskContext.get().partitionId(), 0, 0
        docs: list[tuple] = []
        size = 0

        def close():
            ids = np.concatenate([d[1] for d in docs]).astype(np.int64)
            words, states, places = encode_block(ids, tables)
            row = [shard, block, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), [d[0] for d in docs], [len(d[1]) for d in docs], words, states, places]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        names = [c.split()[0] for c in BLOCK.split(", ")]
        id_kind = None
        for batch in batches:
            id_kind = id_kind or batch.schema.field("doc_id").type
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(id_kind), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            for doc_id, width, body in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                own = _ids(body, width)
                if docs and size + len(own) > BLOCK_IDS:
                    yield close()
                    docs, block, first, size = [], block + 1, first + size, 0
                docs.append((doc_id, own))
                size += len(own)
        if docs:
            yield close()

    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    placed.mapInArrow(run, BLOCK.format(id=kind)).write.parquet(f"{path}/blocks")
    release(spark)
    return table


def read_ids(spark: SparkSession, path: str, texts: bool = False) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``; ``ids`` if asked for.

    A block whose CRC-32 does not fit raises an error.
    """
    body = "".join(r["value"] for r in spark.read.text(f"{path}/frequencies").collect())
    handle = shared(spark, Frequencies.from_json(body))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = opened(Frequencies, handle).tables()
        for batch in batches:
            for k in range(batch.num_rows):
                b = {name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names) if name != "doc_ids"}
                ids = decode_block(b["n"], b["words"], b["states"], b["places"], tables).astype("<u4")
                body = ids.tobytes()
                if zlib.crc32(body) != b["crc32"]:
                    raise ValueError(f"block {b['block']} of shard {b['shard']} is damaged")
                ends = np.cumsum(b["lengths"])
                starts = ends - b["lengths"]
                parts = [body[4 * s : 4 * e] for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(parts), b["shard"]), pa.int32()),
                        batch.column(batch.schema.get_field_index("doc_ids"))[k].values,
                        pa.array(starts + b["first"], pa.int64()),
                        pa.array(b["lengths"], pa.int64()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array(parts if texts else [None] * len(parts), pa.binary()),
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    # Ids before each shard: one row per shard, from the block headers.
    sizes = sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n").alias("n")).collect())
    before, total = [], 0
    for shard, n in sizes:
        before.append((shard, total))
        total += n
    offsets = spark.createDataFrame(before, "shard int, before bigint")
    docs = blocks.mapInArrow(run, f"shard int, doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    columns = ["doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if texts else [])]
    return docs.join(F.broadcast(offsets), "shard").select(*columns)


def encoded_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_ids(token_ids(docs, tokenizer), path)
    return read_ids(spark, path)
