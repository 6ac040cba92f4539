"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one pass over each text.

The model's scores are merge ranks: its own encoding merges the best pair of neighbours again and again. That is
no largest sum of scores, but it can be told from neighbours alone: a split is the model's if each piece is what merging
makes of its own characters, and each two neighbours are what merging makes of theirs. So the pass relaxes, at each
position, the pieces that end there, longest first along the automaton's output links: a piece is taken if it stays apart from
the piece the best split ends with where it begins. Exactly one does. Whether two pieces stay apart is read off their
merge trees (``Merges.apart``). No piece joins a space to what is before it, so the split of a text is the splits of its words one
after the other, and each word is searched once per task. Nor does a piece
go across two ASCII characters that no piece has side by side, so texts are cut there as well, and fewer different words are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers
from .tables import opened, shared

SPACE = "▁"
#: Stands for a space sign that is itself in the text; no valid text holds it.
LITERAL = "\ud800"


def raw(c: str) -> bytes:
    """UTF-8 of a character of a text whose spaces are replaced."""
    return b" " if c == SPACE else SPACE.encode() if c == LITERAL else c.encode()


class Model:
    """Pieces of a model file, ready to send to tasks: strings, scores, and the ids of single bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(k) for k in range(size)]
        self.scores = [model.get_score(k) for k in range(size)]
        self.plain = [k for k in range(size) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        byte_ids = {int(self.pieces[k][3:5], 16): k for k in range(size) if model.is_byte(k)}
        if len(byte_ids) != 256:
            raise ValueError("the model must have a piece for every byte")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        for k in self.plain:
            inner = self.pieces[k].lstrip(SPACE)
            if SPACE in inner or ("\n" in self.pieces[k] and len(self.pieces[k]) > 1):
                raise ValueError("a piece crosses words")
        self.rank, self.left, self.right = merge_trees(self.pieces, self.scores, self.plain)
        self.joined = joined_bytes([self.pieces[k].replace(SPACE, " ") for k in self.plain])

    def bodies(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces, one after the other, and where each begins."""
        own = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, k in enumerate(self.byte_ids):
            own[k] = bytes([b])
        at = np.concatenate([[0], np.cumsum([len(b) for b in own])])
        return np.frombuffer(b"".join(own), np.uint8), at


def joined_bytes(pieces: list[str]) -> np.ndarray:
    """For each two bytes: could a piece go across them? Two ASCII characters that no piece has side by side are never merged."""
    table = np.ones((256, 256), bool)
    table[:128, :128] = False
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if a < "\x80" and b < "\x80":
                table[ord(a), ord(b)] = True
    return table


def merge_trees(pieces: list[str], scores: list[float], plain: list[int]) -> tuple[list[int], list[int], list[int]]:
    """For each piece its place in the order of merges (best first; -1 for single characters) and the two pieces of its last merge.

    A piece that merging its characters does not give has no parts (-1, -1) and is never used.
    """
    ids = {pieces[k]: k for k in plain}
    place = {k: n for n, k in enumerate(sorted(plain, key=lambda k: (-scores[k], k)))}
    rank, left, right = [-1] * len(pieces), [-1] * len(pieces), [-1] * len(pieces)
    for k in plain:
        if len(pieces[k]) == 1:
            continue
        rank[k] = place[k]
        parts = [ids.get(c, -1) for c in pieces[k]]
        while len(parts) > 2:
            pairs = [(place[m], i) for i in range(len(parts) - 1) if (m := ids.get(pieces[parts[i]] + pieces[parts[i + 1]])) is not None] if -1 not in parts else []
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [ids[pieces[parts[i]] + pieces[parts[i + 1]]]]
        if len(parts) == 2 and -1 not in parts:
            left[k], right[k] = parts
    return rank, left, right


#: Words longer than this are searched each time they are in a slice; what is kept takes so many bytes at most.
LONG_WORD = 256
KEPT_BYTES = 48 << 20


class Encoder:
    """The model's split of single words, and of whole texts with every word searched once."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.ids = {model.pieces[k]: k for k in model.plain}
        self.automaton = ahocorasick.Automaton()
        for k in model.plain:
            if len(model.pieces[k]) == 1 or model.left[k] >= 0:
                self.automaton.add_word(model.pieces[k], (len(model.pieces[k]), k))
        self.automaton.make_automaton()
        self.body, self.at = model.bodies()
        self.known = buffers.Kept()
        self.pairs: dict[int, bool] = {}

    @property
    def kept(self) -> int:
        return self.known.nbytes

    def apart(self, a: int, b: int) -> bool:
        """Do two neighbouring pieces stay apart when their characters are merged?

        The merges that made them are undone, the last one first. Whenever what then touches could have merged before the merge
        that was undone last, they would not be two pieces: of equal merges the one to the left comes first.
        """
        key = a << 24 | b
        known = self.pairs.get(key)
        if known is not None:
            return known
        m, x, y = self.model, a, b
        limit, result = len(m.pieces), True
        while True:
            both = self.ids.get(m.pieces[x] + m.pieces[y])
            if both is not None and m.rank[both] < limit:
                result = False
                break
            if m.rank[x] < 0 and m.rank[y] < 0:
                break
            if m.rank[x] >= m.rank[y]:
                # Equal pieces: the left one was made first, so the right one is undone first.
                if m.rank[x] == m.rank[y]:
                    limit, y = m.rank[y] + 1, m.left[y]
                else:
                    limit, x = m.rank[x], m.right[x]
            else:
                limit, y = m.rank[y] + 1, m.left[y]
        if len(self.pairs) > 2_000_000:
            self.pairs = {}
        self.pairs[key] = result
        return result

    def word(self, text: str) -> list[int]:
        """Piece ids of a text whose spaces are replaced. A character no piece has is one byte piece for each byte."""
        n = len(text)
        last = [-2] * (n + 1)  # the piece the split up to here ends with; -1 for a character without one, -2 for none yet
        last[0] = -1
        pairs = self.pairs
        size, done = [0] * (n + 1), 0
        for end, (length, piece) in self.automaton.iter(text):
            end += 1
            while done < end:  # characters without a piece stay alone
                if last[done] == -2:
                    last[done], size[done] = -1, 1
                done += 1
            if last[end] == -2:
                before = last[end - length]
                if before >= 0:
                    stays = pairs.get(before << 24 | piece)
                    if stays is None:
                        stays = self.apart(before, piece)
                        pairs = self.pairs
                    if not stays:
                        continue
                last[end], size[end] = piece, length
        for e in range(1, n + 1):
            if last[e] == -2:
                last[e], size[e] = -1, 1
        out, e = [], n
        while e:
            if last[e] < 0:
                out += [self.model.byte_ids[b] for b in reversed(raw(text[e - 1]))]
            else:
                out.append(last[e])
            e -= size[e]
        return out[::-1]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has. A text that is not empty gets a space in front."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        space, line = data == 0x20, data == 0x0A
        new = np.zeros(len(data) + 1, bool)
        new[offsets] = True
        first = new[:-1].copy()
        new = first | line | (space & ~np.concatenate([[False], space[:-1]])) | np.concatenate([[False], line[:-1]])
        new[1:] |= ~self.model.joined[data[:-1], data[1:]]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(data))
        front = first[starts]
        hashes = buffers.word_hashes(data, starts, ends) ^ front.astype(buffers.U64)
        own, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.kept > KEPT_BYTES:
            self.known = buffers.Kept()
        body = data.tobytes()

        def search(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes, flat = [], []
            places = where[some]
            for s, e, leads in zip(starts[places].tolist(), ends[places].tolist(), front[places].tolist(), strict=True):
                unit = body[s:e].decode().replace(SPACE, LITERAL).replace(" ", SPACE)
                ids = self.word(SPACE + unit if leads else unit)
                sizes.append(len(ids))
                flat += ids
            return np.array(sizes, np.int64), np.array(flat, np.int32)

        table, begin, size = self.known.runs(own, search, (ends - starts)[where] <= LONG_WORD)
        counts = size[inverse]
        ids = table[np.repeat(begin[inverse], counts) + buffers.places(counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        unit_at = np.searchsorted(starts, offsets)
        return ids, total[unit_at[1:]] - total[unit_at[:-1]]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids, without the space put in front."""
        size = self.at[ids + 1] - self.at[ids]
        body = self.body[np.repeat(self.at[ids], size) + buffers.places(size)]
        return body[1:].tobytes()


def encoded(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text``, ``ids`` (piece ids), ``decoded`` (text of the ids).

    ``decoded`` equals the text byte for byte. NULL counts as empty and has no pieces; repeated
    rows each come out. ``model`` is the path of a model with byte fallback whose pieces have
    spaces in front only.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    handle = shared(docs.sparkSession, Model(model))

    @buffers.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(opened(Model, handle))
        for batch, data, offsets in buffers.slices(batches, "text", 1 << 20):
            ids, counts = encoder(data, offsets)
            ends = np.cumsum(counts)
            decoded = [encoder.decode(ids[e - c : e]).decode() for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), buffers.lists(ids, counts, pa.int32()), pa.array(decoded, pa.string())],
                names=["doc_id", "text", "ids", "decoded"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, ids array<int>, decoded string")


def encoding_report(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``n_chars``, ``n_pieces``, ``ids``, ``decoded_sha256``, ``exact`` (decoding gives the text back)."""
    body = F.coalesce("text", F.lit(""))
    return encoded(docs, model).select(
        "doc_id",
        F.length(body).cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == body).alias("exact"),
    )
