"""Jaccard join of shingle sets by parity sketches.

A set is sketched by hashing each shingle to one bit of a very wide bit string and flipping it.
Two sketches differ in no more bits than the sets differ in shingles, and sets of sizes p and q
reach similarity 0.75 only if they differ in at most (p + q) / 7 shingles. The bit string is cut
into blocks; each block is kept as the XOR of 64-bit codes of its set bits, so only blocks with
bits are held. If one set fills more blocks than the two may differ in, the sets share a filled
block, and it is found among the d + 1 first blocks of both in any order all sets agree on.

The order puts blocks last that hold common shingles only, the commonest at the very end, so a
passage that many documents share does not bring them together. Sets are sketched per size band, with as many blocks as the
band's sizes need, and once more in the band below if a partner can be there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers
from .components import components
from .tables import discard, release, unused, written

SHINGLE_WORDS = 5
BAND = 4  # sizes of one band differ by less than this factor
#: Cells of the table that grades how common shingles are, the most cells one task reports, and the
#: most that are graded. It only steers the order of blocks: any table gives the same links.
CELLS = 1 << 22
OFTEN = 1 << 16
COMMON = 1 << 18
#: Rounds with other pivots for buckets whose open pairs are more than so many times their rows.
PIVOT_ROUNDS = 6
MANY = 4
#: Prefixes are dealt into so many buckets by shingle, a power of two, and a task gives out what it holds after so many entries.
BUCKETS = 1 << 10
HELD = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and how many each text has.

    Words are runs without ASCII white space, A-Z lowered. Fewer than five words are one shingle.
    """
    data = buffers.lower_ascii()[data]
    starts, ends, at = buffers.word_spans(data, offsets, buffers.separators())
    words = buffers.word_hashes(data, starts, ends)
    grams = buffers.gram_hashes(words, SHINGLE_WORDS)
    few = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < SHINGLE_WORDS))
    short = dict(zip(few.tolist(), buffers.run_hashes(words, at[few], at[few + 1]) if len(few) else [], strict=True))
    sets = []
    for k in range(len(offsets) - 1):
        if k in short:
            sets.append(np.array([short[k]], buffers.U64))
        else:
            sets.append(np.unique(grams[at[k] : max(at[k], at[k + 1] - SHINGLE_WORDS + 1)]))
    return np.concatenate(sets) if sets else np.zeros(0, buffers.U64), np.array([len(s) for s in sets], np.int64)


def class_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One key for each set, equal for equal sets."""
    keys = np.zeros(len(counts), buffers.U64)
    full = np.flatnonzero(counts)
    if len(full):
        keys[full] = np.add.reduceat(buffers.mix(hashes ^ buffers.U64(0x5851F42D4C957F2D)), (np.cumsum(counts) - counts)[full])
    return buffers.mix(keys + counts.astype(buffers.U64))


def band_of(sizes: np.ndarray) -> np.ndarray:
    """k for sizes from BAND**k to below BAND**(k+1)."""
    return np.array([(int(n).bit_length() - 1) // 2 for n in sizes], np.int64)


def blocks_of(band: np.ndarray) -> np.ndarray:
    """Blocks for sets of a band: sparse for small sets, else up to two thirds of a shingle each."""
    return np.where(band <= 2, 1 << 20, 2 * BAND ** (np.minimum(band, 13) + 1)).astype(np.int64)


def entries(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set, band and the most shingles it may differ in from a partner there, for each sketch to make."""
    band = band_of(np.maximum(sizes, 1))
    floor = BAND**band
    # Own band: partners up to 4/3 of the size. Band below: partners of less than this band's least size.
    own = np.flatnonzero(sizes > 0)
    below = np.flatnonzero((band > 0) & (3 * sizes < 4 * floor) & (sizes > 0))
    most = (sizes[own] + 4 * sizes[own] // 3) // 7
    less = (sizes[below] + floor[below] - 1) // 7
    return np.concatenate([own, below]), np.concatenate([band[own], band[below] - 1]), np.concatenate([most, less])


def signatures(hashes: np.ndarray, counts: np.ndarray, grade: np.ndarray, seed: int):
    """The first ``d + 1`` blocks of every sketch: set, signature; and sets with too few filled blocks.

    ``grade`` (0 to 31) tells for each cell how common its shingles are; a block counts as its rarest shingle.
    """
    own, band, differ = entries(counts)
    kept = differ > 0  # sets that may not differ at all meet by their class key
    own, band, differ = own[kept], band[kept], differ[kept]
    if not len(own):
        return own, np.zeros(0, buffers.U64), own
    first = np.cumsum(counts) - counts
    size = counts[own]
    flat = np.repeat(first[own], size) + buffers.places(size)
    entry = np.repeat(np.arange(len(own)), size)
    h = hashes[flat]
    block = (buffers.mix(h ^ buffers.U64(0xA24BAED4963EE407 + seed)) >> buffers.U64(20)).astype(np.int64) & (blocks_of(band)[entry] - 1)
    place = entry << 32 | block
    order = np.argsort(place, kind="stable")
    place = place[order]
    start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    code = np.bitwise_xor.reduceat(buffers.mix(h + buffers.U64(0x9FB21C651E98DF25))[order], start)
    common = np.minimum.reduceat(grade[(h & buffers.U64(CELLS - 1)).astype(np.int64)][order], start)
    entry, block = place[start] >> 32, place[start] & 0xFFFFFFFF
    filled = np.bincount(entry, minlength=len(own))
    poor = own[filled <= differ]
    sign = buffers.mix(code ^ buffers.mix((block << 8 | band[entry]).astype(buffers.U64)))
    bits = int(len(own)).bit_length()
    rank = entry.astype(buffers.U64) << buffers.U64(64 - bits) | common.astype(buffers.U64) << buffers.U64(59 - bits) | sign >> buffers.U64(bits + 5)
    order = np.argsort(rank, kind="stable")
    order = order[buffers.places(filled) <= differ[entry[order]]]
    return own[entry[order]], sign[order], poor


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """Dense parity sketch of one set: a power of two of bits, at least two for each shingle."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & buffers.U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two dense sketches; one of twice the length is folded first."""

    def folded(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    odd = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(odd, F.lit(0), lambda s, x: s + x)


@buffers.lean
def _classes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "n", "key", "cell", "hits", "bits"]
    seen: set[int] = set()
    hits = np.zeros(CELLS, np.int32)
    kind = pa.int64()
    for batch, data, offsets in buffers.slices(rows, "text"):
        hashes, counts = shingle_sets(data, offsets)
        keys = buffers.signed(class_keys(hashes, counts))
        kind = batch.schema.field("doc_id").type
        new = np.zeros(len(keys), bool)
        for k, key in enumerate(keys.tolist()):
            new[k] = key not in seen
            seen.add(key)
        hits += np.bincount((hashes[np.repeat(new, counts)] & buffers.U64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.int32)
        none = pa.nulls(len(keys), pa.int64())
        first = np.cumsum(counts) - counts
        bits = [parity_bits(hashes[first[k] : first[k] + counts[k]]) if new[k] and counts[k] else np.zeros(0, np.int64) for k in range(len(keys))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("text_hash")),
                pa.array(counts),
                pa.array(keys, mask=counts == 0),
                none,
                none,
                buffers.lists(np.concatenate([np.zeros(0, np.int64), *bits]), [len(b) for b in bits], pa.int64()),
            ],
            names=names,
        )
    # The task's most frequent cells; what is rarer in all tasks is not common anywhere.
    often = np.argpartition(hits, CELLS - OFTEN)[-OFTEN:]
    often = often[hits[often] > 1]
    none = pa.nulls(len(often), pa.int64())
    empty = pa.nulls(len(often), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.nulls(len(often), kind), none, none, none, pa.array(often), pa.array(hits[often], pa.int64()), empty], names=names)


def _signed_rows(common, seed: int):
    @buffers.lean
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade, seen = np.zeros(CELLS, np.uint8), set()
        cells, hits = common.value
        grade[cells] = np.minimum(31, np.ceil(np.log2(hits + 1))).astype(np.uint8)
        for _, data, offsets in buffers.slices(rows, "text"):
            hashes, counts = shingle_sets(data, offsets)
            keys = buffers.signed(class_keys(hashes, counts))
            new = np.zeros(len(keys), bool)
            for k, key in enumerate(keys.tolist()):
                new[k] = key not in seen
                seen.add(key)
            hashes, counts, keys = hashes[np.repeat(new, counts)], counts[new], keys[new]
            own, sign, poor = signatures(hashes, counts, grade, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buffers.signed(sign)), pa.array(keys[own]), pa.array(counts[own])], names=["sign", "key", "n"]
            )
            if len(poor):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(poor), pa.int64()), pa.array(keys[poor]), pa.array(counts[poor])], names=["sign", "key", "n"])

    return run


@buffers.lean
def _buckets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature, size and key: keep signatures of two sets or more, each set with a pivot.

    The pivot is the first set of the bucket, or the first that is too large for the pivot before.
    The last signature of a batch may go on, so its latest row is kept back.
    """
    held: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None  # latest row with its pivot and pivot size

    def table(sign, key, n, pivot):
        return pa.RecordBatch.from_arrays([pa.array(sign), pa.array(key), pa.array(n), pa.array(pivot)], names=["sign", "key", "n", "pivot"])

    fresh = False  # the row held back has not been given out
    for batch in rows:
        sign, key, n = (np.asarray(batch.column(k).fill_null(0)) for k in range(3))
        null = np.asarray(batch.column(0).is_null())
        if null.any():
            lost = pa.nulls(int(null.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([lost, pa.array(key[null]), pa.array(n[null]), lost], names=["sign", "key", "n", "pivot"])
            sign, key, n = sign[~null], key[~null], n[~null]
        if not len(sign):
            continue
        lead = 0
        if held is not None:
            sign, key, n = np.concatenate([[held[0]], sign]), np.concatenate([[held[1]], key]), np.concatenate([[held[2]], n])
            lead = 1
        same = np.concatenate([[False], (sign[1:] == sign[:-1]) & (key[1:] == key[:-1]) & (n[1:] == n[:-1])])
        sign, key, n = sign[~same], key[~same], n[~same]
        new = np.concatenate([[True], sign[1:] != sign[:-1]])
        head = np.maximum.accumulate(np.where(new, np.arange(len(sign)), 0))
        pivot, size = key[head].copy(), n[head].copy()
        if lead:
            first_run = head == 0
            pivot[first_run], size[first_run] = held[3], held[4]
        while True:  # rows too large for their pivot start another, one per bucket and turn
            far = 3 * n > 4 * size
            if not far.any():
                break
            at = np.flatnonzero(far)
            at = at[np.concatenate([[True], head[at[1:]] != head[at[:-1]]])]
            mark = np.full(len(sign), -1)
            mark[at] = at
            mark = np.maximum.accumulate(mark)
            later = (mark >= 0) & (head[np.maximum(mark, 0)] == head) & far
            pivot[later], size[later] = key[mark[later]], n[mark[later]]
        several = (np.bincount(head, minlength=len(sign))[head] > 1) | ((head == 0) & bool(lead) & (not fresh))
        give = several.copy()
        if lead and not fresh:
            give[0] = False
        last = len(sign) - 1
        fresh_next = not several[last]
        yield table(sign[give], key[give], n[give], pivot[give])
        held = (sign[last], key[last], n[last], pivot[last], size[last])
        fresh = fresh_next


@buffers.lean
def _sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for _, data, offsets in buffers.slices(rows, "text", buffers.SLICE_BYTES // 2):
        hashes, counts = shingle_sets(data, offsets)
        keys = buffers.signed(class_keys(hashes, counts))
        first = np.cumsum(counts) - counts
        kept = []
        for k, key in enumerate(keys.tolist()):
            if counts[k] and key not in seen:
                seen.add(key)
                kept.append(k)
        sets = [hashes[first[k] : first[k] + counts[k]] for k in kept]
        flat = buffers.signed(np.concatenate([np.zeros(0, buffers.U64), *sets]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[kept], pa.int64()), buffers.lists(flat, [len(s) for s in sets], pa.int64())], names=["key", "shingles"]
        )


def _close(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) whose sizes and dense sketches allow enough similarity."""

    def side(name: str) -> DataFrame:
        return sketches.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    total = F.col("n_a") + F.col("n_b")
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(F.least("n_a", "n_b") * 4 >= F.greatest("n_a", "n_b") * 3)
        .filter(hamming(F.col("bits_a"), F.col("bits_b")) * 7 <= total)
        .select("a", "b", total.alias("total"))
    )


def verified(pairs: DataFrame, sketches: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sets are alike enough. Sets are built only for pairs that their sketches let through."""
    close = written(_close(pairs, sketches), "close")
    keys = close.select(F.col("a").alias("key")).unionByName(close.select(F.col("b").alias("key"))).distinct()
    wanted = classes.join(keys, "key").select(F.col("least").alias("doc_id"))
    texts = rows.join(wanted, "doc_id", "left_semi").select("text")
    sets = written(texts.mapInArrow(_sets, "key bigint, shingles array<bigint>"), "sets")
    release(rows.sparkSession)
    shared = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    matched = (
        close.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("shingles_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("shingles_b")), "b")
        .select("a", "b", "total", shared.alias("shared"))
        .filter("shared * 100 >= (total - shared) * 75")
        .select("a", "b")
    )
    links = written(matched, "links")
    discard(close, sets)
    release(rows.sparkSession)
    return links


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components of more links: those found before go in as the ties of their nodes, not as all their links."""
    more = components(links.unionByName(parts.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    discard(parts, links)
    return more


def _unsettled(buckets: DataFrame, parts: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows (with ``part``) of buckets whose sets are in several components, how many pairs that leaves open, and how many in heavy buckets."""
    placed = buckets.join(parts, buckets["key"] == parts["node"], "left").select("sign", "key", "n", F.coalesce("root", "key").alias("part"))
    by_part = placed.groupBy("sign", "part").agg(F.count(F.lit(1)).alias("c"))
    sizes = by_part.groupBy("sign").agg(F.sum("c").alias("rows"), F.sum(F.col("c") * F.col("c")).alias("q"))
    mixed = sizes.select("sign", "rows", ((F.col("rows") * F.col("rows") - F.col("q")) / 2).cast("long").alias("pairs")).filter("pairs > 0")
    mixed = written(mixed.withColumn("heavy", F.col("pairs") > F.col("rows") * MANY), "mixed")
    n = mixed.agg(F.sum("pairs"), F.sum(F.when(F.col("heavy"), F.col("pairs")))).first()
    unsettled = written(placed.join(mixed.select("sign", "heavy"), "sign"), "open")
    discard(mixed)
    return unsettled, n[0] or 0, n[1] or 0


def _pivoted(unsettled: DataFrame, turn: int) -> DataFrame:
    """Each set with the pivot of each of its buckets, if that is in another component.

    First it is the set that is in most buckets: of near copies, that is the text they were made
    from, which is more alike to each than they are to one another. Later pivots are drawn by a
    hash of set, bucket and turn, so a set meets many others, and the group grows together
    without all its pairs being compared.
    """
    rank = F.xxhash64("key", "sign", F.lit(turn)).alias("rank")
    if turn == 0:
        degree = unsettled.groupBy("key").agg((-F.count(F.lit(1))).alias("degree"))
        unsettled, rank = unsettled.join(degree, "key"), F.col("degree").alias("rank")
    pivots = unsettled.groupBy("sign").agg(F.min(F.struct(rank, "key", "n", "part")).alias("p"))
    return (
        unsettled.join(pivots, "sign")
        .filter("part <> p.part AND 4 * least(n, p.n) >= 3 * greatest(n, p.n)")
        .select(F.least("key", "p.key").alias("a"), F.greatest("key", "p.key").alias("b"))
        .distinct()
    )


def _prefixes(common):
    """The rarest quarter of each set's shingles, and one, dealt by shingle: a row for each bucket with all a task has for it.

    Rows have the ``key`` and ``part`` of the set their text should have: texts of a repeated id that have another are left out.
    """

    def dealt(held):
        shingle, *others = [np.concatenate(c) for c in zip(*held, strict=True)]
        bucket = shingle & (BUCKETS - 1)
        order = np.argsort(bucket, kind="stable")
        there, counts = np.unique(bucket, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), *[buffers.lists(c[order], counts, pa.int64()) for c in (shingle, *others)]],
            names=["bucket", "shingle", "key", "part", "n", "place"],
        )

    @buffers.lean
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(CELLS, np.int64)
        cells, hits = common.value
        often[cells] = hits
        held: list[list[np.ndarray]] = []
        size = 0
        for batch, data, offsets in buffers.slices(rows, "text", buffers.SLICE_BYTES // 2):
            hashes, counts = shingle_sets(data, offsets)
            keys = buffers.signed(class_keys(hashes, counts))
            right = (keys == np.asarray(batch.column(batch.schema.get_field_index("key")))) & (counts > 0)
            shingle = buffers.signed(hashes[np.repeat(right, counts)])
            n, own = counts[right], np.repeat(np.arange(int(right.sum())), counts[right])
            order = np.lexsort([shingle, often[shingle & (CELLS - 1)], own])
            place = buffers.places(n)
            first = place <= n[own] // 4
            own, part = own[first], np.asarray(batch.column(batch.schema.get_field_index("part")))[right]
            held.append([shingle[order][first], keys[right][own], part[own], n[own], place[first]])
            size += len(own)
            if size > HELD:
                yield dealt(held)
                held, size = [], 0
        if size:
            yield dealt(held)

    return run


DEALT = "bucket int, shingle array<bigint>, key array<bigint>, part array<bigint>, n array<bigint>, place array<bigint>"


def meeting(shingle: np.ndarray, part: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries can be half of a pair: another component has the shingle, and the smaller of two sets has it in its first seventh."""
    order = np.argsort(shingle, kind="stable")
    shingle, part, front = shingle[order], part[order], (7 * place <= n)[order]
    start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(shingle))))
    highest, lowest = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    least, most = np.minimum.reduceat(part, start)[group], np.maximum.reduceat(part, start)[group]
    ahead = np.minimum.reduceat(np.where(front, part, highest), start)[group]
    ahead_most = np.maximum.reduceat(np.where(front, part, lowest), start)[group]
    some = np.logical_or.reduceat(front, start)[group]
    found = np.where(front, least != most, some & ((ahead != part) | (ahead_most != part)))
    kept = np.zeros(len(shingle), bool)
    kept[order] = found
    return kept


@buffers.lean
def _met(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_prefixes`` sorted by bucket: the entries that can meet another, one bucket at a time."""
    names = ["shingle", "key", "part", "n", "place"]

    def found(lists):
        shingle, key, part, n, place = (np.concatenate(c) for c in zip(*lists, strict=True))
        kept = meeting(shingle, part, n, place)
        return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (shingle, key, part, n, place)], names=names)

    bucket, held = None, []
    for batch in rows:
        at = np.asarray(batch.column(0))
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else []
        for a, b in zip(edge, [*edge[1:], len(at)], strict=True):
            if held and at[a] != bucket:
                yield found(held)
                held = []
            bucket = at[a]
            held.append([np.asarray(c.slice(a, b - a).flatten()).astype(np.int64) for c in batch.columns[1:]])
    if held:
        yield found(held)


def _rare_prefixes(open_sets: DataFrame, rows: DataFrame, classes: DataFrame, common) -> DataFrame:
    """``shingle``, ``key``, ``part``, ``n``, ``place``: what can meet of the prefixes of sets (``key``, ``part``).

    Most shingles of a prefix are in one set or one component alone. The prefixes are dealt by shingle as arrays, a row for each bucket and
    task, and only entries that others can meet become rows.
    """
    wanted = classes.join(open_sets, "key").select(F.col("least").alias("doc_id"), "key", "part")
    texts = rows.select("doc_id", "text").join(wanted, "doc_id").select("text", "key", "part")
    dealt = texts.mapInArrow(_prefixes(common), DEALT)
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return written(ordered.mapInArrow(_met, "shingle bigint, key bigint, part bigint, n bigint, place bigint"), "prefixes")


def _sharing_rare_shingles(found: DataFrame) -> DataFrame:
    """Pairs of sets in different components that can be alike by what they share of their rarest shingles.

    All sets order their shingles alike, rare ones first. Sets of sizes p and q that link share 3(p + q)/7 shingles or more, so from their
    first common one on both have that many left, which puts it in the first quarter of either and in the first seventh of the smaller. Near
    copies of one text that are too far from it have so many shingles of their own that what all copies share comes too late: they do not
    meet, however many there are.
    """
    left, right = found.alias("l"), found.alias("r")
    rest = F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
    near = (F.col("l.key") < F.col("r.key")) & (F.col("l.part") != F.col("r.part")) & (rest * 7 >= (F.col("l.n") + F.col("r.n")) * 3)
    pairs = left.join(right, (F.col("l.shingle") == F.col("r.shingle")) & near)
    return pairs.select(F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``docs``.

    Texts link if their sets of 5-word shingles have Jaccard similarity 0.75 or more; the
    component id is the smallest id reachable by links. Texts of equal sets are one class, and
    links are sought between classes: in each bucket of sets that share a block, all sets are
    compared with a pivot, and with other pivots while much is open. Of the sets that are then still
    in different components, those in small buckets are compared, and those in heavy ones if they share a
    shingle that is rare enough in both (``_rare_prefixes``, ``_sharing_rare_shingles``). NULL and empty
    texts, and rows without an id, link with nothing and keep their own id. Repeated rows each
    come out. Sets are compared by 64-bit shingle hashes.
    """
    return placed_rows(docs, id, text)[0].drop("text_hash")


def placed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """As ``near_duplicates``, and ``text_hash`` (``xxhash64`` of the text), which tells rows of one id apart; and the tables it reads."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    noted = written(rows.mapInArrow(_classes, f"doc_id {kind}, text_hash bigint, n bigint, key bigint, cell bigint, hits bigint, bits array<bigint>"), "classes")
    often = noted.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("hits").alias("hits")).orderBy(F.desc("hits"), "cell").limit(COMMON)
    often = often.toArrow()
    common = spark.sparkContext.broadcast((np.asarray(often.column("cell").combine_chunks()), np.asarray(often.column("hits").combine_chunks())))
    members = noted.filter("cell IS NULL").select("doc_id", "text_hash", "n", "key")
    listed = members.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = listed.groupBy("key").agg(F.min("doc_id").alias("least"))

    seed = 0
    while True:
        signs = rows.filter(F.col("doc_id").isNotNull()).mapInArrow(_signed_rows(common, seed), "sign bigint, key bigint, n bigint")
        sorted_signs = signs.repartition("sign").sortWithinPartitions("sign", "n", "key")
        buckets = written(sorted_signs.mapInArrow(_buckets, "sign bigint, key bigint, n bigint, pivot bigint"), "buckets")
        if buckets.filter("sign IS NULL").isEmpty():
            break
        discard(buckets)
        seed += 1  # a set's blocks fell together too much: deal all sets out anew
    del signs, sorted_signs
    release(spark)

    sketches = noted.filter(F.size("bits") > 0).dropDuplicates(["key"]).select("key", "n", "bits")
    stars = buckets.filter("pivot <> key").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    links = verified(stars, sketches, rows, classes)
    parts = components(links)
    discard(links)
    unsettled, open_pairs, heavy = _unsettled(buckets, parts)
    for turn in range(PIVOT_ROUNDS):
        if not heavy:
            break
        parts = _joined(parts, verified(_pivoted(unsettled.filter("heavy"), turn), sketches, rows, classes))
        before = heavy
        discard(unsettled)
        unsettled, open_pairs, heavy = _unsettled(buckets, parts)
        if turn > 1 and heavy > before * 0.7:
            break  # what is left there is alike without being linked
    # What shares a bucket and is not connected yet: pairs of small buckets, at most MANY times their rows, are compared. Sets
    # of heavy buckets have to share a rare shingle first.
    if open_pairs:
        light = unsettled.filter(~F.col("heavy"))
        left, right = light.alias("l"), light.alias("r")
        apart = (
            left.join(right, F.col("l.sign") == F.col("r.sign"))
            .filter("l.key < r.key AND l.part <> r.part AND 4 * least(l.n, r.n) >= 3 * greatest(l.n, r.n)")
            .select(F.col("l.key").alias("a"), F.col("r.key").alias("b"))
            .distinct()
        )
        found = []
        if heavy:
            found.append(_rare_prefixes(unsettled.filter("heavy").select("key", "part").distinct(), rows, classes, common))
            apart = apart.unionByName(_sharing_rare_shingles(found[0])).distinct()
        parts = _joined(parts, verified(apart, sketches, rows, classes))
        discard(*found)
    discard(buckets, unsettled)
    release(spark)
    rooted = classes.join(parts, classes["key"] == parts["node"], "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(smallest, "root").select("key", "component_id")
    linked = listed.join(component, "key").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id")
    alone = members.filter("key IS NULL OR doc_id IS NULL").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone), [noted, parts]


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without near duplicates: of each component, the row with its smallest id.

    Of rows that repeat that id, the one with the smallest text hash stays, and one of rows that
    repeat the text too. Texts without words, and rows without an id, are linked with nothing and
    all stay.
    """
    found, behind = placed_rows(docs)
    found = found.filter("doc_id IS NOT NULL AND n_shingles > 0")
    by_row = found.groupBy("doc_id", "text_hash").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    by_row = written(by_row, "placed")
    discard(*behind)
    least = by_row.filter("component_id = doc_id").groupBy("doc_id").agg(F.min("text_hash").alias("least"))
    gone = by_row.join(least, "doc_id", "left").filter("component_id <> doc_id OR text_hash <> least").select("doc_id", "text_hash")
    again = by_row.filter("n > 1").select("doc_id", "text_hash")
    mark = unused(docs, "_hash")
    own = docs.withColumn(mark, F.xxhash64("text"))
    kept = own.join(gone, (own["doc_id"] == gone["doc_id"]) & (own[mark] == gone["text_hash"]), "left_anti")
    if not again.isEmpty():  # whole rows are grouped only where rows repeat
        on = (kept["doc_id"] == again["doc_id"]) & (kept[mark] == again["text_hash"])
        kept = kept.join(again, on, "left_anti").unionByName(kept.join(again, on, "left_semi").dropDuplicates(["doc_id", mark]))
    return kept.select(*docs.columns)
