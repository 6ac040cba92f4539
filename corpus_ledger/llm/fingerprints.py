"""Threshold-scaled sketches: the shingle hashes of a text below a fixed fraction of the hash range.

The fraction is the same for every text, so sketches of parts merge by union, and the share of
a short text's hashes found in a long text's sketch estimates containment however unequal the
two are. Everything here is built-in column functions; no Python runs on executors.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stages import once
from .tables import written

SHINGLE_WORDS = 5
ONE_IN = 4
#: Text of one bucket of neighbouring ids, about; a single longer text has one of its own. There are about ``MOST_BUCKETS`` at
#: most: beyond that much text buckets grow with it, so borders stay few enough for the driver and the plan.
BUCKET_CHARS = 4_000_000
MOST_BUCKETS = 1 << 15
SPACE = "[ \\t-\\r]+"


def below(one_in: int = ONE_IN) -> int:
    """The limit that one in ``one_in`` hashes lies below."""
    return -(1 << 63) + (1 << 64) // one_in


def sketch(text: Column, one_in: int = ONE_IN, size: int = SHINGLE_WORDS) -> Column:
    """Sorted distinct shingle hashes in the lowest ``1/one_in`` of the hash range.

    Words are runs without ASCII white space, A-Z lowered. A text of fewer than ``size`` words
    is one shingle; a text without words, or NULL, has the empty sketch. A text with shingles
    but none below the limit keeps its smallest as a stand-in, so short texts stay comparable;
    ``merged`` drops stand-ins as soon as there is a hash below the limit.
    """
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(low, SPACE), lambda w: w != "")

    def shingles(ws: Column) -> Column:
        # Past the end get() is NULL and skipped by the hash, so the first entry of a short text holds all its words.
        hashes = F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + j) for j in range(1, size)]))
        return F.slice(hashes, 1, F.greatest(F.size(ws) - (size - 1), F.least(F.size(ws), F.lit(1))))

    # One-entry arrays bind a value once; written out, the words would be split again for every shingle.
    hashes = F.transform(F.array(words), shingles)
    return F.get(F.transform(hashes, lambda hs: F.array_sort(F.array_distinct(_retained(hs, one_in)))), F.lit(0))


def _retained(hashes: Column, one_in: int) -> Column:
    kept = F.filter(hashes, lambda h: h < F.lit(below(one_in)))
    return F.when(F.exists(hashes, lambda h: h < F.lit(below(one_in))), kept).otherwise(
        F.filter(F.array(F.array_min(hashes)), lambda h: h.isNotNull())
    )


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Sketch of two texts taken as one set."""
    return F.get(F.transform(F.array(F.array_union(a, b)), lambda hs: F.array_sort(_retained(hs, one_in))), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets; two empty sketches are alike, an empty and another not."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that are in the second; 1 for an empty sketch."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(s: Column) -> Column:
    """A sketch as a string: 16 hex digits for each hash, in order, without separators."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", one_in: int = ONE_IN) -> DataFrame:
    """``doc_id``, ``sketch`` for each row; NULL text gives the empty sketch."""
    return docs.select(F.col(id).alias("doc_id"), sketch(F.col(text), one_in).alias("sketch"))


def bucket_starts(rows: DataFrame) -> list[tuple[bool, int, int]]:
    """The least ``(_has, _id, _key)`` of each bucket, in order: runs of texts in that order, cut by running size.

    Only ids, hashes and lengths are sorted, by ranges that are written once; the driver gets one
    row per range and one per bucket, at most ``MOST_BUCKETS`` and one. However uneven the ids, a bucket holds ``BUCKET_CHARS``
    (or its share of all text, if that is more) and at most one text more; only rows that repeat id and text stay together.
    """
    place = F.struct("_has", "_id", "_key")
    narrow = written(rows.groupBy("_has", "_id", "_key").agg(F.sum((F.length("_text") + 100).cast("long")).alias("_n")), "lengths")
    ranged = written(narrow.repartitionByRange("_has", "_id", "_key").withColumn("_part", F.spark_partition_id()), "ranges")
    totals = sorted(ranged.groupBy("_part").agg(F.min(place).alias("first"), F.sum("_n").alias("n")).collect(), key=lambda r: tuple(r["first"]))
    if not totals:
        return []
    before = [0, *accumulate(r["n"] for r in totals)]
    size = max(BUCKET_CHARS, -(-before[-1] // MOST_BUCKETS))
    offsets = rows.sparkSession.createDataFrame([(r["_part"], before[k]) for k, r in enumerate(totals)], "_part int, _before long")
    earlier = Window.partitionBy("_part").orderBy("_has", "_id", "_key").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    numbered = ranged.join(F.broadcast(offsets), "_part").select(place.alias("place"), F.floor(at / F.lit(size)).alias("_bucket"))
    return sorted(tuple(r["start"]) for r in numbered.groupBy("_bucket").agg(F.min("place").alias("start")).collect())


def bucket_of(place: Column, starts: list[tuple[bool, int, int]]) -> Column:
    """Number of the last start up to ``place``, by binary search in a constant array."""
    if not starts:
        return F.lit(0)
    # Each array is folded into one literal.
    columns = [F.split(F.lit(",".join(str(x).lower() for x in c)), ",").cast(f"array<{t}>") for c, t in zip(zip(*starts, strict=True), ("boolean", "bigint", "bigint"), strict=True)]
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        start = F.struct(*[F.get(c, at + step) for c in columns])
        return F.when((at + step < len(starts)) & (start <= place), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def edited_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text", one_in: int = ONE_IN) -> DataFrame:
    """Each text, its next in descending id order, and an edit that mixes the two.

    The edited text has its last ``floor(n/3)`` code points replaced by the first as many (or
    all) of the next text; after the last text comes the first. The order is by id descending
    (NULL last), then by a hash of the text, so ties are in a fixed order. Rows that repeat id
    and text share one place in the order and each come out. NULL text counts as empty.

    Texts move once: to their bucket, a run of neighbouring texts in that order,
    where the next text is the neighbour in the sort order. Only one text per bucket has its
    neighbour elsewhere and is fetched for it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        body.alias("_text"),
        F.col(id).isNotNull().alias("_has"),
        F.coalesce(F.col(id).cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(body).alias("_key"),
    )
    place = F.struct("_has", "_id", "_key")
    rows = rows.withColumn("_bucket", bucket_of(place, bucket_starts(rows)))

    # The last text of each bucket precedes the first of the bucket above; the very last precedes the very first.
    ends = rows.groupBy("_bucket").agg(F.max(place).alias("_last"))
    above = Window.orderBy("_bucket")
    everything = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heirs = ends.select(F.coalesce(F.lead("_bucket").over(above), F.min("_bucket").over(everything)).alias("_to"), "_last.*")
    fetched = (
        rows.join(F.broadcast(heirs), ["_has", "_id", "_key"])
        .dropDuplicates(["_to"])
        .select(F.col("_to").alias("_bucket"), F.col("_text").alias("_far"))
    )
    order = Window.partitionBy("_bucket").orderBy("_has", "_id", "_key")
    placed = (
        rows.repartition("_bucket")
        .groupBy("_bucket", "_has", "_id", "_key")
        .agg(F.first("_text").alias("_text"), F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("_rows"))
    )
    sketched = once(placed, {"sketch": sketch(F.col("_text"), one_in)})
    beside = sketched.select(
        "*", F.lag("_text").over(order).alias("_near"), F.lag("sketch").over(order).alias("_near_sketch")
    ).join(fetched, "_bucket", "left")
    n, third = F.length("_text"), F.floor(F.length("_text") / 3).cast("int")
    following = F.coalesce("_near", "_far")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - third), F.substring(following, F.lit(1), third))
    ready = once(
        beside.select("doc_id", "_rows", "_text", "sketch", edited.alias("_edited"), "_near_sketch", "_far"),
        {"edited_sketch": sketch(F.col("_edited"), one_in), "next_sketch": F.coalesce("_near_sketch", sketch(F.col("_far"), one_in))},
    )
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))
    return ready.select("doc_id", F.col("_text").alias("text"), F.col("_edited").alias("edited"), "sketch", "edited_sketch", "next_sketch", repeated.alias("_copy")).drop("_copy")


def document_fingerprints(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """One row per row of ``docs``: sketches of the text and of its edit as strings, and how alike they are."""
    s, e, n = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited_pairs(docs, one_in=one_in).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(s).alias("fingerprint"),
        as_text(e).alias("edited_fingerprint"),
        likeness(s, e).alias("near_edited"),
        likeness(s, n).alias("near_next"),
        containment(s, e).alias("contained_in_edited"),
    )
