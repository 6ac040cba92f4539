"""Substring dedup over word windows: a count-min prefilter, then exact grouping of what it leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .tables import release, written

WINDOW_WORDS = 35
ANCHOR_WORDS = 18


def repeated_words(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """One row per row of ``docs``: words, removed words, and the digest of the words that stay.

    A word goes if a window of ``width`` words over it also starts anywhere else, in the same
    text or another. Sketches of the partitions, added up, overestimate how often each window's
    anchor occurs; only windows whose anchor may repeat are grouped, by anchor and window hash
    (64 bits each). Copies of a run of windows are counted as one content first, so a passage in
    a third of all documents is a few rows with high counts. NULL and empty texts have no words;
    repeated rows are documents of their own and remove each other's windows.
    """
    kind = repeats.Kind(words=True, width=width, inner=anchor)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    found = repeats.candidate_runs(rows, kind)
    release(docs.sparkSession)
    runs = repeats.occurrences(found)
    distinct = written(repeats.contents(runs), "contents")
    shared = repeats.shared_anchors(distinct).select("key")
    # Windows of contents that share an anchor, each content once with its count.
    listed = found.filter(F.size("key") > 0).select("row", F.inline(F.arrays_zip("start", F.col("windows").alias("hashes"))))
    several = distinct.join(shared, "key", "left_semi").select("key", "content", "n", "row", "start").join(listed, ["row", "start"])
    windows = written(several.select("key", "content", "n", F.posexplode("hashes").alias("place", "window")), "windows")
    often = windows.groupBy("key", "window").agg(F.sum("n").alias("total")).filter("total > 1").select("key", "window")
    partly = (
        windows.filter("n = 1")
        .join(often, ["key", "window"], "left_semi")
        .groupBy("key", "content")
        .agg(F.collect_set("place").alias("places"))
        .select("key", "content", F.expr(f"CAST(transform(places, p -> named_struct('from', p, 'to', p + 1)) AS {repeats.SPANS})").alias("spans"))
    )
    repeated = repeats.whole_runs(distinct).unionByName(partly)
    return repeats.removal(found, runs, repeated, kind)


def deduplicated_words(docs: DataFrame) -> DataFrame:
    return repeated_words(docs).select("doc_id", F.col("n_items").alias("n_words"), "n_removed", "kept_sha256")
