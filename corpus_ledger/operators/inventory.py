"""Artefacts on disk: presence, validity, directory totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import validity as VA
from ..functions.identifiers import FAST_SUFFIX, doi_of_stem, stem_of
from ..functions.text import has_text_sql
from ..schemas import PARSERS
from .gaps import keyed, missing_all_text

# How much larger one folder must be to be the one to keep.
KEEP_PAPERS_FACTOR = 10
KEEP_PDFS_FACTOR = 2
EXAMPLES = 5


def with_doi(files: DataFrame, *known: DataFrame) -> DataFrame:
    """Add ``doi`` to files with a ``stem``: the known DOI that has this stem.

    ``known`` are tables with a ``doi`` column. Only a stem no known DOI has is turned back,
    which is lossy for DOIs with an underscore. Two known DOIs with one stem give two rows.
    """
    dois = [k.select("doi").filter(has_text_sql(F.col("doi"))) for k in known]
    stems = reduce(DataFrame.unionByName, dois).distinct().select(stem_of(F.col("doi")).alias("_stem"), F.col("doi").alias("_known"))
    plain = F.regexp_replace("stem", f"{FAST_SUFFIX}$", "")
    return (
        files.withColumn("_stem", plain)
        .join(stems, "_stem", "left")
        .withColumn("doi", F.coalesce("_known", doi_of_stem(F.col("stem"))))
        .drop("_stem", "_known")
    )


def valid_parsers(bodies: DataFrame, *known: DataFrame) -> DataFrame:
    """``(doi, parser)`` of valid extractions."""
    return with_doi(VA.with_validity(bodies).filter("is_valid").select("stem", "parser"), *known).select("doi", "parser")


def parser_sets(keys: DataFrame) -> DataFrame:
    """One row per DOI with the set of its parsers (at most one entry per parser)."""
    return keys.groupBy("doi").agg(F.array_sort(F.collect_set("parser")).alias("parsers"))


def routed(bodies: DataFrame) -> DataFrame:
    """Every extraction with its ``route``, usable or quarantine, and the ``reason`` of the latter: one parse decides both."""
    judged = VA.with_content_check(VA.with_validity(VA.parse_bodies(bodies), "is_usable"))
    usable = F.coalesce(F.col("is_usable"), F.lit(False))
    return judged.select(
        *bodies.columns, F.when(~usable, F.coalesce("reason", F.lit("Too little content"))).alias("reason"),
        F.when(usable, "usable").otherwise("quarantine").alias("route"),
    )


def quarantine(bodies: DataFrame) -> DataFrame:
    """Extractions that are not usable, with their reason. No file moves."""
    return routed(bodies).filter("route = 'quarantine'").drop("route")


def check_types(bodies: DataFrame) -> DataFrame:
    """``(stem, parser, type, reason)``: valid, invalid or empty per extraction."""
    kind = F.when(~F.col("is_valid"), "invalid").when(~F.col("has_content"), "empty").otherwise("valid")
    return VA.with_content_check(bodies).select("stem", "parser", kind.alias("type"), "reason")


def validity_statistics(bodies: DataFrame) -> DataFrame:
    return check_types(bodies).groupBy("type", "parser").agg(F.count(F.lit(1)).alias("files"))


def validity_examples(bodies: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """The first ``n`` stems per problem type; Spark cuts each task to ``n`` before the shuffle."""
    problems = check_types(bodies).filter("type <> 'valid'").withColumn("kind", F.concat_ws("_", "type", "parser"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("stem"))
    return problems.withColumn("rank", rank).filter(F.col("rank") <= n).select("kind", "rank", "stem")


def directory_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and newest stamp per directory."""
    return files.groupBy("dir").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("mtime_s").alias("latest_s")
    )


def directory_diff(files: DataFrame, left: str = "papers", right: str = "pdfs") -> DataFrame:
    """Every file name with the directory it is in, and whether sizes agree.

    One grouping over both directories replaces a full outer join.
    """

    def size_in(d: str) -> Column:
        return F.max(F.when(F.col("dir") == d, F.col("length")))

    sides = (
        files.filter(F.col("dir").isin(left, right))
        .groupBy("stem")
        .agg(size_in(left).alias("left_size"), size_in(right).alias("right_size"))
    )
    where = (
        F.when(F.col("right_size").isNull(), f"only_{left}")
        .when(F.col("left_size").isNull(), f"only_{right}")
        .when(F.col("left_size") == F.col("right_size"), "same_size")
        .otherwise("different_size")
    )
    return sides.select("stem", where.alias("state"))


def directory_overlap(files: DataFrame) -> DataFrame:
    return directory_diff(files).groupBy("state").agg(F.count(F.lit(1)).alias("files"))


def in_both(files: DataFrame, left: str = "papers", right: str = "pdfs") -> DataFrame:
    names = files.select("dir", "stem")
    return names.filter(F.col("dir") == left).select("stem").intersect(names.filter(F.col("dir") == right).select("stem"))


def consolidation_advice(files: DataFrame, left: str = "papers", right: str = "pdfs") -> DataFrame:
    """One row: which directory to keep, from the two file counts and newest stamps."""
    row = files.agg(
        *[F.count_if(F.col("dir") == d).alias(f"{d}_files") for d in (left, right)],
        *[F.max(F.when(F.col("dir") == d, F.col("mtime_s"))).alias(f"{d}_latest") for d in (left, right)],
    )
    advice = (
        F.when(F.col(f"{left}_files") > F.col(f"{right}_files") * KEEP_PAPERS_FACTOR, f"consolidate to {left}")
        .when(F.col(f"{right}_files") > F.col(f"{left}_files") * KEEP_PDFS_FACTOR, f"consolidate to {right}")
        .otherwise(f"consolidate to {left} (historical standard)")
    )
    active = F.when(F.col(f"{left}_latest") > F.col(f"{right}_latest"), left).otherwise(right)
    return row.select(f"{left}_files", f"{right}_files", advice.alias("advice"), active.alias("more_active"))


def files_without_extraction(pdfs: DataFrame, extractions: DataFrame, parser: str = "grobid") -> DataFrame:
    """PDF stems that lack the parser's output."""
    done = extractions.filter(F.col("parser") == parser).select("stem")
    return pdfs.select("stem").distinct().join(done, "stem", "left_anti")


def presence_by_stem(pdfs: DataFrame, extractions: DataFrame, directory: str = "papers") -> DataFrame:
    """``(stem, has_pdf, has_pymupdf, has_grobid)``: one tagged union, one grouping.

    Only PDFs of the primary folder count, and no empty files.
    """
    tagged = pdfs.filter((F.col("length") > 0) & (F.col("dir") == directory)).select("stem", F.lit("pdf").alias("kind")).unionByName(
        extractions.filter("length > 0").select("stem", F.col("parser").alias("kind"))
    )
    return tagged.groupBy("stem").agg(*[F.max(F.col("kind") == k).alias(f"has_{k}") for k in ("pdf", *PARSERS)])


def content_with_artefact(papers: DataFrame, bodies: DataFrame) -> DataFrame:
    """Papers without text that have an extraction, classed by what is usable.

    The structured file is looked at first, and a bad file of either parser hides a good
    one of the other in ``class``; ``usable_parser`` names the good one.
    """
    judged = VA.with_section_list_check(bodies).select(
        "stem", "parser", F.when(~F.col("is_valid"), "json_invalid").when(~F.col("has_content"), "json_empty").otherwise("ok").alias("state")
    )
    flags = judged.groupBy("stem").agg(
        *[F.min(F.when(F.col("parser") == p, F.col("state"))).alias(p) for p in PARSERS]
    )
    bad = [F.when(F.col(p) != "ok", F.col(p)) for p in ("grobid", "pymupdf")]
    label = F.coalesce(
        *bad,
        F.when(F.col("grobid").isNotNull() & F.col("pymupdf").isNotNull(), "has_both")
        .when(F.col("grobid").isNotNull(), "has_grobid")
        .otherwise("has_pymupdf"),
    )
    usable = F.when(F.col("grobid") == "ok", "grobid").when(F.col("pymupdf") == "ok", "pymupdf")
    missing = keyed(papers).filter(missing_all_text()).select("doi", stem_of(F.col("doi")).alias("stem")).distinct()
    return missing.join(flags, "stem").select("doi", label.alias("class"), usable.alias("usable_parser"))


def artefact_counts(papers: DataFrame, extractions: DataFrame) -> DataFrame:
    """One row: papers without text, and how many have an extraction (structured first)."""
    flags = extractions.groupBy("stem").agg(*[F.max(F.col("parser") == p).alias(p) for p in PARSERS])
    missing = keyed(papers).filter(missing_all_text()).select("doi", stem_of(F.col("doi")).alias("stem")).distinct()
    has = {p: F.coalesce(F.col(p), F.lit(False)) for p in PARSERS}
    return missing.join(flags, "stem", "left").agg(
        F.count(F.lit(1)).alias("missing"),
        F.count_if(has["grobid"]).alias("have_json"),
        F.count_if(~has["grobid"] & has["pymupdf"]).alias("have_fast"),
        F.count_if(has["grobid"] | has["pymupdf"]).alias("have_either"),
    )


def artefact_coverage(papers: DataFrame, extractions: DataFrame) -> DataFrame:
    """One row: files per parser against keyed papers, in percent.

    Both sides are reduced to counters and added in one tagged union, so no cross join.
    """
    p = keyed(papers).select(
        F.lit(1).alias("total"), missing_all_text().cast("int").alias("missing"), F.lit(0).alias("structured"), F.lit(0).alias("fast")
    )
    e = extractions.select(
        F.lit(0).alias("total"), F.lit(0).alias("missing"),
        (F.col("parser") == "grobid").cast("int").alias("structured"), (F.col("parser") == "pymupdf").cast("int").alias("fast"),
    )
    names = ("total", "missing", "structured", "fast")
    sums = p.unionByName(e).agg(*[F.sum(n).alias(n) for n in names])
    return sums.select(
        F.col("total").alias("total_dois"), F.col("missing").alias("missing_both"),
        (F.col("total") - F.col("missing")).alias("has_content"), F.col("structured").alias("structured_files"), F.col("fast").alias("fast_files"),
        *[F.round(F.try_divide(F.col(n) * 100.0, F.col("total")), 2).alias(f"{n}_pct") for n in ("missing", "structured", "fast")],
    )
