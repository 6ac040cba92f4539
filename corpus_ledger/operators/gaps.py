"""Which papers lack content, and which of those are worth working on.

Every frame here is keyed by ``doi``. Rows without a DOI are dropped before a join, so
they never pile up on one task, and key lists are made distinct before they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ci, has_text, has_text_sql, is_blank_sql, null_if_empty, strip

# Evaluation results that are worth processing, and the highest confidence
# at which a rejection is still looked at again.
ACCEPTED = ("valid", "doubted")
REJECTED = "not_valid"
MAX_REJECT_CONFIDENCE = 7
NO_CONFIDENCE = 999


def keyed(papers: DataFrame) -> DataFrame:
    """Rows that have a DOI."""
    return papers.filter(has_text_sql(F.col("doi")))


def without_doi(papers: DataFrame) -> DataFrame:
    return papers.filter(is_blank_sql(F.col("doi")))


def missing_abstract() -> Column:
    return is_blank_sql(F.col("abstract"))


def missing_text() -> Column:
    return is_blank_sql(F.col("full_text"))


def missing_sections() -> Column:
    return is_blank_sql(F.col("full_text_sections"))


def missing_abstract_or_sections() -> Column:
    return missing_abstract() | missing_sections()


def missing_text_or_abstract() -> Column:
    return missing_text() | missing_abstract()


def missing_all_text() -> Column:
    return missing_text() & missing_sections()


def needs_update() -> Column:
    """Content is missing, or it came from something other than the structured parser."""
    status = F.col("parsing_status")
    other_parser = has_text_sql(status) & ~contains_ci(status, "grobid")
    return missing_abstract() | missing_text() | missing_sections() | other_parser


def needs_oa_url(min_year: str | None = None) -> Column:
    """No text, and no URL beyond a DOI redirect. Years are compared as text."""
    url = F.col("oa_url")
    cond = missing_all_text() & (
        is_blank_sql(url) | F.lower(url).startswith("https://doi.org/") | F.lower(url).startswith("http://dx.doi.org/")
    )
    return cond if min_year is None else cond & (F.col("year") >= min_year)


def without_status() -> Column:
    return is_blank_sql(F.col("parsing_status"))


def content_flags(papers: DataFrame) -> DataFrame:
    """Per row: does it hold an abstract, text, sections, or a URL once white space is ignored?"""
    abstract, text, sections = (has_text(F.col(c)) for c in ("abstract", "full_text", "full_text_sections"))
    return papers.withColumns(
        {
            "has_abstract": abstract,
            "has_full_text": text,
            "has_sections": sections,
            "has_content": text | sections,
            "has_any": abstract | text | sections,
            "has_oa_url": has_text(F.col("oa_url")),
        }
    )


def worth_processing(evaluations: DataFrame) -> DataFrame:
    """Distinct DOIs an evaluation accepted, or rejected without much confidence."""
    result, confidence = F.col("result"), F.coalesce(F.col("confidence_score"), F.lit(NO_CONFIDENCE))
    return (
        evaluations.filter(
            has_text_sql(F.col("doi"))
            & (result.isin(*ACCEPTED) | ((result == REJECTED) & (confidence <= MAX_REJECT_CONFIDENCE)))
        )
        .select("doi")
        .distinct()
    )


def work_list(papers: DataFrame, evaluations: DataFrame, limit: int | None = None) -> DataFrame:
    """Sorted DOIs that lack an abstract or sections and are worth processing."""
    needed = keyed(papers).filter(missing_abstract_or_sections()).select("doi").distinct()
    out = needed.join(worth_processing(evaluations), "doi", "left_semi").orderBy("doi")
    return out if limit is None else out.limit(limit)


def priority_after_removal(removed: DataFrame, papers: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Removed DOIs that still lack text, or are gone from the table, and are worth processing."""
    with_text = (
        content_flags(keyed(papers)).groupBy("doi").agg(F.max("has_content").alias("has_content"))
    ).filter("has_content")
    return (
        removed.select("doi")
        .distinct()
        .join(with_text, "doi", "left_anti")
        .join(worth_processing(evaluations), "doi", "left_semi")
    )


def new_missing(papers: DataFrame, excluded: DataFrame) -> DataFrame:
    """Papers that lack an abstract or sections, minus already listed DOIs, with the kind of gap."""
    return gap_classes(papers, excluded).filter("gap <> 'already_excluded'")


def gap_classes(papers: DataFrame, excluded: DataFrame) -> DataFrame:
    listed = excluded.select("doi").distinct().withColumn("_listed", F.lit(True))
    gap = (
        F.when(F.col("_listed"), "already_excluded")
        .when(missing_abstract() & missing_sections(), "missing_both")
        .when(missing_abstract(), "missing_abstract")
        .otherwise("missing_full_text")
    )
    narrow = keyed(papers).filter(missing_abstract_or_sections())
    return narrow.join(listed, "doi", "left").select("doi", "title", gap.alias("gap"))


def gap_summary(papers: DataFrame, excluded: DataFrame) -> DataFrame:
    return gap_classes(papers, excluded).groupBy("gap").agg(F.count(F.lit(1)).alias("papers"))


def missing_matrix(papers: DataFrame) -> DataFrame:
    """One row: how many papers lack text, an abstract, either or both."""
    return papers.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(missing_text()).alias("missing_full_text"),
        F.count_if(missing_abstract()).alias("missing_abstract"),
        F.count_if(missing_text_or_abstract()).alias("missing_either"),
        F.count_if(missing_text() & missing_abstract()).alias("missing_both"),
    )


def _keys(df: DataFrame) -> DataFrame:
    return df.select(strip(F.col("doi")).alias("doi")).filter("doi <> ''").distinct()


def presence(papers: DataFrame, tracker: DataFrame) -> DataFrame:
    """Every DOI of either table with the side it is on; one shuffle, no outer join."""
    tagged = _keys(papers).withColumn("side", F.lit(1)).unionByName(_keys(tracker).withColumn("side", F.lit(2)))
    where = F.sum("side")
    return tagged.groupBy("doi").agg(
        F.when(where == 3, "both").when(where == 1, "only_papers").otherwise("only_tracker").alias("presence")
    )


def presence_counts(papers: DataFrame, tracker: DataFrame) -> DataFrame:
    return presence(papers, tracker).groupBy("presence").agg(F.count(F.lit(1)).alias("dois"))


def not_in_tracker(papers: DataFrame, tracker: DataFrame) -> DataFrame:
    return _keys(papers).join(_keys(tracker), "doi", "left_anti")


def not_in_papers(papers: DataFrame, tracker: DataFrame) -> DataFrame:
    return _keys(tracker).join(_keys(papers), "doi", "left_anti")


def already_complete(papers: DataFrame, lists: DataFrame) -> DataFrame:
    """DOIs of the table that no supplied list asks for."""
    return keyed(papers).select("doi").distinct().join(lists.select("doi").distinct(), "doi", "left_anti")


def key_union(*frames: DataFrame) -> DataFrame:
    """Distinct DOIs over any number of frames; each is made distinct map-side first."""
    out = frames[0].select("doi")
    for frame in frames[1:]:
        out = out.unionByName(frame.select("doi"))
    return out.filter(has_text_sql(F.col("doi"))).distinct()


def key_difference(papers: DataFrame, tracker: DataFrame) -> DataFrame:
    """Row counts of both tables and their difference (not a set difference)."""
    sides = keyed(papers).select(F.lit(1).alias("p"), F.lit(0).alias("t")).unionAll(
        tracker.select(F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    return sides.agg(
        F.sum("p").alias("papers"), F.sum("t").alias("tracked"), (F.sum("p") - F.sum("t")).alias("difference")
    )


def oa_lookup(identifiers: DataFrame, papers: DataFrame) -> DataFrame:
    """Known URL of each listed DOI; NULL when there is none."""
    known = (
        keyed(papers)
        .filter(has_text_sql(F.col("oa_url")))
        .groupBy("doi")
        .agg(F.min(F.struct(F.col("pmid").isNull(), "pmid", "oa_url")).alias("_first"))
        .select("doi", F.col("_first.oa_url").alias("oa_url"))
    )
    return identifiers.select("doi").distinct().join(known, "doi", "left")


def list_status(identifiers: DataFrame, papers: DataFrame) -> DataFrame:
    """YES/NO per listed DOI for abstract and text; NOT FOUND when the table lacks it."""

    def yes_no(cond: Column) -> Column:
        return F.when(F.col("_found").isNull(), "NOT FOUND").when(cond, "YES").otherwise("NO")

    held = (
        keyed(papers)
        .groupBy("doi")
        .agg(
            F.lit(True).alias("_found"),
            F.max(has_text_sql(F.col("abstract"))).alias("_abstract"),
            F.max(has_text_sql(F.col("full_text"))).alias("_text"),
            F.max(has_text_sql(F.col("full_text_sections"))).alias("_sections"),
        )
    )
    return (
        identifiers.select("doi")
        .distinct()
        .join(held, "doi", "left")
        .select(
            "doi",
            yes_no(F.col("_abstract")).alias("abstract"),
            yes_no(F.col("_text")).alias("full_text"),
            yes_no(F.col("_sections")).alias("sections"),
        )
    )


def select_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a keyed table for a list of keys. Spark broadcasts the list when it is small enough."""
    return table.join(keys.select("doi").distinct(), "doi", "left_semi")


def remove_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys.select("doi").distinct(), "doi", "left_anti")


def coverage(papers: DataFrame) -> DataFrame:
    """One row: content coverage of the paper table in counts and percent."""
    counts = papers.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has_text_sql(F.col("doi"))).alias("with_doi"),
        F.count_if(~missing_abstract()).alias("with_abstract"),
        F.count_if(~missing_text()).alias("with_full_text"),
        F.count_if(~missing_sections()).alias("with_sections"),
        F.count_if(~without_status()).alias("with_status"),
    )
    return counts.withColumns(
        {
            f"{c}_pct": F.round(F.try_divide(F.col(c) * 100.0, F.col("total")), 2)
            for c in ("with_abstract", "with_sections", "with_status")
        }
    )


def oa_content_counts(papers: DataFrame) -> DataFrame:
    """One row: keyed papers with content, with a URL, and with a URL but no content."""
    content = ~missing_text() | ~missing_sections()
    url = has_text_sql(F.col("oa_url"))
    return keyed(papers).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(content).alias("has_content"),
        F.count_if(url).alias("has_oa_url"),
        F.count_if(url & ~content).alias("oa_without_content"),
    )


def best_identifiers(papers: DataFrame) -> DataFrame:
    return papers.select(
        "pmid", F.coalesce(null_if_empty(F.col("doi")), null_if_empty(F.col("title"))).alias("identifier")
    )
