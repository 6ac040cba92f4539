"""Merge extractions, logs and lists into the paper table.

Every job yields *changes* first: one narrow row per paper with the new values. Only
:func:`apply_changes` touches the wide table. Decisions use flags and lengths computed at
the scan; text moves only for rows that get new text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import status as S
from ..functions import variant as V
from ..functions.identifiers import stem_of
from ..functions.stages import once
from ..functions.text import contains_ci, has_text, has_text_sql, is_blank_sql, null_if_empty, spread_key
from ..schemas import PARSERS
from .gaps import keyed, missing_abstract, missing_text, needs_update, without_status
from .sections import parsed_sections, sections_json, sections_text

CONTENT = ("abstract", "full_text", "full_text_sections", "parsing_status")


def choose_parser(extractions: DataFrame, legacy: bool = False) -> DataFrame:
    """Extraction to use per stem ``(stem, parser, has_body)``.

    With both present, the structured one is used if its body is not empty (an unreadable
    file has none); ``legacy`` always prefers it.
    """
    flags = extractions.groupBy("stem").agg(
        *[F.max(F.col("parser") == p).alias(f"has_{p}") for p in PARSERS],
        F.max((F.col("parser") == "grobid") & F.col("has_body")).alias("structured_body"),
    )
    both = F.col("has_grobid") & F.col("has_pymupdf")
    wins = F.lit(True) if legacy else F.col("structured_body")
    choice = F.when(both, F.when(wins, "grobid").otherwise("pymupdf")).when(F.col("has_grobid"), "grobid").otherwise("pymupdf")
    return flags.select("stem", choice.alias("parser"), F.col("has_grobid").alias("has_structured"))


def with_body_flag(bodies: DataFrame) -> DataFrame:
    """``(stem, parser, has_body)``: does the structured file list any section?"""
    doc = F.when(F.col("parser") == "grobid", V.parse(F.col("body")))
    staged = once(bodies, {"_doc": doc})
    listed = F.coalesce(F.array_size(V.items_at(F.col("_doc"), "$.full_text.body")) > 0, F.lit(False))
    return staged.select("stem", "parser", listed.alias("has_body"))


def _targets(papers: DataFrame) -> DataFrame:
    """Narrow row per DOI that an import may change.

    Rows that repeat a DOI are one paper: the one with the highest ``pmid`` decides, and the
    change applies to all of them. The grouping leaves one row per DOI and task.
    """
    status = F.col("parsing_status")
    facts = F.struct(
        status.alias("old_status"), has_text(F.col("abstract")).alias("has_abstract"), has_text(F.col("full_text")).alias("has_text"),
        has_text(F.col("full_text_sections")).alias("has_sections"),
        (has_text_sql(status) & ~contains_ci(status, "grobid")).alias("other_parser"), "pmid",
    )
    rows = keyed(papers).filter(needs_update()).select("doi", facts.alias("f"))
    newest = rows.groupBy("doi").agg(F.max_by("f", F.coalesce("f.pmid", F.lit(""))).alias("f"))
    return newest.select("doi", stem_of(F.col("doi")).alias("stem"), "f.*").drop("pmid")


def import_changes(papers: DataFrame, bodies: DataFrame, ledger: DataFrame) -> DataFrame:
    """Changes an import of extractions makes.

    A paper parsed by something else is overridden by a structured file, even an empty one;
    a paper that is complete and not overridden is skipped. Columns are decided one by one.
    """
    targets = _targets(papers)
    # Only files of papers in question are parsed, each once; Spark places both sides by
    # stem for this join, and the grouping and the join below keep that placement.
    needed = bodies.select("stem", "parser", "body").join(targets.select("stem").distinct(), "stem", "left_semi")
    sides = parsed_sections(needed).groupBy("stem").agg(
        *[
            F.max_by(F.struct("abstract", "sections", "has_body", "unreadable"), F.when(F.col("parser") == p, 1)).alias(f"in_{p}") for p in PARSERS
        ]
    )
    has = {p: F.col(f"in_{p}").isNotNull() for p in PARSERS}
    override = F.col("other_parser") & has["grobid"]
    structured = has["grobid"] & (override | ~has["pymupdf"] | F.col("in_grobid.has_body"))
    held = ledger.select("doi", F.lit(True).alias("_tracked"), *[F.col(f"{p}_status").alias(f"_{p}") for p in PARSERS])
    decided = targets.join(sides, "stem").withColumns(
        {"override": override, "parser": F.when(structured, "grobid").otherwise("pymupdf")}
    )
    chosen = F.when(F.col("parser") == "grobid", F.col("in_grobid")).otherwise(F.col("in_pymupdf"))
    joined = once(
        decided.withColumn("_chosen", chosen).join(held, "doi", "left"),
        {
            "skipped": F.col("has_abstract") & (F.col("has_text") | F.col("has_sections")) & ~F.col("override"),
            "new_abstract": F.col("_chosen.abstract"),
            "sections": F.col("_chosen.sections"),
            "new_text": null_if_empty(sections_text(F.col("_chosen.sections"))),
        },
    )
    live = ~F.col("skipped")
    takes_text = live & F.col("new_text").isNotNull() & (~F.col("has_text") | F.col("override"))
    takes_sections = live & F.col("sections").isNotNull() & (~F.col("has_sections") | F.col("override"))
    takes_abstract = live & ~F.col("has_abstract") & has_text_sql(F.col("new_abstract"))
    status = S.import_status(
        F.col("override"), F.col("old_status"), F.coalesce(F.col("_tracked"), F.lit(False)), F.col("_pymupdf"), F.col("_grobid"), F.col("parser")
    )
    return joined.select(
        "doi", F.col("parser").alias("parser_used"), "override", "skipped",
        F.when(takes_abstract, F.col("new_abstract")).alias("abstract"),
        F.when(takes_text, F.col("new_text")).alias("full_text"),
        F.when(takes_sections, sections_json(F.col("sections"))).alias("full_text_sections"),
        F.when(live, status).alias("parsing_status"), (live & F.coalesce(F.col("_chosen.unreadable"), F.lit(False))).alias("unreadable"),
    )


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("json_updates"),
        F.count_if("skipped").alias("skipped_already_complete"),
        F.count("abstract").alias("abstract_updated"),
        F.count("full_text").alias("sections_updated"),
        F.count("parsing_status").alias("status_from_jsons"),
        F.count_if("unreadable").alias("errors"),
    ]


def import_counters(changes: DataFrame) -> DataFrame:
    """One row of import counters; ``sections_updated`` counts full-text updates, ``errors`` files in use that hold no JSON."""
    return changes.agg(*_counters())


def write_import(changes: DataFrame, path: str) -> dict[str, int]:
    """Write the changes of an import and return its counters, observed while they are written."""
    seen = Observation()
    changes.observe(seen, *_counters()).write.mode("errorifexists").parquet(path)
    return seen.get


def legacy_import_changes(papers: DataFrame, bodies: DataFrame, log: DataFrame, keys: DataFrame) -> DataFrame:
    """Older rule for listed DOIs: fill blanks only, always rewrite the status from the log.

    ``log(doi, result)`` is the latest result per DOI.
    """
    choice = choose_parser(bodies.select("stem", "parser", F.lit(True).alias("has_body")), legacy=True)
    targets = (
        keyed(papers)
        .groupBy("doi")
        .agg(F.max(has_text(F.col("abstract"))).alias("has_abstract"), F.max(has_text(F.col("full_text_sections"))).alias("has_sections"))
        .join(keys.select("doi").distinct(), "doi", "left_semi")
        .withColumn("stem", stem_of(F.col("doi")))
        .join(choice.select("stem", "parser"), "stem")
    )
    content = parsed_sections(
        bodies.select("stem", "parser", "body").join(targets.select("stem", "parser").distinct(), ["stem", "parser"], "left_semi")
    ).select("stem", "parser", F.col("abstract").alias("new_abstract"), "sections")
    joined = targets.join(content, ["stem", "parser"], "left").join(log.select("doi", "result"), "doi", "left")
    label = S.parser_label(F.col("parser"))
    return joined.select(
        "doi",
        F.when(~F.col("has_abstract") & has_text_sql(F.col("new_abstract")), F.col("new_abstract")).alias("abstract"),
        F.when(~F.col("has_sections"), sections_json(F.col("sections"))).alias("full_text_sections"),
        F.when(has_text_sql(F.col("result")), F.concat(F.col("result"), F.lit(" (parser: "), label, F.lit(")")))
        .otherwise(F.concat(F.lit("parser: "), label))
        .alias("parsing_status"),
    )


def loaded_content(bodies: DataFrame) -> DataFrame:
    """Loader's content per stem: first parser with sections that hold text, structured first.

    The abstract is the first one found on the way, so it may come from the structured
    file while the sections come from the fast one.
    """
    parsed = parsed_sections(bodies, drop_blank=True)
    sides = parsed.groupBy("stem").agg(
        *[
            F.max_by(F.struct(F.when(has_text(F.col("abstract")), F.col("abstract")).alias("a"), F.col("sections").alias("s")), F.when(F.col("parser") == p, 1)).alias(p)
            for p in PARSERS
        ]
    )
    structured, fast = F.col("grobid"), F.col("pymupdf")
    use_structured = structured["s"].isNotNull()
    return sides.select(
        "stem",
        F.when(use_structured, structured["a"]).otherwise(F.coalesce(structured["a"], fast["a"])).alias("abstract"),
        F.coalesce(structured["s"], fast["s"]).alias("sections"),
        F.when(use_structured, "success (parser: grobid)").when(fast["s"].isNotNull(), "success (parser: pymupdf)").alias("parsing_status"),
    )


def loader_changes(keys: DataFrame, bodies: DataFrame) -> DataFrame:
    """Overwrites for listed DOIs; a DOI without usable sections is left alone."""
    wanted = keys.select("doi", stem_of(F.col("doi")).alias("stem")).distinct()
    needed = bodies.join(wanted.select("stem").distinct(), "stem", "left_semi")
    return (
        wanted.join(loaded_content(needed).filter(F.col("sections").isNotNull()), "stem")
        .select("doi", "abstract", sections_json(F.col("sections")).alias("full_text_sections"), "parsing_status")
    )


def fetched_changes(papers: DataFrame, fetched: DataFrame) -> DataFrame:
    """One change per ``pmid``: only columns that were missing; sections only with text.

    ``fetched(pmid, abstract, full_text, full_text_sections)``. Papers that share a ``pmid`` are
    changed alike, in what any of them lacks; of several fetched rows the fullest wins.
    """
    narrow = (
        papers.filter(has_text_sql(F.col("pmid")))
        .filter(missing_text() | missing_abstract())
        .groupBy("pmid")
        .agg(F.max(missing_abstract()).alias("no_abstract"), F.max(missing_text()).alias("no_text"))
    )
    parts = [null_if_empty(F.col(c)).alias(c) for c in ("full_text", "abstract", "full_text_sections")]
    new = fetched.groupBy("pmid").agg(F.max(F.struct(*[p.isNotNull() for p in parts], *parts)).alias("f")).select("pmid", "f.full_text", "f.abstract", "f.full_text_sections")
    takes_text = F.col("no_text") & F.col("full_text").isNotNull()
    rows = narrow.join(new, "pmid").select(
        "pmid",
        F.when(F.col("no_abstract"), F.col("abstract")).alias("abstract"),
        F.when(takes_text, F.col("full_text")).alias("full_text"),
        F.when(takes_text, F.col("full_text_sections")).alias("full_text_sections"),
    )
    return rows.filter("abstract IS NOT NULL OR full_text IS NOT NULL")


def oa_url_changes(papers: DataFrame, found: DataFrame) -> DataFrame:
    """New URL per DOI. ``found(doi, oa_url)`` holds what a provider returned."""
    urls = found.filter(has_text_sql(F.col("oa_url"))).groupBy("doi").agg(F.min("oa_url").alias("oa_url"))
    return keyed(papers).select("doi").distinct().join(urls, "doi")


def complete_changes(papers: DataFrame, lists: DataFrame) -> DataFrame:
    """Papers no list asks for and without a status are marked as populated."""
    return (
        keyed(papers)
        .filter(without_status())
        .select("doi")
        .distinct()
        .join(lists.select("doi").distinct(), "doi", "left_anti")
        .withColumn("parsing_status", F.lit(S.ALREADY_POPULATED))
    )


def log_changes(papers: DataFrame, log: DataFrame) -> DataFrame:
    """Status of papers without one, from the latest log entry ``log(doi, result, parser)``."""
    entries = log.select("doi", "result", "parser", F.lit(True).alias("_hit"))
    status = F.when(F.col("_hit"), S.log_status(F.col("result"), F.col("parser"))).otherwise(S.NOT_IN_LOGS)
    return keyed(papers).filter(without_status()).select("doi").distinct().join(entries, "doi", "left").select(
        "doi", status.alias("parsing_status")
    )


def mark_without_doi(papers: DataFrame) -> DataFrame:
    """Papers with neither a DOI nor a status get a fixed status; a projection, no shuffle."""
    unmarked = is_blank_sql(F.col("doi")) & without_status()
    return papers.withColumn("parsing_status", F.when(unmarked, S.NO_DOI).otherwise(F.col("parsing_status")))


def apply_changes(papers: DataFrame, changes: DataFrame, key: str = "doi") -> DataFrame:
    """Paper table with the set columns replaced.

    Papers without a key get one of their own, so they do not meet on one task. A changes
    frame that turns out small is broadcast by Spark, and then the wide table is not
    shuffled at all. Of changes that repeat a key the greatest, column by column from the first, is taken as a
    whole, so no paper is multiplied and no two versions are mixed.
    """
    columns = [c for c in changes.columns if c in CONTENT + ("oa_url",)]
    one = changes.groupBy(key).agg(F.max(F.struct(*columns)).alias("_one"))
    new = one.select(F.col(key).alias("_key"), *[F.col(f"_one.{c}").alias(f"_new_{c}") for c in columns])
    row_key = F.xxhash64(*papers.columns)
    joined = papers.withColumn("_key", spread_key(F.col(key), row_key)).join(new, "_key", "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in papers.columns]
    )


def update_all(papers: DataFrame, bodies: DataFrame, ledger: DataFrame, lists: DataFrame, log: DataFrame) -> DataFrame:
    """The combined update in its fixed order: import, complete, logs, no-DOI.

    The later steps only concern papers without a status, so their outcome is known from
    the paper's old status and the import's. All changes meet in one frame, and the wide
    table is joined once, however many steps there are.
    """
    imported = import_changes(papers, bodies, ledger).select("doi", *CONTENT)
    asked = lists.select("doi").distinct().withColumn("_asked", F.lit(True))
    entries = log.select("doi", "result", "parser", F.lit(True).alias("_hit"))
    unset = keyed(papers).filter(without_status()).select("doi").distinct().withColumn("_unset", F.lit(True))
    status = (
        F.when(F.col("parsing_status").isNotNull() | F.col("_unset").isNull(), F.col("parsing_status"))
        .when(F.col("_asked").isNull(), S.ALREADY_POPULATED)
        .when(F.col("_hit"), S.log_status(F.col("result"), F.col("parser")))
        .otherwise(S.NOT_IN_LOGS)
    )
    changes = (
        imported.join(unset, "doi", "full_outer")
        .join(asked, "doi", "left")
        .join(entries, "doi", "left")
        .withColumn("parsing_status", status)
        .select("doi", *CONTENT)
    )
    return mark_without_doi(apply_changes(papers, changes))


def latest_log_entry(log: DataFrame) -> DataFrame:
    """Newest entry per DOI; of equal stamps the one read first stays.

    A grouping with ``max_by`` instead of a window: each task keeps one row per DOI.
    """
    order = F.struct(F.col("ts"), -F.col("file_ord"), -F.col("pos"))
    return log.groupBy("doi").agg(F.max_by(F.struct("result", "parser", "ts"), order).alias("e")).select(
        "doi", "e.result", "e.parser", "e.ts"
    )


