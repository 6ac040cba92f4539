"""Layout rows and parsed JSON into sections, full text and references."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.stages import once
from ..functions.text import has_fewer_words, has_text, null_if_empty, strip
from ..schemas import SECTIONS

# Layout rules and default titles.
FONT_SAMPLE_PAGES = 5
DEFAULT_FONT_SIZE = 12.0
BOLD_FLAG = 16
LARGER_BY = 1.2
HEADING_MAX_WORDS = 15
FIRST_TITLE = "Introduction"
NO_TITLE = "Unnamed Section"
FALLBACK_TITLE = "Full Text (Fallback Extraction)"
FALLBACK_METHOD = "fallback_pypdf"
BLOCK_SEP = "\n\n"
# Headers of a reference list, looked for in this order, and entry marks.
REFERENCE_HEADERS = ["REFERENCES", "References", "BIBLIOGRAPHY", "Bibliography", "LITERATURE CITED"]
REFERENCE_MARK = r"\n\s*(?:\[\d+\]|\(\d+\)|\d+\.)"


def _placed(spans: DataFrame) -> DataFrame:
    """Spans with a document and a page; the others belong nowhere and count nowhere."""
    return spans.filter("doc_id IS NOT NULL AND page IS NOT NULL")


def _all_blocks(spans: DataFrame) -> DataFrame:
    """One row per block, blank ones included, with what its page adds to the font average.

    Spans are placed by (doc, page) once, and every later step on blocks keeps that
    placement: a document with a huge share of the spans is spread over its pages, and the
    two uses of the blocks below read the same shuffle.
    """
    size = F.coalesce("size", F.lit(0.0))
    # Both uses must see the same filter for Spark to see that the shuffle is the same.
    per_block = (
        _placed(spans)
        .repartition("doc_id", "page")
        .groupBy("doc_id", "page", "block")
        .agg(
            F.sort_array(F.collect_list(F.struct("line", "span", F.coalesce("text", F.lit("")).alias("text")))).alias("parts"),
            F.max(size).alias("max_size"),
            F.max(F.col("flags").bitwiseAND(BOLD_FLAG) > 0).alias("is_bold"),
            F.sum(size).alias("size_sum"),
            F.count(F.lit(1)).alias("n_spans"),
        )
    )
    text = F.array_join(
        F.transform(
            F.col("parts"),
            lambda x, i: F.when(
                (i > 0) & (F.get(F.col("parts"), i - 1)["line"] != x["line"]), F.concat(F.lit(" "), x["text"])
            ).otherwise(x["text"]),
        ),
        "",
    )
    is_short = (F.col("text") != "") & has_fewer_words(F.col("text"), HEADING_MAX_WORDS)
    return once(per_block, {"text": strip(text)}).drop("parts").withColumn("is_short", is_short)


def _pages(blocks: DataFrame) -> DataFrame:
    """Per page: the document's mean font size, and the headings on earlier pages.

    A page is reduced to a few numbers before the shuffle by document. The headings of a
    page are known once the mean is: bold short blocks, and short blocks clearly larger
    than the mean, of which the page row has a count for each size.
    """
    may_head = F.col("is_short") & ~F.col("is_bold")
    by_size = blocks.groupBy("doc_id", "page", F.when(may_head, F.col("max_size")).alias("size")).agg(
        F.sum("size_sum").alias("size_sum"), F.sum("n_spans").alias("n_spans"),
        F.count_if(F.col("is_short") & F.col("is_bold")).alias("bold_heads"), F.count(F.lit(1)).alias("n"),
    )
    page = by_size.groupBy("doc_id", "page").agg(
        F.sum("size_sum").alias("size_sum"), F.sum("n_spans").alias("n_spans"), F.sum("bold_heads").alias("bold_heads"),
        F.collect_list(F.when(F.col("size").isNotNull(), F.struct("size", "n"))).alias("sizes"),
    )
    doc = Window.partitionBy("doc_id")
    earlier = doc.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)

    def first_pages(column: str) -> Column:
        return F.sum(F.when(F.col("page") < FONT_SAMPLE_PAGES, F.col(column))).over(doc)

    mean = F.coalesce(F.try_divide(first_pages("size_sum"), first_pages("n_spans")), F.lit(DEFAULT_FONT_SIZE))
    large = F.aggregate(F.filter("sizes", lambda x: x["size"] > F.col("avg_size") * LARGER_BY), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return (
        page.withColumns({"avg_size": mean, "page_count": F.max("page").over(doc) + 1})
        .withColumn("heads", F.col("bold_heads") + large)
        .select(
            "doc_id", "page", "avg_size", "page_count", F.coalesce(F.sum("heads").over(earlier), F.lit(0)).alias("heads_before")
        )
    )


def average_font(spans: DataFrame) -> DataFrame:
    """Mean span size over the first pages of each document; a default where there is none."""
    early = F.when(F.col("page") < FONT_SAMPLE_PAGES, F.coalesce("size", F.lit(0.0)))
    return _placed(spans).groupBy("doc_id").agg(F.coalesce(F.avg(early), F.lit(DEFAULT_FONT_SIZE)).alias("avg_size"))


def _headed_blocks(spans: DataFrame) -> DataFrame:
    blocks = _all_blocks(spans)
    stands_out = F.col("is_bold") | (F.col("max_size") > F.col("avg_size") * LARGER_BY)
    return (
        blocks.filter("text <> ''")
        .join(_pages(blocks), ["doc_id", "page"])
        .withColumn("is_heading", F.col("is_short") & stands_out)
    )


def with_headings(spans: DataFrame) -> DataFrame:
    """Blocks with ``is_heading``: bold or clearly larger than average, and short."""
    return _headed_blocks(spans).select("doc_id", "page", "block", "text", "is_heading")


def section_blocks(spans: DataFrame) -> DataFrame:
    """Blocks with the number of the section they are in; 0 is the text before any heading.

    The number is the count of headings so far: those of earlier pages, and those of the
    own page up to the block, a window no larger than a page.
    """
    on_page = Window.partitionBy("doc_id", "page").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = F.sum(F.col("is_heading").cast("int")).over(on_page)
    return (
        _headed_blocks(spans)
        .withColumn("section", F.col("heads_before") + so_far)
        .select("doc_id", "section", "page", "block", "text", "is_heading")
    )


def sections(spans: DataFrame) -> DataFrame:
    """One row per section: title and its blocks in order."""
    return _sections_of(section_blocks(spans)).select(
        "doc_id", "section", F.coalesce("heading", F.lit(FIRST_TITLE)).alias("title"), "content"
    )


def _sections_of(rows: DataFrame) -> DataFrame:
    parts = F.collect_list(F.when(~F.col("is_heading"), F.struct("page", "block", "text")))
    return (
        rows.groupBy("doc_id", "section")
        .agg(F.max(F.when(F.col("is_heading"), F.col("text"))).alias("heading"), F.sort_array(parts).alias("parts"))
        .select("doc_id", "section", "heading", F.col("parts.text").alias("content"))
    )


def full_texts(spans: DataFrame) -> DataFrame:
    """Full text of each document (blocks joined by a blank line) and its page count."""
    # A page is joined where its spans already are; one string per page moves to its document.
    blocks = F.collect_list(F.when(F.col("text") != "", F.struct("block", "text")))
    pages = _all_blocks(spans).groupBy("doc_id", "page").agg(F.sort_array(blocks).alias("blocks"))
    joined = pages.select("doc_id", "page", F.when(F.size("blocks") > 0, F.array_join(F.col("blocks.text"), BLOCK_SEP)).alias("text"))
    parts = F.collect_list(F.when(F.col("text").isNotNull(), F.struct("page", "text")))
    return (
        joined.groupBy("doc_id")
        .agg(F.sort_array(parts).alias("parts"), (F.max("page") + 1).alias("page_count"))
        .select("doc_id", F.array_join(F.col("parts.text"), BLOCK_SEP).alias("full_text"), "page_count")
    )


def scanned_documents(spans: DataFrame) -> DataFrame:
    """Documents whose first pages hold no text at all."""
    early = F.col("page") < FONT_SAMPLE_PAGES
    return _placed(spans).groupBy("doc_id").agg(
        (F.count_if(early & has_text(F.col("text"))) == 0).alias("is_scanned")
    )


def references_of(text: Column) -> Column:
    """Entries after the first matching reference header; headers are tried in fixed order."""
    rest = F.lit(None).cast("string")
    for header in reversed(REFERENCE_HEADERS):
        pattern = rf"(?U)\n\s*{header}\s*\n"
        tail = F.regexp_extract(text, rf"(?Us)\n\s*{header}\s*\n(.*)$", 1)
        rest = F.when(text.rlike(pattern), tail).otherwise(rest)
    entries = F.transform(F.split(rest, "(?U)" + REFERENCE_MARK), strip)
    return F.coalesce(F.filter(entries, lambda e: e != ""), F.array().cast("array<string>"))


def structured_documents(spans: DataFrame, mode: str = "structured") -> DataFrame:
    """Columns of one extraction mode: ``simple`` text, or ``structured``/``full`` sections and references.

    The full text of a document is its sections read in order, so blocks are assembled once.
    """
    if mode == "simple":
        return full_texts(spans).select("doc_id", F.lit(mode).alias("mode"), F.col("full_text").alias("text"))
    if mode not in ("structured", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    listed = (
        _sections_of(section_blocks(spans))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("section", "heading", "content"))).alias("s"))
    )
    texts = F.flatten(
        F.transform("s", lambda x: F.when(x["heading"].isNull(), x["content"]).otherwise(F.concat(F.array(x["heading"]), x["content"])))
    )
    shaped = F.transform(
        "s", lambda x: F.struct(F.coalesce(x["heading"], F.lit(FIRST_TITLE)).alias("title"), x["content"].alias("content"))
    )
    counts = _placed(spans).groupBy("doc_id").agg((F.max("page") + 1).alias("page_count"))
    joined = once(
        counts.join(listed, "doc_id", "left"),
        {
            "sections": F.coalesce(shaped, F.array().cast("array<struct<title:string,content:array<string>>>")),
            "full_text": F.coalesce(F.array_join(texts, BLOCK_SEP), F.lit("")),
        },
    )
    return joined.select(
        "doc_id", F.lit(mode).alias("mode"),
        F.struct("sections", references_of(F.col("full_text")).alias("references"), "full_text", "page_count").alias("structured_text"),
    )


def keywords_of(keywords: Column) -> Column:
    return F.coalesce(F.split(null_if_empty(keywords), ","), F.array().cast("array<string>"))


# -- parsed JSON -----------------------------------------------------------------------


def last_wins(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Merge sections of equal title: the last content at the first position.

    ``raw`` is an array of ``(pos, title, content)``. Sorting by title puts equal titles
    side by side, so one pass over neighbours finds each first position and last content
    without a shuffle, whatever the number of sections.
    """
    by_title = F.transform(raw, lambda x: F.struct(x["title"].alias("t"), x["pos"].alias("p"), x["content"].alias("c")))
    sorted_by_title = once(df, {"_s": F.array_sort(by_title)})

    def neighbour(step: int):
        return lambda x, i: F.get(F.col("_s"), i + step)["t"].eqNullSafe(x["t"])

    firsts = F.filter("_s", lambda x, i: (i == 0) | ~neighbour(-1)(x, i))
    lasts = F.filter("_s", lambda x, i: (i == F.array_size(F.col("_s")) - 1) | ~neighbour(1)(x, i))
    merged = once(sorted_by_title, {"_f": firsts, "_l": lasts}).withColumn(
        out,
        F.transform(
            F.array_sort(
                F.transform("_f", lambda x, i: F.struct(x["p"].alias("p"), x["t"].alias("t"), F.get(F.col("_l"), i)["c"].alias("c")))
            ),
            lambda x, i: F.struct(i.alias("pos"), x["t"].alias("title"), x["c"].alias("content")),
        ).cast(SECTIONS),
    )
    return merged.drop("_s", "_f", "_l")


def parsed_sections(bodies: DataFrame, drop_blank: bool = False) -> DataFrame:
    """Abstract and merged sections per extraction ``(stem, parser, body)``; NULL when there are none.

    A document of the wrong shape gives neither. ``drop_blank`` is the loader's variant:
    sections without text are left out first, a fast extraction may bring a top-level
    abstract, and an abstract is kept whatever the shape of the sections.
    """
    doc, is_fast = F.col("_doc"), F.col("parser") == "pymupdf"
    staged = once(bodies, {"_doc": V.parse(F.col("body"))}).withColumns(
        {
            "_holder": F.when(is_fast, V.at(doc, "$.structured_text")).otherwise(V.at(doc, "$.full_text")),
            "_listed": F.when(is_fast, V.at(doc, "$.structured_text.sections")).otherwise(V.at(doc, "$.full_text.body")),
        }
    )
    # One cast for the whole list; an entry that is not an object becomes NULL.
    staged = once(staged, {"_cast": F.try_variant_get("_listed", "$", "array<struct<title:string,content:variant>>")})
    well_formed = (F.col("_holder").isNull() | V.is_object(F.col("_holder"))) & (
        F.col("_listed").isNull() | F.coalesce(~F.exists("_cast", lambda s: s.isNull()), F.lit(False))
    )
    staged = staged.withColumn("_items", F.when(well_formed, F.col("_cast")))
    raw = F.transform(
        F.coalesce(F.col("_items"), F.array().cast("array<struct<title:string,content:variant>>")),
        lambda s, i: F.struct(
            i.alias("pos"),
            F.coalesce(s["title"], F.lit(NO_TITLE)).alias("title"),
            F.coalesce(V.joined_text(s["content"], BLOCK_SEP), F.lit("")).alias("content"),
        ),
    )
    staged = once(staged, {"_raw": raw})
    if drop_blank:
        staged = staged.withColumn("_raw", F.filter("_raw", lambda s: has_text(s["content"])))
    abstract = V.text_at(doc, "$.metadata.abstract")
    if not drop_blank:
        abstract = F.when(well_formed, abstract)
    top_level = V.text_at(doc, "$.abstract") if drop_blank else F.lit(None).cast("string")
    merged = last_wins(staged, "_raw", "sections").withColumn(
        "abstract", F.when(is_fast, top_level).otherwise(abstract)
    )
    keep = [c for c in bodies.columns if c != "body"]
    return once(merged, {"_sections": F.when(F.array_size("sections") > 0, F.col("sections"))}).select(
        *keep, "abstract", F.col("_sections").alias("sections"),
        doc.isNull().alias("unreadable"), (F.coalesce(F.array_size("_items"), F.lit(0)) > 0).alias("has_body"),
    )


def sections_text(sections_column: Column) -> Column:
    """``title`` line and content per section, sections apart by a blank line."""
    return F.array_join(
        F.transform(sections_column, lambda s: F.concat(s["title"], F.lit("\n"), s["content"])), BLOCK_SEP
    )


def sections_markdown(sections_column: Column) -> Column:
    return F.array_join(
        F.transform(
            sections_column,
            lambda s: F.concat(F.lit("## "), F.coalesce(s["title"], F.lit(NO_TITLE)), F.lit(BLOCK_SEP), F.coalesce(s["content"], F.lit(""))),
        ),
        BLOCK_SEP,
    )


def _json_text(c: Column) -> Column:
    """A text as a JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def sections_json(sections_column: Column) -> Column:
    """JSON object title -> content, in section order (a map would lose it)."""
    pairs = F.transform(
        sections_column, lambda s: F.concat(_json_text(s["title"]), F.lit(": "), _json_text(s["content"]))
    )
    return F.when(
        sections_column.isNotNull(), F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    )


def section_statistics(parsed: DataFrame) -> DataFrame:
    """Section count and character totals of each extraction."""
    lengths = F.transform("sections", lambda s: F.length(s["content"]).cast("long"))
    return parsed.select(
        "stem", "parser",
        F.coalesce(F.array_size("sections"), F.lit(0)).cast("long").alias("n_sections"),
        F.coalesce(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).alias("total_chars"),
        F.coalesce(F.array_max(lengths), F.lit(0)).alias("longest_section"),
    )


def with_fallback(structured: DataFrame, raw_text: DataFrame) -> DataFrame:
    """Structured sections where there are any, else the whole raw text as one section.

    ``structured(stem, abstract, sections)`` and ``raw_text(stem, text)``; a document with
    neither yields no row.
    """
    both = structured.select("stem", "abstract", "sections").join(
        raw_text.select("stem", strip(F.col("text")).alias("text")), "stem", "full_outer"
    )
    one = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit(FALLBACK_TITLE).alias("title"), F.col("text").alias("content"))
    ).cast(SECTIONS)
    has_structured = F.col("sections").isNotNull()
    return both.filter(has_structured | has_text(F.col("text"))).select(
        "stem", F.when(has_structured, F.col("abstract")).alias("abstract"),
        F.when(has_structured, F.col("sections")).otherwise(one).alias("sections"),
        F.when(has_structured, "grobid").otherwise(FALLBACK_METHOD).alias("extraction_method"),
    )


# -- batch extraction ------------------------------------------------------------------

RESULT_SCHEMA = "stem string, status string, doi string, error string, body string"


def first_files(pending: DataFrame, limit: int | None = None) -> DataFrame:
    """Pending files of the first ``limit`` stems; all of them without a limit, or with one below 1."""
    if limit is None or limit < 1:
        return pending
    # Only stems are sorted: contents stay where they are.
    return pending.join(pending.select("stem").distinct().orderBy("stem").limit(limit), "stem", "left_semi")


def run_extractor(
    pending: DataFrame, extract: Callable[[str, bytes], str | None], tasks: int | None = None, limit: int | None = None, dry_run: bool = False
) -> DataFrame:
    """Run a plug-in over pending files ``(stem, content)``: one result row per file.

    ``extract(stem, content)`` gives JSON text, or nothing when it finds none. A file that
    raises becomes an error row; it never fails the batch. Filter ``pending`` first: Spark
    cannot move a filter through Python. ``limit`` takes the files of the first stems only; a
    ``dry_run`` gives the stems that would be extracted and runs nothing.
    """
    pending = first_files(pending, limit)
    if dry_run:
        return pending.select("stem")

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for stem, content in zip(frame["stem"], frame["content"], strict=True):
                doi = stem.replace("_", "/")
                try:
                    body = extract(stem, content)
                    rows.append((stem, "success" if body else "failed", doi, None, body))
                except Exception as problem:  # noqa: BLE001 - any plug-in failure is a result
                    rows.append((stem, "error", doi, f"{type(problem).__name__}: {problem}", None))
            yield pd.DataFrame(rows, columns=["stem", "status", "doi", "error", "body"])

    source = pending.select("stem", "content")
    if tasks:
        source = source.repartition(tasks)
    return source.mapInPandas(batches, RESULT_SCHEMA)


def extraction_totals(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


