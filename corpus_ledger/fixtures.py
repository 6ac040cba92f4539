"""The ledger's relations, derived from the driver tables.

Each view is one SQL text that both engines run unchanged: Spark reads it over the
parquet tables, and the oracle inlines it as a CTE. Bodies of extracted documents
(JSON, TEI, PDF bytes, layout spans) are built by Spark from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identifiers as I

# Every fourth DOI holds an underscore, so its file stem cannot be turned back.
DOI = "concat('10.', CAST(1000 + doc_id % 9000 AS STRING), '/', source, CASE WHEN doc_id % 4 = 1 THEN '_' ELSE '.' END, CAST(doc_id AS STRING))"
STEM = f"replace({DOI}, '/', '_')"

VIEWS: dict[str, str] = {}

VIEWS["papers"] = f"""
SELECT CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN CAST(doc_id - 1 AS STRING) ELSE CAST(doc_id AS STRING) END AS pmid,
 CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '' ELSE {DOI} END AS doi,
 split_part(text, chr(10), 1) AS title,
 CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE text END AS abstract,
 CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '   ' ELSE text END AS full_text,
 CASE WHEN doc_id % 3 = 0 OR doc_id % 13 = 0 THEN NULL ELSE text END AS full_text_sections,
 CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 6 = 1 THEN ''
      WHEN doc_id % 6 = 2 THEN concat('https://doi.org/', {DOI})
      ELSE concat('https://repo.example.org/', CAST(doc_id AS STRING), '.pdf') END AS oa_url,
 CAST(2015 + doc_id % 10 AS STRING) AS year,
 CASE doc_id % 8 WHEN 0 THEN 'success (parser: grobid)' WHEN 1 THEN 'success (parser: PyMuPDF)'
      WHEN 2 THEN 'processing_failed (parser: grobid)' WHEN 3 THEN 'not_found' WHEN 4 THEN NULL
      WHEN 5 THEN '' WHEN 6 THEN 'download_failed' ELSE 'parser: PyMuPDF' END AS parsing_status
FROM {{documents}}"""

VIEWS["evaluations"] = f"""
SELECT d.doi_key AS doi,
 CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'valid' WHEN l.quality = 1 THEN 'doubted' ELSE 'not_valid' END AS result,
 CASE WHEN l.doc_id % 4 = 0 THEN NULL ELSE l.doc_id % 11 END AS confidence_score
FROM {{labels}} l JOIN (SELECT doc_id, {DOI} AS doi_key FROM {{documents}}) d ON l.doc_id = d.doc_id"""

VIEWS["ledger_events"] = f"""
SELECT e.event_id AS id, d.doi_key AS doi,
 CASE e.event_type WHEN 'view' THEN 'download' WHEN 'click' THEN 'pymupdf' WHEN 'purchase' THEN 'grobid'
      WHEN 'signup' THEN 'retry_increment' ELSE CASE WHEN e.event_id % 40 = 0 THEN 'reset' ELSE 'error' END END AS event_type,
 CASE e.event_type
      WHEN 'view' THEN CASE WHEN e.event_id % 3 = 0 THEN 'scihub' WHEN e.event_id % 3 = 1 THEN 'oa' ELSE 'unknown_source' END
      WHEN 'click' THEN CASE WHEN e.event_id % 4 = 0 THEN 'failed' ELSE 'success' END
      WHEN 'purchase' THEN CASE WHEN e.event_id % 5 = 0 THEN 'failed' ELSE 'success' END ELSE NULL END AS status_to,
 CASE WHEN e.event_type = 'error' THEN e.props END AS message,
 e.ts AS created_at
FROM {{events}} e JOIN (SELECT doc_id, {DOI} AS doi_key FROM {{documents}}) d ON e.user_id = d.doc_id"""

# Events of every kind the ledger knows: availability, attempts and downloads of the open sources,
# downloads by outcome, plain column updates (one column and value each), and resets.
VIEWS["source_events"] = f"""
SELECT e.event_id AS id, d.doi_key AS doi,
 CASE e.event_id % 13 WHEN 0 THEN 'scihub_available' WHEN 1 THEN 'oa_available' WHEN 2 THEN 'arxiv_attempted' WHEN 3 THEN 'arxiv_download'
  WHEN 4 THEN 'biorxiv_attempted' WHEN 5 THEN 'biorxiv_download' WHEN 6 THEN 'europepmc_attempted' WHEN 7 THEN 'europepmc_download'
  WHEN 8 THEN 'unpaywall_attempted' WHEN 9 THEN 'unpaywall_download' WHEN 10 THEN 'download' WHEN 11 THEN 'update'
  ELSE CASE WHEN e.event_id % 5 = 0 THEN 'reset' ELSE 'retry_increment' END END AS event_type,
 CASE WHEN e.event_id % 13 < 2 THEN CASE WHEN e.event_id % 2 = 0 THEN 'yes' ELSE 'no' END
  WHEN e.event_id % 13 IN (3, 5, 7, 9) THEN CASE WHEN e.event_id % 4 = 0 THEN 'success' ELSE 'failed' END
  WHEN e.event_id % 13 = 10 THEN CASE e.event_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'oa' ELSE 'scihub' END END AS status_to,
 CASE WHEN e.event_id % 13 = 11 THEN CASE e.event_id % 3 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'grobid_status' ELSE 'has_content_in_db' END END AS upd_column,
 CASE WHEN e.event_id % 13 = 11 THEN concat('v', CAST(e.event_id % 7 AS STRING)) END AS upd_value,
 e.ts AS created_at
FROM {{events}} e JOIN (SELECT doc_id, {DOI} AS doi_key FROM {{documents}}) d ON e.user_id = d.doc_id"""

VIEWS["tracker"] = f"""
SELECT {DOI} AS doi,
 CASE doc_id % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN 'unknown' ELSE NULL END AS scihub_available,
 CASE n_chars % 3 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' ELSE NULL END AS scihub_downloaded,
 CASE doc_id % 3 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' ELSE NULL END AS oa_available,
 CASE n_chars % 5 WHEN 0 THEN 'yes' WHEN 1 THEN NULL ELSE 'no' END AS oa_downloaded,
 CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'yes' END AS arxiv_attempted,
 CASE WHEN doc_id % 5 = 0 THEN NULL WHEN n_chars % 6 = 0 THEN 'yes' ELSE 'no' END AS arxiv_downloaded,
 CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'yes' END AS biorxiv_attempted,
 CASE WHEN doc_id % 7 = 0 THEN NULL WHEN n_chars % 8 = 0 THEN 'yes' ELSE 'no' END AS biorxiv_downloaded,
 CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 'yes' END AS europepmc_attempted,
 CASE WHEN doc_id % 9 = 0 THEN NULL WHEN n_chars % 10 = 0 THEN 'yes' ELSE 'no' END AS europepmc_downloaded,
 CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 'yes' END AS unpaywall_attempted,
 CASE WHEN doc_id % 11 = 0 THEN NULL WHEN n_chars % 12 = 0 THEN 'yes' ELSE 'no' END AS unpaywall_downloaded,
 CASE n_chars % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN 'unknown' ELSE NULL END AS downloaded,
 CAST(NULL AS TIMESTAMP) AS download_date,
 CASE WHEN n_chars % 4 = 1 THEN 'scihub' END AS download_source,
 CASE WHEN doc_id % 2 = 0 THEN 'yes' ELSE 'no' END AS has_content_in_db,
 CASE n_chars % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'not_attempted' WHEN 3 THEN 'in_progress' ELSE NULL END AS pymupdf_status,
 CAST(NULL AS TIMESTAMP) AS pymupdf_date,
 CASE doc_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'success' WHEN 2 THEN 'not_attempted' ELSE NULL END AS grobid_status,
 CAST(NULL AS TIMESTAMP) AS grobid_date,
 CAST(NULL AS STRING) AS error_msg,
 CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS last_updated,
 CAST(doc_id % 4 AS INT) AS retry_count
FROM {{documents}} WHERE source <> 'src7'"""

# Presence and state of the two extractions of a document; the body itself is built per engine.
VIEWS["extractions"] = f"""
SELECT doc_id, {STEM} AS stem, parser, state, lang, n_chars, text FROM (
 SELECT *, 'grobid' AS parser,
  CASE WHEN n_chars % 13 = 0 THEN 'broken' WHEN n_chars % 11 = 0 THEN 'empty' WHEN n_chars % 7 = 0 THEN 'untitled' ELSE 'ok' END AS state
 FROM {{documents}} WHERE lang <> 'fr'
 UNION ALL
 SELECT *, 'pymupdf' AS parser,
  CASE WHEN n_chars % 17 = 0 THEN 'broken' WHEN n_chars % 5 = 0 THEN 'empty' ELSE 'ok' END AS state
 FROM {{documents}} WHERE source NOT IN ('src3', 'src11')) x"""

VIEWS["pdfs"] = f"""
SELECT 'papers' AS dir, {STEM} AS stem, CAST(n_chars * 10 AS BIGINT) AS length, CAST(1704067200 + doc_id AS BIGINT) AS mtime_s
FROM {{documents}} WHERE lang <> 'de'
UNION ALL
SELECT 'pdfs' AS dir, {STEM} AS stem, CAST(n_chars * 10 + n_chars % 2 AS BIGINT) AS length, CAST(1704067200 + 2 * doc_id AS BIGINT) AS mtime_s
FROM {{documents}} WHERE lang IN ('en', 'de')"""

# A raw identifier list: prefixes, junk, article paths and repeats, as users supply them.
VIEWS["id_list"] = f"""
SELECT doc_id AS pos,
 CASE doc_id % 12
  WHEN 0 THEN concat('https://doi.org/', {DOI})
  WHEN 1 THEN concat('DOI: ', {DOI})
  WHEN 2 THEN concat('  ', {DOI}, '  ')
  WHEN 3 THEN concat('http://dx.doi.org/', {DOI}, '?x=', source, '.')
  WHEN 4 THEN concat('https://doi.org/doi:', {DOI})
  WHEN 5 THEN concat('/j/', source, '/ab-', CAST(doc_id AS STRING), '/ab-', CAST(doc_id AS STRING), '.xml')
  WHEN 6 THEN concat(CAST(doc_id % 95 AS STRING), '/4/', CAST(n_chars AS STRING))
  WHEN 7 THEN CAST(100000 + n_chars AS STRING)
  WHEN 8 THEN concat('PMID: ', CAST(n_chars * 37 AS STRING))
  WHEN 9 THEN concat('10.', CAST(1000 + doc_id AS STRING))
  WHEN 10 THEN concat(split_part(text, chr(10), 1), chr(10), ' x')
  ELSE {DOI} END AS identifier
FROM {{documents}}"""

# Retrieval attempts per source, as the waterfall would record them.
VIEWS["attempts"] = f"""
SELECT d.doi_key AS doi,
 CASE e.event_id % 11 WHEN 0 THEN 'oa_sciencedirect' WHEN 1 THEN 'oa_direct' WHEN 2 THEN 'openalex_sciencedirect'
  WHEN 3 THEN 'openalex' WHEN 4 THEN 'arxiv' WHEN 5 THEN 'biorxiv' WHEN 6 THEN 'europepmc' WHEN 7 THEN 'unpaywall'
  WHEN 8 THEN 'semanticscholar' WHEN 9 THEN 'doi_sciencedirect' ELSE 'doi_content_neg' END AS source,
 (e.event_type = 'purchase' AND e.event_id % 7 = 0) AS ok
FROM {{events}} e JOIN (SELECT doc_id, {DOI} AS doi_key FROM {{documents}}) d ON e.user_id = d.doc_id"""

# Two run logs; whole-hour stamps make ties common.
VIEWS["run_log"] = f"""
SELECT d.doi_key AS doi, concat(substr(CAST(e.ts AS STRING), 1, 13), ':00:00') AS ts,
 CASE e.event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'processing_failed' WHEN 'purchase' THEN 'success' ELSE 'not_found' END AS result,
 CASE e.event_type WHEN 'view' THEN 'PyMuPDF' WHEN 'purchase' THEN 'grobid' END AS parser,
 CAST(e.event_id % 2 AS INT) AS file_ord, e.event_id AS pos
FROM {{events}} e JOIN (SELECT doc_id, {DOI} AS doi_key FROM {{documents}}) d ON e.user_id = d.doc_id"""

# Results of one run over the paper list.
VIEWS["run_results"] = f"""
SELECT {DOI} AS identifier,
 CASE doc_id % 9 WHEN 0 THEN 'success' WHEN 1 THEN 'not_found' WHEN 2 THEN 'processing_failed' WHEN 3 THEN 'skipped_complete'
  WHEN 4 THEN 'skipped_failed' WHEN 5 THEN 'invalid_identifier' ELSE 'success' END AS status,
 CASE WHEN n_chars % 3 = 0 THEN 'structured' WHEN n_chars % 3 = 1 THEN 'simple' ELSE 'full' END AS mode,
 CAST(n_chars AS DOUBLE) / 64 AS seconds
FROM {{documents}}"""

TABLES = ("documents", "labels", "events", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def oracle(*names: str, sql: str) -> str:
    """``sql`` with the named views in front as CTEs."""
    plain = {t: t for t in TABLES}
    head = ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in names)
    body = sql.strip()
    if not head:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def with_doi(files: str, *known: str) -> str:
    """SQL: rows of ``files`` with ``doi``: the known DOI that has the stem, else the stem turned back."""
    dois = " UNION ".join(f"SELECT doi FROM {k} WHERE doi IS NOT NULL AND doi <> ''" for k in known)
    return f"(SELECT f0.*, coalesce(k0.doi, replace(f0.stem, '_', '/')) AS doi FROM {files} f0 LEFT JOIN ({dois}) k0 ON replace(k0.doi, '/', '_') = f0.stem)"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def first_line(text: Column) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def bodies(extractions: DataFrame) -> DataFrame:
    """``(stem, parser, length, body)`` of the JSON each parser would have written."""
    text, ok = F.col("text"), F.col("state") != "empty"
    lines = F.when(ok, lines_of(text)).otherwise(F.array().cast("array<string>"))
    doi = I.doi_of_stem(F.col("stem"))

    def title_of(i: Column) -> Column:
        return F.concat(F.lit("S"), (i % 4).cast("string"))

    structured = F.to_json(
        F.struct(
            F.struct(
                doi.alias("doi"),
                F.when(F.col("state") == "untitled", "none")
                .otherwise(first_line(text))
                .alias("title"),
                F.when(F.col("n_chars") % 3 != 0, text).alias("abstract"),
                F.array().cast("array<struct<name:string>>").alias("authors"),
            ).alias("metadata"),
            F.struct(
                F.transform(lines, lambda x, i: F.struct(title_of(i).alias("title"), x.alias("content"))).alias("body"),
                F.array().cast("array<struct<raw:string>>").alias("references"),
            ).alias("full_text"),
            F.lit("grobid").alias("extraction_method"),
        )
    )
    fast = F.to_json(
        F.struct(
            F.concat(F.col("stem"), F.lit(".pdf")).alias("file"),
            F.lit("structured").alias("mode"),
            F.struct(doi.alias("doi")).alias("metadata"),
            F.struct(
                F.transform(
                    lines, lambda x, i: F.struct(title_of(i).alias("title"), F.array(x).alias("content"))
                ).alias("sections"),
                F.array().cast("array<string>").alias("references"),
                F.when(ok, text).otherwise(F.lit("")).alias("full_text"),
                F.lit(1).alias("page_count"),
            ).alias("structured_text"),
        )
    )
    body = F.when(F.col("parser") == "grobid", structured).otherwise(fast)
    return (
        extractions.withColumn("_body", body)
        .withColumn(
            "body",
            F.when(F.col("state") == "broken", F.substring("_body", F.lit(1), F.floor(F.length("_body") / 2).cast("int")))
            .otherwise(F.col("_body")),
        )
        .select("stem", "parser", F.octet_length("body").cast("long").alias("length"), "body")
    )


def extraction_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bodies(view(spark, sf_dir, "extractions"))


def layout_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout rows: a text line is a block; its first word is a span of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("n", "row"))
    words = F.split(F.col("row"), " ", 2)
    size = F.when(F.size(F.split(F.col("row"), " ")) < 6, 16.0).otherwise(10.0)
    parts = docs.select("doc_id", "n", F.posexplode(words).alias("span", "text"), size.alias("size"))
    return parts.select(
        "doc_id",
        F.floor(F.col("n") / 4).cast("int").alias("page"),
        (F.col("n") % 4).cast("int").alias("block"),
        F.col("span").alias("line"),
        F.lit(0).alias("span"),
        "text",
        "size",
        F.when(F.col("n") % 9 == 5, 16).otherwise(0).alias("flags"),
    )


def run_log_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text of log blocks, as they stand between two markers."""
    log = view(spark, sf_dir, "run_log")
    block = F.concat(
        F.lit(" "), F.col("doi"), F.lit("\nTimestamp: "), F.col("ts"), F.lit("\nWorker: 3\nResult: "), F.col("result"),
        F.coalesce(F.concat(F.lit("\nParser: "), F.col("parser")), F.lit("")), F.lit("\n----\n"),
    )
    return log.select("file_ord", "pos", block.alias("block"))


def pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF-like bytes around each text: some with a wrong header, some with the trailer too far up."""
    head = F.when(F.col("n_chars") % 5 == 0, "%PDX-").otherwise("%PDF-")
    tail = F.when(F.col("n_chars") % 7 == 0, "").otherwise("%%EOF")
    fill = F.repeat(F.lit("x"), (F.col("n_chars") % 6000).cast("int"))
    content = F.encode(F.concat(head, F.col("text"), tail, fill), "UTF-8")
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.expr(STEM).alias("stem"), content.alias("content")).withColumn("length", F.octet_length("content").cast("long"))


def tei_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TEI markup around each text: two authors, nested emphasis, one division per line."""

    def esc(c: Column) -> Column:
        amp = F.replace(c, F.lit("&"), F.lit("&amp;"))
        lt = F.replace(amp, F.lit("<"), F.lit("&lt;"))
        clean = F.replace(lt, F.lit(">"), F.lit("&gt;"))
        return F.regexp_replace(clean, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")

    ident, text = F.col("doc_id").cast("string"), F.col("text")
    division = F.transform(
        lines_of(text),
        lambda x, i: F.concat(
            F.lit("<div>"),
            F.when(i % 3 != 0, F.concat(F.lit("<head> S"), i.cast("string"), F.lit(" </head>"))).otherwise(F.lit("")),
            F.lit("<p>"), esc(x), F.lit("</p><p>a <hi>b</hi> c</p></div>"),
        ),
    )
    refs = F.transform(
        F.sequence(F.lit(1), (F.col("n_chars") % 3 + 1).cast("int")),
        lambda k: F.when(k == 2, F.concat(F.lit("<biblStruct><note>raw "), ident, F.lit("</note></biblStruct>"))).otherwise(
            F.concat(
                F.lit("<biblStruct><analytic><title>T"), k.cast("string"),
                F.lit("</title><author><persName><forename>R</forename><surname>Q"), ident,
                F.lit('</surname></persName></author></analytic><monogr><date when="2011-05"/></monogr></biblStruct>'),
            )
        ),
    )
    tei = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title> '),
        esc(first_line(text)),
        F.lit('</title></titleStmt><sourceDesc><biblStruct><analytic><author><persName><forename>A</forename><surname>B'),
        ident,
        F.lit("</surname></persName><email>b@x.org</email><affiliation>Lab</affiliation></author>"
              '</analytic><monogr><title>J</title><imprint><biblScope unit="volume">'),
        (F.col("doc_id") % 40).cast("string"),
        F.lit('</biblScope><date when="2019-03-04"/></imprint></monogr><idno type="DOI">10.1/'), ident,
        F.lit("</idno></biblStruct></sourceDesc></fileDesc><profileDesc><textClass><keywords><term>k1</term><term> </term>"
              "</keywords></textClass><abstract><p> one </p><p>two</p></abstract></profileDesc></teiHeader><text><body>"),
        F.array_join(division, ""),
        F.lit("</body><back><listBibl>"), F.array_join(refs, ""), F.lit("</listBibl></back></text>"),
        F.when(F.col("n_chars") % 19 == 0, F.lit("")).otherwise(F.lit("</TEI>")),
    )
    return table(spark, sf_dir, "documents").select("doc_id", tei.alias("tei"))
