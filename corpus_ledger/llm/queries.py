"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, expansion, fingerprints, jaccard, langid, pieces, rans, runs, secrets, shards, toxicity, whitening, windows
from .tables import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(job: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


@query("op1_fingerprints")
def op1_fingerprints(spark, sf_dir):
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


BENCHMARK_WORDS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0) x),
h AS (SELECT x.doc_id, x.i, p.n, p.item_id FROM (SELECT doc_id, s.n, i, array_to_string(w[i:i + s.n - 1], ' ') AS win FROM (SELECT DISTINCT n FROM p) s, d, unnest(generate_series(1, len(w) - s.n + 1)) AS g(i)) x
 JOIN p ON x.win = p.win AND x.n = p.n),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM h) y) z GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) y GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query("op2_decontaminate", BENCHMARK_WORDS)
def op2_decontaminate(spark, sf_dir):
    return decontaminate.decontamination_report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


SHINGLE_LINKS = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
pairs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT pairs.b, r.root FROM r JOIN pairs ON pairs.a = r.doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""


@query("op3_ngram_jaccard", SHINGLE_LINKS)
def op3_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(documents(spark, sf_dir))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    return expansion.deduplicated_bytes(documents(spark, sf_dir))


WORD_WINDOWS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS win FROM d, unnest(generate_series(1, len(w) - 34)) AS g(i)),
r AS (SELECT doc_id, i FROM x WHERE win IN (SELECT win FROM x GROUP BY win HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(generate_series(i, i + 34)) AS k FROM r) y),
g AS (SELECT doc_id, list(k) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
 sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op8_window_dedup", WORD_WINDOWS)
def op8_window_dedup(spark, sf_dir):
    return windows.deduplicated_words(documents(spark, sf_dir))


@query("op9_sharding")
def op9_sharding(spark, sf_dir):
    return shards.sharded(documents(spark, sf_dir))


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file, as the machine's ``public_tokenizers`` module gives it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_rans_tokens")
def op4_rans_tokens(spark, sf_dir):
    return rans.encoded_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    return pieces.encoding_report(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    return langid.language_report(documents(spark, sf_dir))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's edit: in a tenth of the documents, told by the checksum of the id, a tail becomes periodic."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    root = words[first : first + period]
    return words[:first] + (root * ((n - first) // period + 1))[: n - first]


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    found = runs.document_runs(documents(spark, sf_dir), edit=repeated_tail).withColumn("best", runs.strongest(F.col("runs")))
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_secret_scan")
def op11_secret_scan(spark, sf_dir):
    found = secrets.secret_spans(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    names = [f"n_{kind}" for kind in secrets.KINDS]
    return found.select(
        "doc_id", *[count(k).alias(name) for k, name in enumerate(names)],
        F.sha2(secrets.as_text(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))
