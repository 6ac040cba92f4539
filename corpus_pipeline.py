"""The cleaning pipeline: each stage is one operator of the training-data package, applied to what the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_ledger.llm import decontaminate, expansion, jaccard, pieces, toxicity
from corpus_ledger.llm.queries import tokenizer_file
from corpus_ledger.llm.tables import documents, table, written

#: No SQL form: the toxicity model is fitted and the pieces come from a Viterbi search.
ORACLE_SQL = None



def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5; the classifier learns from the labels of the given documents.

    NULL and empty texts have the score of a text without features and stay; repeated rows are judged alike, each for
    itself; without labels of both classes there is nothing to learn, and all stay or, if all labels are toxic, none.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets, the one with the smallest id; of rows that repeat its id, one.

    Documents without words, and rows without an id, are linked with nothing and all stay.
    """
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that 400-byte windows repeat elsewhere; what is left of a cut character goes too.

    Every document stays, if need be with an empty text; ``n_chars`` counts what is left. NULL texts stay NULL.
    """
    return expansion.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words do not lie in windows of the benchmark to a twentieth or more; their texts stay whole.

    NULL and empty texts have no words and stay, repeated rows are judged alike, and an empty benchmark keeps all.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with a check that decoding gives the text back.

    NULL counts as empty, and an empty text has no pieces; repeated rows each come out, and so do rows without an id.
    """
    return pieces.encoding_report(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("decontaminate", without_benchmark),
    ("sentencepiece", as_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
