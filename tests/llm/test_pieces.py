"""The encoding against the model's own by the library, and exact round trips."""

import random

import pytest

from corpus_ledger.llm import pieces
from tests.llm.common import frame

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.Model(PATH)
ENCODER = pieces.Encoder(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)

TEXTS = [
    "Hello world", " lead", "two  spaces   three", "trail  ", "line\nbreak \n\n next", "\n", " ", "▁ literal ▁▁x", "naïve Über 日本語 👩‍👩‍👧", "\t tab\r\nx",
    "a" * 3000, "word " * 4000, "<s> </s> <unk> <0x41>", "\x01\x02", "x" * 20_000 + " " + "ab" * 10_000,
]
PARTS = ["a", "aa", "e", "th", "the", "in", "  ", " ", "\n", "ing", "é", "😀", "ß", "1", "00", "==", "\t", "-", "本", "日", "Q", "'s", "ation"]


def test_ids_of_the_library_and_round_trip(spark):
    rnd = random.Random(2)
    rows = [(k, t) for k, t in enumerate(TEXTS + ["".join(rnd.choices("ab ▁\né.", k=40)) for _ in range(30)])]
    rows += [(900, None), (901, ""), (None, "no id"), rows[0], rows[0]]
    got = pieces.encoded(frame(spark, rows, "ids").repartition(3), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        assert r["decoded"] == text
        if "▁" not in text:  # the library takes this sign for a space; here it comes back as it was
            assert r["ids"] == LIBRARY.encode(text)
    assert all(r["exact"] for r in pieces.encoding_report(frame(spark, rows, "exact"), PATH).collect())


def test_random_texts(spark):
    rnd = random.Random(5)
    rows = [(k, "".join(rnd.choices(PARTS, k=rnd.randrange(1, 30)))) for k in range(3000)]
    for r in pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect():
        assert r["ids"] == LIBRARY.encode(r["text"]) and r["decoded"] == r["text"]


def test_pieces_that_stay_apart():
    """The merge trees tell of any two pieces what the library makes of them."""
    rnd = random.Random(7)
    letters = [k for k in MODEL.plain if MODEL.pieces[k].isalpha() and MODEL.pieces[k].isascii()]
    for _ in range(5000):
        a, b = rnd.choice(letters), rnd.choice(letters)
        text = MODEL.pieces[a] + MODEL.pieces[b]
        own = ENCODER.word(text)
        assert (own == [a, b]) == ENCODER.apart(a, b)


def test_kept_words_are_bounded(monkeypatch):
    import numpy as np

    monkeypatch.setattr(pieces, "KEPT_BYTES", 2000)
    encoder = pieces.Encoder(MODEL)
    for part in range(20):
        text = " ".join(f"w{part}x{k}" for k in range(50)) + " " + "y" * 5000
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder(data, np.array([0, len(data)]))
        assert ids.tolist() == LIBRARY.encode(text)
        assert encoder.kept < 2000 + 51 * 300 and len(encoder.known) < 60


def test_words_are_cut_where_no_piece_joins():
    """What stands beside a word without joining it makes no other word of it."""
    import numpy as np

    encoder = pieces.Encoder(MODEL)
    text = "".join(f" tion{a}" for a in "\x01\x02\x03\x04\x05") * 3
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = encoder(data, np.array([0, len(data)]))
    assert ids.tolist() == LIBRARY.encode(text)
    assert len(encoder.known) == 7  # the word, the first one with a space more, and five marks


def test_empty_table(spark):
    assert pieces.encoding_report(frame(spark, [], "exact"), PATH).collect() == []


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in pieces.encoded(docs, PATH).collect():
        assert r["decoded"] == r["text"] and r["ids"] == LIBRARY.encode(r["text"])
