"""Exact round trips through the coder and the files."""

import zlib

import numpy as np
import pytest

from corpus_ledger.llm import rans
from tests.llm.common import frame

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "Hello  World! it's 2024, l'été à Paris\n\nnew\tline",
    "",
    " \n ",
    "x" * 5000,
    "<|endoftext|>a <|startoftext|> b<|endoftext|>",
    "ΟΔΟΣ ΣΊΣΥΦΟΣ café café ́alone á ́",
    " non breaking\u0085spaces​\x1c\x1dcontrol",
    "日本語 テスト 👩‍👩‍👧 İstanbul ǅ ß ﬁ",
    "don't DON'T 'S 's'd'll 12a34 ... --- a.b.c",
    "w" + " word" * 30000,
    "A.b,C;;d:'S!'s?!x .'s é.a.é ,'ll I'm.I'M \u0130.\u0307a, a.\u0301b",
]


def plain(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, rans.END_ID]


@pytest.mark.parametrize("n", [1, 5, rans.LANES, rans.LANES + 1, 3 * rans.LANES * rans.CHECKPOINT, 200_001])
def test_blocks(n):
    rnd = np.random.default_rng(n)
    ids = np.minimum(rnd.zipf(1.2, n), 49_407).astype(np.int64)
    ids[rnd.integers(0, n)] = 0
    table = rans.Frequencies.of(dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)], strict=True)))
    assert table.scaled.sum() == 1 << rans.SCALE_BITS
    tables = rans.Frequencies.from_json(table.to_json()).tables()
    words, states, places = rans.encode_block(ids, tables)
    assert (rans.decode_block(n, words, states, places, tables) == ids).all()
    share = np.bincount(ids)[ids] / n
    assert 8 * len(words) <= -np.log2(share).sum() * 1.02 + 64


def test_files(spark, tmp_path):
    rows = [(k * 3, t) for k, t in enumerate(TEXTS)] + [(1, None), (None, "no id"), (6, TEXTS[3]), (6, TEXTS[3])]
    path = str(tmp_path / "tokens")
    rans.write_ids(rans.token_ids(frame(spark, rows, "shard").repartition(4), PATH), path)
    got = sorted(rans.read_ids(spark, path, texts=True).collect(), key=lambda r: r["start"])
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys) and len(got) == len(rows)
    at = 0
    want = sorted([(i if i is not None else -1, plain(t)) for i, t in rows])
    for r, (i, ids) in zip(got, want, strict=True):
        body = np.array(ids, "<u4").tobytes()
        assert (r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["n_tokens"]) == (i, at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(body) and r["ids"] == body
        at += len(ids)


def test_blocks_of_one_document_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 4)
    rows = [(k, t) for k, t in enumerate(TEXTS[:9])]
    rans.write_ids(rans.token_ids(frame(spark, rows, "n"), PATH), str(tmp_path / "t"))
    got = rans.read_ids(spark, str(tmp_path / "t")).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: len(plain(t)) for k, t in rows}


def test_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "t")
    rans.write_ids(rans.token_ids(frame(spark, [(1, TEXTS[0] * 50)], "n"), PATH), path)
    blocks = spark.read.parquet(f"{path}/blocks").toPandas()
    blocks["crc32"] += 1
    spark.createDataFrame(blocks, spark.read.parquet(f"{path}/blocks").schema).write.parquet(f"{path}2/blocks")
    spark.read.text(f"{path}/frequencies").write.text(f"{path}2/frequencies")
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(spark, f"{path}2").collect()


def test_words_of_a_worker_are_bounded(monkeypatch):
    monkeypatch.setattr(rans, "KEPT_BYTES", 4000)
    words = rans.WordIds(PATH)
    for part in range(20):
        texts = [" ".join(f"w{part}x{k}" for k in range(50)), "", f"again and again {part}"]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        ids, counts = words(data, np.cumsum([0, *[len(t) for t in texts]]))
        assert ids.tolist() == [i for t in texts for i in plain(t)[:-1]] and counts.tolist() == [len(plain(t)) - 1 for t in texts]
        assert words.known.nbytes < 4000 + 60 * 60 and len(words.known) < 160


def test_empty_table(spark):
    assert rans.encoded_documents(frame(spark, [], "n"), PATH).collect() == []


def test_words_equal_whole_texts(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    got = rans.token_ids(frame(spark, list(enumerate(texts)), "n"), PATH).collect()
    assert all(np.frombuffer(r["ids"], f"<u{r['width']}").tolist() == plain(texts[r["doc_id"]]) for r in got)


def as_slice(texts):
    bodies = [t.encode() for t in texts]
    return np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *[len(b) for b in bodies]])


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_of_letters_are_encoded_together():
    words = rans.WordIds(PATH)
    words.tokenizer, words.spaced = Counted(words.tokenizer), Counted(words.spaced)
    rnd = np.random.default_rng(3)
    texts = [" ".join("".join(rnd.choice(list("abcdeéñœ"), rnd.integers(1, 12))) + end for _ in range(100)) for end in ("", ".", "$$$") * 20]
    ids, counts = words(*as_slice(texts))
    assert ids.tolist() == [i for t in texts for i in plain_ids(t)] and counts.tolist() == [len(plain_ids(t)) for t in texts]
    assert words.tokenizer.texts + words.spaced.texts < 120


def test_letters_beside_marks():
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha()]
    latin = [chr(c) for c in range(0xA0, 0x300)]
    texts = [f"{a}{m}{b}{m}{a}{b} {m}{a}{m} {a}\u0301{m}\u0338{b}" for a in ["x", "s", "É", "ß", "İ"] for m in marks for b in ["y", "S", "œ"]]
    texts += [f"a{c}b {c}. .{c}{c}'s {c}\u0307 {c}" for c in latin] + ["É", "", "é", "\u0301.", "'ll.'LL"]
    words = rans.WordIds(PATH)
    for group in (texts, texts[::-1], [*texts, "<|endoftext|>A.É"]):
        ids, counts = words(*as_slice(group))
        assert ids.tolist() == [i for t in group for i in plain_ids(t)] and counts.tolist() == [len(plain_ids(t)) for t in group]


def test_another_model_takes_words_one_by_one(tmp_path):
    """Without marked last tokens, or where accents are dropped, words are not put together."""
    from tokenizers import Tokenizer, normalizers

    bare = Tokenizer.from_file(PATH)
    bare.normalizer = normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents(), normalizers.Lowercase()])
    bare.save(str(tmp_path / "t.json"))
    words, texts = rans.WordIds(str(tmp_path / "t.json")), ["Élan été a.b", "naïve"]
    assert words.last is None
    assert words(*as_slice(texts))[0].tolist() == [i for t in texts for i in bare.encode(t, add_special_tokens=False).ids]


def plain_ids(text, kept={}):
    if not kept:
        from tokenizers import Tokenizer

        kept["t"] = Tokenizer.from_file(PATH)
    return kept["t"].encode(text, add_special_tokens=False).ids
