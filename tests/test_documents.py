"""Layout, parsed JSON, references, TEI and batch extraction on literal documents."""

import json

from pyspark.sql import functions as F

from corpus_ledger import schemas
from corpus_ledger.functions import variant
from corpus_ledger.operators import merge, sections, tei

V = F.col("v")


def spans(spark, *rows):
    """Rows are (doc, page, block, line, text, size, flags)."""
    return spark.createDataFrame([(d, p, b, ln, i, t, s, f) for i, (d, p, b, ln, t, s, f) in enumerate(rows)], schemas.LAYOUT_BLOCKS)


def assembled(df):
    return [(r["doc_id"], r["title"], r["content"]) for r in sections.sections(df).orderBy("doc_id", "section").collect()]


def test_sections_before_and_after_headings(spark):
    df = spans(
        spark,
        (1, 0, 0, 0, "lead ", 10.0, 0), (1, 0, 0, 1, "text", 10.0, 0), (1, 0, 1, 0, "Methods", 10.0, 16), (1, 0, 2, 0, "one", 10.0, 0),
        (1, 1, 0, 0, "two", 10.0, 4), (1, 1, 1, 0, "  ", 10.0, 16), (1, 1, 2, 0, "Results", 30.0, 0), (1, 1, 3, 0, "Empty", 30.0, 0),
        (2, 0, 0, 0, "Title", 10.0, 16), (2, 6, 0, 0, "late", 50.0, 0),
    )
    assert assembled(df) == [
        (1, "Introduction", ["lead  text"]), (1, "Methods", ["one", "two"]), (1, "Results", []), (1, "Empty", []), (2, "Title", []), (2, "late", []),
    ]


def test_heading_limits(spark):
    words14, words15 = " ".join(["w"] * 14), " ".join(["w"] * 15)
    # Mean size 10: a size of exactly 12 does not stand out.
    df = spans(
        spark,
        (1, 0, 0, 0, words14, 10.0, 16), (1, 0, 1, 0, words15, 10.0, 16), (2, 0, 0, 0, "flat", 8.0, 0), (2, 0, 1, 0, "edge", 12.0, 0),
    )
    got = {(r["doc_id"], r["block"]): r["is_heading"] for r in sections.with_headings(df).collect()}
    assert got == {(1, 0): True, (1, 1): False, (2, 0): False, (2, 1): False}


def test_font_default_beyond_sample(spark):
    df = spans(spark, (1, 5, 0, 0, "a", 14.0, 0), (1, 5, 1, 0, "b", 14.5, 0))
    assert sections.average_font(df).first()["avg_size"] == 12.0
    assert [r["is_heading"] for r in sections.with_headings(df).orderBy("block").collect()] == [False, True]


def test_full_text_and_scans(spark):
    df = spans(spark, (1, 0, 0, 0, "a", 1.0, 0), (1, 2, 0, 0, "b", 1.0, 0), (2, 3, 0, 0, " ", 1.0, 0), (2, 7, 0, 0, "late", 1.0, 0))
    got = {r["doc_id"]: (r["full_text"], r["page_count"]) for r in sections.full_texts(df).collect()}
    assert got == {1: ("a\n\nb", 3), 2: ("late", 8)}
    assert {r["doc_id"]: r["is_scanned"] for r in sections.scanned_documents(df).collect()} == {1: False, 2: True}


def test_full_text_joins_pages_first(spark):
    rows = [(1, page, block, 0, f"p{page}b{block}" if block != 3 else " ", 1.0, 0) for page in (10, 0, 2) for block in (11, 3, 2)]
    out = sections.full_texts(spans(spark, *rows))
    assert [tuple(r) for r in out.collect()] == [(1, "\n\n".join(f"p{p}b{b}" for p in (0, 2, 10) for b in (2, 11)), 11)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    per_document = [line for line in plan.splitlines() if "Aggregate [doc_id#" in line and "page#" not in line.split("]")[0]]
    assert len(per_document) == 1 and "block" not in per_document[0]  # no block reaches the group of a document


def test_modes(spark):
    df = spans(spark, (1, 0, 0, 0, "Head", 10.0, 16), (1, 0, 1, 0, "body", 10.0, 0), (2, 0, 0, 0, " ", 10.0, 0))
    simple = {r["doc_id"]: r["text"] for r in sections.structured_documents(df, "simple").collect()}
    assert simple == {1: "Head\n\nbody", 2: ""}
    full = {r["doc_id"]: r["structured_text"] for r in sections.structured_documents(df, "full").collect()}
    assert [(s["title"], s["content"]) for s in full[1]["sections"]] == [("Head", ["body"])]
    assert (full[1]["full_text"], full[2]["sections"], full[2]["full_text"], full[2]["page_count"]) == ("Head\n\nbody", [], "", 1)


def test_references(one):
    def refs(text):
        return one(sections.references_of(V), v=text)

    assert refs("t\nReferences\n[1] a\n[2] b\n") == ["[1] a", "b"]
    assert refs("t\nReferences\n\n[1] a\n (2) b\n3. c") == ["[1] a", "b", "c"]
    # Headers are tried in fixed order, not in text order.
    assert refs("t\nReferences\nx\nREFERENCES\n1. a\n2. b") == ["1. a", "b"]
    assert refs("t\n Bibliography \nz") == ["z"]
    assert refs("no header") == []
    assert refs("t\nREFERENCES\n") == []
    assert refs(None) == []


def test_keywords(one):
    assert one(sections.keywords_of(V), v="a, b") == ["a", " b"]
    assert one(sections.keywords_of(V), v="") == []


def bodies(spark, *rows):
    return spark.createDataFrame(
        [(s, p, b if isinstance(b, str) else json.dumps(b)) for s, p, b in rows], "stem string, parser string, body string"
    )


def parsed(df, **kw):
    out = {}
    for r in sections.parsed_sections(df, **kw).collect():
        listed = None if r["sections"] is None else [(s["pos"], s["title"], s["content"]) for s in r["sections"]]
        out[r["stem"], r["parser"]] = (r["abstract"], listed)
    return out


BODY = [
    {"title": "B", "content": "b1"}, {"title": "A", "content": ["a1", "a2"]}, {"content": "none"}, {"title": "B", "content": "b2"}, {"title": "C", "content": " "},
]


def test_last_content_first_position(spark):
    df = bodies(
        spark,
        ("x", "grobid", {"metadata": {"abstract": "abs"}, "full_text": {"body": BODY}}), ("x", "pymupdf", {"abstract": "top", "structured_text": {"sections": BODY}}),
        ("y", "grobid", {"full_text": {"body": []}}), ("z", "grobid", "{bad"), ("s", "grobid", {"metadata": {"abstract": "abs"}, "full_text": "text"}),
        ("n", "grobid", {"metadata": {"abstract": "abs"}, "full_text": {"body": None}}), ("i", "grobid", {"metadata": {"abstract": "abs"}, "full_text": {"body": [{"content": "a"}, "b"]}}),
        ("m", "grobid", {"metadata": {"abstract": "abs"}}),
    )
    listed = [(0, "B", "b2"), (1, "A", "a1\n\na2"), (2, "Unnamed Section", "none"), (3, "C", " ")]
    got = parsed(df)
    assert got["x", "grobid"] == ("abs", listed)
    assert got["x", "pymupdf"] == (None, listed)
    assert got["y", "grobid"] == (None, None)
    assert got["z", "grobid"] == (None, None)
    assert [got[k, "grobid"] for k in "snim"] == [(None, None), (None, None), (None, None), ("abs", None)]
    loaded = parsed(df, drop_blank=True)
    assert loaded["x", "pymupdf"] == ("top", listed[:3])
    assert [loaded[k, "grobid"] for k in "snim"] == [("abs", None)] * 4


def test_section_texts(spark):
    df = sections.parsed_sections(bodies(spark, ("x", "grobid", {"full_text": {"body": [{"title": 'q"1', "content": "é\n"}, {"title": "r", "content": ""}]}})))
    s = F.col("sections")
    row = df.select(sections.sections_text(s).alias("t"), sections.sections_markdown(s).alias("m"), sections.sections_json(s).alias("j")).first()
    assert row["t"] == 'q"1\né\n\n\nr\n'
    assert row["m"] == '## q"1\n\né\n\n\n## r\n\n'
    assert row["j"] == json.dumps({'q"1': "é\n", "r": ""}, ensure_ascii=False)


def test_fallback(spark):
    structured = sections.parsed_sections(bodies(spark, ("x", "grobid", {"metadata": {"abstract": "s"}, "full_text": {"body": [{"title": "T", "content": "c"}]}}), ("y", "grobid", {"a": 1})))
    raw = spark.createDataFrame([("x", "raw"), ("y", " raw \n"), ("z", "  ")], "stem string, text string")
    got = {r["stem"]: (r["abstract"], r["extraction_method"], r["sections"][0]["title"], r["sections"][0]["content"]) for r in sections.with_fallback(structured, raw).collect()}
    assert got == {"x": ("s", "grobid", "T", "c"), "y": (None, "fallback_pypdf", "Full Text (Fallback Extraction)", "raw")}


def test_variant_truth(one):
    for text, truth in {'"a"': True, '""': False, "[]": False, "[0]": True, "{}": False, '{"a": null}': True, "0": False, "0.0": False, "2": True, "true": True, "false": False, "null": False}.items():
        assert one(variant.is_truthy(variant.parse(V)), v=text) is truth, text


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title> A &amp; B </title></titleStmt>
<author><persName><forename>Ann</forename><surname>Lee</surname></persName><affiliation><orgName>Lab</orgName> X</affiliation><email>a@x</email></author>
<author><persName><surname>Kim</surname></persName></author><author><persName><forename>No</forename></persName></author>
<monogr><title>J</title><biblScope unit="volume">4</biblScope><biblScope unit="issue">2</biblScope><biblScope unit="page">9</biblScope><date when="2020-01-02"/></monogr>
<idno type="ISSN">1</idno><idno type="DOI"> 10.1/x </idno><term>k</term><term> </term><abstract><div><p> p1 </p><p>p<b>2</b></p></div></abstract></teiHeader>
<text><body><div><head>H</head><p>a <i>b</i></p><div><p>inner</p></div></div><div><head>E</head></div></body>
<back><listBibl><biblStruct><title>T</title><author><persName><forename>R</forename><surname>S</surname></persName></author><date when="1999"/></biblStruct>
<biblStruct><note>raw one</note></biblStruct></listBibl></back></text></TEI>"""


def test_tei(spark):
    docs = spark.createDataFrame([(1, TEI), (2, "<TEI><body>"), (3, "<TEI/>"), (4, None)], "doc_id long, tei string")
    meta = {r["doc_id"]: r for r in tei.metadata(docs).collect()}
    one = meta[1]
    assert (one["title"], one["doi"], one["abstract"], one["journal"], one["volume"], one["issue"], one["pages"], one["year"]) == (
        "A & B", "10.1/x", "p1 p2", "J", "4", "2", "9", "2020",
    )
    # Authors of the references are collected too.
    assert [tuple(a) for a in one["authors"]] == [("Ann Lee", "Lab X", "a@x"), ("Kim", None, None), ("R S", None, None)]
    assert one["keywords"] == ["k"] and one["error"] is None
    assert meta[2]["error"].startswith("malformed") and meta[4]["error"] is not None
    assert meta[3]["title"] is None and meta[3]["authors"] == []
    got = [(r["pos"], r["title"], r["content"]) for r in tei.sections(docs).orderBy("doc_id", "pos").collect()]
    assert got == [(0, "H", "a b\n\ninner"), (1, "Unnamed Section", "inner")]
    refs = [(r["pos"], r["title"], r["authors"], r["year"], r["raw"]) for r in tei.references(docs).orderBy("pos").collect()]
    assert refs == [(0, "T", ["R S"], "1999", None), (1, None, None, None, "raw one")]


def test_batch_never_fails(spark):
    files = spark.createDataFrame([("a_b", bytearray(b"ok")), ("c", bytearray(b"")), ("d", bytearray(b"\xff"))], "stem string, content binary")

    def extract(stem, content):
        return content.decode("utf-8") or None

    got = {r["stem"]: (r["status"], r["doi"], r["error"], r["body"]) for r in sections.run_extractor(files, extract, tasks=2).collect()}
    assert got["a_b"] == ("success", "a/b", None, "ok")
    assert got["c"] == ("failed", "c", None, None)
    assert got["d"][0] == "error" and got["d"][2].startswith("UnicodeDecodeError")
    totals = {r["status"]: r["files"] for r in sections.extraction_totals(sections.run_extractor(files, extract)).collect()}
    assert totals == {"success": 1, "failed": 1, "error": 1}


def test_extractor_limit_and_dry_run(spark):
    files = spark.createDataFrame([(f"s{k}", b"x") for k in (3, 1, 2, 0)], "stem string, content binary")

    def never(stem, content):
        raise AssertionError("a dry run extracts nothing")

    run = sections.run_extractor
    assert sorted(r["stem"] for r in run(files, lambda stem, content: "{}", limit=2).collect()) == ["s0", "s1"]
    dry = run(files, never, limit=3, dry_run=True)
    assert dry.columns == ["stem"] and sorted(r["stem"] for r in dry.collect()) == ["s0", "s1", "s2"]
    assert run(files, never, dry_run=True).count() == run(files, never, limit=0).count() == 4


# -- merge -----------------------------------------------------------------------------

PAPER = ["pmid", "doi", "abstract", "full_text", "full_text_sections", "parsing_status"]


def papers(spark, *rows):
    df = spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in PAPER))
    return df.withColumn("title", F.lit("t")).withColumn("oa_url", F.lit(None).cast("string"))


def ledger_of(spark, **rows):
    return spark.createDataFrame([(d, *v) for d, v in rows.items()] or [(None, None, None)], "doi string, pymupdf_status string, grobid_status string").filter("doi IS NOT NULL")


def grobid(stem, body=None, abstract="new abs"):
    return (stem, "grobid", {"metadata": {"abstract": abstract}, "full_text": {"body": body if body is not None else [{"title": "T", "content": "g"}]}})


def fast(stem):
    return (stem, "pymupdf", {"structured_text": {"sections": [{"title": "F", "content": ["f"]}]}})


def test_import_rules(spark):
    rows = papers(
        spark,
        ("1", "none", None, None, None, None), ("2", "fast", " ", None, None, None), ("3", "empty", "", " ", "", None), ("4", "both", None, None, None, None),
        ("5", "emptyboth", None, None, None, None), ("6", "badboth", None, None, None, None), ("7", "over", "old", "old", "old", "success (parser: PyMuPDF)"),
        ("8", "overempty", "old", "old", "old", "not_found"), ("9", "skip", "old", "old", None, "x GROBID y"), ("10", "full", "old", "old", "old", "grobid"),
        ("11", "partial", "old", " ", None, ""), ("12", None, None, None, None, None), ("13", "", None, None, None, None), ("14", "space", "old", "old", "old", " "),
    )
    files = bodies(
        spark, fast("fast"), grobid("empty", []), grobid("both"), fast("both"), grobid("emptyboth", []), fast("emptyboth"), ("badboth", "grobid", "{x"), fast("badboth"),
        grobid("over"), fast("over"), grobid("overempty", []), fast("overempty"), grobid("skip"), grobid("full"), fast("partial"), grobid("space"), grobid("unlisted"),
    )
    held = ledger_of(spark, fast=("success", None), both=("success", "success"), emptyboth=("failed", "failed"), badboth=(None, "success"))
    changes = merge.import_changes(rows, files, held)
    got = {r["doi"]: (r["parser_used"], r["skipped"], r["abstract"], r["full_text"], r["full_text_sections"], r["parsing_status"]) for r in changes.collect()}
    g = ("T\ng", '{"T": "g"}')
    f = ("F\nf", '{"F": "f"}')
    assert got == {
        "fast": ("pymupdf", False, None, *f, "success (parser: PyMuPDF)"),
        "empty": ("grobid", False, "new abs", None, None, "parser: grobid"),
        "both": ("grobid", False, "new abs", *g, "success (parser: PyMuPDF) | grobid: success"),
        "emptyboth": ("pymupdf", False, None, *f, "parser: PyMuPDF"),
        "badboth": ("pymupdf", False, None, *f, "success (parser: grobid)"),
        "over": ("grobid", False, None, *g, "success (parser: PyMuPDF) | grobid: success"),
        "overempty": ("grobid", False, None, None, None, "not_found | grobid: success"),
        "skip": ("grobid", True, None, None, None, None),
        "partial": ("pymupdf", False, None, *f, "parser: PyMuPDF"),
        "space": ("grobid", False, None, *g, "  | grobid: success"),
    }
    counters = merge.import_counters(changes).first().asDict()
    assert counters == {"json_updates": 10, "skipped_already_complete": 1, "abstract_updated": 2, "sections_updated": 7, "status_from_jsons": 9, "errors": 0}
    after = {r["pmid"]: r for r in merge.apply_changes(rows, changes).collect()}
    assert len(after) == 14 and after["12"]["doi"] is None and after["13"]["doi"] == ""
    assert (after["7"]["abstract"], after["7"]["full_text"]) == ("old", "T\ng")
    assert after["1"]["parsing_status"] is None


def test_repeated_doi_is_one_paper(spark):
    """Rows that share a DOI get one change each, not one per pair."""
    rows = papers(spark, *[(str(100 + i), "same", None, None, None, None) for i in range(30)])
    changes = merge.import_changes(rows, bodies(spark, fast("same")), ledger_of(spark))
    assert changes.count() == 1
    after = merge.apply_changes(rows, changes)
    assert after.count() == 30 and after.filter("full_text = 'F\\nf'").count() == 30


def test_combined_update(spark):
    rows = papers(
        spark,
        ("1", "imported", None, None, None, None), ("2", "listed", "a", "a", "a", ""), ("3", "unlisted", "a", "a", "a", None), ("4", "logged", "a", "a", "a", None),
        ("5", None, None, None, None, None), ("6", "", None, None, None, "kept"), ("7", "kept", "a", "a", "a", "grobid"),
    )
    lists = spark.createDataFrame([("imported",), ("listed",), ("logged",)], "doi string")
    log = spark.createDataFrame([("logged", "success", "grobid"), ("imported", "x", None)], "doi string, result string, parser string")
    got = {r["pmid"]: r["parsing_status"] for r in merge.update_all(rows, bodies(spark, fast("imported")), ledger_of(spark), lists, log).collect()}
    assert got == {
        "1": "parser: PyMuPDF", "2": "not processed - not found in logs", "3": "not required - already populated", "4": "success (parser: grobid)",
        "5": "no DOI available", "6": "kept", "7": "grobid",
    }


def test_loader_mixes_parsers(spark):
    files = bodies(
        spark, grobid("a", [{"title": "T", "content": "  "}]), fast("a"), grobid("b"), fast("b"), ("c", "pymupdf", {"abstract": "top", "structured_text": {"sections": [{"content": ["z"]}]}}),
        grobid("d", []), ("e", "grobid", "{x"), fast("e"),
    )
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), ("zz",)], "doi string")
    got = {r["doi"]: (r["abstract"], r["full_text_sections"], r["parsing_status"]) for r in merge.loader_changes(keys, files).collect()}
    assert got == {
        "a": ("new abs", '{"F": "f"}', "success (parser: pymupdf)"), "b": ("new abs", '{"T": "g"}', "success (parser: grobid)"),
        "c": ("top", '{"Unnamed Section": "z"}', "success (parser: pymupdf)"), "e": (None, '{"F": "f"}', "success (parser: pymupdf)"),
    }


def test_fetched_changes(spark):
    rows = papers(spark, ("1", "a", None, None, None, None), ("2", "b", "x", "", None, None), ("3", "c", "", "x", None, None), ("4", "d", "x", "x", None, None), ("5", "e", None, None, None, None))
    new = spark.createDataFrame([("1", "A", "T", "S"), ("2", "A", "T", ""), ("3", "A", "T", "S"), ("4", "A", "T", "S"), ("5", "", "", "S")], "pmid string, abstract string, full_text string, full_text_sections string")
    changes = merge.fetched_changes(rows, new)
    got = {r["pmid"]: (r["abstract"], r["full_text"], r["full_text_sections"]) for r in changes.collect()}
    assert got == {"1": ("A", "T", "S"), "2": (None, "T", None), "3": ("A", None, None)}
    after = {r["pmid"]: r["full_text"] for r in merge.apply_changes(rows, changes, key="pmid").collect()}
    assert after == {"1": "T", "2": "T", "3": "x", "4": "x", "5": None}


def test_latest_entry_ties(spark):
    rows = [("a", "2024-01-02", "late", "p", 1, 5), ("a", "2024-01-02", "first", None, 0, 9), ("a", "2024-01-01", "old", "p", 0, 1), ("b", "1", "x", None, 0, 2), ("b", "1", "y", None, 0, 3)]
    log = spark.createDataFrame(rows, "doi string, ts string, result string, parser string, file_ord int, pos long")
    got = {r["doi"]: (r["result"], r["parser"]) for r in merge.latest_log_entry(log).collect()}
    assert got == {"a": ("first", None), "b": ("x", None)}
