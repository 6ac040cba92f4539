"""TEI markup into metadata, sections and references.

Mixed content and nested divisions are out of reach of XPath functions, so each row is
parsed in an Arrow batch with the standard library. Malformed markup becomes an error row.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Output shapes.
AUTHOR = pa.struct([("name", pa.string()), ("affiliation", pa.string()), ("email", pa.string())])
_TEXT = ("error", "doi", "title", "abstract", "journal", "volume", "issue", "pages", "year")
METADATA = pa.schema(
    [("doc_id", pa.int64()), *[(c, pa.string()) for c in _TEXT], ("authors", pa.list_(AUTHOR)), ("keywords", pa.list_(pa.string()))]
)
METADATA_SCHEMA = (
    "doc_id long, " + ", ".join(f"{c} string" for c in _TEXT)
    + ", authors array<struct<name:string,affiliation:string,email:string>>, keywords array<string>"
)
SECTION = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("title", pa.string()), ("content", pa.string())])
SECTION_SCHEMA = "doc_id long, pos int, title string, content string"
REFERENCE = pa.schema(
    [("doc_id", pa.int64()), ("pos", pa.int32()), ("title", pa.string()), ("authors", pa.list_(pa.string())), ("year", pa.string()), ("raw", pa.string())]
)
REFERENCE_SCHEMA = "doc_id long, pos int, title string, authors array<string>, year string, raw string"
DOCS_PER_BATCH = 64
UNNAMED = "Unnamed Section"


def _named(node: ET.Element, name: str, **attrs: str) -> Iterator[ET.Element]:
    """Descendants by local name, in document order, without the node itself."""
    for child in node.iter():
        if child is node or not isinstance(child.tag, str):
            continue
        if child.tag.rpartition("}")[2] == name and all(child.get(k) == v for k, v in attrs.items()):
            yield child


def _first(node: ET.Element | None, name: str, **attrs: str) -> ET.Element | None:
    return None if node is None else next(_named(node, name, **attrs), None)


def _text(node: ET.Element | None) -> str | None:
    return None if node is None else "".join(node.itertext()).strip()


def _person(author: ET.Element) -> str | None:
    person = _first(author, "persName")
    surname = _text(_first(person, "surname"))
    if surname is None:
        return None
    forename = _text(_first(person, "forename"))
    return surname if forename is None else f"{forename} {surname}"


def _year(node: ET.Element | None) -> str | None:
    date = _first(node, "date")
    when = None if date is None else date.get("when")
    return when[:4] if when else None


def _root(tei: str) -> ET.Element:
    """A parent above the document element, so every element of it is a descendant."""
    top = ET.Element("document")
    top.append(ET.fromstring(tei))
    return top


def _metadata(root: ET.Element) -> dict:
    abstract = _first(root, "abstract")
    monograph = _first(root, "monogr")
    authors = []
    for author in _named(root, "author"):
        entry = {
            "name": _person(author),
            "affiliation": _text(_first(author, "affiliation")),
            "email": _text(_first(author, "email")),
        }
        if any(v is not None for v in entry.values()):
            authors.append(entry)
    terms = (_text(t) for t in _named(root, "term"))
    return {
        "doi": _text(_first(root, "idno", type="DOI")),
        "title": _text(_first(_first(root, "titleStmt"), "title")),
        "abstract": None if abstract is None else " ".join(_text(p) or "" for p in _named(abstract, "p")),
        "authors": authors,
        "journal": _text(_first(monograph, "title")),
        "volume": _text(_first(monograph, "biblScope", unit="volume")),
        "issue": _text(_first(monograph, "biblScope", unit="issue")),
        "pages": _text(_first(monograph, "biblScope", unit="page")),
        "year": _year(monograph),
        "keywords": [t for t in terms if t],
    }


def _sections(root: ET.Element) -> Iterator[dict]:
    body = _first(root, "body")
    pos = 0
    for div in [] if body is None else _named(body, "div"):
        content = "\n\n".join(_text(p) or "" for p in _named(div, "p"))
        if content:
            head = _text(_first(div, "head"))
            yield {"pos": pos, "title": UNNAMED if head is None else head, "content": content}
            pos += 1


def _references(root: ET.Element) -> Iterator[dict]:
    listing = _first(_first(root, "back"), "listBibl")
    for pos, entry in enumerate([] if listing is None else _named(listing, "biblStruct")):
        names = [n for n in map(_person, _named(entry, "author")) if n is not None]
        found = {"title": _text(_first(entry, "title")), "authors": names or None, "year": _year(entry)}
        raw = _text(entry) if all(v is None for v in found.values()) else None
        yield {"pos": pos, **found, "raw": raw}


def _per_document(docs: DataFrame, rows_of, arrow: pa.Schema, schema: str) -> DataFrame:
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            # Output is cut by documents, so a batch holds the rows of a few texts only.
            for start in range(0, frame.num_rows, DOCS_PER_BATCH):
                part = frame.slice(start, DOCS_PER_BATCH).to_pylist()
                rows = [{"doc_id": d["doc_id"], **row} for d in part for row in rows_of(d["tei"])]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select("doc_id", "tei").mapInArrow(batches, schema)


def _metadata_rows(tei: str | None) -> list[dict]:
    try:
        return [{"error": None, **_metadata(_root(tei or ""))}]
    except ET.ParseError as problem:
        return [{"error": f"malformed: {problem}", "authors": [], "keywords": []}]


def _section_rows(tei: str | None) -> list[dict]:
    try:
        return list(_sections(_root(tei or "")))
    except ET.ParseError:
        return []


def _reference_rows(tei: str | None) -> list[dict]:
    try:
        return list(_references(_root(tei or "")))
    except ET.ParseError:
        return []


def metadata(docs: DataFrame) -> DataFrame:
    """One row per document ``(doc_id, tei)``; ``error`` is set where the markup is malformed."""
    return _per_document(docs, _metadata_rows, METADATA, METADATA_SCHEMA)


def sections(docs: DataFrame) -> DataFrame:
    """Body divisions (nested ones too) that hold paragraphs."""
    return _per_document(docs, _section_rows, SECTION, SECTION_SCHEMA)


def references(docs: DataFrame) -> DataFrame:
    """Bibliography entries; ``raw`` holds the text where nothing could be named."""
    return _per_document(docs, _reference_rows, REFERENCE, REFERENCE_SCHEMA)
