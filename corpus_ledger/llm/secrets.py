"""Secrets in texts: fixed patterns, and values after credential words that would take many guesses.

A value is judged as a password guesser would see it: the cheapest way to cut it into words, dates, repeats, keyboard walks,
sequences and rest, each with the number of guesses it takes, is found by dynamic programming over its characters. Words
are those of the documents themselves, a word costs as many guesses as there are words at least as frequent (to a power of
two). Words inside of the judged values are not counted, so copies of a secret don't make it a word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import runs
from .tables import written

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter match is dropped, and no other starts in it
LEAST_VALUE, LEAST_ACCESS = 8, 16

#: What stands before a credential value: a word and a sign, a command line option, or the user of an address.
CONTEXTS = (
    re.compile(
        r"""(?ia)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|auth)[_-]?key|auth|credentials?)["']?(?:\x20*(?::|=>?)|\x20+is)\x20*["']?([^\s"'<>,;]+)"""
    ),
    re.compile(r"""(?ia)(?:--(?:password|passwd|token|secret|api-?key)[\x20=]|\bbearer\x20+)["']?([^\s"'<>,;]+)"""),
    re.compile(r"""(?a)://[^\s/:@"'<>]{1,64}:([^\s/@"'<>]+)@"""),
)
#: A text without any of these (in lower case) has no context and no assignment.
HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer", "://")

#: log10 of the guesses from which a value is a secret.
LEAST_GUESSES = 10.0
WORD_LETTERS = (3, 24)
WORD = re.compile(r"[^\W\d_]+")
HELD_WORDS = 200_000


# -- guesses -----------------------------------------------------------------------------

#: Rows of the common keyboard, each half a key to the right of the one above.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
PLACES = {key: (x, y) for y, row in enumerate(ROWS) for x, key in enumerate(row, start=y > 0)}
STEPS = {(1, 0), (-1, 0), (0, 1), (-1, 1), (0, -1), (1, -1)}

#: log10 of guesses: a further part; the first key and direction of a walk, each step straight on, each turn; a sequence's start, each step.
FURTHER, WALK, STRAIGHT, TURN, SEQUENCE, ON = 1.0, math.log10(47 * 6), 0.1, math.log10(6), math.log10(62 * 2), 0.05
YEARS = 130
#: By the digits of day and month: day, month and year (of two or four digits), and year, month and day.
DATES = [
    {w: re.compile(rf"(?a)(?P<first>\d{{{w}}})(?P<sign>[-/._]?)(?P<second>\d{{{w}}})(?P=sign)(?:19|20)\d\d") for w in (1, 2)},
    {w: re.compile(rf"(?a)(?P<first>\d{{{w}}})(?P<sign>[-/._]?)(?P<second>\d{{{w}}})(?P=sign)\d\d") for w in (1, 2)},
    {w: re.compile(rf"(?a)(?:19|20)\d\d(?P<sign>[-/._]?)(?P<first>\d{{{w}}})(?P=sign)(?P<second>\d{{{w}}})") for w in (1, 2)},
]


def lowered(value: str) -> str:
    """Lower case, character by character."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


def word_parts(value: str) -> set[str]:
    """What of a value may be a word: every stretch of letters, in lower case."""
    least, most = WORD_LETTERS
    return {
        m[0][i:j] for m in WORD.finditer(lowered(value)) for i in range(len(m[0])) for j in range(i + least, min(len(m[0]), i + most) + 1)
    }


def case_guesses(word: str) -> int:
    """Ways to write a word with as many capitals: two for none but the first or all, else all their places."""
    upper = sum(c != low for c, low in zip(word, lowered(word)))
    if not upper:
        return 1
    if upper == len(word) or (upper == 1 and word[0] != lowered(word[0])):
        return 2
    return 2 * math.comb(len(word), min(upper, len(word) - upper))


def alphabet(value: str) -> int:
    """Size of the character classes a value uses."""
    if all(c in "0123456789abcdef" for c in value) and not value.isdecimal():
        return 16
    kinds = {10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" else 27 if "A" <= c <= "Z" else 33 if c < "\x80" else 1000 for c in value}
    return sum(26 if k == 27 else k for k in kinds)


def walk_step(a: str, b: str) -> tuple[int, int] | None:
    """Direction from a key to a neighbour."""
    p, q = (PLACES.get(lowered(c.translate(SHIFTED))) for c in (a, b))
    step = (q[0] - p[0], q[1] - p[1]) if p and q else None
    return step if step in STEPS else None


def sequence_step(a: str, b: str) -> int | None:
    """1 or -1 between letters or digits that follow each other."""
    same = any(low <= a <= high and low <= b <= high for low, high in ("09", "az", "AZ"))
    return ord(b) - ord(a) if same and abs(ord(b) - ord(a)) == 1 else None


def dates(value: str) -> Iterator[tuple[int, int, float]]:
    """Years, and dates of day, month and year in the usual orders, with or without a sign between them."""
    for i in range(len(value)):
        if not "0" <= value[i] <= "9":
            continue
        if re.match(r"(?a)(?:19|20)\d\d", value[i : i + 4]):
            yield i, i + 4, math.log10(YEARS)
        for pattern in DATES:
            for width in (1, 2):
                m = pattern[width].match(value, i)
                if m and _real(m):
                    yield i, m.end(), math.log10(366 * YEARS * (4 if m["sign"] else 1))


def _real(m: re.Match) -> bool:
    a, b = int(m["first"]), int(m["second"])
    return (1 <= a <= 31 and 1 <= b <= 12) or (1 <= a <= 12 and 1 <= b <= 31)


def repeats(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """Stretches of whole periods, from the start of each run: the guesses of one period times their number."""
    for start, length, period in runs.periodic_runs(np.array([ord(c) for c in value], np.int64)):
        times = length // period
        yield start, start + times * period, guess_digits(value[start : start + period], ranks) + math.log10(times)


def words(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    low = lowered(value)
    least, most = WORD_LETTERS
    for i in range(len(low)):
        for j in range(i + least, min(len(low), i + most) + 1):
            rank = ranks.get(low[i:j])
            if rank:
                yield i, j, math.log10(rank * case_guesses(value[i:j]))


def guess_digits(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses of the cheapest segmentation; ``ranks`` has the guesses of each word the value may hold.

    One pass: ``best[j]`` is the cheapest way to end a part before character ``j``; open brute-force, walk and sequence
    parts are carried on from character to character.
    """
    n = len(value)
    if not n:
        return 0.0
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for found in (words(value, ranks), dates(value), repeats(value, ranks) if n > 1 else ()):
        for i, j, cost in found:
            ending[j].append((i, cost))
    char = math.log10(alphabet(value))
    best, no = [0.0] + [math.inf] * n, math.inf
    begin = lambda i: best[i] + (FURTHER if i else 0.0)
    rest = walk = sequence = no
    walked = followed = None
    for j in range(1, n + 1):
        rest = min(rest, begin(j - 1)) + char
        if j > 1:
            step = walk_step(value[j - 2], value[j - 1])
            walk = min(walk + (STRAIGHT if step == walked else TURN), begin(j - 2) + WALK + STRAIGHT) if step else no
            walked = step
            step = sequence_step(value[j - 2], value[j - 1])
            carried = sequence + ON if step == followed else no
            sequence = min(carried, begin(j - 2) + SEQUENCE + ON) if step else no
            followed = step
        best[j] = min([rest, walk, sequence, *(begin(i) + cost for i, cost in ending[j])])
    return best[n]


# -- one text ----------------------------------------------------------------------------


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """Start, end and kind of what the fixed patterns find; ``low`` is the text in lower case, to skip patterns that can't match."""
    found = []
    if any(hint in low for hint in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def credential_values(text: str, low: str) -> list[tuple[int, int]]:
    """Where values after credential words are; what ends a sentence or bracket is no part of them."""
    if not any(hint in low for hint in HINTS):
        return []
    found = set()
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            value = m[1].rstrip(".:)]}")
            if value:
                found.add((m.start(1), m.start(1) + len(value)))
    return sorted(found)


# -- all documents -----------------------------------------------------------------------

SPAN = "struct<start:bigint,end:bigint,kind:int>"
VALUE = "struct<start:bigint,end:bigint,value:string>"


def _structs(rows: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.Array:
    return pa.array([[dict(zip(names, r)) for r in row] for row in rows], pa.list_(pa.struct(list(zip(names, kinds)))))


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts, written: a row per document with spans and values, and rows that count the words of a task."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row bigint, base array<{SPAN}>, held array<{VALUE}>, word string, n bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = TaskContext.get().partitionId() << 33, Counter()

        def counted() -> pa.RecordBatch:
            k = len(counts)
            none = lambda t: pa.nulls(k, t)
            columns = [none(ids), none(pa.int64()), none(spans), none(values), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        names = ["id", "row", "base", "held", "word", "n"]
        ids = spans = values = None
        for batch in batches:
            base, held = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                low = text.lower()
                base.append(base_spans(text, low))
                places = credential_values(text, low)
                held.append([(i, j, text[i:j]) for i, j in places])
                for i, j in reversed(places):
                    text = f"{text[:i]} {text[j:]}"
                counts.update(WORD.findall(text.lower() if places else low))
            base = _structs(base, ["start", "end", "kind"], [pa.int64(), pa.int64(), pa.int32()])
            held = _structs(held, ["start", "end", "value"], [pa.int64(), pa.int64(), pa.string()])
            ids, spans, values = batch.column(0).type, base.type, held.type
            k = batch.num_rows
            rows = pa.array(np.arange(seen, seen + k, dtype=np.int64))
            seen += k
            yield pa.RecordBatch.from_arrays([batch.column(0), rows, base, held, pa.nulls(k, pa.string()), pa.nulls(k, pa.int64())], names)
            if len(counts) > HELD_WORDS:
                yield counted()
        if counts:
            yield counted()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(work, schema), "secrets")


def word_ranks(counts: DataFrame) -> Column:
    """Guesses of a word by its count ``n``: words at least as frequent, to a power of two (at most 64 classes)."""
    power = F.floor(F.log2("n")).cast("int")
    classes = sorted(((r["p"], r["k"]) for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    total, known = 0, []
    for p, k in classes:
        total += k
        known += [F.lit(p), F.lit(total)]
    return F.element_at(F.create_map(*known), power) if known else F.lit(None).cast("bigint")


def judged(held: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct ``value`` with the ``digits`` of the guesses it takes, from the words of the corpus it holds."""
    values = held.select("value").distinct()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found = sorted(word_parts(value))
                for at in range(0, len(found), 100_000):
                    some = found[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([value] * len(some), pa.string()), pa.array(some, pa.string())], ["value", "word"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits = [
                guess_digits(value, {w["word"]: w["rank"] for w in known or []})
                for value, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digits, pa.float64())], ["value", "digits"])

    ranked = counts.select("word", word_ranks(counts).cast("bigint").alias("rank"))
    known = values.mapInArrow(parts, "value string, word string").join(ranked, "word")
    known = known.groupBy("value").agg(F.collect_list(F.struct("word", "rank")).alias("known"))
    return values.join(known, "value", "left").select("value", "known").mapInArrow(judge, "value string, digits double")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_guesses: float = LEAST_GUESSES) -> DataFrame:
    """Spans of secrets in every whole text: ``id_col`` and ``spans``, structs of start, end (code points, exclusive) and kind.

    Kinds are numbers into ``KINDS``; spans are ordered by start, then kind. The first three are fixed patterns, ``guess``
    marks values after credential words that take ``10**least_guesses`` guesses or more, also inside of others' spans.
    NULL and empty texts have no spans; equal texts have equal spans; rows without an id are kept; other columns are
    left out. One value may be in many documents: it is judged once, and the join back splits its rows.
    """
    table = scanned(docs, id_col, text_col)
    rows = table.filter(F.col("row").isNotNull())
    counts = table.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    some = rows.filter(F.size("held") > 0)
    held = some.select("row", F.inline("held"))
    verdicts = written(judged(held, counts).filter(F.col("digits") >= least_guesses), "judged")
    hits = held.join(verdicts, "value").groupBy("row").agg(
        F.collect_list(F.struct("start", "end", F.lit(KINDS.index("guess")).alias("kind"))).alias("more")
    )
    kept = rows.filter(F.size("held") == 0).select("id", F.col("base").alias("spans"))
    every = F.concat("base", F.coalesce("more", F.expr(f"cast(array() as array<{SPAN}>)")))
    order = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    back = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    more = some.join(hits, "row", "left").select("id", F.transform(F.array_sort(F.transform(every, order)), back).alias("spans"))
    return kept.unionAll(more).withColumnRenamed("id", id_col)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
