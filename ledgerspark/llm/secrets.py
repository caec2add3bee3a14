"""Secrets in whole texts: fixed patterns, and windows of high character entropy.

Three base patterns give ``assign``, ``access`` and ``hex`` spans.  The method adds
``entropy`` spans: a candidate is a run of at least ``WINDOW`` characters of base64 text;
a window of ``WINDOW`` characters slides over it while counts per character, and with
them the sum of c * log2(c), are kept up to date by one step each.  A window counts as
secret when its entropy reaches the bound of the candidate's character class (``BOUNDS``);
one such window makes the whole candidate a span.

Suppressed by the allow list: candidates without a letter, UUIDs, file paths and names of
words with numbers at their ends (``of_words``), and every string that the caller allows.  A span that lies within a base span is left out; base spans always stay.

Positions are code points, ends exclusive.  Spans are ordered by start, then by kind in
the order of ``KINDS``.

Defined cases: a null text is an empty one and has no spans; equal rows get equal spans;
texts are read whole; extra columns are carried along, a column named ``spans`` is
replaced; an empty table gives an empty one.  Documents are handled one by one inside
their partition: nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import released

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: Bits per character that a window must reach; 20 characters can hold 4.32.
BOUNDS = {"hex": 2.8, "one_case": 3.2, "mixed": 3.4}
MASK = "[secret]"

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGNED, ACCESS_LENGTH = 6, 20

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{%d,}" % WINDOW)
ALLOWED = re.compile(
    r"[^A-Za-z]*"  # no letter
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")  # UUID
CUT = re.compile(r"[-_/=+]+")
SEGMENT = re.compile(r"[0-9]{0,6}[A-Za-z]+(?:[0-9]{1,6}[A-Za-z]{3,})*[0-9]{0,6}|[0-9]{1,8}")
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Letters per thousand of running text (English, German and French together).
LETTERS = dict(zip("abcdefghijklmnopqrstuvwxyz", (
    75, 17, 30, 42, 150, 16, 22, 40, 75, 3, 9, 45, 28, 80, 55, 22, 5, 67, 70, 70, 47, 14, 14, 3, 10, 8)))
LIKELY = {c: math.log2(26 * n / sum(LETTERS.values())) for c, n in LETTERS.items()}
ONE_SOUND = re.compile("sch|[cpst]h|ck|ng|pf|tz|st")
UNSPEAKABLE = re.compile("[^aeiouy]{6}|[aeiouy]{6}")
IN_WORDS = 0.8  # share of letters that stand in pieces of three and more

Span = tuple[int, int, int]  # start, place of the kind, end


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def character_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "mixed" if re.search("[a-z]", s) and re.search("[A-Z]", s) else "one_case"


def entropy_windows(s: str, window: int = WINDOW) -> Iterator[tuple[int, float, int]]:
    """Start, entropy and letter-digit changes of every window, each from the one before."""
    counts: dict[str, int] = {}
    log = [0.0, 0.0, *(c * math.log2(c) for c in range(2, window + 2))]  # a step adds before it takes away
    digit = [c.isdigit() for c in s]
    turn = [i > 0 and s[i].isalnum() and s[i - 1].isalnum() and digit[i] != digit[i - 1] for i in range(len(s))]
    total, changes = 0.0, 0
    for i, c in enumerate(s):
        k = counts.get(c, 0)
        counts[c] = k + 1
        total += log[k + 1] - log[k]
        if i >= window:
            old = s[i - window]
            k = counts[old]
            counts[old] = k - 1
            total += log[k - 1] - log[k]
            changes -= turn[i - window + 1]
        changes += turn[i] if i else 0
        if i >= window - 1:
            yield i - window + 1, math.log2(window) - total / window, changes


def of_words(s: str) -> bool:
    """Whether words, by their case, their letters and the runs of vowels and others, make up the string."""
    letters, held, likely = 0, 0, 0.0
    for segment in CUT.split(s):
        if not segment:
            continue
        if not SEGMENT.fullmatch(segment):
            return False
        pieces = CAMEL.findall(segment)
        n = sum(map(len, pieces))
        letters += n
        held += n if n <= 2 else sum(len(p) for p in pieces if len(p) > 2)
        for p in pieces:
            low = p.lower()
            likely += sum(map(LIKELY.__getitem__, low))
            if UNSPEAKABLE.search(ONE_SOUND.sub("t", low)):
                return False
    return held >= IN_WORDS * letters and likely > 0


def entropy_spans(text: str, allowed: frozenset[str] = frozenset()) -> list[Span]:
    found = []
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if s in allowed or ALLOWED.fullmatch(s) or of_words(s):
            continue
        bound = BOUNDS[character_class(s)]
        if any(bits >= bound for _, bits, _ in entropy_windows(s)):
            found.append((m.start(), 3, m.end()))
    return found


def spans(text: str | None, allowed: frozenset[str] = frozenset()) -> list[Span]:
    if not text:
        return []
    base = base_spans(text)
    more = [s for s in entropy_spans(text, allowed) if not any(b[0] <= s[0] and s[2] <= b[2] for b in base)]
    return sorted(base + more)


def masked(text: str, found: list[Span], mask: str = MASK) -> str:
    """The text with each stretch of spans that touch or overlap replaced once."""
    out, at = [], 0
    for start, _, end in found:
        if start > at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                   T.StructField("end", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, text: str = "text", allowed: frozenset[str] = frozenset()) -> DataFrame:
    """The frame with ``spans``: array of (kind, start, end)."""
    docs = docs.drop("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t.as_py(), allowed)]
                     for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW)], [*batch.schema.names, "spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("spans", _SPANS)]))


def redact(docs: DataFrame, text: str = "text", mask: str = MASK, allowed: frozenset[str] = frozenset()) -> DataFrame:
    """The same rows and columns, secrets replaced by ``mask``; null texts stay null."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            clean = [None if (t := v.as_py()) is None else masked(t, found, mask) if (found := spans(t, allowed)) else t
                     for v in batch.column(place)]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (as text), n_entropy."""
    found = find(docs.select("doc_id", "text")).drop("text")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = listed(F.filter("spans", lambda s: s["kind"] != "entropy"))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count("entropy").alias("n_entropy"))
