"""Quality rules whose cutoffs are learned: mergeable quantile sketches per language and source.

Counts of each whole text are taken once and stored.  Four whole-number measures follow from
them (``MEASURES``).  A sketch is a histogram over buckets that keep the leading ``BITS`` binary
digits of a value, so any quantile is right to one part in ``2**(BITS - 1)``; two sketches merge
by adding their counts.  One table holds the sketches of all groups of language and source, at
most some 1,300 rows a group and measure; those of a language, and of everything, are its
sums.  A group of fewer than ``LEAST`` documents takes the cutoffs of its language, and a
language of fewer those of all documents.

A cutoff is a fence: the 90th percentile, plus the larger of ``REACH`` times its distance from
the median and the measure's slack (the average word length has a lower fence too).  So what
most documents of a group do is never a reason to drop one.  Documents that fail the
fixed base rules are left out of the sketches and are not kept.

Hot groups: sketches are summed per task before the shuffle.  Cutoffs are joined to the
documents by broadcast up to ``BROADCAST_ROWS`` groups; beyond, those of groups with more than
a ten-thousandth of the documents (fewer than 10,000) are, and the others are shuffled.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; a null
language or source is a group of its own; rows with the same doc_id are judged one by one, equal
rows alike; a long text is read whole (some 100 bytes of memory a word); extra columns do not
disturb, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.common import BROADCAST_ROWS, keep, released

#: Leading binary digits of a value that its bucket keeps.
BITS = 7
#: Documents that a group needs for cutoffs of its own.
LEAST = 200
REACH = 3
MIDDLE, HIGH, LOW = 50, 90, 10  # percentiles
#: Each measure: numerator, denominator (in thousandths of it), slack of the fence, lower fence or not.
MEASURES = {
    "symbols": ("n_symbols", "n_words", 100, False),
    "dup_lines": ("n_dup_lines", "n_lines", 400, False),
    "repeats": ("n_repeat_words", "n_words", 300, False),
    "word_length": ("word_chars", "n_words", 500, True),
}
_LEAST_WORDS, _MOST_REPEATED = 50, 50  # base rules: words, and percent of them in repeated windows
_BLANKS, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
_GROUP_BYTES = 1 << 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _in_repeated(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text the words in 3-word windows that occur twice; equal ids only in one text."""
    n = len(ids)
    totals = np.zeros(len(sizes), np.int64)
    if n < 3:
        return totals
    ends = np.cumsum(sizes)
    inside = np.ones(n, bool)  # a window begins here
    for back in (1, 2):
        cut = ends - back
        inside[cut[(cut >= 0) & (sizes >= back)]] = False
    at = np.flatnonzero(inside[:n - 2])
    first, second, third = ids[at], ids[at + 1], ids[at + 2]
    if n < 1 << 21:
        code = (first << 42) | (second << 21) | third
    else:
        code = pd.factorize(first * n + second)[0].astype(np.int64) * n + third
    place = pd.factorize(code)[0]
    twice = at[np.bincount(place, minlength=1)[place] > 1] if len(place) else at
    covered = np.zeros(n + 2, np.int64)
    for step in range(3):
        covered[twice + step] = 1
    total = np.concatenate([[0], np.cumsum(covered[:n])])
    return total[ends] - total[ends - sizes]


def counted_texts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of whole texts, in order."""
    out = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
    at = 0
    while at < len(texts):
        begin, size = at, 0
        ids, sizes = [], []
        while at < len(texts) and size < _GROUP_BYTES:
            text = texts[at] or ""
            data = text.encode("utf-8", "surrogatepass")
            words = data.split()
            known: dict[bytes, int] = {}
            base = sum(sizes)
            ids.append(np.fromiter(map(known.setdefault, words, itertools.count(base)), np.int64, len(words)))
            sizes.append(len(words))
            lines = [x for x in data.split(b"\n") if x.strip()]
            out["n_lines"][at] = len(lines)
            out["n_dup_lines"][at] = len(lines) - len(set(lines))
            out["n_symbols"][at] = len(data) - len(data.translate(None, _SYMBOLS))
            out["word_chars"][at] = len(text) - (len(data) - len(data.translate(None, _BLANKS)))
            size += len(data)
            at += 1
        n = np.array(sizes, np.int64)
        out["n_words"][begin:at] = n
        out["n_repeat_words"][begin:at] = _in_repeated(np.concatenate(ids), n)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            counts = counted_texts(batch.column("text").to_pylist())
            kept = [batch.column(c) for c in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(counts[c]) for c in COUNTS)],
                                             ["doc_id", "lang", "source", *COUNTS])

    own = docs.select("doc_id", F.col("lang").cast("string").alias("lang"),
                      F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, lang string, source string, " + ", ".join(
        f"{c} long" for c in COUNTS)
    return own.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < _LEAST_WORDS) | (100 * F.col("n_repeat_words") > _MOST_REPEATED * F.col("n_words"))


def _value(measure: str) -> Column:
    over, under, _, _ = MEASURES[measure]
    return F.expr(f"1000 * {over} div greatest({under}, 1)")


def bucket(v: Column) -> Column:
    """The smallest value with the same leading BITS digits."""
    drop = F.greatest(F.lit(0), F.length(F.bin(v)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n of the documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(_value(m)).alias("bucket"))
                               for m in MEASURES]))
    rows = counts.where(~base_failed()).select("lang", "source", each.alias("m"))
    return rows.groupBy("lang", "source", F.col("m.measure").alias("measure"), F.col("m.bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches added up over everything but ``by``."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *by: str) -> DataFrame:
    """One row per group: n, and per measure its low, middle and high percentile."""
    group = W.partitionBy(*by, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = sketch.withColumns({"_upto": upto, "_all": F.sum("n").over(group)})
    out = []
    for m in MEASURES:
        own = F.col("measure") == m
        for p in (LOW, MIDDLE, HIGH):
            reached = own & (100 * F.col("_upto") >= p * F.col("_all"))
            out.append(F.min(F.when(reached, F.col("bucket"))).alias(f"{m}_{p}"))
    total = F.max("_all").alias("n_docs")
    return rows.groupBy(*by).agg(total, *out)


def cutoffs(counts: DataFrame) -> DataFrame:
    """One row per language and source: the rows, and a fence per measure."""
    sketch = keep(sketches(counts), "sketches")
    by_lang = keep(merged(sketch, "lang"), "sketches")
    own = quantiles(sketch, "lang", "source")
    lang = quantiles(by_lang, "lang")
    every = quantiles(merged(by_lang)).first()  # one row
    names = [c for c in own.columns if c not in ("lang", "source")]
    own = own.select("lang", "source", F.struct(*names).alias("own"))
    lang = lang.select(F.col("lang").alias("_lang"), F.struct(*names).alias("of_lang"))
    of_all = F.struct(*[F.lit(every[c] if every else None).cast("long").alias(c) for c in names])
    groups = counts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    t = groups.join(own.withColumnsRenamed({"lang": "_l", "source": "_s"}),
                    F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    t = t.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    used = F.when(F.col("own.n_docs") >= LEAST, F.col("own")).when(
        F.col("of_lang.n_docs") >= LEAST, F.col("of_lang")).otherwise(of_all)
    t = t.select("lang", "source", "rows", used.alias("q"))
    fences = []
    for m, (_, _, slack, below) in MEASURES.items():
        low, middle, high = (F.col(f"q.{m}_{p}") for p in (LOW, MIDDLE, HIGH))
        fences.append((high + F.greatest(F.lit(slack), REACH * (high - middle))).alias(f"{m}_most"))
        if below:
            fences.append((low - F.greatest(F.lit(slack), REACH * (middle - low))).alias(f"{m}_least"))
    return t.select("lang", "source", "rows", *fences)


def _within() -> Column:
    """True where every measure lies within its fences; no fence, no reason to drop."""
    ok = F.lit(True)
    for m, (_, _, _, below) in MEASURES.items():
        ok = ok & F.coalesce(_value(m) <= F.col(f"{m}_most"), F.lit(True))
        if below:
            ok = ok & F.coalesce(_value(m) >= F.col(f"{m}_least"), F.lit(True))
    return ok


def _joined(counts: DataFrame, fences: DataFrame, limit: int) -> DataFrame:
    """Each document with the fences of its group."""
    named = fences.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    if fences.count() <= limit:
        return counts.join(F.broadcast(named), same).drop("_lang", "_source", "rows")
    hot = 10_000 * F.col("rows") > F.lit(counts.count())  # fewer than 10,000 groups
    many, few = F.broadcast(named.where(hot)), named.where(~hot)
    return counts.join(many, same).unionByName(
        counts.join(many, same, "left_anti").join(few, same)).drop("_lang", "_source", "rows")


def judged(docs: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    counts = keep(measured(docs), "counts")
    fences = keep(cutoffs(counts), "cutoffs")
    out = _joined(counts, fences, limit)
    return out.select("doc_id", *COUNTS[:-1], base_failed().alias("base_failed"),
                      (~base_failed() & _within()).alias("kept"))


def _sql() -> str:
    ratios = ", ".join(f"1000 * {over} // greatest({under}, 1) AS {m}" for m, (over, under, _, _) in MEASURES.items())
    picks = ", ".join(f"min(bucket) FILTER (WHERE measure = '{m}' AND 100 * upto >= {p} * total) AS {m}_{p}"
                      for m in MEASURES for p in (LOW, MIDDLE, HIGH))
    names = [f"{m}_{p}" for m in MEASURES for p in (LOW, MIDDLE, HIGH)]
    levels = {"own": "lang, source", "of_lang": "lang", "of_all": ""}
    parts = []
    for name, by in levels.items():
        keys = f"{by}, " if by else ""
        parts.append(f"""{name}_n AS (SELECT {keys}measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
{name} AS (SELECT {keys}max(total) AS n_docs, {picks} FROM (
  SELECT *, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY {keys}measure) AS total FROM {name}_n) {f'GROUP BY {by}' if by else ''})""")
    chosen = ", ".join(f"CASE WHEN own.n_docs >= {LEAST} THEN own.{c} WHEN of_lang.n_docs >= {LEAST} "
                       f"THEN of_lang.{c} ELSE of_all.{c} END AS {c}" for c in names)
    tests = []
    for m, (_, _, slack, below) in MEASURES.items():
        lo, mid, hi = (f"{m}_{p}" for p in (LOW, MIDDLE, HIGH))
        tests.append(f"{m} <= {hi} + greatest({slack}, {REACH} * ({hi} - {mid}))")
        if below:
            tests.append(f"{m} >= {lo} - greatest({slack}, {REACH} * ({mid} - {lo}))")
    within = " AND ".join(f"coalesce({t}, true)" for t in tests)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
x AS (
  SELECT *, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
y AS (
  SELECT r, i, word, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, word, w2, w3) > 1 AS again FROM x),
z AS (
  SELECT r, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM y),
words AS (
  SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, count(*) FILTER (WHERE hit) AS n_repeat_words
  FROM z GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (
  SELECT d.r, doc_id, lang, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)),
m AS (
  SELECT *, n_words < {_LEAST_WORDS} OR 100 * n_repeat_words > {_MOST_REPEATED} * n_words AS base_failed, {ratios} FROM c),
u AS (UNPIVOT (SELECT r, lang, source, base_failed, {', '.join(MEASURES)} FROM m)
      ON {', '.join(MEASURES)} INTO NAME measure VALUE v),
sketch AS (
  SELECT lang, source, measure, (v >> s) << s AS bucket, count(*) AS n
  FROM (SELECT *, greatest(0, length(bin(v)) - {BITS}) AS s FROM u WHERE NOT base_failed) GROUP BY ALL),
{', '.join(parts)},
q AS (
  SELECT m.*, {chosen} FROM m
  LEFT JOIN own ON m.lang IS NOT DISTINCT FROM own.lang AND m.source IS NOT DISTINCT FROM own.source
  LEFT JOIN of_lang ON m.lang IS NOT DISTINCT FROM of_lang.lang CROSS JOIN of_all)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {within} AS kept
FROM q
"""


ORACLE_SQL = _sql()
