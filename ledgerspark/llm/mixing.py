"""Mix sources to target weights: whole copies plus one drawn copy per document.

Sources in code-point order, null last, take the weights 1, 2, 3, 1, ... and share all
words by them.  A target stops at ``MOST`` times its source's size and the excess is
shared again by weight; that is the level at which ``sum(min(cap, weight * level))``
equals all words, found in one sorted pass over the sources.

A document of a source with rate r is given floor(r) times, and once more when a number
in [0, 1) made from the seed and its doc_id is below the fraction of r.  So reruns agree,
and no task needs to know any other row.

Only DataFrame functions: words are counted once per row, one row per source is
aggregated (partly before the shuffle, so a hot source costs one row per task), and the
targets, whose number is that of the sources, are joined back.

Defined cases: a null or empty text has size 0; a null source is a source; rows with the
same doc_id draw alike; a source of size 0 has target 0 and keeps each document once; an
empty table gives an empty one.  ``mixture`` keeps every column as it is, whatever its name;
``mix`` replaces columns named like its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.common import join_small, keep, word_counts

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
_DIGITS = 13  # hex digits of the draw: 52 bits, exact in a double


def draw(id_col: str, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    part = F.substring(F.md5(text.cast("binary")), 1, _DIGITS)
    return F.conv(part, 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source of a frame with ``source`` and ``size``.

    The two windows run over one row per source, not over documents.
    """
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((rank - 1) % len(weights) + 1).cast("int")).cast("long")
    t = totals.select("source", "source_size", rank.alias("_rank"), weight.alias("_weight"))
    t = t.withColumn("_cap", F.col("source_size") * most)
    order = W.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # In this order the filled sources come first, and the level is highest right after them.
    every = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rest = F.sum("_weight").over(every) - F.coalesce(
        F.sum("_weight").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(every) - before).cast("double") / rest.cast("double")
    t = t.withColumn("_level", level).withColumn("_level", F.max("_level").over(every))
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_level"))
    return t.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", seed: str = SEED, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The frame with source_size, target and copies; needs ``id_col``, ``source`` and ``size``."""
    targets = keep(source_targets(docs.select("source", "size"), weights, most), "targets")
    targets = targets.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    extra = (draw(id_col, seed) < rate - F.floor(rate)).cast("long")
    out = join_small(docs.drop("source_size", "target", "copies"), targets,
                     F.col("source").eqNullSafe(F.col("_source")))
    return out.withColumn("copies", F.floor(rate) + extra).drop("_source")


def mixture(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed corpus: each document as often as its rate says, in the columns of ``docs``."""
    own = [f"_c{i}" for i in range(len(docs.columns))]  # whatever the documents' columns are called
    renamed = docs.toDF(*own)
    place = dict(zip(docs.columns, own))
    sized = renamed.withColumns({"doc_id": F.col(place["doc_id"]), "source": F.col(place["source"]),
                                 "size": word_counts(place["text"])})
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    out = mix(sized, seed=seed, weights=weights, most=most).where("copies > 0")
    return out.withColumn("_copy", times).select(*own).toDF(*docs.columns)


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each document."""
    sized = keep(docs.select("doc_id", "source", word_counts().alias("size")), "sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target",
                             (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
t AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST) AS k FROM t),
lv AS (
  SELECT max((total - before)::DOUBLE / (weights - passed)::DOUBLE) AS level FROM (
    SELECT sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
           coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
    FROM o)),
r AS (
  SELECT source, source_size, least(cap::DOUBLE, w * level) AS target,
         CASE WHEN source_size > 0 THEN least(cap::DOUBLE, w * level) / source_size ELSE 1.0 END AS rate
  FROM o, lv)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (floor(rate) + CASE WHEN
          ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
          < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
