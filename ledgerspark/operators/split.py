"""Exact, reproducible, stratified splits.

Class quotas are exact.  Which rows of a class go where is decided by a seeded
hash of the row's id, so the choice does not depend on partitioning.  Rather
than ranking all rows of a class, the hash key at the quota's rank is found: one
pass counts the classes by cells that get finer towards the wanted shares, one
fetches the keys of a cell per quota.  The split itself is then a comparison on the
row, with no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.ordered import cell, cells_of_ranks, hash_key, keys_in_cells, refuse_ties, with_rank
from ledgerspark.sources.scratch import materialize
from ledgerspark.sources.small import small_table

# Quotas of up to so many classes are planned on the driver, of more in a table.
LOCAL_CLASSES = 10_000
SPLIT = "split"


def class_table(df: DataFrame, label: str) -> DataFrame:
    """Stored rows per class (label, n); missing labels are refused."""
    return _checked(materialize(df.groupBy(F.col(f"`{label}`").alias("label")).agg(
        F.count(F.lit(1)).alias("n")), "classes"), label)


def _checked(counts: DataFrame, label: str) -> DataFrame:
    gap = F.col("label").isNull()
    if isinstance(counts.schema["label"].dataType, (T.FloatType, T.DoubleType)):
        gap = gap | F.isnan("label")
    missing = counts.where(gap).agg(F.sum("n")).first()[0]
    if missing:
        raise ValueError(f"'{label}' has {missing} missing values")
    return counts


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, for labels whose classes a model can tell apart."""
    return _local(class_table(df, label))


def _local(classes: DataFrame) -> dict:
    return dict(sorted((r["label"], r["n"]) for r in classes.collect()))


def quotas(counts: dict, size: int) -> dict:
    """Shares of ``size`` per class: floors plus largest remainders.

    Remainders that tie go to the smaller label.
    """
    total = sum(counts.values())
    # Whole-number arithmetic: a rounded share must not decide a tie.
    out = {k: n * size // total for k, n in counts.items()}
    rest = {k: n * size % total for k, n in counts.items()}
    left = size - sum(out.values())
    for k in sorted(counts, key=lambda k: (-rest[k], k))[:left]:
        out[k] += 1
    return out


def _held_out(counts: dict, share: float) -> dict:
    """Quota per class of a held-out part; the same refusals as the original."""
    size = _held_size(sum(counts.values()), len(counts), min(counts.values(), default=0), share)
    return quotas(counts, size)


def _held_size(total: int, classes: int, least: int, share: float) -> int:
    size = math.ceil(share * total)
    if least < 2:
        raise ValueError("The least populated class has fewer than 2 members")
    if size < classes or total - size < classes:
        raise ValueError(
            f"A split into {total - size} and {size} rows cannot hold {classes} classes"
        )
    return size


def _check_sizes(test_size: float, valid_size: float) -> None:
    if test_size <= 0 or valid_size < 0 or test_size + valid_size >= 1:
        raise ValueError(
            f"Unusable split sizes: test {test_size}, validation {valid_size}"
        )


def plan_split(counts: dict, test_size: float, valid_size: float) -> dict:
    """Per class: (test rows, validation rows).  The rest is for training."""
    _check_sizes(test_size, valid_size)
    if valid_size == 0:
        return {k: (n, 0) for k, n in _held_out(counts, test_size).items()}
    held = _held_out(counts, test_size + valid_size)
    test = _held_out(held, test_size / (test_size + valid_size))
    return {k: (test[k], held[k] - test[k]) for k in counts}


def assign_split(df: DataFrame, label: str, id_col, *, test_size: float = 0.2,
                 valid_size: float = 0.2, seed: int = 42,
                 local_classes: int = LOCAL_CLASSES) -> DataFrame:
    """Append ``split``: train, valid or test.

    ``id_col`` is one column or a list that tells the rows apart.  Any number of classes;
    ``local_classes`` only says from how many on quotas are planned in tables.

    One pass over label and id counts each class by cells around the wanted shares, a
    second one fetches the keys of one cell per quota; both give counters or keys per class,
    and the driver sees at most a row per class.
    """
    _check_sizes(test_size, valid_size)
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    shares = [test_size, test_size + valid_size] if valid_size else [test_size]
    cells = [f"c{i}" for i in range(len(shares))]
    key = hash_key(seed, ids)
    keyed = df.select(F.col(f"`{label}`").alias("label"), key.alias("key"))
    keyed = keyed.select("label", "key", *[cell(F.col("key"), s).alias(c) for s, c in zip(shares, cells)])
    counts = materialize(keyed.groupBy("label", *cells).agg(F.count(F.lit(1)).alias("n")), "cells")
    classes = _checked(materialize(counts.groupBy("label").agg(F.sum("n").alias("n")), "classes"), label)
    n = classes.count()
    if n <= local_classes:
        plan = plan_split(_local(classes), test_size, valid_size)
        schema = T.StructType([df.schema[label], *(T.StructField(c, T.LongType()) for c in ("test", "held"))])
        quota = small_table(df.sparkSession, [(k, t, t + v) for k, (t, v) in plan.items()], schema)
        quota = quota.withColumnRenamed(label, "label")
    else:
        quota = _plan_table(classes, test_size, valid_size).select("label", "test", "held")
    ranks = quota.select("label", F.explode(F.array(
        *[F.struct(F.lit(i).alias("slot"), F.col(c).alias("rank")) for i, c in enumerate(("test", "held")[:len(shares)])]
    )).alias("r")).select("label", "r.slot", "r.rank")
    wanted = materialize(cells_of_ranks(counts, ranks, ["label"], cells), "cells")
    few = n <= local_classes
    keys = keys_in_cells(keyed, F.broadcast(wanted) if few else wanted, ["label", *cells])
    at = [F.max(F.when(F.col("slot") == i, F.col("key"))) for i in range(len(shares))]
    cuts = materialize(classes.join(keys, "label", "left").groupBy("label").agg(
        F.max("n").alias("_n"), F.bool_or("tied").alias("_tied"), F.coalesce(at[0], F.lit("")).alias("_test"),
        F.coalesce(at[-1], F.lit("")).alias("_valid")).withColumnRenamed("label", "_label"), "cuts")
    refuse_ties(cuts.agg(F.bool_or("_tied")).first()[0])
    return _cut(df, label, key, cuts.drop("_tied"), few, local_classes)


def _cut(df: DataFrame, label: str, key: Column, cuts: DataFrame, few: bool, big_classes: int) -> DataFrame:
    """The rows with their split, by the last keys of their class; classes that are many are joined
    by a shuffle, but for those with more than 1 / ``big_classes`` of the rows."""
    keyed = df.withColumns({"_label": F.col(f"`{label}`"), "_key": key})
    if few:
        marked = keyed.join(F.broadcast(cuts), "_label", "left")  # one row per class
    else:
        large = F.col("_n") * F.lit(big_classes) > F.lit(cuts.agg(F.sum("_n")).first()[0])
        many = F.broadcast(cuts.where(large))  # fewer than ``big_classes`` rows
        rest = keyed.join(many.select("_label"), "_label", "left_anti")
        marked = keyed.join(many, "_label").unionByName(rest.join(cuts.where(~large), "_label", "left"))
    # A label without a cut cannot occur unless the input changed meanwhile.
    known = F.when(F.col("_test").isNull(), F.raise_error(F.lit("A class was not counted")))
    return marked.withColumn(
        SPLIT,
        F.when(F.col("_test").isNull(), known.cast("string"))
        .when(F.col("_key") <= F.col("_test"), "test")
        .when(F.col("_key") <= F.col("_valid"), "valid")
        .otherwise("train"),
    ).select(*[f"`{c}`" for c in df.columns if c != SPLIT], SPLIT)


def _quota_table(classes: DataFrame, size: int, total: int, out: str) -> DataFrame:
    """``quotas`` for a table of classes (label, n): one more column, stored."""
    big = "decimal(38,0)"
    parts = classes.withColumn("_product", F.col("n").cast(big) * F.lit(size).cast(big)).withColumns({
        "_floor": F.expr(f"CAST(_product div {total} AS BIGINT)"),
        "_rest": F.expr(f"CAST(_product % {total} AS BIGINT)")})
    parts = materialize(parts.withColumn("_turn", -F.col("_rest")).drop("_product"), "quotas")
    left = size - parts.agg(F.sum("_floor")).first()[0]
    ranked = with_rank(parts, ["_turn", "label"], "_place")
    return materialize(ranked.withColumn(
        out, F.col("_floor") + F.when(F.col("_place") < left, 1).otherwise(0)).select(*classes.columns, out), "quotas")


def _plan_table(classes: DataFrame, test_size: float, valid_size: float) -> DataFrame:
    """Quotas for any number of classes, as a stored table: label, n, held, test."""
    share = test_size + valid_size
    row = classes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    size = _held_size(row["n"], row["k"], row["least"], share)
    held = _quota_table(classes, size, row["n"], "held")
    if not valid_size:
        return held.withColumn("test", F.col("held"))
    inner = held.select("label", F.col("held").alias("n"))
    row = inner.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    size = _held_size(row["n"], row["k"], row["least"], test_size / share)
    tested = _quota_table(inner, size, row["n"], "test").select("label", "test")
    return materialize(held.join(tested, "label"), "plan")


def split_tables(df: DataFrame, label: str, id_col, *, test_size: float = 0.2,
                 valid_size: float = 0.2, seed: int = 42):
    """(train, valid, test); valid is None if its size is 0."""
    marked = assign_split(df, label, id_col, test_size=test_size,
                          valid_size=valid_size, seed=seed)

    def part(name: str) -> DataFrame:
        return marked.where(F.col(SPLIT) == name).drop(SPLIT)

    return part("train"), part("valid") if valid_size > 0 else None, part("test")


def split_by_conf(df: DataFrame, conf: dict, id_col) -> DataFrame:
    """``assign_split`` with sizes, seed and label from a configuration."""
    cfg = conf.get("data_split", {})
    return assign_split(
        df, conf["target"], id_col,
        test_size=cfg.get("test_size", 0.2),
        valid_size=cfg.get("valid_size", 0.2),
        seed=cfg.get("random_state", 42),
    )
