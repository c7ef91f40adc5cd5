"""Running totals and ranks of large groups, cut into buckets so that no task orders a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def buckets_for(rows: int) -> int:
    """How many buckets: as many as a bucket then has rows, so both grow with the root of the rows."""
    return max(1, int(rows**0.5))


def running_total(rows: DataFrame, keys: list[str], bucket: Column, order: list, amount: Column | None, out: str) -> DataFrame:
    """rows with `out`: the sum of `amount` (or the number of rows) before each row of its group, in the given order.

    `bucket` must not fall along the order. Bucket totals, few rows, are added up along the group; rows are ordered
    inside their bucket alone. Rows that are equal in the order take their places in any order. Null keys are groups.
    """
    amount = F.lit(1) if amount is None else amount
    cut = rows.withColumn("__bucket", bucket)
    along = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "__bucket").agg(F.sum(amount).alias("__total"))
    names = [f"__key{k}" for k in range(len(keys))]
    starts = totals.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col("__bucket").alias("__from"), F.coalesce(F.sum("__total").over(along), F.lit(0)).alias("__start"))
    same = F.col("__bucket").eqNullSafe(F.col("__from"))
    for k, n in zip(keys, names):
        same &= F.col(k).eqNullSafe(F.col(n))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(starts, same).withColumn(out, F.col("__start") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).drop("__bucket", "__from", "__start", *names)


def numbered(rows: DataFrame, keys: list[str], draw: Column, tie: list[str], out: str, count: int | None = None) -> DataFrame:
    """rows with `out`, their number from 0 in their group, in the order of a uniform draw in [0, 1), ties by `tie`."""
    n = buckets_for(rows.count() if count is None else count)
    drawn = rows.withColumn("__u", draw)
    return running_total(drawn, keys, F.floor(F.col("__u") * n), ["__u", *tie], None, out).drop("__u")


def _same(keys: list[str], names: list[str]) -> Column:
    """The condition that keys equal their renamed copies, nulls included."""
    out = F.lit(True)
    for k, n in zip(keys, names):
        out &= F.col(k).eqNullSafe(F.col(n))
    return out


def handed_on(rows: DataFrame, keys: list[str], order: list[str], bucket: Column | None, **wanted: tuple[str, Column]) -> DataFrame:
    """rows with running values over the rows of their group before them, or from the row behind them, in an order.

    wanted: name=(kind, value), kind "max" or "sum" of the values before, "last" for the value of the row before, "next"
    for that of the row behind; null where there is none (sum: 0). `bucket` must not fall along the order. Rows are
    ordered inside their bucket; what a bucket hands on is found on a table of a row for each bucket, so no task orders
    a whole group. Without a bucket, for groups that are known to be small, they are ordered whole.
    """
    if bucket is None:
        whole = Window.partitionBy(*keys).orderBy(*order)
        before = whole.rowsBetween(Window.unboundedPreceding, -1)
        plain = {"max": lambda v: F.max(v).over(before), "sum": lambda v: F.coalesce(F.sum(v).over(before), F.lit(0)), "last": lambda v: F.lag(v).over(whole), "next": lambda v: F.lead(v).over(whole)}
        return rows.select(*(F.col(c) for c in rows.columns), *(plain[kind](v).alias(n) for n, (kind, v) in wanted.items()))
    place = F.struct(*order)
    summaries = {"max": F.max, "sum": F.sum, "last": lambda v: F.max_by(F.struct(v), place), "next": lambda v: F.min_by(F.struct(v), place)}
    cut = rows.withColumn("__bucket", bucket)
    along = Window.partitionBy(*keys).orderBy("__bucket")
    above = along.rowsBetween(Window.unboundedPreceding, -1)
    given = {"max": lambda c: F.max(c).over(above), "sum": lambda c: F.sum(c).over(above), "last": lambda c: F.lag(c).over(along), "next": lambda c: F.lead(c).over(along)}
    totals = cut.groupBy(*keys, "__bucket").agg(*(summaries[kind](v.alias("v")).alias(f"__{n}") for n, (kind, v) in wanted.items()))
    names = [f"__key{k}" for k in range(len(keys))]
    starts = totals.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col("__bucket").alias("__from"), *(given[kind](f"__{n}").alias(f"__{n}") for n, (kind, _) in wanted.items()))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    def told(name: str, kind: str, v: Column) -> Column:
        handed = F.col(f"__{name}")
        if kind == "max":
            return F.greatest(F.max(v).over(before), handed)
        if kind == "sum":
            return F.coalesce(F.sum(v).over(before), F.lit(0)) + F.coalesce(handed, F.lit(0))
        near = F.lag if kind == "last" else F.lead
        return F.coalesce(near(F.struct(v.alias("v"))).over(inside), handed)["v"]

    out = cut.join(starts, _same([*keys, "__bucket"], [*names, "__from"]))
    return out.select(*(F.col(c) for c in rows.columns), *(told(n, kind, v).alias(n) for n, (kind, v) in wanted.items()))
