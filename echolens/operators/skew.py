"""Joins and rankings that hold when one key carries a large share of all rows.

Spark's AQE splits skewed partitions only when both join inputs are plain
shuffles. Here one side is usually an aggregate, so its partitioning is reused
and AQE leaves the hot partition whole. These helpers spread such keys
explicitly; results never depend on which path a key takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the fact rows, so there
# are never more than 1 / HOT_SHARE hot keys: that bounds every broadcast made
# here, whatever the data size.
HOT_SHARE = 1e-4
SALTS = 256
# Above this the optimizer no longer cuts ranked groups before the shuffle.
GROUP_LIMIT_MAX = 1000


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    weight: str | None = None,
    hot_share: float = HOT_SHARE,
    spread: Sequence[str] | None = None,
    probe: bool = False,
) -> DataFrame:
    """Join a large table to a table with one row per key.

    Keys holding more than ``hot_share`` of the fact rows are looked up through
    a broadcast (bounded by ``1 / hot_share`` rows); their fact rows are then
    scattered by a salt, so no task receives a hot group. All other keys use an
    ordinary shuffle join.

    ``weight`` names a column of ``dim`` that counts the fact rows per key, or
    grows with them; without it the keys are counted first, which reads ``fact``
    twice. ``spread`` names fact columns
    that vary inside a hot group. ``how`` is left, inner, semi or anti.

    ``probe`` counts the rows of a ``dim`` that is cheap to read, ``1 / hot_share`` of
    them at most and one: one with no more rows than there may be hot keys is broadcast
    whole, so that neither the fact rows nor their keys are shuffled.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if probe:
        most = int(1 / hot_share)
        if dim.limit(most + 1).count() <= most:
            kind = {"left": "left", "inner": "inner", "semi": "left_semi", "anti": "left_anti"}[how]
            small = dim if weight is None or how in ("semi", "anti") else dim.drop(weight)
            joined = fact.join(F.broadcast(small), keys, kind)
            values = [c for c in small.columns if c not in keys]
            return joined.select(*fact.columns, *(values if how in ("left", "inner") else []))
    values = [c for c in dim.columns if c not in keys and c != weight]
    payload = F.struct(F.lit(1).alias("_hit"), *[F.col(v) for v in values])
    packed = dim.select(*keys, payload.alias("_dim"))
    if weight is None:
        load = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        limit = load.agg(F.sum("_rows") * hot_share).scalar()
        hot_keys = load.filter(F.col("_rows") > limit).select(*keys)
        hot = packed.join(F.broadcast(hot_keys), keys, "left_semi")
    else:
        limit = dim.agg(F.sum(weight) * hot_share).scalar()
        hot = dim.filter(F.col(weight) > limit).select(*keys, payload.alias("_dim"))
    hot = hot.withColumnRenamed("_dim", "_hot")

    spread_by = [F.col(c) for c in (spread or fact.columns)]
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)) + 1
    # null keys match nothing; they are scattered like hot ones
    to_shuffle = F.col("_hot").isNull()
    for key in keys:
        to_shuffle = to_shuffle & F.col(key).isNotNull()
    marked = fact.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(to_shuffle, F.lit(0).cast("bigint")).otherwise(salt)
    )
    cold = packed.withColumn("_salt", F.lit(0).cast("bigint"))
    joined = marked.join(cold, [*keys, "_salt"], "left").withColumn(
        "_found", F.coalesce("_hot", "_dim")
    )
    if how == "anti":
        return joined.filter(F.col("_found").isNull()).select(*fact.columns)
    if how in ("inner", "semi"):
        joined = joined.filter(F.col("_found").isNotNull())
    if how == "semi":
        return joined.select(*fact.columns)
    return joined.select(*fact.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """First ``k`` rows per group with their rank, exact for any skew.

    Up to ``GROUP_LIMIT_MAX`` the optimizer cuts each task's groups to ``k``
    rows before the shuffle (WindowGroupLimit), so a hot group arrives as
    tasks x k rows. A larger ``k`` first ranks salted sub-groups: a row outside
    the first k of its sub-group cannot be among the first k of the group.
    """
    if k > GROUP_LIMIT_MAX:
        by = [F.col(c) for c in (spread or df.columns)]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
        inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            salted.withColumn(rank, F.row_number().over(inner))
            .filter(F.col(rank) <= k)
            .drop("_salt", rank)
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of the whole table: per-task heaps, then one small merge."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def first_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Top ``k`` per group, or of the table when no group keys are given."""
    if by:
        return top_per_group(df, by, order, k, rank)
    return top_rows(df, order, k, rank)
