"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition only when both join inputs are plain shuffle
stages. Joins against a one-row-per-key aggregate (client totals,
collateral values) do not qualify: the aggregate's own shuffle already
partitions that side. For those joins the hot keys are split explicitly:

1. Keys whose row count on the large side exceeds ``rows_per_task`` are hot.
   There are at most ``rows(large) / rows_per_task`` of them, which bounds the
   broadcast list.
2. The large side's rows of a hot key are spread over
   ``ceil(count / rows_per_task)`` salts (a hash of the row's id columns);
   other keys take salt 0.
3. The one-row-per-key side repeats each hot key's row once per salt.
4. The large side is hash-partitioned on (key, salt) and the join runs on
   (key, salt): every large-side row meets exactly one copy of its partner
   row, so the result equals the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000

SALT = "_salt"
SALTS = "_salts"
COUNT = "_n"


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key (a key-only aggregate, combined map-side). Counting on a
    superset of the join's large side gives an upper bound, which is all the
    salting needs."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))


def hot_keys(counts: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(keys..., _salts) for the keys whose large-side count (column ``_n``)
    needs more than one task."""
    n_salts = F.ceil(F.col(COUNT) / F.lit(rows_per_task)).cast("int")
    hot = F.col(COUNT) > rows_per_task
    for k in keys:          # a NULL key never joins
        hot = hot & F.col(k).isNotNull()
    return counts.where(hot).select(*keys, n_salts.alias(SALTS))


def split_hot_keys(large: DataFrame, per_key: DataFrame, keys: list[str], how: str,
                   id_cols: list[str], counts: DataFrame | None = None,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``large.join(per_key, keys, how)`` with hot keys split over salts.

    ``per_key`` holds at most one row per key. ``counts`` (keys..., ``_n``)
    gives the large side's rows per key when already known; otherwise it is
    computed (a key-only aggregate, combined map-side). ``id_cols`` identify
    a large-side row well enough to spread a hot key's rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_hot_keys supports inner and left joins")
    if counts is None:
        counts = key_counts(large, keys)
    # At most rows(large) / rows_per_task keys: a few thousand short rows at
    # any size this is run at, which is the proof for the broadcast.
    hot = F.broadcast(hot_keys(counts, keys, rows_per_task))
    salt = F.when(F.col(SALTS).isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in id_cols]), F.col(SALTS)).cast("int"))
    # Partition explicitly on (key, salt): the join itself may reuse an
    # existing partitioning on the key alone (co-partitioned composite joins
    # are allowed, see session.py), which would put every salt of a hot key
    # back into one task.
    big = (large.join(hot, keys, "left").withColumn(SALT, salt).drop(SALTS)
           .repartition(*[F.col(k) for k in keys], F.col(SALT)))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))
    small = per_key.join(hot, keys, "left").withColumn(SALT, copies).drop(SALTS)
    return big.join(small, keys + [SALT], how).drop(SALT)
