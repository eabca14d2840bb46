"""Left lookup joins that stay balanced when a few keys hold most rows.

A shuffle join sends every row of a key to one task, so a customer or
product holding a third of all orders would make one task do a third of the
work.  ``left_lookup`` guards against that in one of two ways.

By default (``hot=None``) the lookup side is rebalanced first.  A lookup
table that comes straight out of its own dedup aggregate is already
hash-partitioned on the key, and a join reusing that partitioning leaves
AQE nothing to act on; with the rebalance both join inputs get a shuffle of
their own, so AQE measures the lookup side (broadcast when it is small) and
splits any oversized partition of ``df`` into several tasks (skew join).
The extra shuffle moves only the lookup table, which is much smaller than
the orders.

With ``hot`` (from ``hot_keys``), such keys are salted instead, which does
not depend on AQE:

1. hot keys: keys holding more than ``hot_share`` of the rows, from a
   partial-then-final count per key and a scalar subquery for the total.
   At most ``1 / hot_share`` keys can pass, which bounds the set, so it is
   broadcast;
2. a row of a hot key, or of none (it matches nothing), gets a salt, a hash of the whole row modulo the
   number of shuffle partitions; every other row gets salt 0;
3. the lookup rows of hot keys are repeated once per salt value (at most
   ``1 / hot_share`` rows times the partition count), the others once;
4. the join runs on (key, salt), so a hot key is spread over all shuffle
   partitions.  The salt is a pure function of the row, so a re-executed
   task routes every row the same way.

The result equals a plain left join whenever the lookup side has at most one
row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_SHARE = 0.01
LEAST_HOT_SHARE = 0.0001  # bounds the broadcast hot set to 10,000 keys
_COUNT = "__rows"
_HOT = "__hot"
SALT = "__salt"


def _checked(hot_share: float) -> float:
    if not LEAST_HOT_SHARE <= hot_share <= 1:
        raise ValueError(f"hot_share must be from {LEAST_HOT_SHARE} to 1, not {hot_share}")
    return hot_share


def hot_keys(df: DataFrame, key: str, hot_share: float = DEFAULT_HOT_SHARE) -> DataFrame:
    """Keys of ``df`` holding more than ``hot_share`` of its rows (at most
    ``1 / hot_share`` of them), as a one-column frame named ``key``."""
    _checked(hot_share)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(_COUNT))
    total = counts.agg(F.sum(_COUNT)).scalar()
    return counts.where(F.col(_COUNT) > total * F.lit(hot_share)).select(key)


def hot_keys_of_columns(df: DataFrame, keys: list[str],
                        hot_share: float = DEFAULT_HOT_SHARE) -> dict[str, DataFrame]:
    """``hot_keys`` for several key columns from one pass over ``df``: a
    grouping-sets aggregate counts the rows per value of each column, and each
    column's hot set is read from that one aggregate (at most
    ``1 / hot_share`` keys per column)."""
    _checked(hot_share)
    sets = [[k] for k in keys]
    counts = (df.select(*keys)
                .groupingSets(sets, *keys)
                .agg(F.count(F.lit(1)).alias(_COUNT), F.grouping_id().alias("__set")))
    out = {}
    for i, key in enumerate(keys):
        # grouping_id has a bit per key, set when the key is aggregated away
        set_id = (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        per_key = counts.where((F.col("__set") == set_id) & F.col(key).isNotNull())
        total = per_key.agg(F.sum(_COUNT)).scalar()
        out[key] = per_key.where(F.col(_COUNT) > total * F.lit(hot_share)).select(key)
    return out


def _flags(hot: DataFrame, key: str) -> DataFrame:
    return F.broadcast(hot.select(key, F.lit(True).alias(_HOT)))


def salted_rows(df: DataFrame, key: str, hot: DataFrame, salts: int) -> DataFrame:
    """``df`` with a salt below ``salts``: a hash of the row for a hot key or none, else 0."""
    cols = df.columns
    return (df.join(_flags(hot, key), on=key, how="left")
              .withColumn(SALT, F.when(F.col(_HOT) | F.col(key).isNull(),
                                       F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
                                 .otherwise(F.lit(0).cast("long")))
              .drop(_HOT))


def salted_side(side: DataFrame, key: str, hot: DataFrame, salts: int) -> DataFrame:
    """``side`` with every salt once for a hot key, and salt 0 for any other."""
    every = F.when(F.col(_HOT), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    return (side.join(_flags(hot, key), on=key, how="left")
                .withColumn(SALT, F.explode(F.coalesce(every, F.array(F.lit(0).cast("long")))))
                .drop(_HOT))


def left_lookup(df: DataFrame, side: DataFrame, key: str, hot: DataFrame | None = None,
                buckets: int | None = None, rebalance: bool = True) -> DataFrame:
    """``df`` left-joined with ``side`` on ``key`` (``side`` unique per key),
    salting the keys listed in ``hot`` (see ``hot_keys``); with ``hot=None``
    a plain join against the side, rebalanced first unless ``rebalance`` is
    off (a side read from files gets its own shuffle anyway)."""
    if hot is None:
        return df.join(side.hint("rebalance") if rebalance else side, on=key, how="left")
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    joined = salted_rows(df, key, hot, buckets).join(salted_side(side, key, hot, buckets), on=[key, SALT], how="left")
    # same column order as the plain join: key, df's columns, side's columns
    return joined.select(key, *[c for c in cols if c != key], *[c for c in side.columns if c != key])
