"""Keep one row per key, deterministically.

Spark's ``dropDuplicates`` keeps an arbitrary row, which may differ between
a first run and a re-executed task.  Here the survivor is the row that is
smallest by all non-key columns, compared in column order, nulls first.

Two plans are offered:

* ``"aggregate"`` (default): ``groupBy(key).agg(min(struct(others)))``.  The
  partial aggregate runs before the shuffle, so a key that holds a third of
  all rows reaches the reducer as one row per map task, never as one huge
  group.
* ``"window"``: ``row_number()`` over the key ordered by the other columns,
  keeping rank 1.  Catalyst adds a partial ``WindowGroupLimit`` before the
  shuffle, with the same effect on hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.schemas import q

_ROW = "__survivor"
_RANK = "__rank"


def keep_one_per_key(df: DataFrame, keys: Sequence[str], strategy: str = "aggregate") -> DataFrame:
    keys = list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} not in {df.columns}")
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*[F.col(k) for k in keys]).distinct()
    if strategy == "aggregate":
        fields = ", ".join(q(c) for c in others)
        kept = df.groupBy(*keys).agg(F.expr(f"min(struct({fields})) AS {_ROW}"))
        unpack = {c: f"{q(c)}" if c in keys else f"{_ROW}.{q(c)} AS {q(c)}" for c in df.columns}
        return kept.selectExpr(*[unpack[c] for c in df.columns])
    if strategy == "window":
        order = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(
            *[F.col(c).asc_nulls_first() for c in others])
        return (df.withColumn(_RANK, F.row_number().over(order))
                  .where(F.col(_RANK) == 1)
                  .drop(_RANK))
    raise ValueError(f"unknown strategy {strategy!r}")
