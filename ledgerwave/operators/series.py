"""Row-framed windows over entities that may be very long.

A window over ``partitionBy(entity)`` puts a whole entity into one task. That is
right while entities are short, and wrong for one that holds a large share of
the table. Long entities are therefore cut into blocks along their order; each
block also receives the rows just before it (as many as the longest look-back),
so every frame is complete, and these borrowed rows are dropped afterwards. The
result is the same as over the uncut entity.

Blocks come from exact row numbers: the rows are range-partitioned by keys and
the full order, whatever its types, numbered inside their partition, and the
counts of the partitions before are added.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.session import stored

MAX_ROWS = 2_000_000
_BLOCK, _OWN = "_block", "_own"


class Series:
    """The window of one entity key and one order, as SQL text."""

    def __init__(self, keys: list[str], order: list[str]):
        self.sql = (
            f"partition by {', '.join(f'`{k}`' for k in keys)} "
            f"order by {', '.join(f'`{o}`' for o in order)}"
        )


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality: a null entity is an entity too."""
    return reduce(and_, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _long_entities(df: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    return counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n")


def _numbered(hot: DataFrame, keys: list[str], order: list[str], parts: int) -> DataFrame:
    """Rows with ``_row``, their number in the entity from 0, and ``_all``, the
    number of rows of the entity. Rows that agree in
    the whole order get an arbitrary one, as in a window."""
    place = [*keys, *order, "_tie"]
    dealt = hot.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *place)
    dealt = stored(dealt.withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    entity = Window.partitionBy(*keys).orderBy("_part")
    before = F.sum("_rows").over(entity) - F.col("_rows")
    starts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), before.alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("_all"),
    )
    inside = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order, "_tie"))
    rows = dealt.withColumn("_in", inside)
    met = rows.join(starts, _same_keys(rows, starts, keys) & (rows["_part"] == starts["_p"]))
    return met.select(*[rows[c] for c in hot.columns], (F.col("_before") + F.col("_in") - 1).alias("_row"), "_all")


def over_series(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lookback: int,
    compute: Callable[[DataFrame, Series], DataFrame],
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Run ``compute`` (windows looking back at most ``lookback`` rows) per entity.

    Entities of more than ``max_rows`` rows are cut into blocks. Finding them
    counts rows per key up front (a scan of the key columns). Pass ``None``
    where the input proves that entities are short, for example one row per
    entity and day.
    """
    if max_rows is None:
        return compute(df, Series(keys, order))
    long = stored(_long_entities(df, keys, max_rows), "long")
    rows = long.agg(F.sum("_n")).first()[0]
    if not rows:
        return compute(df, Series(keys, order))

    same = _same_keys(df, long, keys)
    block = F.floor(F.col("_row") / F.lit(max_rows)).cast("long")
    reach = F.least(F.col("_row") + F.lit(lookback), F.col("_all") - 1)
    last = F.floor(reach / F.lit(max_rows)).cast("long")
    placed = (
        _numbered(df.join(long, same, "left_semi"), keys, order, -(-rows // max_rows))
        # Its own block first, then every later one whose look-back reaches the row.
        .select(*df.columns, F.posexplode(F.sequence(block, last)).alias("_nth", _BLOCK))
        .withColumn(_OWN, F.col("_nth") == 0)
        .drop("_nth")
        .unionByName(
            df.join(long, same, "left_anti").withColumns({_BLOCK: F.lit(0).cast("long"), _OWN: F.lit(True)})
        )
    )
    done = compute(placed, Series([*keys, _BLOCK], order))
    return done.filter(_OWN).drop(_BLOCK, _OWN)
