"""Joins and choices by key that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of one key that one task takes in a join.
ROWS_PER_TASK = 1_000_000
#: Most rows a side may have to be broadcast (dimension rows are a few hundred bytes).
BROADCAST_ROWS = 200_000


def compute_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that they are worked out once, whatever uses them afterwards.

    Catalyst moves a filter below the projection that computes its column and thereby repeats the
    computation, once per mention. It does not cross a column that is said to depend on the task, and still
    leaves out one that nothing uses.
    """
    anywhere = F.spark_partition_id() >= 0
    return rows.withColumns({name: F.when(anywhere, column) for name, column in columns.items()})


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a few large files over all cores; no shuffle when there are partitions enough."""
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Written as a filter on ``row_number`` so that Catalyst keeps one row per key and task *before* the
    shuffle (``WindowGroupLimit``): a key with very many copies sends few of them.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def later_copies(rows: DataFrame, row: str, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The numbers, in column ``row``, of what :func:`latest_per_key` leaves out; keys and order alone are shuffled."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank > 1").select(row)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key in ``order``, cut down before the shuffle in the same way."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def is_small(rows: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether ``rows`` has at most ``bound`` rows; reads no more than ``bound + 1`` of them."""
    return rows.limit(bound + 1).count() <= bound


def dimension_join(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner", bound: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a side table by ``key``: broadcast when its checked size allows, else a balanced shuffle."""
    if is_small(dimension, bound):
        return facts.join(F.broadcast(dimension), key, how)
    return balanced_join(facts, dimension, key, how)


def balanced_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join with hot keys cut into parts.

    ``lookup`` has one row per key and ``how`` is ``inner`` or ``left``. A key with more than
    ``rows_per_task`` fact rows gets its facts spread over several parts and its lookup row repeated once
    per part. The list of hot keys is broadcast: it has at most ``facts / rows_per_task`` rows. Facts
    without a key are spread over all tasks, since they match nothing. ``counts`` gives ``key, _rows`` where
    they are known; else a pass over the key column of ``facts`` finds them.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if counts is None:
        counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(
        counts.filter(F.col(key).isNotNull() & (F.col("_rows") > rows_per_task))
        .select(key, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_parts"))
    )
    place = F.xxhash64(*[F.col(f"`{name}`") for name in facts.columns])
    keyed = facts.join(hot, key, "left").withColumn(
        "_part",
        F.when(F.col(key).isNull(), place)
        .when(F.col("_parts").isNotNull(), F.pmod(place, F.col("_parts")))
        .otherwise(F.lit(0).cast("bigint")),
    )
    repeated = (
        lookup.filter(F.col(key).isNotNull())
        .join(hot, key, "left")
        .withColumn(
            "_part",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)).cast("bigint") - 1)),
        )
    )
    return keyed.drop("_parts").join(repeated.drop("_parts"), [key, "_part"], how).drop("_part")
