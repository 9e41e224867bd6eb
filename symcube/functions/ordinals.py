"""Ordinals over sorted data without a single-partition window, and sets of them as predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from symcube.functions.storage import scratch, store

#: A place (monotonically increasing id) is a partition number and a row number below this many bits.
ROW_BITS = 33
#: Up to so many ids are part of the plan; more are joined.
LISTED_IDS = 300


def bases(placed: DataFrame, at: str, *group: str) -> DataFrame:
    """part, base (rows of all partitions before), rows: one small row per partition of a table with places, or of each group."""
    sizes = placed.groupBy(*group, F.shiftright(at, ROW_BITS).cast("int").alias("part")).agg(F.count("*").alias("rows"))
    before = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(*group, "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"), "rows")


def numbered(placed: DataFrame, at: str, name: str, start: int = 1) -> DataFrame:
    """Replace the place ``at`` of a written table by ``name``, the row's number in the order of places."""
    base = bases(placed, at).select(F.col("part").alias("_part"), F.col("base").alias("_base"))
    rows = placed.withColumn("_part", F.shiftright(at, ROW_BITS).cast("int")).join(F.broadcast(base), "_part")  # a row per partition
    return rows.withColumn(name, F.col("_base") + F.col(at).bitwiseAND((1 << ROW_BITS) - 1) + F.lit(start)).drop(at, "_part", "_base")


def placed_by(df: DataFrame, order: list[str | Column], at: str) -> DataFrame:
    """Range-partitioned and sorted, with ``at``: a number that ascends in this order, with gaps between partitions."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())


def number_rows(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Add ``name``, the position of each row in the order of unique ``order`` columns.

    Rows are range-partitioned, sorted and written; a row's number is its place in its partition plus the sizes
    of the partitions before.  Only one small row per partition meets in one task.
    """
    placed = store(placed_by(df, [F.col(c) for c in order], "_at"), scratch(df.sparkSession, "numbered"))
    return numbered(placed, "_at", name, start)


def in_set(column: Column, ids: list[int]) -> Column:
    """Membership in a few ids: a range, which sorted files can skip by, and a flat set where it has gaps."""
    own = sorted(set(ids))
    if not own:
        return F.lit(False)
    span = column == own[0] if len(own) == 1 else column.between(own[0], own[-1])
    return span if own[-1] - own[0] + 1 == len(own) else span & column.isin(own)


def restrict(df: DataFrame, column: str, ids: list[int], most: int = LISTED_IDS) -> DataFrame:
    """The rows whose column is among some ids, however many: a long list becomes a range and a semi-join."""
    own = sorted(set(ids))
    if len(own) <= most or own[-1] - own[0] + 1 == len(own):
        return df.where(in_set(F.col(column), own))
    wanted = df.sparkSession.createDataFrame([(i,) for i in own], "_wanted int")
    wanted = F.broadcast(wanted) if len(own) <= 2_000_000 else wanted  # four bytes an id
    ranged = df.where(F.col(column).between(own[0], own[-1]))
    return ranged.join(wanted, ranged[column] == wanted["_wanted"], "left_semi")
