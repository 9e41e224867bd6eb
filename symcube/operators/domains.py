"""The labels that a symbol really uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symcube.functions.naming import check_names, key_names
from symcube.functions.ordinals import number_rows
from symcube.sources.bundle import Bundle


def used_labels(bundle: Bundle, symbol: str) -> DataFrame:
    """dim, uel, label of every used label, found in one pass over the records."""
    dim = bundle.symbol(symbol).dim
    if not dim:
        return bundle.spark.createDataFrame([], "dim int, uel int, label string")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"u{i}").alias("uel"), F.col(f"k{i}").alias("label")) for i in range(dim)]))
    return bundle.records(symbol).select(each.alias("e")).select("e.*").distinct()


def domain_elements(bundle: Bundle, symbol: str, dimension: int) -> DataFrame:
    """uel, label of one dimension's used labels, ascending; empty for a dimension that is not there."""
    if not 0 <= dimension < bundle.symbol(symbol).dim:
        return bundle.spark.createDataFrame([], "uel int, label string")
    used = bundle.records(symbol).select(F.col(f"u{dimension}").alias("uel"), F.col(f"k{dimension}").alias("label"))
    return used.distinct().orderBy("uel")


def read_domains(source: Bundle | str, symbol: str, spark: SparkSession | None = None, ordinal: str | None = None) -> DataFrame:
    """A column per dimension with its used labels in label order, padded with nulls to the longest.

    Here only the dimensions' names are distinct; unlike in a scan, the value column reserves no name.
    ``ordinal`` names a column with the row's number, which the order can be told from.  All dimensions are listed in
    one pass over the records: their distinct labels are numbered together in the order of dimension and label,
    and a label's row is its number less the labels of the dimensions before.
    """
    bundle = source if isinstance(source, Bundle) else Bundle(spark or SparkSession.active(), source)
    names = key_names(bundle.symbol(symbol).domains)
    if not names:
        return bundle.spark.createDataFrame([], "dummy int").drop("dummy")
    sensitive = bundle.spark.conf.get("spark.sql.caseSensitive") == "true"
    check_names(names, ordinal or f"{'_'.join(names)}_", sensitive)
    numbered = number_rows(used_labels(bundle, symbol), ["dim", "uel"], "n", start=0)
    begin = numbered.groupBy("dim").agg(F.min("n").alias("begin"))  # a row per dimension
    rows = numbered.join(F.broadcast(begin), "dim").withColumn("place", (F.col("n") - F.col("begin") + 1).cast("int"))
    wide = rows.groupBy("place").agg(*[F.max(F.when(F.col("dim") == i, F.col("label"))).alias(f"c{i}") for i in range(len(names))])
    keep = [F.col("place").alias(ordinal)] if ordinal else []
    return wide.orderBy("place").select(*keep, *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
