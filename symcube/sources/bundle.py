"""An opened symbol bundle: catalog, label table and lazy scans.

Layout of a bundle directory::

    catalog.json              replaced in one step when a version is complete; without it there is no bundle;
                              holds the labels too if they are few
    <version>/labels/         uel INT, label STRING, sorted by uel: the label numbers, from 1
    <version>/by_label/       the same rows, sorted by label, for lookups
    <version>/data/<number>/  at BIGINT, u0.. INT, k0.. STRING, level .. scale DOUBLE, sorted by u0, u1, ..
    <version>/places/         symbol INT, part INT, base BIGINT, rows BIGINT: sizes of the data's partitions

All tables are Parquet.  Keys are kept twice: labels for the user, label numbers for order and for skipping
pages.  A record's place ``at`` ascends in record order, so the first records are a range of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from symcube.functions.naming import FIELDS
from symcube.functions.ordinals import ROW_BITS
from symcube.functions.storage import read_text
from symcube.sources.errors import ClosedError, IntegrityError, InvalidPathError, OpenReadError, SymbolNotFoundError

CATALOG = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("subtype", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("domains", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("producer", T.StringType()),
    ]
)
UELS = T.StructType([T.StructField("uel", T.IntegerType()), T.StructField("label", T.StringType())])
PLACES = "symbol int, part int, base bigint, rows bigint"


def data_schema(dim: int) -> T.StructType:
    return T.StructType(
        [T.StructField("at", T.LongType())]
        + [T.StructField(f"u{i}", T.IntegerType()) for i in range(dim)]
        + [T.StructField(f"k{i}", T.StringType()) for i in range(dim)]
        + [T.StructField(f, T.DoubleType()) for f in FIELDS]
    )


@dataclass(frozen=True)
class Symbol:
    number: int
    name: str
    type: str
    dim: int
    subtype: int
    records: int
    domains: tuple[str, ...]
    text: str
    first_rows: int  # records in the first partition


class Bundle:
    """A bundle opened for reading.  The small catalog is read at once, records only when used."""

    def __init__(self, spark: SparkSession, path: str):
        if not path:
            raise InvalidPathError("a bundle needs a path")
        self.spark, self.path, self.closed = spark, path.rstrip("/"), False
        found = read_text(spark, f"{self.path}/catalog.json")
        if found is None:
            raise OpenReadError(f"{path} holds no complete bundle")
        told = json.loads(found)
        self.root, self.producer, self.compression = f"{self.path}/{told['version']}", told["producer"], told["compression"]
        self._labels = told["labels"] and {x: n for n, x in enumerate(told["labels"], 1)}  # only of a small label table
        self._symbols = [Symbol(**s | {"domains": tuple(s["domains"])}) for s in told["symbols"]]
        self._by_name = {s.name: s for s in self._symbols}

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Bundle:
        return cls(spark, path)

    def close(self) -> None:
        """May be called repeatedly; DataFrames made before stay usable."""
        self.closed = True

    def __enter__(self) -> Bundle:
        self._check()
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _check(self) -> None:
        if self.closed:
            raise ClosedError("reader is closed")

    # -- catalog ---------------------------------------------------------------------------------

    def symbols(self) -> list[Symbol]:
        self._check()
        return list(self._symbols)

    def symbol(self, name: str) -> Symbol:
        """Exact, case-sensitive lookup."""
        self._check()
        if name not in self._by_name:
            raise SymbolNotFoundError(f"no symbol {name!r}; there are: {', '.join(self._by_name) or 'none'}")
        return self._by_name[name]

    def catalog(self) -> DataFrame:
        self._check()
        rows = [(s.number, s.name, s.type, s.dim, s.subtype, s.records, list(s.domains), s.text, self.producer) for s in self._symbols]
        return self.spark.createDataFrame(rows, CATALOG)

    # -- labels ----------------------------------------------------------------------------------

    def uels(self) -> DataFrame:
        self._check()
        return self.spark.read.schema(UELS).parquet(f"{self.root}/labels")

    def uel_table(self) -> list[str]:
        """All labels in file order, on the driver: for interactive use."""
        return [r.label for r in self.uels().orderBy("uel").toLocalIterator()]

    def uel_counts(self) -> tuple[int, int]:
        row = self.uels().agg(F.count("*").alias("n"), F.coalesce(F.max("uel"), F.lit(0)).alias("high")).first()
        return row.n, row.high

    def lookup(self, labels: Iterable[str | None]) -> dict[str, int]:
        """The numbers of the known among some labels; exact match.

        A small label table came with the catalog.  Otherwise the rows sorted by label are read, of which few pages match.
        """
        self._check()
        known = [x for x in dict.fromkeys(labels) if x is not None]
        if not known:
            return {}
        if self._labels is not None:
            return {x: self._labels[x] for x in known if x in self._labels}
        found = self.spark.read.schema(UELS).parquet(f"{self.root}/by_label")
        if len(known) <= 2000:
            found = found.where(F.col("label").isin(known))
        else:  # a long list is joined, not put into the plan
            wanted = self.spark.createDataFrame([(x,) for x in known], "label string")
            found = found.join(wanted, "label", "left_semi")
        return {r.label: r.uel for r in found.collect()}  # as many as labels were asked for

    def resolve(self, labels: Iterable[str | None]) -> list[int]:
        """Sorted label numbers of the known among some labels; unknown ones and nulls are dropped."""
        return sorted(self.lookup(labels).values())

    # -- records ---------------------------------------------------------------------------------

    def records(self, name: str) -> DataFrame:
        """The stored columns of a symbol."""
        symbol = self.symbol(name)
        return self.spark.read.schema(data_schema(symbol.dim)).parquet(f"{self.root}/data/{symbol.number}")

    def places(self, name: str) -> DataFrame:
        """part, base, rows: the sizes of the partitions that hold a symbol's records, in record order."""
        number = self.symbol(name).number
        return self.spark.read.schema(PLACES).parquet(f"{self.root}/places").where(F.col("symbol") == number).drop("symbol")

    def place_of(self, name: str, n: int) -> int | None:
        """The place of the n-th record, from 1; None if there are fewer.  A job only beyond the first partition."""
        symbol = self.symbol(name)
        if n > symbol.records:
            return None
        if n <= symbol.first_rows:
            return n - 1
        row = self.places(name).where(F.col("base") < n).orderBy(F.desc("base")).first()
        return (row.part << ROW_BITS) + n - row.base - 1

    def check_count(self, name: str, delivered: int) -> None:
        """A whole symbol must deliver as many records as the catalog says."""
        expected = self.symbol(name).records
        if delivered != expected:
            raise IntegrityError(f"{name}: {delivered} records were read, the catalog says {expected}")

    # -- physical layout -------------------------------------------------------------------------

    def is_compressed(self) -> bool:
        self._check()
        return self.compression != "none"

    def files(self, name: str) -> DataFrame:
        """file, bytes of the files that hold a symbol's records."""
        kept = self.records(name).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        return kept.distinct()

    def restart_points(self, name: str) -> DataFrame:
        """u0, record (from 0) of the first record of each label of the first dimension, in record order."""
        symbol = self.symbol(name)
        if not symbol.dim:
            return self.spark.createDataFrame([], "u0 int, record bigint")
        first = self.records(name).groupBy("u0").agg(F.min("at").alias("at"))
        first = first.withColumn("part", F.shiftright("at", ROW_BITS).cast("int")).join(F.broadcast(self.places(name)), "part")  # a row per partition
        return first.select("u0", (F.col("base") + F.col("at").bitwiseAND((1 << ROW_BITS) - 1)).alias("record")).orderBy("u0")
