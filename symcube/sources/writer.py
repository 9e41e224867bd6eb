"""Writing symbol bundles."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symcube.functions.naming import FIELDS, KINDS, MAX_DIM, MAX_LABEL_BYTES
from symcube.functions.ordinals import bases, number_rows, placed_by
from symcube.functions.special import Sentinels, map_special
from symcube.functions.storage import delete, folders, read_text, scratch, store, write_text
from symcube.sources.bundle import UELS, Bundle
from symcube.sources.errors import CreateError, InvalidPathError, InvalidWriteInputError, OpenWriteError

#: A dimension's labels are broadcast up to so many bytes; beyond, the records are joined with them by a shuffle.
BROADCAST_BYTES = 32 << 20
#: A label table of up to so many bytes is part of the catalog file too, so that lookups need no job.
INLINE_BYTES = 256 << 10
#: Symbols that are written at the same time.
AT_ONCE = 4


@dataclass
class _Staged:
    name: str
    kind: str
    dim: int
    subtype: int
    domains: list[str]
    text: str
    records: int
    data: DataFrame  # written: k0.., the fields, and at, which ascends in the order of insertion
    folder: str


class BundleWriter:
    """Collects validated symbols and writes them at ``finish``, the catalog last.

    Labels are numbered from 1 by first appearance: symbol by symbol, record by record in the order
    given, dimension by dimension.  An older bundle at the path stays readable until ``finish`` has replaced its
    catalog, and its tables are kept until the next bundle is written there.
    """

    def __init__(self, spark: SparkSession, path: str, producer: str = "symcube", compression: str = "zstd"):
        if not path:
            raise InvalidPathError("a bundle needs a path")
        if compression not in ("none", "snappy", "zstd", "gzip", "lz4"):
            raise CreateError(f"unknown compression {compression!r}")
        self.spark, self.path, self.producer, self.compression = spark, path.rstrip("/"), producer, compression
        self._staged: list[_Staged] = []
        self.finished = False

    @classmethod
    def create(cls, spark: SparkSession, path: str, producer: str = "symcube", compression: str = "zstd") -> BundleWriter:
        return cls(spark, path, producer, compression)

    def __enter__(self) -> BundleWriter:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None and not self.finished:
            self.finish()
        elif kind is not None:
            self._forget()

    def write_symbol(
        self,
        name: str,
        records: DataFrame,
        keys: list[str],
        values: dict[str, str | Column] | None = None,
        kind: str = "Parameter",
        text: str = "",
        domains: list[str] | None = None,
        subtype: int = 0,
        order: list[str | Column] | None = None,
        sentinels: Sentinels | None = None,
    ) -> None:
        """Stage and validate all records of a symbol; after an error the writer is as before.

        ``keys`` are the key columns, ``values`` the columns of value fields (others are 0).
        ``order`` gives the records' order of insertion, by columns of any type that Spark sorts, ties by the
        keys; by default it is the order of the keys.  The source is computed once.
        """
        self.write_symbols([{"name": name, "records": records, "keys": keys, "values": values, "kind": kind, "text": text, "domains": domains, "subtype": subtype, "order": order, "sentinels": sentinels}])

    def write_symbols(self, symbols: list[dict]) -> None:
        """Stage several symbols, each given by the arguments of ``write_symbol``, at the same time.

        They are numbered in the order of the list.  If one is refused, none is staged.
        """
        if self.finished:
            raise OpenWriteError("the bundle is finished")
        taken = {s.name for s in self._staged}
        for s in symbols:
            if not s["name"] or s["name"] in taken:
                raise InvalidWriteInputError(f"symbol name {s['name']!r} is empty or taken")
            taken.add(s["name"])
        plans = [self._planned(**s) for s in symbols]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            jobs = [pool.submit(self._stage, *p) for p in plans]
        errors = [e for j in jobs if (e := j.exception())]
        staged = [j.result() for j in jobs if not j.exception()]
        if errors:
            for s in staged:
                delete(self.spark, s.folder)
            raise errors[0]
        self._staged += staged

    def _planned(
        self,
        name: str,
        records: DataFrame,
        keys: list[str],
        values: dict[str, str | Column] | None = None,
        kind: str = "Parameter",
        text: str = "",
        domains: list[str] | None = None,
        subtype: int = 0,
        order: list[str | Column] | None = None,
        sentinels: Sentinels | None = None,
    ) -> tuple[_Staged, DataFrame, list[str]]:
        """What can be checked without a job; the records to stage, in their order, and the key columns."""
        dim = len(keys)
        if domains and len(domains) != dim:
            raise InvalidWriteInputError(f"{len(domains)} domain names for {dim} dimensions")
        if dim > MAX_DIM:
            raise InvalidWriteInputError(f"{dim} dimensions; at most {MAX_DIM} are allowed")
        if kind not in KINDS:
            raise InvalidWriteInputError(f"unknown kind {kind!r}")
        values = values or {}
        if unknown := [f for f in values if f not in FIELDS]:
            raise InvalidWriteInputError(f"unknown value fields {unknown}")
        if missing := [k for k in keys if k not in records.columns]:
            raise InvalidWriteInputError(f"no key columns {missing}")
        column = lambda c: F.col(c) if isinstance(c, str) else c
        value = lambda f: column(values[f]).cast("double") if f in values else F.lit(0.0)
        mapped = lambda f: map_special(value(f), sentinels) if sentinels and f in values else value(f)
        labels = [f"k{i}" for i in range(dim)]
        data = records.select(
            *[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
            *[F.coalesce(mapped(f), F.lit(float("nan"))).alias(f) for f in FIELDS],
            *[column(c).alias(f"o{i}") for i, c in enumerate(order or [])],
        )
        sorting = [*[f"o{i}" for i in range(len(order or []))], *labels]
        data = placed_by(data, sorting, "at") if sorting else data.withColumn("at", F.monotonically_increasing_id())
        data = data.select(*labels, *FIELDS, "at")
        return _Staged(name, kind, dim, subtype, list(domains or ["*"] * dim), text, 0, data, scratch(self.spark, "staged")), data, labels

    def _stage(self, s: _Staged, data: DataFrame, labels: list[str]) -> _Staged:
        """Written and validated."""
        s.data = store(data, s.folder)
        try:
            s.records = self._validate(s.name, s.data, labels)
        except InvalidWriteInputError:
            delete(self.spark, s.folder)
            raise
        return s

    def _validate(self, name: str, data: DataFrame, labels: list[str]) -> int:
        """The number of records.  Only hashes of the keys are shuffled; keys themselves if two hashes are equal."""
        bad = F.lit(False)
        for k in labels:
            bad = bad | F.col(k).isNull() | (F.octet_length(k) > MAX_LABEL_BYTES)
        hashed = data.select((F.xxhash64(*labels) if labels else F.lit(0).cast("long")).alias("h"), bad.alias("bad"))
        found = hashed.groupBy("h").agg(F.count("*").alias("n"), F.max("bad").alias("bad"))
        row = found.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max("bad").alias("bad")).first()
        if row.bad:
            raise InvalidWriteInputError(f"{name}: a key is null or longer than {MAX_LABEL_BYTES} bytes")
        if (row.most or 0) > 1 and not data.groupBy(*labels).count().where("count > 1").isEmpty():
            raise InvalidWriteInputError(f"{name}: two records have the same keys")
        return row.n or 0

    def _firsts(self, number: int, s: _Staged) -> DataFrame:
        """symbol, d, label, at: each dimension's distinct labels with their first record, by partial aggregation."""
        each = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"k{d}").alias("label")) for d in range(s.dim)]))
        rows = s.data.select("at", each.alias("e")).select("at", "e.*")
        return rows.groupBy("d", "label").agg(F.min("at").alias("at")).select(F.lit(number).alias("symbol"), "d", "label", "at")

    def finish(self) -> Bundle:
        """Write everything into a new version folder; the bundle becomes visible with its catalog, at the end."""
        if self.finished:
            raise OpenWriteError("the bundle is finished")
        version = f"v-{uuid.uuid4().hex}"
        root, how = f"{self.path}/{version}", {"compression": self.compression}
        firsts = None
        for number, s in enumerate(self._staged, 1):
            if s.dim:
                own = self._firsts(number, s)
                firsts = own if firsts is None else firsts.unionByName(own)
        temporary = [scratch(self.spark, "firsts"), scratch(self.spark, "codes")]
        firsts = store(firsts if firsts is not None else self.spark.createDataFrame([], "symbol int, d int, label string, at long"), temporary[0])
        first = firsts.groupBy("label").agg(F.min(F.struct("symbol", "at", "d")).alias("first"))
        uels = store(number_rows(first, ["first"], "uel").select(F.col("uel").cast("int"), "label"), f"{root}/labels", **how)
        by_label = uels.select("uel", "label").repartitionByRange("label").sortWithinPartitions("label")
        codes = store(firsts.join(uels, "label").select("symbol", "d", "uel", "label"), temporary[1])
        # so many bytes of labels does each dimension have: one small row each
        sizes = {(r.symbol, r.d): r.n for r in firsts.groupBy("symbol", "d").agg(F.sum(F.octet_length("label") + 16).alias("n")).collect()}

        def write(number: int, s: _Staged) -> None:
            data = s.data.drop("at")
            for d in range(s.dim):
                own = codes.where((F.col("symbol") == number) & (F.col("d") == d)).select(F.col("uel").alias(f"u{d}"), F.col("label").alias(f"k{d}"))
                data = data.join(F.broadcast(own) if sizes.get((number, d), 0) <= BROADCAST_BYTES else own, f"k{d}")
            keys = [f"u{i}" for i in range(s.dim)]
            data = data.select(*keys, *[f"k{i}" for i in range(s.dim)], *FIELDS)
            data = placed_by(data, keys, "at") if keys else data.withColumn("at", F.monotonically_increasing_id())
            data.write.parquet(f"{root}/data/{number}", **how)

        with ThreadPoolExecutor(AT_ONCE) as pool:  # most symbols are small, so their jobs overlap
            jobs = [pool.submit(write, n, s) for n, s in enumerate(self._staged, 1)]
            jobs.append(pool.submit(lambda: by_label.write.parquet(f"{root}/by_label", **how)))
            for job in jobs:
                job.result()
        parts = self.spark.createDataFrame([], "symbol int, at long")
        for number, _ in enumerate(self._staged, 1):
            parts = parts.unionByName(self.spark.read.schema("at long").parquet(f"{root}/data/{number}").select(F.lit(number).alias("symbol"), "at"))
        places = store(bases(parts, "at", "symbol").coalesce(1).sortWithinPartitions("symbol", "base"), f"{root}/places")
        heads = {r.symbol: r.rows for r in places.where("part = 0").collect()}  # one row per symbol
        symbols = [
            {"number": n, "name": s.name, "type": s.kind, "dim": s.dim, "subtype": s.subtype, "records": s.records, "domains": s.domains, "text": s.text, "first_rows": heads.get(n, 0)}
            for n, s in enumerate(self._staged, 1)
        ]
        told_labels = None
        if sum(sizes.values()) <= 16 * INLINE_BYTES and (uels.agg(F.sum(F.octet_length("label") + 4).alias("n")).first()["n"] or 0) <= INLINE_BYTES:
            told_labels = [r.label for r in uels.orderBy("uel").collect()]
        before = read_text(self.spark, f"{self.path}/catalog.json")
        told = {"version": version, "producer": self.producer, "compression": self.compression, "symbols": symbols, "labels": told_labels}
        write_text(self.spark, f"{self.path}/catalog.json", json.dumps(told))
        self.finished = True
        keep = {version, json.loads(before)["version"] if before else version}
        for old in folders(self.spark, self.path):
            if old.startswith("v-") and old not in keep:
                delete(self.spark, f"{self.path}/{old}")
        self._forget()
        for folder in temporary:
            delete(self.spark, folder)
        return Bundle(self.spark, self.path)

    def _forget(self) -> None:
        for s in self._staged:
            delete(self.spark, s.folder)
