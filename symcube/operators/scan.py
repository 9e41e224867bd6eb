"""Lazy scans: key labels and one value field of a symbol as a DataFrame.

Filters on keys, and the parts of a condition that compare a key with constant labels, are resolved to label numbers
when they are added: a lookup of those labels alone.  The numbers reach the sorted files as ranges or small sets, a long
list as a range and a semi-join, and a label that the bundle doesn't have gives a plan without any scan.  Everything
else is left to Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symcube.functions.naming import FIELDS, check_names, hidden_names, key_names, stored_field, value_name
from symcube.functions.ordinals import restrict
from symcube.operators.predicates import key_tests
from symcube.sources.bundle import Bundle, Symbol
from symcube.sources.errors import BundleError

UEL = {"uel": True}  # metadata of key columns: they sort by u<i>, not by label
AUTO_RECORDS = 5_000_000  # fixed value: from here on "auto" means all cores


def resolve_threads(threads: int | str | None, records: int, cores: int) -> int:
    """Accepted for parity and checked; Spark splits files itself, so results never depend on it."""
    if threads is None:
        return 1
    if threads == "auto":
        return cores if records >= AUTO_RECORDS else 1
    if isinstance(threads, bool) or not isinstance(threads, int) or threads < 0:
        raise ValueError(f"threads must be 'auto', None or a count, not {threads!r}")
    return max(1, threads)


@dataclass(frozen=True)
class SymbolScan:
    """A scan under construction; every method returns a new one and reads no records."""

    bundle: Bundle
    symbol: Symbol
    keys: tuple[str, ...]
    shown: tuple[str, ...]  # the value column(s)
    data: DataFrame  # the hidden columns, the keys, the value column(s)
    ordinals: tuple[str, ...]  # hidden: label numbers
    at: str  # hidden: the record's place
    empty: bool = False
    whole: bool = True  # no record was filtered out so far

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.shown]

    def _dimension(self, key: int | str) -> int:
        if isinstance(key, str):
            if key not in self.keys:
                raise ValueError(f"{key!r} is no key of {self.symbol.name}; keys: {', '.join(self.keys)}")
            return self.keys.index(key)
        if isinstance(key, bool) or not 0 <= key < self.symbol.dim:
            raise ValueError(f"dimension {key} of {self.symbol.name}, which has {self.symbol.dim}")
        return key

    def _with(self, data: DataFrame, empty: bool = False) -> SymbolScan:
        return replace(self, data=data.where(F.lit(False)) if empty else data, empty=self.empty or empty, whole=False)

    def _restricted(self, tests: list[tuple[int, list[str | None]]]) -> SymbolScan:
        """All tests must hold; the labels of all of them are looked up at once."""
        if any(all(x is None for x in labels) for _, labels in tests):
            return self._with(self.data, empty=True)
        known = self.bundle.lookup([x for _, labels in tests for x in labels])
        data = self.data
        for dimension, labels in tests:
            ids = [known[x] for x in labels if x in known]
            if not ids:
                return self._with(self.data, empty=True)
            data = restrict(data, self.ordinals[dimension], ids)
        return self._with(data)

    def where_keys(self, labels: Mapping[int | str, Iterable[str | None]]) -> SymbolScan:
        """Exact label filters: all dimensions must match, each any of its labels, however many.

        Unknown labels match nothing; nulls are dropped.  Repeated calls intersect.
        """
        tests = []
        for key, wanted in labels.items():
            if isinstance(wanted, str):
                raise ValueError("give a list of labels, not a string")
            tests.append((self._dimension(key), list(wanted)))
        return self._restricted(sorted(tests, key=lambda t: t[0])) if tests and not self.empty else self

    def where_ordinals(self, dimension: int | str, low: int, high: int) -> SymbolScan:
        """Records whose label number in a dimension lies in [low, high]."""
        return self._with(self.data.where(F.col(self.ordinals[self._dimension(dimension)]).between(low, high)))

    def filter(self, condition: Column | str) -> SymbolScan:
        """Any condition on the visible columns, or on ``ordinal(i)``; tests of keys are added as label numbers."""
        tests = key_tests(self.data, condition, {k: i for i, k in enumerate(self.keys)})
        kept = self._restricted(tests) if tests and not self.empty else self
        return replace(kept, data=kept.data.where(condition), whole=False)

    def ordinal(self, dimension: int | str) -> Column:
        """The label number of a dimension: the order of its labels."""
        return F.col(self.ordinals[self._dimension(dimension)])

    def head(self, n: int) -> SymbolScan:
        """The first ``n`` records, in record order, of what passes the filters so far.

        Without filters these are a range of places, which the sorted files are read up to.
        """
        if n < 0:
            raise ValueError("head needs a count")
        last = self.bundle.place_of(self.symbol.name, n) if self.whole and n else None
        data = self.data if last is None else self.data.where(F.col(self.at) <= last)
        return replace(self, data=data.orderBy(self.at).limit(n), whole=False)

    def sorted(self, *dimensions: int | str) -> SymbolScan:
        """In the order of label numbers; by default the order of records."""
        by = [self.ordinal(d) for d in dimensions] or [F.col(self.at)]
        return replace(self, data=self.data.orderBy(*by))

    def df(self, ordinals: bool = False) -> DataFrame:
        """The rows as a DataFrame; ``ordinals`` adds u0, u1, .. as the last columns."""
        extra = [F.col(u).alias(f"u{i}") for i, u in enumerate(self.ordinals)] if ordinals else []
        return self.data.select(*[F.col(f"`{c}`") for c in self.columns], *extra)

    def select(self, *columns: str) -> DataFrame:
        return self.data.select(*[F.col(f"`{c}`") for c in columns])

    def collect(self) -> list:
        return self.sorted().df().collect()

    def to_arrow(self, categories: bool = False):
        """All rows in record order as one Arrow table on the driver; a whole symbol must be complete.

        With ``categories``, keys are dictionary-encoded: their categories are all labels of the bundle in the order
        of their numbers, so a sort of the keys follows the bundle's order.
        """
        rows = self.sorted()
        if not categories:
            table = rows.df().toArrow()
        else:
            import pyarrow as pa
            import pyarrow.compute  # noqa: F401

            slim = rows.data.select(*[F.col(u).alias(f"u{i}") for i, u in enumerate(self.ordinals)], *[F.col(f"`{v}`") for v in self.shown])
            table = slim.toArrow()
            labels = pa.array(self.bundle.uel_table(), pa.string())
            width = pa.int16() if len(labels) <= 1 << 15 else pa.int32()
            encoded = [pa.DictionaryArray.from_arrays(pa.compute.subtract(table[i].combine_chunks(), 1).cast(width), labels, ordered=True) for i in range(len(self.keys))]
            table = pa.table([*encoded, *[table[v] for v in self.shown]], names=self.columns)
        if self.whole:
            self.bundle.check_count(self.symbol.name, table.num_rows)
        return table


def build_scan(
    bundle: Bundle,
    name: str,
    value_field: str | None = None,
    key_filter: Mapping[int, Iterable[str]] | None = None,
    threads: int | str | None = None,
    keys: list[str] | None = None,
    all_fields: bool = False,
    slot: str | None = None,
) -> SymbolScan:
    """``slot`` reads that field into the value column, whatever the symbol's kind."""
    symbol = bundle.symbol(name)
    resolve_threads(threads, symbol.records, bundle.spark.sparkContext.defaultParallelism)
    value = value_name(symbol.type, value_field)
    shown = list(FIELDS) if all_fields else [value]
    names = key_names(symbol.domains, shown) if keys is None or len(keys) != symbol.dim else list(keys)
    if keys is not None and len(keys) != symbol.dim:
        names = key_names(["*"] * symbol.dim, shown)
    sensitive = bundle.spark.conf.get("spark.sql.caseSensitive") == "true"
    for v in shown:
        check_names(names, v, sensitive)
    ordinals, at = hidden_names(symbol.dim, [*names, *shown])
    fields = [F.col(f) for f in FIELDS] if all_fields else [F.col(slot or stored_field(symbol.type, value_field)).alias(value)]
    data = bundle.records(name).select(
        F.col("at").alias(at),
        *[F.col(f"u{i}").alias(u) for i, u in enumerate(ordinals)],
        *[F.col(f"k{i}").alias(n, metadata=UEL) for i, n in enumerate(names)],
        *fields,
    )
    scan = SymbolScan(bundle, symbol, tuple(names), tuple(shown), data, tuple(ordinals), at)
    return scan.where_keys(key_filter) if key_filter else scan


def scan_symbol(
    source: Bundle | str,
    symbol: str,
    value_field: str | None = None,
    key_filter: Mapping[int, Iterable[str]] | None = None,
    threads: int | str | None = None,
    keys: list[str] | None = None,
    all_fields: bool = False,
    spark: SparkSession | None = None,
) -> SymbolScan:
    """A lazy scan of one symbol; arguments are checked at once, records are read when collected.

    ``source`` is a bundle, or a path together with ``spark``.  ``keys`` renames the key columns (a list of
    the wrong length falls back to ``dim_<i>``).  ``all_fields`` shows all five fields instead of one.
    """
    if isinstance(source, Bundle):
        return build_scan(source, symbol, value_field, key_filter, threads, keys, all_fields)
    session = spark or SparkSession.active()
    return build_scan(Bundle(session, source), symbol, value_field, key_filter, threads, keys, all_fields)


def read_symbol(source: Bundle | str, symbol: str, n_rows: int | None = None, **how):
    """The rows of a symbol in record order as an Arrow table: for results that fit the driver."""
    scan = scan_symbol(source, symbol, **how)
    return (scan if n_rows is None else scan.head(n_rows)).to_arrow()


def read_slot(
    source: Bundle | str,
    symbol: str,
    keys: list[str] | None = None,
    value_field: str | None = None,
    key_filter: Mapping[int, Iterable[str]] | None = None,
    n_rows: int | None = None,
    threads: int | str | None = None,
    spark: SparkSession | None = None,
) -> SymbolScan:
    """The tolerant low-level scan.  The value field may be spelled in any case, and an unknown one is a ``BundleError``.

    On sets, parameters and aliases it chooses the slot too, though the column is called ``value`` there.
    """
    field = (value_field or FIELDS[0]).lower()
    if field not in FIELDS:
        raise BundleError(f"unknown value field {value_field!r}; there are {', '.join(FIELDS)}")
    bundle = source if isinstance(source, Bundle) else Bundle(spark or SparkSession.active(), source)
    scan = build_scan(bundle, symbol, field, key_filter, threads, keys, slot=field)
    return scan if n_rows is None else scan.head(n_rows)


def list_symbols(source: Bundle | str, spark: SparkSession | None = None) -> DataFrame:
    """name, type, dim, records, domains, text of every symbol."""
    bundle = source if isinstance(source, Bundle) else Bundle(spark or SparkSession.active(), source)
    return bundle.catalog().orderBy("number").select("name", "type", "dim", "records", "domains", "text")
