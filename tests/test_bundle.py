import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from symcube.functions.special import Sentinels, map_special
from symcube.operators import domain_elements, list_symbols, read_domains, read_slot, read_symbol, scan_symbol
from symcube.sources import Bundle, BundleWriter
from symcube.sources.errors import BundleError, ClosedError, IntegrityError, InvalidPathError, InvalidWriteInputError, OpenReadError, OpenWriteError, SymbolNotFoundError

D = [("brno", "graz", 4.0), ("brno", "porto", 3.25), ("brno", "split", 6.5), ("turku", "graz", 1.5), ("turku", "porto", 2.75), ("turku", "split", 5.0)]
X = {("brno", "graz"): 12.0, ("brno", "porto"): 340.0, ("brno", "split"): 0.0, ("turku", "graz"): 95.0, ("turku", "porto"): 0.0, ("turku", "split"): 260.0}


@pytest.fixture(scope="module")
def bundle(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('bundles')}/timber"
    rows = lambda data, names: spark.createDataFrame([(n, *r) for n, r in enumerate(data)], ["nr", *names])
    with BundleWriter.create(spark, path, producer="tests") as w:
        w.write_symbol("i", rows([("brno",), ("turku",)], ["k"]), ["k"], kind="Set", text="saw mills", order=["nr"])
        w.write_symbol("j", rows([("graz",), ("porto",), ("split",)], ["k"]), ["k"], kind="Set", text="harbours", order=["nr"])
        w.write_symbol("d", rows(D, ["a", "b", "v"]), ["a", "b"], {"level": "v"}, text="days by rail", order=["nr"])
        w.write_symbol("cost", rows(D, ["a", "b", "v"]), ["a", "b"], {"level": F.col("v") * 3 / 8}, order=["nr"])
        w.write_symbol("a", rows([("brno", 410.0), ("turku", 530.0)], ["k", "v"]), ["k"], {"level": "v"}, text="logs a week", order=["nr"])
        x = rows([(*k, v) for k, v in X.items()], ["a", "b", "v"])
        w.write_symbol("x", x, ["a", "b"], {"level": "v", "marginal": F.col("v") / 10, "upper": F.lit(1e5)}, kind="Variable", text="loads", order=["nr"])
        w.write_symbol("supply", rows([("brno",), ("turku",)], ["k"]), ["k"], kind="Equation", text="what a mill can saw", order=["nr"])
        w.write_symbol("value", rows([("oak",), ("elm",)], ["k"]), ["k"], kind="Set", order=["nr"])
        p = rows([("oak", "oak", 1.0), ("oak", "elm", 2.0), ("elm", "oak", 3.0), ("elm", "elm", 4.0)], ["a", "b", "v"])
        w.write_symbol("p", p, ["a", "b"], {"level": "v"}, domains=["value", "value"], order=["nr"])
        mixed = rows([("Lund", 10.0), ("OULU", 20.0), ("split", 30.0)], ["k", "v"])
        w.write_symbol("mixed", mixed, ["k"], {"level": "v"}, order=["nr"])
        w.write_symbol("pi", spark.createDataFrame([(3.14,)], ["v"]), [], {"level": "v"})
        w.write_symbol("none", rows([("x",)], ["k"]).limit(0), ["k"], order=["nr"])
        w.write_symbol("ii", rows([("brno",)], ["k"]), ["k"], kind="Alias", domains=["i"], order=["nr"])
    return Bundle.open(spark, path)


def tuples(scan):
    return [tuple(r) for r in scan.collect()]


def test_catalog(bundle):
    got = {r.name: r for r in list_symbols(bundle).collect()}
    assert list(got)[:4] == ["i", "j", "d", "cost"]
    assert (got["x"].type, got["x"].dim, got["x"].records, got["x"].domains) == ("Variable", 2, 6, ["*", "*"])
    assert (got["supply"].type, got["i"].type, got["d"].type, got["ii"].type) == ("Equation", "Set", "Parameter", "Alias")
    assert got["pi"].dim == 0 and got["pi"].domains == [] and got["p"].domains == ["value", "value"]
    assert list_symbols(bundle).columns == ["name", "type", "dim", "records", "domains", "text"]
    with pytest.raises(ValueError, match="cost"):
        scan_symbol(bundle, "D")


def test_label_table(bundle):
    table = bundle.uel_table()
    assert table[:5] == ["brno", "turku", "graz", "porto", "split"]
    assert bundle.uel_counts() == (len(table), len(table)) and len(set(table)) == len(table)
    assert bundle.resolve(["split", "brno", "nowhere", None, "SPLIT", "brno"]) == [1, 5]
    assert bundle.resolve([f"x{i}" for i in range(3000)] + ["porto"]) == [4]


def test_schema_and_values(bundle):
    assert scan_symbol(bundle, "x").df().dtypes == [("dim_0", "string"), ("dim_1", "string"), ("level", "double")]
    assert scan_symbol(bundle, "cost").columns == ["dim_0", "dim_1", "value"]
    assert scan_symbol(bundle, "p").columns == ["value_0", "value_1", "value"]
    assert tuples(scan_symbol(bundle, "d")) == D
    assert {r[:2]: r[2] for r in tuples(scan_symbol(bundle, "x"))} == X
    assert [r[2] for r in tuples(scan_symbol(bundle, "x", value_field="marginal"))] == [v / 10 for v in X.values()]
    assert tuples(scan_symbol(bundle, "d", value_field="upper")) == D
    assert tuples(scan_symbol(bundle, "pi")) == [(3.14,)] and scan_symbol(bundle, "pi").columns == ["value"]
    assert tuples(scan_symbol(bundle, "none")) == [] and tuples(scan_symbol(bundle, "ii")) == [("brno", 0.0)]
    wide = scan_symbol(bundle, "x", all_fields=True)
    assert wide.columns[2:] == ["level", "marginal", "lower", "upper", "scale"]
    assert wide.df().schema["dim_0"].metadata == {"uel": True}
    with pytest.raises(ValueError):
        scan_symbol(bundle, "x", value_field="Level")


def test_custom_key_names(bundle):
    assert scan_symbol(bundle, "x", keys=["from", "to"]).columns == ["from", "to", "level"]
    assert scan_symbol(bundle, "p", keys=["only"]).columns == ["dim_0", "dim_1", "value"]
    for keys in (["a", "a"], ["level", "b"]):
        with pytest.raises(ValueError):
            scan_symbol(bundle, "x", keys=keys)


def test_key_filters(bundle):
    count = lambda **f: len(tuples(scan_symbol(bundle, "x", key_filter={int(k[1:]): v for k, v in f.items()})))
    assert count(d0=["brno"]) == 3 and count(d0=["brno"], d1=["porto"]) == 1
    assert count(d0=["brno", "turku"], d1=["split"]) == 2 and count(d1=["porto"]) == 2
    assert count(d1=["PORTO"]) == count(d0=["nirgends"]) == count(d1=["brno"]) == count(d0=[]) == count(d0=["brno "]) == 0
    assert count(d0=["brno", "nowhere", None]) == 3
    scan = scan_symbol(bundle, "x", key_filter={0: ["brno"]})
    assert tuples(scan.where_keys({"dim_0": ["turku"]})) == []
    assert len(tuples(scan.where_keys({0: ["turku", "brno"]}).filter(F.col("level") > 0))) == 2
    assert scan.where_keys({0: ["nobody"]}).df().schema == scan.df().schema
    for bad in ({2: ["a"]}, {-1: ["a"]}, {"dim_9": ["a"]}, {0: "brno"}):
        with pytest.raises(ValueError):
            scan_symbol(bundle, "x").where_keys(bad)


def test_predicates(bundle):
    x = scan_symbol(bundle, "x")
    assert len(tuples(x.filter(F.col("dim_0") == "brno"))) == len(tuples(x.filter(F.lit("brno") == F.col("dim_0")))) == 3
    assert len(tuples(x.filter("dim_0 = 'brno' OR level > 250"))) == 4
    assert len(tuples(x.filter(F.col("dim_1").isin("split", "nowhere")))) == 2
    assert len(tuples(x.filter((F.col("dim_0") == "brno") & (F.col("level") > 0)))) == 2
    assert len(tuples(x.filter(x.ordinal(1) >= 4))) == 4
    assert [r[0] for r in tuples(x.where_ordinals(0, 2, 9))] == ["turku"] * 3
    assert sorted({r[0] for r in tuples(scan_symbol(bundle, "mixed"))}) == ["Lund", "OULU", "split"]


def test_head_is_a_slice(bundle):
    x = scan_symbol(bundle, "x")
    for scan in (x, x.where_keys({1: ["split", "porto"]}), x.filter("level > 0")):
        whole = tuples(scan)
        for n in (0, 1, 2, 10):
            assert tuples(scan.head(n)) == whole[:n]
    assert tuples(x.head(2).filter("level > 100")) == [("brno", "porto", 340.0)]
    assert x.head(3).to_arrow().num_rows == 3 and read_symbol(bundle, "x", n_rows=4).num_rows == 4
    with pytest.raises(ValueError):
        x.head(-1)


def test_projection_and_order(bundle):
    assert scan_symbol(bundle, "x").select("dim_1").columns == ["dim_1"]
    assert [r[0] for r in tuples(scan_symbol(bundle, "mixed"))] == ["split", "Lund", "OULU"]  # by label number
    by_second = scan_symbol(bundle, "d").sorted(1).df().collect()
    assert [r[1] for r in by_second] == ["graz"] * 2 + ["porto"] * 2 + ["split"] * 2


def test_domains(bundle):
    got = read_domains(bundle, "x")
    assert got.columns == ["dim_0", "dim_1"]
    assert [tuple(r) for r in got.collect()] == [("brno", "graz"), ("turku", "porto"), (None, "split")]
    assert read_domains(bundle, "p").columns == ["value", "value_1"]
    assert read_domains(bundle, "pi").columns == [] and read_domains(bundle, "none").collect() == []
    assert [r.uel for r in domain_elements(bundle, "x", 1).collect()] == [3, 4, 5]
    assert domain_elements(bundle, "x", 2).collect() == domain_elements(bundle, "pi", 0).collect() == []
    with pytest.raises(SymbolNotFoundError):
        read_domains(bundle, "nothing")


def test_lifecycle(spark, bundle):
    with Bundle(spark, bundle.path) as b:
        df = scan_symbol(b, "x").df()
    b.close()
    assert df.count() == 6 == df.count()
    for use in (b.symbols, b.uels, lambda: scan_symbol(b, "x"), b.__enter__):
        with pytest.raises(ClosedError, match="reader is closed"):
            use()
    assert scan_symbol(bundle.path, "x", spark=spark).df().count() == 6
    with pytest.raises(OpenReadError):
        Bundle(spark, bundle.path + "-absent")
    with pytest.raises(InvalidPathError):
        Bundle(spark, "")


def test_plans_push_filters_and_prune_columns(bundle):
    scan = scan_symbol(bundle, "x", key_filter={0: ["brno"]}).filter(F.col("dim_1") == "split")
    plan = scan.df()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k1,split)" in plan and "u0" in plan.split("PushedFilters")[1]
    schema = scan.select("dim_1")._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert "level" not in schema and "marginal" not in schema and "k0" not in schema
    empty = scan_symbol(bundle, "x", key_filter={0: ["nobody"]}).df()
    assert "FileScan" not in empty._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_writer_refuses_bad_symbols_and_stays_usable(spark, tmp_path):
    w = BundleWriter.create(spark, f"file://{tmp_path}/b", compression="snappy")
    two = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0)], ["x", "y", "v"])
    w.write_symbol("ok", two, ["x", "y"], {"level": "v"}, domains=["i", "j"])
    wide = two.select(*[F.lit(f"l{i}").alias(f"c{i}") for i in range(21)]).limit(1)
    bad = [
        ("ok", two, ["x", "y"], {}),
        ("", two, ["x", "y"], {}),
        ("dup", two, ["x"], {}),
        ("keys", two, ["x", "z"], {}),
        ("doms", two, ["x", "y"], {"domains": ["i"]}),
        ("doms", two, ["x", "y"], {"domains": ["i", "j", "k"]}),
        ("kind", two, ["x", "y"], {"kind": "Matrix"}),
        ("field", two, ["x", "y"], {"values": {"slack": "v"}}),
        ("wide", wide, wide.columns, {}),
        ("null", spark.createDataFrame([("a",), (None,)], ["x"]), ["x"], {}),
        ("long", spark.createDataFrame([("é" * 128,)], ["x"]), ["x"], {}),
    ]
    for name, data, keys, how in bad:
        with pytest.raises(InvalidWriteInputError):
            w.write_symbol(name, data, keys, **how)
    w.write_symbol("twenty", wide, wide.columns[:20])
    w.write_symbol("label", spark.createDataFrame([("é" * 127,)], ["x"]), ["x"])
    b = w.finish()
    assert [s.name for s in b.symbols()] == ["ok", "twenty", "label"]
    assert scan_symbol(b, "ok").columns == ["i", "j", "value"] and len(scan_symbol(b, "twenty").columns) == 21
    for late in (w.finish, lambda: w.write_symbol("late", two, ["x", "y"])):
        with pytest.raises(OpenWriteError):
            late()
    again = BundleWriter.create(spark, b.path)
    again.write_symbol("new", two, ["x", "y"])
    assert [s.name for s in again.finish().symbols()] == ["new"]
    with pytest.raises(OpenReadError):
        Bundle(spark, f"file://{tmp_path}/unfinished")


def test_unfinished_bundle_is_invisible(spark, tmp_path):
    two = spark.createDataFrame([("a", 1.0)], ["x", "v"])
    with pytest.raises(RuntimeError), BundleWriter.create(spark, f"file://{tmp_path}/b") as w:
        w.write_symbol("p", two, ["x"])
        raise RuntimeError("stop")
    with pytest.raises(OpenReadError):
        Bundle(spark, f"file://{tmp_path}/b")


def test_special_values(spark, tmp_path):
    codes = Sentinels(plus_inf=3e300, minus_inf=4e300, undef=1e300, na=2e300, eps=5e300)
    values = [3e300, 4e300, 1e300, 2e300, 5e300, 1.5, 0.0]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], ["k", "v"])
    got = [r[0] for r in df.select(map_special(F.col("v"), codes)).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4:] == [0.0, 1.5, 0.0]
    w = BundleWriter.create(spark, f"file://{tmp_path}/s")
    w.write_symbol("s", df, ["k"], {"level": "v"}, sentinels=codes)
    back = scan_symbol(w.finish(), "s").df()
    assert back.where(F.isnan("value")).count() == 2 and back.agg(F.count("value")).first()[0] == 7


@pytest.mark.parametrize("parts", [1, 2, 5, 16])
def test_results_do_not_depend_on_partitions(spark, tmp_path, parts):
    rows = spark.range(40 * 50).select((F.col("id") / 50).cast("int").alias("a"), (F.col("id") % 50).alias("b"))
    rows = rows.select(F.concat(F.lit("i"), F.col("a") + 1).alias("i"), F.concat(F.lit("j"), F.col("b") + 1).alias("j"), (F.col("a") * 1000 + F.col("b")).cast("double").alias("v"), "a", "b")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        w = BundleWriter.create(spark, f"file://{tmp_path}/big{parts}")
        w.write_symbol("big", rows.repartition(parts), ["i", "j"], {"level": "v"}, domains=["i", "j"], order=["a", "b"])
        b = w.finish()
        big = scan_symbol(b, "big", threads="auto")
        assert b.uel_table() == ["i1", *(f"j{k}" for k in range(1, 51)), *(f"i{k}" for k in range(2, 41))]
        assert len(tuples(big.where_keys({0: ["i7"]}))) == 50 and len(tuples(big.where_keys({1: ["j23"]}))) == 40
        whole = tuples(big)
        assert whole == [(f"i{a + 1}", f"j{c + 1}", a * 1000.0 + c) for a in range(40) for c in range(50)]
        assert tuples(big.filter("value % 7 = 3").head(11)) == [r for r in whole if r[2] % 7 == 3][:11]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_host_operations(bundle):
    x, d = scan_symbol(bundle, "x").df(), scan_symbol(bundle, "d").df()
    assert x.join(d, ["dim_0", "dim_1"]).count() == 6
    assert x.select("dim_0").distinct().count() == 2 and x.groupBy("dim_0").count().count() == 2
    assert [r[0] for r in x.select(F.upper("dim_0")).distinct().orderBy(F.upper("dim_0")).collect()] == ["BRNO", "TURKU"]


def test_names_that_differ_in_case_are_refused_and_internal_names_may_be_used(spark, tmp_path):
    two = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0)], ["x", "y", "v"])
    w = BundleWriter.create(spark, f"file://{tmp_path}/names")
    w.write_symbol("case", two, ["x", "y"], {"level": "v"}, domains=["I", "i"])
    w.write_symbol("odd", two, ["x", "y"], {"level": "v"}, domains=["_u0", "_AT"])
    w.write_symbol("dots", two, ["x", "y"], {"level": "v"}, domains=["a.b", "u0"])
    b = w.finish()
    with pytest.raises(ValueError, match="case"):
        scan_symbol(b, "case")
    with pytest.raises(ValueError, match="case"):
        read_domains(b, "case")
    assert tuples(scan_symbol(b, "case", keys=["p", "q"])) == [("a", "b", 1.0), ("a", "c", 2.0)]
    assert tuples(scan_symbol(b, "odd").where_keys({"_AT": ["c"]})) == [("a", "c", 2.0)]
    dots = scan_symbol(b, "dots")
    assert dots.columns == ["a.b", "u0", "value"] and tuples(dots.filter("`a.b` = 'a' AND u0 = 'b'")) == [("a", "b", 1.0)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert scan_symbol(b, "case").columns == ["I", "i", "value"] and tuples(scan_symbol(b, "case").filter("i = 'c'")) == [("a", "c", 2.0)]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("double", [100.0, 9.0, 10.0, -1.5]),
        ("decimal(10,2)", [Decimal("100.00"), Decimal("9.10"), Decimal("10.00"), Decimal("-1")]),
        ("date", [date(2020, 10, 1), date(2020, 2, 1), date(2020, 9, 30), date(999, 1, 1)]),
        ("timestamp", [datetime(2020, 10, 1), datetime(2020, 2, 1, 9), datetime(2020, 2, 1, 10), datetime(1960, 1, 1)]),
        ("string", ["d", "b", "c", "a"]),
        ("long", [100, 9, 10, -1]),
    ],
)
def test_labels_are_numbered_in_the_order_of_typed_columns(spark, tmp_path, kind, values):
    rows = spark.createDataFrame([(f"n{i}", v) for i, v in enumerate(values)], f"k string, v {kind}").repartition(3)
    w = BundleWriter.create(spark, f"file://{tmp_path}/typed")
    w.write_symbol("s", rows, ["k"], order=["v"])
    assert w.finish().uel_table() == [f"n{i}" for i in sorted(range(len(values)), key=lambda i: values[i])]


@pytest.fixture(scope="module")
def grid(spark, tmp_path_factory):
    """300 x 200 records over several partitions; the label of a row is its number."""
    rows = spark.range(60_000).select((F.col("id") / 200).cast("int").alias("a"), (F.col("id") % 200).cast("int").alias("b"))
    rows = rows.select("a", "b", F.concat(F.lit("r"), "a").alias("r"), F.concat(F.lit("c"), "b").alias("c"), (F.col("a") * 1000.0 + F.col("b")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        w = BundleWriter.create(spark, f"file://{tmp_path_factory.mktemp('grid')}/g")
        w.write_symbol("grid", rows, ["r", "c"], {"level": "v"}, domains=["r", "c"], order=["a", "b"])
        return w.finish()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Records that the scans of an executed plan delivered."""
    df.collect()
    node, found = df._jdf.queryExecution().executedPlan(), 0
    rest = [node]
    while rest:
        n = rest.pop()
        if n.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            rest.append(n.executedPlan())
            continue
        if n.getClass().getSimpleName() == "FileSourceScanExec":
            found += n.metrics().apply("numOutputRows").value()
        rest += [n.children().apply(i) for i in range(n.children().size())]
        if n.getClass().getSimpleName().endswith("QueryStageExec"):
            rest.append(n.plan())
    return found


def test_key_predicates_become_label_numbers(grid):
    scan = scan_symbol(grid, "grid")
    for condition in ("r = 'r7'", "'r7' = r", F.col("r").isin("r7", "nowhere", None), (F.col("value") >= 0) & (F.col("r") == "r7"), "r <=> 'r7'"):
        kept = scan.filter(condition)
        assert "EqualTo(u0," in plan_of(kept.df()) and [r[2] for r in tuples(kept)] == [7000.0 + b for b in range(200)]
        assert rows_read(kept.df()) < 60_000
    for condition in ("r = 'nowhere'", "r = 'c3'", F.col("r").isin("R7"), "r = 'r7' AND c = 'C3'", "r = NULL", F.col("r").isin(None, None)):
        assert tuples(scan.filter(condition)) == []
    for condition in ("r = 'nowhere'", "c = 'c3' AND r IN ('x', 'y')", "r = NULL"):
        assert "FileScan" not in plan_of(scan.filter(condition).df())
    assert len(tuples(scan.filter("r = 'r7' OR c = 'c3'"))) == 200 + 299  # no conjunction: left to Catalyst
    assert len(tuples(scan.filter("NOT r = 'r7'"))) == 59_800
    assert tuples(scan.filter("r = 'r7'").where_keys({"c": ["c3", "c4"]}).filter("c <> 'c4'")) == [("r7", "c3", 7003.0)]


def test_lookups_in_a_stored_label_table(spark, tmp_path, monkeypatch):
    from symcube.sources import writer

    monkeypatch.setattr(writer, "INLINE_BYTES", 0)
    rows = spark.range(500).select(F.concat(F.lit("r"), F.col("id") % 50).alias("a"), F.concat(F.lit("c"), "id").alias("b"))
    w = BundleWriter.create(spark, f"file://{tmp_path}/stored")
    w.write_symbol("s", rows, ["a", "b"], domains=["a", "b"])
    b = w.finish()
    assert b._labels is None and b.resolve(["r0", "c0", "no", None]) == [1, 2] and b.resolve([]) == []
    assert b.lookup([f"c{i}" for i in range(3000)]) == {r.label: r.uel for r in b.uels().where("label LIKE 'c%'").collect()}
    assert scan_symbol(b, "s").filter("a = 'r7'").df().count() == 10 and scan_symbol(b, "s").where_keys({0: ["r7"], 1: ["c7"]}).df().count() == 1
    assert "FileScan" not in plan_of(scan_symbol(b, "s").filter("a = 'nowhere'").df())


def test_long_scattered_lists(grid):
    scan = scan_symbol(grid, "grid")
    odd = scan.where_keys({0: [f"r{i}" for i in range(0, 300, 2)], 1: [f"c{i}" for i in range(0, 200_000, 2)]})
    assert odd.df().count() == 150 * 100
    many = [f"r{i}" for i in range(200_000) if i % 3] + [f"c{i}" for i in range(200)]
    kept = scan_symbol(grid, "grid", key_filter={0: many})
    assert kept.df().count() == 200 * 200 and kept.head(3).collect()[0][:2] == ("r1", "c0")
    assert scan.filter(F.col("r").isin([f"r{i}" for i in range(1, 1501, 3)])).df().count() == 100 * 200


def test_head_reads_a_prefix(grid):
    scan = scan_symbol(grid, "grid")
    whole = tuples(scan)
    assert len(grid.places("grid").collect()) > 1
    for n in (1, 10, 19_999, 30_000, 59_999, 60_000, 70_000):
        assert tuples(scan.head(n)) == whole[:n]
    assert "LessThanOrEqual(at,9)" in plan_of(scan.head(10).df()) and rows_read(scan.head(10).df()) <= 20_000
    assert tuples(scan.head(500).head(3)) == whole[:3] and tuples(scan.filter("c = 'c199'").head(2)) == [("r0", "c199", 199.0), ("r1", "c199", 1199.0)]
    assert tuples(scan.head(0)) == []


def test_physical_layout_and_integrity(spark, grid, tmp_path):
    assert grid.is_compressed() and sum(r.bytes for r in grid.files("grid").collect()) > 0
    assert [tuple(r) for r in grid.restart_points("grid").collect()][:3] == [(1, 0), (202, 200), (203, 400)]
    assert grid.restart_points("grid").count() == 300
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"))
    w = BundleWriter.create(spark, f"file://{tmp_path}/part", compression="none")
    w.write_symbol("s", rows, ["k"])
    b = w.finish()
    assert not b.is_compressed() and read_symbol(b, "s").num_rows == 1000
    spark.read.parquet(f"{b.root}/data/1").limit(10).write.mode("overwrite").parquet(f"file://{tmp_path}/copy")
    # the damage: fewer records than the catalog says
    spark.read.parquet(f"file://{tmp_path}/copy").write.mode("overwrite").parquet(f"{b.root}/data/1")
    with pytest.raises(IntegrityError):
        read_symbol(b, "s")


def test_low_level_read_is_tolerant(bundle):
    assert tuples(read_slot(bundle, "x", value_field="MARGINAL"))[1] == ("brno", "porto", 34.0)
    assert read_slot(bundle, "x", keys=["only"], value_field="Upper").columns == ["dim_0", "dim_1", "upper"]
    slot = read_slot(bundle, "d", value_field="marginal", n_rows=2)
    assert slot.columns == ["dim_0", "dim_1", "value"] and [r[2] for r in tuples(slot)] == [0.0, 0.0]
    assert tuples(read_slot(bundle, "d", key_filter={0: ["nobody"]})) == []
    with pytest.raises(BundleError):
        read_slot(bundle, "d", value_field="nope", key_filter={0: []})


def test_a_rewritten_bundle_switches_at_once(spark, tmp_path):
    two = spark.createDataFrame([("a", 1.0), ("b", 2.0)], ["x", "v"])
    w = BundleWriter.create(spark, f"file://{tmp_path}/b")
    w.write_symbol("p", two, ["x"], {"level": "v"})
    first = w.finish()
    old = scan_symbol(first, "p").df()
    with pytest.raises(RuntimeError), BundleWriter.create(spark, first.path) as w:
        w.write_symbol("q", two, ["x"])
        raise RuntimeError("stop")
    assert [s.name for s in Bundle(spark, first.path).symbols()] == ["p"]
    w = BundleWriter.create(spark, first.path)
    w.write_symbol("q", two, ["x"], {"level": "v"})
    assert [s.name for s in w.finish().symbols()] == ["q"] and old.count() == 2  # what was open before goes on


def test_a_hot_label_in_a_large_dimension(spark, tmp_path, monkeypatch):
    from symcube.sources import writer

    monkeypatch.setattr(writer, "BROADCAST_BYTES", 0)
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("a"), F.col("id").cast("string").alias("b"))
    w = BundleWriter.create(spark, f"file://{tmp_path}/hot")
    w.write_symbol("s", rows, ["a", "b"])
    b = w.finish()
    assert scan_symbol(b, "s").where_keys({0: ["hot"]}).df().count() == 1667 and scan_symbol(b, "s").df().count() == 5000


def test_keys_as_categories(bundle):
    scan = scan_symbol(bundle, "x")
    table = scan.to_arrow(categories=True)
    assert table.column_names == ["dim_0", "dim_1", "level"] and table.to_pylist() == scan.to_arrow().to_pylist()
    keys = table["dim_1"].chunk(0)
    assert keys.type.ordered and keys.dictionary.to_pylist() == bundle.uel_table() and str(keys.type.index_type) == "int16"
    empty = scan.where_keys({0: ["nobody"]}).to_arrow(categories=True)
    assert empty.num_rows == 0 and empty.schema.field("dim_0").type == table.schema.field("dim_0").type


def test_several_symbols_are_staged_together_or_not_at_all(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame([(x, float(n)) for n, x in enumerate(rows)], "k string, v double")
    symbol = lambda name, *rows: {"name": name, "records": frame(*rows), "keys": ["k"], "values": {"level": "v"}, "order": ["v"]}
    w = BundleWriter.create(spark, f"file://{tmp_path}/many")
    for wrong in ([symbol("a", "x"), symbol("a", "y")], [symbol("a", "x"), symbol("b", "y", "y")], [symbol("a", "x"), symbol("b", None)], [symbol("", "x")]):
        with pytest.raises(InvalidWriteInputError):
            w.write_symbols(wrong)
    w.write_symbols([symbol(f"s{n}", *[f"l{(n * 3 + i) % 10}" for i in range(4)]) for n in range(9)])
    b = w.finish()
    assert [s.name for s in b.symbols()] == [f"s{n}" for n in range(9)]
    assert b.uel_table() == [f"l{i}" for i in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)]
    assert sorted(tuples(scan_symbol(b, "s8"))) == [("l4", 0.0), ("l5", 1.0), ("l6", 2.0), ("l7", 3.0)]
