"""The catalogue of queries on the bundle of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from symcube.functions.storage import scratch
from symcube.functions.special import Sentinels, map_special
from symcube.operators import domain_elements, list_symbols, read_domains, read_slot, scan_symbol
from symcube.operators.scan import SymbolScan
from symcube.plans.tables import bundle
from symcube.sources import Bundle, BundleWriter
from symcube.sources.errors import InvalidWriteInputError

Query = Callable[[SparkSession, str], DataFrame]


def _scan(symbol: str, **how) -> Callable[[SparkSession, str], SymbolScan]:
    return lambda spark, sf_dir: scan_symbol(bundle(spark, sf_dir), symbol, **how)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _numbered(scan: SymbolScan, *order: str) -> DataFrame:
    """A bounded result with its place in the order, which a hash of unordered rows can see."""
    return scan.df(ordinals=True).withColumn("place", F.row_number().over(W.orderBy(*order)))


def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).df()


def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = list_symbols(bundle(spark, sf_dir))
    return found.select("name", "type", "dim", "records", F.array_join("domains", ",").alias("domains"), "text")


def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_domains(bundle(spark, sf_dir), "bal", ordinal="place")


def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain_elements(bundle(spark, sf_dir), "ship", 2)


def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle(spark, sf_dir).uels()


def q05_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle(spark, sf_dir).uels().agg(F.count("*").alias("n"), F.max("uel").alias("high"))


def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship", keys=["o", "p", "s", "l", "d"])(spark, sf_dir).df()


def q07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship", all_fields=True)(spark, sf_dir).df()


def q08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).filter(F.col("customer").like("%7")).df()


def q09(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = _scan("bal")(spark, sf_dir)
    return scan.filter(scan.ordinal(1) % 2 == 0).df()


def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(_scan("bal")(spark, sf_dir).head(10), "u0", "u1")


def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the segments that come second and third in label order."""
    of = bundle(spark, sf_dir)
    used = [r.uel for r in domain_elements(of, "bal", 0).collect()]  # five segments
    return scan_symbol(of, "bal").where_ordinals(0, used[1], used[2]).df(ordinals=True)


def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A symbol is written and read back; one with repeated keys is refused, and the writer goes on."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    refused = 0
    with BundleWriter.create(spark, scratch(spark, "written"), producer="q12", compression="snappy") as w:
        w.write_symbol("bal", customer, ["c_mktsegment", "c_name"], {"level": "c_acctbal"}, domains=["segment", "customer"], order=["c_custkey"])
        try:
            w.write_symbol("repeated", customer, ["c_mktsegment"], order=["c_acctbal"])
        except InvalidWriteInputError:
            refused = 1
        w.write_symbol("by_balance", customer, ["c_name"], order=["c_acctbal", "c_custkey"])
        path = w.path
    back = scan_symbol(path, "bal", spark=spark).df()
    return back.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"), F.lit(refused).alias("refused"))


def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).select("customer")


def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship", value_field="marginal")(spark, sf_dir).df()


def q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("price")(spark, sf_dir).df()


def q16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal", value_field="marginal")(spark, sf_dir).df()


def q17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount 0 as EPS, 0.05 as +Inf and 0.06 as -Inf; tax 0 as NA and 0.01 as Undef."""
    rows = _scan("ship", all_fields=True)(spark, sf_dir).df()
    low = map_special(F.when(F.col("lower") == 0, F.lit(5e300)).otherwise(F.col("lower")), Sentinels(plus_inf=0.05, minus_inf=0.06, eps=5e300))
    up = map_special(F.col("upper"), Sentinels(na=0.0, undef=0.01))
    rows = rows.select(low.alias("low"), up.alias("up"))
    count = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("long")
    return rows.agg(
        count(F.col("low") == 0).alias("n_eps"),
        count(F.col("low") == float("inf")).alias("n_plus"),
        count(F.col("low") == float("-inf")).alias("n_minus"),
        count(F.isnan("up")).alias("n_nan"),
        F.count("up").alias("n"),
    )


def q18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).df().select(F.upper("segment").alias("segment")).distinct()


def q19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal", key_filter={0: ["BUILDING", "nowhere"]})(spark, sf_dir).df()


def q20(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = _scan("bal")
    tests = [("wrong case", {0: ["building"]}), ("unknown", {1: ["nobody"]}), ("empty list", {0: []}), ("trailing blank", {0: ["BUILDING "]})]
    parts = [_count(scan(spark, sf_dir).where_keys(t).df()).select(F.lit(name).alias("test"), "n") for name, t in tests]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).filter(F.col("segment") == "BUILDING").df()


def q22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).filter(F.col("segment").isin("BUILDING", "MACHINERY", "nowhere", None)).df()


def q23(spark: SparkSession, sf_dir: str) -> DataFrame:
    regular = _scan("ev")(spark, sf_dir)
    return regular.filter((F.col("dim_0") == "click") & F.col("user").isin("u1", "u2", "u3")).df()


def q24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal", key_filter={0: ["BUILDING", "MACHINERY"]})(spark, sf_dir).filter(F.col("segment") != "BUILDING").where_keys({0: ["MACHINERY", "BUILDING"]}).df()


def q25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's name is a label of the file, but none of the first dimension."""
    of = bundle(spark, sf_dir)
    name = scan_symbol(of, "bal").head(1).df().first()["customer"]
    return _count(scan_symbol(of, "bal", key_filter={0: [name]}).df())


def q26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).filter(F.col("value") > 5000).df()


def q27(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).filter((F.col("segment") == "BUILDING") | (F.col("value") < 0)).df()


def q28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ev", key_filter={1: ["u1", "u5", "u7"]})(spark, sf_dir).df()


def q29(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(_scan("bal")(spark, sf_dir).filter(F.col("value") > 0).head(5), "u0", "u1")


def q30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities by label number, which is not the order of their names."""
    return domain_elements(bundle(spark, sf_dir), "total", 0).select(F.col("label").alias("priority"), F.row_number().over(W.orderBy("uel")).alias("place"))


def q31(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship, total = (_scan(s)(spark, sf_dir).df() for s in ("ship", "total"))
    return ship.join(total.withColumnRenamed("level", "total"), "order").groupBy("priority").agg(
        F.count("*").alias("n"), F.sum(F.col("level").cast("decimal(18,4)")).cast("double").alias("quantity")
    )


def _of_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship", key_filter={2: ["s1"]})(spark, sf_dir).select("order")


def q32_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("total")(spark, sf_dir).df().join(_of_supplier(spark, sf_dir), "order", "left_semi").select("priority", "order", "level")


def q32_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("total")(spark, sf_dir).df().join(_of_supplier(spark, sf_dir), "order", "left_anti").select("priority", "order", "level")


def q33(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("bal")(spark, sf_dir).df().groupBy("segment").agg(F.count("*").alias("n"))


def q34(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship")(spark, sf_dir).df().select("order", "part").distinct()


def q35(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("ship")(spark, sf_dir).df().groupBy("supp").agg(F.countDistinct("order").alias("n_orders"))


def q36_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("nlines")(spark, sf_dir).df()


def q37_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan("nation")(spark, sf_dir).df()


def q38(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The low-level read: a tolerant spelling of the value field, whose slot is shown whatever the kind."""
    ship = read_slot(bundle(spark, sf_dir), "ship", value_field="UPPER").select("order", "part", "supp", "line", "day", "upper")
    price = read_slot(bundle(spark, sf_dir), "price", keys=["brand", "part"], value_field="Marginal").df()
    return ship.agg(F.count("*").alias("n"), F.sum(F.col("upper").cast("decimal(18,4)")).cast("double").alias("upper")).join(
        price.agg(F.count("*").alias("n_price"), F.max("value").alias("marginal"))  # one row each
    )


def q39(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle(spark, sf_dir).restart_points("bal")


def q40(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100,000 scattered labels, most of them unknown."""
    return _scan("ev", key_filter={1: [f"u{i}" for i in range(0, 200_000, 2)]})(spark, sf_dir).df()


def q41(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a conjunction that compare keys with labels, in either order, beside another condition."""
    return _scan("ship")(spark, sf_dir).filter("'s7' = supp AND line IN ('l1', 'l2', 'no such line') AND level > 10").df()


def q42(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in the order of a column of doubles."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    with BundleWriter.create(spark, scratch(spark, "typed"), producer="q42") as w:
        w.write_symbol("s", customer, ["c_name"], {"level": "c_acctbal"}, order=["c_acctbal", "c_custkey"])
        path = w.path
    return Bundle(spark, path).uels()


def q43(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_domains(bundle(spark, sf_dir), "ship", ordinal="place")


QUERIES: dict[str, Query] = {
    "q01_scan": q01,
    "q02_catalog": q02,
    "q03_domains": q03,
    "q04_domain_elements": q04,
    "q05_label_table": q05,
    "q05_label_counts": q05_counts,
    "q06_custom_key_names": q06,
    "q07_all_fields": q07,
    "q08_label_predicate": q08,
    "q09_ordinal_predicate": q09,
    "q10_head": q10,
    "q11_ordinal_range": q11,
    "q12_write_read": q12,
    "q13_projection": q13,
    "q14_value_field": q14,
    "q15_name_collisions": q15,
    "q16_ignored_value_field": q16,
    "q17_special_values": q17,
    "q18_upper": q18,
    "q19_key_filter": q19,
    "q20_empty_filters": q20,
    "q21_equality": q21,
    "q22_is_in": q22,
    "q23_conjunction": q23,
    "q24_intersection": q24,
    "q25_unused_label": q25,
    "q26_value_predicate": q26,
    "q27_disjunction": q27,
    "q28_inner_dimension": q28,
    "q29_filter_then_head": q29,
    "q30_label_order": q30,
    "q31_join": q31,
    "q32_semi_join": q32_semi,
    "q32_anti_join": q32_anti,
    "q33_group_count": q33,
    "q34_distinct": q34,
    "q35_count_distinct": q35,
    "q36_scalar": q36_scalar,
    "q37_set": q37_sets,
    "q38_low_level": q38,
    "q39_restart_points": q39,
    "q40_long_list": q40,
    "q41_key_conjunction": q41,
    "q42_typed_order": q42,
    "q43_five_domains": q43,
}
