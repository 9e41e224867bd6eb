"""The TPC-H-like tables as symbols of one bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symcube.functions.storage import scratch
from symcube.sources import Bundle, BundleWriter

_BUNDLES: dict[tuple[str, str], str] = {}


def write_bundle(spark: SparkSession, sf_dir: str, path: str) -> Bundle:
    """Write the eight symbols that the queries use."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def label(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    region, nation = table("region"), table("nation")
    order_label, part_label = label("o", "o_orderkey"), label("p", "p_partkey")
    lines = table("lineitem").select(
        "*",
        label("o", "l_orderkey").alias("order"),
        label("p", "l_partkey").alias("part"),
        label("s", "l_suppkey").alias("supp"),
        label("l", "l_linenumber").alias("line"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
    )
    events = table("events").select("*", label("u", "user_id").alias("user"), label("e", "event_id").alias("event"))
    of = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])  # 5 rows at any scale
    parts = table("part").select("*", part_label.alias("part"))
    orders = table("orders").select("*", order_label.alias("order"))
    count = table("lineitem").agg(F.count("*").cast("double").alias("n"))
    fields = {"level": "l_quantity", "marginal": "l_extendedprice", "lower": "l_discount", "upper": "l_tax", "scale": F.lit(1.0)}
    place = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "day"]
    domains = ["order", "part", "supp", "line", "day"]

    def symbol(name: str, records: DataFrame, keys: list[str], values: dict | None = None, **how) -> dict:
        return {"name": name, "records": records, "keys": keys, "values": values, **how}

    with BundleWriter.create(spark, path) as w:
        w.write_symbols(
            [
                symbol("region", region, ["r_name"], kind="Set", text="regions", order=["r_regionkey"]),
                symbol("nation", of, ["n_name", "r_name"], kind="Set", text="nations", domains=["nation", "region"], order=["n_nationkey"]),
                symbol("bal", table("customer"), ["c_mktsegment", "c_name"], {"level": "c_acctbal"}, text="balance", domains=["segment", "customer"], order=["c_custkey"]),
                symbol("price", parts, ["p_brand", "part"], {"level": "p_retailprice"}, text="price", domains=["value", "value"], order=["p_partkey"]),
                symbol("total", orders, ["o_orderpriority", "order"], {"level": "o_totalprice"}, kind="Equation", text="order total", domains=["priority", "order"], order=["o_orderkey"]),
                symbol("ship", lines, domains, fields, kind="Variable", text="shipments", domains=domains, order=place),
                symbol("ev", events, ["event_type", "user", "event"], {"level": "value"}, text="events", domains=["*", "user", "*"], order=["event_id"]),
                symbol("nlines", count, [], {"level": "n"}, text="number of line items"),
            ]
        )
    return Bundle(spark, path)


def bundle(spark: SparkSession, sf_dir: str) -> Bundle:
    """The bundle of a table directory, written once per session to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUNDLES:
        path = scratch(spark, "bundle")
        write_bundle(spark, sf_dir, path)
        _BUNDLES[key] = path
    return Bundle(spark, _BUNDLES[key])
