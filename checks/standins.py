"""The given tables read as versioned, multi-tenant extracts.

``ExtractId`` is the year of a date less 1994 (1 to 7) for orders and line items; reference data
arrives with extract 1, some of it later. Nations are the practices: an order belongs to the nation
of its customer, a line item to that of its supplier (or, routed, to that of its order). A line
item with return flag R counts as deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.registry import COMMON, PRACTICE, TENANT, VERSION, ForeignKey, Registry, Table, Via

REGISTRY = Registry(
    (
        Table("customer", COMMON, ("c_custkey",), tenant=None),
        Table("events", PRACTICE, tenant="user_id"),
        Table("lineitem", PRACTICE, ("l_orderkey", "l_linenumber"), deleted="Deleted",
              tenant=None, via=Via("l_orderkey", "orders", "o_orderkey")),
        Table("nation", COMMON, ("n_nationkey",), tenant=None),
        Table("orders", PRACTICE, ("o_orderkey",), tenant="OrganisationGuid"),
        Table("part", COMMON, ("p_partkey",), tenant=None),
        Table("supplier", COMMON, ("s_suppkey",), tenant=None),
    ),
    (
        ForeignKey(1, "customer", "c_nationkey", "nation", "n_nationkey"),
        ForeignKey(2, "events", "user_id", "customer", "c_custkey"),
        ForeignKey(3, "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ForeignKey(4, "lineitem", "l_partkey", "part", "p_partkey"),
        ForeignKey(5, "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ForeignKey(6, "orders", "o_custkey", "customer", "c_custkey"),
        ForeignKey(7, "supplier", "s_nationkey", "nation", "n_nationkey"),
    ),
)
LINEITEM = REGISTRY.table("lineitem")
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


_SCHEMAS: dict[str, StructType] = {}


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once, not for every use."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def year_version(column: str) -> Column:
    return (F.year(column) - 1994).alias(VERSION)


def store_name(nation: str | Column) -> Column:
    return F.concat(F.lit("Nation"), F.col(nation).cast("string")).alias(TENANT)


def late(condition: Column, extract: int) -> Column:
    return F.when(condition, extract).otherwise(1).alias(VERSION)


def lineitem(spark: SparkSession, folder: str, text_dates: bool = False) -> DataFrame:
    """Line items as history; the date as seconds, or as text the way extracts carry it."""
    shipped = stamp("l_shipdate") if text_dates else F.unix_timestamp("l_shipdate")
    return given(spark, folder, "lineitem").select(
        *LINE_COLUMNS,
        shipped.alias("shipped"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("Deleted"),
        year_version("l_shipdate"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    homes = given(spark, folder, "customer").select("c_custkey", store_name("c_nationkey"))
    return (
        given(spark, folder, "orders")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", TENANT, year_version("o_orderdate"))
    )


def lineitem_of_supplier(
    spark: SparkSession, folder: str, text_dates: bool = False
) -> DataFrame:
    homes = given(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("_supplier"), store_name("s_nationkey")
    )
    lines = lineitem(spark, folder, text_dates)
    return lines.join(homes, F.col("l_suppkey") == F.col("_supplier")).drop("_supplier")


def events(spark: SparkSession, folder: str) -> DataFrame:
    homes = given(spark, folder, "customer").select("c_custkey", store_name("c_nationkey"))
    return (
        given(spark, folder, "events")
        .join(homes, F.col("user_id") == F.col("c_custkey"))
        .select(
            "event_id", "user_id", TENANT,
            F.ceil(F.dayofmonth("ts") / 5).cast("int").alias(VERSION),
        )
    )


def histories(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    def common(name: str, version: Column, *columns: str) -> DataFrame:
        return given(spark, folder, name).select(*columns, version)

    return {
        "customer": common(
            "customer", late(F.col("c_acctbal") < 0, 2), "c_custkey", "c_nationkey"
        ),
        "events": events(spark, folder),
        "lineitem": lineitem_of_supplier(spark, folder),
        "nation": common("nation", late(F.col("n_regionkey") == 4, 2), "n_nationkey"),
        "orders": orders(spark, folder),
        "part": common("part", late(F.col("p_size") > 40, 3), "p_partkey"),
        "supplier": common(
            "supplier", late(F.col("s_acctbal") < 0, 2), "s_suppkey", "s_nationkey"
        ),
    }


def practices(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as configured practices; those of region 4 start with extract 2."""
    number = F.col("n_nationkey").cast("string")
    return given(spark, folder, "nation").select(
        F.concat(F.lit("org-"), number).alias("OrganisationGuid"),
        F.col("n_name").alias("PracticeName"),
        F.concat(F.lit("N"), number).alias("ODSCode"),
        F.col("n_nationkey").cast("int").alias("CDB"),
        F.concat(F.lit("Nation"), number).alias("PracticeDBName"),
        F.when(F.col("n_regionkey") == 4, 2).otherwise(1).alias("StartExtractId"),
        F.lit(False).alias("NewlyConfigured"),
        F.lit(None).cast("int").alias("ConfiguredAfter"),
    )
