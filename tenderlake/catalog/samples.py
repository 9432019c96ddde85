"""The sample tables seen as procurement data: silver-shaped notices, items and bids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.schemas import KEY, MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("notice_no"),
        F.col("o_custkey").cast("string").alias("unit_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("modality_id"),
        F.date_format("o_orderdate", "yyyyMM").alias("period"),
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        "o_orderdate",
        "o_totalprice",
    )


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as notices of the unit (customer), its agency (nation) and parent (region)."""
    orders = _orders(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # Nations and regions are fixed by the sample schema: 25 and 5 rows.
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    placed = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    value = F.when(F.col("o_orderkey") % 28 != 0, F.col("o_totalprice").cast(MONEY))
    return placed.select(
        "notice_no",
        "unit_id",
        F.col("c_name").alias("unit_name"),
        "modality_id",
        F.col("o_orderpriority").alias("modality_name"),
        F.concat(F.lit("P"), "notice_no").alias("process_no"),
        F.concat_ws("; ", F.lit("Aquisição"), "c_mktsegment", "o_orderpriority").alias("subject"),
        F.col("o_orderstatus").alias("status"),
        F.col("n_regionkey").cast("string").alias("parent_agency_id"),
        F.col("r_name").alias("parent_agency_name"),
        F.col("c_nationkey").cast("string").alias("agency_id"),
        F.col("n_name").alias("agency_name"),
        F.substring("n_name", 1, 2).alias("state"),
        F.col("c_mktsegment").alias("city"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("result_date"),
        F.to_date("o_orderdate").alias("opening_date"),
        value.alias("value"),
        F.col("o_orderkey").alias("line_no"),
        "period",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the key of their notice and the supplier id, a share of them sentinels."""
    orders = _orders(spark, sf_dir).select("o_orderkey", *KEY, "period")
    text = F.lpad(F.col("l_suppkey").cast("string"), 14, "0")
    kind = F.col("l_suppkey") % 20
    supplier = (
        F.when(kind == 0, "-11").when(kind == 1, "-2").when(kind == 2, F.concat(F.lit("ESTRANG"), text)).otherwise(text)
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("supplier_id", supplier)
        .withColumn("item_code", F.col("l_partkey").cast("string"))
    )


def _line_no() -> Column:
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no")


def _of_item() -> list[Column]:
    return [
        F.concat(F.lit("Item "), "item_code").alias("description"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_value"),
        F.col("supplier_id").alias("winner_id"),
        F.concat(F.lit("Supplier "), "supplier_id").alias("winner_name"),
    ]


def _of_bid() -> list[Column]:
    """One bid per line; modality 5 is a direct purchase with a single bidder per notice."""
    direct = F.lpad("unit_id", 14, "0")
    bidder = F.when(F.col("modality_id") == 5, direct).otherwise(F.col("supplier_id"))
    return [
        bidder.alias("bidder_id"),
        F.concat(F.lit("Supplier "), bidder).alias("bidder_name"),
        (F.col("l_returnflag") == "R").alias("is_winner"),
    ]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(*KEY, "item_code", *_of_item(), _line_no(), "period")


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(*KEY, "item_code", *_of_bid(), _line_no(), "period")


def items_and_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item and the bid of every line side by side, so that orders and lines meet once.

    The rows of a task come by period: sorted here, they are narrower than anything made of them.
    """
    lines = _lines(spark, sf_dir).sortWithinPartitions("period")
    return lines.select(*KEY, "item_code", *_of_item(), *_of_bid(), "period")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("unit_id"), F.col("c_nationkey").cast("string").alias("agency_id")
    )


# The same views in SQL, for the comparison engine.
SQL_NOTICES = """
notices AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS notice_no, CAST(o_custkey AS VARCHAR) AS unit_id,
         c_name AS unit_name, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS modality_id,
         o_orderpriority AS modality_name, 'P' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS process_no,
         'Aquisição; ' || c_mktsegment || '; ' || o_orderpriority AS subject, o_orderstatus AS status,
         CAST(n_regionkey AS VARCHAR) AS parent_agency_id, r_name AS parent_agency_name,
         CAST(c_nationkey AS VARCHAR) AS agency_id, n_name AS agency_name, substr(n_name, 1, 2) AS state,
         c_mktsegment AS city, CAST(o_orderdate AS DATE) + 30 AS result_date, CAST(o_orderdate AS DATE) AS opening_date,
         CASE WHEN o_orderkey % 28 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,4)) END AS value,
         o_orderkey AS line_no, strftime(o_orderdate, '%Y%m') AS period
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""
SQL_LINES = """
lines AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS notice_no, CAST(o_custkey AS VARCHAR) AS unit_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS modality_id, strftime(o_orderdate, '%Y%m') AS period,
         CAST(l_partkey AS VARCHAR) AS item_code, CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,4)) AS unit_value, l_returnflag, l_orderkey * 10 + l_linenumber AS line_no,
         CASE l_suppkey % 20 WHEN 0 THEN '-11' WHEN 1 THEN '-2'
              WHEN 2 THEN 'ESTRANG' || lpad(CAST(l_suppkey AS VARCHAR), 14, '0')
              ELSE lpad(CAST(l_suppkey AS VARCHAR), 14, '0') END AS supplier_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""
SQL_ITEMS = (
    SQL_LINES
    + """,
items AS (
  SELECT notice_no, unit_id, modality_id, period, item_code, quantity, unit_value, supplier_id AS winner_id,
         'Supplier ' || supplier_id AS winner_name, line_no FROM lines
)"""
)
SQL_BIDS = """
bids AS (
  SELECT *, 'Supplier ' || bidder_id AS bidder_name FROM (
    SELECT notice_no, unit_id, modality_id, period, item_code, l_returnflag = 'R' AS is_winner, line_no,
           CASE WHEN modality_id = 5 THEN lpad(unit_id, 14, '0') ELSE supplier_id END AS bidder_id
    FROM lines)
)"""
