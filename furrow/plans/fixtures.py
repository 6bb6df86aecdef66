"""Inputs that queries derive from the driver's tables, as DataFrames and as DuckDB SQL, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
LEGEND = {0: "背景/非农田", 1: "玉米", 2: "小麦", 3: "大豆"}
CODES = [0, 1, 2, 3]
SAMPLE_CODES = [0, 1, 2]
SAMPLE_LEGEND = {0: "背景/非农田", 1: "玉米", 2: "小麦"}


def query(sql: str | None = None):
    """Register a function as a query under its own name, with the SQL that says the same."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(x: Column) -> Column:
    """Four decimals without a negative zero."""
    return F.round(x, 4) + 0.0


def r4n(x: Column) -> Column:
    """Four decimals; exact halves, which two engines may round differently, are moved up first."""
    return F.round(x + 1e-9, 4) + 0.0


def nudged(sql: str) -> str:
    """The same in SQL: every `round(x, 4)` becomes `round((x) + 1e-9, 4)`."""
    out, at = "", 0
    while (i := sql.find("round(", at)) >= 0:
        depth, j, comma = 1, i + 6, -1
        while depth:
            c = sql[j]
            depth += (c in "([") - (c in ")]")
            if c == "," and depth == 1:
                comma = j
            j += 1
        inner = nudged(sql[i + 6 : comma])
        out += sql[at:i] + (f"round(({inner}) + 1e-9, 4)" if sql[comma:j].replace(" ", "") == ",4)" else f"round({inner}{sql[comma:j]}")
        at = j
    return out + sql[at:]


def query_n(sql: str | None = None):
    """query() for results by r4n()."""
    return query(nudged(sql) if sql else None)


# ---- a validation sample and its map, from lineitem

FLAG = "CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END"
SAMPLE_SQL = f"""SELECT {FLAG} AS map_label, CASE WHEN (l_orderkey * 7 + l_linenumber * 3) % 11 = 0 THEN ({FLAG} + 1) % 3 ELSE {FLAG} END AS true_label,
    CAST(1 AS DOUBLE) AS weight FROM lineitem WHERE l_orderkey % 97 = 0"""
MAP_SQL = f"SELECT {FLAG} AS code FROM lineitem"
MACRO_SQL = "SELECT CASE WHEN l_quantity <= 40 THEN 0 WHEN l_quantity <= 48 THEN 1 ELSE 2 END AS code FROM lineitem"


def sample(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_orderkey % 97 = 0").select(F.expr(FLAG).alias("map_label"), ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 11 == 0).alias("flip"))
    return rows.select("map_label", F.when(F.col("flip"), (F.col("map_label") + 1) % 3).otherwise(F.col("map_label")).alias("true_label"), F.lit(1.0).alias("weight"))


def class_map(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.expr(FLAG).alias("code"))


def macro_map(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.when(F.col("l_quantity") <= 40, 0).when(F.col("l_quantity") <= 48, 1).otherwise(2).alias("code"))


# ---- a pixel grid with ridges between blocks, from events

RIDGE = "(event_id // 100) % 12 = 0 OR (event_id % 100) % 15 = 0"
GRID_SQL = f"""SELECT event_id // 100 AS r, event_id % 100 AS c, CASE WHEN {RIDGE} THEN 0 ELSE (((event_id // 100) // 12) * 7 + ((event_id % 100) // 15) * 3) % 4 END AS code,
    least(value / 100, 1) AS conf, value FROM events"""
LATE_SQL = f"SELECT event_id // 100 AS r, event_id % 100 AS c, CASE WHEN {RIDGE} THEN 0 ELSE (((event_id // 100) // 12) * 5 + ((event_id % 100) // 15) * 2) % 4 END AS code FROM events"


def grid(spark: SparkSession, d: str, a: int = 7, b: int = 3) -> DataFrame:
    rows = table(spark, d, "events").select(F.expr("event_id DIV 100").alias("r"), (F.col("event_id") % 100).alias("c"), "value")
    code = F.when((F.col("r") % 12 == 0) | (F.col("c") % 15 == 0), 0).otherwise((F.expr("r DIV 12") * a + F.expr("c DIV 15") * b) % 4)
    return rows.select("r", "c", code.cast("int").alias("code"), F.least(F.col("value") / 100, F.lit(1.0)).alias("conf"), "value")


# ---- series of eight values, from events

BINS_SQL = """SELECT user_id, CAST(floor(date_diff('hour', TIMESTAMP '2024-01-01', ts) / 90.0) AS INT) AS t, avg(value) / 200 AS v FROM events GROUP BY 1, 2"""
SERIES_SQL = f"SELECT user_id, list(v ORDER BY t) AS v FROM ({BINS_SQL}) GROUP BY 1 HAVING count(*) = 8"


def series(spark: SparkSession, d: str) -> DataFrame:
    """user_id and v, for users with all eight bins.

    A bin's values are added in the order in which the files hold them, as SQL adds them in one thread: partial sums that meet in any
    order differ in the last bit from run to run, and values on a threshold with them. A bin without a time comes last.
    Hours are counted by their beginnings, as SQL's date_diff does: before the origin a part of an hour goes down, not towards the origin.
    """
    hours = F.timestamp_diff("HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp"), F.date_trunc("HOUR", "ts"))
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    placed = table(spark, d, "events").select("user_id", F.floor(hours / 90.0).cast("int").alias("t"), *place, "value")
    so_far = Window.partitionBy("user_id", "t").orderBy("file", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # streams, and spills
    added = placed.select("user_id", "t", F.count("*").over(so_far).alias("k"), F.count("value").over(so_far).alias("n"), F.sum("value").over(so_far).alias("s"))
    bins = added.groupBy("user_id", "t").agg(F.max_by(F.struct("s", "n"), "k").alias("x")).select("user_id", "t", (F.try_divide("x.s", "x.n") / 200).alias("v"))
    whole = bins.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(F.isnull("t"), "t", "v"))).alias("s"))
    return whole.where("size(s) = 8").select("user_id", F.transform("s", lambda x: x["v"]).alias("v"))


# ---- points and a parcel table, from customer

POINT_SQL = """SELECT c_custkey, 73 + CAST(c_custkey * 37 % 6200 AS DOUBLE) / 100 AS lon, 18 + CAST(c_custkey * 53 % 3600 AS DOUBLE) / 100 AS lat,
    CAST(c_custkey * 9973 % 400000 AS DOUBLE) / 100 AS area_mu, CAST(5 + c_custkey % 90 AS DOUBLE) / 100 AS compactness FROM customer"""


def points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    part = lambda x: x.cast("double") / 100
    return table(spark, d, "customer").select("c_custkey", (73 + part(k * 37 % 6200)).alias("lon"), (18 + part(k * 53 % 3600)).alias("lat"), part(k * 9973 % 400000).alias("area_mu"), part(5 + k % 90).alias("compactness"))


# ---- spectral bands, from lineitem

BAND_SQL = """SELECT l_orderkey, l_linenumber, CAST(500 + l_partkey * 13 % 1500 AS DOUBLE) AS b2, CAST(400 + l_suppkey * 17 % 1800 AS DOUBLE) AS b3,
    CAST(800 + l_orderkey * 7 % 3000 AS DOUBLE) AS b4, CAST(300 + l_partkey * 29 % 2500 AS DOUBLE) AS b5 FROM lineitem"""


def bands(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *(x.cast("double").alias(n) for n, x in (("b2", 500 + c("l_partkey") * 13 % 1500), ("b3", 400 + c("l_suppkey") * 17 % 1800), ("b4", 800 + c("l_orderkey") * 7 % 3000), ("b5", 300 + c("l_partkey") * 29 % 2500))))
