"""Registry of checks, and the survey-like views of the given tables.

Each view exists twice: as a DataFrame and as SQL text under the same name. SQL texts restate the
semantics on their own terms (whole-line windows, brute-force joins, built-in quantiles).
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake.operators.along import Track, every
from soundlake.operators.raster import Grid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, views: str = "", sql: str | None = None):
    """Register a query; ``views`` are prepended to ``sql`` as common table expressions."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(views, sql)
        return fn

    return add


def with_views(views: str, body: str) -> str:
    names = views.split()
    if not names:
        return body.strip()
    head = "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = body.strip()
    if body.startswith("WITH RECURSIVE"):
        return head.replace("WITH", "WITH RECURSIVE", 1) + ",\n" + body[14:]
    return f"{head},\n{body[4:]}" if body.startswith("WITH ") else f"{head}\n{body}"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r(c: Column | str, n: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, n) + F.lit(0.0)


def r5(c: Column | str, n: int = 6) -> Column:
    """Rounding for exact decimals that may sit on a tie: both sides add the same small offset."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + 0.33 * 10.0**-n / 10, n)


def sql5(expr: str, n: int = 6) -> str:
    return f"ROUND({expr} + 0.33 * 1e-{n} / 10, {n})"


def micros(ts: str) -> Column:
    """Microseconds of a zone-free timestamp, whatever the session's zone."""
    t = F.col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    frac = (F.expr(f"extract(SECOND FROM {ts})") * 1000000).cast("long")
    return ((days * 24 + F.hour(t)) * 60 + F.minute(t)) * 60000000 + frac


VIEWS = {
    "track": """
        SELECT user_id AS line, event_type AS channel, event_id AS seq, epoch_us(ts) / 1e6 AS t, value AS v,
               (user_id * 10 + value / 20) % 360 AS heading, value % 7 - 3 AS roll,
               120.7 + user_id * 0.0005 + value * 1e-5 AS lon, 22.1 + (event_id % 1000) * 1e-5 AS lat
        FROM events""",
    "sample": """
        SELECT l_suppkey AS line, l_linenumber % 2 AS channel, l_orderkey AS ping, 15 + l_quantity AS angle,
               l_extendedprice AS bs, 10 + l_tax * 100 AS altitude, l_partkey AS part, l_linenumber AS num,
               CAST(l_partkey % 64 AS INTEGER) AS "row", CAST(l_suppkey % 50 AS INTEGER) AS col
        FROM lineitem""",
    "raster": """
        SELECT CAST(o_orderkey // 100 AS INTEGER) AS "row", CAST(o_orderkey % 100 AS INTEGER) AS col,
               o_totalprice / 10000 AS z
        FROM orders""",
    # The raster with holes: their cells stay, without a value.
    "holed": """
        SELECT CAST(o_orderkey // 100 AS INTEGER) AS "row", CAST(o_orderkey % 100 AS INTEGER) AS col,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice / 10000 END AS z
        FROM orders""",
    "trace": """
        SELECT label AS line, vec_id AS seq, list_transform(embedding, lambda x: abs(x)) AS amps FROM embeddings""",
    "spot": """
        SELECT c_custkey AS id, (c_custkey * 7919 % 10007) / 10.0 AS x, (c_custkey * 104729 % 10009) / 10.0 AS y,
               c_acctbal AS v FROM customer""",
}


def track(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    uid, v = F.col("user_id"), F.col("value")
    return e.select(
        uid.alias("line"),
        F.col("event_type").alias("channel"),
        F.col("event_id").alias("seq"),
        (micros("ts") / 1e6).alias("t"),
        v.alias("v"),
        ((uid * 10 + v / 20) % 360).alias("heading"),
        (v % 7 - 3).alias("roll"),
        ((F.lit(Decimal("120.7")) + uid * F.lit(Decimal("0.0005"))).cast("double") + v * 1e-5).alias("lon"),  # decimals up to there, as in the SQL
        (F.lit(22.1) + (F.col("event_id") % 1000) * 1e-5).alias("lat"),
    )


THREE_DAYS = 3 * 86400


def along(*line: str) -> Track:
    """Tracks of the events table: by time, in stretches of three days."""
    return Track(line or ("line",), ("t", "seq"), every(THREE_DAYS))


def sample(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("line"),
        (F.col("l_linenumber") % 2).alias("channel"),
        F.col("l_orderkey").alias("ping"),
        (15 + F.col("l_quantity")).alias("angle"),
        F.col("l_extendedprice").alias("bs"),
        (10 + F.col("l_tax") * 100).alias("altitude"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("num"),
        (F.col("l_partkey") % 64).cast("int").alias("row"),
        (F.col("l_suppkey") % 50).cast("int").alias("col"),
    )


SAMPLE_TIE = ["ping", "num", "part", "line", "bs"]
SAMPLE_GRID = Grid(0.0, 64.0, 1.0, 64, 50)


def raster(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        F.floor(k / 100).cast("int").alias("row"),
        (k % 100).cast("int").alias("col"),
        (F.col("o_totalprice") / 10000).alias("z"),
    )


def holed(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("row") * 100 + F.col("col")
    return raster(spark, d).withColumn("z", F.when(k % 97 != 0, F.col("z")))


def raster_grid(spark: SparkSession, d: str, res: float = 1.0) -> Grid:
    """100 columns; as many rows as there are order keys (read from the file's statistics)."""
    top = table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]
    return Grid(0.0, (top // 100 + 1) * res, res, top // 100 + 1, 100)


def trace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("label").alias("line"),
        F.col("vec_id").alias("seq"),
        F.transform("embedding", lambda x: F.abs(x)).alias("amps"),
    )


BLANK = 8  # traces of 64 samples: blanking of 8 instead of 50


def by_seq(*line: str) -> Track:
    """Tracks in sequence order, in stretches of 64 numbers."""
    return Track(line or ("line",), ("seq",), F.floor(F.col("seq") / 64))


def spot(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.alias("id"), (k * 7919 % 10007 / 10.0).alias("x"), (k * 104729 % 10009 / 10.0).alias("y"),
        F.col("c_acctbal").alias("v"),
    )
