"""Test-data adapters: the transaction views built from the driver's parquet tables.

The reference works on one card-transaction table (``Time, V1..V28, Amount, Class``).
No table of that shape exists here, so three views stand in for it:

* ``txn``        full 31-column shape: embeddings joined to events;
* ``txn_events`` medium: one row per event, with a deterministic stand-in score;
* ``txn_lines``  large: one row per line item, id = md5 of the whole row.

Every operator takes column names, so all three views work with all operators.
Doubles are normalised NaN -> NULL at read time.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import nan_to_null
from riskframe.session import configure

# Fixed values of the adapter (must equal the oracle SQL)
EPOCH_EVENTS = "2024-01-01 00:00:00"
EPOCH_LINES = "1992-01-01 00:00:00"
N_V = 28
TXN_FEATURES = ["Time"] + [f"V{i}" for i in range(1, N_V + 1)] + ["Amount"]
LINE_FEATURES = ["Time", "Quantity", "Amount", "Discount", "Tax"]
EVENT_FEATURES = ["Time", "Amount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table (after applying the plan settings to the session)."""
    configure(spark)
    return widen(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than cores (a one-row-group file is read by
    one task, and every row expression before the first shuffle would run there).
    Planning-only check; on a cluster input splits outnumber cores and this is a no-op."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def _seconds_since(ts_col: str, epoch: str):
    # timestampdiff works on TIMESTAMP_NTZ without a session-time-zone dependence
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{epoch}', {ts_col})") / F.lit(1e6)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings e JOIN events v ON e.vec_id = v.event_id`` in the reference's shape."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    j = emb.join(ev, emb["vec_id"] == ev["event_id"])
    vs = [nan_to_null(F.col("embedding")[i - 1].cast("double")).alias(f"V{i}") for i in range(1, N_V + 1)]
    return j.select(
        F.col("vec_id").alias("txn_id"),
        _seconds_since("ts", EPOCH_EVENTS).alias("Time"),
        *vs,
        nan_to_null("value").alias("Amount"),
        (F.col("label") == 0).cast("int").alias("Class"),
    )


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_events_from(table(spark, sf_dir, "events"))


def txn_events_from(events: DataFrame) -> DataFrame:
    """The ``txn_events`` projection of any events frame (batch or streaming)."""
    ev = events.select("event_id", "ts", "event_type", "value")
    amount = nan_to_null("value")
    return ev.select(
        F.col("event_id").alias("txn_id"),
        _seconds_since("ts", EPOCH_EVENTS).alias("Time"),
        amount.alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("Class"),
        F.round(amount / (amount + F.lit(50.0)), 3).alias("score"),
    )


def _cents(c: str):
    return F.round(F.col(c) * F.lit(100.0)).cast("bigint").cast("string")


def line_id():
    """md5 over all columns of a line item; (orderkey, linenumber) is not unique."""
    return F.md5(F.concat_ws(
        "|",
        F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
        _cents("l_quantity"), _cents("l_extendedprice"), _cents("l_discount"), _cents("l_tax"),
        F.col("l_returnflag"), F.col("l_linestatus"), F.date_format("l_shipdate", "yyyy-MM-dd"),
    ))


def txn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        line_id().alias("txn_id"),
        _seconds_since("l_shipdate", EPOCH_LINES).alias("Time"),
        nan_to_null("l_quantity").alias("Quantity"),
        nan_to_null("l_extendedprice").alias("Amount"),
        nan_to_null("l_discount").alias("Discount"),
        nan_to_null("l_tax").alias("Tax"),
        F.col("l_returnflag").alias("ReturnFlag"),
        F.col("l_linestatus").alias("LineStatus"),
        ((F.col("l_discount") >= 0.1) & (F.col("l_quantity") >= 46)).cast("int").alias("Class"),
    )


VIEWS = {"txn": txn, "txn_events": txn_events, "txn_lines": txn_lines}


# DuckDB spellings of the same views, used as CTEs by the oracle SQL.
def _sql_cents(c: str) -> str:
    return f"CAST(CAST(round({c} * 100.0) AS BIGINT) AS VARCHAR)"


SQL_VIEWS = {
    "txn": (
        "SELECT e.vec_id AS txn_id, "
        f"date_diff('microsecond', TIMESTAMP '{EPOCH_EVENTS}', v.ts) / 1e6 AS \"Time\", "
        + ", ".join(f"CAST(e.embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, N_V + 1))
        + ", v.value AS Amount, CAST(e.label = 0 AS INTEGER) AS Class "
        "FROM embeddings e JOIN events v ON e.vec_id = v.event_id"
    ),
    "txn_events": (
        "SELECT event_id AS txn_id, "
        f"date_diff('microsecond', TIMESTAMP '{EPOCH_EVENTS}', ts) / 1e6 AS \"Time\", "
        "value AS Amount, CAST(event_type = 'error' AS INTEGER) AS Class, "
        "round(value / (value + 50.0), 3) AS score FROM events"
    ),
    "txn_lines": (
        "SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), "
        "CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
        f"{_sql_cents('l_quantity')}, {_sql_cents('l_extendedprice')}, {_sql_cents('l_discount')}, "
        f"{_sql_cents('l_tax')}, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS txn_id, "
        f"date_diff('microsecond', TIMESTAMP '{EPOCH_LINES}', l_shipdate) / 1e6 AS \"Time\", "
        "l_quantity AS Quantity, l_extendedprice AS Amount, l_discount AS Discount, l_tax AS Tax, "
        "l_returnflag AS ReturnFlag, l_linestatus AS LineStatus, "
        "CAST(l_discount >= 0.1 AND l_quantity >= 46 AS INTEGER) AS Class FROM lineitem"
    ),
}


def sql_with(*views: str) -> str:
    """``WITH`` clause defining the named adapter views for DuckDB."""
    return "WITH " + ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in views)
