"""Extensions that Spark brings along: grouping sets, approximate sketches, ranking frames, event-time windows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..streaming import windows
from .registry import query


@query("SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def rollup_counts(t):
    geo = t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return t("customer").join(geo, "c_nationkey").rollup("r_name", "n_name").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_sums(t):
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
""")
def pricing_summary(t):
    x = t("lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'")
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly_windows(t):
    return windows.tumbling(t("events"), "ts", "1 hour", ["event_type"]).withColumn("total", F.round("total", 4)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new, event_id FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k
""")
def user_sessions(t):
    return windows.sessions(t("events"), "ts", "6 hours", "user_id").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("""
SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, CAST(ntile(4) OVER w AS INTEGER) AS quarter, round(percent_rank() OVER w, 6) AS place FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
""")
def ranking_frames(t):
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    return t("orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"), F.ntile(4).over(w).alias("quarter"), F.round(F.percent_rank().over(w), 6).alias("place"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS faults, min(ts) FILTER (WHERE event_type = 'error') AS first_at FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'error') > 15")
def fault_thresholds(t):
    return windows.first_fault(t("events"), "user_id", "ts", "event_type = 'error'", 15)


@query()
def approximate_distinct(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.01).alias("parts"), F.percentile_approx("l_quantity", 0.5).alias("median"))
