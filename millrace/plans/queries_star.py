"""Dimensions, facts and marts on the driver tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import clean, facts, history, lookups, marts
from millrace.operators.skew import hot_keys, salted_join
from millrace.plans.catalog import cents, day, decimal, query, table
from millrace.plans.landing_feed import new_lake
from millrace.plans.queries_history import FX_SQL
from millrace.sources import tables


@query("""
SELECT user_id, CAST(ts AS DATE) AS d, min(CASE WHEN event_type = 'click' THEN ts END) AS opened_at, min(CASE WHEN event_type = 'view' THEN ts END) AS first_response_at,
  min(CASE WHEN event_type = 'purchase' THEN ts END) AS resolved_at, arg_max(event_type, event_id) AS event_type,
  CAST(trunc(date_diff('microsecond', min(CASE WHEN event_type = 'click' THEN ts END),
                       min(CASE WHEN event_type = 'purchase' THEN ts END)) / 3600000000) AS BIGINT) AS resolution_hours
FROM events GROUP BY 1, 2""")
def support_case_accumulating(spark, sf_dir):
    """A user's day as a case: opened by a click, answered by a view, resolved by a purchase."""
    events = table(spark, sf_dir, "events").withColumn("d", day("ts"))
    reached = lambda kind: F.when(F.col("event_type") == kind, F.col("ts"))
    cases = facts.accumulating_snapshot(
        events, ["user_id", "d"], ["event_id"],
        {"opened_at": reached("click"), "first_response_at": reached("view"), "resolved_at": reached("purchase")}, ["event_type"])
    return cases.withColumn("resolution_hours", facts.resolution_hours("opened_at", "resolved_at"))


@query("""
WITH d AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS d, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders
   WHERE isodow(o_orderdate) < 6 AND strftime(o_orderdate, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26') GROUP BY 1, 2)
SELECT priority, strftime(d, '%Y-%m') AS month, max(d) AS d, arg_max(n, d) AS n, arg_max(cents, d) AS cents FROM d GROUP BY 1, 2""")
def periodic_snapshot_month_end(spark, sf_dir):
    daily = (table(spark, sf_dir, "orders").filter(dates.is_business_day("o_orderdate"))
             .groupBy(F.col("o_orderpriority").alias("priority"), day("o_orderdate").alias("d"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("cents"))
             .withColumn("month", dates.month_text("d")))
    return marts.month_end_values(daily, ["priority"], "month", "d", ["n", "cents"])


def spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions: N purchases, R refunds booked at shipment, A bill payments."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate", decimal("l_extendedprice").alias("amount"))
    return lines.join(orders, "l_orderkey").withColumn("month", dates.month_text("l_shipdate"))


SPENDING_SQL = """
WITH s AS (SELECT o_custkey, o_orderpriority, o_orderstatus, l_returnflag, l_linestatus, l_shipdate, strftime(l_shipdate, '%Y-%m') AS month, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


@query(SPENDING_SQL + """
SELECT o_custkey, month, o_orderpriority,
  CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS spend,
  CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS refunds,
  count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS txn_count, count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus <> 'F') AS declined_count,
  CAST(sum(CASE WHEN l_linestatus <> 'F' THEN 0 WHEN l_returnflag = 'N' THEN amount WHEN l_returnflag = 'R' THEN -amount ELSE 0 END) AS DECIMAL(38,2)) AS net
FROM s WHERE l_returnflag <> 'A' GROUP BY 1, 2, 3""")
def spend_monthly(spark, sf_dir):
    rows = spending(spark, sf_dir).filter(F.col("l_returnflag") != "A")
    return marts.spend_monthly(rows, ["o_custkey", "month", "o_orderpriority"], "amount", F.col("l_returnflag") == "N",
                               F.col("l_returnflag") == "R", F.col("l_linestatus") == "F")


@query(SPENDING_SQL + """
SELECT month, o_orderpriority, o_orderstatus, CAST(sum(amount) AS DECIMAL(38,2)) AS spend, count(*) AS txn_count,
  CAST(grouping(month) + grouping(o_orderpriority) + grouping(o_orderstatus) AS INT) AS level
FROM s WHERE l_returnflag = 'N' AND l_linestatus = 'F' GROUP BY ROLLUP (month, o_orderpriority, o_orderstatus)""")
def spend_monthly_rollup(spark, sf_dir):
    return marts.spend_rollup(spending(spark, sf_dir), ["month", "o_orderpriority", "o_orderstatus"], "amount",
                              (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))


@query("""
WITH m AS (SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS month_index, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS spend FROM orders GROUP BY 1, 2)
SELECT *, spend - lag(spend) OVER (PARTITION BY o_custkey ORDER BY month_index) AS spend_change,
  max(spend) OVER (PARTITION BY o_custkey ORDER BY month_index RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS spend_recent_max FROM m""")
def feature_rolling(spark, sf_dir):
    monthly = table(spark, sf_dir, "orders").groupBy("o_custkey", marts.month_index("o_orderdate").alias("month_index")).agg(
        F.sum(cents("o_totalprice")).alias("spend"))
    return marts.monthly_change(monthly, ["o_custkey"], "month_index", "spend")


@query("""
WITH s AS (SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS month_index, CAST(max(floor(o_totalprice / 1000)) AS BIGINT) AS score FROM orders GROUP BY 1, 2),
l AS (SELECT o_custkey, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INT) AS month_index, CAST(max(greatest(date_diff('day', o_orderdate, l_shipdate), 0)) AS INT) AS dpd_max
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
f AS (SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS month_index,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS income,
        CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS spend FROM orders GROUP BY 1, 2),
j AS (SELECT s.*, coalesce(dpd_max, 0) AS dpd_max, income, spend FROM s LEFT JOIN l USING (o_custkey, month_index) LEFT JOIN f USING (o_custkey, month_index))
SELECT *, score - lag(score) OVER (PARTITION BY o_custkey ORDER BY month_index) AS score_change,
  max(dpd_max) OVER (PARTITION BY o_custkey ORDER BY month_index RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS dpd_recent_max,
  CASE WHEN income > 0 THEN spend * 100 // income END AS spend_to_income_pct FROM j""")
def credit_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    index = marts.month_index("o_orderdate").alias("month_index")
    scores = orders.groupBy("o_custkey", index).agg(F.max(F.floor(F.col("o_totalprice") / 1000)).alias("score"))
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    bills = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(owner, "l_orderkey").select(
        "o_custkey", marts.month_index("l_shipdate").alias("month_index"), dates.days_late("l_shipdate", "o_orderdate").alias("late"))
    lateness = marts.monthly_lateness(bills, ["o_custkey", "month_index"], "late").withColumnRenamed("days_late_max", "dpd_max")
    income = F.col("o_orderstatus") == "F"
    flows = orders.groupBy("o_custkey", index).agg(
        F.sum(F.when(income, cents("o_totalprice"))).alias("income"), F.sum(F.when(~income, cents("o_totalprice"))).alias("spend"))
    return marts.credit_features(scores, lateness, flows, ["o_custkey"])


@query("""
WITH b AS (SELECT o_custkey, o_orderpriority, date_diff('day', o_orderdate, l_shipdate) AS late FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT o_custkey, o_orderpriority, count(*) AS n_bills, count(*) FILTER (WHERE late <= 0) AS n_on_time, CAST(sum(greatest(late, 0)) AS BIGINT) AS days_late_sum,
  CAST(max(greatest(late, 0)) AS INT) AS max_days_late, CAST(count(*) FILTER (WHERE late <= 0) * 1000 // count(*) AS BIGINT) AS on_time_per_mille,
  CAST(CAST(sum(greatest(late, 0)) AS DOUBLE) / count(*) AS DECIMAL(10,4)) AS avg_days_late
FROM b GROUP BY 1, 2""")
def bill_behaviour(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority", "o_orderdate")
    bills = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey").select(
        "o_custkey", "o_orderpriority", dates.days_late("l_shipdate", "o_orderdate").alias("late"))
    return marts.bill_behaviour(bills, ["o_custkey", "o_orderpriority"], "late")


@query("""
WITH p AS (SELECT o_custkey, p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT o_custkey, p_type, value, CAST(CAST(value * 100 AS HUGEINT) * 1000 // CAST(sum(value * 100) OVER (PARTITION BY o_custkey) AS HUGEINT) AS BIGINT) AS share_per_mille FROM p""")
def invest_allocation(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    held = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", decimal("l_extendedprice").alias("v"))
            .join(part, "l_partkey").join(orders, "l_orderkey"))
    return marts.allocation(held, ["o_custkey"], "p_type", "v")


@query("""
WITH c AS (SELECT user_id, CAST(ts AS DATE) AS d, min(CASE WHEN event_type = 'click' THEN ts END) AS o, min(CASE WHEN event_type = 'purchase' THEN ts END) AS r FROM events GROUP BY 1, 2),
h AS (SELECT d, CAST(trunc(date_diff('microsecond', o, r) / 3600000000) AS BIGINT) AS h FROM c WHERE o IS NOT NULL AND (r IS NULL OR r >= o))
SELECT d, count(*) AS cases, count(h) AS resolved_cases, CAST(sum(h) AS BIGINT) AS resolution_hours, max(h) AS longest_hours FROM h GROUP BY 1""")
def support_usage(spark, sf_dir):
    cases = support_case_accumulating(spark, sf_dir).filter(
        F.col("opened_at").isNotNull() & (F.col("resolved_at").isNull() | (F.col("resolved_at") >= F.col("opened_at"))))
    return marts.support_usage(cases, ["d"], "resolution_hours")


@query(FX_SQL + """,
h AS (SELECT user_id, event_id, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before, event_type FROM events WHERE event_type IN ('signup', 'click')),
v AS (SELECT user_id, ts AS valid_from, event_type AS segment FROM h WHERE before IS NULL OR before <> event_type),
t AS (SELECT event_id, user_id, ts, event_type FROM events)
SELECT t.event_id, CAST(year(l) * 10000 + month(l) * 100 + day(l) AS INT) AS date_key, v.valid_from IS NULL AS is_unknown, coalesce(v.segment, 'unknown') AS segment,
  t.event_type AS currency, CAST(e.rate / 10000 AS DECIMAL(18,4)) AS fx_rate, CAST(e.base_cents AS DECIMAL(38,0)) AS base_cents
FROM (SELECT *, CAST(timezone('Europe/Vilnius', timezone('UTC', ts)) AS DATE) AS l FROM t) t JOIN e ON e.event_id = t.event_id
ASOF LEFT JOIN v ON v.user_id = t.user_id AND v.valid_from <= t.ts""")
def fact_transaction(spark, sf_dir):
    """Events as transactions: converted, dated locally, and keyed to the user's version as of the event."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.col("event_type").alias("currency"), day("ts").alias("business_date"), decimal("value").alias("amount"))
    rates = (events.filter((F.col("currency") != "view") & dates.is_business_day("business_date"))
             .groupBy("currency", F.col("business_date").alias("day"))
             .agg((F.max("amount") / 100 + F.lit("0.5").cast("decimal(18,4)")).cast("decimal(18,4)").alias("rate")))
    until = events.agg(F.max("business_date")).first()[0]
    converted = lookups.convert(events, lookups.daily_rates(rates, "currency", "day", "rate", F.lit(until)),
                                "currency", "business_date", "amount", base="view")
    changes = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "click"))
    versions = history.scd2(changes, ["user_id"], ["event_id"], "ts", ["event_type"]).withColumnRenamed("event_type", "segment")
    dim = facts.versioned_dimension(versions, "user_id", "user_sk")
    dim = tables_roundtrip(spark, history.with_unknown_member(dim, "user_sk", ["segment"]))
    keyed = facts.dimension_keys(converted, [(dim, "user_id", "user_sk")], "ts")
    # The stored dimension's size decides between broadcast and AQE's skew-aware sort-merge join.
    named = keyed.join(dim.select("user_sk", "segment"), "user_sk", "left")
    return named.select("event_id", dates.date_key(dates.local_date("ts", ntz_utc=True)).alias("date_key"),
                        (F.col("user_sk") == history.UNKNOWN_SK).alias("is_unknown"), "segment", "currency", "fx_rate",
                        (F.col("amount_base") * 100).cast("decimal(38,0)").alias("base_cents"))


def tables_roundtrip(spark: SparkSession, dim: DataFrame) -> DataFrame:
    """A dimension is a table: built once, then read by everything that looks keys up in it."""
    path = new_lake(spark, "gold").path("gold", "dim")
    tables.overwrite(dim, path)
    return spark.read.parquet(path)


@query("""
WITH d AS (SELECT o_orderkey, min(CAST(l_shipdate AS DATE)) AS paid, max(CAST(l_shipdate AS DATE)) AS due, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
SELECT o_orderkey, CAST(strftime(paid, '%Y%m%d') AS INT) AS date_key, CAST(strftime(due, '%Y%m%d') AS INT) AS due_date_key, CAST(date_diff('day', due, paid) AS INT) AS days_late,
  n AS n_lines FROM d""")
def fact_bill_payment(spark, sf_dir):
    """An order as a bill: paid with its first shipment, due with its last."""
    bills = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(day("l_shipdate")).alias("paid"), F.max(day("l_shipdate")).alias("due"), F.count(F.lit(1)).alias("n_lines"))
    known = bills.join(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "left_semi")
    return facts.bill_payments(known, "paid", "due").drop("paid", "due")


@query("""
WITH h AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events WHERE event_type IN ('signup', 'error')),
v AS (SELECT user_id, ts, event_type FROM h WHERE before IS NULL OR before <> event_type),
c AS (SELECT * FROM events WHERE event_type = 'view')
SELECT c.event_id AS check_id, CAST(strftime(timezone('Europe/Vilnius', timezone('UTC', c.ts)), '%Y%m%d') AS INT) AS date_key,
  CASE WHEN c.value > 100 THEN 'fail' ELSE 'pass' END AS result, coalesce(v.event_type, 'unknown') AS status
FROM c ASOF LEFT JOIN v ON v.user_id = c.user_id AND v.ts <= c.ts""")
def fact_check(spark, sf_dir):
    """Views as checks of their user, keyed to the version at the time."""
    events = table(spark, sf_dir, "events")
    versions = history.scd2(events.filter(F.col("event_type").isin("signup", "error")), ["user_id"], ["event_id"], "ts", ["event_type"])
    dim = facts.versioned_dimension(versions.withColumnRenamed("event_type", "status"), "user_id", "user_sk")
    dim = tables_roundtrip(spark, history.with_unknown_member(dim, "user_sk", ["status"]))
    checks = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("check_id"), "user_id", "ts", F.when(F.col("value") > 100, "fail").otherwise("pass").alias("result"))
    keyed = facts.dimension_keys(checks, [(dim, "user_id", "user_sk")], "ts", broadcast_rows=100)
    return keyed.join(dim.select("user_sk", "status"), "user_sk", "left").select(
        "check_id", dates.date_key(dates.local_date("ts", ntz_utc=True)).alias("date_key"), "result", "status")


@query("""
WITH s AS (SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS report_month_key, CAST(floor(max(o_totalprice) / 600) AS BIGINT) AS score,
                  count(*) AS open_credit_lines FROM orders GROUP BY 1, 2)
SELECT s.*, CASE WHEN score >= 800 THEN 'A' WHEN score >= 650 THEN 'B' WHEN score >= 500 THEN 'C' WHEN score >= 350 THEN 'D' ELSE 'E' END AS risk_band,
  coalesce(c_mktsegment, 'unknown') AS segment FROM s LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') ON c_custkey = o_custkey""")
def fact_score(spark, sf_dir):
    """Month x customer scores with the band of their value."""
    from millrace.functions import money

    scores = table(spark, sf_dir, "orders").groupBy("o_custkey", dates.month_key("o_orderdate").alias("report_month_key")).agg(
        F.floor(F.max("o_totalprice") / 600).alias("score"), F.count(F.lit(1)).alias("open_credit_lines"))
    members = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "MACHINERY").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    keyed = members.withColumn("customer_sk", history.surrogate_key("o_custkey"))
    dim = history.with_unknown_member(keyed, "customer_sk", ["segment"]).select("customer_sk", "segment")
    found = facts.current_key(scores, keyed, "o_custkey", "customer_sk")
    return found.join(dim, "customer_sk").select("o_custkey", "report_month_key", "score", "open_credit_lines",
                                                 money.band("score").alias("risk_band"), "segment")


@query("""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey, l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS units FROM lineitem
  WHERE isodow(l_shipdate) < 6 AND strftime(l_shipdate, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26') GROUP BY 1, 2, 3)
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, l_suppkey, l_partkey, units, CAST(round(units * CAST(p_retailprice AS DECIMAL(18,2)), 2) AS DECIMAL(38,2)) AS market_value
FROM d JOIN part ON p_partkey = l_partkey""")
def fact_holding_snapshot(spark, sf_dir):
    """Supplier x part x business day positions valued at the part's price."""
    held = (table(spark, sf_dir, "lineitem").filter(dates.is_business_day("l_shipdate"))
            .groupBy(day("l_shipdate").alias("d"), "l_suppkey", "l_partkey")
            .agg(F.sum(decimal("l_quantity", 4)).cast("decimal(38,4)").alias("units")))
    prices = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), decimal("p_retailprice").alias("price"))
    value = F.round(F.col("units").cast("decimal(19,4)") * F.col("price"), 2).cast("decimal(38,2)")
    hot = hot_keys(table(spark, sf_dir, "lineitem"), ["l_partkey"])
    return salted_join(held, prices, ["l_partkey"], "inner", hot=hot).select(
        dates.date_key("d").alias("date_key"), "l_suppkey", "l_partkey", "units", value.alias("market_value"))


@query("""
WITH c AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, max(l_returnflag) AS flag, max(l_linestatus) AS status FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, lag(flag) OVER w AS pf, lag(status) OVER w AS ps FROM c WINDOW w AS (PARTITION BY l_suppkey ORDER BY d)),
v AS (SELECT *, lead(d) OVER (PARTITION BY l_suppkey ORDER BY d) AS valid_to FROM b WHERE pf IS NULL OR pf <> flag OR ps <> status)
SELECT l_suppkey, flag, status, d AS valid_from, valid_to, valid_to IS NULL AS is_current FROM v""")
def dims_scd2(spark, sf_dir):
    """Supplier versions over two attributes from daily summaries of their lines."""
    daily = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", day("l_shipdate").alias("d")).agg(
        F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("status"))
    versions = history.scd2(daily, ["l_suppkey"], ["d"], "d", ["flag", "status"])
    return facts.versioned_dimension(versions, "l_suppkey", "supplier_sk").drop("row_hash", "supplier_sk")


@query("""
WITH k AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1)
SELECT d, n, cents FROM k""")
def late_rebuild(spark, sf_dir):
    """A daily aggregate table first built without the urgent orders, then brought up to date by rebuilding
    only the dates the late orders fall on; the result equals a full build."""
    path = new_lake(spark, "lake").path("gold", "orders_daily")
    orders = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("d"), "o_orderpriority", cents("o_totalprice").alias("cents"))
    daily = lambda df: df.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    month = lambda df: df.withColumn("m", F.trunc("d", "MM"))
    late = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    tables.replace_partitions(month(daily(orders.filter(F.col("o_orderpriority") != "1-URGENT"))), path, ["m"])
    touched = clean.affected_partitions(month(late), "m")
    rebuilt = daily(month(orders).join(touched, "m", "left_semi"))
    tables.replace_partitions(month(rebuilt), path, ["m"])
    return tables.read_table(spark, path).select("d", "n", "cents")


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1""")
def backfill_range(spark, sf_dir):
    """A year that was stored without its amounts is processed again on top of the existing table: staged, then swapped.
    An upsert that kept an old row would leave an amount out."""
    path = new_lake(spark, "lake").path("silver", "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "MM").alias("m"), cents("o_totalprice").alias("cents"))
    year = F.year("m") == 1998
    tables.replace_partitions(orders.withColumn("cents", F.when(year, 0).otherwise(F.col("cents"))), path, ["m"])
    current = tables.read_table(spark, path).filter(year)
    merged = clean.upsert(current.withColumn("version", F.lit(1)), orders.filter(year).withColumn("version", F.lit(2)),
                          ["o_orderkey"], ["version"]).drop("version")
    tables.stage_then_replace(merged, path, ["m"])
    return tables.read_table(spark, path).groupBy("m").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"), F.sum("cents").alias("cents"))
