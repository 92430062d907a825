"""Replay, history, durable keys and point-in-time lookups on the driver tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import calendar as cal
from millrace.operators import clean, facts, history, lookups, marts
from millrace.operators.skew import salted_join
from millrace.plans.catalog import cents, day, decimal, query, table
from millrace.plans.landing_feed import new_lake
from millrace.sources import tables


def order_number_of(ntz: str):
    """Microseconds since 1970 of a TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ntz))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records of their user: signup inserts, error deletes, the rest updates."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", op.alias("op"),
                                                 cents("value").alias("cents"))


@query("""
SELECT user_id, event_id, event_type, cents FROM (
  SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
         arg_max(CAST(round(value * 100) AS BIGINT), event_id) AS cents FROM events GROUP BY user_id)
WHERE event_type <> 'error'""")
def cdc_replay_current(spark, sf_dir):
    return history.replay(user_changes(spark, sf_dir), ["user_id"], ["event_id"]).select(
        "user_id", "event_id", "event_type", "cents")


@query("""
SELECT user_id, event_id, event_type FROM (
  SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
  FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15' GROUP BY user_id)
WHERE event_type <> 'error'""")
def point_in_time(spark, sf_dir):
    up_to = day("ts") <= F.lit("2024-01-15").cast("date")
    return history.replay(user_changes(spark, sf_dir), ["user_id"], ["event_id"], up_to=up_to).select(
        "user_id", "event_id", "event_type")


@query("""
SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS O, max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS F
FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_totalprice < 300000 GROUP BY 1""")
def primary_account_pivot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    accounts = orders.select("o_orderkey", F.col("o_orderstatus").alias("account_type"),
                             F.when(F.col("o_orderpriority") == "1-URGENT", "closed").otherwise("active").alias("status"))
    holders = orders.select("o_orderkey", "o_custkey", F.when(F.col("o_totalprice") < 300000, "primary").otherwise("joint").alias("role"))
    return history.primary_by_type(holders, accounts, "o_orderkey", "o_custkey", ["O", "F"])


@query("""
WITH RECURSIVE e AS (SELECT c_custkey AS o, c_custkey + 1 AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
fwd AS (SELECT o AS k, n FROM e UNION ALL SELECT fwd.k, e.n FROM fwd JOIN e ON e.o = fwd.n),
bwd AS (SELECT n AS k, o FROM e UNION ALL SELECT bwd.k, e.o FROM bwd JOIN e ON e.n = bwd.o),
k AS (SELECT o AS key FROM e UNION SELECT n FROM e)
SELECT key, coalesce((SELECT max(n) FROM fwd WHERE fwd.k = key), key) AS latest_key,
       coalesce((SELECT min(o) FROM bwd WHERE bwd.k = key), key) AS durable_key FROM k""")
def key_map_closure(spark, sf_dir):
    """Customers of two segments were re-keyed to the next number, which makes chains of any length."""
    edges = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("old_key"), (F.col("c_custkey") + 1).alias("new_key"))
    return history.key_map(edges)


@query("""
WITH RECURSIVE e AS (SELECT c_custkey AS o, c_custkey + 1 AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
bwd AS (SELECT n AS k, o FROM e UNION ALL SELECT bwd.k, e.o FROM bwd JOIN e ON e.n = bwd.o),
d AS (SELECT k, min(o) AS dk FROM bwd GROUP BY k)
SELECT coalesce(dk, o_custkey) AS customer_dk, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders LEFT JOIN d ON k = o_custkey GROUP BY 1""")
def durable_customer(spark, sf_dir):
    """Orders of every id a customer ever had, under the first of them."""
    edges = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("old_key"), (F.col("c_custkey") + 1).alias("new_key"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", cents("o_totalprice").alias("cents"))
    resolved = history.resolve_keys(orders, history.key_map(edges), "o_custkey", "customer_dk")
    return resolved.groupBy("customer_dk").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents"))


CALENDAR_SQL = """
WITH span AS (SELECT date_trunc('month', min(o_orderdate))::TIMESTAMP AS a, last_day(max(o_orderdate))::TIMESTAMP AS b FROM orders),
days AS (SELECT CAST(x AS DATE) AS d FROM span, generate_series(a, b, INTERVAL 1 DAY) t(x)),
k AS (SELECT d, isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26') AS bd,
             CAST(year(d) * 100 + month(d) AS INT) AS month_key FROM days),
cal AS (SELECT *, coalesce(d = min(CASE WHEN bd THEN d END) OVER (PARTITION BY month_key), false) AS fbd,
               coalesce(d = max(CASE WHEN bd THEN d END) OVER (PARTITION BY month_key), false) AS lbd FROM k)
"""


@query(CALENDAR_SQL + """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS date_key, d AS date, CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter,
  CAST(year(d) AS INT) AS year, isodow(d) > 5 AS is_weekend, bd AS is_business_day, month_key, fbd AS is_first_business_day, lbd AS is_last_business_day FROM cal""")
def business_calendar(spark, sf_dir):
    return cal.calendar_of(table(spark, sf_dir, "orders"), day("o_orderdate"))


@query(CALENDAR_SQL + """
SELECT d AS date, strftime(d - INTERVAL 1 MONTH, '%Y-%m') AS report_month FROM cal WHERE fbd""")
def first_business_day(spark, sf_dir):
    days = cal.calendar_of(table(spark, sf_dir, "orders"), day("o_orderdate"))
    return days.filter("is_first_business_day").select("date", dates.report_month("date").alias("report_month"))


@query("""
SELECT o_custkey, m AS payment_month, CAST(max(greatest(late, 0)) AS INT) AS days_late_max FROM (
  SELECT o_custkey, strftime(l_shipdate, '%Y-%m') AS m, date_diff('day', o_orderdate, l_shipdate) AS late
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1, 2""")
def days_late_monthly_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    bills = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey").select(
        "o_custkey", dates.month_text("l_shipdate").alias("payment_month"),
        dates.days_late("l_shipdate", "o_orderdate").alias("late"))
    return marts.monthly_lateness(bills, ["o_custkey", "payment_month"], "late")


@query("""
WITH old AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus AS status, 1 AS version FROM orders),
new AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) + 100 AS cents, 'X' AS status, 2 AS version FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
        UNION ALL SELECT o_orderkey + 1000000000, CAST(round(o_totalprice * 100) AS BIGINT), 'N', 1 FROM orders WHERE o_orderstatus = 'P')
SELECT coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey, coalesce(new.cents, old.cents) AS cents,
       coalesce(new.status, old.status) AS status, CAST(coalesce(new.version, old.version) AS INT) AS version
FROM old FULL JOIN new ON new.o_orderkey = old.o_orderkey""")
def upsert_recompute(spark, sf_dir):
    """Updates and new keys merged into orders, applied twice."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", cents("o_totalprice").alias("cents"), F.col("o_orderstatus").alias("status"), "o_orderpriority",
        F.lit(1).alias("version"))
    current = orders.drop("o_orderpriority")
    changed = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", (F.col("cents") + 100).alias("cents"), F.lit("X").alias("status"), F.lit(2).alias("version"))
    added = orders.filter(F.col("status") == "P").select(
        (F.col("o_orderkey") + 1000000000).alias("o_orderkey"), "cents", F.lit("N").alias("status"), "version")
    changes = changed.unionByName(added)
    once = clean.upsert(current, changes, ["o_orderkey"], ["version"])
    return clean.upsert(once, changes, ["o_orderkey"], ["version"])


SCD2_SQL = """
WITH c AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
v AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to FROM c WHERE before IS NULL OR before <> event_type)
"""


@query(SCD2_SQL + """
SELECT user_id, event_type, ts AS valid_from, valid_to, valid_to IS NULL AS is_current FROM v""")
def scd2_history(spark, sf_dir):
    return user_history(spark, sf_dir).drop("row_hash")


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2(user_changes(spark, sf_dir), ["user_id"], ["event_id"], "ts", ["event_type"])


@query("""
WITH s AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS d, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
n AS (SELECT d, lead(d) OVER (ORDER BY d) AS next_d FROM (SELECT DISTINCT d FROM s)),
r AS (SELECT s.*, n.next_d FROM s JOIN n ON n.d = s.d),
b AS (SELECT *, lag(priority) OVER w AS p_priority, lag(next_d) OVER w AS p_next FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY d)),
g AS (SELECT *, sum(CASE WHEN p_priority IS NULL OR p_priority <> priority OR p_next <> d THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY d) AS v FROM b)
SELECT o_custkey, min(priority) AS priority, min(d) AS valid_from, arg_max(coalesce(next_d, DATE '9999-01-01'), d) AS valid_to, arg_max(next_d IS NULL, d) AS is_current
FROM g GROUP BY o_custkey, v""")
def scd2_snapshot(spark, sf_dir):
    """Yearly snapshots of customers: a missing year is a delete, a new one a return."""
    copies = table(spark, sf_dir, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "year").alias("d")).agg(
        F.max("o_orderpriority").alias("priority"))
    days = history.complete_snapshots(copies, "d")
    return (history.scd2_from_snapshots(copies, days, ["o_custkey"], "d", ["priority"])
            .withColumn("valid_to", F.coalesce("valid_to", F.lit("9999-01-01").cast("date"))).drop("row_hash"))


@query("""
SELECT user_id, event_id, event_type FROM (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1)""")
def scd1_latest(spark, sf_dir):
    return history.latest_only(user_changes(spark, sf_dir), ["user_id"], ["event_id"]).select("user_id", "event_id", "event_type")


@query("""
WITH s AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2)
SELECT o_custkey, arg_max(priority, d) AS priority, max(d) AS d, max(d) = (SELECT max(d) FROM s) AS is_active FROM s GROUP BY 1""")
def scd1_snapshot_activity(spark, sf_dir):
    copies = table(spark, sf_dir, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("d")).agg(
        F.max("o_orderpriority").alias("priority"))
    return history.latest_with_activity(copies, ["o_custkey"], "d")


@query("""
SELECT c_mktsegment IS NULL AS is_unknown, coalesce(c_mktsegment, 'unknown') AS segment, count(*) AS n, count(DISTINCT coalesce(c_custkey, -1)) AS n_members
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = o_custkey GROUP BY ALL""")
def surrogate_unknown(spark, sf_dir):
    """Facts of a segment the dimension lacks land on the -1 member."""
    members = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    keyed = members.withColumn("customer_sk", history.surrogate_key("o_custkey"))
    dim = history.with_unknown_member(keyed, "customer_sk", ["segment"])
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    found = facts.current_key(orders, keyed, "o_custkey", "customer_sk")
    counted = found.groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(dim.select("customer_sk", "segment"), "customer_sk")
            .groupBy((F.col("customer_sk") == history.UNKNOWN_SK).alias("_u"), "segment")
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_members"))
            .select(F.col("_u").alias("is_unknown"), "segment", "n", "n_members"))


@query("""
WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_use FROM orders GROUP BY 1),
m AS (SELECT c_custkey, c_mktsegment, first_use + CAST(c_nationkey - 5 AS INT) AS seen FROM customer JOIN f ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING')
SELECT o_custkey, CASE WHEN c_custkey IS NULL THEN first_use ELSE least(first_use, seen) END AS valid_from, c_custkey IS NULL AS is_inferred, c_mktsegment AS segment
FROM f LEFT JOIN m ON c_custkey = o_custkey""")
def inferred_member(spark, sf_dir):
    """Masters arrive from five days before to weeks after the first order, or never."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", day("o_orderdate").alias("d"))
    first = orders.groupBy("o_custkey").agg(F.min("d").alias("first_use"))
    dim = (table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
           .withColumnRenamed("c_custkey", "o_custkey").join(first, "o_custkey")
           .select("o_custkey", F.date_add("first_use", F.col("c_nationkey") - 5).alias("valid_from"),
                   F.col("c_mktsegment").alias("segment")))
    return history.inferred_members(orders, dim, "o_custkey", "d")


@query("""
WITH s AS (SELECT * FROM events WHERE event_type <> 'purchase'),
c AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM s),
v AS (SELECT user_id, ts, event_type FROM c WHERE before IS NULL OR before <> event_type)
SELECT p.event_id, p.user_id, coalesce(CAST(epoch_us(v.ts) AS BIGINT), -1) AS version_sk
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON v.user_id = p.user_id AND v.ts <= p.ts""")
def pit_lookup(spark, sf_dir):
    """Purchases against the state their user was in, through the as-of path of the lookup."""
    changes = user_changes(spark, sf_dir)
    versions = (history.scd2(changes.filter(F.col("event_type") != "purchase"), ["user_id"], ["event_id"], "ts", ["event_type"])
                .withColumn("sk", order_number_of("valid_from")))
    purchases = changes.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return lookups.version_lookup(purchases, versions, ["user_id"], "ts", "sk", "version_sk", broadcast_rows=0).select(
        "event_id", "user_id", "version_sk")


@query("""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts, CAST(round(value * 100) AS BIGINT) AS rate FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, r.rate FROM p ASOF LEFT JOIN r ON r.user_id = p.user_id AND r.ts <= p.ts""")
def asof_rate(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    purchases = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    rates = events.filter(F.col("event_type") == "view").select("user_id", F.col("ts").alias("rate_ts"), cents("value").alias("rate"))
    return lookups.asof_join(purchases, rates, ["user_id"], "ts", "rate_ts", ["rate"]).select("event_id", "user_id", "rate")


FX_SQL = """
WITH r AS (SELECT event_type AS ccy, CAST(ts AS DATE) AS d, CAST(round(max(value) * 100) AS BIGINT) + 5000 AS rate FROM events
           WHERE event_type <> 'view' AND isodow(ts) < 6 AND strftime(ts, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26') GROUP BY 1, 2),
f AS (SELECT event_id, event_type AS ccy, CAST(ts AS DATE) AS d, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
x AS (SELECT f.*, CASE WHEN f.ccy = 'view' THEN 10000 ELSE r.rate END AS rate FROM f ASOF LEFT JOIN r ON r.ccy = f.ccy AND r.d <= f.d),
e AS (SELECT *, (cents::HUGEINT * 20000 + rate) // (2 * rate) AS base_cents FROM x)
"""


@query(FX_SQL + """
SELECT ccy AS currency, d AS business_date, CAST(max(rate) / 10000 AS DECIMAL(18,4)) AS fx_rate, count(*) AS n, count(base_cents) AS n_converted,
       CAST(sum(base_cents) AS DECIMAL(38,0)) AS base_cents FROM e GROUP BY 1, 2""")
def fx_convert(spark, sf_dir):
    """Event types as currencies, rates published on business days only; views are the base currency."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("currency"),
                                                   day("ts").alias("business_date"), decimal("value").alias("amount"))
    rates = (events.filter((F.col("currency") != "view") & dates.is_business_day("business_date"))
             .groupBy("currency", F.col("business_date").alias("day"))
             .agg((F.max("amount") / 100 + F.lit("0.5").cast("decimal(18,4)")).cast("decimal(18,4)").alias("rate")))
    until = events.agg(F.max("business_date")).first()[0]
    dense = lookups.daily_rates(rates, "currency", "day", "rate", F.lit(until))
    converted = lookups.convert(events, dense, "currency", "business_date", "amount", base="view")
    return converted.groupBy("currency", "business_date").agg(
        F.max("fx_rate").alias("fx_rate"), F.count(F.lit(1)).alias("n"), F.count("amount_base").alias("n_converted"),
        F.sum(F.col("amount_base") * 100).cast("decimal(38,0)").alias("base_cents"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def junk_dim(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    dim = facts.junk_dimension(orders, columns, "profile_sk")
    keyed = orders.withColumn("profile_sk", history.surrogate_key(*columns))
    return (keyed.groupBy("profile_sk").agg(F.count(F.lit(1)).alias("n")).join(dim, "profile_sk").select(*columns, "n"))


@query("""
WITH c AS (SELECT user_id, event_type, event_id, ts, value < 20 AS gone, CASE WHEN value >= 100 THEN 'primary' ELSE 'joint' END AS role FROM events),
b AS (SELECT *, lag(role) OVER w AS p_role, lag(gone) OVER w AS p_gone FROM c WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id)),
v AS (SELECT *, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS valid_to FROM b WHERE p_role IS NULL OR p_role <> role OR p_gone <> gone)
SELECT user_id, event_type, role, ts AS valid_from, valid_to, valid_to IS NULL AS is_current FROM v WHERE NOT gone""")
def bridge_intervals(spark, sf_dir):
    """User and event type as a link: small values close it."""
    changes = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "ts", F.when(F.col("value") < 20, "D").otherwise("I").alias("op"),
        F.when(F.col("value") >= 100, "primary").otherwise("joint").alias("role"))
    return facts.bridge(changes, ["user_id", "event_type"], ["event_id"], "ts", ["role"]).drop("row_hash")


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderstatus, count(*) AS n FROM orders
WHERE strftime(o_orderdate, '%Y-%m') <> '1997-05' GROUP BY 1, 2
UNION ALL
SELECT DATE '1997-05-01', 'replaced', count(*) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-05'""")
def partition_replace(spark, sf_dir):
    """A rerun of one month replaces that partition and no other; doing it twice changes nothing."""
    path = new_lake(spark, "lake").path("silver", "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc("o_orderdate", "MM").alias("m"))
    tables.replace_partitions(orders, path, ["m"])
    again = orders.filter(F.col("m") == F.lit("1997-05-01").cast("date")).withColumn("o_orderstatus", F.lit("replaced"))
    for _ in range(2):
        tables.replace_partitions(again, path, ["m"])
    return tables.read_table(spark, path).groupBy("m", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id, ts, event_type FROM events WHERE event_type <> 'purchase')
SELECT p.user_id, count(*) AS n_purchases, count_if(coalesce(s.event_type = 'error', false)) AS n_blocked
FROM p ASOF LEFT JOIN s ON s.user_id = p.user_id AND s.ts < p.ts GROUP BY 1""")
def blocked_status_pit(spark, sf_dir):
    """Purchases made while the user's latest earlier state is error."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    purchases = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    states = events.filter(F.col("event_type") != "purchase").select("user_id", F.col("ts").alias("at"), F.col("event_type").alias("status"))
    found = lookups.asof_join(purchases, states, ["user_id"], "ts", "at", ["status"], strict=True)
    blocked = F.coalesce(F.col("status") == "error", F.lit(False))
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_purchases"), F.count_if(blocked).alias("n_blocked"))


@query("""
WITH h AS (SELECT user_id, event_id, event_type, CAST(ts AS DATE) AS d, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
k AS (SELECT user_id, CAST(ts AS DATE) AS d, max(event_type) AS result FROM events WHERE value > 50 GROUP BY 1, 2)
SELECT h.user_id, h.event_id, h.p AS previous_status, h.event_type, coalesce((h.event_type = 'signup') = (k.result = 'view'), false) AS backed
FROM h LEFT JOIN k ON k.user_id = h.user_id AND k.d = h.d WHERE h.p IS NOT NULL AND h.p <> h.event_type""")
def change_backed_by_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", day("ts").alias("d"), "value")
    checks = events.filter(F.col("value") > 50).groupBy("user_id", "d").agg(F.max("event_type").alias("result"))
    expected = (F.col("event_type") == "signup") == (F.col("result") == "view")
    return facts.backed_changes(events.drop("value"), ["user_id"], ["event_id"], "event_type", "d", checks,
                                ["user_id", "d"], "result", expected).select(
        "user_id", "event_id", "previous_status", "event_type", "backed")


@query("""
WITH k AS (SELECT c_custkey AS old_key, min(CAST(o_orderdate AS DATE)) + 700 AS changed FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
SELECT o_custkey, count(*) AS n_after FROM orders JOIN k ON old_key = o_custkey WHERE CAST(o_orderdate AS DATE) >= changed GROUP BY 1""")
def old_key_after_change(spark, sf_dir):
    """Orders that still use a customer id after the day it was replaced."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", day("o_orderdate").alias("d"))
    changed = (table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
               .select(F.col("c_custkey").alias("o_custkey"))
               .join(orders.groupBy("o_custkey").agg(F.date_add(F.min("d"), 700).alias("changed")), "o_custkey"))
    return (salted_join(orders, changed, ["o_custkey"], "inner").filter(F.col("d") >= F.col("changed"))
            .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_after")))


@query("""
WITH c AS (SELECT user_id, min(ts) AS closed FROM events WHERE event_type = 'error' AND value > 100 GROUP BY 1)
SELECT e.user_id, e.event_type, count(*) AS n_after FROM events e JOIN c ON c.user_id = e.user_id WHERE e.ts > c.closed GROUP BY 1, 2""")
def activity_after_close(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    closed = events.filter((F.col("event_type") == "error") & (F.col("value") > 100)).groupBy("user_id").agg(F.min("ts").alias("closed"))
    return (salted_join(events.drop("value"), closed, ["user_id"], "inner").filter(F.col("ts") > F.col("closed"))
            .groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_after")))


@query("""
WITH f AS (SELECT o_custkey, min(o_orderkey) AS o FROM orders JOIN (SELECT o_custkey AS k, min(o_orderdate) AS d FROM orders GROUP BY 1) ON k = o_custkey AND o_orderdate = d GROUP BY 1)
SELECT f.o_custkey, f.o AS o_orderkey FROM f JOIN orders ON o_orderkey = f.o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = f.o AND abs(date_diff('day', o_orderdate, l_shipdate)) <= 400)""")
def child_on_same_day(spark, sf_dir):
    """First orders of a customer without a line shipped around the same time."""
    orders = table(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("f")).select(
        "o_custkey", F.col("f.o_orderkey").alias("o_orderkey"), F.col("f.o_orderdate").alias("o_orderdate"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    near = (lines.join(first.select("o_orderkey", "o_orderdate"), "o_orderkey")
            .filter(F.abs(F.datediff("l_shipdate", "o_orderdate")) <= 400).select("o_orderkey").distinct())
    return first.join(near, "o_orderkey", "left_anti").select("o_custkey", "o_orderkey")


@query("""
WITH s AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT CASE WHEN s.user_id IS NULL THEN 'no_lifetime' WHEN e.ts < a THEN 'before' WHEN e.ts > b THEN 'after' ELSE 'inside' END AS finding, event_type, count(*) AS n
FROM events e LEFT JOIN s ON s.user_id = e.user_id GROUP BY ALL""")
def lifetime_range(spark, sf_dir):
    """Events outside the span between their user's first and last signup."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    lifetime = events.filter(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    finding = (F.when(F.col("a").isNull(), "no_lifetime").when(F.col("ts") < F.col("a"), "before")
               .when(F.col("ts") > F.col("b"), "after").otherwise("inside"))
    return salted_join(events, lifetime, ["user_id"], "left").groupBy(finding.alias("finding"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(SCD2_SQL + """
SELECT event_type, count(*) AS versions, CAST(sum(date_diff('microsecond', ts, valid_to) // 3600000000) AS BIGINT) AS time_spent FROM v WHERE valid_to IS NOT NULL GROUP BY 1""")
def status_durations(spark, sf_dir):
    return marts.status_durations(user_history(spark, sf_dir), ["event_type"])


@query("""
SELECT user_id, event_id FROM (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS v,
   max(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events)
WHERE v <= m""")
def sequence_out_of_order(spark, sf_dir):
    """Arrivals whose sequence (the event's value) is not above all earlier ones of the user."""
    from millrace.operators.quality import out_of_order

    rows = table(spark, sf_dir, "events").select("user_id", "event_id", cents("value").alias("seq"))
    return out_of_order(rows, ["user_id"], ["event_id"], "seq").select("user_id", "event_id")


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 7000 THEN 'A' WHEN c_acctbal >= 3000 THEN 'B' ELSE 'C' END AS band,
   CAST(greatest(0, CAST(floor(c_acctbal / 5) AS BIGINT)) AS BIGINT) AS reported FROM customer),
l AS (SELECT o_custkey, max(greatest(date_diff('day', o_orderdate, l_shipdate), 0)) AS late FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
SELECT band, count(*) AS n, CAST(count_if(reported = coalesce(late, 0)) AS BIGINT) AS n_equal, CAST(count_if(coalesce(late, 0) > reported) AS BIGINT) AS n_above
FROM c LEFT JOIN l ON o_custkey = c_custkey GROUP BY 1""")
def derived_equals_reported(spark, sf_dir):
    """Reported lateness per customer against the lateness recomputed from bills."""
    from millrace.functions import money

    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    bills = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey").select(
        "c_custkey", dates.days_late("l_shipdate", "o_orderdate").alias("late"))
    derived = marts.monthly_lateness(bills, ["c_custkey"], "late")
    reports = table(spark, sf_dir, "customer").select(
        "c_custkey", money.band("c_acctbal", [("A", 7000), ("B", 3000)], "C").alias("band"),
        F.greatest(F.lit(0), F.floor(F.col("c_acctbal") / 5)).alias("reported"))
    late = F.coalesce("days_late_max", F.lit(0))
    return reports.join(derived, "c_custkey", "left").groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("reported") == late).alias("n_equal"),
        F.count_if(late > F.col("reported")).alias("n_above"))
