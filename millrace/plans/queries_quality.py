"""Typing, rules, quarantine, keys, references and drift on the driver tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, money
from millrace.operators import calendar as cal
from millrace.operators import clean, facts, marts, quality, reconcile
from millrace.operators.skew import salted_join
from millrace.plans.catalog import cents, day, decimal, query, table

VILNIUS = dates.BUSINESS_ZONE
MONEY_SQL = r"'^-?\d+(\.\d{1,2})?$'"


@query("""
SELECT CAST(timezone('Europe/Vilnius', timezone('UTC', ts)) AS DATE) AS local_day, count(*) AS n,
       CAST(count_if(CAST(timezone('Europe/Vilnius', timezone('UTC', ts)) AS DATE) <> CAST(ts AS DATE)) AS BIGINT) AS n_other_day
FROM events GROUP BY 1""")
def local_business_date(spark, sf_dir):
    local = dates.local_date("ts", ntz_utc=True)
    return (table(spark, sf_dir, "events").select(local.alias("local_day"), day("ts").alias("utc_day"))
            .groupBy("local_day").agg(F.count(F.lit(1)).alias("n"),
                                      F.count_if(F.col("local_day") != F.col("utc_day")).alias("n_other_day")))


@query("""
SELECT l_orderkey, CAST(sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2))
       AS DECIMAL(38,2)) AS discount_total FROM lineitem GROUP BY 1""")
def money_half_up(spark, sf_dir):
    rounded = money.half_up(decimal("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(rounded).cast("decimal(38,2)").alias("discount_total"))


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the texts a careless source would send."""
    events = table(spark, sf_dir, "events")
    plain = decimal("value").cast("string")
    amount = (F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.regexp_replace(plain, r"\.", ","))
              .when((F.col("event_type") == "signup") & (F.col("value") > 80), "n/a")
              .when((F.col("event_type") == "view") & (F.col("value") > 90), F.concat(plain, F.lit("5")))
              .otherwise(plain))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamp = F.when((F.col("event_type") == "click") & (F.col("value") > 70),
                   F.date_format("ts", "dd/MM/yyyy HH:mm")).otherwise(iso)
    key = F.when((F.col("event_type") != "purchase") | (F.col("value") < 120), F.col("event_id").cast("string"))
    return events.select(key.alias("event_id"), amount.alias("amount"), stamp.alias("event_ts"), "event_type",
                         day("ts").alias("_batch_date"))


EVENT_TEXTS_SQL = """
WITH t AS (
  SELECT CASE WHEN event_type <> 'purchase' OR value < 120 THEN event_id END AS event_id, CAST(ts AS DATE) AS d,
    CASE WHEN event_type = 'error' AND value > 50 THEN replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         WHEN event_type = 'signup' AND value > 80 THEN 'n/a'
         WHEN event_type = 'view' AND value > 90 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '5'
         ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN event_type = 'click' AND value > 70 THEN strftime(ts, '%d/%m/%Y %H:%M')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_ts
  FROM events),
j AS (
  SELECT *, CASE WHEN event_id IS NULL THEN 'missing_event_id'
                 WHEN NOT regexp_full_match(amount, '-?[0-9]+([.][0-9]{1,2})?') THEN 'invalid_amount'
                 WHEN try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') IS NULL THEN 'invalid_event_ts' END AS reason
  FROM t)
"""


def _judged(spark, sf_dir):
    typed = clean.typed_projection(event_texts(spark, sf_dir), {
        "event_id": "bigint", "amount": "decimal(18,2)", "event_ts": "timestamp"}, keep=["_batch_date"])
    rules = [quality.Rule("invalid_event_ts", "types", F.col("event_ts").isNull() & F.col("event_ts_text").isNotNull()),
             quality.Rule("invalid_amount", "types", F.col("amount").isNull() & F.col("amount_text").isNotNull()),
             quality.Rule("missing_event_id", "keys", F.col("event_id").isNull())]
    return typed, [rules[2], rules[1], rules[0]]


@query(EVENT_TEXTS_SQL + """
SELECT d AS batch_date, coalesce(reason, 'accepted') AS outcome, count(*) AS n,
       CAST(sum(CASE WHEN reason IS NULL THEN CAST(amount AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS total
FROM j GROUP BY 1, 2""")
def try_cast_quarantine(spark, sf_dir):
    typed, rules = _judged(spark, sf_dir)
    good, bad = quality.split_quarantine(typed, rules)
    both = good.withColumn("reason", F.lit("accepted")).unionByName(bad)
    total = F.sum(F.when(F.col("reason") == "accepted", F.col("amount"))).cast("decimal(38,2)")
    return both.groupBy(F.col("_batch_date").alias("batch_date"), F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), total.alias("total"))


@query(EVENT_TEXTS_SQL + """,
r AS (SELECT d, count(*) AS n, count_if(event_id IS NULL) AS k,
             count_if(NOT regexp_full_match(amount, '-?[0-9]+([.][0-9]{1,2})?')) AS a,
             count_if(try_strptime(event_ts, '%Y-%m-%dT%H:%M:%SZ') IS NULL) AS t FROM j GROUP BY d)
SELECT d AS batch_date, 'missing_event_id' AS rule, n AS rows_checked, CAST(k AS BIGINT) AS rows_failed FROM r
UNION ALL SELECT d, 'invalid_amount', n, CAST(a AS BIGINT) FROM r
UNION ALL SELECT d, 'invalid_event_ts', n, CAST(t AS BIGINT) FROM r""")
def rule_coverage(spark, sf_dir):
    typed, rules = _judged(spark, sf_dir)
    return quality.rule_results(typed, rules, ["_batch_date"]).withColumnRenamed("_batch_date", "batch_date")


@query("""
WITH i AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS bban, c_mktsegment FROM customer),
c AS (SELECT *, 98 - (CAST(bban || '212900' AS HUGEINT) % 97) AS good FROM i),
s AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN substr('LT' || lpad(CAST(good AS VARCHAR), 2, '0') || bban, 1, 19)
       ELSE 'LT' || lpad(CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN good + 1 ELSE good END AS VARCHAR), 2, '0') || bban END AS iban FROM c)
SELECT c_custkey, iban, length(iban) = 20 AND CAST(substr(iban, 5) || '2129' || substr(iban, 3, 2) AS HUGEINT) % 97 = 1 AS valid
FROM s""")
def iban_check(spark, sf_dir):
    bban = F.lpad(F.col("c_custkey").cast("string"), 16, "0")
    good = (F.lit(98) - F.concat(bban, F.lit("212900")).cast("decimal(38,0)") % 97).cast("int")
    digits = F.lpad(F.when(F.col("c_mktsegment") == "MACHINERY", good + 1).otherwise(good).cast("string"), 2, "0")
    iban = F.concat(F.lit("LT"), digits, bban)
    iban = F.when(F.col("c_mktsegment") == "BUILDING", F.substring(iban, 1, 19)).otherwise(iban)
    return (table(spark, sf_dir, "customer").select("c_custkey", iban.alias("iban"))
            .withColumn("valid", money.iban_valid("iban")))


@query("""
SELECT CAST(floor((c_acctbal + 1000) / 12) AS INT) AS score, c_mktsegment, count(*) AS n,
  CASE WHEN floor((c_acctbal + 1000) / 12) >= 800 THEN 'A' WHEN floor((c_acctbal + 1000) / 12) >= 650 THEN 'B'
       WHEN floor((c_acctbal + 1000) / 12) >= 500 THEN 'C' WHEN floor((c_acctbal + 1000) / 12) >= 350 THEN 'D' ELSE 'E' END AS risk_band
FROM customer GROUP BY ALL""")
def score_band(spark, sf_dir):
    score = F.floor((F.col("c_acctbal") + 1000) / 12).cast("int")
    return (table(spark, sf_dir, "customer").select(score.alias("score"), "c_mktsegment")
            .withColumn("risk_band", money.band("score"))
            .groupBy("score", "c_mktsegment", "risk_band").agg(F.count(F.lit(1)).alias("n")))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as holdings: product risk from the part's size, rating from the customer's segment."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.ceil(F.col("p_size") / 8).cast("int").alias("product_risk"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rating = money.lookup("c_mktsegment", {"AUTOMOBILE": "low", "BUILDING": "medium", "FURNITURE": "high"})
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), rating.alias("rating"))
    return lines.join(part, "l_partkey").join(orders, "l_orderkey").join(customers, "o_custkey")


POSITIONS_SQL = """
WITH p AS (SELECT o_custkey, CAST(ceil(p_size / 8.0) AS INT) AS product_risk,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'low' WHEN 'BUILDING' THEN 'medium' WHEN 'FURNITURE' THEN 'high' END AS rating
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
s AS (SELECT *, product_risk <= CASE rating WHEN 'low' THEN 3 WHEN 'medium' THEN 5 WHEN 'high' THEN 7 END AS ok FROM p)
"""


@query(POSITIONS_SQL + """
SELECT rating, product_risk, ok AS suitable, count(*) AS n FROM s GROUP BY ALL""")
def suitability(spark, sf_dir):
    return (positions(spark, sf_dir).withColumn("suitable", money.suitable("product_risk", "rating"))
            .groupBy("rating", "product_risk", "suitable").agg(F.count(F.lit(1)).alias("n")))


@query(POSITIONS_SQL + """
SELECT o_custkey, count(*) AS n_positions, count(*) FILTER (WHERE NOT ok) AS n_warnings FROM s GROUP BY 1""")
def risk_warning(spark, sf_dir):
    """Reported, never quarantined: a later re-rating may break a position legitimately."""
    return (positions(spark, sf_dir).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.count_if(~money.suitable("product_risk", "rating")).alias("n_warnings")))


@query("""
SELECT verdict, m AS refund_month, count(*) AS n FROM (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
    CASE WHEN o_orderkey IS NULL THEN 'pending'
         WHEN date_diff('day', o_orderdate, l_shipdate) NOT BETWEEN 1 AND 10 THEN 'look_back'
         WHEN l_linestatus <> o_orderstatus THEN 'different_status'
         WHEN CAST(round(l_extendedprice * 100) AS BIGINT) > CAST(round(o_totalprice * 100) AS BIGINT) THEN 'amount' ELSE 'ok' END AS verdict
  FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT') ON o_orderkey = l_orderkey
  WHERE l_returnflag = 'R')
GROUP BY ALL""")
def refund_lookback(spark, sf_dir):
    """Returned lines as refunds of their order; urgent orders have not arrived yet."""
    refunds = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("original_id"), day("l_shipdate").alias("refund_day"),
        F.col("l_linestatus").alias("status"), cents("l_extendedprice").alias("amount"))
    originals = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") != "1-URGENT").select(
        "o_orderkey", day("o_orderdate").alias("order_day"), F.col("o_orderstatus").alias("status"),
        cents("o_totalprice").alias("amount"))
    linked = facts.linked_refunds(refunds, originals, "original_id", "o_orderkey", "refund_day", "order_day",
                                  ["status"], "amount")
    return linked.groupBy("verdict", F.trunc("refund_day", "MM").alias("refund_month")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS clicks FROM events e
WHERE event_type = 'click' AND EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error'
      AND CAST(x.ts AS DATE) = CAST(e.ts AS DATE))
GROUP BY 1, 2""")
def semi_declined(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", day("ts").alias("d"), "event_type")
    failed = marts.days_with(events, ["user_id", "d"], F.col("event_type") == "error")
    clicks = (events.filter(F.col("event_type") == "click").groupBy("user_id", "d")
              .agg(F.count(F.lit(1)).alias("clicks")))
    return clicks.join(failed, ["user_id", "d"], "left_semi")


@query("""
SELECT year(o_orderdate)::INT AS y, count(o_custkey) AS n_known, CAST(sum(o_custkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""")
def rename_coalesce(spark, sf_dir):
    """The column is called merchant_ref from 1998 on."""
    late = F.year("o_orderdate") >= 1998
    rows = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("y"), F.when(~late, F.col("o_custkey")).alias("merchant_id"),
        F.when(late, F.col("o_custkey")).alias("merchant_ref"))
    merged = clean.merge_renamed(rows, {"merchant_id": ["merchant_ref"]})
    return merged.groupBy("y").agg(F.count("merchant_id").alias("n_known"), F.sum("merchant_id").alias("key_sum"))


@query("""
SELECT CAST(o_orderdate AS DATE) AS due_date, CASE WHEN o_orderstatus = 'O' THEN 'utc_instant' ELSE 'date' END AS form, count(*) AS n
FROM orders GROUP BY ALL""")
def due_date_dual(spark, sf_dir):
    """Open orders carry the UTC instant of local midnight instead of the date."""
    midnight = F.convert_timezone(F.lit(VILNIUS), F.lit("UTC"), F.col("o_orderdate"))
    text = F.when(F.col("o_orderstatus") == "O", F.date_format(midnight, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return (table(spark, sf_dir, "orders").select(text.alias("text"))
            .groupBy(dates.parse_date_or_instant("text").alias("due_date"), dates.date_format_kind("text").alias("form"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("""
SELECT kind, fmt, count(*) AS n, min(d) AS first_day, max(d) AS last_day FROM (
  SELECT CAST(o_orderdate AS DATE) AS d,
    CASE o_orderstatus WHEN 'O' THEN 'utc_instant' WHEN 'P' THEN 'date' ELSE 'invalid' END AS kind,
    CASE o_orderstatus WHEN 'O' THEN true ELSE false END AS fmt FROM orders) GROUP BY 1, 2""")
def format_rules(spark, sf_dir):
    text = (F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")))
    rows = table(spark, sf_dir, "orders").select(text.alias("text"), day("o_orderdate").alias("d"))
    return (rows.groupBy(dates.date_format_kind("text").alias("kind"),
                         dates.parse_timestamp("text").isNotNull().alias("fmt"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day")))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, price FROM (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, round(l_extendedprice * 100) DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def dedup_winner(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day("l_shipdate").alias("d"),
        cents("l_extendedprice").alias("price"))
    return clean.winners(lines, ["l_orderkey", "l_linenumber"],
                         [F.desc(c) for c in ("d", "price", "l_partkey", "l_suppkey")])


@query("""
SELECT rule, rows_found FROM (
  SELECT 'lineitem_key' AS rule, count(*) AS rows_found FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'order_key', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'order_without_line', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'line_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'customer_without_order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def fk_pk_check(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    found = {
        "lineitem_key": quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]),
        "order_key": quality.duplicate_keys(orders, ["o_orderkey"]),
        "order_without_line": quality.missing_parents(orders.select("o_orderkey"), lines, {"o_orderkey": "l_orderkey"}),
        "line_without_order": quality.missing_parents(lines.select("l_orderkey"), orders, {"l_orderkey": "o_orderkey"}),
        "customer_without_order": quality.missing_parents(customers.select("c_custkey"), orders, {"c_custkey": "o_custkey"}),
    }
    result = None
    for rule, rows in found.items():
        one = rows.agg(F.count(F.lit(1)).alias("rows_found")).select(F.lit(rule).alias("rule"), "rows_found")
        result = one if result is None else result.unionByName(one)
    return result


@query("""
WITH f AS (SELECT c_custkey, min(CAST(o_orderdate AS DATE)) + CAST(c_nationkey AS INT) AS first_seen
           FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' GROUP BY c_custkey, c_nationkey)
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n, CAST(count_if(c_custkey IS NULL) AS BIGINT) AS n_now,
       CAST(count_if(c_custkey IS NULL OR first_seen > CAST(o_orderdate AS DATE)) AS BIGINT) AS n_as_of
FROM orders LEFT JOIN f ON c_custkey = o_custkey GROUP BY 1""")
def referential_asof(spark, sf_dir):
    """Customers become known some days after their first order; one segment never does."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), day("o_orderdate").alias("d"))
    first = orders.groupBy("c_custkey").agg(F.min("d").alias("first_order"))
    master = (table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
              .join(first, "c_custkey").select("c_custkey", F.date_add("first_order", F.col("c_nationkey")).alias("first_seen")))
    return (quality.orphans_as_of(orders, master, "c_custkey", "d", "first_seen")
            .groupBy(F.trunc("d", "MM").alias("m")).agg(
                F.count(F.lit(1)).alias("n"), F.count_if("orphan_now").alias("n_now"),
                F.count_if("orphan_as_of").alias("n_as_of")))


@query("""
WITH r AS (SELECT o_orderkey, o_orderpriority AS p, o_orderdate AS od,
    CASE o_orderstatus WHEN 'O' THEN 'purchase' WHEN 'F' THEN 'refund' ELSE 'bill_payment' END AS kind,
    CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'F' THEN 'R' ELSE 'B' END AS good FROM orders)
SELECT kind, CAST(count_if(p IN ('5-LOW', '1-URGENT')) AS BIGINT) AS n_failed, count(*) AS n FROM r GROUP BY 1""")
def id_prefix_rule(spark, sf_dir):
    """Low-priority ids carry a wrong letter, urgent ids the next day's date."""
    kind = money.lookup("o_orderstatus", {"O": "purchase", "F": "refund", "P": "bill_payment"})
    letter = F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise(
        money.lookup("o_orderstatus", {"O": "P", "F": "R", "P": "B"}))
    stamp = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_add("o_orderdate", 1)).otherwise(day("o_orderdate"))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), F.date_format(stamp, "yyyyMMdd"), letter, F.col("o_orderkey")).alias("id"),
        kind.alias("kind"), day("o_orderdate").alias("d"))
    failed = quality.id_prefix_fails("id", "kind", "d")
    return rows.groupBy("kind").agg(F.count_if(failed).alias("n_failed"), F.count(F.lit(1)).alias("n"))


@query("""
WITH t AS (SELECT event_type, value,
    CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'refund' WHEN 'click' THEN 'bill_payment'
                    WHEN 'view' THEN 'transfer_out' ELSE 'salary_in' END AS kind FROM events)
SELECT kind AS transaction_type, coalesce(CASE
    WHEN (kind IN ('purchase', 'refund') OR value > 150) AND kind NOT IN ('purchase', 'refund') THEN 'merchant_id_not_applicable'
    WHEN (kind = 'bill_payment' OR value > 100) AND kind <> 'bill_payment' THEN 'biller_id_not_applicable'
    WHEN value > 90 AND kind <> 'bill_payment' THEN 'bill_reference_not_applicable'
    WHEN value > 75 AND kind <> 'bill_payment' THEN 'due_date_not_applicable'
    WHEN (kind = 'transfer_out' OR value > 60) AND kind <> 'transfer_out' THEN 'counterparty_iban_not_applicable'
    WHEN value > 45 AND kind <> 'refund' THEN 'original_transaction_id_not_applicable' END, 'ok') AS finding,
  count(*) AS n FROM t GROUP BY ALL""")
def cross_field_nulls(spark, sf_dir):
    kind = money.lookup("event_type", {"purchase": "purchase", "error": "refund", "click": "bill_payment",
                                       "view": "transfer_out", "signup": "salary_in"})
    used = lambda kind, limit, what: F.when((F.col("transaction_type") == kind) | (F.col("value") > limit), what)
    rows = table(spark, sf_dir, "events").select("value", kind.alias("transaction_type")).select(
        "transaction_type",
        F.when(F.col("transaction_type").isin("purchase", "refund") | (F.col("value") > 150), "M").alias("merchant_id"),
        F.when((F.col("transaction_type") == "bill_payment") | (F.col("value") > 100), "B").alias("biller_id"),
        F.when((F.col("transaction_type") == "transfer_out") | (F.col("value") > 60), "LT").alias("counterparty_iban"),
        used("bill_payment", 90, "r").alias("bill_reference"), used("bill_payment", 75, "2026-01-01").alias("due_date"),
        used("refund", 45, "T").alias("original_transaction_id"))
    finding = F.coalesce(quality.first_reason(quality.cross_field_rules()), F.lit("ok"))
    return rows.groupBy("transaction_type", finding.alias("finding")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH b AS (SELECT CAST(ts AS DATE) AS d, event_id, event_type, value,
    CASE WHEN event_type = 'view' AND value > 100 THEN NULL ELSE event_id END AS k,
    CASE WHEN event_type = 'error' AND value > 60 THEN 'EUX' ELSE 'EUR' END AS ccy,
    CASE WHEN event_type = 'click' AND value > 80 THEN -value ELSE value END AS amt,
    CASE WHEN event_type = 'signup' AND value > 90 THEN ts + INTERVAL 400 DAY ELSE ts END AS t2,
    CASE WHEN event_type = 'purchase' AND value > 70 THEN NULL ELSE 'B' END AS biller FROM events)
SELECT d AS batch_date, coalesce(CASE WHEN k IS NULL THEN 'missing_transaction_id' WHEN ccy = 'EUX' THEN 'invalid_currency'
   WHEN amt <= 0 THEN 'negative_amount' WHEN CAST(timezone('Europe/Vilnius', timezone('UTC', t2)) AS DATE) > d THEN 'future_event_ts'
   WHEN event_type = 'purchase' AND biller IS NULL THEN 'bill_without_biller' END, 'ok') AS finding, count(*) AS n FROM b GROUP BY ALL""")
def business_rules(spark, sf_dir):
    """The payment feed's rules on spoiled events; purchases play bill payments."""
    spoiled = lambda kind, limit: (F.col("event_type") == kind) & (F.col("value") > limit)
    utc = F.date_format(F.when(spoiled("signup", 90), F.col("ts") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("ts")),
                        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, sf_dir, "events").select(
        F.when(~spoiled("view", 100), F.col("event_id").cast("string")).alias("transaction_id"),
        F.when(spoiled("error", 60), "EUX").otherwise("EUR").alias("currency"),
        F.when(spoiled("click", 80), -decimal("value")).otherwise(decimal("value")).cast("string").alias("amount"),
        utc.alias("event_ts"), F.when(~spoiled("purchase", 70), "B").alias("biller_id"),
        F.when(F.col("event_type") == "purchase", "bill_payment").otherwise("purchase").alias("transaction_type"),
        F.lit(None).cast("string").alias("due_date"), day("ts").alias("_batch_date"))
    columns = {"transaction_id": "string", "currency": "string", "amount": "decimal(18,2)", "event_ts": "timestamp",
               "biller_id": "string", "transaction_type": "string", "due_date": "date_or_instant"}
    typed = clean.typed_projection(rows, columns, keep=["_batch_date"])
    rules = quality.transaction_rules(["EUR", "PLN", "SEK", "GBP", "USD"], columns)
    finding = F.coalesce(quality.first_reason(rules), F.lit("ok"))
    return typed.groupBy(F.col("_batch_date").alias("batch_date"), finding.alias("finding")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
WHERE (o_orderpriority, o_orderstatus) NOT IN (('1-URGENT', 'F'), ('1-URGENT', 'O'), ('2-HIGH', 'F'), ('3-MEDIUM', 'P'), ('5-LOW', 'O'))
GROUP BY ALL""")
def allowed_pairs(spark, sf_dir):
    allowed = {"1-URGENT": ["F", "O"], "2-HIGH": ["F"], "3-MEDIUM": ["P"], "5-LOW": ["O"]}
    table_of = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    fine = F.array_contains(F.try_element_at(table_of, F.col("o_orderpriority")), F.col("o_orderstatus"))
    return (table(spark, sf_dir, "orders").filter(~F.coalesce(fine, F.lit(False)))
            .groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("""
WITH x AS (SELECT s_suppkey, CASE WHEN n_regionkey = 0 THEN 'LT' WHEN n_regionkey = 1 THEN 'PL' WHEN n_regionkey = 2 THEN 'SE'
                                  WHEN n_regionkey = 3 THEN 'GB' ELSE 'US' END AS country
           FROM supplier JOIN nation ON n_nationkey = s_nationkey),
t AS (SELECT country, CASE country WHEN 'LT' THEN 'EUR' WHEN 'PL' THEN 'PLN' WHEN 'SE' THEN 'SEK' WHEN 'GB' THEN 'GBP' ELSE 'USD' END AS expected,
       CASE WHEN l_returnflag = 'A' THEN 'EUR' WHEN country = 'LT' THEN 'EUR' WHEN country = 'PL' THEN 'PLN' WHEN country = 'SE' THEN 'SEK' WHEN country = 'GB' THEN 'GBP' ELSE 'USD' END AS currency,
       CASE WHEN l_linestatus = 'O' THEN 'online' ELSE 'pos' END AS channel
      FROM lineitem JOIN x ON s_suppkey = l_suppkey)
SELECT country, currency, channel, currency = expected AS currency_ok, country = 'LT' OR channel = 'online' AS channel_ok, count(*) AS n
FROM t GROUP BY ALL""")
def country_currency(spark, sf_dir):
    """Currency follows the merchant's country; foreign merchants sell online only."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    country = money.lookup("n_regionkey", {0: "LT", 1: "PL", 2: "SE", 3: "GB", 4: "US"})
    merchants = table(spark, sf_dir, "supplier").join(nation, "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), country.alias("country"))
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    expected = money.lookup("country", money.CURRENCY_BY_COUNTRY)
    rows = salted_join(lines, merchants, ["l_suppkey"], "inner").select(
        "country", F.when(F.col("l_returnflag") == "A", "EUR").otherwise(expected).alias("currency"),
        F.when(F.col("l_linestatus") == "O", "online").otherwise("pos").alias("channel"))
    return (rows.withColumn("currency_ok", F.col("currency") == expected)
            .withColumn("channel_ok", (F.col("country") == "LT") | (F.col("channel") == "online"))
            .groupBy(*["country", "currency", "channel", "currency_ok", "channel_ok"]).agg(F.count(F.lit(1)).alias("n")))


@query("""
WITH t AS (SELECT CASE event_type WHEN 'view' THEN 'pos' WHEN 'click' THEN 'online' WHEN 'error' THEN 'mobile_app' WHEN 'signup' THEN 'web' ELSE 'bank_network' END AS channel,
   CASE WHEN value > 100 THEN 'ios' WHEN event_type = 'view' THEN 'pos_terminal' WHEN event_type = 'error' THEN 'android' ELSE 'web_browser' END AS device FROM events)
SELECT channel, device, (channel || '/' || device) IN ('pos/pos_terminal', 'online/web_browser', 'web/web_browser', 'bank_network/bank_system', 'mobile_app/ios', 'mobile_app/android') AS allowed,
  count(*) AS n FROM t GROUP BY ALL""")
def device_domain(spark, sf_dir):
    channel = money.lookup("event_type", {"view": "pos", "click": "online", "error": "mobile_app", "signup": "web",
                                          "purchase": "bank_network"})
    device = (F.when(F.col("value") > 100, "ios").when(F.col("event_type") == "view", "pos_terminal")
              .when(F.col("event_type") == "error", "android").otherwise("web_browser"))
    return (table(spark, sf_dir, "events").select(channel.alias("channel"), device.alias("device"))
            .withColumn("allowed", money.device_allowed("channel", "device"))
            .groupBy("channel", "device", "allowed").agg(F.count(F.lit(1)).alias("n")))


@query("""
WITH x AS (SELECT CASE WHEN d < -5 THEN 'too_early' WHEN d > 10 THEN 'too_late' END AS finding, isodow(l_shipdate) > 5 AS weekend
   FROM (SELECT l_shipdate, date_diff('day', o_orderdate, l_shipdate) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey))
SELECT coalesce(finding, 'in_range') AS finding, weekend, count(*) AS n FROM x GROUP BY ALL""")
def lateness_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    late = dates.days_late("l_shipdate", "o_orderdate")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")
    finding = F.when(late < -5, "too_early").when(late > 10, "too_late").otherwise("in_range")
    return rows.groupBy(finding.alias("finding"), (F.weekday("l_shipdate") > 4).alias("weekend")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH span AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders),
cal AS (SELECT CAST(x AS DATE) AS d FROM span, generate_series(date_trunc('month', a)::TIMESTAMP, last_day(b)::TIMESTAMP, INTERVAL 1 DAY) t(x)),
k AS (SELECT d, isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26') AS bd FROM cal),
o AS (SELECT CAST(o_orderdate AS DATE) AS d, list_sort(list(DISTINCT o_orderpriority)) AS ps FROM orders GROUP BY 1)
SELECT coalesce(k.d, o.d) AS d, CASE WHEN o.d IS NULL THEN 'no_file' WHEN NOT bd THEN 'closing_day'
       WHEN len(ps) < 5 THEN 'currencies_missing' END AS finding
FROM k FULL JOIN o ON k.d = o.d WHERE (bd AND o.d IS NULL) OR (o.d IS NOT NULL AND NOT bd) OR (bd AND len(ps) < 5)""")
def feed_calendar(spark, sf_dir):
    """A rate file exists exactly on publication days and holds every currency (priorities stand in)."""
    orders = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("d"), "o_orderpriority")
    # Values outside the contract list are irrelevant here, so the set per day is at most the list.
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    published = orders.groupBy("d").agg(*[F.max(F.col("o_orderpriority") == n).alias(f"_h{i}") for i, n in enumerate(names)])
    complete = F.lit(True)
    for i in range(len(names)):
        complete = complete & F.col(f"_h{i}")
    days = cal.calendar_of(orders, F.col("d")).select(F.col("date").alias("d"), "is_business_day")
    both = days.join(published.select("d", complete.alias("complete")), "d", "full_outer")
    finding = (F.when(F.col("complete").isNull() & F.col("is_business_day"), "no_file")
               .when(F.col("complete").isNotNull() & ~F.col("is_business_day"), "closing_day")
               .when(~F.col("complete") & F.col("is_business_day"), "currencies_missing"))
    return both.select("d", finding.alias("finding")).filter(F.col("finding").isNotNull())


@query("""
WITH x AS (SELECT l_returnflag, CAST(l_quantity AS DECIMAL(18,4)) AS units, CAST(CAST(l_discount AS DECIMAL(18,4)) + CAST(0.0125 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS price,
    CASE WHEN l_linestatus = 'F' THEN round(CAST(l_quantity AS DECIMAL(18,4)) * CAST(CAST(l_discount AS DECIMAL(18,4)) + CAST(0.0125 AS DECIMAL(18,4)) AS DECIMAL(18,4)), 2)
         ELSE trunc(l_quantity * 100 * (l_discount * 10000 + 125) / 10000 + 1e-7) / 100 END AS mv FROM lineitem)
SELECT l_returnflag, count(*) AS n, CAST(count_if(CAST(mv AS DECIMAL(18,2)) <> round(units * price, 2)) AS BIGINT) AS n_different,
  CAST(sum(round(units * price, 2)) AS DECIMAL(38,2)) AS total FROM x GROUP BY 1""")
def product_consistency(spark, sf_dir):
    """market_value = units x price, half up; open lines were rounded down by their source."""
    units, price = decimal("l_quantity", 4), (decimal("l_discount", 4) + F.lit("0.0125").cast("decimal(18,4)")).cast("decimal(18,4)")
    exact = (units * price)
    stated = F.when(F.col("l_linestatus") == "F", money.half_up(exact)).otherwise(F.floor(exact * 100) / 100).cast("decimal(18,2)")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", money.half_up(exact).alias("expected"), stated.alias("stated"))
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("stated") != F.col("expected")).alias("n_different"),
        F.sum("expected").cast("decimal(38,2)").alias("total"))


@query("""
WITH k AS (SELECT event_type, CAST(ts AS DATE) AS d, event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) * 10000000 + event_id AS seq,
                  CASE WHEN event_type = 'error' AND value > 80 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS bd,
                  CASE WHEN event_type = 'view' AND value > 80 THEN 2 ELSE 1 END AS copies FROM events)
SELECT event_type, seq, bd AS batch_date, CAST(copies AS BIGINT) AS uses,
       CASE WHEN copies > 1 THEN 'repeated' ELSE 'wrong_day' END AS finding
FROM k WHERE copies > 1 OR bd <> d""")
def order_key_check(spark, sf_dir):
    """Large error events arrive under the next day's batch, large views twice."""
    events = table(spark, sf_dir, "events")
    rows = events.select("event_type", dates.change_sequence(day("ts"), "event_id").alias("seq"),
                         F.when((F.col("event_type") == "error") & (F.col("value") > 80), F.date_add("ts", 1))
                         .otherwise(day("ts")).alias("batch_date"),
                         F.when((F.col("event_type") == "view") & (F.col("value") > 80), 2).otherwise(1).alias("copies"))
    sent = rows.select("event_type", "seq", "batch_date", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")
    return quality.sequence_findings(sent, ["event_type"], "seq", "batch_date")


@query("""
SELECT user_id, event_id, previous_status, event_type FROM (
  SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_status FROM events)
WHERE NOT coalesce(CASE WHEN previous_status IS NULL THEN event_type IN ('signup', 'view')
      WHEN previous_status = 'signup' THEN event_type = 'view' WHEN previous_status = 'view' THEN event_type IN ('click', 'view', 'error')
      WHEN previous_status = 'click' THEN event_type IN ('purchase', 'view', 'error') ELSE false END, false)""")
def lifecycle_transitions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    allowed = {None: ["signup", "view"], "signup": ["view"], "view": ["click", "view", "error"],
               "click": ["purchase", "view", "error"]}
    return quality.lifecycle_findings(events, ["user_id"], ["event_id"], "event_type", allowed)


@query("""
WITH r AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
  sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS live FROM events)
SELECT user_id, event_id, op, CAST(live AS BIGINT) AS live_after FROM r WHERE (op = 'D' AND live <> 0) OR (op = 'I' AND live <> 1)""")
def running_delete_check(spark, sf_dir):
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    changes = table(spark, sf_dir, "events").select("user_id", "event_id", op.alias("op"))
    return quality.running_delete_findings(changes, ["user_id"], ["event_id"])


@query("""
WITH p AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n, count_if(event_type <> 'view' AND NOT (day(ts) > 15 AND event_type = 'click')) AS known,
           count_if(value < 300) AS cheap FROM events GROUP BY 1),
l AS (SELECT d, 'merchant_id' AS column_name, n AS rows, n - known AS null_rows FROM p UNION ALL SELECT d, 'amount', n, n - cheap FROM p),
w AS (SELECT *, CAST(floor(null_rows * 100 / rows) AS BIGINT) AS null_pct,
   CAST(floor(sum(null_rows) OVER t * 100 / sum(rows) OVER t) AS BIGINT) AS baseline_pct FROM l
   WINDOW t AS (PARTITION BY column_name ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT d AS batch_date, column_name, rows, CAST(null_rows AS BIGINT) AS null_rows, null_pct, baseline_pct
FROM w WHERE null_pct - baseline_pct >= 10""")
def null_rate_alert(spark, sf_dir):
    """From the 16th on click events stop filling a field."""
    gone = (F.col("event_type") == "view") | ((F.dayofmonth("ts") > 15) & (F.col("event_type") == "click"))
    rows = table(spark, sf_dir, "events").select(
        day("ts").alias("batch_date"), F.when(~gone, F.col("user_id")).alias("merchant_id"),
        F.when(F.col("value") < 300, F.col("value")).alias("amount"))
    return quality.null_rate_alerts(quality.null_rates(rows, ["batch_date"], ["merchant_id", "amount"]), "batch_date",
                                    min_increase_pct=10)


@query("""
WITH seen AS (SELECT DISTINCT CAST(ts AS DATE) AS d, unnest(json_keys(
    CASE WHEN event_type = 'click' AND day(ts) >= 20 THEN '{"device": 1, ' || substr(props, 2) ELSE props END)) AS field FROM events),
e AS (SELECT DISTINCT d, f.field FROM seen, (VALUES ('k'), ('v')) f(field))
SELECT coalesce(s.d, e.d) AS batch_date, coalesce(s.field, e.field) AS field, CASE WHEN e.d IS NULL THEN 'unexpected' ELSE 'missing' END AS finding
FROM seen s FULL JOIN e ON s.d = e.d AND s.field = e.field WHERE s.d IS NULL OR e.d IS NULL""")
def schema_drift(spark, sf_dir):
    """Contract fields k and v: v never arrives, click events bring `device` from the 20th on."""
    changed = (F.col("event_type") == "click") & (F.dayofmonth("ts") >= 20)
    props = F.when(changed, F.concat(F.lit('{"device": 1, '), F.expr("substr(props, 2)"))).otherwise(F.col("props"))
    seen = table(spark, sf_dir, "events").select(day("ts").alias("batch_date"), F.explode(F.json_object_keys(props)).alias("field"))
    return quality.schema_drift(seen, ["k", "v"], ["batch_date"])


@query("""
WITH raw AS (SELECT CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber, l_quantity FROM lineitem),
g AS (SELECT *, row_number() OVER (PARTITION BY d, l_orderkey, l_linenumber ORDER BY l_quantity DESC) AS rn FROM raw WHERE l_quantity > 1),
m AS (SELECT d, count(*) AS n, count_if(l_quantity <= 1) AS q FROM raw GROUP BY d),
s AS (SELECT d, count_if(rn = 1) AS good, count_if(rn > 1) AS dup FROM g GROUP BY d)
SELECT m.d AS batch_date, n AS manifest_rows, n AS bronze_rows, CAST(coalesce(good, 0) AS BIGINT) AS silver_rows, CAST(q AS BIGINT) AS quarantined_rows,
  CAST(coalesce(dup, 0) AS BIGINT) AS duplicate_rows, 'OK' AS status FROM m LEFT JOIN s ON s.d = m.d""")
def layer_reconcile(spark, sf_dir):
    """Rows per ship date: landed, quarantined (quantity 1), duplicate, and what remains."""
    lines = table(spark, sf_dir, "lineitem").select(day("l_shipdate").alias("batch_date"), "l_orderkey", "l_linenumber", "l_quantity")
    good, bad = quality.split_quarantine(lines, [quality.Rule("too_few", "business", F.col("l_quantity") <= 1)])
    keys = ["batch_date", "l_orderkey", "l_linenumber"]
    count = lambda df: df.groupBy("batch_date").agg(F.count(F.lit(1)).alias("rows"))
    copies = (good.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("rows")).groupBy("batch_date").agg(F.sum("rows").alias("rows")))
    silver = clean.winners(good, keys, [F.desc("l_quantity")])
    return reconcile.layer_counts(count(lines), count(lines), count(silver), count(bad), copies, "batch_date")


@query("""
SELECT CAST(o_orderdate AS DATE) AS partition_date FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 480000
GROUP BY 1""")
def affected_partitions(spark, sf_dir):
    late = table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 480000))
    return clean.affected_partitions(late.select(day("o_orderdate").alias("partition_date")), "partition_date")


@query("""
SELECT c_custkey, sha256('pepper' || c_name) AS c_name, c_mktsegment FROM customer""")
def pii_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return clean.hide_personal(rows, ["c_name"], salt="pepper")


@query("""
SELECT CAST(ts AS DATE) AS batch_date, CAST(coalesce(json_extract_string(p, '$.key_ref'), json_extract_string(p, '$.k')) AS INT) AS k, count(*) AS n
FROM (SELECT ts, CASE WHEN event_type = 'view' THEN replace(props, '"k"', '"key_ref"') ELSE props END AS p FROM events) GROUP BY ALL""")
def silver_projection(spark, sf_dir):
    """Contract fields only; a renamed field is read under its contract name."""
    props = F.when(F.col("event_type") == "view", F.regexp_replace("props", '"k"', '"key_ref"')).otherwise(F.col("props"))
    fields = table(spark, sf_dir, "events").select(day("ts").alias("_batch_date"), F.from_json(props, "map<string,string>").alias("f"))
    bronze = fields.select("_batch_date", F.try_element_at("f", F.lit("k")).alias("k"),
                           F.try_element_at("f", F.lit("key_ref")).alias("key_ref"), F.lit("x").alias("unapproved"))
    typed = clean.typed_projection(clean.merge_renamed(bronze, {"k": ["key_ref"]}), {"k": "int"}, keep=["_batch_date"])
    return typed.groupBy(F.col("_batch_date").alias("batch_date"), "k").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN n_regionkey = 0 THEN 'LT' WHEN n_regionkey = 1 THEN 'LV' ELSE 'EE' END AS country, c_mktsegment,
    CASE WHEN n_regionkey = 0 OR c_mktsegment = 'BUILDING' THEN '+3706' WHEN n_regionkey = 1 THEN '+3712' ELSE '+3725' END || c_custkey AS phone
   FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT country, c_mktsegment, count(*) AS n, CAST(count_if(NOT starts_with(phone, CASE country WHEN 'LT' THEN '+3706' WHEN 'LV' THEN '+3712' ELSE '+3725' END)) AS BIGINT) AS n_bad_phone
FROM c GROUP BY ALL""")
def holder_rules(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    country = F.when(F.col("n_regionkey") == 0, "LT").when(F.col("n_regionkey") == 1, "LV").otherwise("EE")
    prefix = money.lookup(F.when(F.col("c_mktsegment") == "BUILDING", "LT").otherwise(F.col("country")), money.PHONE_PREFIX_BY_COUNTRY)
    rows = (table(spark, sf_dir, "customer").join(nation, "c_nationkey").withColumn("country", country)
            .withColumn("phone", F.concat(prefix, F.col("c_custkey"))))
    bad = ~F.startswith("phone", money.lookup("country", money.PHONE_PREFIX_BY_COUNTRY))
    return rows.groupBy("country", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad_phone"))
