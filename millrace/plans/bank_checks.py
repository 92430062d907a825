"""The bank's cross-table rules over Silver, as (rule, rows_checked, rows_failed)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates, money
from millrace.operators import facts, history, lookups, marts, quality
from millrace.operators.quality import Rule
from millrace.operators.skew import salted_join
from millrace.plans.gold import CHANGE_ORDER, Silver, with_durable_customer
from millrace.registry import ACCOUNT_TYPES_BY_METHOD, CASE_LIFECYCLE, DOMAINS, OUTGOING
from millrace.sources import tables

MATCHED = ["account_id", "currency", "merchant_id", "payment_method", "customer_dk"]


def _found(rule: str, checked: DataFrame, failed: DataFrame) -> DataFrame:
    """A rule whose failing rows come from an operator of their own."""
    n = F.count(F.lit(1))
    both = (checked.agg(n.alias("n")).select(F.lit("rows_checked").alias("what"), "n")
            .unionByName(failed.agg(n.alias("n")).select(F.lit("rows_failed").alias("what"), "n")))
    return both.agg(F.max(F.when(F.col("what") == "rows_checked", F.col("n"))).alias("rows_checked"),
                    F.max(F.when(F.col("what") == "rows_failed", F.col("n"))).alias("rows_failed")).select(
        F.lit(rule).alias("rule"), "rows_checked", "rows_failed")


def _isin_map(key: str, value: str, allowed: dict[str, list[str]]) -> Column:
    table = F.create_map(*[x for k, v in allowed.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.array_contains(F.try_element_at(table, F.col(key)), F.col(value)), F.lit(False))


def transaction_checks(silver: Silver) -> DataFrame:
    """Rules a transaction can be judged by alone, or with its account and merchant; one pass."""
    rows = silver("transactions")
    accounts = history.replay(silver("accounts"), ["account_id"], CHANGE_ORDER).select("account_id", "account_type")
    closed = silver("accounts").filter("op = 'U' and status = 'closed'").groupBy("account_id").agg(
        F.min("_batch_date").alias("closed_on"))
    merchants = history.replay(silver("merchants"), ["merchant_id"], CHANGE_ORDER).select("merchant_id", "country")
    account = accounts.join(closed, "account_id", "left")
    joined = salted_join(rows, account, ["account_id"], "left")
    joined = joined.join(merchants, "merchant_id", "left")     # AQE splits a hot merchant; one row matches
    day = dates.local_date("event_ts")
    late = dates.days_late("_batch_date", "due_date")
    expected = F.coalesce(money.lookup("country", money.CURRENCY_BY_COUNTRY), F.lit("EUR"))
    rules = [
        *quality.domain_rules(DOMAINS["transactions"]), *quality.cross_field_rules(),
        Rule("business_date", "business", day != F.col("_batch_date")),
        Rule("id_prefix", "business", quality.id_prefix_fails("transaction_id", "transaction_type", "_batch_date")),
        Rule("account_type", "business", ~_isin_map("payment_method", "account_type", ACCOUNT_TYPES_BY_METHOD)),
        Rule("closed_account", "business", F.col("_batch_date") >= F.col("closed_on")),
        Rule("currency_of_country", "business", F.col("currency") != expected),
        Rule("foreign_not_online", "business", (F.col("country") != "LT") & (F.col("channel") != "online")),
        Rule("bill_lateness", "business", (F.col("transaction_type") == "bill_payment") & ~late.between(-5, 10)),
        Rule("salary_on_weekend", "business", (F.col("transaction_type") == "salary_in") & (F.weekday("_batch_date") > 4)),
        Rule("iban", "business", ~money.iban_valid("counterparty_iban")),
    ]
    return quality.rule_results(joined, rules)


def refund_checks(silver: Silver, mapping: DataFrame) -> DataFrame:
    """Refunds against their completed purchases; what has not arrived yet is pending, not wrong."""
    rows = with_durable_customer(silver("transactions"), mapping)
    refunds = rows.filter("transaction_type = 'refund'")
    originals = rows.filter("transaction_type = 'purchase' and status = 'completed'")
    linked = facts.linked_refunds(refunds, originals, "original_transaction_id", "transaction_id", "_batch_date",
                                  "_batch_date", MATCHED, "amount")
    return quality.rule_results(linked, [Rule("refund_link", "business", ~F.col("verdict").isin("ok", "pending"))])


def reference_checks(silver: Silver) -> DataFrame:
    """References as of each row's batch date."""
    rows = silver("transactions").select("merchant_id", "account_id", "biller_id", "_batch_date")
    results = []
    for entity, key in (("merchants", "merchant_id"), ("accounts", "account_id"), ("billers", "biller_id")):
        seen = silver(entity).select(key, F.col("_batch_date").alias("first_seen"))
        judged = quality.orphans_as_of(rows, seen, key, "_batch_date", "first_seen")
        results.append(quality.rule_results(judged, [Rule(f"orphan_{key}", "business", F.col("orphan_as_of"))]))
    last_seen = silver("billers").groupBy("biller_id").agg(F.max("_batch_date").alias("last_seen"))
    bills = salted_join(rows.filter("biller_id is not null"), last_seen, ["biller_id"], "left")
    results.append(quality.rule_results(bills, [
        Rule("biller_lifetime", "business", F.col("_batch_date") > F.col("last_seen"))]))
    return reduce(DataFrame.unionByName, results)


def customer_checks(silver: Silver, mapping: DataFrame) -> DataFrame:
    """KYC status in time, changes backed by checks, key changes, accounts of new customers, phone prefix."""
    changes = with_durable_customer(silver("customers"), mapping)
    rows = with_durable_customer(silver("transactions"), mapping).select(
        "customer_id", "customer_dk", "transaction_type", "_batch_date")
    status = changes.select("customer_dk", F.col("_batch_date").alias("since"), "kyc_status", "change_seq")
    status = status.groupBy("customer_dk", "since").agg(F.max_by("kyc_status", "change_seq").alias("kyc_status"))
    at_time = lookups.asof_join(rows, status, ["customer_dk"], "_batch_date", "since", ["kyc_status"])
    blocked = quality.rule_results(at_time, [Rule("expired_pays", "business",
                                                  F.col("transaction_type").isin(OUTGOING) & (F.col("kyc_status") == "expired"))])
    checks = silver("kyc_checks").groupBy("customer_id", "_batch_date").agg(F.max_by("result", "check_ts").alias("result"))
    fits = (F.col("kyc_status") == "verified") == (F.col("result") == "pass")
    backed = facts.backed_changes(changes, ["customer_dk"], CHANGE_ORDER, "kyc_status", "_batch_date", checks,
                                  ["customer_id", "_batch_date"], "result", fits)
    replaced = silver("customers").filter("old_customer_id is not null").select(
        F.col("old_customer_id").alias("customer_id"), F.col("_batch_date").alias("changed_on"))
    old_ids = salted_join(rows, replaced, ["customer_id"], "left")
    holders = silver("account_holders").filter("op = 'I' and role = 'primary'").join(
        silver("accounts").filter("op = 'I' and account_type = 'current'").select("account_id"), "account_id", "left_semi")
    first_day = changes.agg(F.min("_batch_date")).first()[0]
    new = silver("customers").filter("op = 'I'").filter(F.col("_batch_date") > F.lit(first_day)).select("customer_id", "_batch_date")
    without = new.join(holders.select("customer_id", "_batch_date"), ["customer_id", "_batch_date"], "left_anti")
    prefix = money.lookup("country", money.PHONE_PREFIX_BY_COUNTRY)
    return reduce(DataFrame.unionByName, [
        blocked,
        quality.rule_results(backed, [Rule("kyc_change_unbacked", "business", ~F.col("backed"))]),
        quality.rule_results(old_ids, [Rule("old_customer_id", "business", F.col("_batch_date") >= F.col("changed_on"))]),
        _found("new_customer_without_account", new, without),
        quality.rule_results(silver("customers"), [*quality.domain_rules(DOMAINS["customers"]),
                                                   Rule("phone_prefix", "business", ~F.startswith("phone", prefix))]),
    ])


def holder_checks(silver: Silver) -> DataFrame:
    """Joint differs from primary, cards and joint holders are verified, accounts open after the customer."""
    links = history.replay(silver("account_holders"), ["account_id", "customer_id"], CHANGE_ORDER).select(
        "account_id", "customer_id", "role")
    primary = links.filter("role = 'primary'").groupBy("account_id").agg(F.max("customer_id").alias("primary_id"))
    accounts = history.replay(silver("accounts"), ["account_id"], CHANGE_ORDER).select("account_id", "account_type", "open_date")
    customers = history.replay(silver("customers"), ["customer_id"], CHANGE_ORDER).select("customer_id", "kyc_status", "customer_since")
    joined = links.join(primary, "account_id", "left").join(accounts, "account_id", "left").join(customers, "customer_id", "left")
    joint = F.col("role") == "joint"
    rules = [Rule("joint_is_primary", "business", joint & (F.col("customer_id") == F.col("primary_id"))),
             Rule("holder_not_verified", "business", (joint | (F.col("account_type") == "credit_card")) & (F.col("kyc_status") != "verified")),
             Rule("opened_before_customer", "business", ~joint & (F.col("open_date") < F.col("customer_since")))]
    deletes = quality.running_delete_findings(silver("account_holders"), ["account_id", "customer_id"], CHANGE_ORDER)
    return quality.rule_results(joined, rules).unionByName(_found("delete_of_missing_holder", silver("account_holders"), deletes))


def other_checks(silver: Silver, mapping: DataFrame) -> DataFrame:
    """Holdings, scores, support cases and rates."""
    products = history.replay(silver("invest_products").withColumn("op", F.lit("I")), ["isin"], ["_batch_date"]).select("isin", "risk_level")
    ratings = history.replay(silver("customers"), ["customer_id"], CHANGE_ORDER).select("customer_id", "risk_rating")
    held = salted_join(silver("holdings"), products, ["isin"], "left").join(ratings, "customer_id", "left")
    holdings = quality.rule_results(held, [
        Rule("market_value", "business", (F.col("units") <= 0) | (F.col("market_value") != money.half_up(F.col("units") * F.col("price")))),
        Rule("suitability_warning", "business", ~money.suitable("risk_level", "risk_rating")),
        Rule("not_a_business_day", "business", ~dates.is_business_day("business_date"))])
    bills = with_durable_customer(silver("transactions").filter("transaction_type = 'bill_payment'"), mapping)
    lateness = marts.monthly_lateness(
        bills.withColumn("report_month", dates.month_text("_batch_date")).withColumn("late", dates.days_late("_batch_date", "due_date")),
        ["customer_dk", "report_month"], "late")
    scored = with_durable_customer(silver("credit_scores"), mapping).join(lateness, ["customer_dk", "report_month"], "left")
    scores = quality.rule_results(scored, [
        Rule("score_range", "business", ~F.col("score").between(1, 999)),
        Rule("score_band", "business", F.col("risk_band") != money.band("score")),
        Rule("report_month", "business", F.col("report_month") != dates.report_month("_batch_date")),
        Rule("days_past_due", "business", F.col("days_past_due_max") != F.coalesce("days_late_max", F.lit(0)))])
    steps = {None: CASE_LIFECYCLE[:1], **{a: [b] for a, b in zip(CASE_LIFECYCLE, CASE_LIFECYCLE[1:])}}
    cases = silver("support_cases")
    wrong = quality.lifecycle_findings(cases, ["case_id"], CHANGE_ORDER, "status", steps)
    times = quality.rule_results(cases, [Rule("case_times", "business", (F.col("first_response_ts") < F.col("opened_ts"))
                                              | (F.col("resolved_ts") < F.coalesce("first_response_ts", "opened_ts")))])
    rates = quality.rule_results(silver("fx_rates"), [
        *quality.domain_rules(DOMAINS["fx_rates"]), Rule("rate_positive", "business", F.col("rate") <= 0),
        Rule("rate_day", "business", ~dates.is_business_day("rate_date"))])
    return reduce(DataFrame.unionByName, [holdings, scores, _found("case_lifecycle", cases, wrong), times, rates])


def run(silver: Silver, run_id: str) -> DataFrame:
    """All checks, stored under the run and read back; a repeated run replaces its rows."""
    mapping = silver.key_map()
    groups = {"transactions": transaction_checks(silver), "refunds": refund_checks(silver, mapping),
              "references": reference_checks(silver), "customers": customer_checks(silver, mapping),
              "holders": holder_checks(silver), "other": other_checks(silver, mapping)}
    named = [df.withColumn("rule_group", F.lit(name)) for name, df in groups.items()]
    path = silver.lake.path("ops", "dq_results")
    tables.append_run(reduce(DataFrame.unionByName, named).withColumn("run_id", F.lit(run_id)), path)
    return tables.read_table(silver.spark, path).filter(F.col("run_id") == run_id)
