"""Silver to Gold: dimensions, facts and marts of the bank model."""
from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, money
from millrace.operators import calendar as cal
from millrace.operators import facts, history, keys, lookups, marts
from millrace.operators.skew import hot_keys, salted_join
from millrace.plans.silver import log_of, read_silver
from millrace.registry import BY_ENTITY
from millrace.sources import tables
from millrace.sources.commits import Version

CHANGE_ORDER = ["change_seq"]
PROFILE = ["payment_method", "channel", "transaction_type", "status"]


@dataclass
class Silver:
    """Reads the Silver tables of one lake, each as of the version it was first asked for; the gold builders below take it
    as their only input."""
    spark: SparkSession
    lake: tables.Lake
    versions: dict[str, Version] = field(default_factory=dict)
    parts: dict[str, DataFrame] = field(default_factory=dict)

    def version(self, entity: str) -> Version:
        if entity not in self.versions:
            self.versions[entity] = log_of(self.spark, self.lake, BY_ENTITY[entity]).current()
        return self.versions[entity]

    def __call__(self, entity: str, days: Iterable[str] | None = None) -> DataFrame:
        if days is None and entity in self.parts:
            return self.parts[entity]
        return read_silver(self.spark, self.lake, BY_ENTITY[entity], at=self.version(entity), values=days)

    def only(self, **parts: DataFrame) -> Silver:
        """The same tables, but of some entities the given rows alone."""
        return replace(self, parts={**self.parts, **parts})

    def key_map(self) -> DataFrame:
        edges = history.key_changes(self("customers"), "old_customer_id", "customer_id", "change_seq")
        return history.key_map(edges)


#: (versions, member column, version column, key column) -> versions with their surrogate keys.
KeyMaker = Callable[[DataFrame, str, str, str], DataFrame]


def hashed_keys(versions: DataFrame, member: str, version: str, sk: str) -> DataFrame:
    """Keys without a store: what the store would draw first for the same names."""
    name = F.coalesce(F.col(version).cast("string"), F.lit(keys.OPEN))
    return versions.withColumn(sk, keys.hashed(F.col(member).cast("string"), name, 0))


def with_durable_customer(df: DataFrame, mapping: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """`base`: the stored table a derived `df` comes from, to look for hot customers in."""
    hot = hot_keys(base, ["customer_id"]) if base is not None else None
    return history.resolve_keys(df, mapping, "customer_id", "customer_dk", hot=hot)


# -- dimensions ------------------------------------------------------------------------------------------
def dim_customer(silver: Silver, mapping: DataFrame, facts_for_stubs: DataFrame | None = None,
                 keyed: KeyMaker = hashed_keys) -> DataFrame:
    """One chain per durable key across key changes; no personal columns. A version is named by the change that opened it."""
    changes = with_durable_customer(silver("customers"), mapping)
    versions = history.scd2(changes, ["customer_dk"], CHANGE_ORDER, "change_ts",
                            ["segment", "city", "country", "kyc_status", "risk_rating"], op="op",
                            carry=["customer_id", *CHANGE_ORDER])
    if facts_for_stubs is not None:
        versions = history.inferred_members(facts_for_stubs, versions, "customer_dk", "event_ts")
    return keyed(versions, "customer_dk", "change_seq", "customer_sk").drop("change_seq")


def _versioned(changes: DataFrame, key: str, sk: str, attributes: list[str], stubs: DataFrame | None,
               keyed: KeyMaker) -> DataFrame:
    versions = history.scd2(changes, [key], CHANGE_ORDER, "change_ts", attributes, op="op", carry=CHANGE_ORDER)
    if stubs is not None:
        versions = history.inferred_members(stubs, versions, key, "event_ts")
    return keyed(versions, key, "change_seq", sk).drop("change_seq")


def dim_account(silver: Silver, stubs: DataFrame | None = None, keyed: KeyMaker = hashed_keys) -> DataFrame:
    return _versioned(silver("accounts"), "account_id", "account_sk", ["account_type", "status", "open_date"], stubs, keyed)


def dim_merchant(silver: Silver, stubs: DataFrame | None = None, keyed: KeyMaker = hashed_keys) -> DataFrame:
    return _versioned(silver("merchants"), "merchant_id", "merchant_sk",
                      ["merchant_name", "mcc", "category", "country"], stubs, keyed)


def bridge_account_customer(silver: Silver, mapping: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Who held which account when; a key change closes and reopens the link under the same customer."""
    changes = with_durable_customer(silver("account_holders"), mapping)
    links = facts.bridge(changes, ["account_id", "customer_dk"], CHANGE_ORDER, "change_ts", ["role"])
    keyed = lookups.version_lookup(links, accounts, ["account_id"], "valid_from", "account_sk", "account_sk")
    keyed = lookups.version_lookup(keyed, customers, ["customer_dk"], "valid_from", "customer_sk", "customer_sk")
    return keyed.drop("row_hash")


def dim_biller(silver: Silver) -> DataFrame:
    """Type 1; a biller missing from the newest snapshot stays, inactive, for the facts that name it."""
    latest = history.latest_with_activity(silver("billers"), ["biller_id"], "_batch_date")
    return latest.select(history.surrogate_key("biller_id").alias("biller_sk"), "biller_id", "biller_name",
                         "bill_type", "is_active")


def dim_invest_product(silver: Silver, verified: DataFrame | None = None, keyed: KeyMaker = hashed_keys) -> DataFrame:
    """A version is named by the snapshot that opened it. `verified` holds the `_batch_date` of accepted batches; Silver holds no other rows if it was built with verdicts."""
    snapshots = silver("invest_products")
    days = history.complete_snapshots(snapshots, "_batch_date", verified)
    versions = history.scd2_from_snapshots(snapshots, days, ["isin"], "_batch_date",
                                           ["product_name", "asset_class", "risk_level"])
    return keyed(versions, "isin", "valid_from", "product_sk")


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    return cal.calendar(spark, start, end).drop("month_key")


# -- facts -----------------------------------------------------------------------------------------------
def dense_rates(silver: Silver, until: str) -> DataFrame:
    return lookups.daily_rates(silver("fx_rates"), "currency", "rate_date", "rate", F.lit(until).cast("date"))


def fact_transaction(silver: Silver, mapping: DataFrame, customers: DataFrame, accounts: DataFrame,
                     merchants: DataFrame, until: str) -> DataFrame:
    """One row per transaction, declined ones included; every key found as of the event."""
    rows = (with_durable_customer(silver("transactions"), mapping)
            .withColumn("business_date", dates.local_date("event_ts")))
    rows = lookups.convert(rows, dense_rates(silver, until), "currency", "business_date", "amount")
    rows = facts.dimension_keys(rows, [(customers, "customer_dk", "customer_sk"), (accounts, "account_id", "account_sk"),
                                       (merchants, "merchant_id", "merchant_sk")], "event_ts")
    return rows.select(
        "transaction_id", "event_ts", dates.date_key("business_date").alias("date_key"), "customer_sk", "account_sk",
        "merchant_sk", history.surrogate_key(*PROFILE).alias("txn_profile_sk"), "original_transaction_id", "amount",
        "currency", "fx_rate", F.col("amount_base").alias("amount_eur"), "_source_file",
        F.col("_batch_date").alias("_batch_id"), "business_date", "customer_dk", "merchant_id", *PROFILE)


def fact_bill_payment(silver: Silver, mapping: DataFrame, customers: DataFrame, billers: DataFrame) -> DataFrame:
    stored = silver("transactions").filter(F.col("transaction_type") == "bill_payment")
    bills = (with_durable_customer(stored, mapping)
             .withColumn("business_date", dates.local_date("event_ts")))
    bills = facts.bill_payments(bills, "business_date", "due_date")
    bills = facts.dimension_keys(bills, [(customers, "customer_dk", "customer_sk")], "event_ts")
    return facts.current_key(bills, billers, "biller_id", "biller_sk", hot=hot_keys(stored, ["biller_id"])).select(
        "transaction_id", "date_key", "due_date_key", "customer_sk", "biller_sk", "amount", "days_late",
        "customer_dk", "business_date")


def fact_holding_snapshot(silver: Silver, mapping: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Positions of business days; product and customer versions as of the end of the day."""
    rows = (with_durable_customer(silver("holdings"), mapping)
            .filter(dates.is_business_day("business_date"))
            .withColumn("_end", dates.day_end("business_date"))
            .withColumn("_day", F.col("business_date")))
    rows = lookups.version_lookup(rows, customers, ["customer_dk"], "_end", "customer_sk", "customer_sk")
    rows = lookups.version_lookup(rows, products, ["isin"], "_day", "product_sk", "product_sk")
    return rows.select(dates.date_key("business_date").alias("date_key"), "customer_sk", "product_sk", "units", "price",
                       "market_value", "business_date", "customer_dk", "isin")


def fact_kyc_check(silver: Silver, mapping: DataFrame, customers: DataFrame) -> DataFrame:
    rows = facts.dimension_keys(with_durable_customer(silver("kyc_checks"), mapping),
                                [(customers, "customer_dk", "customer_sk")], "check_ts")
    return rows.select("kyc_check_id", dates.date_key(dates.local_date("check_ts")).alias("date_key"), "customer_sk",
                       "check_type", "result")


def fact_support_case(silver: Silver, mapping: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per case, dates filled as the case moves on; the customer is the case's current one."""
    changes = silver("support_cases")
    cases = facts.accumulating_snapshot(
        changes, ["case_id"], CHANGE_ORDER,
        {"opened_at": F.col("opened_ts"), "first_response_at": F.col("first_response_ts"), "resolved_at": F.col("resolved_ts")},
        ["customer_id", "channel", "reason", "status", "change_ts"])
    cases = facts.dimension_keys(with_durable_customer(cases, mapping, changes), [(customers, "customer_dk", "customer_sk")], "change_ts")
    key = lambda c: dates.date_key(dates.local_date(c))
    return cases.select(
        "case_id", "customer_sk", key("opened_at").alias("opened_date_key"),
        key("first_response_at").alias("first_response_date_key"), key("resolved_at").alias("resolved_date_key"),
        "channel", "reason", "status", facts.resolution_hours("opened_at", "resolved_at").alias("resolution_hours"),
        "customer_dk")


def fact_credit_score_snapshot(silver: Silver, mapping: DataFrame, customers: DataFrame) -> DataFrame:
    """Month x customer; the version valid at the end of the reported month."""
    first = F.to_date(F.concat("report_month", F.lit("-01")))
    rows = (with_durable_customer(silver("credit_scores"), mapping)
            .withColumn("_end", dates.day_end(F.last_day(first)))
            .withColumn("month_index", marts.month_index(first)).withColumn("report_month_key", dates.month_key(first)))
    rows = lookups.version_lookup(rows, customers, ["customer_dk"], "_end", "customer_sk", "customer_sk")
    return rows.select("report_month_key", "customer_sk", "score", "risk_band", "open_credit_lines", "days_past_due_max",
                       "customer_dk", "month_index")


# -- marts -----------------------------------------------------------------------------------------------
def mart_spend_monthly(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Spend comes from the transaction fact only and leaves bill payments out."""
    category = merchants.select("merchant_sk", "category")
    rows = salted_join(transactions, category, ["merchant_sk"], "left")
    rows = rows.filter(F.col("transaction_type").isin("purchase", "refund"))
    return marts.spend_monthly(
        rows.withColumn("month", dates.month_text("business_date")), ["customer_dk", "month", "category", "payment_method"],
        "amount_eur", F.col("transaction_type") == "purchase", F.col("transaction_type") == "refund",
        F.col("status") == "completed")


def mart_bill_behaviour(bills: DataFrame, billers: DataFrame) -> DataFrame:
    rows = salted_join(bills, billers.select("biller_sk", "bill_type"), ["biller_sk"], "left")
    return marts.bill_behaviour(rows.withColumn("month", dates.month_text("business_date")),
                                ["customer_dk", "bill_type", "month"], "days_late")


def _indexed(df: DataFrame) -> DataFrame:
    return df.withColumn("month_index", marts.month_index("business_date"))


def monthly_lateness(bills: DataFrame) -> DataFrame:
    return (marts.monthly_lateness(_indexed(bills), ["customer_dk", "month_index"], "days_late")
            .withColumnRenamed("days_late_max", "dpd_max"))


def monthly_flows(transactions: DataFrame) -> DataFrame:
    done = F.col("status") == "completed"
    amount = lambda kind: F.sum(F.when((F.col("transaction_type") == kind) & done, F.col("amount_eur")))
    return _indexed(transactions).groupBy("customer_dk", "month_index").agg(
        amount("salary_in").alias("income"), amount("purchase").alias("spend"))


def mart_credit_features(scores: DataFrame, lateness: DataFrame, flows: DataFrame) -> DataFrame:
    """From one row per customer and month of each: the windows look back over months, so they run over these sums."""
    return marts.credit_features(scores.select("customer_dk", "month_index", "score", "risk_band"), lateness, flows, ["customer_dk"])


def monthly_holdings(holdings: DataFrame, products: DataFrame) -> DataFrame:
    """Month-end value per customer, asset class and month, with its share; each month stands for itself."""
    rows = salted_join(holdings, products.select("product_sk", "asset_class", "risk_level"), ["product_sk"], "left")
    # The month end is the last business day anyone was reported on, so a closed position counts as gone.
    last = rows.groupBy(marts.month_index("business_date").alias("month_index")).agg(F.max("business_date").alias("business_date"))
    ends = rows.join(F.broadcast(last), "business_date")
    parts = marts.allocation(ends, ["customer_dk", "month_index"], "asset_class", "market_value")
    risk = ends.groupBy("customer_dk", "month_index").agg(
        F.max("risk_level").alias("max_risk_level"), F.count_distinct("product_sk").alias("n_products"))
    return parts.join(risk, ["customer_dk", "month_index"])


def mart_invest_features(monthly: DataFrame) -> DataFrame:
    """Monthly holdings with each customer's total and its change on the month before."""
    totals = monthly.groupBy("customer_dk", "month_index").agg(F.sum("value").cast("decimal(38,2)").alias("total_value"))
    change = marts.monthly_change(totals, ["customer_dk"], "month_index", "total_value").drop("total_value_recent_max")
    return monthly.join(change, ["customer_dk", "month_index"])
