"""Gold brought up to date: from what changed in Silver to the months, members and marts that depend on it.

Everything is one commit. Facts and monthly sums are partitioned by month; a run computes the months

- that changed Silver batches fall into, before or now (`lineage_*`: batch date -> months),
- in which a member is used (`uses_*`) at a time for which its dimension, durable key or rate says something new,

and of links between refunds and originals also the months of refunds whose original changed. Dimensions, marts over
several months and small facts are computed whole from Silver's change feeds and from monthly sums, and only if one of
their inputs changed. All other partitions stay the files they were. Surrogate keys come from stores that only grow.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import changes, facts, history, keys
from millrace.plans import gold
from millrace.plans.silver import log_of
from millrace.registry import BY_ENTITY, FEEDS
from millrace.sources.commits import Log, Version
from millrace.sources.tables import Lake, staged

#: Feeds whose facts have months, with the columns that name members.
MEMBERS = {
    "transactions": ["customer_id", "account_id", "merchant_id", "biller_id", "currency", "original_transaction_id"],
    "holdings": ["customer_id", "isin"],
}
MATCHED = ["account_id", "currency", "merchant_id", "payment_method", "customer_dk"]
ALWAYS = "1900-01-01"


def gold_log(spark: SparkSession, lake: Lake) -> Log:
    return Log(spark, lake.path("gold"))


def read(spark: SparkSession, lake: Lake, table: str, at: Version | None = None) -> DataFrame:
    """A Gold table as of a version (default: the last)."""
    log = gold_log(spark, lake)
    return log.read(table, at or log.current())


def build(silver: gold.Silver, until: str) -> Version:
    """All of Gold, every month computed again; surrogate keys stay those of the stores."""
    return Update(silver, until, full=True).run()


def update(silver: gold.Silver, until: str) -> Version:
    """Brings Gold up to the Silver that `silver` sees; `until` is the last day that rates are carried to. The tables are
    those that `build` would leave, row by row and key by key."""
    return Update(silver, until).run()


def month_column(entity: str) -> Column:
    """The month that a row of a feed belongs to in Gold."""
    day = dates.local_date("event_ts") if entity == "transactions" else F.col("business_date")
    return changes.month_of(day)


class Update:
    """One run. Each step leaves in `rebuilt` the months it computed, which the commit's notes keep."""

    def __init__(self, silver: gold.Silver, until: str, full: bool = False):
        self.silver, self.until, self.spark = silver, until, silver.spark
        self.commit = gold_log(silver.spark, silver.lake).begin()
        notes = self.commit.base.notes
        self.consumed = {f.entity: silver.version(f.entity).number for f in FEEDS}
        self.full = full or not self.commit.base.number
        self.until_moved = notes.get("until") != until
        before = notes.get("silver", {})
        self.older = {e: log_of(self.spark, silver.lake, BY_ENTITY[e]).version(before.get(e, 0)) for e in self.consumed}
        self.changed = {e: silver.version(e).changed(self.older[e], "rows") for e in self.consumed}
        self.days: dict[str, dict[str, set[str]]] = {}        # feed -> month -> batch dates
        self.rebuilt: dict[str, list[str]] = {}

    # -- helpers -------------------------------------------------------------------------------------
    def now(self, table: str, months: Iterable[str] | None = None) -> DataFrame:
        return self.commit.read(table, months)

    def before(self, table: str) -> DataFrame | None:
        base = self.commit.base
        return self.commit.log.read(table, base) if table in base.schemas else None

    def put(self, table: str, df: DataFrame) -> DataFrame:
        self.commit.put(table, df)
        return self.now(table)

    def replace(self, table: str, df: DataFrame, months: set[str]) -> None:
        """Whole months of a table; without any, the table only gets its columns if it has none yet."""
        if months or table not in self.commit.schemas:
            month = F.coalesce("month", F.lit("none")) if "month" in df.columns else changes.month_of(F.col("business_date"))
            self.commit.replace(table, df.withColumn("month", month), "month", months)
        self.rebuilt[table] = sorted(months)

    def stale(self, table: str, *inputs: bool) -> bool:
        return self.full or table not in self.commit.base.schemas or any(inputs)

    def rows_of(self, entity: str, months: set[str]) -> DataFrame:
        """Silver rows of some months: only the batch dates that hold any of them are read."""
        days = set().union(*[self.days[entity].get(m, set()) for m in months])
        return self.silver(entity, days).where(month_column(entity).isin(sorted(months)))

    # -- what changed --------------------------------------------------------------------------------
    def relate(self, entity: str) -> set[str]:
        """Brings lineage and uses of a feed up to date; the months its changed batches fell or fall into."""
        table, at = f"lineage_{entity}", "event_ts" if entity == "transactions" else "business_date"
        moved = self.silver.version(entity).values("rows") | self.older[entity].values("rows") if self.full else self.changed[entity]
        old = self.before(table)
        fresh = changes.lineage(self.silver(entity, moved), "_batch_date", month_column(entity))
        kept = fresh.limit(0) if old is None else old.where(~F.col("batch_date").isin(sorted(moved)))
        gone = set() if old is None else {r["month"] for r in old.where(F.col("batch_date").isin(sorted(moved))).select("month").distinct().collect()}
        held = self.put(table, kept.unionByName(fresh)) if moved or old is None else old
        self.days[entity] = {}
        touched = set(gone)
        for r in held.collect():                              # one row per batch date and month
            self.days[entity].setdefault(r["month"], set()).add(r["batch_date"])
            if r["batch_date"] in moved:
                touched.add(r["month"])
        used = changes.uses(self.rows_of(entity, touched), MEMBERS[entity], at, month_column(entity))
        self.replace(f"uses_{entity}", used, touched)
        return touched

    def uses(self, entity: str, kind: str) -> DataFrame:
        return self.now(f"uses_{entity}").where(F.col("kind") == kind)

    def used_customers(self, entity: str) -> DataFrame:
        """Uses of customers under their durable keys."""
        named = gold.with_durable_customer(self.uses(entity, "customer_id").withColumnRenamed("key", "customer_id"), self.mapping)
        return named.select("kind", F.col("customer_dk").alias("key"), "month", "first_use")

    def stubs(self, kind: str, out: str) -> DataFrame:
        return self.uses("transactions", kind).select(F.col("key").alias(out), F.col("first_use").alias("event_ts"))

    def months_of(self, used: DataFrame, kind: str, intervals: DataFrame) -> set[str]:
        return {r["month"] for r in changes.months_in_use(used, kind, intervals).collect()}

    def keyed(self, name: str):
        """Keys from the store of one dimension, grown by what it lacks."""
        table = f"keys_{name}"

        def make(versions: DataFrame, member: str, version: str, sk: str) -> DataFrame:
            versions = staged(versions)
            store = self.now(table) if table in self.commit.schemas else self.spark.createDataFrame([], keys.STORE)
            made = staged(keys.extend(store, keys.entries(versions, member, version)))
            if table not in self.commit.schemas or not made.isEmpty():
                self.commit.put(table, made, value=f"{self.commit.base.number + 1:012d}")
            return keys.with_keys(versions, self.now(table), member, version, sk)
        return make

    def dimension(self, name: str, member: str, sk: str, stale: bool, make) -> tuple[DataFrame, DataFrame | None]:
        """The dimension as it is now, and (key, low, high) of what it says anew; None if it was not computed."""
        table = f"dim_{name}"
        if not self.stale(table, stale):
            return self.now(table), None
        new = self.put(table, make(self.keyed(name)))
        old = self.before(table)
        return new, None if old is None else staged(changes.changed_intervals(old, new, member, sk))

    # -- steps ---------------------------------------------------------------------------------------
    def run(self) -> Version:
        silver, changed = self.silver, self.changed
        spent, held = self.relate("transactions"), self.relate("holdings")
        moved_keys = self.map_keys()
        customers, new_customers = self.dimension("customer", "customer_dk", "customer_sk", bool(changed["customers"] or spent),
            lambda k: gold.dim_customer(silver, self.mapping, gold.with_durable_customer(self.stubs("customer_id", "customer_id"), self.mapping), k))
        accounts, new_accounts = self.dimension("account", "account_id", "account_sk", bool(changed["accounts"] or spent),
            lambda k: gold.dim_account(silver, self.stubs("account_id", "account_id"), k))
        merchants, new_merchants = self.dimension("merchant", "merchant_id", "merchant_sk", bool(changed["merchants"] or spent),
            lambda k: gold.dim_merchant(silver, self.stubs("merchant_id", "merchant_id"), k))
        products, new_products = self.dimension("invest_product", "isin", "product_sk", bool(changed["invest_products"]),
            lambda k: gold.dim_invest_product(silver, keyed=k))
        billers, new_billers = self.billers()
        if not self.full:
            spent |= self.members("transactions", moved_keys, new_customers, account_id=new_accounts, merchant_id=new_merchants)
            spent |= self.rates()
            held |= self.members("holdings", moved_keys, new_customers, isin=new_products)
        elif self.stale("fx_daily"):
            self.put("fx_daily", gold.dense_rates(silver, self.until))
        billed = spent if new_billers is None else spent | self.months_of(self.now("uses_transactions"), "biller_id", new_billers)
        self.money(spent, billed, customers, accounts, merchants, billers)
        self.invest(held, customers, products)
        self.links(spent)
        people = bool(moved_keys or self.full or new_customers is not None and not new_customers.isEmpty())
        if self.stale("bridge_account_customer", people, new_accounts is not None, changed["account_holders"]):
            self.put("bridge_account_customer", gold.bridge_account_customer(silver, self.mapping, accounts, customers))
        if self.stale("fact_kyc_check", people, changed["kyc_checks"]):
            self.put("fact_kyc_check", gold.fact_kyc_check(silver, self.mapping, customers))
        if self.stale("fact_support_case", people, changed["support_cases"]):
            self.put("fact_support_case", gold.fact_support_case(silver, self.mapping, customers))
        scored = self.stale("fact_credit_score_snapshot", people, changed["credit_scores"])
        if scored:
            self.put("fact_credit_score_snapshot", gold.fact_credit_score_snapshot(silver, self.mapping, customers))
        if self.stale("mart_credit_features", scored, spent, billed):
            self.put("mart_credit_features", gold.mart_credit_features(
                self.now("fact_credit_score_snapshot"), self.now("lateness_monthly").drop("month"), self.now("flows_monthly").drop("month")))
        return self.commit.finish(silver=self.consumed, until=self.until, rebuilt=self.rebuilt)

    def map_keys(self) -> DataFrame | None:
        """Brings the map of durable keys up to date; customer ids that it maps otherwise than before."""
        if not self.stale("key_map", self.changed["customers"]):
            self.mapping = self.now("key_map")
            return None
        old, self.mapping = self.before("key_map"), self.put("key_map", self.silver.key_map())
        if old is None:
            return None
        moved = staged(changes.differing(old, self.mapping).select("key").distinct())
        return None if moved.isEmpty() else moved

    def members(self, entity: str, moved_keys: DataFrame | None, new_customers: DataFrame | None, **new) -> set[str]:
        """Months of a feed in which a member is used at a time that its dimension has changed for."""
        found: set[str] = set()
        if moved_keys is not None:
            found |= self.months_of(self.now(f"uses_{entity}"), "customer_id", always(moved_keys))
        if new_customers is not None:
            found |= self.months_of(self.used_customers(entity), "customer_id", new_customers)
        for kind, intervals in new.items():
            if intervals is not None:
                found |= self.months_of(self.now(f"uses_{entity}"), kind, intervals)
        return found

    def billers(self) -> tuple[DataFrame, DataFrame | None]:
        if not self.stale("dim_biller", self.changed["billers"]):
            return self.now("dim_biller"), None
        new = self.put("dim_biller", gold.dim_biller(self.silver))
        old = self.before("dim_biller")
        return new, None if old is None else staged(always(changes.differing(old, new).select(F.col("biller_id").alias("key")).distinct()))

    def rates(self) -> set[str]:
        """Months in which a currency is used that has another rate than before on one of their days."""
        if not self.stale("fx_daily", self.changed["fx_rates"], self.until_moved):
            return set()
        old, new = self.before("fx_daily"), self.put("fx_daily", gold.dense_rates(self.silver, self.until))
        days = changes.differing(old, new).select(F.col("currency").alias("key"), changes.month_of(F.col("rate_date")).alias("month"))
        met = self.uses("transactions", "currency").join(days.distinct(), ["key", "month"], "left_semi")
        return {r["month"] for r in met.select("month").distinct().collect()}

    def money(self, spent: set[str], billed: set[str], customers, accounts, merchants, billers) -> None:
        part = self.silver.only(transactions=self.rows_of("transactions", spent))
        self.replace("fact_transaction", gold.fact_transaction(part, self.mapping, customers, accounts, merchants, self.until), spent)
        fact = self.now("fact_transaction", spent)
        self.replace("mart_spend_monthly", gold.mart_spend_monthly(fact.drop("month"), merchants), spent)
        self.replace("flows_monthly", gold.monthly_flows(fact).withColumn("month", month_text("month_index")), spent)
        self.replace("profile_months", fact.select("month", *gold.PROFILE).distinct().withColumn(
            "txn_profile_sk", history.surrogate_key(*gold.PROFILE)), spent)
        if self.stale("dim_txn_profile", spent):
            self.put("dim_txn_profile", self.now("profile_months").drop("month").distinct())
        part = self.silver.only(transactions=self.rows_of("transactions", billed))
        self.replace("fact_bill_payment", gold.fact_bill_payment(part, self.mapping, customers, billers), billed)
        bills = self.now("fact_bill_payment", billed)
        self.replace("mart_bill_behaviour", gold.mart_bill_behaviour(bills.drop("month"), billers), billed)
        self.replace("lateness_monthly", gold.monthly_lateness(bills).withColumn("month", month_text("month_index")), billed)

    def invest(self, held: set[str], customers: DataFrame, products: DataFrame) -> None:
        part = self.silver.only(holdings=self.rows_of("holdings", held))
        self.replace("fact_holding_snapshot", gold.fact_holding_snapshot(part, self.mapping, customers, products), held)
        monthly = gold.monthly_holdings(self.now("fact_holding_snapshot", held).drop("month"), products)
        self.replace("holdings_monthly", monthly.withColumn("month", month_text("month_index")), held)
        if self.stale("mart_invest_features", held):
            self.put("mart_invest_features", gold.mart_invest_features(self.now("holdings_monthly").drop("month")))

    def links(self, spent: set[str]) -> None:
        """Refunds with what their original says of them (`refund_links`), of the given months and of months whose refunds
        name a transaction of a changed batch.

        Originals are looked for in these months, the months before them, and where they were found before. Refunds that
        are still without one and were not known to be so are looked up in all other months.
        """
        entity, months = "transactions", set(spent)
        if not self.full and self.changed[entity]:
            ids = self.silver(entity, self.changed[entity]).select("transaction_id").unionByName(
                self.silver_before(entity, self.changed[entity]).select("transaction_id")).distinct()
            named = self.uses(entity, "original_transaction_id").join(ids.withColumnRenamed("transaction_id", "key"), "key", "left_semi")
            months |= {r["month"] for r in named.select("month").distinct().collect()}
        known = None if self.full or "refund_links" not in self.commit.base.schemas else staged(self.now("refund_links", months))
        near = months | {month_before(m) for m in months}
        if known is not None:
            near |= {r[0] for r in known.where("original_month IS NOT NULL").select("original_month").distinct().collect()}
        rows = lambda some: gold.with_durable_customer(self.rows_of(entity, some), self.mapping).withColumn(
            "business_date", dates.local_date("event_ts"))
        originals = lambda some: rows(some).where("transaction_type = 'purchase' AND status = 'completed'")
        refunds = staged(rows(months).where("transaction_type = 'refund'"))
        linked = staged(link(refunds, originals(near)))
        lost = linked.where("verdict = 'pending'").select("transaction_id", "original_transaction_id")
        if known is not None:
            pending = known.where("verdict = 'pending'").select("transaction_id", "original_transaction_id")
            lost = lost.join(pending, ["transaction_id", "original_transaction_id"], "left_anti")
        far = set(self.days[entity]) - near
        if far and not lost.isEmpty():
            again = refunds.join(lost.select("transaction_id"), "transaction_id", "left_semi")
            linked = linked.join(lost.select("transaction_id"), "transaction_id", "left_anti").unionByName(link(again, originals(far)))
        self.replace("refund_links", linked, months)

    def silver_before(self, entity: str, days: Iterable[str]) -> DataFrame:
        return gold.replace(self.silver, versions={entity: self.older[entity]}, parts={})(entity, days)


def always(members: DataFrame) -> DataFrame:
    """(key, low, high) of members that count at any time."""
    return members.select("key", F.lit(ALWAYS).cast("timestamp").alias("low"), F.lit(changes.FAR).cast("timestamp").alias("high"))


def link(refunds: DataFrame, originals: DataFrame) -> DataFrame:
    judged = facts.linked_refunds(refunds, originals, "original_transaction_id", "transaction_id", "business_date",
                                  "business_date", MATCHED, "amount")
    found = F.when(F.col("age_days").isNotNull(), changes.month_of(F.date_sub("business_date", F.col("age_days"))))
    return judged.select("transaction_id", "original_transaction_id", "customer_dk", "amount", "currency", "business_date",
                         "age_days", "verdict", found.alias("original_month"))


def month_text(index: str) -> Column:
    """yyyy-MM of a month's number; rows without one have a month of their own."""
    year, month = F.floor(F.col(index) / 12), F.col(index) % 12 + 1
    return F.coalesce(F.when(F.col(index).isNotNull(), F.format_string("%04d-%02d", year, month)), F.lit("none"))


def month_before(month: str) -> str:
    if month == "none":
        return month
    year, number = map(int, month.split("-"))
    return f"{year - (number == 1):04d}-{(number - 2) % 12 + 1:02d}"
