"""The faults a landing area sees, from JSON lines to Gold."""
from datetime import date, datetime
from decimal import Decimal

import bank
import pytest
from pyspark.sql import functions as F

from millrace.operators import facts, quality
from millrace.plans import bank_checks, bronze_run, gold, gold_run, silver
from millrace.registry import BY_ENTITY, DOMAINS, FEEDS
from millrace.sources.tables import Lake
from millrace.streaming import bronze

TXN = BY_ENTITY["transactions"]
D = bank.DAYS


def rules(feed=TXN):
    return quality.transaction_rules(DOMAINS["transactions"]["currency"], TXN.columns) if feed is TXN else ()


def to_silver(spark, lake, **options):
    bronze.ingest(spark, lake, TXN, "r")
    silver.build(spark, lake, TXN, rules(), **options)
    return silver.read_silver(spark, lake, TXN)


def reasons(spark, lake):
    return {r["reason"]: r["n"] for r in silver.read_quarantine(spark, lake, TXN).groupBy("reason").agg(F.count("*").alias("n")).collect()}


def test_bad_records_are_quarantined_by_the_first_failing_rule(spark, lake):
    day = D[0]
    cut = bank.to_line(bank.txn(day, 90))[:60]
    bad = [cut, cut, cut,
           bank.txn(day, 10, amount="12,50"), bank.txn(day, 11, amount="7,20"), bank.txn(day, 12, amount="n/a", currency="EUX"),
           bank.txn(day, 13, event_ts="14/09/2026 06:24"),
           bank.txn(day, 14, transaction_id=None), bank.txn(day, 15, transaction_id=None),
           bank.txn(day, 16, currency="EUX"), bank.txn(day, 17, amount="-8.32"), bank.txn(day, 18, event_ts="2027-01-01T00:00:00Z"),
           bank.txn(day, 19, "bill_payment", biller_id=None)]
    good = bank.transactions(day)
    bank.deliver(lake.landing, "transactions", day, good + bad)
    rows = to_silver(spark, lake)
    assert rows.count() == len(good)
    assert reasons(spark, lake) == {"malformed_record": 3, "invalid_amount": 3, "invalid_event_ts": 1, "missing_transaction_id": 2,
                                    "invalid_currency": 1, "negative_amount": 1, "future_event_ts": 1, "bill_without_biller": 1}
    quarantined = silver.read_quarantine(spark, lake, TXN)
    assert {r["_raw"] for r in quarantined.filter("reason = 'malformed_record'").collect()} == {cut}
    assert quarantined.filter("_source_file is null").count() == 0
    types = dict(rows.dtypes)
    assert (types["amount"], types["event_ts"], types["due_date"]) == ("decimal(18,2)", "timestamp", "date")


def test_duplicates_resent_files_and_rejected_batches(spark, lake):
    root = lake.landing
    rows = bank.transactions(D[0])
    bank.deliver(root, "transactions", D[0], rows + rows[:3])                                       # repeats in one file
    bank.put_manifest(root, TXN, D[1], [bank.put_file(root, TXN, D[1], bank.transactions(D[1]), p) for p in (1, 2)],
                      bank.transactions(D[1]) * 2)                                                  # file sent twice
    whole = bank.transactions(D[2])
    sent = [bank.to_line(r) for r in whole[:-2]] + [bank.to_line(whole[-2])[:50]]
    bank.put_manifest(root, TXN, D[2], [{**bank.put_file(root, TXN, D[2], sent), "records": len(whole)}], whole)
    bronze.ingest(spark, lake, TXN, "r")
    verdicts = bronze_run.verify_feed(spark, lake, TXN)
    assert {r["business_date"]: r["accepted"] for r in verdicts.collect()} == {D[0]: True, D[1]: True, D[2]: False}
    got = to_silver(spark, lake, verdicts=verdicts).groupBy("_batch_date").count()
    assert {r[0]: r[1] for r in got.collect()} == {D[0]: 5, D[1]: 4}

    # Loaded without the check, the cut line shows up as quarantined ...
    to_silver(spark, lake)
    assert reasons(spark, lake) == {"malformed_record": 1}
    # ... and is gone once the redelivered file is the one the manifest lists.
    again = bank.put_file(root, TXN, D[2], whole, part=2)
    bank.put_manifest(root, TXN, D[2], [again], whole, delivery_attempt=2, supersedes=["part-0001.jsonl"])
    got = to_silver(spark, lake, start=str(D[2]), end=str(D[2])).groupBy("_batch_date").count()
    assert {r[0]: r[1] for r in got.collect()} == {D[0]: 5, D[1]: 4, D[2]: 5}
    assert silver.read_quarantine(spark, lake, TXN).count() == 0


def test_schema_changes(spark, lake):
    day = D[0]
    bank.deliver(lake.landing, "transactions", day, [bank.txn(day, 1)])
    to_silver(spark, lake)
    renamed = {k: v for k, v in bank.txn(D[1], 1).items() if k != "merchant_id"}
    bank.deliver(lake.landing, "transactions", D[1], [
        {**renamed, "merchant_ref": "M-1"}, bank.txn(D[1], 2, device_type="ios"),
        bank.txn(D[1], 3, "bill_payment", due_date=f"{D[0]}T21:00:00Z")])          # local midnight of D[1]
    rows = to_silver(spark, lake)
    assert "device_type" not in rows.columns and rows.filter("merchant_id = 'M-1'").count() == 3
    assert rows.filter("due_date is not null").first()["due_date"] == D[1]
    approved = to_silver(spark, lake, version="1.1") and silver.read_silver(spark, lake, TXN, "1.1")
    assert approved.filter("device_type = 'ios'").count() == 1 and approved.count() == 4


def whole_bank(spark, lake, order=None, spoil=None):
    """Everything delivered day by day in the given order of transaction days, then built."""
    bank.master_data(lake.landing)
    if spoil:
        spoil(lake.landing)
    days = order or D
    for chunk in ([days] if order is None else [days[:5], days[5:]]):
        bank.all_transactions(lake.landing, chunk)
        bronze_run.run(spark, lake, run_id="r", gate=False)
    for feed in FEEDS:
        silver.build(spark, lake, feed, rules(feed))
    gold_run.build(gold.Silver(spark, lake), str(D[-1]))
    return lambda name: gold_run.read(spark, lake, name)


@pytest.fixture(scope="module")
def built_lake(tmp_path_factory):
    return Lake(str(tmp_path_factory.mktemp("bank") / "lake"))


@pytest.fixture(scope="module")
def built(spark, built_lake):
    return whole_bank(spark, built_lake)


def test_clean_bank_passes_its_checks(spark, built_lake, built):
    got = {r["rule"]: r for r in bank_checks.run(gold.Silver(spark, built_lake), "r1").collect()}
    assert len(got) > 40
    failed = {rule: r["rows_failed"] for rule, r in got.items() if r["rows_failed"]}
    # From the 16th on C-2's purchases should carry the new id; the position in X2 is above a low rating's limit;
    # the salary account's phone is fine, and the removed biller is used by nobody.
    assert failed == {"old_customer_id": 7, "suitability_warning": 7}
    assert all(r["rows_checked"] > 0 for rule, r in got.items()
               if rule not in ("kyc_change_unbacked", "new_customer_without_account"))


def test_customer_history_follows_the_key_change(built):
    dim = built("dim_customer")
    chain = dim.filter("customer_dk = 'C-2'").orderBy("valid_from").collect()
    assert len(chain) == 1 and chain[0]["is_current"]          # the new id changes no attribute, so it is no version
    moved = dim.filter("customer_dk = 'C-1'").orderBy("valid_from").collect()
    assert [r["segment"] for r in moved] == ["mass", "affluent"] and moved[0]["valid_to"] == moved[1]["valid_from"]
    assert dim.filter("customer_dk = 'C-9'").count() == 0
    assert not {"first_name", "email", "phone"} & set(dim.columns)
    assert dim.select("customer_sk").distinct().count() == dim.count()


def test_transaction_fact(built):
    fact = built("fact_transaction")
    assert fact.count() == 9 * 4 + 2 and fact.filter("customer_sk = -1 or account_sk = -1").count() == 0
    assert fact.filter("merchant_sk = -1").select("transaction_type").distinct().count() == 2      # bills and salary have none
    pln = {r["business_date"]: r for r in fact.filter("currency = 'PLN'").collect()}
    assert pln[D[0]]["fx_rate"] == Decimal("4.3000") and pln[D[0]]["amount_eur"] == Decimal("10.00")
    friday = D[4]
    assert pln[D[5]]["fx_rate"] == pln[D[6]]["fx_rate"] == pln[friday]["fx_rate"] == Decimal("4.3400")   # weekend
    assert pln[D[7]]["fx_rate"] == Decimal("4.3700")
    old = fact.filter("customer_dk = 'C-2'")
    assert old.count() == 9 and old.select("customer_sk").distinct().count() == 1
    c1 = fact.filter("customer_dk = 'C-1'").join(built("dim_customer").select("customer_sk", "segment"), "customer_sk")
    assert c1.filter(F.col("business_date") == F.lit(D[0])).select("segment").distinct().first()[0] == "mass"
    assert c1.filter(F.col("business_date") == F.lit(D[1])).select("segment").distinct().first()[0] == "affluent"


def test_other_facts(built):
    bills = built("fact_bill_payment")
    assert bills.count() == 9 and bills.select("days_late").distinct().first()[0] == 2 and bills.filter("biller_sk = -1").count() == 0
    case = built("fact_support_case").first()
    assert (case["case_id"], case["status"], case["customer_dk"]) == ("CS-1", "resolved", "C-2")
    assert (case["opened_date_key"], case["resolved_date_key"], case["resolution_hours"]) == (20260915, 20260918, 72)
    holdings = built("fact_holding_snapshot")
    assert holdings.count() == 7 * 2 and holdings.filter("product_sk = -1 or customer_sk = -1").count() == 0
    assert built("fact_kyc_check").first()["date_key"] == 20260915
    scores = {r["customer_dk"]: r["score"] for r in built("fact_credit_score_snapshot").collect()}
    assert scores == {"C-1": 700, "C-2": 820}


def test_dimensions(built):
    product = built("dim_invest_product").filter("isin = 'X2'").orderBy("valid_from").collect()
    assert [(r["risk_level"], r["valid_from"], r["valid_to"]) for r in product] == [(6, D[0], D[4]), (7, D[4], None)]
    billers = {r["biller_id"]: r["is_active"] for r in built("dim_biller").collect()}
    assert billers == {"B-1": True, "B-2": False}
    links = built("bridge_account_customer")
    assert {(r["account_id"], r["customer_dk"]) for r in links.filter("is_current").collect()} == {("A-1", "C-1"), ("A-2", "C-2")}
    assert built("dim_txn_profile").count() == built("fact_transaction").select("txn_profile_sk").distinct().count()


def test_marts(built):
    spend = {(r["customer_dk"], r["category"]): r for r in built("mart_spend_monthly").collect()}
    groceries = spend[("C-1", "Groceries")]
    assert (groceries["spend"], groceries["refunds"], groceries["net"]) == (Decimal("90.00"), Decimal("4.00"), Decimal("86.00"))
    assert (groceries["txn_count"], groceries["declined_count"]) == (9, 9)
    bills = built("mart_bill_behaviour").first()
    assert (bills["n_bills"], bills["on_time_per_mille"], bills["max_days_late"], bills["avg_days_late"]) == (9, 0, 2, Decimal("2.0000"))
    credit = {r["customer_dk"]: r for r in built("mart_credit_features").collect()}
    assert (credit["C-1"]["dpd_max"], credit["C-1"]["income"], credit["C-1"]["spend_to_income_pct"]) == (2, Decimal("1000.00"), 9)
    invest = {r["asset_class"]: r for r in built("mart_invest_features").collect()}
    assert (invest["bond_fund"]["value"], invest["etf"]["value"], invest["etf"]["max_risk_level"]) == (Decimal("280.00"), Decimal("50.00"), 7)
    assert invest["bond_fund"]["total_value"] == Decimal("330.00") and invest["bond_fund"]["n_products"] == 2


def test_out_of_order_delivery_and_late_dimensions_converge(spark, built, tmp_path):
    """Days arrive shuffled and a refund before its purchase; the Gold tables are those of in-order delivery."""
    shuffled = [D[2], D[1], D[4], D[3], D[8], D[0], D[5], D[7], D[6]]
    other = whole_bank(spark, Lake(str(tmp_path / "lake")), order=shuffled)
    for name in ("fact_transaction", "fact_bill_payment", "dim_customer", "mart_spend_monthly", "mart_credit_features"):
        drop = [c for c in ("_source_file",) if c in built(name).columns]
        assert sorted(map(str, other(name).drop(*drop).collect())) == sorted(map(str, built(name).drop(*drop).collect())), name


def test_late_dimension_and_old_key(spark, lake):
    """A merchant used before its master record, and a fact under a replaced customer id."""
    def spoil(root):
        bank.deliver(root, "transactions", D[3], bank.transactions(D[3]) + [
            bank.txn(D[3], 20, merchant_id="M-90001"), bank.txn(D[3], 21, customer_id="C-2", account_id="A-2")])
        bank.deliver(root, "merchants", D[5], [bank.merchant(D[5], 1, "M-90001", category="Taxi")])
    bank.master_data(lake.landing)
    bank.all_transactions(lake.landing, [D[0]])
    spoil(lake.landing)
    feeds = [BY_ENTITY[e] for e in ("customers", "accounts", "merchants", "fx_rates", "transactions")]
    bronze_run.run(spark, lake, feeds, run_id="r")
    for feed in feeds:
        silver.build(spark, lake, feed, rules(feed))
    read = gold.Silver(spark, lake)
    facts_as_of = read("transactions").select("merchant_id", "_batch_date", "transaction_id")
    master = read("merchants").withColumnRenamed("_batch_date", "first_seen")
    orphans = quality.orphans_as_of(facts_as_of, master, "merchant_id", "_batch_date", "first_seen")
    assert orphans.filter("orphan_now").count() == 0 and orphans.filter("orphan_as_of").count() == 1
    mapping = read.key_map()
    merchants = gold.dim_merchant(read, read("transactions").select("merchant_id", "event_ts"))
    late = merchants.filter("merchant_id = 'M-90001'").collect()
    assert len(late) == 1 and not late[0]["is_inferred"] and late[0]["category"] == "Taxi"
    assert late[0]["valid_from"] == read("transactions").filter("merchant_id = 'M-90001'").first()["event_ts"]
    fact = gold.fact_transaction(read, mapping, gold.dim_customer(read, mapping), gold.dim_account(read), merchants, str(D[-1]))
    assert fact.filter("merchant_id = 'M-90001' and merchant_sk = -1").count() == 0
    assert fact.filter("transaction_id like '%P21'").first()["customer_dk"] == "C-2"


def test_refunds_stay_pending_until_the_original_arrives(spark, lake):
    bank.deliver(lake.landing, "transactions", D[2], bank.transactions(D[2]))
    columns = ["account_id", "currency", "merchant_id", "payment_method"]

    def verdict():
        rows = to_silver(spark, lake)
        return facts.linked_refunds(rows.filter("transaction_type = 'refund'"), rows.filter("transaction_type = 'purchase' and status = 'completed'"),
                                    "original_transaction_id", "transaction_id", "_batch_date", "_batch_date", columns, "amount").first()["verdict"]
    assert verdict() == "pending"
    bank.deliver(lake.landing, "transactions", D[0], bank.transactions(D[0]))
    assert verdict() == "ok"


def test_date_dimension(spark):
    days = {r["date"]: r for r in gold.dim_date(spark, "2026-12-20", "2027-01-05").collect()}
    assert len(days) == 17 and days[date(2026, 12, 25)]["is_weekend"] is False and not days[date(2026, 12, 25)]["is_business_day"]
    assert days[date(2026, 12, 31)]["is_last_business_day"] and days[date(2027, 1, 4)]["is_first_business_day"]
    assert days[date(2026, 12, 31)]["date_key"] == 20261231 and days[date(2026, 12, 31)]["quarter"] == 4


def test_resolution_hours(spark):
    df = spark.createDataFrame([(datetime(2026, 9, 1, 8), datetime(2026, 9, 2, 9, 59)), (datetime(2026, 9, 1, 8), None)], "o timestamp, r timestamp")
    assert [r[0] for r in df.select(facts.resolution_hours("o", "r")).collect()] == [25, None]


@pytest.mark.parametrize("slices", [[(0, 2)], [(0, 0), (1, 1), (2, 2)], [(2, 2), (0, 0), (1, 1)], [(1, 2), (0, 0)], [(0, 1), (2, 2), (0, 2), (1, 1)]])
def test_silver_does_not_depend_on_how_dates_are_dealt_to_calls(spark, lake, slices):
    """Keys come back in later batches; a corrected batch takes one away again."""
    for k, day in enumerate(D[:3]):
        bank.deliver(lake.landing, "transactions", day, [bank.txn(day, 100 + k), bank.txn(D[0], 7, amount=f"{k + 1}.00"),
                                                         bank.txn(D[0], 8 + k // 2, amount="5.00")])
    bronze.ingest(spark, lake, TXN, "r")
    for a, b in slices:
        silver.build(spark, lake, TXN, rules(), start=str(D[a]), end=str(D[b]))
    rows = silver.read_silver(spark, lake, TXN).collect()
    got = sorted((r["transaction_id"], r["_batch_date"], r["amount"]) for r in rows)
    assert len({g[0] for g in got}) == len(got) == 6
    assert {g[0] for g in got} == {bank.txn(D[0], n)["transaction_id"] for n in (7, 8, 9)} | {
        bank.txn(day, 100 + k)["transaction_id"] for k, day in enumerate(D[:3])}
    assert {g[1] for g in got if g[0] == bank.txn(D[0], 7)["transaction_id"]} == {D[2]}  # the last file wins
