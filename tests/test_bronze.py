import json
import os
import time
from datetime import date, timedelta

import bank
import pytest
from pyspark.sql import functions as F

from millrace.operators import reconcile
from millrace.plans import bronze_run
from millrace.registry import ADDED_FIELDS, BY_ENTITY, DOMAINS, FEEDS, SOURCE_ORDER, contract_columns, feed_table
from millrace.sources import files, manifests, tables
from millrace.streaming import bronze

TXN = BY_ENTITY["transactions"]
D0, D1, D2 = bank.DAYS[:3]


def ingest(spark, lake, run="r", **options):
    bronze.ingest(spark, lake, TXN, run, **options)
    return bronze.read_bronze(spark, lake, TXN)


def reconciled(spark, lake):
    return {r["batch_date"]: r for r in bronze_run.reconcile_feeds(spark, lake, [TXN], "r").collect()}


def test_registry_is_complete_and_unique(spark):
    assert len(FEEDS) == 12 == len({f.under('') for f in FEEDS})
    assert {f.source for f in FEEDS} == set(SOURCE_ORDER)
    assert feed_table(spark).count() == 12
    assert all(set(f.keys) <= set(f.columns) for f in FEEDS)
    assert all(c in contract_columns(BY_ENTITY[e], "9") for e, cs in DOMAINS.items() for c in cs)
    assert "device_type" not in contract_columns(TXN, "1.0") and "device_type" in contract_columns(TXN, "1.1")
    assert set(ADDED_FIELDS) == {("transactions", "1.1")}
    assert BY_ENTITY["fx_rates"].under("/l/") == "/l/reference/fx_rates"


@pytest.mark.parametrize("path,expected", [
    ("file:/x/payments/transactions/2026/09/08/part-0001.jsonl", date(2026, 9, 8)),
    ("s3://b/2026/09/08/deeper/part-0001.jsonl", None), ("/x/part-0001.jsonl", None), ("/x/2026/13/40/p.jsonl", None)])
def test_batch_date_of_a_path(spark, path, expected):
    assert spark.createDataFrame([(path,)], "p string").select(bronze.batch_date("p").alias("d")).first()["d"] == expected


def test_everything_is_text_with_lineage(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, [bank.txn(D0, 1, amount=12.5, nested={"a": [1]})])
    row = ingest(spark, lake, "run-7").first()
    assert row["amount"] == "12.5" and row["nested"] == '{"a":[1]}' and row["merchant_id"] == "M-1" and row["biller_id"] is None
    assert row["_batch_date"] == D0 and row["_run_id"] == "run-7" and row["_source_file"].endswith("/2026/09/14/part-0001.jsonl")
    assert row["_raw"] is None and row["_rescued_data"] is None
    fields = dict(bronze.read_bronze(spark, lake, TXN).dtypes)
    assert all(fields[c] == "string" for c in TXN.columns)


def test_a_file_is_ingested_once(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    assert ingest(spark, lake).count() == 5
    assert ingest(spark, lake).count() == 5
    # A changed file under the same path is not read again; a new part is.
    bank.put_file(lake.landing, TXN, D0, bank.transactions(D0) * 2)
    assert ingest(spark, lake).count() == 5
    bank.put_file(lake.landing, TXN, D0, [bank.txn(D0, 50)], part=2)
    assert ingest(spark, lake).count() == 6


def test_an_old_file_delivered_late_is_read(spark, lake):
    bank.deliver(lake.landing, "transactions", D1, bank.transactions(D1))
    assert ingest(spark, lake).count() == 4
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    old = time.time() - 90 * 86400
    os.utime(os.path.join(bank.folder(lake.landing, TXN, D0), "part-0001.jsonl"), (old, old))
    assert ingest(spark, lake).count() == 9


def test_new_fields_become_columns_and_stay_known(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    ingest(spark, lake)
    bank.deliver(lake.landing, "transactions", D1, [bank.txn(D1, 1, device_type="ios"), bank.txn(D1, 2)])
    rows = ingest(spark, lake)
    assert rows.filter("device_type = 'ios'").count() == 1 and rows.filter("device_type is null").count() == 6
    bank.deliver(lake.landing, "transactions", D2, [bank.txn(D2, 1, device_type="android")])
    rows = ingest(spark, lake)
    assert rows.count() == 8 and rows.filter("device_type is not null").count() == 2
    assert rows.filter("_rescued_data is not null").count() == 0


def test_rescue_mode_keeps_unexpected_fields_as_json(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, [bank.txn(D0, 1, extra=None, other="x"), bank.txn(D0, 2)])
    rows = ingest(spark, lake, evolve="rescue")
    assert [json.loads(r[0]) for r in rows.filter("_rescued_data is not null").select("_rescued_data").collect()] == [
        {"extra": None, "other": "x"}]
    assert "other" not in rows.columns


def test_malformed_lines_are_visible_and_blank_lines_are_no_records(spark, lake):
    full = bank.to_line(bank.txn(D0, 1))
    bank.put_file(lake.landing, TXN, D0, [full, full[:40], "", "   ", "{}", "[1]", '"text"', bank.to_line(bank.txn(D0, 2))])
    rows = ingest(spark, lake)
    assert rows.count() == 6
    broken = rows.filter("_raw is not null")
    assert sorted(r["_raw"] for r in broken.collect()) == sorted([full[:40], "{}", "[1]", '"text"'])
    assert broken.filter(F.coalesce(*TXN.columns).isNotNull()).count() == 0


def test_hidden_folders_and_manifests_are_no_data(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    os.makedirs(f"{lake.landing}/payments/transactions/_late/2026/09/20")
    with open(f"{lake.landing}/payments/transactions/_late/2026/09/20/part-0001.jsonl", "w") as f:
        f.write(bank.to_line(bank.txn(D0, 9)) + "\n")
    assert ingest(spark, lake).count() == 5
    assert manifests.read_manifests(spark, lake.landing).count() == 1


def test_reconciliation_verdicts(spark, lake):
    root = lake.landing
    bank.deliver(root, "transactions", D0, bank.transactions(D0))
    bank.deliver(root, "transactions", D1, [])                                           # empty batch: 0 = 0
    rows = bank.transactions(D2)
    first = bank.put_file(root, TXN, D2, rows[:-1])                                      # truncated, stale manifest
    bank.put_manifest(root, TXN, D2, [{**first, "records": len(rows)}], rows)
    bank.put_file(root, TXN, bank.DAYS[3], rows)                                         # no manifest at all
    copies = [bank.put_file(root, TXN, bank.DAYS[4], rows, part) for part in (1, 2)]     # resent file
    bank.put_manifest(root, TXN, bank.DAYS[4], copies, rows + rows)
    ingest(spark, lake)
    got = {d: (r["manifest_records"], r["bronze_records"], r["unlisted_records"], r["status"]) for d, r in reconciled(spark, lake).items()}
    assert got == {D0: (5, 5, 0, "OK"), D1: (0, 0, 0, "OK"), D2: (5, 4, 0, "MISMATCH"),
                   bank.DAYS[3]: (0, 0, 5, "OK"), bank.DAYS[4]: (10, 10, 0, "OK")}
    read = manifests.read_manifests(spark, root, TXN)
    assert [r["batch_date"] for r in reconcile.without_manifest(bronze.read_bronze(spark, lake, TXN), read).collect()] == [bank.DAYS[3]]

    verdicts = {r["business_date"]: r["reason"] for r in bronze_run.verify_feed(spark, lake, TXN).collect()}
    assert verdicts == {D0: None, D1: None, D2: "file_count", bank.DAYS[4]: None}

    # Redelivery: a new part and a manifest that lists it alone.
    again = bank.put_file(root, TXN, D2, rows, part=2)
    bank.put_manifest(root, TXN, D2, [again], rows, delivery_attempt=2, supersedes=["part-0001.jsonl"])
    ingest(spark, lake)
    row = reconciled(spark, lake)[D2]
    assert (row["bronze_records"], row["unlisted_records"], row["status"]) == (5, 4, "OK")
    assert bronze_run.verify_feed(spark, lake, TXN).filter("not accepted").count() == 0


@pytest.mark.parametrize("spoil,reason", [
    (lambda m: m["files"][0].update(sha256="0" * 64), "checksum"),
    (lambda m: m["files"][0].update(name="part-0007.jsonl"), "missing_file"),
    (lambda m: m["amount_totals"].update(EUR="1.00"), "control_total"),
    (lambda m: m.update(record_count=99), "manifest_sum"),
    (lambda m: None, None)])
def test_whole_batch_is_rejected(spark, lake, spoil, reason):
    rows = bank.transactions(D0) + [bank.txn(D0, 9, amount="n/a"), "{cut"]
    bank.deliver(lake.landing, "transactions", D0, rows)
    path = os.path.join(bank.folder(lake.landing, TXN, D0), "_manifest.json")
    with open(path) as f:
        document = json.load(f)
    spoil(document)
    with open(path, "w") as f:
        json.dump(document, f)
    ingest(spark, lake)
    assert bronze_run.verify_feed(spark, lake, TXN).first()["reason"] == reason


def test_run_over_feeds_and_gate(spark, lake):
    bank.master_data(lake.landing)
    bank.all_transactions(lake.landing, bank.DAYS[:2])
    report = bronze_run.run(spark, lake, run_id="run-a")
    assert len(report.ingested) == 12 and not report.skipped and set(report.seconds) == set(report.ingested)
    stored = bronze_run.stored_results(spark, lake, "run-a")
    assert stored.filter("status <> 'OK'").count() == 0 and stored.select("entity").distinct().count() == 12
    batches = stored.count()
    bronze_run.run(spark, lake, run_id="run-a")            # the same run again replaces its rows
    assert bronze_run.stored_results(spark, lake).count() == batches
    bank.put_manifest(lake.landing, TXN, D0, [{"name": "part-0001.jsonl", "records": 9, "sha256": ""}], ["{}"] * 9)
    with pytest.raises(reconcile.ReconciliationError, match="1 of"):
        bronze_run.run(spark, lake, run_id="run-b")
    assert bronze_run.stored_results(spark, lake, "run-b").filter("status = 'MISMATCH'").count() == 1


def test_feeds_without_a_folder_are_skipped(spark, lake):
    bank.deliver(lake.landing, "merchants", D0, [])
    report = bronze_run.run(spark, lake, run_id="r")
    assert report.ingested == ["merchants"] and len(report.skipped) == 11


def test_duplicate_digests_and_manifest_sum(spark, lake):
    rows = bank.transactions(D0)
    bank.put_manifest(lake.landing, TXN, D0, [bank.put_file(lake.landing, TXN, D0, rows, p) for p in (1, 2)], rows + rows)
    read = manifests.read_manifests(spark, lake.landing, TXN)
    listing = manifests.manifest_listing(read)
    assert reconcile.duplicate_digests(listing, ["entity"]).first()["copies"] == 2
    assert reconcile.manifest_sum_check(read).first()["sum_matches"]
    paths = listing.select(F.concat_ws("/", "folder", "file_name").alias("path"))
    assert {r["sha256"] for r in files.digests(paths).collect()} == {r["sha256"] for r in listing.collect()}


def test_manifest_without_files_stays_visible(spark, lake):
    os.makedirs(bank.folder(lake.landing, TXN, D0))
    bank.put_manifest(lake.landing, TXN, D0, [], [])
    read = manifests.read_manifests(spark, lake.landing, TXN)
    assert [tuple(r) for r in manifests.manifest_rows(read).collect()] == [(D0, 0)]
    listing = manifests.manifest_listing(read)
    assert listing.count() == 1 and listing.first()["file_name"] is None


def test_completeness_by_cadence(spark, lake):
    from millrace.operators import calendar

    bank.master_data(lake.landing)
    read = manifests.read_manifests(spark, lake.landing)
    cal = calendar.calendar(spark, "2026-09-01", "2026-10-31")
    expected = reconcile.expected_batches(feed_table(spark), F.lit(bank.DAYS[0]), F.lit(bank.DAYS[-1]), cal)
    found = {(r["entity"], r["business_date"], r["finding"]) for r in reconcile.completeness(expected, read).collect()}
    gaps = {("transactions", d, "missing") for d in bank.DAYS}
    early = {(e, bank.DAYS[0], "unexpected") for e in ("kyc_checks", "support_cases")}
    assert found == gaps | early | {("credit_scores", date(2026, 10, 1), "unexpected")}


def test_ledger(spark):
    ledger = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    offered = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", "3")], "path string, sha256 string")
    assert sorted(r["path"] for r in reconcile.new_deliveries(offered, ledger).collect()) == ["b", "c"]
    assert [tuple(r) for r in reconcile.ledger_conflicts(offered, ledger).collect()] == [("b", "9", "2")]


def test_late_and_ordered_batches(spark):
    rows = [("payments", "t", D0, 3), ("payments", "t", D1, 1), ("payments", "t", D2, 2), ("_chaos", "t", D0, 1), ("crm", "c", D0, 1)]
    batches = spark.createDataFrame(rows, "source string, entity string, business_date date, arrival int")
    late = manifests.late_batches(batches.filter("source = 'payments'"), ["entity"], "business_date", "arrival")
    assert {r["business_date"]: r["is_late"] for r in late.collect()} == {D0: True, D1: False, D2: False}
    found = manifests.discover(batches, str(D0), str(D1)).collect()
    assert [(r["source"], r["business_date"]) for r in found] == [("payments", D0), ("crm", D0), ("payments", D1)]


def test_control_totals_rules(spark):
    rows = spark.createDataFrame([("1.005", "EUR"), ("1.00", "EUR"), ("n/a", "EUR"), (None, "EUR"), ("2", None), ("3", "EUX")], "a string, c string")
    got = {r["currency"]: str(r["total"]) for r in reconcile.control_totals(rows, [], "a", "c").collect()}
    assert got == {"EUR": "2.01", "None": "2.00", "EUX": "3.00"}
    assert {r["currency"] for r in reconcile.control_totals(rows, [], "a").collect()} == {"ALL"}


def test_append_run_and_namespaces(spark, lake):
    df = spark.range(3).withColumn("run_id", F.lit("x"))
    for _ in range(2):
        tables.append_run(df, lake.path("ops", "t"))
    tables.append_run(df.withColumn("extra", F.lit(1)).withColumn("run_id", F.lit("y")), lake.path("ops", "t"))
    stored = tables.read_table(spark, lake.path("ops", "t"))
    assert stored.count() == 6 and stored.filter("extra is null").count() == 3
    with pytest.raises(ValueError):
        lake.path("platinum")


def test_reconcile_reads_lineage_columns_only(spark, lake):
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    ingest(spark, lake)
    text = bronze_run.reconcile_feeds(spark, lake, [TXN], "r")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_source_file:string>" in text


def test_delivery_spreads_equal_lines_over_bounded_files(spark, lake):
    from millrace.sources import delivery

    rows = spark.range(1000).select(F.lit(D0).alias("business_date"), F.lit('{"a":1}').alias("line"), "id")
    written = delivery.write_files(rows, lake.landing, TXN.source, TXN.entity, rows_per_file=100, order="id").collect()
    assert sum(r["records"] for r in written) == 1000 and len(written) == 10 and max(r["records"] for r in written) < 200
    assert {r["file_name"] for r in written} == {f"part-00-{i:06d}.jsonl" for i in range(1, 11)}
    found = {r["path"]: r["sha256"] for r in files.digests(spark.createDataFrame([(r["path"],) for r in written], "path string")).collect()}
    assert found == {r["path"]: r["sha256"] for r in written}


def test_attempts_of_many_files_do_not_meet(spark, lake):
    from millrace.sources import delivery

    rows = spark.range(2400).select(F.lit(D0).alias("business_date"), F.concat(F.lit("{"), "id").alias("line"), "id")
    paths = set()
    for attempt in (0, 1):
        paths |= {r["path"] for r in delivery.write_files(rows, lake.landing, TXN.source, TXN.entity, attempt,
                                                          rows_per_file=2, order="id").collect()}
    assert spark.read.text(sorted(paths)[0].rsplit("/", 1)[0]).count() == 4800 and len(paths) > 2000


def test_all_new_fields_become_columns(spark, lake):
    extra = {f"extra_{i:04d}": i for i in range(2_300)}
    bank.deliver(lake.landing, "transactions", D0, [bank.txn(D0, 1, **extra), bank.txn(D0, 2)])
    rows = ingest(spark, lake)
    assert set(extra) <= set(rows.columns)
    assert rows.filter("_rescued_data is not null").count() == 0
    assert rows.filter("extra_2299 = '2299' and extra_0000 = '0'").count() == 1


def test_names_that_differ_in_case_and_odd_names(spark, lake):
    odd = {"a`b": 1, "a.b": 2, "a b": 3, 'q"uote': 4, "käse": 5, "x,y;z={}()": 6, "": 7, " ": 8, "_own": 9}
    first = [bank.txn(D0, 1, Ref="r1", ref="r2", **odd), bank.txn(D0, 2, ref="r3", AMOUNT="other")]
    bank.deliver(lake.landing, "transactions", D0, first)
    rows = ingest(spark, lake).orderBy("transaction_id").collect()
    bank.deliver(lake.landing, "transactions", D1, [bank.txn(D1, 3, REF="r4")])
    again = ingest(spark, lake).filter(F.col("_batch_date") == D1).first()
    assert [r["ref"] for r in rows] == ["r2", "r3"] and again["ref"] is None
    kept = [json.loads(r["_rescued_data"]) for r in rows]
    assert kept[0] == {"Ref": "r1", "": "7", " ": "8", "_own": "9"} and kept[1] == {"AMOUNT": "other"}
    assert json.loads(again["_rescued_data"]) == {"REF": "r4"}
    assert {k: rows[0][k] for k in list(odd)[:6]} == {k: str(v) for k, v in list(odd.items())[:6]}


def test_feeds_that_meet_new_fields_together(spark, lake):
    own = ["transactions", "customers", "accounts", "merchants"]
    for name in own:
        bank.deliver(lake.landing, name, D0, [{**{k: "1" for k in BY_ENTITY[name].keys}, f"new_{name}": "x"}])
    report = bronze_run.ingest_feeds(spark, lake, [BY_ENTITY[n] for n in own], parallel=4)
    assert sorted(report.ingested) == sorted(own)
    for name in own:
        assert bronze.read_bronze(spark, lake, BY_ENTITY[name]).first()[f"new_{name}"] == "x"


@pytest.mark.parametrize("text", ['{"source": "payments", "entity": "tran', "", "[]", "\udcff\udcfe"])
def test_a_manifest_that_cannot_be_read_is_no_match(spark, lake, text):
    bank.deliver(lake.landing, "transactions", D0, bank.transactions(D0))
    bank.deliver(lake.landing, "transactions", D1, bank.transactions(D1))
    with open(os.path.join(bank.folder(lake.landing, TXN, D0), "_manifest.json"), "wb") as f:
        f.write(text.encode("utf-8", "surrogateescape"))
    ingest(spark, lake)
    got = reconciled(spark, lake)
    assert (got[D0]["status"], got[D1]["status"]) == ("BAD_MANIFEST", "OK")
    with pytest.raises(reconcile.ReconciliationError):
        reconcile.enforce_gate(bronze_run.reconcile_feeds(spark, lake, [TXN], "r"))
