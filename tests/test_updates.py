"""Runs that fail, batches that are rejected or late, keys that stay: Silver and Gold over several versions."""
from datetime import date

import bank
import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, keys
from millrace.plans import bronze_run, gold, gold_run, silver
from millrace.registry import BY_ENTITY, FEEDS
from millrace.sources import commits, files
from millrace.sources.tables import Lake
from millrace.streaming import bronze

TXN = BY_ENTITY["transactions"]
D = bank.DAYS
EARLY = [date(2026, 6, 1), date(2026, 7, 6), date(2026, 8, 3)]


def rows(df):
    return sorted(map(str, df.drop("_run_id").collect()))


def silver_state(spark, lake):
    return rows(silver.read_silver(spark, lake, TXN)), rows(silver.read_quarantine(spark, lake, TXN))


class Failing:
    """Raises at the n-th write of a log, data or commit."""

    def __init__(self, monkeypatch, at):
        self.left = at
        for owner, name in ((commits, "write_folder"), (files, "write_new")):
            monkeypatch.setattr(owner, name, self.wrapped(getattr(owner, name)))

    def wrapped(self, write):
        def run(*args):
            self.left -= 1
            if self.left < 0:
                raise OSError("disk gone")
            return write(*args)
        return run


def test_a_failure_at_any_write_changes_nothing_and_a_rerun_mends_it(spark, tmp_path, monkeypatch):
    """Key P7 stands in two days; the second day is delivered again without it while the build fails."""
    def lake_until_redelivery(name):
        lake = Lake(str(tmp_path / name))
        for k, day in enumerate(D[:2]):
            bank.deliver(lake.landing, "transactions", day, [bank.txn(day, 100 + k), bank.txn(D[0], 7, amount=f"{k + 1}.00"),
                                                             bank.txn(day, 50, amount="12,50")])
        bronze.ingest(spark, lake, TXN, "r")
        silver.build(spark, lake, TXN)
        again = bank.put_file(lake.landing, TXN, D[1], [bank.txn(D[1], 101), bank.txn(D[1], 51, status="nonsense")], part=2)
        bank.put_manifest(lake.landing, TXN, D[1], [again], [], record_count=2, delivery_attempt=2, supersedes=["part-0001.jsonl"])
        bronze.ingest(spark, lake, TXN, "r2")
        return lake

    lake = lake_until_redelivery("a")
    before = silver_state(spark, lake)
    for at in range(5):                                       # quarantine, landed, candidates, rows, the commit itself
        with monkeypatch.context() as m:
            Failing(m, at)
            with pytest.raises(OSError):
                silver.build(spark, lake, TXN, start=str(D[1]), end=str(D[1]))
        assert silver_state(spark, lake) == before
    silver.build(spark, lake, TXN, start=str(D[1]), end=str(D[1]))
    got = silver.read_silver(spark, lake, TXN).select("transaction_id", "amount", "_batch_date").collect()
    assert sorted((r[0], str(r[1]), r[2]) for r in got) == [("T20260914P100", "10.00", D[0]), ("T20260914P7", "1.00", D[0]),
                                                           ("T20260915P101", "10.00", D[1])]
    layers = {(r["_batch_date"], r["currency"]): r for r in silver.layers(spark, lake, TXN).collect()}
    whole = layers[D[0], "*"]
    assert [whole[c] for c in ("landed_rows", "quarantined_rows", "silver_rows", "duplicate_rows", "manifest_rows", "status")] == [3, 1, 2, 0, 3, "OK"]
    assert str(layers[D[0], "EUR"]["manifest_total"]) == str(layers[D[0], "EUR"]["landed_total"]) == "11.00"
    assert layers[D[1], "*"]["status"] == "OK" and layers[D[1], "EUR"]["status"] == "MISMATCH"    # announced without totals
    reasons = silver.read_quarantine(spark, lake, TXN).groupBy("reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"invalid_amount": 1, "status_domain": 1}      # by the contract alone


def test_a_batch_rejected_later_leaves_silver(spark, lake):
    for day in D[:2]:
        bank.deliver(lake.landing, "transactions", day, [bank.txn(day, 1), bank.txn(D[0], 9)])
    bronze.ingest(spark, lake, TXN, "r")
    silver.build(spark, lake, TXN)
    assert silver.read_silver(spark, lake, TXN).count() == 3
    verdicts = spark.createDataFrame([(D[0], True), (D[1], False)], "business_date date, accepted boolean")
    silver.build(spark, lake, TXN, verdicts=verdicts)
    got = {(r["transaction_id"], r["_batch_date"]) for r in silver.read_silver(spark, lake, TXN).collect()}
    assert got == {("T20260914P1", D[0]), ("T20260914P9", D[0])}


def test_two_runs_from_one_version_conflict_and_readers_keep_theirs(spark, tmp_path):
    log = commits.Log(spark, str(tmp_path / "log"))
    df = lambda *v: spark.createDataFrame([(x, y) for x, y in v], "n int, p string")
    one, two = log.begin(), log.begin()
    one.replace("t", df((1, "a"), (2, "b"), (3, None), (4, "x:y z")), "p")
    two.replace("t", df((9, "a")), "p")
    first = one.finish(by="one")
    with pytest.raises(commits.CommitConflict):
        two.finish()
    assert [r["n"] for r in log.read("t", log.current()).orderBy("n").collect()] == [1, 2, 3, 4]
    assert log.read("t", first, ["x:y z"]).first()["p"] == "x:y z"
    again = log.begin()
    again.replace("t", df((5, "a")), "p", touched=["a", "b"])
    again.put("whole", df((7, "q")))
    second = again.finish()
    assert second.changed(first, "t") == {"a", "b"} and log.current().notes == {}
    assert [r["n"] for r in log.read("t", first).orderBy("n").collect()] == [1, 2, 3, 4]
    assert [r["n"] for r in log.read("t", second).orderBy("n").collect()] == [3, 4, 5]
    assert log.read("t", second, ["nowhere"]).collect() == [] and log.read("whole", second).first()["n"] == 7
    assert log.vacuum(keep=1, older_than_hours=1) == []       # nothing is old yet
    removed = log.vacuum(keep=1, older_than_hours=-1)
    assert len(removed) == 1 and removed[0].startswith("t/")  # the write that never was committed
    assert [r["n"] for r in log.read("t", log.current()).orderBy("n").collect()] == [3, 4, 5]


def store_of(spark, *steps, draw=keys.hashed):
    store = spark.createDataFrame([], keys.STORE)
    for step in steps:
        wanted = spark.createDataFrame(step, "member string, version string, place bigint")
        store = store.unionByName(keys.extend(store, wanted, draw))
    return {(r["member"], r["version"]): r["sk"] for r in store.collect()}


def test_surrogate_keys_never_move(spark):
    """A member facts know first, its versions later, then an earlier change and a second stub."""
    got = store_of(spark, [("A", "", None)], [("A", "", None), ("B", "5", 5)],
                   [("A", "30", 30), ("A", "200", 200), ("B", "5", 5)], [("A", "4", 4), ("A", "30", 30), ("B", "", None)])
    assert set(got) == {("A", ""), ("A", "30"), ("A", "200"), ("A", "4"), ("B", "5")}
    assert got["A", "30"] == got["A", ""] and len(set(got.values())) == 4


def test_colliding_hashes_get_keys_of_their_own(spark):
    draw = lambda member, version, salt: F.lit(salt - 1).cast("bigint")  # noqa: E731 - the first is the unknown member's
    wanted = [(m, str(v), v) for m in "AB" for v in (1, 2)]
    got = store_of(spark, wanted[:3], wanted, draw=draw)
    assert len(set(got.values())) == 4 and -1 not in got.values()


def test_more_entries_than_keys_in_the_range_end(spark):
    asked = []

    def draw(member, version, salt):
        asked.append(salt)
        assert len(asked) < 80, "draws from a range that is full"
        return F.pmod(F.xxhash64(member, version, F.lit(salt)), F.lit(16))
    wanted = [(str(m), str(v), v) for m in range(10) for v in (1, 2, 3)]
    first = store_of(spark, wanted[:8], draw=draw)
    got = store_of(spark, wanted[:8], wanted, draw=draw)
    assert set(got) == {w[:2] for w in wanted} and len(set(got.values())) == 30 and -1 not in got.values()
    assert set(first.values()) < set(range(16)) and first.items() < got.items()


def test_a_crowded_range_takes_few_rounds(spark, monkeypatch):
    written, staged = [], keys.staged
    monkeypatch.setattr(keys, "staged", lambda df: (written.append(df.columns), staged(df))[1])
    draw = lambda member, version, salt: F.pmod(F.xxhash64(member, version, F.lit(salt)), F.lit(4096))
    got = store_of(spark, [(str(m), "1", 1) for m in range(3000)], draw=draw)
    assert len(set(got.values())) == len(got) == 3000 and 0 <= min(got.values()) <= max(got.values()) < 4096
    assert len(written) <= 9                                  # three, and one a round


def test_only_times_that_say_something_new_count(spark):
    def dim(*versions):
        return spark.createDataFrame(versions, "k string, sk bigint, valid_from string, valid_to string, row_hash bigint").select(
            "k", "sk", F.col("valid_from").cast("timestamp").alias("valid_from"), F.col("valid_to").cast("timestamp").alias("valid_to"), "row_hash")
    old = dim(("a", 1, "2026-01-10", "2026-03-01", 5), ("a", 2, "2026-03-01", None, 6), ("b", 3, "2026-01-01", None, 7))
    new = dim(("a", 1, "2026-01-05", "2026-03-01", 5), ("a", 2, "2026-03-01", "2026-05-01", 6), ("a", 4, "2026-05-01", None, 8),
              ("b", 3, "2026-01-01", None, 9))
    got = {(r["key"], str(r["low"])[:10], str(r["high"])[:10]) for r in changes.changed_intervals(old, new, "k", "sk").collect()}
    assert got == {("a", "2026-01-05", "2026-01-10"), ("a", "2026-05-01", "9999-12-31"), ("b", "2026-01-01", "9999-12-31")}


def redelivered(lake, entity, day, content):
    """A second attempt, whose file takes the place of the first one's."""
    feed = BY_ENTITY[entity]
    bank.put_manifest(lake.landing, feed, day, [bank.put_file(lake.landing, feed, day, content, part=2)], content,
                      delivery_attempt=2, supersedes=["part-0001.jsonl"])


def brought_in(spark, lake, entities):
    bronze_run.run(spark, lake, [BY_ENTITY[e] for e in entities], run_id="r", gate=False)
    for entity in entities:
        silver.build(spark, lake, BY_ENTITY[entity])


def test_an_update_equals_a_full_build_and_touches_only_what_changed(spark, lake):
    bank.master_data(lake.landing)
    for day in EARLY:
        bank.deliver(lake.landing, "transactions", day, [
            bank.txn(day, 1), bank.txn(day, 2, customer_id="C-2", account_id="A-2", merchant_id="M-2", currency="PLN"),
            bank.txn(day, 3, "bill_payment", due_date=str(day))])
    bank.all_transactions(lake.landing, D[:4])
    # Refunds of a June purchase that is there, and of a July purchase that is not yet.
    bank.deliver(lake.landing, "transactions", D[4], bank.transactions(D[4]) + [
        bank.txn(D[4], 31, "refund", merchant_id="M-1", original_transaction_id="T20260601P1", amount="1.00"),
        bank.txn(D[4], 32, "refund", merchant_id="M-1", original_transaction_id="T20260706P77", amount="1.00")])
    brought_in(spark, lake, [f.entity for f in FEEDS])
    first = gold_run.update(gold.Silver(spark, lake), str(D[-1]))
    assert set(first.tables["fact_transaction"]) == {"2026-06", "2026-07", "2026-08", "2026-09"}
    verdicts = lambda: {r["transaction_id"]: (r["verdict"], r["original_month"]) for r in gold_run.read(spark, lake, "refund_links").collect()}
    assert verdicts() == {"T20260918R31": ("look_back", "2026-06"), "T20260918R32": ("pending", None), "T20260916R5": ("ok", "2026-09")}

    # Nothing new: nothing is written but the note.
    same = gold_run.update(gold.Silver(spark, lake), str(D[-1]))
    assert same.tables == first.tables

    # July is delivered again with one more purchase, of a merchant nobody knows.
    day = EARLY[1]
    redelivered(lake, "transactions", day, [bank.txn(day, 1), bank.txn(day, 77, merchant_id="M-9"),
                                            bank.txn(day, 3, "bill_payment", due_date=str(day))])
    brought_in(spark, lake, ["transactions"])
    second = gold_run.update(gold.Silver(spark, lake), str(D[-1]))
    facts = lambda v: v.tables["fact_transaction"]
    assert second.notes["rebuilt"]["fact_transaction"] == ["2026-07"]
    assert {m for m in facts(first) if facts(first)[m] != facts(second)[m]} == {"2026-07"}
    assert second.notes["rebuilt"]["refund_links"] == ["2026-07", "2026-09"] and verdicts()["T20260918R32"] == ("look_back", "2026-07")
    read = gold_run.Update(gold.Silver(spark, lake), str(D[-1]))
    read.relate("transactions")
    scanned = read.rows_of("transactions", {"2026-07"}).inputFiles()
    assert scanned and all("_batch_date=2026-07-06" in f for f in scanned)

    # The unknown merchant's record comes, a change of C-1, another rate: keys stay, June is not looked at.
    stub = gold_run.read(spark, lake, "dim_merchant").where("merchant_id = 'M-9'").first()
    redelivered(lake, "merchants", D[5], [bank.merchant(D[5], 1, "M-9", category="Taxi")])
    redelivered(lake, "customers", D[5], [bank.customer(D[5], 7, "C-1", "U", segment="premium", change_ts="2026-09-17T00:00:00Z")])
    redelivered(lake, "fx_rates", D[1], [{"rate_date": str(D[1]), "base_currency": "EUR", "currency": "PLN", "rate": "5.0000", "source": "s"}])
    brought_in(spark, lake, ["merchants", "customers", "fx_rates"])
    third = gold_run.update(gold.Silver(spark, lake), str(D[-1]))
    known = gold_run.read(spark, lake, "dim_merchant").where("merchant_id = 'M-9'").first()
    assert stub["is_inferred"] and not known["is_inferred"] and known["merchant_sk"] == stub["merchant_sk"]
    assert "2026-06" not in third.notes["rebuilt"]["fact_transaction"]
    spend = gold_run.read(spark, lake, "mart_spend_monthly").where("month = '2026-07' AND category = 'Taxi'").count()
    assert spend == 1

    whole = gold_run.build(gold.Silver(spark, lake), str(D[-1]))
    assert set(whole.tables) == set(third.tables)
    for table in whole.tables:
        assert rows(gold_run.read(spark, lake, table, third)) == rows(gold_run.read(spark, lake, table, whole)), table


def test_verification_opens_each_file_once(spark, lake, monkeypatch):
    """The second run opens the new file alone, and its verdicts are those of a run that knows nothing."""
    opened = []
    digests = files.digests
    monkeypatch.setattr(files, "digests", lambda paths: (opened.extend(r["path"] for r in paths.collect()), digests(paths))[1])
    plain = lambda df: sorted(map(str, df.drop("total_differences").collect()))
    bank.all_transactions(lake.landing, D[:2])
    bronze.ingest(spark, lake, TXN, "r")
    assert all(r["accepted"] for r in bronze_run.verify_feed(spark, lake, TXN).collect()) and len(opened) == 2
    bank.deliver(lake.landing, "transactions", D[2], bank.transactions(D[2]), amount_totals={"EUR": "1.00"})
    bronze.ingest(spark, lake, TXN, "r2")
    opened.clear()
    got = bronze_run.verify_feed(spark, lake, TXN)
    assert {r["business_date"]: r["reason"] for r in got.collect()} == {D[0]: None, D[1]: None, D[2]: "control_total"}
    assert [p.rsplit("/", 2)[1] for p in opened] == ["16"]
    opened.clear()
    again = bronze_run.verify_feed(spark, lake, TXN, start=str(D[1]))
    assert {r["business_date"] for r in again.collect()} == {D[1], D[2]} and not opened
    monkeypatch.setattr(bronze_run, "state_log", lambda spark, lake, feed: commits.Log(spark, lake.path("ops", "elsewhere")))
    assert plain(bronze_run.verify_feed(spark, lake, TXN)) == plain(got) and len(opened) == 3
    # A file that is overwritten in place is opened again.
    bank.put_file(lake.landing, TXN, D[0], bank.transactions(D[0])[:1])
    opened.clear()
    changed = {r["business_date"]: r["reason"] for r in bronze_run.verify_feed(spark, lake, TXN).collect()}
    assert changed[D[0]] == "checksum" and len(opened) == 1
