from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import clean, facts, history, quality

T0 = datetime(2026, 9, 1)
changes_lists = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30), st.sampled_from(["x", "y", None]),
                                   st.sampled_from("IUUD")), min_size=1, max_size=25)
slow = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def changes(spark, rows):
    data = [(k, i, T0 + timedelta(hours=h), v, op) for i, (k, h, v, op) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, seq bigint, ts timestamp_ntz, v string, op string")


@slow
@given(changes_lists)
def test_scd2_intervals_are_disjoint_and_end_in_the_replayed_state(spark, rows):
    df = changes(spark, rows)
    versions = history.scd2(df, ["k"], ["seq"], "ts", ["v"], op="op").collect()
    by_key = {}
    for r in sorted(versions, key=lambda r: (r["k"], r["valid_from"])):
        by_key.setdefault(r["k"], []).append(r)
    last = {}
    for i, (k, _, v, op) in enumerate(rows):
        last[k] = (v, op)
    for key, chain in by_key.items():
        for r in chain:
            assert r["valid_to"] is None or r["valid_from"] < r["valid_to"]
            assert r["is_current"] == (r["valid_to"] is None)
        for a, b in zip(chain, chain[1:]):
            assert a["valid_to"] is not None and a["valid_to"] <= b["valid_from"]
            assert a["v"] != b["v"] or a["valid_to"] < b["valid_from"]
    current = {r["k"]: r["v"] for r in versions if r["is_current"]}
    assert current == {k: v for k, (v, op) in last.items() if op != "D"}
    replayed = {r["k"]: r["v"] for r in history.replay(df, ["k"], ["seq"]).collect()}
    assert current == replayed


def test_scd2_drops_versions_a_later_change_overrides_in_time(spark):
    df = changes(spark, [("a", 10, "x", "I"), ("a", 12, "y", "U"), ("a", 9, "x", "U"), ("a", 20, "y", "U")])
    got = sorted((r["valid_from"].hour, r["v"]) for r in history.scd2(df, ["k"], ["seq"], "ts", ["v"]).collect())
    assert got == [(9, "x"), (20, "y")]


edges_lists = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=10).map(
    lambda pairs: {a: b for a, b in pairs if a < b}).filter(bool)


@slow
@given(edges_lists)
def test_key_map_follows_chains_of_any_length(spark, links):
    got = {r["key"]: r for r in history.key_map(spark.createDataFrame(list(links.items()), "old_key int, new_key int")).collect()}
    assert set(got) == set(links) | set(links.values())
    back = {}
    for old, new in links.items():
        back[new] = min(old, back.get(new, old))

    def follow(key, table):
        while key in table:
            key = table[key]
        return key
    for key, row in got.items():
        assert row["latest_key"] == follow(key, links) and row["durable_key"] == follow(key, back)


@pytest.mark.parametrize("n", [2, 3, 5])
def test_circular_key_changes_are_refused(spark, n):
    edges = spark.createDataFrame([(i, (i + 1) % n) for i in range(n)], "old_key int, new_key int")
    with pytest.raises(history.KeyCycleError):
        history.key_map(edges)


def test_key_changes_keep_the_latest_of_repeats(spark):
    df = spark.createDataFrame([(None, "c", 1), ("a", "b", 2), ("a", "b2", 3), ("a", "b2", 3)], "old string, new string, seq int")
    assert [tuple(r) for r in history.key_changes(df, "old", "new", "seq").collect()] == [("a", "b2", 3)]


def snapshots(spark, table):
    rows = [(date(2026, 9, d), k, v) for d, content in table.items() for k, v in content.items()]
    return spark.createDataFrame(rows, "d date, k string, v int")


def test_snapshot_history(spark):
    df = snapshots(spark, {1: {"a": 1, "b": 1}, 2: {"a": 1, "b": 2}, 4: {"a": 1}, 5: {"a": 1, "b": 2}, 6: {"a": 3, "b": 2}})
    days = history.complete_snapshots(df, "d")
    got = sorted((r["k"], r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day)
                 for r in history.scd2_from_snapshots(df, days, ["k"], "d", ["v"]).collect())
    assert got == [("a", 1, 1, 6), ("a", 3, 6, None), ("b", 1, 1, 2), ("b", 2, 2, 4), ("b", 2, 5, None)]


def test_a_broken_snapshot_deletes_nothing(spark):
    df = snapshots(spark, {1: {"a": 1, "b": 1, "c": 1}, 2: {"a": 1}, 3: {"a": 1, "b": 1, "c": 1}})
    verified = spark.createDataFrame([(date(2026, 9, 1),), (date(2026, 9, 3),)], "d date")
    days = history.complete_snapshots(df, "d", verified)
    got = [(r["k"], r["valid_to"]) for r in history.scd2_from_snapshots(df, days, ["k"], "d", ["v"]).collect()]
    assert sorted(got) == [("a", None), ("b", None), ("c", None)]
    assert days.count() == 2


def test_snapshot_size_decides_nothing_and_drops_are_reported(spark):
    full = {k: 1 for k in "abcd"}
    df = snapshots(spark, {1: full, 2: {"a": 1}, 3: {"a": 1}})
    every = history.complete_snapshots(df, "d")
    assert every.count() == 3
    assert [(r["d"].day, r["rows"], r["rows_before"]) for r in history.snapshot_drops(df, every, "d").collect()] == [(2, 1, 4)]
    rejected = spark.createDataFrame([(date(2026, 9, 1),), (date(2026, 9, 3),)], "d date")
    # Compared with the last trusted day: the rejected one in between does not make the third look whole.
    assert [r["d"].day for r in history.snapshot_drops(df, rejected, "d").collect()] == [3]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 200])
def test_a_long_chain_is_no_cycle(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "old_key int, new_key int")
    got = {r["key"]: (r["latest_key"], r["durable_key"]) for r in history.key_map(edges).collect()}
    assert got == {i: (n, 0) for i in range(n + 1)}


def test_inferred_member_is_updated_in_place(spark):
    used = spark.createDataFrame([("m1", 5), ("m1", 7), ("m2", 1), (None, 1)], "m string, at int")
    before = history.inferred_members(used, spark.createDataFrame([("m2", 0, None, True, "n")], "m string, valid_from int, valid_to int, is_current boolean, name string"), "m", "at")
    stub = before.filter("m = 'm1'").withColumn("sk", history.surrogate_key("m", "valid_from")).first()
    assert (stub["valid_from"], stub["is_inferred"], stub["is_current"], stub["name"]) == (5, True, True, None)
    master = spark.createDataFrame([("m2", 0, None, True, "n"), ("m1", 9, 12, False, "first"), ("m1", 12, None, True, "second")],
                                   "m string, valid_from int, valid_to int, is_current boolean, name string")
    after = history.inferred_members(used, master, "m", "at").withColumn("sk", history.surrogate_key("m", "valid_from"))
    rows = {(r["m"], r["valid_from"]): r for r in after.collect()}
    assert set(rows) == {("m1", 5), ("m1", 12), ("m2", 0)}
    first = rows[("m1", 5)]
    assert first["sk"] == stub["sk"] and first["name"] == "first" and not first["is_inferred"]


def test_unknown_member_and_type1(spark):
    dim = spark.createDataFrame([(1, "a", 2)], "sk bigint, name string, n int")
    rows = {r["sk"]: r for r in history.with_unknown_member(dim, "sk", ["name"]).collect()}
    assert rows[-1]["name"] == "unknown" and rows[-1]["n"] is None
    df = snapshots(spark, {1: {"a": 1, "b": 1}, 2: {"a": 2}})
    got = {r["k"]: (r["v"], r["is_active"]) for r in history.latest_with_activity(df, ["k"], "d").collect()}
    assert got == {"a": (2, True), "b": (1, False)}


def test_primary_accounts(spark):
    accounts = spark.createDataFrame([("1", "current", "active"), ("2", "current", "active"), ("3", "credit_card", "closed"), ("4", "credit_card", "active")],
                                     "account_id string, account_type string, status string")
    holders = spark.createDataFrame([("1", "c", "primary"), ("2", "c", "primary"), ("3", "c", "primary"), ("4", "c", "joint"), ("4", "d", "primary")],
                                    "account_id string, customer_id string, role string")
    got = {r["customer_id"]: (r["current"], r["credit_card"]) for r in history.primary_by_type(
        holders, accounts, "account_id", "customer_id", ["current", "credit_card"]).collect()}
    assert got == {"c": ("2", None), "d": (None, "4")}


def test_upsert_is_idempotent_and_keeps_newer_rows(spark):
    now = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "k int, v string, seq int")
    new = spark.createDataFrame([(1, "old", 4), (2, "c", 2), (3, "d", 1), (None, "x", 1)], "k int, v string, seq int")
    once = clean.upsert(now, new, ["k"], ["seq"])
    twice = clean.upsert(once, new, ["k"], ["seq"])
    expected = [(1, "a", 5), (2, "c", 2), (3, "d", 1)]
    assert sorted(map(tuple, once.collect())) == expected == sorted(map(tuple, twice.collect()))


def test_lifecycle_and_sequence_rules(spark):
    rows = spark.createDataFrame([("c1", 1, "opened"), ("c1", 2, "in_progress"), ("c1", 3, "resolved"), ("c2", 1, "in_progress"),
                                  ("c3", 1, "opened"), ("c3", 2, "resolved")], "c string, seq bigint, status string")
    allowed = {None: ["opened"], "opened": ["in_progress"], "in_progress": ["resolved"]}
    bad = quality.lifecycle_findings(rows, ["c"], ["seq"], "status", allowed)
    assert sorted((r["c"], r["previous_status"], r["status"]) for r in bad.collect()) == [("c2", None, "in_progress"), ("c3", "opened", "resolved")]
    arrivals = spark.createDataFrame([("f", 1, 10), ("f", 2, 12), ("f", 3, 11), ("f", 4, 12)], "f string, at int, seq bigint")
    assert sorted(r["at"] for r in quality.out_of_order(arrivals, ["f"], ["at"], "seq").collect()) == [3, 4]


def test_refund_verdicts(spark):
    originals = spark.createDataFrame([("p1", date(2026, 9, 1), 100, "m"), ("p2", date(2026, 9, 9), 100, "m")], "id string, day date, amount int, m string")
    refunds = spark.createDataFrame([("p1", date(2026, 9, 5), 50, "m"), ("p1", date(2026, 9, 20), 50, "m"), ("p1", date(2026, 9, 5), 500, "m"),
                                     ("p1", date(2026, 9, 5), 5, "other"), ("p9", date(2026, 9, 5), 5, "m"), ("p2", date(2026, 9, 9), 5, "m")],
                                    "link string, day date, amount int, m string")
    got = facts.linked_refunds(refunds, originals, "link", "id", "day", "day", ["m"], "amount")
    assert sorted(r["verdict"] for r in got.collect()) == ["amount", "different_m", "look_back", "look_back", "ok", "pending"]


def test_null_rates_and_drift(spark):
    rows = [(date(2026, 11, d), "m" if d < 9 else None) for d in range(1, 12) for _ in range(4)]
    df = spark.createDataFrame(rows, "d date, merchant_id string")
    alerts = quality.null_rate_alerts(quality.null_rates(df, ["d"], ["merchant_id"]), "d")
    assert [r["d"].day for r in alerts.orderBy("d").collect()] == [9, 10, 11]
    seen = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", "z")], "v string, field string")
    got = sorted(map(tuple, quality.schema_drift(seen, ["a", "b"], ["v"]).collect()))
    assert got == [("2", "b", "missing"), ("2", "z", "unexpected")]


def test_backed_changes_by_previous_status(spark):
    rows = [("c", 1, "pending", 1), ("c", 2, "verified", 2), ("c", 3, "expired", 3), ("c", 4, "expired", 4)]
    hist = spark.createDataFrame(rows, "c string, seq bigint, status string, d int")
    checks = spark.createDataFrame([("c", 2, "pass"), ("c", 4, "fail")], "c string, d int, result string")
    expected = (F.col("status") == "verified") == (F.col("result") == "pass")
    got = facts.backed_changes(hist, ["c"], ["seq"], "status", "d", checks, ["c", "d"], "result", expected)
    assert sorted((r["seq"], r["backed"]) for r in got.collect()) == [(2, True), (3, False)]
