"""Star schema: facts, junk dimension, bridge, snapshots."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators.history import UNKNOWN_SK, scd2, surrogate_key
from millrace.operators.lookups import version_lookup
from millrace.operators.skew import MAX_GROUP_ROWS, OrderedGroups, hot_keys, salted_join


def junk_dimension(facts: DataFrame, columns: Sequence[str], sk: str) -> DataFrame:
    """Distinct combinations of low-cardinality descriptors under a hashed key."""
    return facts.select(*columns).distinct().select(surrogate_key(*columns).alias(sk), *columns)


def versioned_dimension(history: DataFrame, durable: str, sk: str, valid_from: str = "valid_from") -> DataFrame:
    return history.withColumn(sk, surrogate_key(durable, valid_from))


def bridge(changes: DataFrame, keys: Sequence[str], order: Sequence[str], change_ts: str, attributes: Sequence[str],
           op: str = "op", max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Validity intervals of a many-to-many link: opened by I, closed by D, reopened by a later I."""
    return scd2(changes, keys, order, change_ts, attributes, op=op, max_rows=max_rows)


def dimension_keys(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], event_ts: str, **options) -> DataFrame:
    """Adds one surrogate key per (dimension, natural key, sk name), −1 for unknown or missing keys."""
    for dim, key, sk in dims:
        facts = version_lookup(facts, dim, [key], event_ts, sk, sk, **options)
    return facts


def current_key(facts: DataFrame, dim: DataFrame, key: str, sk: str, out: str | None = None,
                hot: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Surrogate key from a dimension with one row per key, −1 where there is none."""
    side = dim.select(key, F.col(sk).alias("_sk"))
    return (salted_join(facts, side, [key], "left", hot=hot, max_rows=max_rows)
            .withColumn(out or sk, F.coalesce("_sk", F.lit(UNKNOWN_SK).cast("bigint"))).drop("_sk"))


def accumulating_snapshot(rows: DataFrame, case: Sequence[str], order: Sequence[str], milestones: dict[str, Column],
                          latest: Sequence[str] = ()) -> DataFrame:
    """One row per case: the first time each milestone was reached, and the newest value of `latest`.

    milestone expressions give the timestamp where a row reaches it and NULL elsewhere.
    """
    newest = F.max_by(F.struct(*latest), F.struct(*order)).alias("_latest") if latest else None
    aggregated = rows.groupBy(*case).agg(*[F.min(expr).alias(name) for name, expr in milestones.items()],
                                         *([newest] if newest is not None else []))
    return aggregated.select(*case, *milestones, *[F.col(f"_latest.{c}").alias(c) for c in latest])


def resolution_hours(opened: Column | str, resolved: Column | str) -> Column:
    """Whole hours between opening and resolution; NULL while unresolved."""
    opened = F.col(opened) if isinstance(opened, str) else opened
    resolved = F.col(resolved) if isinstance(resolved, str) else resolved
    return F.timestamp_diff("HOUR", opened, resolved)


def bill_payments(transactions: DataFrame, business_date: str, due_date: str) -> DataFrame:
    """date keys and days_late of bill payments (negative when early)."""
    return (transactions.withColumn("date_key", dates.date_key(business_date))
            .withColumn("due_date_key", dates.date_key(due_date))
            .withColumn("days_late", dates.days_late(business_date, due_date)))


def linked_refunds(refunds: DataFrame, originals: DataFrame, link: str, identifier: str, refund_day: str,
                   original_day: str, same: Sequence[str], amount: str, look_back: tuple[int, int] = (1, 10),
                   hot: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Each refund with its original and a verdict: 'pending' while the original has not arrived,
    else the first broken rule ('look_back', 'different_<column>', 'amount'), else 'ok'.

    Originals are unique by id, so a refund meets one row at most.
    """
    side = originals.select(F.col(identifier).alias(link), F.col(original_day).alias("_day"),
                            F.col(amount).alias("_amount"), *[F.col(c).alias(f"_o_{c}") for c in same])
    joined = salted_join(refunds, side, [link], "left", hot=hot, max_rows=max_rows)
    age = F.datediff(refund_day, "_day")
    verdict = F.when(F.col("_day").isNull(), "pending").when(~age.between(*look_back), "look_back")
    for c in same:
        verdict = verdict.when(~F.col(c).eqNullSafe(F.col(f"_o_{c}")), f"different_{c}")
    verdict = verdict.when(F.col(amount) > F.col("_amount"), "amount").otherwise("ok")
    return (joined.withColumn("age_days", age).withColumn("verdict", verdict)
            .drop("_day", "_amount", *[f"_o_{c}" for c in same]))


def backed_changes(history: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, day: str,
                   checks: DataFrame, check_keys: Sequence[str], result: str, expected: Column,
                   max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Status changes with `backed`: a check of the same key and day whose result fits the new status.

    `checks` holds one row per check_keys (the same columns as in `history`); `expected` is a condition over
    the new status and the check's result.
    """
    groups = OrderedGroups(history, keys, order, max_rows).previous("_before", status)
    changed = (groups.result().withColumn("previous_status", F.col(f"_before.{status}")).drop("_before")
               .filter(F.col("previous_status").isNotNull() & ~F.col(status).eqNullSafe(F.col("previous_status"))))
    hot = hot_keys(history, list(check_keys), max_rows)
    return (salted_join(changed, checks.select(*check_keys, result), list(check_keys), "left", hot=hot, max_rows=max_rows)
            .withColumn("backed", F.coalesce(F.col(result).isNotNull() & expected, F.lit(False))))
