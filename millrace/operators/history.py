"""Change records and snapshots to current rows, history and durable keys."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions.money import null_safe_hash
from millrace.operators.clean import winners
from millrace.operators.skew import MAX_GROUP_ROWS, OrderedGroups, salted_join
from millrace.session import materialize

UNKNOWN_SK = -1


class KeyCycleError(RuntimeError):
    """Key changes that lead back to themselves have no first or last id."""


def replay(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op",
           up_to: Column | None = None) -> DataFrame:
    """Rows alive after all changes, or after those for which `up_to` holds (a point in time)."""
    applied = changes if up_to is None else changes.filter(up_to)
    last = winners(applied, keys, [F.desc_nulls_last(c) for c in order])
    return last.filter(F.col(op) != "D")


def key_changes(changes: DataFrame, old: str, new: str, order: str) -> DataFrame:
    """(old_key, new_key, order) from the records that carry an old key; a repeat keeps the latest."""
    edges = changes.filter(F.col(old).isNotNull() & (F.col(old) != F.col(new))).select(
        F.col(old).alias("old_key"), F.col(new).alias("new_key"), order)
    return winners(edges, ["old_key"], [F.desc(order)])


def key_map(edges: DataFrame, old: str = "old_key", new: str = "new_key") -> DataFrame:
    """(key, latest_key, durable_key) for every id that takes part in a key change.

    Pointer doubling: each round joins the links with themselves and doubles the distance covered, so a chain
    of n changes needs log2(n) joins. Links to the latest and to the first id move in the same rounds, and
    every round is written to the shared folder.
    """
    ahead = edges.select(F.lit("latest").alias("way"), F.col(old).alias("id"), F.col(new).alias("to")).distinct()
    back = (edges.groupBy(F.col(new).alias("id")).agg(F.min(old).alias("to"))
            .select(F.lit("first").alias("way"), "id", "to"))
    links, covered = materialize(ahead.unionByName(back)), 1
    longest = links.count()  # a chain has no more links than there are
    while True:
        step = links.select("way", F.col("id").alias("at"), F.col("to").alias("next"))
        joined = materialize(
            salted_join(links.withColumn("at", F.col("to")), step, ["way", "at"], "left")
            .select("way", "id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        state = joined.agg(F.bool_or("moved").alias("moved"), F.bool_or(F.col("id") == F.col("to")).alias("closed")).first()
        if state["closed"] or state["moved"] and covered > longest:
            raise KeyCycleError("a key change leads back to its own start")
        links, covered = joined.drop("moved"), covered * 2
        if not state["moved"]:
            break
    side = lambda way, out: links.filter(F.col("way") == way).select(F.col("id").alias("key"), F.col("to").alias(out))
    return (side("latest", "latest_key").join(side("first", "durable_key"), "key", "full_outer")
            .select("key", F.coalesce("latest_key", "key").alias("latest_key"),
                    F.coalesce("durable_key", "key").alias("durable_key")))


def resolve_keys(df: DataFrame, mapping: DataFrame, key: str, out: str, which: str = "durable_key",
                 max_rows: int = MAX_GROUP_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Adds `out`: the durable (or latest) key, or the key itself where it never changed."""
    lookup = mapping.select(F.col("key").alias(key), F.col(which).alias("_mapped"))
    return (salted_join(df, lookup, [key], "left", hot=hot, max_rows=max_rows)
            .withColumn(out, F.coalesce("_mapped", key)).drop("_mapped"))


def scd2(changes: DataFrame, keys: Sequence[str], order: Sequence[str], change_ts: str,
         attributes: Sequence[str], op: str | None = None, carry: Sequence[str] = (),
         max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """History with half-open [valid_from, valid_to), is_current and row_hash.

    Versions follow `order`, never the clock. A version whose time is not before every later version's time
    would be empty and is left out; a version equal to its predecessor is no version. A delete closes the
    chain without opening a version. `carry` columns travel along without making versions.
    """
    deleted = (F.col(op) == "D") if op else F.lit(False)
    rows = changes.select(*dict.fromkeys([*keys, *order, change_ts, *attributes, *carry]),
                          deleted.alias("_deleted"))
    later = OrderedGroups(rows, keys, order, max_rows).running_extreme(
        "_next_min", F.col(change_ts), largest=False, backwards=True)
    effective = later.where(F.col("_next_min").isNull() | (F.col(change_ts) < F.col("_next_min")))
    effective.df = effective.df.drop("_next_min")

    effective.df = effective.df.withColumn("_same_as", F.struct(*attributes, "_deleted"))
    versions = effective.previous("_before", "_same_as")
    changed = F.col("_before").isNull() | ~F.col("_same_as").eqNullSafe(F.col("_before._same_as"))
    versions.where(changed)
    versions.df = versions.df.drop("_before", "_same_as")

    chained = versions.previous("_after", change_ts, following=True).result()
    return (chained.filter(~F.col("_deleted"))
            .select(*keys, *attributes, *[c for c in carry if c not in keys],
                    F.col(change_ts).alias("valid_from"), F.col(f"_after.{change_ts}").alias("valid_to"),
                    F.col("_after").isNull().alias("is_current"),
                    null_safe_hash(*attributes).alias("row_hash")))


def complete_snapshots(snapshots: DataFrame, day: str, verified: DataFrame | None = None) -> DataFrame:
    """Days whose snapshot may be trusted to imply deletes: those of accepted batches (all without verdicts).

    A snapshot's size decides nothing; `snapshot_drops` reports days that shrank.
    """
    days = snapshots.select(day).distinct()
    return days if verified is None else days.join(verified.select(day).distinct(), day, "left_semi")


def snapshot_drops(snapshots: DataFrame, days: DataFrame, day: str, share_pct: int = 50) -> DataFrame:
    """(day, rows, rows_before) of trusted days with less than `share_pct` of the trusted day before: for a person to
    look at. Works on one row per day."""
    counts = (snapshots.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
              .join(days.select(day).distinct(), day, "left_semi"))
    return (counts.withColumn("rows_before", F.lag("rows").over(W.orderBy(day)))
            .filter(F.col("rows") * 100 < F.col("rows_before") * share_pct))


def scd2_from_snapshots(snapshots: DataFrame, days: DataFrame, keys: Sequence[str], day: str,
                        attributes: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """History from full copies: a version ends when an attribute changes or the key is missing next time.

    `days` are the trusted snapshot dates; other snapshots are ignored, so a broken one deletes nothing.
    """
    # One row per snapshot date: the date after it.
    calendar = days.select(day).distinct().withColumn("_next_day", F.lead(day).over(W.orderBy(day)))
    rows = snapshots.select(*keys, day, *attributes).join(calendar, day)
    rows = rows.withColumn("_same_as", F.struct(*attributes))
    groups = OrderedGroups(rows, keys, [day], max_rows).previous("_before", "_same_as", "_next_day")
    starts = (F.col("_before").isNull() | ~F.col("_before._same_as").eqNullSafe(F.col("_same_as"))
              | (F.col("_before._next_day") != F.col(day)))
    # The gap before a reappearance ends the earlier version at the first date it was missing from.
    groups.df = groups.df.withColumn("_starts", starts).drop("_before", "_same_as")
    groups.running_sum("_version", F.when(F.col("_starts"), 1).otherwise(0))
    spans = (groups.result().groupBy(*keys, "_version")
             .agg(F.min(day).alias("valid_from"), F.max_by("_next_day", day).alias("valid_to"),
                  *[F.min_by(a, day).alias(a) for a in attributes]))
    return spans.select(*keys, *attributes, "valid_from", "valid_to",
                        F.col("valid_to").isNull().alias("is_current"),
                        null_safe_hash(*attributes).alias("row_hash"))


def latest_only(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Type 1: the newest row per key overwrites its predecessors."""
    return winners(rows, keys, [F.desc_nulls_last(c) for c in order])


def latest_with_activity(snapshots: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Type 1 from snapshots: newest row per key, `is_active` when the newest snapshot still has it."""
    newest = snapshots.agg(F.max(day).alias("_newest"))
    last = winners(snapshots, keys, [F.desc(day)]).withColumn("_newest", F.col(day))
    return (last.join(newest, "_newest", "left_semi").withColumn("is_active", F.lit(True))
            .unionByName(last.join(newest, "_newest", "left_anti").withColumn("is_active", F.lit(False)))
            .drop("_newest"))


def surrogate_key(*columns: str) -> Column:
    """Deterministic BIGINT: the same member gets the same key in every run, on every executor."""
    hashed = F.xxhash64(*columns)
    return F.when(hashed == UNKNOWN_SK, F.lit(0).cast("bigint")).otherwise(hashed)


def with_unknown_member(dim: DataFrame, sk: str, keys: Sequence[str]) -> DataFrame:
    """Adds the −1 row facts fall back to; descriptive columns stay NULL."""
    spark = dim.sparkSession
    values = {sk: F.lit(UNKNOWN_SK).cast("bigint"), **{k: F.lit("unknown").cast(dim.schema[k].dataType)
              if dim.schema[k].dataType.simpleString() == "string" else F.lit(None) for k in keys}}
    row = spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                                  for f in dim.schema.fields])
    return dim.unionByName(row)


def inferred_members(facts: DataFrame, dim: DataFrame, key: str, event_ts: str, valid_from: str = "valid_from",
                     hot: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """History completed for early facts, with is_inferred.

    A key facts use but the dimension lacks gets one open stub version from its first fact on. A key whose
    master record came after its first fact keeps that stub's valid_from on its first version: attributes
    are updated in place and the surrogate key stays the same.
    """
    first_use = (facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(event_ts).alias("_first_use")))
    first_version = dim.groupBy(key).agg(F.min(valid_from).alias("_first_version"))
    both = first_use.join(first_version, key, "full_outer")
    known = (dim.join(both.filter(F.col("_first_version").isNotNull()), key)
             .withColumn(valid_from, F.when(
                 (F.col(valid_from) == F.col("_first_version")) & (F.col("_first_use") < F.col(valid_from)),
                 F.col("_first_use")).otherwise(F.col(valid_from)))
             .drop("_first_use", "_first_version").withColumn("is_inferred", F.lit(False)))
    stubs = (both.filter(F.col("_first_version").isNull())
             .select(key, F.col("_first_use").alias(valid_from), F.lit(True).alias("is_inferred"),
                     *([F.lit(True).alias("is_current")] if "is_current" in dim.columns else [])))
    return known.unionByName(stubs, allowMissingColumns=True)


def primary_by_type(holders: DataFrame, accounts: DataFrame, account: str, customer: str,
                    types: Sequence[str], type_column: str = "account_type") -> DataFrame:
    """One column per account type: the customer's active primary account, the last id winning."""
    active = accounts.filter(F.col("status") == "active").select(account, type_column)
    owned = holders.filter(F.col("role") == "primary").join(active, account)
    return owned.groupBy(customer).pivot(type_column, list(types)).agg(F.max(account))

