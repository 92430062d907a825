"""Surrogate keys that never move: a store of (member, version, sk) that only grows.

A version of a member is named by what opened it (the number of its change, the day of its snapshot), never by the moving
time it begins at. A member that only facts know has one open entry with the empty version; the first real version that
comes takes over its key, so facts keep theirs. New keys are hashes; where a hash is taken, by another entry of the store
or of the same run, it is drawn again with a salt, so no two entries share a key by chance. Hashes of a range that has no
room left for all are drawn from all 64 bits instead.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.history import UNKNOWN_SK
from millrace.sources.tables import staged

STORE = "member string, version string, sk bigint"
#: The version of a member that only facts know.
OPEN = ""

#: Keys that an entry draws in one round at most.
DRAWS = 32

Hash = Callable[[Column, Column, int], Column]


def hashed(member: Column, version: Column, salt: int) -> Column:
    return F.xxhash64(member, version, F.lit(salt)) if salt else F.xxhash64(member, version)


def entries(versions: DataFrame, member: str, version: str) -> DataFrame:
    """(member, version, place) of a dimension's rows: names as texts, and what orders a member's versions."""
    return versions.select(F.col(member).cast("string").alias("member"),
                           F.coalesce(F.col(version).cast("string"), F.lit(OPEN)).alias("version"),
                           F.col(version).alias("place"))


def takeovers(store: DataFrame, fresh: DataFrame) -> DataFrame:
    """Entries of the first fresh version of each member whose open key nobody has taken over."""
    is_open = F.col("version") == OPEN
    open_ = store.groupBy("member").agg(F.min(is_open).alias("alone"), F.min("sk").alias("sk")).where("alone")
    first = fresh.where(~is_open).groupBy("member").agg(F.min_by("version", "place").alias("version"))
    return first.join(open_.select("member", "sk"), "member").select("member", "version", "sk")


def draw_keys(pending: DataFrame, taken: DataFrame, draw: Hash, salts: range) -> DataFrame:
    """The entries of `pending`, each with the first key that it draws before all others and that is not `taken`, or NULL.

    Taken keys and draws meet in one shuffle: in the order of turns, the taken ones at 0, the first of a key has it.
    """
    draws = F.array(*[draw(F.col("member"), F.col("version"), salt) for salt in salts])
    drawn = pending.select("member", "version", F.posexplode(draws).alias("turn", "key")).withColumn("turn", F.col("turn") + 1)
    both = drawn.unionByName(taken.select(F.lit(0).alias("turn"), F.col("sk").alias("key")), allowMissingColumns=True)
    place = F.row_number().over(Window.partitionBy("key").orderBy("turn", "member", "version"))
    met = both.select("member", "version", "turn", F.when(place == 1, F.col("key")).alias("sk")).where("turn > 0")
    if len(salts) == 1:
        return met.drop("turn")
    won = F.when(F.col("sk").isNotNull(), F.col("turn"))
    return met.where("turn = 1 OR sk IS NOT NULL").groupBy("member", "version").agg(F.min_by("sk", won).alias("sk"))


def extend(store: DataFrame, wanted: DataFrame, draw: Hash = hashed) -> DataFrame:
    """The entries that `store` lacks for `wanted` (member, version, place), with their keys.

    Known entries go by an anti-join before anything is drawn, so a run pays for what is new. A member that has versions
    needs no open entry. Each round draws about as many keys as the first, so the fewer entries are left the more keys each
    of them draws. Once a round leaves more than a third of its entries without a key, the range of `draw` is too crowded or
    holds fewer keys than there are entries, and `hashed` draws for those left; so rounds are few whatever `draw` does.
    """
    is_open, found = F.col("version") == OPEN, F.col("sk").isNotNull()
    stubs = staged(wanted.where(is_open))
    known = store.where(~is_open).select("member").unionByName(wanted.where(~is_open).select("member")).join(
        stubs.select("member"), "member", "left_semi").distinct()
    named = wanted.where(~is_open).unionByName(stubs.join(known, "member", "left_anti"))
    fresh = staged(named.join(store.select("member", "version"), ["member", "version"], "left_anti")
                   .groupBy("member", "version").agg(F.min("place").alias("place")))
    part = staged(fresh.join(takeovers(store, fresh), ["member", "version"], "left").select("member", "version", "sk"))
    made, pending = part.where(found), part.where(~found)
    left = most = pending.count()
    salt = 0
    while left:
        salts = range(salt, salt + min(DRAWS, max(most, DRAWS) // left))
        taken = store.select("sk").unionByName(made.select("sk")).unionByName(
            store.sparkSession.range(1).select(F.lit(UNKNOWN_SK).cast("bigint").alias("sk")))
        part = staged(draw_keys(pending, taken, draw, salts))
        made, pending = made.unionByName(part.where(found)), part.where(~found)
        before, left, salt = left, pending.count(), salts.stop
        if 3 * left > before:
            draw, most = hashed, left
    return made


def with_keys(versions: DataFrame, store: DataFrame, member: str, version: str, sk: str) -> DataFrame:
    """Versions with their keys from a store that holds them all. A stub of a member that has versions meanwhile takes the
    key of the first of them that took over, which is its own."""
    named = versions.withColumn("_member", F.col(member).cast("string")).withColumn(
        "_version", F.coalesce(F.col(version).cast("string"), F.lit(OPEN)))
    side = store.select(F.col("member").alias("_member"), F.col("version").alias("_version"), F.col("sk").alias(sk))
    return named.join(side, ["_member", "_version"]).drop("_member", "_version")
