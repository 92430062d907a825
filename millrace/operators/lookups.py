"""Looking values up as of a moment: rates by date, dimension versions by event time."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.history import UNKNOWN_SK
from millrace.operators.skew import MAX_GROUP_ROWS, OrderedGroups

BROADCAST_ROWS = 500_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most max_rows + 1 rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def asof_join(facts: DataFrame, versions: DataFrame, on: Sequence[str], fact_time: str, version_time: str,
              values: Sequence[str], strict: bool = False, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Each fact with the `values` of the latest version at or before (strict: before) its time.

    Both sides are stacked and read once in time order per key. No fact meets more than one version, so
    keys with many facts and many versions cost no more than their rows. Facts without one keep NULLs.
    """
    same_time = F.lit(2) if strict else F.lit(0)
    # A fact with a NULL key has no version. Such rows may be a third of all, so they stay out of the window.
    keyed = F.lit(True)
    for k in on:
        keyed = keyed & F.col(k).isNotNull()
    kinds = {f.name: f.dataType for f in versions.select(*values).schema}
    keyless = facts.filter(~keyed).select("*", *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    left = facts.filter(keyed).select(*on, F.col(fact_time).alias("_at"), F.lit(1).alias("_side"),
                        F.struct(*facts.columns).alias("_fact"))
    right = versions.filter(keyed & F.col(version_time).isNotNull()).select(
        *on, F.col(version_time).alias("_at"), same_time.alias("_side"), F.struct(*values).alias("_version"))
    stacked = left.unionByName(right, allowMissingColumns=True)
    found = OrderedGroups(stacked, on, ["_at", "_side"], max_rows).last_known("_found", F.col("_version"))
    return (found.result().filter(F.col("_side") == 1)
            .select("_fact.*", *[F.col(f"_found.{v}").alias(v) for v in values])
            .unionByName(keyless))


def version_lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str], fact_time: str, sk: str, out: str,
                   valid_from: str = "valid_from", valid_to: str = "valid_to", default: Column | None = None,
                   broadcast_rows: int = BROADCAST_ROWS, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Surrogate key of the version with fact time in [valid_from, valid_to), −1 where there is none.

    A dimension of a counted, small size is broadcast and the facts are not moved; a larger one goes
    through the as-of join. On both ways a fact meets the one version that began last at or before its time, so
    overlapping versions never multiply facts; of versions that begin together the largest key counts.
    """
    default = F.lit(UNKNOWN_SK).cast("bigint") if default is None else default
    one = (dim.filter(F.col(valid_from).isNotNull()).groupBy(*on, F.col(valid_from).alias("_from"))
           .agg(F.max_by(F.struct(F.col(valid_to).alias("_to"), F.col(sk).alias("_sk")),
                         F.struct(F.col(sk))).alias("_v")))
    versions = one.select(*on, "_from", "_v._to", "_v._sk")
    # The dimension's own rows are counted, no fewer than its versions: a limit over a stored table stops early, one over
    # the grouping could not, and would group everything once more.
    if fits_broadcast(dim, broadcast_rows):
        spans = versions.withColumn("_next", F.lead("_from").over(W.partitionBy(*on).orderBy("_from")))
        condition = F.lit(True)
        for k in on:
            condition = condition & (F.col(f"f.{k}") == F.col(f"v.{k}"))
        at = F.col(f"f.{fact_time}")
        condition = condition & (at >= F.col("v._from")) & (F.col("v._next").isNull() | (at < F.col("v._next")))
        valid = F.col("v._to").isNull() | (at < F.col("v._to"))
        joined = (facts.alias("f").join(F.broadcast(spans).alias("v"), condition, "left")
                  .select("f.*", F.coalesce(F.when(valid, F.col("v._sk")), default).alias(out)))
        return joined
    joined = asof_join(facts, versions, on, fact_time, "_from", ["_to", "_sk"], max_rows=max_rows)
    valid = F.col("_to").isNull() | (F.col(fact_time) < F.col("_to"))
    return joined.withColumn(out, F.coalesce(F.when(valid, F.col("_sk")), default)).drop("_to", "_sk")


def daily_rates(rates: DataFrame, currency: str, day: str, rate: str, until: Column) -> DataFrame:
    """(currency, date, rate) for every day from a currency's first rate on: gaps repeat the latest rate.

    One row per publication becomes one per day it applies to; the span to the next publication is known
    from a window over a currency's own publication dates.
    """
    one = rates.groupBy(currency, day).agg(F.max_by(rate, F.struct(rate)).alias(rate))
    following = F.lead(day).over(W.partitionBy(currency).orderBy(day))
    last = F.coalesce(F.date_sub(following, 1), F.greatest(F.col(day), until))
    return (one.withColumn("_last", last)
            .select(currency, rate, F.explode(F.sequence(F.col(day), F.col("_last"))).alias("rate_date")))


def convert(facts: DataFrame, dense: DataFrame, currency: str, day: str, amount: str, rate: str = "rate",
            base: str = "EUR", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds fx_rate (1 for the base currency, else the latest on or before the day) and amount_base.

    rate is units per one base unit, so the base amount is amount / rate, rounded half up to cents.
    """
    table = dense.select(F.col(currency), F.col("rate_date").alias(day), F.col(rate).alias("_rate"))
    side = F.broadcast(table) if fits_broadcast(table, broadcast_rows) else table
    joined = facts.join(side, [currency, day], "left")
    fx = F.when(F.col(currency) == base, F.lit(1).cast("decimal(18,4)")).otherwise(F.col("_rate"))
    exact = F.col(amount).cast("decimal(20,2)") / fx
    return (joined.withColumn("fx_rate", fx)
            .withColumn("amount_base", F.round(exact, 2).cast("decimal(18,2)")).drop("_rate"))
