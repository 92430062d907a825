"""From changed partitions and members to what has to be computed again."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAR = "9999-12-31"


def month_of(day: Column) -> Column:
    """yyyy-MM of a date; rows without one have a month of their own."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def lineage(rows: DataFrame, batch: str, month: Column) -> DataFrame:
    """(batch_date, month, n_rows): which months the rows of each batch fall into. One row per batch and month."""
    return rows.groupBy(F.col(batch).cast("string").alias("batch_date"), month.alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def uses(rows: DataFrame, kinds: Sequence[str], at: str, month: Column) -> DataFrame:
    """(kind, key, first_use, month): when each value of the `kinds` columns is first used in a month."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in kinds])
    return (rows.select(F.explode(pairs).alias("p"), F.col(at).cast("timestamp").alias("at"), month.alias("month"))
            .where("p.key IS NOT NULL").groupBy("p.kind", "p.key", "month").agg(F.min("at").alias("first_use")))


def changed_intervals(old: DataFrame, new: DataFrame, key: str, sk: str, compared: Sequence[str] = ("row_hash",),
                      valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """(key, low, high): times at which a lookup of a versioned dimension finds something else than before.

    A version that is there on both sides with equal `compared` columns matters where only one of its two spans reaches;
    any other matters for its whole span. Sides meet by (key, sk), so this costs the dimension's rows.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).cast("string").alias("key"), F.col(sk).alias("sk"), F.struct(
            F.col(valid_from).cast("timestamp").alias("low"),
            F.coalesce(F.col(valid_to).cast("timestamp"), F.lit(FAR).cast("timestamp")).alias("high"),
            F.struct(*[F.col(c) for c in compared]).alias("held")).alias(name))

    both = side(old, "o").join(side(new, "n"), ["key", "sk"], "full_outer")
    span = lambda a, b: F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    edges = F.array(span(F.col("o.low"), F.col("n.low")), span(F.col("o.high"), F.col("n.high")))
    whole = F.array(F.struct(F.least("o.low", "n.low").alias("low"), F.greatest("o.high", "n.high").alias("high")))
    same = F.col("o").isNotNull() & F.col("n").isNotNull() & F.col("o.held").eqNullSafe(F.col("n.held"))
    return (both.select("key", F.explode(F.when(same, edges).otherwise(whole)).alias("s"))
            .select("key", "s.low", "s.high").where("low < high"))


def months_in_use(used: DataFrame, kind: str, intervals: DataFrame) -> DataFrame:
    """(month) in which a changed member is used within one of its intervals, told by `uses` alone.

    `intervals` (key, low, high); a month counts if its first use lies before the end and its end after the start.
    """
    until = F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1).cast("timestamp") + F.expr("INTERVAL 1 DAY")
    mine = used.where((F.col("kind") == kind) & (F.col("month") != "none")).select("key", "month", "first_use", until.alias("until"))
    met = mine.join(intervals, "key").where((F.col("first_use") < F.col("high")) & (F.col("until") > F.col("low")))
    return met.select("month").distinct()


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows on one side only, each as often as it stands there more than on the other."""
    new = new.select(*old.columns)
    return old.exceptAll(new).unionAll(new.exceptAll(old))
