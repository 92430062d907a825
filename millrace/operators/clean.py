"""From all-text Bronze rows to typed rows, a quarantine and one winner per key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions import dates, money

TRACE = ["_source_file", "_file_modification_time", "_batch_date", "_run_id"]


def typed(column: str, target: str) -> Column:
    """One text column in its contract type, NULL where the text does not fit. Nothing is corrected."""
    text = F.col(column)
    if target == "string":
        return text
    if target == "timestamp":
        return dates.parse_timestamp(text)
    if target == "date":
        return dates.parse_date(text)
    if target == "date_or_instant":
        return dates.parse_date_or_instant(text)
    if target == "decimal(18,2)":
        return money.parse_money(text)
    if target.startswith("decimal("):
        # More digits than the type has are no value: a cast would round them away.
        scale = int(target.rstrip(")").split(",")[1])
        fits = text.rlike(rf"^-?\d+(\.\d{{1,{scale}}})?$" if scale else r"^-?\d+$")
        return F.when(fits, text.try_cast(target))
    return text.try_cast(target)


def merge_renamed(df: DataFrame, renamed: dict[str, Sequence[str]]) -> DataFrame:
    """New name first, then the contract name; the new columns disappear."""
    for name, others in renamed.items():
        present = [c for c in [*others, name] if c in df.columns]
        if present:
            df = df.withColumn(name, F.coalesce(*present)).drop(*[c for c in others if c in df.columns])
    return df


def typed_projection(bronze: DataFrame, columns: dict[str, str], keep: Sequence[str] = TRACE) -> DataFrame:
    """Contract columns of the approved version, typed, in one projection; other columns are ignored.

    The text of each re-typed column stays available as `<name>_text` for the rules that follow.
    """
    absent = F.lit(None).cast("string")
    text = bronze.select(
        *[(F.col(c) if c in bronze.columns else absent).alias(c) for c in columns],
        *[c for c in [*keep, "_raw"] if c in bronze.columns])
    return text.select(
        *[typed(c, t).alias(c) for c, t in columns.items()],
        *[F.col(c).alias(f"{c}_text") for c, t in columns.items() if t != "string"],
        *[c for c in text.columns if c not in columns])


def all_null(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull()


def winners(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, NULL keys left out; `order` ranks the versions, best first.

    row_number() = 1 lets Spark keep only the best row per key in each input partition before the shuffle,
    so a key with any number of copies sends at most one row per task.
    """
    present = df.dropna(subset=list(keys))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return present.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def delivery_order(df: DataFrame) -> list[Column]:
    """Latest attempt, then latest file, then a hash so that the choice never depends on the plan."""
    ranked = [F.desc_nulls_last(c) for c in ("delivery_attempt", "_file_modification_time", "_source_file")
              if c in df.columns]
    return [*ranked, F.desc(F.xxhash64(*df.columns))]


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current rows with newer versions of the same key put in; running it twice changes nothing."""
    both = (current.withColumn("_incoming", F.lit(0))
            .unionByName(changes.withColumn("_incoming", F.lit(1)), allowMissingColumns=True))
    best = winners(both, keys, [*[F.desc_nulls_last(c) for c in order], F.desc("_incoming"),
                                F.desc(F.xxhash64(*current.columns))])
    return best.drop("_incoming")


def affected_partitions(changes: DataFrame, partition: str) -> DataFrame:
    """Which partitions a late or repeated delivery touches."""
    return changes.select(partition).distinct()


def hide_personal(df: DataFrame, columns: Sequence[str], salt: str | None = None) -> DataFrame:
    """Personal columns removed, or replaced by a salted digest that still joins."""
    present = [c for c in columns if c in df.columns]
    if salt is None:
        return df.drop(*present)
    return df.select(*[F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256).alias(c)
                       if c in present else F.col(c) for c in df.columns])
