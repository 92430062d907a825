"""Bronze to Silver for a range of business dates; safe to repeat, in any order."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import clean, quality, reconcile
from millrace.registry import CROSS_FIELDS, DOMAINS, RENAMED_FIELDS, Feed, contract_columns
from millrace.session import materialize
from millrace.sources import manifests, tables
from millrace.sources.commits import Commit, Log, Version
from millrace.sources.files import file_name
from millrace.streaming.bronze import read_bronze


def log_of(spark: SparkSession, lake: tables.Lake, feed: Feed) -> Log:
    """The feed's commit log: tables `rows`, `quarantine` and, for keys that come back, `candidates`."""
    return Log(spark, lake.path("silver", feed.entity))


def announced(spark: SparkSession, lake: tables.Lake, feed: Feed, start: str | None = None,
              end: str | None = None) -> DataFrame:
    """(_batch_date, _file, delivery_attempt) of all files the latest manifests list, within the dates.

    An empty batch keeps its date with a NULL file. Read once and kept: manifests may be replaced while a build runs.
    """
    read = manifests.read_manifests(spark, lake.landing, feed)
    if start:
        read = read.filter(F.col("business_date") >= F.lit(start).cast("date"))
    if end:
        read = read.filter(F.col("business_date") <= F.lit(end).cast("date"))
    return materialize(read.select(
        F.col("business_date").alias("_batch_date"), F.coalesce("delivery_attempt", F.lit(1)).alias("delivery_attempt"),
        F.explode_outer("files.name").alias("_file")).distinct())


def accepted_files(listed: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """What `verdicts` (business_date, accepted) leave of the announced files: a rejected batch goes as a whole."""
    if verdicts is None:
        return listed
    good = verdicts.filter("accepted").select(F.col("business_date").alias("_batch_date"))
    return materialize(listed.join(good, "_batch_date", "left_semi"))


def batch_dates(accepted: DataFrame) -> list:
    """The dates of a build: one value per date, for partition pruning."""
    return [r["_batch_date"] for r in accepted.select("_batch_date").distinct().collect()]


def accepted_bronze(spark: SparkSession, lake: tables.Lake, feed: Feed, accepted: DataFrame, days: list) -> DataFrame:
    """Bronze rows of accepted files; only the partitions of their dates are listed and read."""
    bronze = read_bronze(spark, lake, feed).filter(F.col("_batch_date").isin(days))
    return bronze.withColumn("_file", file_name("_source_file")).join(accepted, ["_batch_date", "_file"]).drop("_file")


def unique_key(feed: Feed) -> list[str]:
    """What may occur once in Silver: change feeds repeat their key on purpose, snapshots every day."""
    per_kind = {"changes": ["change_seq"], "snapshot": ["_batch_date"], "events": []}
    return [*feed.keys, *per_kind[feed.kind]]


def feed_rules(feed: Feed, columns: dict[str, str], rules: Sequence[quality.Rule] = ()) -> list[quality.Rule]:
    """The rules the registry binds to a feed (structure, keys, types, code values, fields that exclude each other), and the
    given ones, which come first in their stage and win on equal names."""
    general = quality.contract_rules(columns, feed.keys, DOMAINS.get(feed.entity, {}))
    if feed.entity in CROSS_FIELDS:
        general += quality.cross_field_rules(*CROSS_FIELDS[feed.entity])
    named = {r.name for r in rules}
    return [*rules, *[r for r in general if r.name not in named]]


def judged_rows(spark: SparkSession, lake: tables.Lake, feed: Feed, accepted: DataFrame, days: list,
                rules: Sequence[quality.Rule] = (), version: str = "1.0") -> DataFrame:
    """Typed rows of accepted files with the first broken rule in `reason`."""
    columns = contract_columns(feed, version)
    bronze = clean.merge_renamed(accepted_bronze(spark, lake, feed, accepted, days), RENAMED_FIELDS.get(feed.entity, {}))
    typed = clean.typed_projection(bronze, columns, keep=[*clean.TRACE, "delivery_attempt"])
    return quality.apply_rules(typed, feed_rules(feed, columns, rules))


def build(spark: SparkSession, lake: tables.Lake, feed: Feed, rules: Sequence[quality.Rule] = (),
          start: str | None = None, end: str | None = None, version: str = "1.0",
          verdicts: DataFrame | None = None) -> Version:
    """Typed, ruled, quarantined and deduplicated rows of the range, written as whole partitions in one commit.

    Every date of the range is computed from Bronze again, so late, repeated and corrected deliveries end in
    the table an in-order delivery would have produced, however the dates are dealt to calls. Dates of the range without
    an accepted batch (rejected since, or taken back) end without rows; dates whose rows come out as they were keep
    their files, so a version differs from the one before in what changed. All tables are partitioned by batch date, and
    nothing shows until all are written: a run that fails changes nothing.
    """
    commit = log_of(spark, lake, feed).begin()
    listed = announced(spark, lake, feed, start, end)
    accepted = accepted_files(listed, verdicts)
    held = {v for t in commit.base.tables for v in commit.base.values(t) if (start or v) <= v <= (end or v)}
    touched = {str(d) for d in batch_dates(listed)} | held
    judged = tables.staged(judged_rows(spark, lake, feed, accepted, batch_dates(accepted), rules, version))
    commit.replace("quarantine", judged.filter(F.col("reason").isNotNull()), "_batch_date", touched)
    commit.replace("landed", landed_sums(judged, feed), "_batch_date", touched)
    good = judged.filter(F.col("reason").isNull()).select(*silver_columns(feed, version))
    key = unique_key(feed)
    if "_batch_date" in key:  # a date's rows have no rivals in other dates
        commit.replace("rows", clean.winners(good, key, clean.delivery_order(good)), "_batch_date", touched, settle=True)
    else:
        across_dates(commit, good, key, touched, fields_of(silver_columns(feed, version)), clean.delivery_order(good))
    return commit.finish(start=start, end=end)


def amount_of(feed: Feed) -> tuple[Column, Column]:
    """A feed's amount and currency; one currency for feeds without."""
    return (F.col(feed.amount) if feed.amount else F.lit(None).cast("decimal(18,2)"), F.col(feed.currency) if feed.currency else F.lit("ALL"))


def landed_sums(judged: DataFrame, feed: Feed) -> DataFrame:
    amount, currency = amount_of(feed)
    return reconcile.batch_sums(judged, "_batch_date", amount, currency, landed_rows=F.lit(True), quarantined_rows=F.col("reason").isNotNull())


def layers(spark: SparkSession, lake: tables.Lake, feed: Feed, at: Version | None = None) -> DataFrame:
    """Each batch from its manifest through the landed rows to Silver, by currency: see `reconcile.layer_totals`.

    What landed was summed when Silver was built, from rows that were typed then; Silver is scanned for three columns.
    Landed totals are those of amounts that are numbers, good or not, as in the manifests.
    """
    log = log_of(spark, lake, feed)
    at = at or log.current()
    amount, currency = amount_of(feed)
    now = reconcile.batch_sums(read_silver(spark, lake, feed, at=at), "_batch_date", amount, currency, silver_rows=F.lit(True))
    read = manifests.read_manifests(spark, lake.landing, feed).withColumnRenamed("business_date", "_batch_date")
    rows = read.select("_batch_date", F.lit(reconcile.WHOLE_BATCH).alias("currency"), F.col("record_count").alias("manifest_rows"))
    sums = read.select("_batch_date", F.explode("amount_totals").alias("currency", "t")).select(
        "_batch_date", "currency", F.col("t").try_cast("decimal(38,2)").alias("manifest_total"))
    announced = rows.unionByName(sums, allowMissingColumns=True)
    return reconcile.layer_totals(log.read("landed", at), now, announced if feed.amount else rows.withColumn(
        "manifest_total", F.lit(None).cast("decimal(38,2)")), "_batch_date")


def across_dates(commit: Commit, good: DataFrame, key: list[str], touched: set[str], schema: str, order: list[Column],
                 partition: str = "_batch_date") -> None:
    """`rows` holds the winner of each key over all partitions, whatever was built when.

    Every good row stays in `candidates`. Keys that the touched partitions held or hold now meet their rivals of other
    partitions there; partitions of rivals are rewritten too, all other keys in them as they are.
    """
    now = tables.staged(good)
    others = commit.base.values("candidates") - touched
    was = commit.read("candidates", touched, schema)
    commit.replace("candidates", now, partition, touched)
    if not others:
        commit.replace("rows", clean.winners(now, key, order), partition, touched, settle=True)
        return
    keys = tables.staged(now.select(*key).unionByName(was.select(*key)).distinct())
    rivals = tables.staged(commit.read("candidates", others, schema).join(keys, key, "left_semi"))
    dates = {str(r[0]) for r in rivals.select(F.col(partition).cast("string")).distinct().collect()}
    rows = clean.winners(now.unionByName(rivals), key, order)
    if dates:
        rest = commit.read("rows", dates, schema).join(keys, key, "left_anti")
        rows = rows.unionByName(rest.select(*rows.columns))
    commit.replace("rows", rows, partition, touched | dates, settle=True)


def rebuild_dates(spark: SparkSession, lake: tables.Lake, feed: Feed, dates: DataFrame, **options) -> None:
    """Backfill or late delivery: rebuilds the span of the touched dates and nothing else."""
    span = dates.agg(F.min("_batch_date").cast("string"), F.max("_batch_date").cast("string")).first()
    if span[0] is not None:
        build(spark, lake, feed, start=span[0], end=span[1], **options)


def silver_columns(feed: Feed, version: str = "1.0") -> dict[str, str]:
    final = {c: "date" if t == "date_or_instant" else t for c, t in contract_columns(feed, version).items()}
    return {**final, "_source_file": "string", "_file_modification_time": "timestamp", "_run_id": "string",
            "delivery_attempt": "int", "_batch_date": "date"}


def fields_of(columns: dict[str, str]) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in columns.items())


def read_silver(spark: SparkSession, lake: tables.Lake, feed: Feed, version: str = "1.0", at: Version | None = None,
                values: Iterable[str] | None = None) -> DataFrame:
    """Under the contract's schema: columns a later version added read NULL in older files. `at` pins a commit (default:
    the last one), `values` are batch dates."""
    log = log_of(spark, lake, feed)
    return log.read("rows", at or log.current(), values, fields_of(silver_columns(feed, version)))


def read_quarantine(spark: SparkSession, lake: tables.Lake, feed: Feed, version: str = "1.0",
                    at: Version | None = None) -> DataFrame:
    """Typed values, the texts they came from, the reason, and the raw line of a malformed record."""
    texts = quality.source_texts(contract_columns(feed, version))
    columns = {**{t: "string" for t in texts}, **silver_columns(feed, version), "_raw": "string", "reason": "string"}
    log = log_of(spark, lake, feed)
    return log.read("quarantine", at or log.current(), schema=fields_of(columns))
