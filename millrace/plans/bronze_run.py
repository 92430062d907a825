"""One Bronze run over many feeds: ingest, reconcile, store, gate."""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import reconcile as checks
from millrace.registry import FEEDS, Feed
from millrace.session import materialize
from millrace.sources import files, manifests, tables
from millrace.sources.commits import Log
from millrace.sources.files import exists
from millrace.streaming.bronze import batch_date, ingest, read_bronze


@dataclass
class RunReport:
    run_id: str
    ingested: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)


def ingest_feeds(spark: SparkSession, lake: tables.Lake, feeds: Sequence[Feed] = FEEDS,
                 run_id: str | None = None, parallel: int = 4, landing_root: str | None = None,
                 **options) -> RunReport:
    """All new files of every feed that has delivered anything. Feeds are independent streams and overlap."""
    report = RunReport(run_id or str(uuid.uuid4()))
    source = landing_root or lake.landing
    present = [f for f in feeds if exists(spark, f.under(source))]
    report.skipped = [f.entity for f in feeds if f not in present]

    def one(feed: Feed) -> None:
        started = time.monotonic()
        ingest(spark, lake, feed, report.run_id, landing_root=source, **options)
        report.seconds[feed.entity] = round(time.monotonic() - started, 3)

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        list(pool.map(one, present))
    report.ingested = [f.entity for f in present]
    return report


def _listing(spark: SparkSession, root: str, feed: Feed) -> tuple[DataFrame, DataFrame]:
    read = manifests.read_manifests(spark, root, feed)
    return read, manifests.manifest_listing(read)


def within(day: str, start: str | None, end: str | None) -> Column:
    """Whether a date lies in an inclusive range; an end that is not given is open."""
    inside = F.lit(True)
    if start:
        inside = inside & (F.col(day) >= F.lit(start).cast("date"))
    if end:
        inside = inside & (F.col(day) <= F.lit(end).cast("date"))
    return inside


def reconcile_feeds(spark: SparkSession, lake: tables.Lake, feeds: Sequence[Feed], run_id: str,
                    landing_root: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """All feeds in one plan: the union of their file counts against one reading of all manifests. A range of business
    dates prunes Bronze to their partitions."""
    stored = reduce(DataFrame.unionByName, [
        checks.stored_files(read_bronze(spark, lake, f).filter(within("_batch_date", start, end)), f.entity) for f in feeds])
    listing = manifests.manifest_listing(manifests.read_manifests(spark, landing_root or lake.landing))
    wanted = listing.filter(F.concat_ws("/", F.lit(""), "source", "entity").isin([f.under("") for f in feeds]))
    return checks.reconcile_files(stored, wanted.filter(within("business_date", start, end)), run_id)


FILE_STATE = ("path string, modified bigint, bytes bigint, business_date date, file_name string, sha256 string, records bigint, "
              "sums array<struct<currency:string,total:decimal(38,6)>>")


def state_log(spark: SparkSession, lake: tables.Lake, feed: Feed) -> Log:
    """What is known of a feed's delivered files (table `files`): digest, Bronze rows and sums of amounts, once a file."""
    return Log(spark, lake.path("ops", f"files/{feed.entity}"))


def learned_files(spark: SparkSession, lake: tables.Lake, feed: Feed, listed: DataFrame, landing_root: str) -> DataFrame:
    """FILE_STATE of all listed files that are there.

    Files that the state holds under their path, time of change and size are not opened again; of Bronze only the batch
    dates of the others are read. What is learned is committed, but for files whose rows Bronze does not hold yet.
    """
    commit = state_log(spark, lake, feed).begin()
    known = commit.read("files", schema=FILE_STATE)
    paths = listed.filter(F.col("file_name").isNotNull()).select(F.concat_ws("/", "folder", "file_name").alias("path")).distinct()
    there = files.glob_stats(spark, f"{feed.under(landing_root)}/*/*/*/part-*").join(paths, "path", "left_semi")
    key = ["path", "modified", "bytes"]
    new = materialize(there.join(known.select(*key), key, "left_anti"))
    if new.isEmpty():
        return known.join(there.select(*key), key, "left_semi")
    shas = files.digests(new.select("path")).filter(F.col("sha256").isNotNull()).select(
        "path", batch_date("path").alias("business_date"), files.file_name("path").alias("file_name"), "sha256")
    days = [r[0] for r in new.select(batch_date("path")).distinct().collect()]
    amounts = [c for c in (feed.amount, feed.currency) if c]
    rows = read_bronze(spark, lake, feed).filter(F.col("_batch_date").isin(days)).select(
        F.col("_batch_date").alias("business_date"), files.file_name("_source_file").alias("file_name"), *amounts)
    on = ["business_date", "file_name"]
    fresh = new.join(shas, "path").join(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("records")), on, "left")
    if feed.amount:
        sums = checks.control_sums(rows, on, feed.amount, feed.currency).groupBy(*on).agg(
            F.collect_list(F.struct("currency", "total")).alias("sums"))     # one entry a currency of a file
        fresh = fresh.join(sums, on, "left")
    else:
        fresh = fresh.withColumn("sums", F.lit(None).cast("array<struct<currency:string,total:decimal(38,6)>>"))
    fresh = materialize(fresh.select(known.columns))
    whole = fresh.filter(F.col("records").isNotNull() | (F.col("bytes") == 0))
    if not whole.isEmpty():
        commit.put("files", whole, value=f"{commit.base.number + 1:012d}")
        commit.finish()
    return known.join(there.select(*key), key, "left_semi").unionByName(fresh)


def verify_feed(spark: SparkSession, lake: tables.Lake, feed: Feed, landing_root: str | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """One verdict per batch (of an inclusive range of business dates) from its files' counts and checksums and its rows'
    control totals.

    Rows are counted in Bronze and files read for their digests once in their life: see `learned_files`.
    """
    root = landing_root or lake.landing
    read, listed = _listing(spark, root, feed)
    read, listed = (df.filter(within("business_date", start, end)) for df in (read, listed))
    state = learned_files(spark, lake, feed, listed, root)
    # A file without lines has no rows to count, yet it was delivered.
    delivered = state.select("business_date", "file_name", "sha256", F.coalesce("records", F.lit(0)).alias("records"))
    totals = None
    if feed.amount:
        effective = manifests.effective_rows(state.select("business_date", "file_name", F.explode("sums").alias("s")), listed,
                                             ["business_date", "file_name"])
        actual = effective.groupBy("business_date", F.col("s.currency").alias("currency")).agg(
            F.round(F.sum("s.total"), 2).cast("decimal(38,2)").alias("total"))
        totals = checks.verify_totals(checks.manifest_totals(read), actual, ["business_date", "currency"])
    return checks.verify_batches(listed, delivered, ["business_date"], totals)


def stored_results(spark: SparkSession, lake: tables.Lake, run_id: str | None = None) -> DataFrame:
    results = tables.read_table(spark, lake.path("ops", "bronze_reconciliation"))
    return results if run_id is None else results.filter(F.col("run_id") == run_id)


def run(spark: SparkSession, lake: tables.Lake, feeds: Sequence[Feed] = FEEDS, run_id: str | None = None,
        gate: bool = True, landing_root: str | None = None, start: str | None = None, end: str | None = None,
        **options) -> RunReport:
    """Ingest, then judge the stored numbers (of a range of business dates): results are computed once, written, and read
    back."""
    report = ingest_feeds(spark, lake, feeds, run_id, landing_root=landing_root, **options)
    delivered = [f for f in feeds if f.entity in report.ingested]
    if delivered:
        tables.append_run(reconcile_feeds(spark, lake, delivered, report.run_id, landing_root, start, end),
                          lake.path("ops", "bronze_reconciliation"))
        if gate:
            checks.enforce_gate(stored_results(spark, lake, report.run_id))
    return report
