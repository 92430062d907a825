"""Batch manifests: read on the executors, one row per batch."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.registry import SOURCE_ORDER, Feed
from millrace.sources import files

# The manifest's name and its document structure.
MANIFEST_NAME = "_manifest.json"
MANIFEST_SCHEMA = (
    "schema_version string, source string, entity string, business_date string, "
    "files array<struct<name:string,records:bigint,sha256:string>>, record_count bigint, "
    "amount_field string, currency_field string, amount_totals map<string,string>, generated_at string, "
    "delivery_attempt int, supersedes array<string>")


def read_manifests(spark: SparkSession, landing_root: str, feed: Feed | None = None) -> DataFrame:
    """Every delivered manifest below the root (of one feed), with its folder and business_date as DATE.

    Folders named with a leading underscore hold late or faulty material and are not deliveries. A document that does
    not say which batch it announces, or how many records, is not `readable`; its batch is told by its path.
    """
    scope = feed.under(landing_root) if feed else f"{landing_root}/[!_]*/[!_]*"
    paths = files.glob_paths(spark, f"{scope}/*/*/*/{MANIFEST_NAME}")
    told = (files.read_texts(paths)
            .select(F.regexp_replace("path", "/[^/]+$", "").alias("folder"),
                    F.from_json("text", MANIFEST_SCHEMA).alias("m"))
            .select("folder", "m.*")
            .withColumn("business_date", F.try_to_date("business_date"))
            .withColumn("readable", F.col("business_date").isNotNull() & F.col("source").isNotNull()
                        & F.col("entity").isNotNull() & F.col("record_count").isNotNull()))
    place = F.split("folder", "/")
    return (told.withColumn("source", F.coalesce("source", F.try_element_at(place, F.lit(-5))))
            .withColumn("entity", F.coalesce("entity", F.try_element_at(place, F.lit(-4))))
            .withColumn("business_date", F.coalesce("business_date", F.try_to_date(F.regexp_extract(
                "folder", r"(\d{4}/\d{2}/\d{2})$", 1), "yyyy/MM/dd"))))


def manifest_rows(manifests: DataFrame) -> DataFrame:
    """(business_date, record_count) per batch."""
    return manifests.select("business_date", "record_count")


def manifest_listing(manifests: DataFrame) -> DataFrame:
    """One row per listed file; a manifest that lists none keeps one row with NULL file columns."""
    head = ["source", "entity", "business_date", "record_count", "folder",
            *[c for c in ("readable",) if c in manifests.columns]]
    return (manifests.select(*head, F.explode_outer("files").alias("f"))
            .select(*head,
                    F.col("f.name").alias("file_name"), F.col("f.records").alias("file_records"),
                    F.col("f.sha256").alias("sha256")))


def source_rank(source: Column | str, order: list[str] = SOURCE_ORDER) -> Column:
    """Position in the delivery order; unknown sources come last."""
    source = F.col(source) if isinstance(source, str) else source
    position = F.array_position(F.array(*[F.lit(s) for s in order]), source)
    return F.when(position > 0, position - 1).otherwise(len(order)).cast("int")


def discover(batches: DataFrame, start: str | None = None, end: str | None = None,
             order: list[str] = SOURCE_ORDER) -> DataFrame:
    """Complete batches of an inclusive date range in delivery order."""
    kept = batches.filter(~F.col("source").startswith("_") & ~F.col("entity").startswith("_"))
    if start is not None:
        kept = kept.filter(F.col("business_date") >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.filter(F.col("business_date") <= F.lit(end).cast("date"))
    return (kept.withColumn("source_rank", source_rank("source", order))
            .orderBy("business_date", "source_rank", "source", "entity"))


def effective_rows(bronze: DataFrame, listing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose file is named by the batch's latest manifest; superseded files drop out."""
    return bronze.join(listing.select(*keys).distinct(), keys, "left_semi")


def late_batches(batches: DataFrame, feed_key: list[str], batch_date: str, arrival: str) -> DataFrame:
    """Adds `is_late`: a later business date of the same feed arrived before this batch.

    One row per batch goes in, so a window per feed holds at most one row per business date and attempt.
    """
    earlier = (W.partitionBy(*feed_key).orderBy(arrival)
               .rowsBetween(W.unboundedPreceding, -1))
    return batches.withColumn(
        "is_late", F.coalesce(F.max(batch_date).over(earlier) > F.col(batch_date), F.lit(False)))
