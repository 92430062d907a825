"""Is what landed what was announced? Counts, checksums, control totals, ledger, completeness."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ReconciliationError(RuntimeError):
    """Bronze and the manifests disagree."""


def stored_files(bronze: DataFrame, entity: str) -> DataFrame:
    """Bronze rows per (entity, batch_date, file_name), counted before anything else touches them."""
    return (bronze.groupBy(F.col("_batch_date").alias("batch_date"),
                           F.substring_index("_source_file", "/", -1).alias("file_name"))
            .agg(F.count(F.lit(1)).alias("rows")).withColumn("entity", F.lit(entity)))


def reconcile_files(stored: DataFrame, listing: DataFrame, run_id: str) -> DataFrame:
    """Per entity and batch date: manifest count, rows from listed files, rows from other files, and the status: OK,
    MISMATCH, or BAD_MANIFEST where a delivered manifest could not be read.

    One full join of files found and files listed, then one aggregate: both sides hold one row per file.
    Missing counts are 0. A file counts as often as it is listed.
    """
    keys = ["entity", "batch_date", "file_name"]
    readable = F.col("readable") if "readable" in listing.columns else F.lit(True)
    listed = (listing.withColumnRenamed("business_date", "batch_date").groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("times_listed"), F.max("record_count").alias("record_count"),
                   F.bool_and(readable).alias("readable")))
    zero = F.lit(0).cast("bigint")
    in_list = F.col("rows") * F.col("times_listed")
    not_in_list = F.when(F.col("times_listed").isNull(), F.col("rows"))
    counts = stored.join(listed, keys, "full_outer").groupBy("entity", "batch_date").agg(
        F.coalesce(F.max("record_count"), zero).alias("manifest_records"),
        F.coalesce(F.sum(in_list), zero).alias("bronze_records"),
        F.coalesce(F.sum(not_in_list), zero).alias("unlisted_records"),
        F.coalesce(F.bool_and("readable"), F.lit(True)).alias("_readable"))
    matches = F.col("manifest_records") == F.col("bronze_records")
    status = F.when(~F.col("_readable"), "BAD_MANIFEST").when(matches, "OK").otherwise("MISMATCH")
    return counts.withColumn("status", status).drop("_readable").withColumns({"run_id": F.lit(run_id), "checked_at": F.now()})


def reconcile(bronze: DataFrame, listing: DataFrame, entity: str, run_id: str) -> DataFrame:
    """One feed's reconciliation; `listing` holds this feed's manifests."""
    return reconcile_files(stored_files(bronze, entity), listing.withColumn("entity", F.lit(entity)), run_id)


def gate_counts(results: DataFrame, status: str = "status") -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("checked"),
                       F.count_if(F.col(status) != "OK").alias("mismatches"))


def enforce_gate(results: DataFrame) -> int:
    """Number of batches checked; raises when any differs."""
    counts = gate_counts(results).first()
    if counts["mismatches"]:
        raise ReconciliationError(f"{counts['mismatches']} of {counts['checked']} batches do not match")
    return counts["checked"]


def without_manifest(bronze: DataFrame, manifests: DataFrame) -> DataFrame:
    """Batch dates with rows but no manifest, which plain reconciliation would report as OK."""
    stored = bronze.groupBy(F.col("_batch_date").alias("batch_date")).agg(F.count(F.lit(1)).alias("rows"))
    return stored.join(manifests.select(F.col("business_date").alias("batch_date")), "batch_date", "left_anti")


def control_sums(rows: DataFrame, keys: Sequence[str], amount: str, currency: str | None = None) -> DataFrame:
    """(keys, currency, total DECIMAL(38,6)) over all records whose amount is a number; not rounded, so sums of files add up to
    those of batches.

    Kept as rows: a corrupt currency field may hold any number of values.
    """
    value = F.col(amount).try_cast("decimal(38,6)")
    name = F.coalesce(F.col(currency).cast("string"), F.lit("None")) if currency else F.lit("ALL")
    return (rows.select(*keys, name.alias("currency"), value.alias("_value"))
            .filter(F.col("_value").isNotNull())
            .groupBy(*keys, "currency").agg(F.sum("_value").cast("decimal(38,6)").alias("total")))


def control_totals(rows: DataFrame, batch_keys: Sequence[str], amount: str,
                   currency: str | None = None) -> DataFrame:
    """(batch keys, currency, total DECIMAL(38,2)) over all records whose amount is a number."""
    return control_sums(rows, batch_keys, amount, currency).withColumn("total", F.round("total", 2).cast("decimal(38,2)"))


def verify_totals(announced: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full comparison of (keys, total) from both sides; a total only one side knows is a difference."""
    a = announced.select(*keys, F.col("total").alias("announced_total"))
    b = actual.select(*keys, F.col("total").alias("actual_total"))
    return (a.join(b, list(keys), "full_outer")
            .withColumn("matches", F.col("announced_total").eqNullSafe(F.col("actual_total"))))


def manifest_totals(manifests: DataFrame) -> DataFrame:
    """The announced totals as rows (source, entity, business_date, currency, total)."""
    return (manifests.select("source", "entity", "business_date", F.explode("amount_totals").alias("currency", "t"))
            .select("source", "entity", "business_date", "currency",
                    F.col("t").try_cast("decimal(38,2)").alias("total")))


def verify_batches(listing: DataFrame, delivered: DataFrame, batch_keys: Sequence[str],
                   totals: DataFrame | None = None) -> DataFrame:
    """One verdict per batch; a single failing file rejects the whole batch.

    listing:   batch_keys, record_count, file_name, file_records, sha256 as announced
    delivered: batch_keys, file_name, records, sha256 as found
    totals:    verify_totals output on batch_keys + currency
    """
    keys = list(batch_keys)
    found = delivered.select(*keys, "file_name", F.col("records").alias("_records"), F.col("sha256").alias("_sha"))
    checked = (listing.join(found, [*keys, "file_name"], "left")
               .groupBy(*keys)
               .agg(F.max("record_count").alias("record_count"),
                    F.coalesce(F.sum("file_records"), F.lit(0)).alias("announced_records"),
                    F.coalesce(F.sum("_records"), F.lit(0)).alias("delivered_records"),
                    F.count_if(F.col("file_name").isNotNull() & F.col("_records").isNull()).alias("missing_files"),
                    F.count_if(F.col("_records") != F.col("file_records")).alias("count_differences"),
                    F.count_if(F.col("_sha") != F.col("sha256")).alias("checksum_differences")))
    if totals is not None:
        bad = totals.groupBy(*keys).agg(F.count_if(~F.col("matches")).alias("total_differences"))
        checked = checked.join(bad, keys, "left")
    else:
        checked = checked.withColumn("total_differences", F.lit(0).cast("bigint"))
    differences = F.coalesce("total_differences", F.lit(0))
    reason = (F.when(F.col("missing_files") > 0, "missing_file")
              .when(F.col("count_differences") > 0, "file_count")
              .when(F.col("checksum_differences") > 0, "checksum")
              .when(F.col("announced_records") != F.col("record_count"), "manifest_sum")
              .when(differences > 0, "control_total"))
    return (checked.withColumn("total_differences", differences)
            .withColumn("reason", reason)
            .withColumn("accepted", F.col("reason").isNull()))


def manifest_sum_check(manifests: DataFrame) -> DataFrame:
    """Sum of the listed files' counts against the batch's own count."""
    total = F.aggregate("files", F.lit(0).cast("bigint"), lambda acc, f: acc + f["records"])
    return manifests.withColumn("files_sum", F.coalesce(total, F.lit(0))).withColumn(
        "sum_matches", F.col("files_sum") == F.col("record_count"))


def duplicate_digests(files: DataFrame, scope: Sequence[str], digest: str = "sha256") -> DataFrame:
    """Content delivered more than once within a scope."""
    return (files.groupBy(*scope, digest).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def new_deliveries(offered: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path, sha256) not yet processed with exactly this content."""
    return offered.join(ledger.select("path", "sha256").distinct(), ["path", "sha256"], "left_anti")


def ledger_conflicts(offered: DataFrame, ledger: DataFrame) -> DataFrame:
    """Known path, different content: an overwrite the protocol forbids."""
    known = ledger.select("path", F.col("sha256").alias("recorded_sha256")).distinct()
    return offered.join(known, "path").filter(F.col("sha256") != F.col("recorded_sha256"))


def skip_superseded(batches: DataFrame, ledger: DataFrame, folder: str = "folder", kind: str = "redelivery") -> DataFrame:
    """Batches whose folder was redelivered stay as they are."""
    replaced = ledger.filter(F.col("kind") == kind).select(F.col("folder").alias(folder)).distinct()
    return batches.join(replaced, folder, "left_anti")


def expected_batches(feeds: DataFrame, start: Column, end: Column, calendar: DataFrame) -> DataFrame:
    """(entity, business_date) due by cadence: daily, business days, or the month's first business day.

    A feed may start later than the window by `first_day_offset` days.
    """
    due = (F.when(F.col("cadence") == "daily", F.lit(True))
           .when(F.col("cadence") == "business_day", F.col("is_business_day"))
           .when(F.col("cadence") == "monthly", F.col("is_first_business_day")))
    days = feeds.select("entity", "cadence", F.explode(F.sequence(
        F.date_add(start, F.col("first_day_offset")), end)).alias("date"))
    return (days.join(calendar.select("date", "is_business_day", "is_first_business_day"), "date")
            .filter(due).select("entity", F.col("date").alias("business_date")))


def completeness(expected: DataFrame, arrived: DataFrame, keys: Sequence[str] = ("entity", "business_date")) -> DataFrame:
    """Gaps ('missing') and surprises ('unexpected') in one pass over both sides."""
    keys = list(keys)
    e = expected.select(*keys).distinct().withColumn("_e", F.lit(1))
    a = arrived.select(*keys).distinct().withColumn("_a", F.lit(1))
    return (e.join(a, keys, "full_outer")
            .filter(F.col("_e").isNull() | F.col("_a").isNull())
            .select(*keys, F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("finding")))


WHOLE_BATCH = "*"


def batch_sums(rows: DataFrame, on: str, amount: Column, currency: Column, **counted: Column) -> DataFrame:
    """(on, currency, total, counts...) of each batch by currency, and of the batch as a whole under currency `*` (no total).

    One scan and one shuffle: both levels are grouping sets over partial sums. `counted` are conditions.
    """
    named = rows.select(F.col(on), F.coalesce(currency.cast("string"), F.lit("None")).alias("_currency"), amount.alias("_amount"),
                        *[c.alias(n) for n, c in counted.items()])
    whole = F.grouping("_currency") == 1
    return named.groupingSets([[F.col(on), F.col("_currency")], [F.col(on)]], on, "_currency").agg(
        F.when(whole, F.lit(WHOLE_BATCH)).otherwise(F.first("_currency")).alias("currency"),
        F.when(~whole, F.round(F.sum("_amount"), 2).cast("decimal(38,2)")).alias("total"),
        *[F.count_if(n).alias(n) for n in counted]).drop("_currency")


def layer_totals(judged: DataFrame, silver: DataFrame, manifest: DataFrame, on: str) -> DataFrame:
    """Rows and amounts of each batch through the layers, by currency and (currency `*`) as a whole.

    judged:   batch_sums of the landed rows, with landed_rows and quarantined_rows
    silver:   batch_sums of Silver, with silver_rows
    manifest: (on, currency, manifest_rows, manifest_total) as announced: rows under `*`, totals under their currencies

    Duplicates are what is neither quarantined nor in Silver. MISMATCH: landed rows or totals are not those announced, or
    Silver holds more than landed.
    """
    sides = [judged.withColumnRenamed("total", "landed_total"), silver.withColumnRenamed("total", "silver_total"), manifest]
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    counts, totals = ("manifest_rows", "landed_rows", "quarantined_rows", "silver_rows"), ("manifest_total", "landed_total", "silver_total")
    joined = tagged.groupBy(on, "currency").agg(*[F.max(c).alias(c) for c in (*counts, *totals)])
    joined = joined.select(on, "currency", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts[1:]], "manifest_rows", *totals)
    duplicates = F.col("landed_rows") - F.col("quarantined_rows") - F.col("silver_rows")
    announced = F.when(F.col("currency") == WHOLE_BATCH, F.coalesce("manifest_rows", F.lit(0)) == F.col("landed_rows")).otherwise(
        F.coalesce("manifest_total", F.lit(0)) == F.coalesce("landed_total", F.lit(0)))
    return joined.withColumn("duplicate_rows", duplicates).withColumn(
        "status", F.when(announced & (duplicates >= 0), "OK").otherwise("MISMATCH"))


def layer_counts(manifest: DataFrame, bronze: DataFrame, silver: DataFrame, quarantined: DataFrame,
                 duplicates: DataFrame, on: str) -> DataFrame:
    """Per batch: manifest = Bronze, and Silver = Bronze - quarantined - duplicates. Inputs are (on, rows)."""
    named = {"manifest_rows": manifest, "bronze_rows": bronze, "silver_rows": silver,
             "quarantined_rows": quarantined, "duplicate_rows": duplicates}
    joined = None
    for name, counts in named.items():
        one = counts.select(on, F.col("rows").alias(name))
        joined = one if joined is None else joined.join(one, on, "full_outer")
    joined = joined.select(on, *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in named])
    balanced = ((F.col("manifest_rows") == F.col("bronze_rows"))
                & (F.col("silver_rows") == F.col("bronze_rows") - F.col("quarantined_rows") - F.col("duplicate_rows")))
    return joined.withColumn("status", F.when(balanced, "OK").otherwise("MISMATCH"))
