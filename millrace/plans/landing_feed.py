"""The driver's events and orders as delivered JSON Lines feeds, with the faults a landing area sees.

Day of month decides the fault of an events batch:
  ..3 truncated upload, then a redelivery whose manifest lists only the new files
  ..5 the same content sent twice, both copies listed
  ..7 truncated upload with the manifest of the intact batch
  ..9 no manifest
Error events above 60.00 are cut in the middle of the line; click events from the 15th on carry a new field.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.reconcile import control_totals
from millrace.plans.catalog import day, table
from millrace.registry import Feed
from millrace.session import materialize, new_folder
from millrace.sources import delivery, tables

EVENTS = Feed("shop", "events", "daily", "events", ("event_id",), {
    "event_id": "bigint", "event_ts": "timestamp", "user_id": "bigint", "event_type": "string",
    "amount": "decimal(18,2)", "props": "string"}, amount="amount", currency="event_type")
ORDERS = Feed("shop", "orders", "daily", "events", ("order_id",), {
    "order_id": "bigint", "customer_id": "bigint", "status": "string", "order_date": "date",
    "amount": "decimal(18,2)"}, amount="amount", currency="status")


def event_lines(events: DataFrame) -> DataFrame:
    """(business_date, line, ...) one JSON object per event, faults included."""
    record = events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_ts"), "user_id", "event_type",
        F.format_string("%.2f", "value").alias("amount"), "props", day("ts").alias("business_date"), "value")
    base = ["event_id", "event_ts", "user_id", "event_type", "amount", "props"]
    plain = F.to_json(F.struct(*base))
    extended = F.to_json(F.struct(*base, F.lit("web_browser").alias("device_type")))
    line = F.when((F.col("event_type") == "click") & (F.dayofmonth("business_date") >= 15), extended).otherwise(plain)
    cut = (F.col("event_type") == "error") & (F.col("value") > 60)
    half = F.expr("substring(_line, 1, cast(length(_line) / 2 as int))")
    return (record.withColumn("_line", line).withColumn("is_cut", cut)
            .withColumn("line", F.when(cut, half).otherwise(F.col("_line")))
            .select("business_date", "line", "event_id", "event_type", "amount", "is_cut",
                    (F.dayofmonth("business_date") % 10).alias("fault")))


def _manifests(files: DataFrame, totals: DataFrame, feed: Feed, announced: DataFrame) -> DataFrame:
    """Manifest rows from written files; `announced` holds (business_date, record_count)."""
    listed = files.groupBy("business_date").agg(F.sort_array(F.collect_list(F.struct(
        F.col("file_name").alias("name"), "records", "sha256"))).alias("files"),
        F.max("attempt").alias("_attempt"))
    sums = totals.groupBy("business_date").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(
        "currency", F.col("total").cast("string"))))).alias("amount_totals"))
    return (listed.join(announced, "business_date").join(sums, "business_date", "left")
            .select(F.lit("1.0").alias("schema_version"), F.lit(feed.source).alias("source"),
                    F.lit(feed.entity).alias("entity"), "business_date", "files", "record_count",
                    F.lit(feed.amount).alias("amount_field"), F.lit(feed.currency).alias("currency_field"),
                    "amount_totals", F.col("_attempt").alias("delivery_attempt")))


def _deliver_events(spark: SparkSession, sf_dir: str, landing: str) -> None:
    lines = materialize(event_lines(table(spark, sf_dir, "events")))
    fault = F.col("fault")
    truncated = fault.isin(3, 7) & (F.col("event_type") == "view")
    first = delivery.write_files(lines.filter(~truncated), landing, EVENTS.source, EVENTS.entity, 0, order="event_id")
    second = delivery.write_files(lines.filter(fault.isin(3, 5)), landing, EVENTS.source, EVENTS.entity, 1,
                                  order="event_id")
    written = (first.withColumn("attempt", F.lit(1)).unionByName(second.withColumn("attempt", F.lit(2)))
               .withColumn("fault", F.dayofmonth("business_date") % 10))
    effective = (written.filter((F.col("fault") != 9) & ((F.col("fault") != 3) | (F.col("attempt") == 2)))
                 .withColumn("sha256", F.when(F.col("fault") == 7, F.repeat(F.lit("0"), F.lit(64)))
                             .otherwise(F.col("sha256"))))
    copies = F.when(F.max("fault") == 5, 2).otherwise(1)
    announced = lines.groupBy("business_date").agg((F.count(F.lit(1)) * copies).alias("record_count"))
    readable = lines.filter(~F.col("is_cut"))
    sent_twice = readable.unionByName(readable.filter(fault == 5))
    totals = control_totals(sent_twice, ["business_date"], "amount", "event_type")
    delivery.write_manifests(_manifests(effective, totals, EVENTS, announced), landing)


def _deliver_orders(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """One batch per month's first day keeps the folder count that of a monthly feed."""
    orders = table(spark, sf_dir, "orders")
    record = orders.select(
        F.trunc(day("o_orderdate"), "MM").alias("business_date"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.format_string("%.2f", "o_totalprice").alias("amount"))
    names = [c for c in record.columns if c != "business_date"]
    lines = record.withColumn("line", F.to_json(F.struct(*names)))
    written = delivery.write_files(lines, landing, ORDERS.source, ORDERS.entity, 0, order="order_id")
    totals = control_totals(record, ["business_date"], "amount", "status")
    announced = written.groupBy("business_date").agg(F.sum("records").alias("record_count"))
    delivery.write_manifests(_manifests(written.withColumn("attempt", F.lit(1)), totals, ORDERS, announced), landing)


_DELIVERED: dict[tuple[str, str], str] = {}


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The delivered landing area; delivered once per application, as an upstream system would."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DELIVERED:
        root = new_folder(spark, "landing")
        _deliver_events(spark, sf_dir, root)
        _deliver_orders(spark, sf_dir, root)
        _DELIVERED[key] = root
    return _DELIVERED[key]


def new_lake(spark: SparkSession, label: str) -> tables.Lake:
    return tables.Lake(new_folder(spark, label))
