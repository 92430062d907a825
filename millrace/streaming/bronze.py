"""Bronze: land JSON Lines exactly as delivered, each file once, as a run-to-completion stream."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.registry import Feed
from millrace.sources import tables
from millrace.sources.files import exists, glob_exists

# Data files, and the date folders their paths carry.
DATA_FILES = "*.jsonl"
BATCH_DATE_PATTERN = r"/(\d{4}/\d{2}/\d{2})/[^/]+$"
LINEAGE = {"_source_file": "string", "_file_modification_time": "timestamp", "_batch_date": "date",
           "_ingest_ts": "timestamp", "_run_id": "string"}
COLUMN_LOG = "column_name string, discovered_in string"
MAX_BATCH_BYTES = 512 * 1024 ** 3


def read_landing(spark: SparkSession, landing_root: str, feed: Feed,
                 max_bytes_per_trigger: int = MAX_BATCH_BYTES) -> DataFrame:
    """Stream of raw lines. Old files stay eligible, so a batch delivered weeks late is still picked up."""
    return (spark.readStream.format("text")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", DATA_FILES)
            .option("maxFileAge", "36500d")
            .option("maxBytesPerTrigger", str(max_bytes_per_trigger))
            .load(feed.under(landing_root) + "/"))


def batch_date(path: Column | str) -> Column:
    """Date from .../yyyy/mm/dd/<file>; NULL when the path carries none."""
    path = F.col(path) if isinstance(path, str) else path
    return F.try_to_date(F.regexp_extract(path, BATCH_DATE_PATTERN, 1), "yyyy/MM/dd")


def add_lineage(df: DataFrame, run_id: str) -> DataFrame:
    """Where each row came from, when, and in which run."""
    file = F.col("_metadata")
    return df.withColumns({
        "_source_file": file["file_path"],
        "_file_modification_time": file["file_modification_time"],
        "_batch_date": batch_date(file["file_path"]),
        "_ingest_ts": F.now(),
        "_run_id": F.lit(run_id),
    })


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds `fields` map<string,string>: every value as text, NULL for a line that is no JSON object.

    Blank lines are no records.
    """
    return (lines.filter(F.trim("value") != "")
            .withColumn("fields", F.from_json("value", "map<string,string>")))


def project_fields(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """Known fields as STRING columns, the rest as JSON text in `_rescued_data`.

    `_raw` keeps a line only where parsing found nothing, so that a quarantined record can be shown.
    """
    known = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<string>")
    unknown = F.map_filter("fields", lambda name, _: ~F.array_contains(known, name))
    lineage = [c for c in LINEAGE if c in parsed.columns]
    return parsed.select(
        *[F.try_element_at("fields", F.lit(c)).alias(c) for c in columns],
        F.when(F.size(unknown) > 0, F.to_json(unknown, {"ignoreNullFields": "false"})).alias("_rescued_data"),
        F.when(F.col("fields").isNull() | (F.size("fields") == 0), F.col("value")).alias("_raw"),
        *lineage)


def column_log(lake: tables.Lake, feed: Feed) -> str:
    """A folder of its own for every feed, as feeds that run side by side append to it."""
    return feed.under(lake.path("ops", "bronze_columns"))


def known_columns(spark: SparkSession, lake: tables.Lake, feed: Feed) -> list[str]:
    """Contract columns plus those discovered by earlier runs, in order of discovery."""
    path = column_log(lake, feed)
    columns = list(feed.columns)
    if exists(spark, path):
        found = (spark.read.schema(COLUMN_LOG).parquet(path)
                 .groupBy("column_name").agg(F.min("discovered_in").alias("first"))
                 .orderBy("first", "column_name").collect())
        taken = {c.lower() for c in columns}
        columns += [r["column_name"] for r in found if r["column_name"].lower() not in taken]
    return columns


def _discover(spark: SparkSession, lake: tables.Lake, feed: Feed, batch_id: int) -> bool:
    """Logs unexpected field names a micro-batch left in `_rescued_data`. TRUE when columns were added.

    Reads one column of the files the micro-batch wrote, with a given schema and no footer pass. All names are
    taken, however many; a table's columns do not differ in case alone, so of names that do the one met most
    often becomes the column and its twins stay in `_rescued_data`, as do blank names and those that
    begin with an underscore.
    """
    target = lake.path("bronze", feed.entity)
    pattern = f"{target}/*/_ingest_batch={batch_id}"
    if not glob_exists(spark, pattern):
        return False
    rescued = spark.read.schema("_rescued_data string").parquet(pattern).filter(F.col("_rescued_data").isNotNull())
    names = (rescued.select(F.explode(F.json_object_keys("_rescued_data")).alias("column_name"))
             .groupBy("column_name").count()
             .filter(~F.col("column_name").startswith("_") & (F.trim("column_name") != ""))
             .orderBy(F.desc("count"), "column_name"))
    taken = {c.lower() for c in known_columns(spark, lake, feed)}
    rows = []
    for row in names.collect():
        if row["column_name"].lower() not in taken:
            taken.add(row["column_name"].lower())
            rows.append((row["column_name"], f"{batch_id:012d}"))
    if rows:
        spark.createDataFrame(rows, COLUMN_LOG).coalesce(1).write.mode("append").parquet(column_log(lake, feed))
    return bool(rows)


def ingest(spark: SparkSession, lake: tables.Lake, feed: Feed, run_id: str, evolve: str = "add",
           max_bytes_per_trigger: int = MAX_BATCH_BYTES, landing_root: str | None = None) -> None:
    """All new files of one feed, then stop; a file is ingested once however often this runs.

    evolve="add":    unexpected fields become columns, earlier rows read NULL.
    evolve="rescue": unexpected fields stay in `_rescued_data`.
    Each micro-batch owns the partitions (_batch_date, _ingest_batch) it writes, so a repeated micro-batch
    replaces its own rows. Nothing is shuffled: a file belongs to one date, and tasks write what they read.
    """
    if evolve not in ("add", "rescue"):
        raise ValueError(f"unknown evolution mode {evolve}")
    target = lake.path("bronze", feed.entity)

    def write(batch: DataFrame, batch_id: int) -> None:
        def store(columns: list[str]) -> None:
            (project_fields(parse_lines(batch), columns)
             .withColumn("_ingest_batch", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch_date", "_ingest_batch").parquet(target))

        session = batch.sparkSession
        store(known_columns(session, lake, feed))
        if evolve == "add" and _discover(session, lake, feed, batch_id):
            store(known_columns(session, lake, feed))

    query = (add_lineage(read_landing(spark, landing_root or lake.landing, feed, max_bytes_per_trigger), run_id)
             .writeStream.queryName(f"bronze_{feed.entity}")
             .option("checkpointLocation", lake.checkpoint(f"bronze/{feed.entity}"))
             .trigger(availableNow=True)
             .foreachBatch(write).start())
    query.awaitTermination()


def read_bronze(spark: SparkSession, lake: tables.Lake, feed: Feed) -> DataFrame:
    """The table under the schema its column log gives: no file footer is read to find it out."""
    names = [*known_columns(spark, lake, feed), "_rescued_data", "_raw"]
    lineage = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in LINEAGE.items()) + ", _ingest_batch bigint")
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], *lineage.schema])
    return spark.read.schema(schema).parquet(lake.path("bronze", feed.entity))
