"""Landing to Bronze, reconciliation and delivery checks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import calendar as cal
from millrace.operators import clean, reconcile
from millrace.plans import bronze_run
from millrace.plans.catalog import day, decimal, query, table
from millrace.plans.landing_feed import EVENTS, ORDERS, landing, new_lake
from millrace.sources import manifests, tables
from millrace.streaming.bronze import ingest, read_bronze

# How often a line of a day is in Bronze, and how often in the files its manifest lists.
DELIVERED_SQL = """
WITH lines AS (
  SELECT CAST(ts AS DATE) AS d, event_id, event_type, value, props, user_id, ts,
         day(ts) % 10 AS fault,
         (event_type = 'error' AND value > 60) AS is_cut,
         (event_type = 'view' AND day(ts) % 10 IN (3, 7)) AS lost
  FROM events),
copies AS (
  SELECT *, CASE WHEN fault IN (3, 5) THEN 1 ELSE 0 END + CASE WHEN lost THEN 0 ELSE 1 END AS n_bronze,
    CASE WHEN fault = 9 THEN 0 WHEN fault = 3 THEN 1 WHEN fault = 5 THEN 2 WHEN lost THEN 0 ELSE 1 END AS n_listed,
    CASE WHEN fault = 9 THEN 0 WHEN fault = 5 THEN 2 ELSE 1 END AS n_announced
  FROM lines)
"""
RECONCILED_SQL = DELIVERED_SQL + """,
reconciled AS (
  SELECT 'events' AS entity, d AS batch_date, CAST(sum(n_announced) AS BIGINT) AS manifest_records,
         CAST(sum(n_listed) AS BIGINT) AS bronze_records,
         CAST(sum(n_bronze - n_listed) AS BIGINT) AS unlisted_records,
         CASE WHEN sum(n_announced) = sum(n_listed) THEN 'OK' ELSE 'MISMATCH' END AS status
  FROM copies GROUP BY d)
"""


_LAKES: dict[tuple[str, str, str], tables.Lake] = {}


def ingested(spark: SparkSession, sf_dir: str, evolve: str = "add") -> tables.Lake:
    """A lake whose Bronze holds the delivered events; ingested once per application and mode."""
    key = (spark.sparkContext.applicationId, sf_dir, evolve)
    if key not in _LAKES:
        lake = new_lake(spark, "lake")
        ingest(spark, lake, EVENTS, "run-1", evolve=evolve, landing_root=landing(spark, sf_dir))
        _LAKES[key] = lake
    return _LAKES[key]


def bronze(spark: SparkSession, sf_dir: str, evolve: str = "add") -> DataFrame:
    return read_bronze(spark, ingested(spark, sf_dir, evolve), EVENTS)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.manifest_listing(manifests.read_manifests(spark, landing(spark, sf_dir), EVENTS))


def reconciled(spark: SparkSession, sf_dir: str, run_id: str = "run-1") -> DataFrame:
    return reconcile.reconcile(bronze(spark, sf_dir), listing(spark, sf_dir), "events", run_id)


@query(DELIVERED_SQL + """
SELECT d AS batch_date, CAST(sum(n_bronze) AS BIGINT) AS n FROM copies GROUP BY d""")
def bronze_ingest_counts(spark, sf_dir):
    """Ingests twice into a fresh Bronze table: the second run finds nothing new."""
    lake = new_lake(spark, "lake")
    for run in ("first", "second"):
        ingest(spark, lake, EVENTS, run, landing_root=landing(spark, sf_dir))
    return read_bronze(spark, lake, EVENTS).groupBy(F.col("_batch_date").alias("batch_date")).agg(
        F.count(F.lit(1)).alias("n"))


@query(DELIVERED_SQL + """
SELECT d AS batch_date, strftime(d, '%Y/%m/%d') AS folder, 'run-1' AS run_id,
       CAST(sum(n_bronze) AS BIGINT) AS n,
       CAST(sum(CASE WHEN is_cut THEN 0 ELSE n_bronze END) AS BIGINT) AS n_on_date,
       min(CASE WHEN NOT is_cut AND n_bronze > 0 THEN event_id END) AS first_id,
       max(CASE WHEN NOT is_cut AND n_bronze > 0 THEN event_id END) AS last_id
FROM copies GROUP BY d""")
def bronze_lineage_batch_date(spark, sf_dir):
    folder = F.regexp_extract("_source_file", r"/(\d{4}/\d{2}/\d{2})/[^/]+$", 1)
    return (bronze(spark, sf_dir)
            .groupBy(F.col("_batch_date").alias("batch_date"), folder.alias("folder"), F.col("_run_id").alias("run_id"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.substring("event_ts", 1, 10) == F.col("_batch_date").cast("string")).alias("n_on_date"),
                 F.min(F.col("event_id").cast("bigint")).alias("first_id"),
                 F.max(F.col("event_id").cast("bigint")).alias("last_id")))


@query(RECONCILED_SQL + "SELECT * FROM reconciled")
def bronze_reconcile(spark, sf_dir):
    return reconciled(spark, sf_dir).drop("run_id", "checked_at")


@query(RECONCILED_SQL + """
SELECT count(*) AS checked, CAST(count_if(status <> 'OK') AS BIGINT) AS mismatches FROM reconciled""")
def reconcile_gate(spark, sf_dir):
    return reconcile.gate_counts(reconciled(spark, sf_dir))


@query(DELIVERED_SQL + """
SELECT d AS batch_date, 'device_type' AS field, 'web_browser' AS field_value, CAST(sum(n_bronze) AS BIGINT) AS n
FROM copies WHERE event_type = 'click' AND day(d) >= 15 GROUP BY d""")
def bronze_rescued_fields(spark, sf_dir):
    """With rescue mode an unexpected field stays readable as JSON text."""
    rescued = bronze(spark, sf_dir, "rescue").filter(F.col("_rescued_data").isNotNull())
    pairs = rescued.select(F.col("_batch_date").alias("batch_date"),
                           F.explode(F.from_json("_rescued_data", "map<string,string>")).alias("field", "field_value"))
    return pairs.groupBy("batch_date", "field", "field_value").agg(F.count(F.lit(1)).alias("n"))


@query(DELIVERED_SQL + """
SELECT d AS batch_date, CAST(sum(CASE WHEN event_type = 'click' AND day(d) >= 15 THEN n_bronze ELSE 0 END) AS BIGINT) AS n_set,
       CAST(sum(n_bronze) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_rescued
FROM copies GROUP BY d""")
def bronze_new_columns(spark, sf_dir):
    """With add mode it becomes a column; older rows read NULL."""
    return bronze(spark, sf_dir).groupBy(F.col("_batch_date").alias("batch_date")).agg(
        F.count("device_type").alias("n_set"), F.count(F.lit(1)).alias("n"), F.count("_rescued_data").alias("n_rescued"))


@query(DELIVERED_SQL + """
SELECT d AS batch_date, CAST(sum(n_bronze) AS BIGINT) AS malformed FROM copies WHERE is_cut GROUP BY d""")
def bronze_malformed(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return (rows.filter(clean.all_null(list(EVENTS.columns)))
            .groupBy(F.col("_batch_date").alias("batch_date")).agg(F.count(F.lit(1)).alias("malformed")))


@query(DELIVERED_SQL + """,
texts AS (
  SELECT d, n_bronze, '{"event_id":' || event_id || ',"event_ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         || '","user_id":' || user_id || ',"event_type":"' || event_type || '","amount":"'
         || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '","props":"' || replace(props, '"', '\\"') || '"}' AS t
  FROM copies WHERE is_cut)
SELECT d AS batch_date, substr(t, 1, CAST(floor(length(t) / 2) AS BIGINT)) AS raw_line, CAST(sum(n_bronze) AS BIGINT) AS n
FROM texts WHERE n_bronze > 0 GROUP BY ALL""")
def raw_line_recovery(spark, sf_dir):
    return (bronze(spark, sf_dir).filter(F.col("_raw").isNotNull())
            .groupBy(F.col("_batch_date").alias("batch_date"), F.col("_raw").alias("raw_line"))
            .agg(F.count(F.lit(1)).alias("n")))


@query(DELIVERED_SQL + """
SELECT d AS batch_date, CAST(sum(n_bronze) AS BIGINT) AS n FROM copies WHERE fault = 9 GROUP BY d""")
def no_manifest(spark, sf_dir):
    read = manifests.read_manifests(spark, landing(spark, sf_dir), EVENTS)
    return reconcile.without_manifest(bronze(spark, sf_dir), read).withColumnRenamed("rows", "n")


@query(DELIVERED_SQL + """,
days AS (SELECT d, max(fault) AS fault, sum(n_announced) AS announced, sum(n_listed) AS listed,
                sum(CASE WHEN lost AND n_announced > 0 AND fault = 7 THEN 1 ELSE 0 END) AS lost_rows
         FROM copies WHERE fault <> 9 GROUP BY d)
SELECT d AS batch_date, CAST(announced AS BIGINT) AS record_count, CAST(listed AS BIGINT) AS delivered_records,
       CASE WHEN fault = 7 THEN 'checksum' END AS reason, fault <> 7 AS accepted
FROM days""")
def batch_verify_files(spark, sf_dir):
    """Counts and checksums of the files themselves, control totals of their parsed rows."""
    return bronze_run.verify_feed(spark, ingested(spark, sf_dir), EVENTS, landing(spark, sf_dir)).select(
        F.col("business_date").alias("batch_date"), "record_count", "delivered_records", "reason", "accepted")


@query(RECONCILED_SQL + """
SELECT r.run_id, status, count(*) AS batches, CAST(sum(bronze_records) AS BIGINT) AS bronze_records
FROM reconciled, (VALUES ('run-1'), ('run-2')) r(run_id) GROUP BY ALL""")
def ops_append_ordered(spark, sf_dir):
    """Results of two runs are appended; repeating a run replaces its own rows."""
    path = new_lake(spark, "ops").path("ops", "bronze_reconciliation")
    for run_id in ("run-1", "run-2", "run-2"):
        tables.append_run(reconciled(spark, sf_dir, run_id), path)
    return (tables.read_table(spark, path).groupBy("run_id", "status")
            .agg(F.count(F.lit(1)).alias("batches"), F.sum("bronze_records").alias("bronze_records"))
            .orderBy("run_id", "status"))


@query(RECONCILED_SQL + """,
both_feeds AS (
  SELECT entity, batch_date, manifest_records, bronze_records, unlisted_records, status FROM reconciled
  UNION ALL
  SELECT 'orders', CAST(date_trunc('month', o_orderdate) AS DATE), count(*), count(*), CAST(0 AS BIGINT), 'OK'
  FROM orders GROUP BY 2)
SELECT * FROM both_feeds""")
def registry_run(spark, sf_dir):
    """Two registered feeds through one run; the stored results are what the gate would judge."""
    lake = new_lake(spark, "lake")
    report = bronze_run.run(spark, lake, [EVENTS, ORDERS], "run-9", gate=False, landing_root=landing(spark, sf_dir))
    return bronze_run.stored_results(spark, lake, report.run_id).select(
        "entity", "batch_date", "manifest_records", "bronze_records", "unlisted_records", "status")


@query("""
SELECT 'orders' AS entity, CAST(o_orderdate AS DATE) AS d, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 2
UNION ALL
SELECT 'lineitem', CAST(l_shipdate AS DATE), count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem GROUP BY 2""")
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        day("o_orderdate").alias("d"), F.lit("orders").alias("entity"), F.col("o_orderkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), day("l_shipdate").alias("d"), F.lit("lineitem").alias("entity"))
    return orders.unionByName(lines).groupBy("entity", "d").agg(
        F.count(F.lit(1)).alias("n"), F.sum("key").alias("key_sum"))


@query("""
SELECT CAST(l_shipdate AS DATE) AS batch_date, coalesce(CASE WHEN l_quantity > 2 THEN l_returnflag END, 'None') AS currency,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM lineitem WHERE NOT (l_linestatus = 'F' AND l_quantity = 1) GROUP BY 1, 2""")
def control_totals(spark, sf_dir):
    """Unparseable amounts are skipped, a missing currency is its own bucket."""
    lines = table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("batch_date"),
        F.when(F.col("l_quantity") > 2, F.col("l_returnflag")).alias("ccy"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") == 1), "n/a")
        .otherwise(decimal("l_extendedprice").cast("string")).alias("amount_text"))
    return reconcile.control_totals(lines, ["batch_date"], "amount_text", "ccy")


@query("""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS f, count(*) AS n, sum(o_orderkey) AS s
           FROM orders GROUP BY 1, 2),
l AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS f, count(*) AS n, sum(o_orderkey) AS s
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2),
b AS (SELECT l.d, sum(l.n) AS announced, coalesce(sum(o.n), 0) AS delivered,
             count_if(o.n IS NULL) AS missing, count_if(o.n <> l.n) AS cnt, count_if(o.s <> l.s) AS chk
      FROM l LEFT JOIN o ON o.d = l.d AND o.f = l.f GROUP BY l.d)
SELECT d AS batch_date, CAST(announced AS BIGINT) AS announced_records, CAST(delivered AS BIGINT) AS delivered_records,
       CASE WHEN missing > 0 THEN 'missing_file' WHEN cnt > 0 THEN 'file_count' WHEN chk > 0 THEN 'checksum' END AS reason,
       missing = 0 AND cnt = 0 AND chk = 0 AS accepted
FROM b""")
def batch_verify_whole_reject(spark, sf_dir):
    """Order days as batches with one file per priority; announced is what has line items."""
    orders = table(spark, sf_dir, "orders").select(
        day("o_orderdate").alias("business_date"), F.col("o_orderpriority").alias("file_name"), "o_orderkey")
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    described = [F.count(F.lit(1)).alias("records"), F.sum("o_orderkey").cast("string").alias("sha256")]
    delivered = orders.groupBy("business_date", "file_name").agg(*described)
    announced = (orders.join(shipped, "o_orderkey", "left_semi").groupBy("business_date", "file_name").agg(*described)
                 .withColumnRenamed("records", "file_records"))
    whole = announced.groupBy("business_date").agg(F.sum("file_records").alias("record_count"))
    return reconcile.verify_batches(announced.join(whole, "business_date"), delivered, ["business_date"]).select(
        F.col("business_date").alias("batch_date"), "announced_records", "delivered_records", "reason", "accepted")


@query("SELECT sha256(text) AS sha256, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_file_digest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"))
    return reconcile.duplicate_digests(docs, [])


@query("""
WITH latest AS (SELECT CAST(l_shipdate AS DATE) AS d, max(l_suppkey) AS f FROM lineitem GROUP BY 1)
SELECT d AS batch_date, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM lineitem JOIN latest ON CAST(l_shipdate AS DATE) = d AND l_suppkey = f GROUP BY d""")
def effective_files(spark, sf_dir):
    """The supplier stands for the file; the day's highest is what the latest manifest lists."""
    lines = table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("batch_date"), F.col("l_suppkey").alias("file_id"), "l_orderkey")
    listed = lines.groupBy("batch_date").agg(F.max("file_id").alias("file_id"))
    return manifests.effective_rows(lines, listed, ["batch_date", "file_id"]).groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query("""
SELECT o_orderstatus AS source, o_orderpriority AS entity, CAST(o_orderdate AS DATE) AS business_date, count(*) AS n,
       CAST(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INT) AS source_rank
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' GROUP BY ALL""")
def discover_ordered(spark, sf_dir):
    batches = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("entity"),
        day("o_orderdate").alias("business_date")).agg(F.count(F.lit(1)).alias("n"))
    return manifests.discover(batches, "1996-01-01", "1997-12-31", order=["P", "O"])


@query("""
SELECT 'doc/' || doc_id AS path, CASE WHEN lang = 'fr' THEN 'conflict' ELSE 'new' END AS outcome
FROM documents WHERE lang <> 'en'""")
def ledger_skip_conflict(spark, sf_dir):
    """English documents are in the ledger, French ones under an older content, the rest are new."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("doc/"), F.col("doc_id"))
    offered = docs.select(path.alias("path"), F.sha2("text", 256).alias("sha256"))
    older = F.when(F.col("lang") == "fr", F.concat("text", F.lit("#"))).otherwise(F.col("text"))
    ledger = docs.filter(F.col("lang").isin("en", "fr")).select(path.alias("path"), F.sha2(older, 256).alias("sha256"))
    pending = reconcile.new_deliveries(offered, ledger)
    conflicts = reconcile.ledger_conflicts(pending, ledger).select("path").withColumn("_conflict", F.lit(True))
    return pending.join(conflicts, "path", "left").select(
        "path", F.when(F.col("_conflict"), "conflict").otherwise("new").alias("outcome"))


@query("""
WITH b AS (SELECT event_type AS entity, CAST(ts AS DATE) AS d,
                  (min(event_id) + 40 * CAST(floor(max(value)) AS BIGINT)) * 1000000000 + min(event_id) AS arrival
           FROM events GROUP BY 1, 2)
SELECT entity, d AS batch_date, coalesce(max(d) OVER (PARTITION BY entity ORDER BY arrival
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > d, false) AS is_late FROM b""")
def late_batches(spark, sf_dir):
    """A batch with a large value arrives some batches later than its date."""
    batches = (table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("entity"), day("ts").alias("batch_date"))
               .agg(((F.min("event_id") + 40 * F.floor(F.max("value"))) * 1000000000 + F.min("event_id")).alias("arrival")))
    return manifests.late_batches(batches, ["entity"], "batch_date", "arrival").drop("arrival")


@query("""
SELECT l_suppkey AS folder, count(*) AS n FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1""")
def superseded_skip(spark, sf_dir):
    ledger = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("folder"),
        F.when(F.col("s_acctbal") > 5000, "redelivery").otherwise("delivery").alias("kind"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("folder"))
    return reconcile.skip_superseded(lines, ledger).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH m AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS f, count(DISTINCT o_orderkey) AS n_orders,
                  count(DISTINCT l_orderkey) AS n_listed
           FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT d AS batch_date, CAST(sum(n_orders) AS BIGINT) AS record_count, CAST(sum(n_listed) AS BIGINT) AS files_sum,
       sum(n_orders) = sum(n_listed) AS sum_matches FROM m GROUP BY d""")
def manifest_sum(spark, sf_dir):
    """A day's manifest lists one file per priority, counted from line items."""
    orders = table(spark, sf_dir, "orders")
    with_lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    marked = orders.join(with_lines.withColumn("_has", F.lit(1)), "o_orderkey", "left")
    per_file = marked.groupBy(day("o_orderdate").alias("batch_date"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count("_has").alias("records"))
    documents = per_file.groupBy("batch_date").agg(
        F.sum("n").alias("record_count"),
        F.collect_list(F.struct(F.col("o_orderpriority").alias("name"), "records")).alias("files"))
    return reconcile.manifest_sum_check(documents).select("batch_date", "record_count", "files_sum", "sum_matches")


@query("""
WITH span AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders),
cal AS (SELECT CAST(x AS DATE) AS d FROM span, generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY) t(x)),
e AS (SELECT DISTINCT p.o_orderpriority AS entity, d FROM cal, (SELECT DISTINCT o_orderpriority FROM orders) p
      WHERE isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ('01-01', '05-01', '12-25', '12-26')),
a AS (SELECT DISTINCT o_orderpriority AS entity, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT coalesce(e.entity, a.entity) AS entity, coalesce(e.d, a.d) AS business_date,
       CASE WHEN a.d IS NULL THEN 'missing' ELSE 'unexpected' END AS finding
FROM e FULL JOIN a ON e.entity = a.entity AND e.d = a.d WHERE e.d IS NULL OR a.d IS NULL""")
def completeness_gaps(spark, sf_dir):
    """Priorities as business-day feeds: days without a batch and batches on closing days."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity"), day("o_orderdate").alias("business_date"))
    first, last = orders.agg(F.min("business_date"), F.max("business_date")).first()
    calendar = cal.calendar_of(orders, F.col("business_date")).select("date", "is_business_day", "is_first_business_day")
    feeds = orders.select("entity").distinct().withColumn("cadence", F.lit("business_day")).withColumn(
        "first_day_offset", F.lit(0))
    expected = reconcile.expected_batches(feeds, F.lit(first), F.lit(last), calendar)
    return reconcile.completeness(expected, orders)
