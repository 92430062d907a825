"""Several versions of the same tables: slices in any order, keys that stay, updates from what changed, contract rules."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import changes, clean, keys, quality, reconcile
from millrace.plans.catalog import cents, day, decimal, query, table
from millrace.plans.silver import across_dates
from millrace.registry import BY_ENTITY, DOMAINS
from millrace.sources.commits import Log, Version
from millrace.sources.tables import staged


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(year(l_shipdate) AS VARCHAR) AS y FROM lineitem
           WHERE NOT (year(l_shipdate) = 1997 AND l_linenumber > 3))
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, cents DESC, y DESC) = 1""")
def silver_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One winning line per order over all years, built in slices: odd years, even years, 1997 in a corrected delivery with
    fewer lines, and between them a run over 1998 that writes garbage and fails before its commit."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    cents("l_extendedprice").alias("cents"), F.year("l_shipdate").cast("string").alias("y"))
    schema = ", ".join(f"{n} {t}" for n, t in lines.dtypes)
    order = [F.desc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "cents", "y")]
    log = Log(spark, session.new_folder(spark, "slices"))
    years = {r["y"] for r in lines.select("y").distinct().collect()}
    corrected = lines.where("NOT (y = '1997' AND l_linenumber > 3)")
    for source, touched, fails in ((lines, {y for y in years if int(y) % 2}, False),
                                   (lines.withColumn("l_linenumber", F.col("l_linenumber") + 100), {"1998"}, True),
                                   (lines, {y for y in years if not int(y) % 2}, False), (corrected, {"1997"}, False)):
        commit = log.begin()
        across_dates(commit, source.where(F.col("y").isin(sorted(touched))), ["l_orderkey"], touched, schema, order, "y")
        if not fails:
            commit.finish()
    return log.read("rows", log.current(), schema=schema)


@query("""
WITH v AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders)
SELECT o_custkey, count(*) AS n_versions, count(*) AS n_keys, CAST(0 AS BIGINT) AS n_shared, CASE WHEN max(y) >= 2000 THEN true END AS kept
FROM v GROUP BY 1""")
def surrogate_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers first known by their orders since 2000, then with a version for each year since 1997, then for each year.

    Keys are drawn from a narrow range, so many collide. `kept`: the first key is that of the first version which came.
    """
    years = staged(table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y")).distinct())
    draw = lambda member, version, salt: F.shiftrightunsigned(F.xxhash64(member, version, F.lit(salt)), 42)
    steps = [years.where("y >= 2000").select("o_custkey", F.lit(None).cast("int").alias("y")).distinct(), years.where("y >= 1997"), years]
    store = spark.createDataFrame([], keys.STORE)
    for step in steps:
        store = store.unionByName(staged(keys.extend(store, keys.entries(step, "o_custkey", "y"), draw)))
    open_ = store.where(F.col("version") == keys.OPEN).select("member", F.col("sk").alias("open_sk"))
    came = F.when(F.col("version") >= "1997", F.col("version").cast("int"))
    shared = store.select("member", "sk").distinct().groupBy("sk").agg((F.count(F.lit(1)) - 1).alias("others"))
    named = store.where(F.col("version") != keys.OPEN).join(shared, "sk").groupBy("member").agg(
        F.count(F.lit(1)).alias("n_versions"), F.count_distinct("sk").alias("n_keys"), F.sum("others").alias("n_shared"), F.min_by("sk", came).alias("first_sk"))
    return named.join(open_, "member", "left").select(
        F.col("member").cast("bigint").alias("o_custkey"), "n_versions", "n_keys", "n_shared", (F.col("first_sk") == F.col("open_sk")).alias("kept"))


VIP = "c_mktsegment = 'BUILDING' AND c_acctbal > 9000"


@query(f"""
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, c_custkey IS NOT NULL AS vip, o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997 AS late
           FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE {VIP}) ON c_custkey = o_custkey),
m AS (SELECT month, bool_or(late) OR bool_or(vip) AND month >= '2000-05' AS rebuilt FROM o GROUP BY 1),
s AS (SELECT month, coalesce(CASE WHEN vip AND o_orderdate >= TIMESTAMP '2000-06-01' THEN 'VIP' END, c_mktsegment, 'unknown') AS segment, count(*) AS n,
             CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM o LEFT JOIN customer c ON c.c_custkey = o_custkey GROUP BY 1, 2)
SELECT month, segment, n, cents, rebuilt FROM s JOIN m USING (month)""")
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month and segment, first without the urgent ones of 1997 and with one version per customer, then updated.

    What changed comes from the difference of two Silver versions and two versions of the dimension; lineage and uses tell
    the months. `rebuilt` tells months whose files are new, so a month too many or too few shows.
    """
    silver, gold = (Log(spark, session.new_folder(spark, name)) for name in ("silver", "gold"))
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", cents("o_totalprice").alias("cents"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1997), "late")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("batch"))
    month = changes.month_of(day("o_orderdate"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), F.expr(VIP).alias("vip"))
    versions = lambda df, start, end, segment, sk: df.select(
        "o_custkey", F.lit(start).cast("timestamp").alias("valid_from"), F.lit(end).cast("timestamp").alias("valid_to"),
        F.lit(segment).alias("segment") if segment else F.col("segment"), F.xxhash64("o_custkey", F.lit(sk)).alias("sk"))
    start, turn = "1900-01-01", "2000-06-01"
    dims = [versions(known, start, None, None, 0),
            versions(known.where("NOT vip"), start, None, None, 0).unionByName(versions(known.where("vip"), start, turn, None, 0))
            .unionByName(versions(known.where("vip"), turn, None, "VIP", 1))]

    def mart(rows: DataFrame, dim: DataFrame) -> DataFrame:
        held = rows.withColumn("at", F.col("o_orderdate").cast("timestamp")).alias("r").join(dim.alias("d"), (
            F.col("r.o_custkey") == F.col("d.o_custkey")) & (F.col("r.at") >= F.col("d.valid_from"))
            & (F.col("d.valid_to").isNull() | (F.col("r.at") < F.col("d.valid_to"))), "left")
        return held.groupBy(month.alias("month"), F.coalesce("segment", F.lit("unknown")).alias("segment")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))

    def deliver(rows: DataFrame) -> Version:
        commit = silver.begin()
        commit.replace("orders", rows, "batch")
        return commit.finish()

    def update(now: Version, then: Version, dim: DataFrame) -> Version:
        commit = gold.begin()
        first = not commit.base.number
        changed = now.changed(then, "orders")
        fresh = changes.lineage(silver.read("orders", now, changed), "batch", month)
        lineage = fresh if first else gold.read("lineage", commit.base).where(~F.col("batch_date").isin(sorted(changed))).unionByName(fresh)
        commit.put("lineage", lineage)
        days: dict[str, set[str]] = {}
        for r in commit.read("lineage").collect():            # one row per batch and month
            days.setdefault(r["month"], set()).add(r["batch_date"])
        touched = {m for m, batches in days.items() if batches & changed}
        rows_of = lambda months: silver.read("orders", now, set().union(*[days[m] for m in months])).where(month.isin(sorted(months)))
        commit.replace("uses", changes.uses(rows_of(touched), ["o_custkey"], "o_orderdate", month), "month", touched)
        commit.put("dim", dim)
        if not first:
            spans = changes.changed_intervals(gold.read("dim", commit.base), commit.read("dim"), "o_custkey", "sk", ["segment"])
            touched |= {r["month"] for r in changes.months_in_use(commit.read("uses"), "o_custkey", spans).collect()}
        commit.replace("mart", mart(rows_of(touched), commit.read("dim")), "month", touched)
        return commit.finish()

    one = deliver(orders.where("batch <> 'late'"))
    before = update(one, Version(), dims[0])
    after = update(deliver(orders.where("batch = 'late'")), one, dims[1])
    rebuilt = F.col("month").isin(sorted(after.changed(before, "mart")))
    return gold.read("mart", after).select("month", "segment", "n", "cents", rebuilt.alias("rebuilt"))


def _coded(entity: str) -> list[tuple[str, list[str]]]:
    return [(column, list(values)) for column, values in DOMAINS[entity].items()]


DOMAIN_SQL = "\nUNION ALL\n".join(
    f"SELECT '{entity}' AS feed, '{column}_domain' AS rule, count(*) AS rows_checked, "
    f"count(*) FILTER (WHERE o_orderkey % {len(values) + 1 + i} >= {len(values)}) AS rows_failed FROM orders"
    for entity in DOMAINS for i, (column, values) in enumerate(_coded(entity)))


@query(DOMAIN_SQL)
def domain_all_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten feeds' rows made of orders, whose codes come from the order's number and are now and then none of the contract's;
    the rules that the registry binds to each feed count them in one pass a feed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    found = []
    for entity in DOMAINS:
        codes = []
        for i, (column, values) in enumerate(_coded(entity)):
            listed = F.array(*[F.lit(v) for v in [*values, *["?"] * (i + 1)]])
            codes.append(F.get(listed, (F.col("o_orderkey") % (len(values) + 1 + i)).cast("int")).alias(column))
        rules = quality.contract_rules({c: "string" for c in BY_ENTITY[entity].columns}, (), DOMAINS[entity])
        bound = [r for r in rules if r.name.endswith("_domain")]
        found.append(quality.rule_results(orders.select(*codes), bound).withColumn("feed", F.lit(entity)))
    return reduce(DataFrame.unionByName, found).select("feed", "rule", "rows_checked", "rows_failed")


@query("""
WITH r AS (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag AS c, l_orderkey, l_linenumber, l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS a, l_quantity <= 1 AS bad FROM lineitem),
s AS (SELECT * FROM r WHERE NOT bad QUALIFY row_number() OVER (PARTITION BY d, l_orderkey, l_linenumber ORDER BY l_quantity DESC, a DESC, c DESC) = 1),
j AS (SELECT d, coalesce(c, '*') AS c, count(*) AS landed_rows, count_if(bad) AS quarantined_rows, CASE WHEN c IS NOT NULL THEN sum(a) END AS landed_total FROM r GROUP BY GROUPING SETS ((d, c), (d))),
k AS (SELECT d, coalesce(c, '*') AS c, count(*) AS silver_rows, CASE WHEN c IS NOT NULL THEN sum(a) END AS silver_total FROM s GROUP BY GROUPING SETS ((d, c), (d))),
m AS (SELECT d, '*' AS c, count(*) AS manifest_rows, NULL AS manifest_total FROM r WHERE NOT (l_quantity >= 50 AND day(d) = 7) GROUP BY d
      UNION ALL SELECT d, c, NULL, sum(CASE WHEN l_quantity >= 50 AND day(d) = 9 THEN a + 1 ELSE a END) FROM r GROUP BY d, c)
SELECT j.d AS batch_date, j.c AS currency, landed_rows, CAST(quarantined_rows AS BIGINT) AS quarantined_rows, coalesce(silver_rows, 0) AS silver_rows, manifest_rows,
  CAST(manifest_total AS DECIMAL(38,2)) AS manifest_total, CAST(landed_total AS DECIMAL(38,2)) AS landed_total, CAST(silver_total AS DECIMAL(38,2)) AS silver_total,
  CAST(landed_rows - quarantined_rows - coalesce(silver_rows, 0) AS BIGINT) AS duplicate_rows,
  CASE WHEN j.c = '*' AND coalesce(manifest_rows, 0) = landed_rows OR j.c <> '*' AND manifest_total = landed_total THEN 'OK' ELSE 'MISMATCH' END AS status
FROM j LEFT JOIN k ON k.d = j.d AND k.c = j.c LEFT JOIN m ON m.d = j.d AND m.c = j.c""")
def layer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by ship date through the layers, return flags as currencies. The sender's numbers leave out large lines on the 7th
    of a month and add to their amounts on the 9th."""
    lines = table(spark, sf_dir, "lineitem").select(
        day("l_shipdate").alias("batch_date"), F.col("l_returnflag").alias("c"), "l_orderkey", "l_linenumber", "l_quantity", decimal("l_extendedprice").alias("a"))
    judged = quality.apply_rules(lines, [quality.Rule("too_few", "business", F.col("l_quantity") <= 1)])
    best = clean.winners(judged.where("reason IS NULL"), ["batch_date", "l_orderkey", "l_linenumber"], [F.desc("l_quantity"), F.desc("a"), F.desc("c")])
    sums = lambda df, **counted: reconcile.batch_sums(df, "batch_date", F.col("a"), F.col("c"), **counted)
    large = F.col("l_quantity") >= 50
    announced = sums(lines.withColumn("a", F.when(large & (F.dayofmonth("batch_date") == 9), F.col("a") + 1).otherwise(F.col("a"))),
                     sent=~(large & (F.dayofmonth("batch_date") == 7)))
    manifest = announced.select("batch_date", "currency", F.when(F.col("currency") == reconcile.WHOLE_BATCH, F.col("sent")).alias("manifest_rows"),
                                F.col("total").alias("manifest_total"))
    return reconcile.layer_totals(sums(judged, landed_rows=F.lit(True), quarantined_rows=F.col("reason").isNotNull()),
                                  sums(best, silver_rows=F.lit(True)), manifest, "batch_date")
