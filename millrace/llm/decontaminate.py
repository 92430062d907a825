"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's fingerprints are the smallest hash of every `window - gram + 1` consecutive runs of `gram` words. Two texts that
share a span of `window` words have all runs of that span in common, so they share its smallest one: joining
fingerprints finds every document that holds a whole benchmark window, at a fraction of the positions. Items of
fewer words than a window are one window of their own length; for each such length that occurs, documents
give all runs of that length.

Hits are then extended: in the documents found, every position's window is compared with all windows of the benchmark by
two independent 64-bit hashes of its words. What is joined are distinct windows, so a passage that many items hold
meets a document once; only afterwards is a document's set of windows turned into items.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

SMALL, LARGE = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What words are made of, in either case. Fixed value. The ASCII characters between words are named one by one: Java
#: looks those up in one table, but asks every range of a class in turn, which takes five times as long.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def spelled(text: Column) -> Column:
    """Words of a text as they are written; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def words(text: str) -> Column:
    """Words of a text with A-Z lowered; none for null."""
    return spelled(F.translate(text, LARGE, SMALL))


def runs(array: str, length: int, make) -> Column:
    """make(list of `length` neighbours) for every position of an array column; null where it is shorter."""
    column = F.col(array)
    return F.when(F.size(column) >= length, F.transform(
        F.sequence(F.lit(0), F.size(column) - length),
        lambda i: make([F.get(column, i + k) for k in range(length)])))


# Arrays are exploded with the outer form: for the other one Spark infers a filter on the array's size, and pushing that
# below the projections that build the array would write their expressions out into one another.
def fingerprints(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """`texts` with its words replaced by one row per distinct fingerprint, `fp`."""
    return (texts.withColumn("h", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
            .withColumn("g", F.when(F.size("h") >= window, runs("h", gram, lambda x: F.xxhash64(*x)))).drop("h")
            .withColumn("m", runs("g", window - gram + 1, lambda x: F.least(*x))).drop("g")
            .withColumn("fp", F.explode_outer(F.array_distinct("m"))).drop("m").where("fp is not null"))


def windows(texts: DataFrame, length: int) -> DataFrame:
    """`texts` with its words replaced by one row per position: pos, len, and two hashes of the `length` words there."""
    return (texts.withColumn("w", runs("words", length, lambda x: F.struct(
        F.xxhash64(*x).alias("k1"), F.xxhash64(F.lit("second"), *x).alias("k2")))).drop("words")
        .select("*", F.posexplode_outer("w").alias("pos", "k")).drop("w").where("pos is not null")
        .select("*", F.lit(length).alias("len"), F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")).drop("k"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated.

    A word is hit if it lies inside an occurrence of a window; n_items counts the items with such windows. Null and
    empty texts have no words. Rows that repeat an id are judged each by its own text. Items without an id hit but are
    not counted. Other columns are not read.
    """
    return judged(docs, items, window, gram, id_col, text_col, item_col, item_text_col).drop("text_hash")


def judged(docs: DataFrame, items: DataFrame, window: int, gram: int, id_col: str, text_col: str, item_col: str,
           item_text_col: str) -> DataFrame:
    """What `contamination` returns, with text_hash. Inside, a document is its id and a hash of its text."""
    own = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")).alias("doc_id"),
                      F.col(text_col).alias("text"))
    bench = stored(items.select(F.col(item_col).alias("item_id"), words(item_text_col).alias("words"))
                   .where(F.size("words") > 0), "benchmark")
    short = sorted(r["n"] for r in bench.select(F.size("words").alias("n")).where(F.col("n") < window)
                   .distinct().collect())  # at most window - 1 numbers

    # Benchmark side: its fingerprints, and its distinct windows with the items that hold them.
    prints = stored(fingerprints(bench, window, gram).select("fp").distinct(), "benchmark-prints")
    exact = [windows(bench, window)] + [windows(bench.where(F.size("words") == n), n) for n in short]
    held = stored(reduce(DataFrame.unionByName, exact).select("len", "k1", "k2", "item_id").distinct(),
                  "benchmark-windows")
    distinct = stored(held.select("len", "k1", "k2").distinct(), "benchmark-distinct")

    # Documents that share a fingerprint, or a run of a short item's length.
    split = own.select("doc_id", words("text").alias("words"))
    found = fingerprints(split, window, gram).join(prints, "fp", "left_semi").select("doc_id")
    for n in short:
        keys = distinct.where(F.col("len") == n).select("k1", "k2")
        found = found.unionAll(windows(split, n).join(keys, ["k1", "k2"], "left_semi").select("doc_id"))
    found = stored(found.distinct(), "candidates")

    # Extension: all windows of those documents.
    candidates = own.join(found.withColumnRenamed("doc_id", "found"), F.col("doc_id").eqNullSafe(F.col("found")),
                          "left_semi").select("doc_id", words("text").alias("words"))
    every = reduce(DataFrame.unionByName, [windows(candidates, n) for n in [window, *short]])
    hits = stored(every.join(distinct, ["len", "k1", "k2"], "left_semi"), "hits")
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    spans = F.sort_array(F.collect_set(F.struct(F.col("pos").cast("long").alias("pos"), "len")))

    def cover(done, span):
        end = F.greatest(done["end"], span["pos"] + span["len"])
        return F.struct(end.alias("end"), (done["n"] + end - F.greatest(done["end"], F.least(span["pos"], end))
                                           ).alias("n"))

    covered = hits.groupBy("doc_id").agg(spans.alias("spans")).select(
        "doc_id", F.aggregate("spans", start, cover)["n"].alias("n_hit"))
    named = (hits.select("doc_id", "len", "k1", "k2").distinct().join(held, ["len", "k1", "k2"])
             .select("doc_id", F.col("item_id").cast("string").alias("item_id")).distinct()
             .groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    marked = stored(covered.join(named.withColumnRenamed("doc_id", "named"), F.col("doc_id").eqNullSafe(F.col("named")),
                                 "left").select(F.col("doc_id").alias("hit_id"), "n_hit", "item_ids"), "marked")
    counted = own.select("doc_id", F.size(spelled(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (counted.join(marked, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left").select(
        F.col("doc_id.id").alias("doc_id"), F.col("doc_id.hash").alias("text_hash"), "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"))
        .withColumn("contaminated", F.col("n_hit") > 0))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10,
               gram: int = 5) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose own text has no hit."""
    found = judged(docs, items, window, gram, id_col, text_col, "item_id", "text").where("contaminated")
    hit = stored(found.select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash")).distinct(), "contaminated")
    return docs.join(hit, docs[id_col].eqNullSafe(hit["_hit_id"]) & (F.xxhash64(docs[text_col]) == hit["_hit_hash"]), "left_anti")
