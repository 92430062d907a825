"""Passages that stand in several documents: candidates by minimizers, FM-indexes over shards of them, words to remove.

Two documents that share a window of words share the smallest hash of its word runs (its anchor). All windows with one
anchor form one passage, so a text becomes passages of at most 2 * window - anchor words. Passages whose anchor stands
in one document only are left behind; equal ones become one row with the smallest id before anything is indexed, so a
group of copies of any size is one passage. The rest is dealt to shards by anchor. Each shard is an FM-index, against
which its passages are matched: where a match reaches the window's length, its interval tells the smallest id.

An anchor with more than `most` different passages (a common phrase with many surroundings) would be a large group.
Its passages are cut into single windows, which are dealt to shards by themselves, equal ones as one row again.
"""
from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Memo, map_arrow, ship, stored
from millrace.llm.fm_index import FMIndex
from millrace.operators.skew import salted_join

#: Multiplier of word hashes inside runs, and of the last mixing step.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
HOT_ROWS = 100_000


def words_of(text: str | None) -> list[bytes]:
    """Runs without blank, tab, line feed, vertical tab, form feed and return, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def run_hashes(words: np.ndarray, run: int) -> np.ndarray:
    """A hash of the `run` words that begin at each place, for all places where so many are left."""
    done, width, power = None, 1, BASE          # `words` covers `width` words, `power` is BASE ** width
    have = 0
    with np.errstate(over="ignore"):
        while True:
            if run & width:
                if done is None:
                    done, have = words, width
                else:
                    n = len(words) - have
                    done = done[:n] * power + words[have:have + n] if n > 0 else words[:0]
                    have += width
            if width * 2 > run:
                break
            words = words[:-width] * power + words[width:] if len(words) > width else words[:0]
            power, width = power * power, width * 2
        done = done[:max(len(done), 0)]
        done = (done ^ (done >> np.uint64(31))) * MIX
        return done ^ (done >> np.uint64(29))


def first_smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The place of the smallest of `span` values from each place on; of equal ones the first."""
    place, width = np.arange(len(values)), 1
    if span > len(values):
        return place[:0]

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    while width * 2 <= span:
        place, width = better(place[:len(place) - width], place[width:]), width * 2
    left = len(values) - span + 1
    return better(place[:left], place[span - width:span - width + left])


def passages_of(words: list[list[bytes]], hashes: np.ndarray, window: int, anchor: int):
    """(document, start, number of windows, anchor hash) of all passages of some documents whose words follow each other
    in `hashes`."""
    lengths = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(lengths) - lengths
    inside = np.repeat(begins + lengths - window, np.maximum(lengths - window + 1, 0))   # the last start of its document
    starts = inside - (np.repeat(np.cumsum(np.maximum(lengths - window + 1, 0)), np.maximum(lengths - window + 1, 0))
                       - 1 - np.arange(len(inside)))
    if not len(starts):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
    grams = run_hashes(hashes, anchor)
    at = first_smallest(grams, window - anchor + 1)[starts]
    fresh = np.flatnonzero(np.diff(at, prepend=-1) | (np.diff(starts, prepend=-2) != 1))
    document = np.searchsorted(begins + lengths, starts[fresh], side="right")
    return document, starts[fresh] - begins[document], np.diff(np.append(fresh, len(starts))), grams[at[fresh]]


def passages(docs: DataFrame, id_col: str, text_col: str, window: int, anchor: int) -> DataFrame:
    """One row a passage: id, a hash of the text, first word, number of windows, anchor, and a digest of its words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        known = Memo(xxhash.xxh3_64_intdigest)

        def work(ids, texts, contents):
            words = [words_of(t) for t in contents]
            hashes = np.array([known[w] for ws in words for w in ws], np.uint64)
            document, start, n, smallest = passages_of(words, hashes, window, anchor)
            begin, end = start.tolist(), (start + n + window - 1).tolist()
            digests = [xxhash.xxh3_128_digest(b" ".join(words[d][b:e])) for d, b, e in zip(document.tolist(), begin, end)]
            rows = document.tolist()
            return ([ids[d] for d in rows], [texts[d] for d in rows], start, n, smallest.view(np.int64), digests)
        return work

    keyed = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("content"))
    return map_arrow(keyed, ["id", "text_hash", "content"], make,
                     f"id {kind}, text_hash long, start int, n int, anchor long, passage binary")


def texts_of(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(anchor, passage, id, words): each wanted passage with its words, cut from the document that holds it."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def work(ids, spots, contents):
            out = [], [], [], []
            for i, listed, content in zip(ids, spots, contents):
                words = words_of(content)
                for s in listed:
                    cut = b" ".join(words[s["start"]:s["start"] + s["n"] + window - 1])
                    for column, value in zip(out, (s["anchor"], s["passage"], i, cut)):
                        column.append(value)
            return out
        return work

    listed = wanted.groupBy("id", "text_hash").agg(
        F.collect_list(F.struct("anchor", "passage", "start", "n")).alias("spots"))
    content = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("content"))
    held = content.join(listed, ["id", "text_hash"])
    found = map_arrow(held, ["id", "spots", "content"], make, f"anchor long, passage binary, id {kind}, words binary")
    return found.dropDuplicates(["passage"])    # a row of the documents may stand there twice


def search(dealt: DataFrame, shards: int, window: int) -> DataFrame:
    """(passage, firsts): for each window of each passage the smallest id among the passages of its shard that hold it.

    `dealt` has one row a passage with its words and smallest id.
    """
    ship(dealt.sparkSession)
    kind = dealt.schema["id"].dataType.simpleString()
    schema = dealt.sparkSession.createDataFrame([], f"passage binary, firsts array<{kind}>").schema

    def run(rows: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        split = [w.split() for w in rows.column("words").to_pylist()]
        lengths = np.array([len(w) for w in split], np.int64)
        symbols = np.array([numbers.setdefault(w, len(numbers) + 1) for ws in split for w in ws], np.int64)
        ids = rows.column("id").combine_chunks()
        order = pc.sort_indices(ids).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        index = FMIndex(symbols, lengths, len(numbers))
        longest, row = index.matching_statistics(symbols, lengths)
        found = order[index.smallest(rank, window)[row[longest >= window]]]
        counts = np.add.reduceat(longest >= window, np.cumsum(lengths) - lengths)
        offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
        return pa.table({"passage": rows.column("passage"),
                         "firsts": pa.ListArray.from_arrays(pa.array(offsets), ids.take(pa.array(found)))})

    keyed = dealt.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return keyed.select("shard", "passage", "id", "words").groupBy("shard").applyInArrow(
        lambda key, rows: run(rows), schema)


def single_windows(hot: DataFrame, window: int) -> DataFrame:
    """(passage, place, single, id, words): the windows of each passage, with a digest of their words."""
    kind = hot.schema["id"].dataType.simpleString()

    def make():
        def work(ids, held, words):
            out = [], [], [], [], []
            for i, p, w in zip(ids, held, words):
                split = w.split()
                for at in range(len(split) - window + 1):
                    cut = b" ".join(split[at:at + window])
                    for column, value in zip(out, (p, at, xxhash.xxh3_128_digest(cut), i, cut)):
                        column.append(value)
            return out
        return work

    return map_arrow(hot, ["id", "passage", "words"], make,
                     f"passage binary, place int, single binary, id {kind}, words binary")


def first_holders(docs: DataFrame, window: int = 50, anchor: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  most: int = 1024, target: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, start, passage) of passages that share their anchor with other documents, and (passage, firsts):
    the smallest id that holds each of a passage's windows."""
    every = stored(passages(docs, id_col, text_col, window, anchor), "passages")
    shared = every.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    held = stored(salted_join(every, shared.select("anchor"), ["anchor"], "left_semi", max_rows=HOT_ROWS), "shared")
    one = held.groupBy("anchor", "passage").agg(F.min(F.struct("id", "text_hash", "start", "n")).alias("at"))
    texts = stored(texts_of(one.select("anchor", "passage", "at.*"), docs, id_col, text_col, window), "texts")
    hot = stored(texts.groupBy("anchor").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > most), "hot")
    cold = texts.join(hot, "anchor", "left_anti")
    singles = stored(single_windows(salted_join(texts, hot.select("anchor"), ["anchor"], "left_semi", hot=hot,
                                                max_rows=HOT_ROWS), window), "windows")
    alone = singles.groupBy("single").agg(F.min("id").alias("id"), F.first("words").alias("words"))
    dealt = cold.select("anchor", "passage", "id", "words").unionByName(alone.select(
        F.xxhash64("single").alias("anchor"), F.col("single").alias("passage"), "id", "words"))
    dealt = stored(dealt, "dealt")
    shards = max(1, -(-dealt.count() // target))
    found = stored(search(dealt, shards, window), "holders")
    of_single = found.select(F.col("passage").alias("single"), F.col("firsts")[0].alias("first"))
    joined = salted_join(singles.select("passage", "place", "single"), of_single, ["single"], "inner", max_rows=HOT_ROWS)
    whole = joined.groupBy("passage").agg(F.sort_array(F.collect_list(F.struct("place", "first"))).alias("w")).select(
        "passage", F.col("w.first").alias("firsts"))
    cold_found = found.join(singles.select(F.col("single").alias("passage")).distinct(), "passage", "left_anti")
    return held, stored(cold_found.unionByName(whole), "firsts")


def remove_repeats(docs: DataFrame, window: int = 50, anchor: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """(id, n_words, n_removed, kept, spans) for every row of `docs`.

    A word goes if a window of `window` consecutive words that covers it also stands in a document with a smaller id;
    windows are judged on the input. `kept` is what is left, joined by one blank, and `spans` lists the removed
    stretches as first word and word after the last. Words are as in `words_of`.

    A null text has no words; texts shorter than the window stay whole. Rows without an id neither lose words nor take
    any; rows with one id are judged each by its own text and do not count against each other; repeated rows get equal
    results. Other columns are not looked at. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held, firsts = first_holders(docs, window, anchor, id_col, text_col, **options)
    found = salted_join(held.select("id", "text_hash", "start", "passage"), firsts, ["passage"], "inner", max_rows=HOT_ROWS)
    starts = F.filter(F.transform("firsts", lambda first, i: F.when(first < F.col("id"), F.col("start") + i)),
                      lambda x: x.isNotNull())
    marks = (found.select("id", "text_hash", starts.alias("starts")).where(F.size("starts") > 0)
             .groupBy("id", "text_hash").agg(F.flatten(F.collect_set("starts")).alias("starts")))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("content"))
    marked = rows.where("id IS NOT NULL").join(marks, ["id", "text_hash"], "left").select("id", "starts", "content")
    nameless = rows.where("id IS NULL").select("id", F.lit(None).cast("array<int>").alias("starts"), "content")

    def make():
        def work(ids, places, contents):
            n_words, n_removed, kept, spans = [], [], [], []
            for listed, content in zip(places, contents):
                words = words_of(content)
                change = np.zeros(len(words) + 1, np.int64)
                if listed:
                    at = np.unique(np.array(listed, np.int64))
                    change[at] += 1
                    change[at + window] -= 1
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
                borders = [0, *edges, len(words)]
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(w for a, b in list(pairwise(borders))[::2] for w in words[a:b]).decode("utf-8", "replace"))
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
            return ids, n_words, n_removed, kept, spans
        return work

    return map_arrow(marked.unionByName(nameless), ["id", "starts", "content"], make,
                     f"`{id_col}` {kind}, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>")
