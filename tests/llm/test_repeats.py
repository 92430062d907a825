"""Repeated passages: the index against plain search, removal against a plain version of the contract."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import awkward, frame, prose
from millrace.llm import fm_index, repeats


def longest_match(texts, query, at):
    best = 0
    for t in texts:
        for s in range(len(t)):
            n = 0
            while at + n < len(query) and s + n < len(t) and t[s + n] == query[at + n] and query[at + n] > 0:
                n += 1
            best = max(best, n)
    return best


@pytest.mark.parametrize("seed,letters", [(1, 2), (2, 3), (3, 9), (4, 1)])
def test_matching_statistics_equal_plain_search(seed, letters):
    r = random.Random(seed)
    some = lambda: [r.randrange(1, letters + 1) for _ in range(r.randrange(0, 14))]
    texts, queries = [some() for _ in range(9)], [some() + [0] * r.randrange(2) for _ in range(12)]
    queries += texts[:3] + [[letters + 1, 1, 1]]
    flat = lambda lists: np.array([x for one in lists for x in one], np.int64)
    sizes = lambda lists: np.array([len(one) for one in lists], np.int64)
    index = fm_index.FMIndex(flat(texts), sizes(texts), letters + 1)
    longest, row = index.matching_statistics(flat(queries), sizes(queries))
    places = [(q, i) for q in queries for i in range(len(q))]
    assert longest.tolist() == [longest_match(texts, q, i) for q, i in places]
    values = np.arange(len(texts))[::-1].copy()
    for window in (1, 2, 3):
        smallest = index.smallest(values, window)
        for (q, i), n, at in zip(places, longest, row):
            if n >= window:
                cut = q[i:i + window]
                holders = [v for t, v in zip(texts, values) if any(t[s:s + window] == cut for s in range(len(t)))]
                assert smallest[at] == min(holders)


def test_wavelet_ranks():
    r = np.random.default_rng(5)
    for most, n in ((1, 70), (2, 1), (200, 1000)):
        seq = r.integers(0, most + 1, n)
        tree = fm_index.WaveletTree(seq, most)
        symbols, at = r.integers(0, most + 1, 300), r.integers(0, n + 1, 300)
        assert tree.rank(symbols, at).tolist() == [int((seq[:i] == c).sum()) for c, i in zip(symbols, at)]


def test_passages_cover_every_window_once():
    r = random.Random(3)
    words = [[bytes([97 + r.randrange(3)]) for _ in range(n)] for n in (0, 5, 12, 13, 60, 2, 30)]
    hashes = np.array([hash(w) & 0xFFFFFFFFFFFF for ws in words for w in ws], np.uint64)
    document, start, n, _ = repeats.passages_of(words, hashes, 12, 5)
    got = sorted((d, s + i) for d, s, k in zip(document, start, n) for i in range(k))
    assert got == [(d, s) for d, ws in enumerate(words) for s in range(len(ws) - 11)]


def removed(rows, window):
    """(id, text) rows to (id, n_words, n_removed, kept), by the words of the contract."""
    first = {}
    split = [(i, (t or "").encode("utf-8").split()) for i, t in rows]
    for i, ws in split:
        for s in range(len(ws) - window + 1 if i is not None else 0):
            key = tuple(ws[s:s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in split:
        gone = set()
        for s in range(len(ws) - window + 1 if i is not None else 0):
            if first[tuple(ws[s:s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((i, len(ws), len(gone), b" ".join(w for p, w in enumerate(ws) if p not in gone).decode()))
    return sorted(out, key=str)


def collection(seed):
    """Copies, a passage in every second text, periodic texts, twins of one id, a missing id."""
    r = random.Random(seed)
    common, other = prose(seed, 40), prose(seed + 1, 25)
    rows = []
    for i in range(60):
        text = prose(1000 + i, r.randrange(0, 40))
        if i % 2:
            text += common[:r.randrange(20, 41)]
        text += prose(2000 + i, r.randrange(0, 20))
        if i % 3 == 0:
            text += other
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[7][1]) for i in range(5)] + [(7, "another text " + " ".join(other)), rows[9], rows[9]]
    rows += [(None, " ".join(common)), (-5, "a b a b a b a b a b a b a b a b a b a b a b a b a b"), (3, None), (200, ""),
             (201, "b a b a b a b a b a b a b a b a b a b a b a b a b a b"), (202, "\x85".join(common))]
    return rows


@pytest.mark.parametrize("most,target", [(1024, 4096), (2, 8)])
def test_removal_equals_a_plain_version(spark, most, target):
    rows = collection(11)
    made = repeats.remove_repeats(frame(spark, rows), window=16, anchor=6, most=most, target=target)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in made.collect()), key=str)
    assert got == removed(rows, 16)
    for r in made.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_ids_may_be_texts(spark):
    rows = collection(12)
    named = frame(spark, rows).withColumn("doc_id", F.format_string("d%05d", F.col("doc_id") + 5))
    named = named.withColumn("doc_id", F.when(~F.col("doc_id").contains("null"), F.col("doc_id")))
    made = repeats.remove_repeats(named, window=16, anchor=6)
    plain = [(None if i is None else f"d{i + 5:05d}", t) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in made.collect()), key=str) == removed(plain, 16)


def test_awkward_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    made = repeats.remove_repeats(awkward(spark))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in made.collect()), key=str) == removed(rows, 50)
    assert repeats.remove_repeats(frame(spark, [])).collect() == []
