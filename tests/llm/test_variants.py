"""Spelling variants against plain edit distances."""
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import ascii_lower, awkward, frame
from millrace.llm import variants


def distance_one(a, b):
    """By the definition: some single insertion, deletion or replacement makes b of a."""
    if a == b:
        return False
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    if len(longer) == len(shorter):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(longer[:i] + longer[i + 1:] == shorter for i in range(len(longer)))


def plain(rows, every=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, out = {}, []
    for w, n in words.items():
        near = sorted((-k, v) for v, k in words.items() if distance_one(w, v))
        form[w] = near[0][1] if near and -near[0][0] >= 5 * n else None
        out.append((w, form[w], n, len(near), words[form[w]] if form[w] else None))
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, f, root(w), n, k, m) for w, f, n, k, m in out)


def collection(seed, letters):
    """Words of few letters and their damaged versions, in steps of frequency, so that forms make chains."""
    r = random.Random(seed)
    rows, bases = [], ["".join(r.choice(letters) for _ in range(r.randrange(6, 10))) for _ in range(60)]
    for base in bases:
        w, n = base, 300
        while n >= 5:
            rows.append(" ".join([w] * n))
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1:]])
            n //= r.choice([2, 5, 6])
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("letters,most", [("abcdé", 2048), ("eaÀÿn", 7), ("ez", 3), ("éz", 40)])
def test_equal_to_plain_distances(spark, letters, most):
    rows = collection(len(letters) + most, letters)
    rows += [(rows[3][0], "twin " + rows[3][1].upper()), rows[5], (None, rows[6][1] + " Zürich×÷ß"), (9999, None), (9998, "")]
    got = variants.variants(frame(spark, rows), every=3, most=most)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, every=3)


def test_one_edit():
    r = random.Random(8)
    words = ["".join(r.choice("ab") for _ in range(r.randrange(0, 6))) for _ in range(80)]
    assert all(variants.one_edit(a, b) == distance_one(a, b) for a in words for b in words)


def test_a_search_reaches_all_near_words_and_few_others(spark):
    """Every word one edit away lies within one surplus and one deficit, in the table of nodes and below."""
    r = random.Random(4)
    words = sorted({"".join(r.choice("eaiontrsluwdcmgpz") for _ in range(7)) for _ in range(300)})
    words += [w[:3] + "z" + w[4:] for w in words] + [w[1:] for w in words]
    df = spark.createDataFrame([(w, 1) for w in sorted(set(words))], "word string, n long").withColumn(
        "counts", variants.group_counts(variants.F.col("word")))
    reached = variants.descend(df, 20).collect()
    home = {x.word: x.node for x in reached if x.spent == variants.SAME}
    at = {(x.word, x.node) for x in reached}
    assert set(home) == set(words) and len(at) == len(reached)
    assert all((a, home[b]) in at or (b, home[a]) in at for a in home for b in home if distance_one(a, b))
    assert len(reached) < 10 * len(home)


def test_awkward_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert sorted(tuple(r) for r in variants.variants(awkward(spark)).collect()) == plain(rows)
    assert variants.variants(frame(spark, [])).collect() == []
