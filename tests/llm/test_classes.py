"""Toxicity, quality and licence scans: features by hand, held-out accuracy, awkward rows."""
import re._parser
import zlib

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, awkward, frame, words_of

from millrace.llm import labelled, license_scan, quality_cnn, queries, toxicity


def accuracy(spark, sf, name, label):
    scored = queries.QUERIES[name](spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label), "doc_id").where("held_out").collect()
    return np.mean([r["predicted"] == r[label] for r in rows])


def test_held_out_rows(spark):
    got = {r["doc_id"]: r["h"] for r in frame(spark, [(i, "") for i in range(300)] + [(None, "")])
           .select("doc_id", labelled.held_out("doc_id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300)} | {None: True}


def test_samples_leave_the_held_out_third_alone(spark):
    docs = frame(spark, [(i, f"t{i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    got = labelled.sample(docs, labels, "toxic", 40).collect()
    assert 0 < len(got) <= 40 and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, labelled.sample(docs, labels, "toxic", 40).collect()))


@pytest.mark.parametrize("raw,folded", [
    ("Ѕсum", " scum "), ("m0r0n!", " moron "), ("1d10t", " idiot "), ("É a", " e a "), ("in 2024", " in 2024 "), ("", "  "),
    ("p@thetic $tupid", " pathetic stupid "), ("a_b", " a b ")])
def test_folding(raw, folded):
    assert toxicity.fold(raw) == folded


def test_lexicon_counts_words_once_and_spares_exceptions():
    lexicon = toxicity.Lexicon({" trash ": 3.0, " tras": 2.0, " scum": 4.0}, ("trash can",), (0.0, 1.0, 1.0))
    value = lambda t: round(float(np.expm1(lexicon.features(t)[0])), 6)
    assert value("trash") == 3.0 and value("trashy") == 2.0 and value("the trash can") == 0.0
    assert value("Trash can trash") == 3.0 and value("scummy trash") == 7.0 and value("untrash") == 0.0
    assert lexicon.features("") == (0.0, 0.0) and 0 <= lexicon.score("scum " * 9) <= 1
    many, few = lexicon.features("scum a a a"), lexicon.features("scum" + " a" * 99)
    assert many[0] == few[0] and many[1] > few[1]


def test_toxicity_of_awkward_rows_and_without_labels(spark):
    docs, none = awkward(spark), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == len(AWKWARD) + 2 and {r["score"] for r in got} == {0.5} and {r["predicted"] for r in got} == {0}
    net = quality_cnn.fit(docs, none)
    got = quality_cnn.score(docs, net).collect()
    assert len(got) == len(AWKWARD) + 2 and {r["score"] for r in got} == {0.5}
    assert toxicity.score(frame(spark, []), toxicity.Lexicon({})).count() == 0
    kept = toxicity.keep_clean(docs, toxicity.Lexicon({" a ": 9.0}, (), (-5.0, 9.0, 9.0)))
    assert kept.columns == docs.columns
    # Not those that hold the word "a": AWKWARD[4], [5], [8] and [10].
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        i for i in [*range(len(AWKWARD)), 9] if " a " not in toxicity.fold(AWKWARD[i] or ""))


def test_held_out_accuracy(spark):
    small = "/root/testdata/sf0.01"
    assert accuracy(spark, small, "op9_quality_cnn", "quality") > 0.95
    assert accuracy(spark, small, "op8_toxicity", "toxic") > 0.9


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        raw = bytes(i % 251 for i in range(n))
        chunks, filled = quality_cnn.chunks_of(raw)
        seen = np.full(max(1, len(chunks)) * quality_cnn.STRIDE + quality_cnn.CHUNK, -1)
        for i, c in enumerate(chunks):
            own = c != quality_cnn.PAD
            at = i * quality_cnn.STRIDE + np.flatnonzero(own)
            seen[at] = c[own]
        assert seen[:n].tolist() == list(raw) and (seen[n:] == -1).all() and 0 <= filled.min() and filled.max() <= 1


def test_the_network_learns_from_its_largest_responses():
    net, r = quality_cnn.Network(filters=16, width=2, hidden=4), np.random.RandomState(1)
    chunks = r.randint(97, 123, (200, quality_cnn.CHUNK)).astype(np.int16)
    y = (r.rand(200) < 0.5).astype(float)
    chunks[y == 1, ::8] = r.randint(33, 48, (int(y.sum()), 32))  # signs among the letters mark the class
    net.train(chunks, np.ones(200), y, np.ones(200), rounds=20, batch=50, least_steps=10)
    assert ((net.logits(chunks, np.ones(200)) > 0) == y).mean() > 0.97


def test_rules_are_many_and_gated():
    own = license_scan.Scanner()
    assert len(own.rules) > 200
    for rule in own.rules:
        assert rule.keyword and 0 < rule.priority <= 100


@pytest.mark.parametrize("text,labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"), ("MIT License", "mit"), ("commit licence", ""),
    ("GNU General Public License version 3", "gpl,gpl-3.0"), ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"), ("(c) All Rights Reserved", "reserved"), ("", "")])
def test_labels(text, labels):
    assert license_scan.Scanner().scan(text)[5] == labels


def test_containment_is_suppressed_by_priority_then_order():
    rules = "50 low | b | a b c\n90 high | b | b c\n90 wide | b | a b c d\n40 other | e | d e"
    spans = license_scan.Scanner(rules, {}).scan("a b c d e")[7]
    assert [(s["label"], s["first"], s["last"]) for s in spans] == [("wide", 0, 3), ("high", 1, 2), ("other", 3, 4)]


def test_scan_against_plain_search(spark):
    extra = ["cc by cc by CC BY", "cc-by! All Rights\nReserved; all rights reserved", "general public license " * 50, "xcc by", "cc byx"]
    rows = [(i, t) for i, t in enumerate(AWKWARD + extra)] + [(3, "cc by")]
    got = license_scan.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r, (i, text) in zip(sorted(got, key=lambda r: (r["doc_id"], r["n_words"])), sorted(rows, key=lambda r: (r[0], len(words_of(r[1]))))):
        w = words_of(text)
        places = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(w))
                  if w[k:k + len(phrase.split())] == phrase.split()]
        assert (r["doc_id"], r["n_words"], r["n_base"]) == (i, len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({p[1] for p in places})) and 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_gradient_of_the_filters():
    """One small step against the gradient of one chunk lowers its loss by the step's first-order share."""
    r = np.random.RandomState(2)
    chunks, filled, y = r.randint(0, 256, (4, quality_cnn.CHUNK)).astype(np.int16), np.ones(4), np.array([1.0, 0, 1, 0])

    def loss(net):
        return np.log1p(np.exp(-net.logits(chunks, filled) * (2 * y - 1))).sum()
    net = quality_cnn.Network()
    before = loss(net)
    net.train(chunks, filled, y, np.ones(4), rounds=1, batch=4, least_steps=1, rate=1e-4)
    assert before - 0.5 < loss(net) < before


def test_toxic_scores_do_not_depend_on_the_bound_of_the_sample(spark):
    """One toxic text to eight: a sample of all rows and one of as many rows of each class score alike."""
    r, rows, marks = np.random.RandomState(4), [], []
    for i in range(3600):
        toxic = i % 9 == 0
        words = [f"w{w}" for w in r.randint(0, 400, 60)]
        words += [w for w in ("scumbag", "moronic", "vermin", "imbecile", "cretin") if r.rand() < (0.3 if toxic else 0.012)]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    fits = [toxicity.fit(docs, labels, most=most) for most in (16_000, 500)]
    texts = [" ".join(f"w{k}" for k in range(60)) + more for more in ("", " scumbag", " scumbag vermin")]
    logits = [[np.log(p / (1 - p)) for p in map(f.score, texts)] for f in fits]
    assert np.abs(np.diff(logits, axis=0)).max() < 0.8, logits
    half = [np.mean([f.score(t) for _, t in rows]) for f in fits]
    assert all(abs(h - 1 / 9) < 0.03 for h in half), half


def expansions(items):
    """What a pattern can read, repeats taken once or not at all, one letter of a range."""
    out = [""]
    for op, value in items:
        kind = str(op)
        if kind == "LITERAL":
            own = [chr(value)]
        elif kind == "IN":
            own = [chr(v) if str(o) == "LITERAL" else chr(v[0]) for o, v in value]
        elif kind == "SUBPATTERN":
            own = expansions(value[3])
        elif kind == "BRANCH":
            own = [x for branch in value[1] for x in expansions(branch)]
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            own = [""] * (value[0] == 0) + expansions(value[2])
        else:
            own = {"NOT_LITERAL": ["?"], "ASSERT_NOT": [""]}[kind]
        out = [o + x for o in out for x in own]
    return out


def test_every_match_of_a_rule_holds_its_keyword():
    for rule in license_scan.Scanner().rules:
        assert not [x for x in expansions(re._parser.parse(rule.pattern.pattern)) if rule.keyword not in x], rule.label


@pytest.mark.parametrize("text,labels", [
    ("the zlib/libpng license", "zlib"), ("BSD-style licensed", "bsd"), ("Ruby's license", "ruby"),
    ("Unicode, Inc. License", "unicode"), ("a U.S. Government work", "public-domain"), ("this is proprietary software", "proprietary"),
    ("dually licensed", "dual"), ("see the COPYING file", "see-file"), ("see the licence file", "see-file"),
    ("see LICENSE.txt", "see-file"), ("see LICENSE.md", "see-file")])
def test_labels_of_each_alternative(text, labels):
    assert license_scan.Scanner().scan(text)[5] == labels


@pytest.mark.parametrize("name,version,labels", [
    ("General", "; either version 1 of the License, or (at your option) any later version", "gpl,gpl-1.0"),
    ("General", "; either version 2 of the License, or (at your option) any later version", "gpl,gpl-2.0-or-later"),
    ("General", "; either version 2, or (at your option) any later version", "gpl,gpl-2.0-or-later"),
    ("General", ", either version 3 of the License, or (at your option) any later version", "gpl,gpl-3.0-or-later"),
    ("General", "; version 2 of the License", "gpl,gpl-2.0"),
    ("Library General", "; either version 2 of the License, or (at your option) any later version", "gpl,lgpl-2.0"),
    ("Lesser General", "; either version 2 of the License, or (at your option) any later version", "gpl,lgpl-2.0"),
    ("Lesser General", "; either version 2.1 of the License, or (at your option) any later version", "gpl,lgpl-2.1"),
    ("Lesser General", ", either version 3 of the License, or (at your option) any later version", "gpl,lgpl-3.0"),
    ("Affero General", ", either version 3 of the License, or (at your option) any later version", "agpl-3.0,gpl")])
def test_labels_of_standard_notices(name, version, labels):
    notice = f"""# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU {name} Public License as published by
# the Free Software Foundation{version}.
#
# This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
# warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {name} Public License for more
# details."""
    assert set(license_scan.Scanner().scan(notice)[5].split(",")) - {"lgpl", "agpl"} == set(labels.split(","))


def test_a_shared_passage_makes_no_copies(spark):
    r = np.random.RandomState(6)
    prose = lambda n: [f"w{k}" for k in r.randint(0, 4000, n)]
    low = lambda words: min(xxhash.xxh3_64_intdigest(" ".join(words[i:i + 5])) for i in range(len(words) - 4))
    passage = min([prose(12) for _ in range(300)], key=lambda p: low(toxicity.fold(" ".join(p)).split()))
    # The passage holds the smallest hash of nearly every text.
    rows = [(i, " ".join(prose(24) + passage + prose(24) + ["scumbag"] * (i % 2))) for i in range(60)]
    copy = " ".join(prose(80) + ["oddity"])
    rows += [(i, copy + f" w{i}") for i in range(100, 130)]
    labels = spark.createDataFrame([(i, int(i >= 100 or i % 2)) for i, _ in rows], "doc_id long, toxic int")
    weights = toxicity.fit(frame(spark, rows), labels).weights
    assert " scumbag " in weights and " oddity " not in weights
    rows = [(y, i, *toxicity.copy_keys(toxicity.fold(copy))) for i, y in enumerate((0, 1, 1, 0))]
    assert [row[:2] for row in toxicity.first_of_copies(rows)] == [(0, 0), (1, 1)]


def test_filters_equal_a_plain_convolution():
    net, r = quality_cnn.Network(filters=3, width=5, hidden=4), np.random.RandomState(5)
    net.numbers = np.array([0.3, 1.0, -0.5, 0.25])
    texts = [None, "", "short", "é" * 700, "".join(chr(r.randint(32, 127)) for _ in range(3000))]
    p, got = net.p, net.features(texts)
    for text, found, score in zip(texts, got, net.scores(texts)):
        raw, logits, weights = (text or "").encode(), [], []
        for start in range(0, max(1, len(raw) - 32), 224):
            own = list(raw[start:start + 256])
            filled, own = len(own) / 256, own + [256] * (256 - len(own))
            best = [max(sum(p["t"][k][own[i + k]][f] for k in range(5)) for i in range(252)) for f in range(3)]
            x = np.array([np.tanh(b) for b in best] + [filled])
            logits.append(float(np.tanh(x @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"][0]))
            weights.append(max(filled, 1e-3))
        want = [np.average(logits, weights=weights), min(logits), max(logits)]
        assert np.allclose(found, want, atol=1e-4)
        assert abs(score - 1 / (1 + np.exp(-(0.3 + want[0] - 0.5 * want[1] + 0.25 * want[2])))) < 1e-4


def test_the_last_chunk_of_long_texts_teaches_too(spark):
    """Texts that differ in their last part alone, under a bound of bytes that most of them keep within."""
    docs = frame(spark, [(i, "plain words go on " * 200 + ("&%$#! " * 60 if i % 2 else "and so on " * 36)) for i in range(240)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)], "doc_id long, quality int")
    rows = quality_cnn.score(docs, quality_cnn.fit(docs, labels, most_bytes=300_000)).where("held_out").collect()
    assert rows and all(r["predicted"] == r["doc_id"] % 2 for r in rows)
    none = quality_cnn.fit(frame(spark, []), labels)
    assert quality_cnn.score(frame(spark, []), none).count() == 0
    assert {0.0 < r["score"] < 1.0 for r in quality_cnn.score(docs, quality_cnn.fit(docs, labels, most_bytes=1)).collect()} == {True}


def test_lexicon_equals_plain_search():
    r = np.random.RandomState(8)
    words = ["scum", "trash", "can", "trashcan", "idiot", "idiotic", "a", "fine", "x" * 60]
    weights = {" trash ": 3.0, " tras": 2.0, " scum": 4.0, " idiot ": 2.5, " idio": 1.5, f" {'x' * 60} ": 5.0}
    lexicon = toxicity.Lexicon(weights, ("trash can",), (0.0, 1.0, 1.0))
    for _ in range(200):
        text = " ".join(words[i] for i in r.randint(0, len(words), r.randint(1, 12)))
        own, total = text.split(), 0.0
        for i, word in enumerate(own):
            spared = own[i:i + 2] == ["trash", "can"] or own[max(0, i - 1):i + 1] == ["trash", "can"]
            if not spared:
                total += max([w for t, w in weights.items() if f" {word} ".startswith(t)], default=0.0)
        assert np.allclose(lexicon.features(text), (np.log1p(total), np.log1p(100 * total / len(own))))


def test_terms_are_words_of_any_length():
    assert f" {'y' * 300} " in toxicity.terms_of(f" {'y' * 300} a ")


def test_toxic_precision_and_recall(spark):
    small = "/root/testdata/sf0.01"
    rows = (queries.QUERIES["op8_toxicity"](spark, small).where("held_out")
            .join(spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect())
    both = sum(r["toxic"] == r["predicted"] == 1 for r in rows)
    assert both >= 0.8 * sum(r["toxic"] for r in rows) > 0 and both >= 0.9 * sum(r["predicted"] for r in rows)
