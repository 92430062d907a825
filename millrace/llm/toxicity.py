"""Toxicity by a weighted lexicon.

Texts are folded first: letters lowered, accents taken off, look-alikes of other scripts and digits that stand for
letters replaced, everything else between words one blank. One Aho-Corasick pass over the folded text finds all terms;
a term is a blank and a whole word, or a blank and the beginning of a word. A word's weight is the largest of the terms
in it, and words inside an exception phrase count nothing. The sum of the weights, and the sum divided by the number of
words, go through a logistic function.

Terms and weights are learned from a bounded sample of labelled texts: the logarithm of how much likelier a term is in
toxic texts. Near copies in the sample would make any of their words look telling, so of texts with one
label that share three of four smallest shingle hashes only one is used. The sample takes as many rows of each class as there is room for, so its classes may be
nearer to halves than all labels are; in the logistic fit each class weighs what it weighs among all labels.
"""
from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_bytes, keep_rows, map_arrow, ship, stored
from millrace.llm.labelled import eligible, held_out, sample

#: Letters of other scripts that look like Latin ones, and what they look like. Fixed values.
HOMOGLYPHS = str.maketrans(
    "абвгдезиійкмнопрстухцѕіјӏԁԛԝүһαβγεηικμνοπρστυχωɑɡıɩʟո",
    "abbrdeznijkmhonpctyxusijldqwyhabyenikuvonpotuxwagiiln")
#: Digits and signs that stand for letters inside words. Fixed values.
DIGITS = str.maketrans("01345789@$", "oieastbgas")
#: Phrases whose words are harmless together. A parameter's default.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clown car", "scum line", "pathetic fallacy")

ODD_SCRIPTS = re.compile("[ıɑ-ʯͰ-ֈ]")
MARKS = re.compile("[̀-ͯ]+")
STANDS_FOR = re.compile(r"(?<=[^\W\d_])[0134578-9@$]+|[0134578-9@$]+(?=[^\W\d_])")
BETWEEN = re.compile(r"[\W_]+")
SHORTEST, LONGEST_STEM = 4, 7
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def fold(text: str) -> str:
    """The folded words, each after one blank, with a blank at the end."""
    text = text.lower()
    if not text.isascii():
        text = MARKS.sub("", unicodedata.normalize("NFKD", text))
        if ODD_SCRIPTS.search(text):
            text = text.translate(HOMOGLYPHS)
    text = STANDS_FOR.sub(lambda m: m[0].translate(DIGITS), text)
    return " " + BETWEEN.sub(" ", text).strip() + " "


def terms_of(folded: str) -> set[str]:
    """Whole words with both blanks, and their beginnings with the blank before."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(" " + word[:n] for n in range(SHORTEST, min(LONGEST_STEM, len(word)) + 1))
    return out


def copy_keys(folded: str) -> list[int]:
    """The smallest of four hashes each of five folded words in a row: near copies mostly share three of them."""
    words = folded.split()
    rows = {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    hashes = np.array([xxhash.xxh3_64_intdigest(r) for r in rows], np.uint64)
    out = []
    for factor in FACTORS:
        mixed = hashes * np.uint64(factor)
        out.append(int(((mixed ^ (mixed >> np.uint64(31))) * np.uint64(FACTORS[0])).min()) - (1 << 63))
    return out


def first_of_copies(rows: list[tuple]) -> list[tuple]:
    """Of (y, id, four keys), the one with the smallest id of those that equal y and three keys connect."""
    rows = sorted(rows, key=lambda r: r[1:])
    top, seen = list(range(len(rows))), {}

    def root(i):
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, (y, _, *keys) in enumerate(rows):
        for k in range(4):
            a, b = root(seen.setdefault((y, k, *keys[:k], *keys[k + 1:]), i)), root(i)
            top[max(a, b)] = min(a, b)
    return [row for i, row in enumerate(rows) if top[i] == i]


class Lexicon:
    """Terms with weights, exception phrases, and the numbers of the logistic function."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS, numbers=(0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.numbers = weights, tuple(exceptions), numbers
        self.matcher = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.matcher.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            folded = fold(phrase)
            self.matcher.add_word(folded, (len(folded), -1.0))
        if len(self.matcher):
            self.matcher.make_automaton()

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.numbers)

    def features(self, text: str) -> tuple[float, float]:
        folded = fold(text)
        words = folded.count(" ") - 1 if len(folded) > 2 else 0
        found: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        if len(self.matcher):
            for end, (length, weight) in self.matcher.iter(folded):
                start = end + 1 - length
                if weight < 0:
                    free.append((start, end))
                elif weight > found.get(start, 0.0):
                    found[start] = weight
        for start, end in free:
            for at in [w for w in found if start <= w < end]:
                del found[at]
        total = sum(found.values())
        return math.log1p(total), math.log1p(100 * total / words) if words else 0.0

    def score(self, text: str) -> float:
        a, b, c = self.numbers
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def logistic(rows: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 60,
             weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (first the constant) by Newton steps; with one class only, its smoothed share. Rows count by `weight`."""
    weight = np.ones(len(y)) if weight is None else weight
    x = np.column_stack([np.ones(len(y)), rows])
    w = np.zeros(x.shape[1])
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        w[0] = math.log(share / (1 - share))
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) / len(y))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (weight * (p - y)) / len(y) + penalty * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 16_000, max_terms: int = 3_000,
        support: int = 4, least: float = 2.5, exceptions=EXCEPTIONS, id_col: str = "doc_id",
        text_col: str = "text") -> Lexicon:
    """A lexicon of at most `max_terms` terms from at most `most` labelled rows outside the held-out third.

    A term needs `support` toxic texts and a weight of `least`. Without labels the lexicon is empty.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = sample(docs, labels, label, most, id_col, text_col)

    def prepare():
        def work(y, ids, texts):
            folded = [fold(t) for t in texts]
            return y, ids, *zip(*[copy_keys(f) for f in folded]), texts
        return work

    kind, keys = rows.schema["doc_id"].dataType.simpleString(), ["doc_id", "a", "b", "c", "d"]
    typed = f"doc_id {kind}, a long, b long, c long, d long"
    keyed = map_arrow(rows, ["y", "doc_id", "text"], prepare, f"y int, {typed}, text string")
    drawn = stored(keyed.groupBy(*keys).agg(F.min(F.struct("y", "text")).alias("row")).select(*keys, "row.*"),
                   "toxicity-sample")
    # At most `most` ids with their four numbers, without texts.
    first = first_of_copies([tuple(r) for r in drawn.select("y", *keys).collect()])
    own = drawn.join(F.broadcast(spark.createDataFrame([r[1:] for r in first], typed)), keys).select("y", "text")
    toxic = sum(r[0] for r in first)
    clean = len(first) - toxic

    def count(batches):
        for batch in (part for whole in batches for part in by_bytes(whole, 1, 1 << 22)):
            seen = (Counter(), Counter())
            for y, text in zip(*[c.to_pylist() for c in batch.columns]):
                seen[y].update(terms_of(fold(text)))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(
                pa.array([seen[y][t] for t in terms], pa.int64()) for y in (0, 1))], ["term", "n", "p"])

    counted = own.select("y", "text").mapInArrow(count, "term string, n long, p long")
    weight = (F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((F.col("n") + 0.5) / (clean + 1)))
    best = (counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).where(F.col("p") >= support)
            .withColumn("weight", weight).where(F.col("weight") >= least)
            .orderBy(F.desc(F.col("weight") * F.log("p")), "term").limit(max_terms))
    lexicon = Lexicon({r["term"]: r["weight"] for r in best.collect()}, exceptions)

    def measure():
        def work(y, texts):
            x = [lexicon.features(t) for t in texts]
            return y, [v[0] for v in x], [v[1] for v in x]
        return work

    points = np.array(map_arrow(own, ["y", "text"], measure, "y int, a double, b double").collect(), float)
    points = points.reshape(-1, 3)
    order = np.lexsort(points.T)
    x, y = points[order, 1:], points[order, 0]
    share = {r["y"]: r["n"] for r in eligible(labels, label, id_col).groupBy("y").agg(F.count("*").alias("n")).collect()}
    whole, weight = sum(share[int(c)] for c in set(y.tolist())), np.ones(len(y))
    for c in set(y.tolist()):
        weight[y == c] = share[int(c)] / whole * len(y) / (y == c).sum()
    lexicon.numbers = tuple(logistic(x, y, weight=weight).tolist())
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, held_out, score, predicted. Null texts score as empty ones; null and
    repeated ids keep their rows; other columns are not read."""
    def make():
        def work(ids, texts):
            return ids, [lexicon.score(t or "") for t in texts]
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_arrow(docs, [id_col, text_col], make, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that score below `threshold`."""
    return keep_rows(docs, text_col, lambda: lambda texts: [lexicon.score(t or "") < threshold for t in texts])
