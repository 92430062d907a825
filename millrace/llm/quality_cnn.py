"""Quality by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Learned filters slide over each chunk; the largest
response of every filter, squeezed by tanh, and the filled share of the chunk go through one hidden layer to the chunk's
logit. The mean, smallest and largest logit of a text's chunks, weighted by a logistic function fitted on other texts,
give one probability.

Filters over bytes are sums of table rows, so a response is as many look-ups as the filter is wide. As only
the place of the largest response matters, its gradient reaches few table rows and training takes seconds.
The model learns from a bounded, balanced sample; the true shares of the classes are put back into the constant.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep_rows, map_arrow, ship, stored
from millrace.llm.labelled import held_out, sample
from millrace.llm.toxicity import logistic

CHUNK, STRIDE, PAD = 256, 224, 256


def chunks_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that cover all of a text (PAD where they are not filled) and their filled shares."""
    n = len(raw)
    starts = np.arange(0, max(1, n - (CHUNK - STRIDE)), STRIDE)
    padded = np.full(int(starts[-1]) + CHUNK, PAD, np.int16)
    padded[:min(n, len(padded))] = np.frombuffer(raw, np.uint8)[:len(padded)]
    filled = np.minimum(CHUNK, n - starts) / CHUNK
    return padded[starts[:, None] + np.arange(CHUNK)[None, :]], np.maximum(filled, 0.0)


class Network:
    """Filters (tables by place in the filter), a hidden layer, and the numbers that combine a text's chunks."""

    def __init__(self, filters: int = 16, width: int = 5, hidden: int = 12, seed: int = 11):
        random = np.random.RandomState(seed)
        self.p = {"t": random.normal(0, 0.3, (width, 257, filters)), "b1": np.zeros(hidden), "b2": np.zeros(1),
                  "w1": random.normal(0, 0.3, (filters + 1, hidden)), "w2": random.normal(0, 0.3, hidden)}
        self.numbers = np.array([0.0, 1.0, 0.0, 0.0])

    def pooled(self, chunks: np.ndarray, want_place: bool = False):
        """The largest response of every filter in every chunk, and where it is."""
        t = self.p["t"].astype(np.float32)
        width, n = len(t), chunks.shape[1] - len(t) + 1
        best, place = np.empty((len(chunks), t.shape[2]), np.float32), None
        if want_place:
            place = np.empty(best.shape, np.int64)
        for start in range(0, len(chunks), 32):  # small enough for the cache
            own = chunks[start:start + 32].astype(np.intp)
            out = t[0].take(own[:, :n], axis=0)
            for k in range(1, width):
                out += t[k].take(own[:, k:k + n], axis=0)
            if want_place:
                at = out.argmax(axis=1)
                place[start:start + 32] = at
                best[start:start + 32] = np.take_along_axis(out, at[:, None, :], axis=1)[:, 0, :]
            else:
                best[start:start + 32] = out.max(axis=1)
        return best, place

    def head(self, pooled: np.ndarray, filled: np.ndarray):
        x = np.column_stack([np.tanh(pooled), filled])
        h = np.tanh(x @ self.p["w1"] + self.p["b1"])
        return x, h, h @ self.p["w2"] + self.p["b2"][0]

    def logits(self, chunks: np.ndarray, filled: np.ndarray) -> np.ndarray:
        return self.head(self.pooled(chunks)[0], filled)[2]

    def train(self, chunks: np.ndarray, filled: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 10,
              batch: int = 256, least_steps: int = 600, rate: float = 0.01, seed: int = 3) -> None:
        """Adam on the weighted log loss of chunks, `least_steps` steps at least."""
        rounds = max(rounds, -(-least_steps // max(1, len(chunks) // batch)))
        random, p, step = np.random.RandomState(seed), self.p, 0
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        filters = p["t"].shape[2]
        for turn in range(rounds):
            for rows in np.array_split(random.permutation(len(chunks)), max(1, len(chunks) // batch)):
                if not len(rows):
                    continue
                own = chunks[rows]
                best, place = self.pooled(own, True)
                x, h, out = self.head(best, filled[rows])
                d = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows]) * weight[rows] / len(rows)
                dh = np.outer(d, p["w2"]) * (1 - h * h)
                dx = (dh @ p["w1"].T)[:, :filters] * (1 - x[:, :filters] ** 2)
                g = {"w2": h.T @ d, "b2": np.array([d.sum()]), "w1": x.T @ dh, "b1": dh.sum(0),
                     "t": np.stack([np.bincount(
                         (np.take_along_axis(own, place + k, axis=1).astype(np.int64) * filters
                          + np.arange(filters)).ravel(), dx.ravel(), 257 * filters).reshape(257, filters)
                         for k in range(len(p["t"]))])}
                step += 1
                slow = rate * (0.2 if turn >= rounds * 0.7 else 1)
                for k in p:
                    grad = g[k] + 1e-5 * p[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    p[k] = p[k] - slow * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Mean, smallest and largest chunk logit of each text, over all of its chunks."""
        out = np.zeros((len(texts), 3))
        made = [chunks_of((t or "").encode()) for t in texts]
        if not made:
            return out
        logits = self.logits(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]))
        ends = np.cumsum([len(m[0]) for m in made])
        for i, (end, m) in enumerate(zip(ends, made)):
            own = logits[end - len(m[0]):end]
            w = np.maximum(m[1], 1e-3)
            out[i] = (own * w).sum() / w.sum(), own.min(), own.max()
        return out

    def scores(self, texts: list[str | None]) -> list[float]:
        x = self.numbers[0] + self.features(texts) @ self.numbers[1:]
        return (1 / (1 + np.exp(-np.clip(x, -30, 30)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 8_000, most_bytes: int = 1 << 25,
        rounds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """A network from at most `most` labelled rows outside the held-out third, half of each class where there are so
    many. Every second row trains the filters, as many whole texts, in the order of a hash of their ids, as `most_bytes`
    hold, and one at least; each text weighs the same, dealt evenly to all of its chunks. The other rows fit how chunks are
    combined. Without labels of both classes the score is the smoothed share."""
    spark = docs.sparkSession
    ship(spark)
    rows = stored(sample(docs, labels, label, most, id_col, text_col), "quality-sample")
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id")))
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    network = Network()
    kind = rows.schema["doc_id"].dataType.simpleString()
    half = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2))
    order = F.xxhash64(F.lit(7), "doc_id", "text")
    sizes = sorted(tuple(r) for r in rows.where(half == 0).select(order, F.octet_length("text")).collect())
    fits = np.cumsum([n for _, n in sizes]) <= most_bytes
    taken = max(1, int(fits.sum()))
    drawn = [] if not sizes else (rows.where((half == 0) & (order <= sizes[taken - 1][0]))
                                  .select("doc_id", "y", F.col("text").cast("binary").alias("raw")).collect())
    drawn.sort(key=lambda r: (r["doc_id"], r["raw"]))
    if len({r["y"] for r in drawn}) == 2:
        made = [chunks_of(bytes(r["raw"])) for r in drawn]
        n = np.array([len(m[1]) for m in made])
        network.train(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]),
                      np.repeat([r["y"] for r in drawn], n).astype(float), np.repeat(n.mean() / n, n), rounds)

    def measure():
        def work(ids, y, texts):
            x = network.features(texts)
            return ids, y, *x.T.tolist()
        return work

    points = map_arrow(rows.where(half == 1), ["doc_id", "y", "text"], measure,
                       f"doc_id {kind}, y int, a double, b double, c double").collect()
    points.sort(key=lambda r: r["doc_id"])
    if points:
        y = np.array([r["y"] for r in points], float)
        network.numbers = logistic(np.array([[r["a"], r["b"], r["c"]] for r in points]), y)
        if len(set(y.tolist())) == 2:
            network.numbers[0] += np.log(share[1] / share[0]) - np.log(y.sum() / (len(y) - y.sum()))
        else:
            network.numbers[1:] = 0
    else:
        network.numbers = np.zeros(4)
    return network


def score(docs: DataFrame, network: Network, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, held_out, score, predicted. Null texts score as empty ones; null and
    repeated ids keep their rows; other columns are not read."""
    def make():
        def work(ids, texts):
            return ids, network.scores(texts)
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    scored = map_arrow(docs, [id_col, text_col], make, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, network: Network, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that score at least `threshold`."""
    return keep_rows(docs, text_col, lambda: lambda texts: [s >= threshold for s in network.scores(texts)])
