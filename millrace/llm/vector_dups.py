"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table distances, exact cosine.

Links are pairs of cosine >= `least`, so of unit vectors at most R = sqrt(2 - 2 * least) apart.

1. Equal vectors form a class with a weight and one representative; only representatives go on.
2. Coarse centres and, for each subspace, code words of the residuals are trained on a bounded sample of
   representatives. Every representative is stored in the list of its nearest centre h, with its residual code and the
   distance e between it and what the code stands for.
3. The plane between centres c and h is (|u-c|^2 - |u-h|^2) / (2 |c-h|) away from u. A partner in list c lies beyond it,
   so lists whose plane is more than R away hold none. In many dimensions nearly all planes are nearer than R, but the
   step to a partner is hardly ever along one normal: a vector queries the lists whose plane is within a reach that is
   measured on the sample, so that all but a share `miss` of pairs at the threshold are met from one side or the other.
   With miss=0 the reach is R itself and no link is lost. A link met from one side only counts for both.
4. Lists and their queries are dealt to blocks of bounded size. In a block, tables of squared distances from a
   query's residual to all code words give the distance to every stored code; by the triangle inequality a partner's is
   at most R + e. What passes is settled by the exact cosine in double precision.
5. Stored rows name the lists that they query themselves, so a block knows which links no other block meets. It
   returns, per vector, the weight of its links and one label of a spanning forest, never pairs.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, stored
from millrace.llm.graph import components

SLACK = 1e-3


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """At most k centres of the rows of x."""
    random = np.random.RandomState(seed)
    k = min(k, len(x))
    centres = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((centres * centres).sum(1)[None, :] - 2 * x @ centres.T, axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


class Quantiser:
    """Coarse centres and code words of residual subspaces, trained on unit vectors (rows of x)."""

    def __init__(self, x: np.ndarray, lists: int, parts: int, words: int):
        self.centres = kmeans(x, lists)
        home = self.home(x)
        rest = x - self.centres[home]
        edges = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
        self.spans = list(zip(edges[:-1], edges[1:]))
        self.words = [kmeans(rest[:, a:b], words) for a, b in self.spans]

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.argmin((self.centres ** 2).sum(1)[None, :] - 2 * x @ self.centres.T, axis=1)

    def fit_width(self, x: np.ndarray) -> np.ndarray:
        """Rows padded with zeros, or cut, to the trained width; only used to choose lists and codes of vectors that
        have this width or are compared as they are."""
        width = self.centres.shape[1]
        out = np.zeros((len(x), width))
        out[:, :min(width, x.shape[1])] = x[:, :width]
        return out

    def codes(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes, and the distance between each vector and what its code stands for."""
        rest = x - self.centres[home]
        code, error = np.zeros((len(x), len(self.spans)), np.uint8), np.zeros(len(x))
        for k, (a, b) in enumerate(self.spans):
            part, words = rest[:, a:b], self.words[k]
            code[:, k] = np.argmin((words ** 2).sum(1)[None, :] - 2 * part @ words.T, axis=1)
            error += ((part - words[code[:, k]]) ** 2).sum(1)
        return code, np.sqrt(error)

    def probes(self, x: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
        """Which lists have their plane within `reach`, for every row."""
        far = (self.centres ** 2).sum(1)[None, :] - 2 * x @ self.centres.T
        gap = np.sqrt(((self.centres[home][:, None, :] - self.centres[None, :, :]) ** 2).sum(2))
        return far - far[np.arange(len(x)), home][:, None] <= 2 * gap * (reach + SLACK)

    def planes(self, x: np.ndarray, home: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far each row is from the plane between two centres; 0 where they are one."""
        h, c = self.centres[home], self.centres[other]
        gap = np.sqrt(((c - h) ** 2).sum(1))
        return np.where(home == other, 0, ((c * c).sum(1) - (h * h).sum(1) - 2 * (x * (c - h)).sum(1))
                        / np.where(gap > 0, 2 * gap, 1))

    def reach(self, x: np.ndarray, least: float, miss: float, draws: int = 65_536, rows: int = 4096,
              links: int = 32, margin: float = 1.2) -> float:
        """The plane distance that all but a share `miss` of pairs need, from their better side: of sampled vectors
        with steps to the threshold in random directions, and of `rows` of them with up to `links` of their links in
        the sample. `margin` covers what the sample does not show."""
        random, need = np.random.RandomState(7), []
        for start in range(0, draws, rows):
            u = x[random.randint(len(x), size=min(rows, draws - start))]
            step = random.standard_normal(u.shape)
            step -= (step * u).sum(1)[:, None] * u
            size = np.sqrt((step * step).sum(1))
            u, step = u[size > 0], step[size > 0] / size[size > 0][:, None]  # one dimension has no such step
            need.append(self.either(u, least * u + np.sqrt(1 - least * least) * step))
        found = np.quantile(np.concatenate(need), 1 - miss) if sum(map(len, need)) else 0.0
        own = []
        for start in range(0, min(rows, len(x)), 512):
            u = x[start:start + 512]
            lot = np.where(u @ x.T >= least, random.random_sample((len(u), len(x))), 2)
            drawn = np.argpartition(lot, min(links, len(x)) - 1, axis=1)[:, :links]
            at, k = np.nonzero(np.take_along_axis(lot, drawn, axis=1) < 2)
            own.append(self.either(u[at], x[drawn[at, k]]))
        return margin * float(max(found, np.quantile(np.concatenate(own), 1 - miss)))

    def either(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        a, b = self.home(u), self.home(v)
        return np.minimum(self.planes(u, a, b), self.planes(v, b, a))

    def distances(self, x: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from every code of one list (rows) to every query, from tables: a code picks a row."""
        rest, out = x - self.centres[centre], np.zeros((len(codes), len(x)), np.float32)
        for k, (a, b) in enumerate(self.spans):
            part, words = rest[:, a:b], self.words[k]
            table = (words ** 2).sum(1)[:, None] + (part ** 2).sum(1)[None, :] - 2 * words @ part.T
            out += table.astype(np.float32).take(codes[:, k], axis=0)
        return out


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def narrowed(x: np.ndarray) -> bytes:
    """The bytes of a vector, as single precision where that loses nothing."""
    small = x.astype(np.float32)
    return small.tobytes() if (small.astype(np.float64) == x).all() else x.tobytes()


def rows_of(values: list[bytes], width: int) -> np.ndarray:
    """Vectors of `width` components, stored by `narrowed`, as a matrix of doubles."""
    small = np.fromiter(map(len, values), np.int64, len(values)) == 4 * width
    out = np.empty((len(values), width))
    for kind, rows in ((np.float32, np.flatnonzero(small)), (np.float64, np.flatnonzero(~small))):
        out[rows] = np.frombuffer(b"".join([values[r] for r in rows]), kind).reshape(-1, width)
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of n nodes reaches by links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    return label


def near_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                 sample: int = 16_384, list_rows: int = 512, most_lists: int = 1024, parts: int = 8,
                 words: int = 64, block: int = 2048, miss: float = 1e-5) -> DataFrame:
    """One row per row of `vectors` that has an id: vec_id, n_links, component_id, kept.

    `sample` bounds the rows that the quantiser is trained on, taken by a hash of the vector; all rows are indexed.
    `miss` is the share of pairs at the threshold that may be lost, as measured on the sample; 0 loses none and probes
    most lists. Vectors of another length than most have are always searched without loss.
    Vectors that are null, zero, or hold null or non-finite components, link with nothing; vectors of different lengths
    do not link. Repeated ids count as one vector each. Rows without an id stay alone: no links, a null component,
    kept. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)

    def read(batches):
        for batch in batches:
            ids, keys, widths, raws = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = raw = None
                if v and None not in v:
                    x = np.array(v, np.float64) + 0.0
                    if np.isfinite(x).all() and x.any():
                        x = x / 2.0 ** np.frexp(np.abs(x).max())[1]  # exact, and no square overflows
                        raw = narrowed(x)
                        key = xxhash.xxh3_128_digest(x.tobytes())
                ids.append(i)
                keys.append(key)
                widths.append(len(v) if raw else None)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(widths, pa.int32()), pa.array(raws, pa.binary())],
                                             ["vec_id", "key", "width", "raw"])

    own = stored(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col))
                 .mapInArrow(read, "vec_id long, key binary, width int, raw binary"), "vectors")
    good = own.where("vec_id is not null and key is not null")
    classes = stored(good.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "classes")
    reps = (good.join(classes.select(F.col("rep").alias("vec_id"), "key", "weight"), ["vec_id", "key"])
            .dropDuplicates(["vec_id", "key"]))
    reps = stored(reps.select("vec_id", "weight", "width", "raw"), "representatives")
    n = reps.count()
    empty = spark.createDataFrame([], "node long, component long")
    if n:
        width = reps.groupBy("width").count().orderBy(F.desc("count"), "width").first()["width"]
        drawn = (reps.where(F.col("width") == width).orderBy(F.xxhash64("raw"), "vec_id").limit(sample)
                 .select("raw").collect())
        trained = unit(rows_of([r["raw"] for r in drawn], width))
        model = Quantiser(trained, min(most_lists, max(1, n // list_rows)), parts, words)
        known = spark.sparkContext.broadcast(model)  # bounded by the parameters, whatever the data
        reach = model.reach(trained, least, miss) if miss else float(np.sqrt(2 - 2 * least))
        linked = stored(_linked(reps, known, least, reach, block), "linked")
        sums = linked.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
        groups = components(linked.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    else:
        sums, groups = spark.createDataFrame([], "node long, links long"), empty
    found = (classes.join(sums, F.col("rep") == F.col("node"), "left").drop("node")
             .join(groups, F.col("rep") == F.col("node"), "left")
             .select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return (own.select("vec_id", "key").join(found, "key", "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0)))
                    .cast("long").alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _linked(reps: DataFrame, known, least: float, reach: float, block: int) -> DataFrame:
    """(node, links, label): weights of links by block and query, and the labels of a spanning forest."""
    radius = float(np.sqrt(2 - 2 * least))

    def placed(batches):
        """Vectors with their lists: rows of the batch, ids, weights, homes, codes, errors, probes, vectors."""
        model = known.value
        for batch in batches:
            ids, widths = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            raws, weights = batch.column(3).to_pylist(), batch.column(1).to_numpy()
            for width in np.unique(widths):
                own = radius if width != model.centres.shape[1] else min(reach, radius)
                for rows in np.array_split(np.flatnonzero(widths == width), -(-(widths == width).sum() // 256)):
                    raw = [raws[r] for r in rows]
                    x = model.fit_width(unit(rows_of(raw, width)))
                    home = model.home(x)
                    yield ids[rows], weights[rows], width, raw, x, home, model.probes(x, home, own)

    def size(batches):
        lists = len(known.value.centres)
        n, q = np.zeros(lists, np.int64), np.zeros(lists, np.int64)
        for *_, home, asked in placed(batches):
            n += np.bincount(home, minlength=lists)
            q += asked.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(lists, dtype=np.int32)), pa.array(n), pa.array(q)],
                                         ["list", "n", "q"])

    def assign(batches):
        model = known.value
        for ids, weights, width, raw, x, home, probes in placed(batches):
            code, error = model.codes(x, home)
            # What a cut takes away counts as error, and only shortens distances.
            error = error + np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
            asked, lists = np.nonzero(probes)
            at = np.concatenate([np.arange(len(ids)), asked])
            is_query = np.arange(len(at)) >= len(ids)
            own = np.split(lists.astype(np.int32), np.cumsum(probes.sum(1))[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([home, lists]).astype(np.int32)), pa.array(is_query),
                 pa.array(ids[at]), pa.array(weights[at]), pa.array(home[at].astype(np.int32)),
                 pa.array([None if q else code[i].tobytes() for i, q in zip(at, is_query)], pa.binary()),
                 pa.array([None if q else own[i].tobytes() for i, q in zip(at, is_query)], pa.binary()),
                 pa.array(error[at]), pa.array(np.full(len(at), width, np.int32)),
                 pa.array([raw[i] for i in at], pa.binary())],
                ["list", "query", "vec_id", "weight", "home", "code", "asks", "error", "width", "raw"])

    rows = reps.mapInArrow(assign, "list int, query boolean, vec_id long, weight long, home int, code binary, "
                                   "asks binary, error double, width int, raw binary")
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.sum(c) / block)).cast("int").alias(c)
    sizes = reps.mapInArrow(size, "list int, n long, q long").groupBy("list").agg(blocks("n"), blocks("q"))
    part = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    dealt = (rows.join(F.broadcast(stored(sizes, "lists")), "list")  # one row a list, at most `most_lists`
             .withColumn("i", F.explode(F.when(F.col("query"), every("n")).otherwise(F.array(part("n")))))
             .withColumn("j", F.explode(F.when(F.col("query"), F.array(part("q"))).otherwise(every("q"))))
             .drop("n", "q"))

    def meet(group: pa.Table) -> pa.Table:
        model, out = known.value, ([], [], [])
        column = lambda name, rows: group.column(name).take(pa.array(rows))
        query = group.column("query").to_numpy()
        widths = group.column("width").to_numpy()
        centre = group.column("list")[0].as_py()
        for width in np.unique(widths):
            left, right = np.flatnonzero(query & (widths == width)), np.flatnonzero(~query & (widths == width))
            if not len(left) or not len(right):
                continue
            u, v = (rows_of(column("raw", side).to_pylist(), width) for side in (left, right))
            nu, nv = np.sqrt((u * u).sum(1)), np.sqrt((v * v).sum(1))
            ids, stored_ids = column("vec_id", left).to_numpy(), column("vec_id", right).to_numpy()
            weight, error = column("weight", right).to_numpy(), column("error", right).to_numpy()
            asking, home = column("weight", left).to_numpy(), column("home", left).to_numpy()
            asks = [np.frombuffer(z, np.int32) for z in column("asks", right).to_pylist()]
            mutual = np.zeros((len(right), len(model.centres)), bool)  # which lists the stored rows query themselves
            mutual[np.repeat(np.arange(len(right)), list(map(len, asks))), np.concatenate(asks)] = True
            codes = np.frombuffer(b"".join(column("code", right).to_pylist()), np.uint8).reshape(len(right), -1)
            x = model.fit_width(unit(u))
            bound = ((radius + error + SLACK) ** 2).astype(np.float32)
            a, b, sums, back = [], [], np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
            for start in range(0, len(left), 256):
                s, q = np.nonzero(model.distances(x[start:start + 256], centre, codes) <= bound[:, None])
                other = ids[start + q] != stored_ids[s]
                q, s = q[other], s[other]
                for cut in range(0, len(q), 1 << 16):
                    qs, ss = q[cut:cut + (1 << 16)] + start, s[cut:cut + (1 << 16)]
                    cosine = np.einsum("ij,ij->i", u[qs], v[ss]) / (nu[qs] * nv[ss])
                    qs, ss = qs[cosine >= least], ss[cosine >= least]
                    np.add.at(sums, qs, weight[ss])
                    alone = ~mutual[ss, home[qs]]
                    np.add.at(back, ss[alone], asking[qs[alone]])
                    a.append(qs)
                    b.append(ss)
            a, b = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (a, b))
            if not len(a):
                continue
            nodes, place = np.unique(np.concatenate([ids[a], stored_ids[b]]), return_inverse=True)
            label = nodes[forest(place[:len(a)], place[len(a):], len(nodes))]
            asked, met = np.flatnonzero(sums), np.flatnonzero(back)
            own = np.concatenate([ids[asked], stored_ids[met]])
            out[0].append(np.concatenate([own, nodes]))
            out[1].append(np.concatenate([sums[asked], back[met], np.zeros(len(nodes), np.int64)]))
            out[2].append(np.concatenate([own, label]))
        return pa.table({name: np.concatenate(z) if z else np.empty(0, np.int64)
                         for name, z in zip(("node", "links", "label"), out)})

    return dealt.groupBy("list", "i", "j").applyInArrow(meet, "node long, links long, label long")
