"""Near copies by MinHash bands and odd sketches, confirmed on full shingle sets.

1. One pass gives every text the hashes of its distinct five-word shingles, and from them k MinHash samples. Bands of
   `rows` samples are the candidate keys. All samples are folded into a parity bitmap (an odd sketch): sample i flips
   one bit. The population count of two bitmaps' XOR tells how many samples differ, precisely so for high similarity.
2. Texts with one and the same shingle set form a class with one representative; only those go on, so copies cost nothing.
3. Every representative meets the head of each of its bands: the member that shares its bands with most others. In a
   group of copies that is the text they were made from, for it is nearer to each than they are to one another. Pairs
   whose sketches are far from `least` go; the others are confirmed on the full sets. What is confirmed joins
   representatives into components.
4. A band whose other members lie in several components may hide links that its head does not show. Its members are
   compared with each other in blocks of bounded size, sketch against sketch inside the task. First only the closest
   partner of each member leaves it and is confirmed, until that joins nothing more. Then the members that still have a
   close partner in another component get their full sets, and all pairs between what are still several components are
   confirmed inside the task, each in the first band that it shares; only a spanning forest of the links leaves it.

What is known of a representative (its component, sketch and set) meets one row that lists its bands; rows by band are
made from that row, never joined one by one.

A pair at the threshold shares no band with probability (1 - 0.75^rows)^bands, about 5e-6 here; the sketch test lies
six standard deviations below the threshold. Shingles are told apart by 64-bit hashes.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Memo, map_arrow, may_hold, ship, stored
from millrace.llm.graph import components
from millrace.llm.vector_dups import forest

MIX = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z lowered."""
    return text.encode().lower().split()


def word_hashes() -> Memo:
    """Hashes of words, remembered by one task: a worker that goes on to other work does not keep them."""
    return Memo(xxhash.xxh3_64_intdigest, 300_000)


def shingles(text: str, size: int = 5, known: Memo | None = None) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of the whole text if it has fewer words, none if none."""
    known = word_hashes() if known is None else known
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(known.__getitem__, words)), np.uint64)
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = scramble(out * np.uint64(MIX) + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Sketcher:
    def __init__(self, bands: int, rows: int, bits: int):
        self.bands, self.rows, self.bits = bands, rows, bits
        random = np.random.RandomState(7)
        n = bands * rows
        self.by = random.randint(0, 1 << 62, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = random.randint(0, 1 << 62, n).astype(np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest value of each of the hash functions."""
        best = np.full(len(self.by), np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for start in range(0, len(hashes), 2048):
                x = hashes[start:start + 2048][None, :] * self.by[:, None] + self.plus[:, None]
                x ^= x >> np.uint64(29)
                np.minimum(best, x.min(axis=1), out=best)
        return best

    def keys(self, samples: np.ndarray) -> np.ndarray:
        """One key a band, in which the band's number is mixed."""
        with np.errstate(over="ignore"):
            out = np.arange(1, self.bands + 1, dtype=np.uint64) * np.uint64(MIX)
            for column in samples.reshape(self.bands, self.rows).T:
                out = scramble(out ^ column) + column
        return out.view(np.int64)

    def sketch(self, samples: np.ndarray) -> bytes:
        """Parity of the samples that fall on each bit."""
        with np.errstate(over="ignore"):
            spots = scramble(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(MIX))
        parity = np.bincount((spots % np.uint64(self.bits)).astype(np.int64), minlength=self.bits) & 1
        return np.packbits(parity.astype(np.uint8)).tobytes()


def far_bits(similarity: float, samples: int, bits: int) -> float:
    """Population count of the XOR that is expected where `similarity` of the samples agree."""
    return bits / 2 * (1 - (1 - 2 / bits) ** (2 * samples * (1 - similarity)))


def signatures(docs: DataFrame, id_col: str, text_col: str, sketcher: Sketcher, size: int) -> DataFrame:
    """doc_id, n_shingles, key (a 128-bit hash of the set), bands, sketch. Sets that are empty have no bands."""
    def make():
        known = word_hashes()

        def work(ids, texts):
            n, keys, bands, sketches = [], [], [], []
            for text in texts:
                hashes = shingles(text or "", size, known)
                n.append(len(hashes))
                if len(hashes):
                    samples = sketcher.samples(hashes)
                    keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    bands.append(sketcher.keys(samples).tolist())
                    sketches.append(sketcher.sketch(samples))
                else:
                    for column in (keys, bands, sketches):
                        column.append(None)
            return ids, n, keys, bands, sketches
        return work

    return map_arrow(docs, [id_col, text_col], make,
                     "doc_id long, n_shingles long, key binary, bands array<long>, sketch binary")


def close(pairs: DataFrame, most: float) -> DataFrame:
    """The pairs (a, b) whose sketches sa and sb differ in at most `most` bits."""
    def measure(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                    for k in (2, 3))
            apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            yield batch.select([0, 1]).filter(pa.array(apart <= most))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(measure, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets meet 100 * |both| >= percent * |either|. Each pair carries one set at a time."""
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"))
    both = pairs.join(right, "b").join(left, "a")

    def measure(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * n >= percent * (len(x) + len(y) - n))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ha", "hb").mapInArrow(measure, "a long, b long")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Full shingle sets (64-bit hashes as bytes) of the documents in `wanted`."""
    own = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
           .join(wanted, "doc_id", "left_semi"))

    def make():
        known = word_hashes()

        def work(ids, texts):
            return ids, [shingles(t or "", size, known).tobytes() for t in texts]
        return work

    return map_arrow(own, ["doc_id", "text"], make, "doc_id long, hashes binary")


def blocks(members: DataFrame, block: int, size: int, *more: str) -> DataFrame:
    """Members of a band, (band, doc_id, component, home, sketch, ...), dealt to groups (band, i, j) with a column
    `query`. Every member outside the band's home component meets every other member in exactly one group.

    Those outside are dealt to parts by a hash of the id, and so are all members; a part holds about `block` members and
    `size` bytes, so no group grows with the band.
    """
    stranger = F.col("component") != F.col("home")
    held = F.length("sketch") + (sum((F.length(c) for c in more if c == "hashes"), F.lit(0)))
    parts = lambda n, b: F.greatest(F.ceil(n / block), F.ceil(b / size)).cast("int")
    sizes = (members.groupBy("band").agg(
        F.count_if(stranger).alias("n"), F.sum(F.when(stranger, held)).alias("b"), F.count("*").alias("m"),
        F.sum(held).alias("c")).where("n > 0")
        .select("band", parts(F.col("n"), F.col("b")).alias("few"), parts(F.col("m"), F.col("c")).alias("all")))
    own = members.join(sizes, "band")
    part = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    row = ["doc_id", "component", "sketch", *more]
    each = own.select("band", every("few").alias("i"), part("all").alias("j"), F.lit(False).alias("query"), *row)
    asked = own.where(stranger).select("band", part("few").alias("i"), every("all").alias("j"),
                                       F.lit(True).alias("query"), *row)
    return each.unionAll(asked)


def bits_of(column) -> np.ndarray:
    """Sketches as rows of -1 and 1."""
    values = column.to_pylist()
    bits = np.unpackbits(np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1), axis=1)
    return bits.astype(np.float32) * 2 - 1


def nearby(group: pa.Table, most: float):
    """For slices of a group's queries: their places, the other members' places, distances, and which are close and of
    another component."""
    asked = group.column("query").to_numpy()
    left, right = np.flatnonzero(asked), np.flatnonzero(~asked)
    component = group.column("component").to_numpy()
    if len(left) and len(right):
        xa, xb = (bits_of(group.column("sketch").take(pa.array(p))) for p in (left, right))
        for start in range(0, len(left), 512):
            own = left[start:start + 512]
            apart = (xa.shape[1] - xa[start:start + 512] @ xb.T) / 2
            yield own, right, apart, (apart <= most) & (component[own][:, None] != component[right][None, :])


def closest_pairs(dealt: DataFrame, most: float) -> DataFrame:
    """(a, b): every query of a group with its closest member of another component, if its sketch is close."""
    def meet(group: pa.Table) -> pa.Table:
        ids, out = group.column("doc_id").to_numpy(), [np.empty((0, 2), np.int64)]
        for left, right, apart, near in nearby(group, most):
            x = np.flatnonzero(near.any(axis=1))
            y = np.where(near, apart, np.inf)[x].argmin(axis=1) if len(x) else x
            out.append(np.sort(np.column_stack([ids[left[x]], ids[right[y]]]), axis=1))
        both = np.concatenate(out)
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    return dealt.groupBy("band", "i", "j").applyInArrow(meet, "a long, b long").distinct()


def with_partners(dealt: DataFrame, most: float) -> DataFrame:
    """(doc_id, band): members that have a close one of another component in a band, queries and others."""
    def meet(group: pa.Table) -> pa.Table:
        ids, out = group.column("doc_id").to_numpy(), [np.empty(0, np.int64)]
        for left, right, _, near in nearby(group, most):
            out += [ids[left[near.any(axis=1)]], ids[right[near.any(axis=0)]]]
        found = np.unique(np.concatenate(out))
        band = group.column("band")[0].as_py() if group.num_rows else 0
        return pa.table({"doc_id": found, "band": np.full(len(found), band, np.int64)})

    return dealt.groupBy("band", "i", "j").applyInArrow(meet, "doc_id long, band long").distinct()


def linked_pairs(dealt: DataFrame, most: float, percent: int) -> DataFrame:
    """(a, b): a spanning forest, by group, of all confirmed links between components. A pair counts in the first band
    that both share; the head of a band has met all others before."""
    def meet(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_numpy()
        asked = {i for i, q in zip(ids.tolist(), group.column("query").to_pylist()) if q}
        bands = np.array(group.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        here = int(np.flatnonzero(bands[0] == group.column("band")[0].as_py())[0]) if len(ids) else 0
        links = []
        for left, right, _, near in nearby(group, most):
            x, y = np.nonzero(near)
            for start in range(0, len(x), 1 << 16):
                p, q = left[x[start:start + (1 << 16)]], right[y[start:start + (1 << 16)]]
                first = (bands[p] == bands[q]).argmax(axis=1) == here
                for a, b in zip(p[first].tolist(), q[first].tolist()):
                    if ids[b] in asked and ids[a] > ids[b]:
                        continue  # the other way round in another place
                    s, t = sets[a], sets[b]
                    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
                        continue
                    n = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * n >= percent * (len(s) + len(t) - n):
                        links.append((ids[a], ids[b]))
        both = np.array(links, np.int64).reshape(-1, 2)
        nodes, place = np.unique(both, return_inverse=True)
        place = place.reshape(-1, 2)
        label = nodes[forest(place[:, 0], place[:, 1], len(nodes))] if len(nodes) else nodes
        return pa.table({"a": label, "b": nodes})

    return dealt.groupBy("band", "i", "j").applyInArrow(meet, "a long, b long").where("a != b").distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = 5,
                bands: int = 32, rows: int = 4, bits: int = 1024, block: int = 2048, block_bytes: int = 1 << 24) -> DataFrame:
    """One row per row of `docs` that has an id: doc_id, n_shingles, component_id, kept.

    The component is the smallest doc_id reachable by links; kept says that it is the row's own. Texts that are null or
    hold no word link with nothing. Rows without an id stay alone with a null component and are kept. Rows that
    repeat an id are rows of one document if their texts are equal. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    sketcher = Sketcher(bands, rows, bits)
    signed = stored(signatures(docs, id_col, text_col, sketcher, size), "signatures")
    known = signed.where("doc_id is not null and key is not null")
    classes = stored(known.groupBy("key").agg(F.min("doc_id").alias("rep")), "classes")
    single = stored(known.join(classes.select(F.col("rep").alias("doc_id"), "key"), ["doc_id", "key"], "left_semi")
                    .dropDuplicates(["doc_id", "key"]).select("doc_id", "bands", "sketch"), "representatives")
    member = stored(band_members(single), "members")
    lists = stored(member.groupBy("doc_id").agg(F.collect_list(F.struct("band", "top")).alias("at")), "lists")
    limit = far_bits(percent / 100 - 6 * (0.75 * 0.25 / (bands * rows)) ** 0.5, bands * rows, bits)
    star = member.select(F.col("top").alias("a"), F.col("doc_id").alias("b")).distinct()
    sketches = single.select("doc_id", "sketch")
    star = stored(close(star.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a")
                        .join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b"), limit),
                  "star")
    links = stored(confirmed(docs, star, id_col, text_col, size, percent), "confirmed")
    groups = components(links)

    while True:
        left = stored(strangers(lists, groups), "strangers")
        if left.isEmpty():
            break
        dealt = blocks(by_band(left, sketches), block, block_bytes)
        more = stored(closest_pairs(dealt, limit), "closest")
        if more.isEmpty():
            break
        found = stored(confirmed(docs, more, id_col, text_col, size, percent), "confirmed")
        last = found.isEmpty()
        if last:
            near = (with_partners(dealt, limit).groupBy("doc_id").agg(F.collect_set("band").alias("bands"))
                    .withColumnRenamed("doc_id", "id"))
            left = stored(left.join(near, F.col("doc_id") == F.col("id")).select(
                "doc_id", "component", F.filter("at", lambda x: F.array_contains("bands", x["band"])).alias("at")), "near")
            sets = sets_of(docs, left.select("doc_id"), id_col, text_col, size)
            full = by_band(left, single.join(stored(sets, "sets"), "doc_id"))
            found = stored(linked_pairs(blocks(full, block, block_bytes, "bands", "hashes"), limit, percent), "linked")
        links = links.unionAll(found)
        groups = components(links)
        if last:
            break
    top = groups.select(F.col("node").alias("rep"), F.col("component"))
    classes = classes.join(top, "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    return (signed.select("doc_id", "n_shingles", "key").join(classes, "key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def band_members(single: DataFrame) -> DataFrame:
    """(band, doc_id, top): members of bands that several representatives share, apart from each band's head, `top`.

    The head shares its bands with most others, counted over all of its bands; of several the smallest id.
    """
    spread = single.select("doc_id", F.explode("bands").alias("band"))
    sizes = stored(spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    held = stored(spread.where(may_hold(sizes, "band")("band")).join(sizes, "band").groupBy("doc_id").agg(F.sum("n").alias("weight"),
                                                                   F.collect_list("band").alias("bands")), "shared")
    each = held.select(F.explode("bands").alias("band"), "doc_id", "weight")
    tops = stored(each.groupBy("band").agg(F.min(F.struct(-F.col("weight"), "doc_id"))["doc_id"].alias("top")), "tops")
    return each.join(tops, "band").where("doc_id != top").select("band", "doc_id", "top")


def strangers(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc_id, component, at): for every member of bands whose members, their heads apart, lie in several components,
    those bands, each with `home`, the component of its head."""
    place = groups.withColumnRenamed("node", "doc_id")
    placed = stored(lists.join(place, "doc_id", "left")
                    .select("doc_id", F.coalesce("component", "doc_id").alias("component"), F.explode("at").alias("at"))
                    .select("doc_id", "component", "at.band", "at.top"), "placed")
    several = (placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                          F.min("top").alias("top")).where("x != y"))
    home = stored(several.join(groups.withColumnRenamed("node", "top"), "top", "left")
                  .select("band", F.coalesce("component", "top").alias("home")), "homes")
    return placed.join(home, "band").groupBy("doc_id", "component").agg(F.collect_list(F.struct("band", "home")).alias("at"))


def by_band(left: DataFrame, known: DataFrame) -> DataFrame:
    """Strangers with what is known of each document, one row for each of its bands."""
    known = known.where(may_hold(left, "doc_id")("doc_id"))
    return (left.join(known, "doc_id").withColumn("at", F.explode("at"))
            .select("at.band", "at.home", *[c for c in left.columns if c != "at"],
                    *[c for c in known.columns if c != "doc_id"]))


def confirmed(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    return confirm(pairs, stored(sets_of(docs, wanted, id_col, text_col, size), "sets"), percent)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, all columns as they are: that of the smallest id.

    A document is an id with its text. Rows that repeat both are one document, of which one row stays. Where different
    texts carry one id, each is judged by itself; all but the first of them, by a hash of the text, rank behind every other
    id. Rows without an id stay, and so do texts without words. Documents that go are taken out by id and hash; only
    texts that a map of them marks move for it, which are they and a few others.
    """
    digest = F.xxhash64(text_col)
    seen = stored(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"), digest.alias("hash")).count(), "seen")
    several = seen.groupBy("id").agg(F.min("hash").alias("first"), F.count(F.lit(1)).alias("texts")).where("texts > 1")
    twins = stored(seen.join(several, "id").where("hash != first").select("id", "hash", F.monotonically_increasing_id().alias("place")), "twins")
    last = seen.agg(F.max("id")).first()[0] or 0
    own = docs.select(F.col(id_col).alias("id"), digest.alias("hash"), F.col(text_col).alias("text"))
    if twins.isEmpty():
        own, nodes = own.withColumnRenamed("id", "doc_id"), seen.withColumnRenamed("id", "doc_id").withColumn("id", F.col("doc_id"))
    else:
        node = F.coalesce(F.col("place") + last + 1, "id").alias("doc_id")
        own = own.join(twins, ["id", "hash"], "left").select(node, "hash", "text")
        nodes = seen.join(twins, ["id", "hash"], "left").select(node, "id", "hash", "count")
    found = stored(near_copies(own).select("doc_id", "kept"), "near-copies")
    gone = found.where("not kept").select("doc_id").distinct()
    gone = stored(nodes.join(gone, "doc_id", "left_semi").select(F.col("id").alias("_gone_id"), F.col("hash").alias("_gone_hash")), "gone")
    left = without(docs, gone, id_col, text_col)
    again = stored(seen.where("count > 1").select(F.col("id").alias("_again_id"), F.col("hash").alias("_again_hash")), "again")
    if again.isEmpty():
        return left
    same = (left[id_col] == again["_again_id"]) & (F.xxhash64(left[text_col]) == again["_again_hash"])
    repeated = left.join(again, same, "left_semi").withColumn("_again_hash", digest).dropDuplicates([id_col, "_again_hash"])
    return left.join(again, same, "left_anti").unionAll(repeated.drop("_again_hash"))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` whose id and hash of the text are not in `gone` (_gone_id, _gone_hash)."""
    marked = may_hold(gone, "_gone_id", "_gone_hash")(F.col(id_col), F.xxhash64(text_col))
    some = docs.where(marked)
    same = (some[id_col] == gone["_gone_id"]) & (F.xxhash64(some[text_col]) == gone["_gone_hash"])
    return docs.where(~marked).unionAll(some.join(gone, same, "left_anti"))
