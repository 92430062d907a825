"""Spelling variants: words one edit apart, found in a trie of letter-group counts, and the roots their forms lead to.

A word is the vector of its length and of how many letters of each group it has, and the trie holds words by these counts,
one level each. One edit changes at most one count upwards and one downwards, so a search spends a surplus and a deficit
of one each on its way down; the words of the leaves that it reaches are compared letter by letter. Each pair is searched
from one side: from the longer word, or, of two of one length, from the one with fewer letters of the first group in which
they differ. So a search takes its deficit without a surplus only if it looks for shorter words, and else after it.

The top of the trie is a table of nodes: all words descend through it together, level by level, as long as a node holds
more than `most` words. Below such a node's children the trie is built and searched, depth first, inside a task.
"""
from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
#: Letters whose number makes one level of the trie, below that of the length; all others make none.
GROUPS = ("e", "a", "i", "o", "n", "r", "t", "s", "l", "uw", "d", "c", "mg", "ph", "éèê", "bvy")
LEVELS = len(GROUPS) + 1
#: What a search has spent: nothing yet, its surplus, all it may; or it looks for shorter words and has its deficit left.
SAME, RISEN, SPENT, SHORTER = range(4)
LEAF = 8


def damaged_runs(docs: DataFrame, id_col: str, text_col: str, least_length: int, every: int) -> DataFrame:
    """(word) for each run of letters that may count: A to Z lower-cased, and where the crc32 of `<id>:<run>` is a
    multiple of `every` without the code point at that crc32 modulo the run's length."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text_col, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_length)
    runs = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", CAPITALS, SMALL))
                       .otherwise(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
             least_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of all words that are long and common enough."""
    return (damaged_runs(docs, id_col, text_col, least_length, every).where(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def group_counts(word: Column) -> Column:
    """A word's length, and how many letters of each group it has."""
    return F.array(F.char_length(word), *[F.char_length(word) - F.char_length(F.translate(word, g, "")) for g in GROUPS])


def ways(level: int) -> Column:
    """What a search may do at a level of the trie: (edge, spent). A node is named by the edges that lead to it."""
    count, spent = F.get("counts", F.lit(level)), F.col("spent")
    way = lambda change, after: F.struct(F.concat((count + change).cast("string"), F.lit(",")).alias("edge"),
                                         after.cast("int").alias("spent"))
    if level == 0:
        return F.array(way(0, F.lit(SAME)), way(-1, F.lit(SHORTER)))
    return F.filter(F.array(way(0, spent), F.when(spent == SAME, way(1, F.lit(RISEN))),
                            F.when(spent.isin(RISEN, SHORTER), way(-1, F.lit(SPENT)))), lambda w: w.isNotNull())


def descend(words: DataFrame, most: int) -> DataFrame:
    """(word, n, counts, node, level, spent, held): the nodes of at most `most` words (`held`; more only where no level is
    left) that each word's search reaches, with what it has spent. A word is itself in the one that it reaches as SAME."""
    front = stored(words.select("word", "n", "counts", F.lit("").alias("node"), F.lit(SAME).alias("spent")), "descent")
    reached = None
    for level in range(LEVELS + 1):
        sizes = stored(front.where(F.col("spent") == SAME).groupBy("node").agg(F.count(F.lit(1)).alias("held")), "nodes")
        full = F.lit(level < LEVELS) & (F.col("held") > most)
        ended = front.join(sizes.where(~full), "node").withColumn("level", F.lit(level))
        reached = ended if reached is None else reached.unionByName(ended)
        if sizes.where(full).isEmpty():
            return reached
        open_ = front.join(sizes.where(full).select("node"), "node")
        front = stored(open_.select("word", "n", "counts", "node", F.explode(ways(level)).alias("way")).select(
            "word", "n", "counts", F.concat("node", "way.edge").alias("node"), "way.spent"), "descent")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes `b` of `a`."""
    if len(a) > len(b):
        a, b = b, a
    at, end = 0, len(a)
    while at < end and a[at] == b[at]:
        at += 1
    if len(b) == end:
        return at < end and a[at + 1:] == b[at + 1:]
    return len(b) == end + 1 and a[at:] == b[at + 1:]


def built(members: list[tuple], level: int):
    """A trie of (counts, word, n) from a level down: nested dictionaries, and lists of at most LEAF members, or of those
    that no level parts."""
    if len(members) <= LEAF or level == LEVELS:
        return members
    below = defaultdict(list)
    for m in members:
        below[m[0][level]].append(m)
    return {count: built(part, level + 1) for count, part in below.items()}


def candidates(trie, counts: list[int], level: int, spent: int) -> list[tuple]:
    """The members of all leaves that a search for these counts reaches, depth first."""
    found, open_ = [], [(trie, level, spent)]
    while open_:
        node, level, spent = open_.pop()
        if isinstance(node, list):
            found += node
            continue
        count = counts[level]
        if level == 0:
            tries = ((count, SAME), (count - 1, SHORTER))
        elif spent == SAME:
            tries = ((count, SAME), (count + 1, RISEN))
        elif spent == SPENT:
            tries = ((count, SPENT),)
        else:
            tries = ((count, spent), (count - 1, SPENT))
        for edge, after in tries:
            if edge in node:
                open_.append((node[edge], level + 1, after))
    return found


def search(rows: pa.Table) -> pa.Table:
    """Members and queries of one node to (word, n_near, less, best), for both words of each pair: number of near words, the
    largest frequency among them, negated, and the first word that has it."""
    level = rows.column("level")[0].as_py()
    member, word, n, counts, spent = (rows.column(c).to_pylist() for c in ("member", "word", "n", "counts", "spent"))
    trie = built([(c, w, k) for m, c, w, k in zip(member, counts, word, n) if m], level)
    near: dict[str, tuple] = {}

    def note(w: str, k: int, other: str) -> None:
        number, best = near.get(w, (0, (1, "")))
        near[w] = number + 1, min(best, (-k, other))

    for m, c, w, k, s in zip(member, counts, word, n, spent):
        if not m:
            for vector, other, often in candidates(trie, c, level, s):
                if one_edit(w, other) and (vector[0] < c[0] or vector[0] == c[0] and (vector, other) > (c, w)):
                    note(w, often, other)
                    note(other, k, w)
    return pa.table({"word": pa.array(near, pa.string()), "n_near": pa.array([v[0] for v in near.values()], pa.int64()),
                     "less": pa.array([v[1][0] for v in near.values()], pa.int64()),
                     "best": pa.array([v[1][1] for v in near.values()], pa.string())})


def near_words(words: DataFrame, most: int = 16_384) -> DataFrame:
    """(word, n_near, best_n, best) of each word (word, n) that another is one edit from; of equally frequent ones the first
    in the order of code points is `best`.

    Queries of a node are dealt to groups of about `most`, each of which gets the node's words. A node that cannot be
    split any more (words with equal counts in every group) has its words dealt out too, and then each pair of parts is a
    group.
    """
    ship(words.sparkSession)
    words = stored(words.withColumn("counts", group_counts(F.col("word"))), "words")
    reached = stored(descend(words, most), "reached")
    asked = stored(reached.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("query_parts")), "parts")
    sized = reached.join(asked, "node").withColumn("word_parts", F.ceil(F.col("held") / most).cast("int"))
    mine = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["node", "level", "word", "n", "counts", "spent"]
    queries = sized.select(*kept, F.lit(False).alias("member"), mine("query_parts").alias("query_part"),
                           all_of("word_parts").alias("word_part"))
    members = sized.where(F.col("spent") == SAME).select(
        *kept, F.lit(True).alias("member"), all_of("query_parts").alias("query_part"), mine("word_parts").alias("word_part"))
    found = queries.unionByName(members).groupBy("node", "query_part", "word_part").applyInArrow(
        lambda key, rows: search(rows), "word string, n_near long, less long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following forms from word to word ends. Each round doubles the distance."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
             ratio: int = 5, every: int = 199, most: int = 16_384) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of a collection that are long and common enough.

    A word's form is the most frequent word one edit away, if that is at least `ratio` times as frequent; its root is
    where forms lead. Forms grow in frequency, so there are no circles and a chain is no longer than the logarithm of the
    largest count.

    Null and empty texts have no words; a null id counts as an empty one in the damage rule; repeated rows and rows with
    one id count each; other columns are not looked at. An empty table gives no rows.
    """
    words = stored(words_of(docs, id_col, text_col, least_length, least_count, every), "words")
    near = stored(near_words(words, most), "near")
    judged = words.join(near, "word", "left").withColumn("ok", F.col("best_n") >= ratio * F.col("n"))
    judged = stored(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                  F.when(F.col("ok"), F.col("best")).alias("form"),
                                  F.when(F.col("ok"), F.col("best_n")).alias("form_n")), "forms")
    ends = roots_of(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
