"""The queries opN_<name>: each applies one operator to its whole table and derives the contract's columns."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.llm import bpe_prefix, decontaminate, huffman_ids, license_scan, minhash_dups, quality_cnn, repeats, token_counts, toxicity, variants, vector_dups, warc, whitening
from millrace.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the byte-level vocabulary."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op5_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by prefix programming and decoded again, as digests."""
    made = bpe_prefix.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return bpe_digests(made)


def bpe_digests(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return made.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written in Huffman blocks in the order of doc_id, and read back from the files."""
    encoded = stored(huffman_ids.encode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"),
                                        end_id=1), "ids")
    path = session.new_folder(spark, "huffman")
    huffman_ids.write(encoded, path)
    return huffman_ids.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a lexicon learned from the labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels and the places of the base phrases in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op7_minhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share three quarters of their five-word shingles."""
    return minhash_dups.near_copies(table(spark, sf_dir, "documents"))


@query
def op1_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of at least 0.95."""
    return vector_dups.near_vectors(table(spark, sf_dir, "embeddings"))


SQL["op1_vector_dups"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), good AS (
    SELECT vec_id, x FROM v
    WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(x, lambda c: c <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
    SELECT a AS n, a AS r FROM links
    UNION SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.r
), low AS (SELECT n, min(r) AS c FROM reach GROUP BY n),
counted AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT v.vec_id, coalesce(k, 0) AS n_links, coalesce(c, v.vec_id) AS component_id,
       v.vec_id = coalesce(c, v.vec_id) AS kept
FROM v LEFT JOIN counted ON counted.a = v.vec_id LEFT JOIN low ON low.n = v.vec_id"""
SQL["op7_minhash_dups"] = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
        lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh FROM w WHERE len(ws) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both FROM s x JOIN s y
        ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
    WHERE 100 * p.both >= 75 * (m.n + n.n - p.both)
), reach AS (
    SELECT a AS n, a AS r FROM links
    UNION SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.r
), low AS (SELECT n, min(r) AS c FROM reach GROUP BY n)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN low ON low.n = d.doc_id"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, read back and assembled to captures."""
    path = session.new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(stored(warc.read(spark, path, with_payload=False), "records"))
    return warc.pages_of(captures).drop("url")


SQL["op2_warc"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           ((instr('0123456789abcdef', substr(p.h, (i * 5) // 4 + 1, 1)) - 1) * 16
            + instr('0123456789abcdef', substr(p.h || '0', (i * 5) // 4 + 2, 1)) - 1)
           >> (3 - (i * 5) % 4)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h"""


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with words of benchmark windows."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256)).drop("item_ids")


WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
SQL["op4_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS ws FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS n, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1),
        lambda i: array_to_string(ws[i:i + 9], ' '))) AS win FROM b WHERE len(ws) > 0
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
    SELECT doc_id, n, pos, array_to_string(ws[pos:pos + n - 1], ' ') AS win
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM d, lens WHERE len(ws) >= n)
), hits AS (SELECT doc_id, dw.n, pos, item_id FROM dw JOIN bw ON bw.win = dw.win AND bw.n = dw.n),
marks AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT doc_id, n, pos FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
    FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marks ON marks.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id"""


@query
def op9_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a byte-level network learned from the labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


@query
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of windows of 50 that a document with a smaller id holds too, removed from every document."""
    made = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op13_repeats"] = """
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), wins AS (
    SELECT doc_id, pos, array_to_string(ws[pos:pos + 49], ' ') AS win
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS pos FROM w WHERE len(ws) >= 50)
), firsts AS (SELECT win, min(doc_id) AS first FROM wins GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps FROM (
        SELECT doc_id, unnest(range(pos, pos + 50)) AS p FROM wins JOIN firsts ON firsts.win = wins.win
        WHERE first < doc_id) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(ws) + 1),
           lambda i: ps IS NULL OR NOT list_contains(ps, i)), lambda i: ws[i]), ' ')) AS kept_sha256
FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id"""


@query
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent word one edit away, and the root that forms lead to."""
    return variants.variants(table(spark, sf_dir, "documents"))


SQL["op11_variants"] = """
WITH RECURSIVE t AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS raw FROM documents
), low AS (
    SELECT run, k, upper(hex(encode(concat(CAST(doc_id AS VARCHAR), ':', run)))) AS hx FROM (
        SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
        FROM runs WHERE length(raw) >= 6 GROUP BY ALL)
), hashed AS (
    SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(hx) // 2), lambda i:
        (instr('0123456789ABCDEF', substr(hx, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hx, 2 * i + 2, 1)) - 1)),
        lambda c, b: xor(tab[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) AS h FROM low, t
), words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT k, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), dels AS (
    SELECT word, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word AS a, b.word AS b FROM dels a JOIN dels b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
    UNION SELECT a.word, w.word FROM dels a JOIN words w ON w.word = a.d
    UNION SELECT w.word, a.word FROM dels a JOIN words w ON w.word = a.d
), best AS (
    SELECT a, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS b, max(w.n) AS bn FROM near JOIN words w ON w.word = b GROUP BY a
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 5 * n THEN b END AS form,
           CASE WHEN bn >= 5 * n THEN bn END AS form_n FROM words LEFT JOIN best ON best.a = word
), chain AS (
    SELECT word, word AS at, form AS next FROM forms
    UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next
)
SELECT forms.word, form, chain.at AS root, n, n_near, form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.next IS NULL"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the unit-variance axes of their eight largest components."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))
