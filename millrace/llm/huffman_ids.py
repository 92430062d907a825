"""Token ids in files: canonical length-limited Huffman codes, blocks that decode on their own.

A file is a run of blocks. A block holds whole documents, about 2^18 ids or one longer document:

    4 bytes  magic "MRB1"
    4 bytes  length of the header, then the header as JSON in UTF-8: first (ids of all documents before the block),
             n (ids in the block), docs (list of [doc_id, number of ids]), step (ids between checkpoints),
             bits (length of the bit stream)
    8 bytes  each: bit offset of every checkpoint, at ids 0, step, 2 * step, ...
    n bytes  the bit stream, first bit highest, filled up with zeros
    1 byte   line feed

All integers are little-endian and unsigned. Beside the blocks lies the code book: the code length of every id, from
which the canonical codes follow. Files come from Spark's own text writer, one block a line, so that they work
on any file system Spark knows and follow its commit protocol; the line feed of that writer is the block's last byte.

A decoder reads many checkpoints of a block side by side: each step looks up the next 16 bits of every one of them in
one table of ids and lengths.
"""
from __future__ import annotations

import json
import os
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe_prefix import COMMON, ODD
from millrace.llm.common import Memo, map_arrow, ship
from millrace.llm.token_counts import byte_letters

MAGIC = b"MRB1"
LONGEST = 16


def code_lengths(counts: dict[int, int], longest: int = LONGEST) -> dict[int, int]:
    """Code lengths of at most `longest` bits with the least total, by package merge. Ties go by id.

    Each round pairs up the packages of the round before and merges them with the single ids; the cheapest
    2n - 2 of the last round name every id as often as its code has bits. A package is kept as its two parts,
    and the namings are counted from the last round back.
    """
    ids = sorted((i for i, c in counts.items() if c > 0), key=lambda i: (counts[i], i))
    n = len(ids)
    if n == 0:
        return {}
    if n == 1:
        return {ids[0]: 1}
    if n > 1 << longest:
        raise ValueError(f"{n} ids have no codes of {longest} bits")
    single = np.array([counts[i] for i in ids], dtype=np.float64)
    rounds, packages = [], np.empty(0)
    for _ in range(longest):
        weight = np.concatenate([single, packages])
        order = np.argsort(weight, kind="stable")
        rounds.append(order)
        merged = weight[order]
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
    length, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for order in reversed(rounds):
        taken = order[:take]
        length[taken[taken < n]] += 1
        take = 2 * int((taken >= n).sum())
    return {i: int(b) for i, b in zip(ids, length)}


class Book:
    """Canonical codes: shorter before longer, then by id."""

    def __init__(self, lengths: dict[int, int], longest: int = LONGEST):
        self.longest = longest
        size = max(lengths, default=0) + 1
        self.bits, self.code = np.zeros(size, np.uint8), np.zeros(size, np.uint32)
        self.symbol, self.used = np.zeros(1 << longest, np.uint32), np.zeros(1 << longest, np.uint8)
        code = 0
        for i in sorted(lengths, key=lambda i: (lengths[i], i)):
            b = lengths[i]
            width = 1 << (longest - b)
            self.bits[i], self.code[i] = b, code  # left-aligned
            self.symbol[code:code + width], self.used[code:code + width] = i, b
            code += width

    def encode(self, ids: np.ndarray, step: int) -> tuple[np.ndarray, int, bytes]:
        """Checkpoints, length in bits and the bit stream."""
        bits = self.bits[ids].astype(np.int64)
        if len(ids) and not bits.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(bits)
        total = int(ends[-1]) if len(ids) else 0
        starts = ends - bits
        # A code lies in the 16-bit word of its start and the next; codes share no bit, so sums of a word are its bits.
        codes = self.code[ids] << np.uint32(32 - self.longest) >> (starts & 15).astype(np.uint32)
        word, n = starts >> 4, (total >> 4) + 2
        out = np.bincount(word, codes >> 16, n) + np.bincount(word + 1, codes & 0xFFFF, n)
        return starts[::step].astype("<u8"), total, out.astype(">u2").tobytes()[:-(-total // 8)]

    def decode(self, marks: np.ndarray, n: int, step: int, stream: bytes) -> np.ndarray:
        """Ids of a block; each checkpoint is a lane, and all lanes advance together."""
        if not n:
            return np.empty(0, np.uint32)
        raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        at, lanes = marks.astype(np.int64), len(marks)
        out, tail = np.zeros((lanes, step), np.uint32), n - (lanes - 1) * step
        for k in range(step):
            if k == tail:
                at = at[:-1]
            if not len(at):
                break
            peek = (window[at >> 3] >> (24 - self.longest - (at & 7)).astype(np.uint32)) & ((1 << self.longest) - 1)
            out[:len(at), k] = self.symbol[peek]
            at += self.used[peek]
        return out.reshape(-1)[:n]


def pack(book: Book, first: int, docs: list, ids: np.ndarray, step: int) -> bytes:
    marks, bits, stream = book.encode(ids, step)
    header = json.dumps({"first": first, "n": len(ids), "docs": docs, "step": step, "bits": bits}).encode()
    return MAGIC + struct.pack("<I", len(header)) + header + marks.tobytes() + stream


def unpack(book: Book, data: bytes):
    """(header, ids) of every block of a file."""
    at = 0
    while at < len(data):
        if data[at:at + 4] != MAGIC:
            raise ValueError(f"no block at byte {at}")
        (size,) = struct.unpack_from("<I", data, at + 4)
        head = json.loads(data[at + 8:at + 8 + size])
        at += 8 + size
        lanes = -(-head["n"] // head["step"])
        marks = np.frombuffer(data, "<u8", lanes, at)
        at += 8 * lanes
        length = -(-head["bits"] // 8)
        yield head, book.decode(marks, head["n"], head["step"], data[at:at + length])
        at += length + 1  # the line feed


class Encoder:
    """Ids of texts by the file's library, as little-endian bytes, two an id.

    A text is cut at blanks and line feeds, which the vocabulary drops: no token and no special token holds one, and
    normalisation does not reach across them. Equal parts of a batch are worked out once and their ids picked by place.
    Parts are cut again into the words that the vocabulary's pre-tokenizer makes, where a text holds only ASCII and
    composed Latin-1 letters and opens no special token; other parts go to the library as they are. Words go to the
    library's model at once, each byte as the letter that stands for it. Ids of words are remembered, and of parts that a
    batch holds more than once, `most` of each.
    """

    def __init__(self, path: str, most: int = 300_000, longest: int = 64):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids of two bytes do not hold this vocabulary")
        self.model = self.library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.most, self.longest = most, longest
        self.parts: dict[str, bytes] = {}
        self.words = Memo(self.word, most, longest)

    def by_library(self, pieces: list[str], times=None) -> list[bytes]:
        return [struct.pack(f"<{len(e)}H", *e.ids)
                for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer."""
        letters = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}H", *ids)

    def known(self, parts: list[str], times: np.ndarray) -> list[bytes]:
        """Ids of different parts, of which each occurs `times`."""
        memo, words = self.parts, self.words
        out = list(map(memo.get, parts))
        lack = [i for i, ids in enumerate(out) if ids is None]
        for i in lack:
            out[i] = b"".join([words[w] for w in COMMON.findall(parts[i])])
        often = [i for i, n in zip(lack, times[lack].tolist()) if n > 1 and len(parts[i]) <= self.longest]
        if len(memo) + len(often) > self.most:
            memo.clear()
        memo.update((parts[i], out[i]) for i in often[:self.most])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        own = [i for i, t in enumerate(texts) if "<|" in t or ODD.search(t) is not None]
        odd = set(own)
        plain = [i for i in range(len(texts)) if i not in odd]
        out = [b""] * len(texts)
        for rows, make, lower in ((plain, self.known, True), (own, self.by_library, False)):
            for i, ids in zip(rows, gathered([texts[i].lower() if lower else texts[i] for i in rows], make)):
                out[i] = ids
        return out


def gathered(texts: list[str], make) -> list[bytes]:
    """Ids of texts cut at blanks and line feeds; `make` gives those of different parts, once each, from the parts and
    how often each occurs, and every text's are picked from them by place."""
    if not texts:
        return []
    cut = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
    ends = cut.offsets.to_numpy()
    coded = pc.dictionary_encode(cut.flatten())
    which = coded.indices
    parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    made = make(parts, np.bincount(which.to_numpy(), minlength=len(parts)))
    picked = pa.array(made, pa.large_binary()).take(which)
    before = np.frombuffer(picked.buffers()[1], np.int64)[picked.offset:picked.offset + len(picked) + 1]
    bounds, ids = before[ends - ends[0]].tolist(), picked.buffers()[2]
    return [ids[a:b].to_pybytes() for a, b in zip(bounds, bounds[1:])] if ids else [b""] * len(texts)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, 2 bytes each) of every text, `end_id` after each. Null texts count as
    empty; null and repeated ids of documents keep their rows; other columns are not read."""
    def make():
        own, end = encoder(tokenizer), b"" if end_id is None else struct.pack("<H", end_id)

        def work(keys, texts):
            made = [ids + end for ids in own.encode([t or "" for t in texts])]
            return keys, [len(m) // 2 for m in made], made
        return work

    return map_arrow(docs, [id_col, text_col], make, "doc_id long, n_tokens long, ids binary",
                     limit=4 << 20)


def counts(encoded: DataFrame) -> dict[int, int]:
    """How often each id occurs in all documents. One row per task and id is shuffled; the driver gets one per id, so
    at most as many as the vocabulary has."""
    ship(encoded.sparkSession)

    def count(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(x or b"" for x in batch.column(0).to_pylist()), "<u2")
            total += np.bincount(ids, minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                                         ["id", "n"])

    rows = encoded.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


def write(encoded: DataFrame, path: str, step: int = 256, block_ids: int = 1 << 18, part_ids: int = 1 << 23,
          most_parts: int = 10_000) -> dict[int, int]:
    """Writes (doc_id, n_tokens, ids) to files below `path` in ascending doc_id order; returns the code lengths.

    Documents are dealt to ranges of doc_id with about `part_ids` token ids each, at most `most_parts` ranges. The
    driver holds one number a range, the ids before it. Rows with equal doc_id follow each other in the order of their
    ids' bytes; those without one come first. A file takes 64 blocks, a range as many files as it needs.
    """
    spark = encoded.sparkSession
    ship(spark)
    found = counts(encoded)
    lengths = code_lengths(found)
    parts = min(most_parts, max(1, -(-sum(found.values()) // part_ids)))
    cuts = np.array(sorted(set(encoded.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)
                               if parts > 1 else [])), dtype=np.float64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:  # the borders are stated, so every attempt of a task finds the same ranges
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy(np.float64), side="right")
        return pd.Series(out)

    dealt = encoded.withColumn("part", part("doc_id"))
    sums = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sums):
        before[p], total = total, total + sums[p]

    def blocks(batches):
        book, current, at = Book(lengths), None, 0
        docs, held, size = [], [], 0

        def block():
            data = pack(book, at - size, docs, np.concatenate(held), step)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            for p, doc, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if docs and (p != current or size >= block_ids):
                    yield block()
                    docs, held, size = [], [], 0
                if p != current:
                    current, at = p, before[p]
                ids = np.frombuffer(raw or b"", "<u2")
                docs.append([doc, len(ids)])
                held.append(ids)
                size, at = size + len(ids), at + len(ids)
        if docs:
            yield block()

    (dealt.repartitionByRange(len(cuts) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")
     .select("part", "doc_id", "ids").mapInArrow(blocks, "value binary")
     .select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 64).text(path))
    (spark.createDataFrame(sorted(lengths.items()), "id int, bits int").coalesce(1)
     .write.parquet(path.rstrip("/") + "-book"))
    return lengths


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below `path`: doc_id, start (ids of all documents before it), n_tokens, ids
    (little-endian unsigned 32-bit integers). Every file is a row of its own and is decoded block by block."""
    ship(spark)
    lengths = {r["id"]: r["bits"] for r in spark.read.schema("id int, bits int")
               .parquet(path.rstrip("/") + "-book").collect()}
    out = spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary").schema

    def decode(batches):
        book, types = Book(lengths), (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for content in batch.column(0):
                for head, ids in unpack(book, content.as_buffer().to_pybytes()):
                    sizes = [n for _, n in head["docs"]]
                    ends = np.cumsum(sizes)
                    raw = [ids[e - n:e].astype("<u4").tobytes() for n, e in zip(sizes, ends)]
                    columns = ([d for d, _ in head["docs"]], head["first"] + ends - sizes, sizes, raw)
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], out.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, out)
