"""Token counts, prefix BPE and Huffman files against the libraries."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, awkward, frame
from tokenizers import Tokenizer

from millrace.llm import bpe_prefix, huffman_ids, queries, token_counts

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "B", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "1", "é", "É", "!", "<|endoftext|>", "　", "́", "<|",
          "|>", "\0", "\r\n", "中", "🙂", "Σ", "ΑΣ", "İ", "ß", "the", "ing", "e", "in", "ﬁ", "'", "ll", "²", "ª", "×", "ǅ", "ɐ"]


def texts(seed, n=4000):
    r = random.Random(seed)
    return [t or "" for t in AWKWARD] + ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


def test_counts_equal_the_library(libraries):
    own, all_texts = token_counts.Counter(BYTE, most=500, longest=6, group_bytes=64), texts(1)
    for start in range(0, len(all_texts), 97):
        part = all_texts[start:start + 97]
        assert own.counts(part) == [len(libraries[0].encode(t, add_special_tokens=False)) for t in part]


def test_counts_without_ranks_equal_those_with(libraries):
    own = token_counts.Counter(BYTE)
    own.ranks = None
    part = texts(2, 300)
    assert own.counts(part) == [len(libraries[0].encode(t, add_special_tokens=False)) for t in part]


def test_a_vocabulary_with_word_ends_has_no_ranks():
    assert token_counts.rank_encoder(WORD) is None


def test_count_tokens_of_awkward_rows(spark, libraries):
    got = token_counts.count_tokens(awkward(spark), BYTE, limit=100).collect()
    assert len(got) == len(AWKWARD) + 2
    for r in got:
        text = (AWKWARD[r["doc_id"]] or "") if r["doc_id"] is not None else "no id here"
        n = len(libraries[0].encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)
    assert token_counts.count_tokens(frame(spark, []), BYTE).count() == 0


def test_prefix_encoding_and_decoding_equal_the_library(libraries):
    own = bpe_prefix.Codec(WORD, most=300)
    r = random.Random(3)
    more = ["".join(r.choice("abcdeinrsthoug.,!") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    for t in texts(4) + more + ["ao" * 20000]:
        expected = libraries[1].encode(t, add_special_tokens=False).ids
        ids, decoded = own.both(t)
        assert np.frombuffer(ids, "<u4").tolist() == expected and own.encode(t) == expected
        assert decoded == libraries[1].decode(expected, skip_special_tokens=False)


def test_tokens_that_are_not_their_own_encoding_never_occur(libraries):
    own = bpe_prefix.Codec(WORD)
    body = [t for t in own.names.values() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t.islower()]
    for t in random.Random(5).sample(body, 2000):
        ids = libraries[1].encode(t[:-4], add_special_tokens=False).ids
        assert list(own.word(t[:-4])) == ids


def test_encode_decode_of_awkward_rows(spark, libraries):
    got = queries.bpe_digests(bpe_prefix.encode_decode(awkward(spark), WORD)).collect()
    assert len(got) == len(AWKWARD) + 2
    for r in got:
        text = (AWKWARD[r["doc_id"]] or "") if r["doc_id"] is not None else "no id here"
        ids = libraries[1].encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(libraries[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_prefix.encode_decode(frame(spark, []), WORD).count() == 0


@pytest.mark.parametrize("n,k", [(0, 1), (1, 1), (5, 1), (1000, 3), (60_000, 49_408)])
def test_blocks_round_trip(n, k):
    random_ids = np.minimum((np.random.RandomState(n).pareto(0.7, n) * 3).astype(np.int64), k - 1).astype("<u2")
    lengths = huffman_ids.code_lengths(dict(zip(*[x.tolist() for x in np.unique(random_ids, return_counts=True)])))
    book = huffman_ids.Book(lengths)
    data = b"".join(huffman_ids.pack(book, 0, [[0, len(x)]], x, 64) + b"\n" for x in np.array_split(random_ids, 3))
    assert np.concatenate([ids for _, ids in huffman_ids.unpack(book, data)]).tolist() == random_ids.tolist()


def test_code_lengths_are_the_best_within_the_limit():
    fibonacci = {0: 1, 1: 1}
    for i in range(2, 24):
        fibonacci[i] = fibonacci[i - 1] + fibonacci[i - 2]
    limited = huffman_ids.code_lengths(fibonacci, 16)
    assert max(limited.values()) == 16 and sum(2.0 ** -b for b in limited.values()) == 1
    free = huffman_ids.code_lengths(fibonacci, 24)
    assert max(free.values()) == 23 and sum(2.0 ** -b for b in free.values()) == 1
    with pytest.raises(ValueError):
        huffman_ids.code_lengths({i: 1 for i in range(9)}, 3)


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_files_hold_all_ids_in_order(spark, tmp_path, libraries, rows):
    docs = frame(spark, []) if rows == "empty" else awkward(spark)
    path = str(tmp_path / "ids")
    encoded = huffman_ids.encode(docs, WORD, end_id=1)
    huffman_ids.write(encoded, path, step=16, block_ids=500, part_ids=1000)
    got = sorted(huffman_ids.read(spark, path).collect(), key=lambda r: r["start"])
    if rows == "empty":
        assert got == []
        return
    keys = [None, *sorted([*range(len(AWKWARD)), 9])]
    assert [r["doc_id"] for r in got] == keys
    at = 0
    for r in got:
        text = (AWKWARD[r["doc_id"]] or "") if r["doc_id"] is not None else "no id here"
        ids = libraries[1].encode(text, add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert zlib.crc32(r["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_bit_offsets_beyond_four_gigabits():
    book = huffman_ids.Book({0: 16})
    marks, bits, stream = book.encode(np.zeros(5, np.int64), 2)
    assert marks.dtype == np.dtype("<u8") and marks.tolist() == [0, 32, 64] and bits == 80 and len(stream) == 10


def test_words_reach_the_model_without_a_text_around_them(libraries):
    texts = [" ".join(f"ne{a}w{b}est, {a}'s {b}!" for b in range(40)) + " the the\tend \x01 \x00a é ñandú café" for a in range(30)]
    own, calls = huffman_ids.Encoder(WORD, most=200), []
    own.by_library = lambda pieces, times=None, real=own.by_library: calls.extend(pieces) or real(pieces)
    made = [np.frombuffer(x, "<u2").tolist() for k in (0, 10, 20) for x in own.encode(texts[k:k + 10])]
    assert made == [libraries[1].encode(t, add_special_tokens=False).ids for t in texts]
    assert not calls
    assert len(own.parts) <= 200 and len(own.words) <= 200


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 5000])
def test_bit_streams_are_the_codes_in_a_row(n):
    book = huffman_ids.Book(huffman_ids.code_lengths({i: 1 + 2 ** min(i, 30) for i in range(40)}))
    ids = np.random.RandomState(n).randint(0, 40, n)
    bits = "".join(f"{book.code[i]:016b}"[:book.bits[i]] for i in ids)
    _, total, stream = book.encode(ids, 16)
    assert total == len(bits)
    assert stream == bytes(int(bits[k:k + 8].ljust(8, "0"), 2) for k in range(0, len(bits), 8))
