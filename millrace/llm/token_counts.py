"""Token counts of whole texts, from Arrow functions that return lengths only.

A byte-level vocabulary never joins white space to what stands before it: a token either begins at a blank or
holds no blank but at its start. So a text may be cut before any blank or line feed that follows a character which is
no white space, and the counts of the pieces add up to the count of the text. Texts are cut there, whatever their
length; pieces that were not met before go through the encoder in groups of about equal bytes.
Special tokens hold no white space, so no cut falls into one.

Where the file's merges stand in the order of their ids (checked when it is read), pieces of Latin letters and signs go
through a rank encoder built from the file, which gives the same ids faster; all others, and those that may hold a
special token, go through the file's own library.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame

from millrace.llm.common import map_arrow

#: Before a blank or line feed that follows no white space.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
DOUBLE = re.compile(r"\s\s")
#: Letters and signs up to Latin Extended-B, without those that open a special token.
LATIN = re.compile("[^<\u0250-\U0010ffff]*")
#: The pattern that a byte-level pre-tokenizer splits text by. Fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COUNTERS: dict[str, "Counter"] = {}


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the
    others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(path: str):
    """A function from a text to ids by ranks, or None if the file is not byte-level BPE with merges in id order."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = model.get("type") != "BPE" or any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if odd or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        return None
    letters, vocab = byte_letters(), model["vocab"]
    if any(a not in letters for word in vocab for a in word):
        return None
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != list(range(256, 256 + len(made))) or len(vocab) != 256 + len(made):
        return None
    ranks = {bytes(letters[a] for a in word): i for word, i in vocab.items()}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Counter:
    """Counts tokens by pieces. Counts of short pieces are remembered, `most` of them at a time."""

    def __init__(self, path: str, most: int = 1_000_000, longest: int = 64, group_bytes: int = 1 << 18):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.ranks = rank_encoder(path)
        self.known: dict[str, int] = {}
        self.most, self.longest, self.group_bytes = most, longest, group_bytes

    def pieces(self, text: str) -> list[str]:
        if DOUBLE.search(text):
            return CUT.split(text)
        # Single white space only: every blank and line feed is a cut. A piece after a blank is written without it,
        # one after a line feed with it, and the text's first piece with a mark, as no blank precedes it.
        words = text.replace("\n", " \n").split(" ")
        if words[0]:
            words[0] = "\0" + words[0]
        else:
            del words[0]
        return words

    @staticmethod
    def whole(word: str) -> str:
        """The text that a word of `pieces` stands for when white space is single."""
        return word[1:] if word[:1] == "\0" else word if word[:1] == "\n" else " " + word

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.pieces(t) if t and "\0" not in t else [t] if t else [] for t in texts]
        plain = [bool(t) and ("\0" in t or bool(DOUBLE.search(t))) for t in texts]
        known = self.known
        if len(known) > self.most:
            known.clear()
        fresh, loose = set(), set()
        for words, p in zip(cut, plain):
            (loose if p else fresh).update(words)
        here: dict[str, int] = {}
        lacking = [w for w in fresh if w not in known]
        self._count(lacking, [self.whole(w) for w in lacking], known, here)
        own: dict[str, int] = {}
        self._count(list(loose), list(loose), own, own)
        out = []
        for words, p in zip(cut, plain):
            if p:
                out.append(sum(own[w] for w in words))
            else:
                try:
                    out.append(sum(map(known.__getitem__, words)))
                except KeyError:  # a long piece is not remembered
                    out.append(sum(known[w] if w in known else here[w] for w in words))
        return out

    def _count(self, keys: list[str], pieces: list[str], keep: dict, rest: dict) -> None:
        """Counts pieces: by ranks where they can, else by the library in groups of about `group_bytes` bytes."""
        if self.ranks is not None:
            others, ranks = [], self.ranks
            for key, piece in zip(keys, pieces):
                if piece.isascii() and "<|" not in piece or LATIN.fullmatch(piece):
                    (keep if len(key) <= self.longest else rest)[key] = len(ranks(piece))
                else:
                    others.append((key, piece))
            keys, pieces = [k for k, _ in others], [p for _, p in others]
        start = held = 0
        for i, piece in enumerate(pieces):
            held += len(piece)
            if held >= self.group_bytes or i == len(pieces) - 1:
                group = self.library.encode_batch_fast(pieces[start:i + 1], add_special_tokens=False)
                for key, encoding in zip(keys[start:i + 1], group):
                    (keep if len(key) <= self.longest else rest)[key] = len(encoding)
                start, held = i + 1, 0


def counter(path: str) -> Counter:
    """One counter a process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of `docs`: the id, n_bytes, n_tokens, over_limit.

    `tokenizer` is the path of a byte-level tokenizer file that every executor has. A null text counts as empty: no
    bytes, no tokens. Ids are only carried, so null and repeated ids keep their rows; other columns are not read.
    """
    def make():
        count = counter(tokenizer).counts

        def work(ids, texts):
            n = count([t or "" for t in texts])
            return ids, [len(t.encode()) if t else 0 for t in texts], n, [x > limit for x in n]
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs, [id_col, text_col], make,
                     f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", batch_bytes)
