"""BPE by dynamic programming over prefixes, and its decoding.

The last token of a text's BPE encoding determines the rest, and each prefix has exactly one last token. An automaton
over the vocabulary (a trie with suffix links) yields, for every prefix of a word, the tokens that are its suffixes.
Such a token is the last one if the prefix before it ends in a token that it is compatible with, which means that no
merge ever joins the two across their border. Following the last tokens back from the end gives the ids.
Time is linear in the word's length times the number of matches, also for words of millions of letters.

Words are what the vocabulary's pre-tokenizer makes of a normalised text; results of short words are remembered.
"""
from __future__ import annotations

import json
import re
import struct
import unicodedata

import ahocorasick
import regex
from pyspark.sql import DataFrame

from millrace.llm.common import Memo, map_arrow
from millrace.llm.token_counts import byte_letters

END = "</w>"
#: What words are, with the case already lowered. Fixed value.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same, faster, for texts without what ODD finds: only ASCII and composed Latin-1 letters.
COMMON = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
ODD = re.compile("[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]")
NEVER = 1 << 60
_CODECS: dict[str, "Codec"] = {}


class Pairs(dict):
    """Whether two tokens, packed into one integer, are compatible; empties itself when full."""

    def __init__(self, apart):
        super().__init__()
        self.apart = apart

    def __missing__(self, key):
        if len(self) >= 250_000:
            self.clear()
        value = self[key] = self.apart(key >> 20, key & 0xFFFFF)
        return value


class Codec:
    """Encoder and decoder of a word vocabulary whose tokens at a word's end carry `</w>`."""

    def __init__(self, path: str, most: int = 150_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = dict(spec["model"]["vocab"])
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
                                           + ")") if special else None
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        letters = byte_letters()
        self.ids: dict[str, int] = {}
        for token, i in vocab.items():
            if token in special:
                continue
            body = token.removesuffix(END)
            if not body or any(a not in letters for a in body):
                continue
            symbols = "".join(chr(letters[a]) for a in body)
            self.ids[symbols if body == token else symbols[:-1] + chr(256 + ord(symbols[-1]))] = i
        size = max(self.names) + 1
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, x, y = vocab[a + b if not a.endswith(END) else ""], vocab[a], vocab[b]
            if self.rank[i] >= 0 or max(self.rank[x], self.rank[y]) >= rank:
                raise ValueError(f"merge {rank} makes a token twice or uses a later one")
            self.rank[i], self.left[i], self.right[i] = rank, x, y
            self.joined[x, y] = rank
        if any(chr(s) not in self.ids for s in range(512)):
            raise ValueError("the vocabulary lacks single bytes")
        stable = [True] * size  # tokens that are their own encoding; no other occurs in any
        for i in sorted((i for i in range(size) if self.rank[i] >= 0), key=self.rank.__getitem__):
            x, y = self.left[i], self.right[i]
            stable[i] = stable[x] and stable[y] and self.apart(x, y, self.rank[i])
        self.matcher = ahocorasick.Automaton()
        for symbols, i in self.ids.items():
            if stable[i]:
                self.matcher.add_word(symbols, (i, len(symbols) - 1))
        self.matcher.make_automaton()
        self.stable = {s: i for s, i in self.ids.items() if stable[i]}
        self.pairs = Pairs(self.apart)
        self.parts = Memo(self.part, most)

    def apart(self, x: int, y: int, until: int = NEVER) -> bool:
        """Whether no merge of a rank below `until` joins neighbours x and y across their border.

        Goes back in time: of the two pieces at the border, the one made last is undone until both are single
        bytes. Two pieces that stand side by side are joined if their merge comes before either is used up; equal
        merges run from left to right.
        """
        rank, x_used, y_used = self.rank, until, until
        while True:
            merge = self.joined.get((x, y))
            if merge is not None and merge < x_used and merge <= y_used:
                return False
            if rank[x] > rank[y]:
                x_used, x = rank[x], self.right[x]
            elif rank[y] >= 0:
                y_used, y = rank[y], self.left[y]
            else:
                return True

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word or special token."""
        if word in self.special:
            return (self.special[word],)
        raw = word.encode().decode("latin-1")
        symbols = raw[:-1] + chr(256 + ord(raw[-1]))
        whole = self.stable.get(symbols)
        if whole is not None:
            return (whole,)
        last, back = [-1] * (len(symbols) + 1), [0] * (len(symbols) + 1)
        compatible = self.pairs
        last[0] = 0
        for end, (token, reach) in self.matcher.iter(symbols):
            if last[end + 1] < 0:
                start = end - reach
                before = last[start]
                if not start or before >= 0 and compatible[before << 20 | token]:
                    last[end + 1], back[end + 1] = token, start
        out, at = [], len(symbols)
        while at:
            out.append(last[at])
            at = back[at]
        return tuple(reversed(out))

    def split(self, text: str) -> list[str]:
        """The words of a text and its special tokens, in order."""
        if "<|" in text or ODD.search(text):
            return self.split_odd(text)
        return COMMON.findall(text.lower())

    def split_odd(self, text: str) -> list[str]:
        """The same for any text: special tokens first, then each letter's case for itself, so that no letter's case
        depends on its neighbours."""
        out = []
        for piece in self.split_special.split(text) if self.split_special else [text]:
            if piece in self.special:
                out.append(piece)
                continue
            piece = unicodedata.normalize("NFC", piece)
            out.extend(WORDS.findall(piece.lower() if "Σ" not in piece else "".join(a.lower() for a in piece)))
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of any text."""
        out: list[int] = []
        for word in self.split(text):
            out.extend(self.word(word))
        return out

    def decode(self, ids) -> str:
        """The tokens' names, blank-separated; ids without a name are passed over."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])

    def part(self, word: str) -> tuple[bytes, str]:
        ids = self.word(word)
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def both(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian 32-bit integers, and the text decoded from them."""
        known = self.parts
        results = [known[word] for word in self.split(text)]
        return b"".join([r[0] for r in results]), " ".join([r[1] for r in results])


def codec(path: str) -> Codec:
    """One codec a process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  batch_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of `docs`: the id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded.

    `tokenizer` is the path of a word-level BPE file that every executor has. A null text counts as empty: no ids,
    an empty decoded text. Ids of documents are only carried, so null and repeated ones keep their rows; other columns
    are not read.
    """
    def make():
        both = codec(tokenizer).both

        def work(ids, texts):
            made = [both(t or "") for t in texts]
            return ids, [len(m[0]) // 4 for m in made], [m[0] for m in made], [m[1] for m in made]
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs, [id_col, text_col], make, f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string",
                     batch_bytes)
