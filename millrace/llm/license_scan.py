"""Licence scan: ordered signature rules over normalised words.

One Aho-Corasick pass over a text's words finds which keywords occur; only rules whose keyword does are run. Of the
detections those that lie inside one of higher priority, or of the same priority and earlier in the rules or longer,
are suppressed. The three base phrases are counted at every place where their words stand in a row, and their
labels are never suppressed.
"""
from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from millrace.llm.common import map_arrow
from millrace.llm.license_rules import RULES

#: Phrase and label. Fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Bytes outside words become blanks, letters become small; bytes above ASCII belong to words.
WORDS = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
GAP = "(?: [^ ]+){0,6}? "
_SCANNERS: dict = {}


class Rule:
    def __init__(self, place: int, line: str):
        head, self.keyword, pattern = (x.strip() for x in line.split(" | ", 2))
        priority, self.label = head.split(" ", 1)
        self.priority, self.place = int(priority), place
        self.pattern = re.compile("(?<![^ ])(?:" + pattern.replace(" ~ ", GAP) + ")(?![^ ])")


class Scanner:
    def __init__(self, rules: str = RULES, base: dict[str, str] = BASE):
        self.base = base
        self.rules = [Rule(i, line) for i, line in enumerate(x for x in rules.splitlines() if x.strip())]
        self.matcher = ahocorasick.Automaton()
        gates: dict[str, list[Rule]] = {}
        for rule in self.rules:
            gates.setdefault(rule.keyword, []).append(rule)
        for phrase in base:
            gates.setdefault(phrase, [])
        for keyword, own in gates.items():
            self.matcher.add_word(keyword, (keyword, own))
        self.matcher.make_automaton()

    def detections(self, words: str, found: dict[str, list[Rule]]) -> list[tuple[int, int, Rule]]:
        """(first character, last character, rule) of what is kept, in the order of the text."""
        hits = [(m.start(), m.end(), rule) for own in found.values() for rule in own
                for m in rule.pattern.finditer(words)]
        hits.sort(key=lambda h: (-h[2].priority, h[2].place, h[0] - h[1], h[0]))
        # Kept intervals do not lie inside each other unless the later one is the larger, so the furthest end of those
        # that begin no later tells whether an interval lies inside one. A Fenwick tree over the starts holds it.
        starts = sorted({h[0] for h in hits})
        place, tree, kept = {s: i + 1 for i, s in enumerate(starts)}, [0] * (len(starts) + 1), []
        for start, end, rule in hits:
            i, furthest = place[start], 0
            while i:
                furthest, i = max(furthest, tree[i]), i & (i - 1)
            if furthest >= end:
                continue
            kept.append((start, end, rule))
            i = place[start]
            while i < len(tree):
                tree[i], i = max(tree[i], end), i + (i & -i)
        return sorted(kept, key=lambda h: (h[0], h[1]))

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, first and last word)."""
        listed = (text or "").encode().translate(WORDS).split()
        words = b" ".join(listed).decode()
        found = {keyword: own for _, (keyword, own) in self.matcher.iter(words)} if words else {}
        if not found:
            return len(listed), 0, None, None, "", "", 0.0, []
        marks, base_labels = [], set()
        for phrase, label in self.base.items():
            if phrase in found:
                # Overlapping places count, each once: a place begins at a word and ends with one.
                places = [m.start() for m in re.finditer(f"(?<![^ ])(?={re.escape(phrase)}(?![^ ]))", words)]
                marks += places
                if places:
                    base_labels.add(label)
        kept = self.detections(words, found)
        order = sorted({p for s, e, _ in kept for p in (s, e)} | set(marks))
        index, at, n = {}, 0, 0
        for p in order:
            n += words.count(" ", at, p)
            index[p], at = n, p
        spans = [{"label": rule.label, "first": index[s], "last": index[e]} for s, e, rule in kept]
        labels = base_labels | {rule.label for _, _, rule in kept}
        sure = max([rule.priority / 100 for _, _, rule in kept] + [0.5] * bool(base_labels) + [0.0])
        numbers = [index[p] for p in marks]
        return (len(listed), len(marks), min(numbers, default=None), max(numbers, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), sure, spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    The score is the highest priority of what was kept, as a share of 100 (base phrases: 0.5; nothing: 0). A null text
    counts as empty: no words, no places, empty label lists. Null and repeated ids keep their rows; other columns are
    not read.
    """
    def make():
        if "" not in _SCANNERS:
            _SCANNERS[""] = Scanner()
        scanner = _SCANNERS[""]

        def work(ids, texts):
            return ids, *zip(*[scanner.scan(t) for t in texts])
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs, [id_col, text_col], make,
                     f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
                     "base_labels string, labels string, score double, "
                     "spans array<struct<label: string, first: long, last: long>>")
