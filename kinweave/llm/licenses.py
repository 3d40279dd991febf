"""Licence detection: base phrases by words, and ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from kinweave.llm.common import over_texts
from kinweave.llm.license_rules import ADDRESSES, NOTICES, SPDX, TITLES

#: Phrases whose places are always counted, and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Trust in a document with a base phrase.
BASE_WEIGHT = 0.6
#: Runs of white space that rules see as one blank.
_GAPS = re.compile(r"[ \t\n\r\f\v]{2,}|[\t\n\r\f\v]")
_LOWER = {c: c + 32 for c in range(65, 91)}
_OTHER = bytes(i for i in range(128) if not (chr(i).isalnum()))
#: Lowers A-Z and turns what parts words into blanks.
_WORDS = bytes.maketrans(_OTHER + bytes(range(65, 91)), b" " * len(_OTHER) + bytes(range(97, 123)))


@dataclass(frozen=True)
class Rule:
    label: str
    weight: float
    keyword: str
    expression: re.Pattern


def rules() -> list[Rule]:
    """All rules, by priority."""

    def read(block: str) -> list[Rule]:
        out = []
        for line in filter(None, block.splitlines()):
            label, weight, keyword, expression = line.split(" | ", 3)
            out.append(Rule(label, float(weight), keyword, re.compile(expression, re.DOTALL)))
        return out

    tags = [
        Rule(x.lower(), 0.95, x.lower(), re.compile(rf"(?:spdx-license-identifier:|license[\"']?\s*[:=])\s*[\"'(]*{re.escape(x.lower())}(?![\w.-])"))
        for x in SPDX.split()
    ]
    return read(NOTICES) + tags + read(ADDRESSES) + read(TITLES)


class Scanner:
    def __init__(self) -> None:
        self.rules = rules()
        by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            by_keyword.setdefault(rule.keyword, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for word, own in by_keyword.items():
            self.automaton.add_word(word, own)
        self.automaton.make_automaton()

    def detections(self, lowered: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) in text whose A-Z are lowered.

        Rules whose keyword occurs are tried in order. A detection goes if its interval lies within that
        of a rule with priority over it, so the short name in a notice gives no second label.
        """
        tried = sorted({k for _, own in self.automaton.iter(lowered) for k in own})
        kept: list[tuple[int, int, Rule]] = []
        spans: list[tuple[int, int]] = []
        for k in tried:
            rule = self.rules[k]
            found = [m.span() for m in rule.expression.finditer(lowered) if m.end() > m.start()]
            fresh = _outside(found, spans)
            kept += [(a, b, rule) for a, b in fresh]
            if fresh:
                spans = _outer(spans + fresh)
        return sorted(kept, key=lambda d: (d[0], d[1], d[2].label))

    def scan(self, text: str) -> list[tuple[int, int, Rule]]:
        """Detections in a text of any case and any breaks of lines, by its own code points."""
        lowered = text.lower() if text.isascii() else text.translate(_LOWER)
        plain = _GAPS.sub(" ", lowered)
        found = self.detections(plain)
        if not found or len(plain) == len(text):
            return found
        ends, lost = [0], [0]  # from here on, a place in the plain text is so many code points further in the whole one
        for m in _GAPS.finditer(lowered):
            if m.end() - m.start() > 1:
                ends.append(m.start() - lost[-1] + 1)
                lost.append(lost[-1] + m.end() - m.start() - 1)
        at = lambda place: place + lost[bisect_right(ends, place) - 1]
        return [(at(a), at(b - 1) + 1, rule) for a, b, rule in found]


def _outer(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The intervals that lie within no other; then both ends ascend."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or b > out[-1][1]:
            out.append((a, b))
    return out


def _outside(found: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of ``found`` (ascending) that lie within no interval of ``spans`` (both ends ascending)."""
    out, k = [], 0
    for a, b in found:
        while k + 1 < len(spans) and spans[k + 1][0] <= a:
            k += 1
        if not (spans and spans[k][0] <= a and b <= spans[k][1]):
            out.append((a, b))
    return out


def base_places(text: str) -> tuple[int, dict[str, list[int]]]:
    """Number of words, and for each base phrase the word numbers where it starts."""
    joined = b" ".join(text.encode("utf-8", "replace").translate(_WORDS).split())
    n = joined.count(b" ") + 1 if joined else 0
    places: dict[str, list[int]] = {}
    padded = b" " + joined + b" "
    for phrase in BASE:
        sought, at, before, words = b" " + phrase.encode() + b" ", -1, 0, 0
        while (at := padded.find(sought, at + 1)) >= 0:
            words += padded.count(b" ", before, at)
            before = at
            places.setdefault(phrase, []).append(words)
    return n, places


def scan(docs: DataFrame) -> DataFrame:
    """Labels of each whole text.

    Result: doc_id, n_words, n_base, first_word, last_word (starts of the first and last base
    phrase, in words from 0; else null), base_labels, labels (base and rules; both distinct, sorted,
    comma-joined), score (0 to 1: the chance that some detection holds, taking them as independent),
    spans (rule detections as label:start:end in code points, comma-joined). A null or empty
    text has no words, labels or spans and score 0. Rules see runs of white space as one blank, so line
    breaks don't hide a notice. Only doc_id and text are read, whatever other columns there are. Repeated
    rows stay; an empty table gives no rows.
    """

    def scanned() -> Callable[[list[str]], list]:
        scanner = Scanner()

        def of(texts: list[str]) -> list:
            rows = []
            for text in texts:
                n, places = base_places(text)
                starts = [p for own in places.values() for p in own]
                base = sorted({BASE[p] for p in places})
                found = scanner.scan(text)
                weights = {label: BASE_WEIGHT for label in base}
                for _, _, rule in found:
                    weights[rule.label] = max(weights.get(rule.label, 0.0), rule.weight)
                miss = 1.0
                for label in sorted(weights):
                    miss *= 1.0 - weights[label]
                spans = ",".join(f"{r.label}:{a}:{b}" for a, b, r in found)
                rows.append((n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(weights)), 1.0 - miss, spans))
            return list(map(list, zip(*rows, strict=True))) or [[]] * 8

        return of

    return over_texts(
        docs, scanned, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    )
