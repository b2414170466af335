"""License notices in texts, short ones and with misspellings.

A notice is cut into one part more than the errors it may hold, so that any occurrence within the bound has at least one part unchanged (pigeonhole). One automaton
finds all parts of all notices in a text's words; around each, the runs of words that an occurrence through that part can be are given to the
regular-expression library's bounded-error matching, which verifies the edits. Phrases that name a license are found as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read, text_batches

#: Phrases of the base and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices and their labels, in words as texts are cut into.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "licensed under the gnu general public license": "gpl",
    "under the terms of the gnu general public license": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under the mozilla public license": "mpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by": "cc",
    "licensed under a creative commons attribution": "cc",
    "released into the public domain": "public-domain",
}
#: A notice may hold one error in so many characters: few enough that no other short name stands where a license is named.
CHARACTERS_AN_ERROR = 20
#: Candidates whose result a task remembers: shared passages are verified once.
KNOWN_WINDOWS = 50_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPANS = "spans array<struct<label: string, start: long, end: long, errors: int, score: double>>"
COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int

    @property
    def pattern(self) -> str:
        return rf"(?b)(?:{regex.escape(self.text, literal_spaces=True)}){{e<={self.errors}}}"

    def parts(self) -> list[tuple[int, str]]:
        """errors + 1 parts with their offsets, as even as can be."""
        n, k = len(self.text), self.errors + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(i, self.text[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def notices_of(notices: dict[str, str], characters_an_error: int = CHARACTERS_AN_ERROR) -> list[Notice]:
    """Notices with their bound of errors; a part must have a character, so a notice shorter than that has none."""
    return [Notice(t, label, min(len(t) // characters_an_error, len(t) - 1)) for t, label in notices.items() if t]


class Finder:
    """Finds notices and phrases in one text after the other."""

    def __init__(self, notices: list[Notice], phrases: dict[str, str]):
        self.notices, self.phrases = notices, phrases
        self.patterns = [regex.compile(n.pattern) for n in notices]
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for at, part in n.parts():
                seeds.setdefault(part, []).append((i, at))
        for part, uses in seeds.items():
            self.automaton.add_word(part, (len(part), uses))
        if seeds:
            self.automaton.make_automaton()
        self.candidates = 0
        self.verify = lru_cache(KNOWN_WINDOWS)(self._verify)

    def _verify(self, i: int, words: str) -> int | None:
        """Least errors with which the words as a whole are notice i, or None beyond its bound. Matched as a whole, as the library's search misses some edits at a match's ends."""
        m = self.patterns[i].fullmatch(words)
        return sum(m.fuzzy_counts) if m else None

    def matches(self, joined: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors) in words joined by single spaces: of matches of a label that overlap, the one with the fewest errors, then the longest, then the first."""
        found: set[tuple[int, int, int, int]] = set()
        tried: set[tuple[int, int]] = set()
        if not self.automaton:
            return []
        for end, (size, uses) in self.automaton.iter(joined):
            for i, at in uses:
                n = self.notices[i]
                start = end + 1 - size - at
                if (i, start) in tried:
                    continue
                tried.add((i, start))
                # an occurrence through this part begins within `errors` of this place, at a word's start
                for low in _borders(joined, start - n.errors, start + n.errors, -1):
                    for high in _borders(joined, low + len(n.text) - n.errors, low + len(n.text) + n.errors, 0):
                        self.candidates += 1
                        errors = self.verify(i, joined[low:high])
                        if errors is not None:
                            found.add((i, low, high, errors))
        best: list[tuple[int, int, int, int]] = []
        for m in sorted(found, key=lambda x: (x[3], x[1] - x[2], x[1], x[0])):
            if all(self.notices[o[0]].label != self.notices[m[0]].label or o[2] <= m[1] or m[2] <= o[1] for o in best):
                best.append(m)
        return sorted(best, key=lambda x: (x[1], x[0]))

    def base(self, joined: str) -> list[tuple[int, int, str]]:
        """(start, end, label) of every place where a phrase's words stand one after the other."""
        around, out = f" {joined} ", []
        for phrase, label in self.phrases.items():
            needle = f" {phrase} "
            at = around.find(needle)
            while at >= 0:
                out.append((at, at + len(phrase), label))
                at = around.find(needle, at + 1)
        return sorted(out)


def _borders(joined: str, low: int, high: int, before: int) -> list[int]:
    """Places from low to high where a word starts (before: -1) or ends (0)."""
    low, high = max(0, low), min(len(joined), high)
    return [p for p in range(low, high + 1) if (joined[p + before] == " " if 0 <= p + before < len(joined) else p in (0, len(joined)))]


def read_words(text: str | None) -> tuple[str, int]:
    """Words of the lower-cased text joined by single spaces, and their number."""
    words = WORD.findall((text or "").translate(LOWER))
    return " ".join(words), len(words)


def in_text(text: str, joined: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the joined words as code points of the text, end exclusive."""
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    return [(places[joined.count(" ", 0, a)][0], places[joined.count(" ", 0, b)][1]) for a, b in spans]


def scan_licenses(docs: DataFrame, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans; one row per row.

    spans: label, start, end (code points of the text, end exclusive), errors (insertions, deletions and substitutions in the joined words) and score, 1 - errors / characters of the
    notice; a phrase's place has no errors. Of one label's notices that overlap, the one with the fewest errors, then the longest, then the first stays. The document's score is its best
    span's, 0 without any. Null and empty texts have no words and no spans; first_word and last_word are null without a base place. Rows that repeat are judged alike, null ids
    stay, other columns are left alone, and no rows give none.
    """
    text_batches(docs.sparkSession)
    known = notices_of(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(known, phrases)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                joined, n_words = read_words(text)
                base, fuzzy = finder.base(joined), finder.matches(joined)
                places = [joined.count(" ", 0, a) for a, _, _ in base]
                found = [(label, a, b, 0, 1.0) for a, b, label in base]
                found += [(known[i].label, a, b, e, 1 - e / len(known[i].text)) for i, a, b, e in fuzzy]
                spans = in_text(text, joined, [(a, b) for _, a, b, _, _ in found]) if found else []
                labels = ",".join(sorted({x[0] for x in found}))
                row = [{"label": x[0], "start": a, "end": b, "errors": x[3], "score": x[4]} for x, (a, b) in zip(found, spans, strict=True)]
                row.sort(key=lambda x: (x["start"], x["end"], x["label"]))
                rows.append((doc, n_words, len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x[2] for x in base})), labels, max([x[4] for x in found], default=0.0), row))
            cols = list(zip(*rows, strict=True)) or [()] * 9
            span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32()), ("score", pa.float64())]))
            types = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64(), span]
            names = [c.split()[0] for c in COLUMNS.split(", ")] + ["spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), f"{COLUMNS}, {SPANS}")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license notices; odd rows as in scan_licenses."""
    return scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


__all__ = ["Finder", "op12_license_scan", "scan_licenses"]
