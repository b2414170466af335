"""Language identification, word first: known words by log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, text_batches

#: The bound of the sample that the model is fitted on: labelled documents of each language, and of all, which many languages share evenly (one each at least).
DOCS_PER_LANG, MOST_DOCS = 600, 38_400
#: Parts of a language's documents among which the sample is chosen first.
PARTS = 32
#: Partitions in which the sample's counts come to the driver, one after the other.
FEW_PARTS = 4
#: Longest n-gram that an unseen word is looked up by, and what a step to a shorter one costs (log).
LONGEST, BACKOFF = 4, math.log(0.4)
#: Log score of a place without any known n-gram.
FLOOR = -20.0
UNKNOWN = "und"
WORD = regex.compile(r"\p{L}+")  # letters alone: not digits, fractions or other numerals
#: Words whose scores a worker keeps; a full table starts anew.
CACHE_WORDS = 100_000


class WordBackoff:
    """Per-language log frequencies of words, and of their n-grams, with every word marked by ^ and $.

    An unseen word is covered by n-grams: at each place the longest known one that starts there counts, each
    step to a shorter one at a fixed cost. Add-half smoothing, over the types of the same length.
    """

    def __init__(self, words: dict[str, Counter]):
        self.langs = sorted(lang for lang, c in words.items() if c)
        counts = [words[lang] for lang in self.langs]
        self.known = list(dict.fromkeys(w for c in counts for w in c))
        self.scores = self._logs(counts, self.known)
        self.gram: dict[str, int] = {}  # n-gram -> row of gram_scores; row 0 stands for a place without a known one
        tables = [np.full((1, len(self.langs)), FLOOR, dtype=np.float32)]
        for size in range(1, LONGEST + 1):
            of_size = [self._grams(c, size) for c in counts]
            keys = list(dict.fromkeys(g for c in of_size for g in c))
            self.gram.update(zip(keys, range(len(self.gram) + 1, len(self.gram) + 1 + len(keys)), strict=True))
            tables.append(self._logs(of_size, keys) + np.float32(BACKOFF * (LONGEST - size)))
        self.gram_scores = np.concatenate(tables)
        self._forget()

    @staticmethod
    def _grams(words: Counter, size: int) -> Counter:
        out: Counter = Counter()
        for w, k in words.items():
            s = f"^{w}$"
            for i in range(len(s) - size + 1):
                out[s[i : i + size]] += k
        return out

    @staticmethod
    def _logs(counts: list[Counter], keys: list[str]) -> np.ndarray:
        got = np.array([[c.get(k, 0) for k in keys] for c in counts], dtype=np.float64).reshape(len(counts), len(keys)) + 0.5
        return np.log(got / got.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def _forget(self) -> None:
        """Only the known words' rows stay. Row 0 is for what has no letter."""
        self.row = dict(zip(self.known, range(1, len(self.known) + 1), strict=True))
        self.table = np.concatenate([np.zeros((1, len(self.langs)), dtype=np.float32), self.scores.reshape(len(self.known), len(self.langs))])
        self.used = len(self.table)

    def places(self, w: str) -> list[int]:
        """The n-gram that counts at each place of a marked word."""
        s, get = f"^{w}$", self.gram.get
        out = []
        for i in range(len(s)):
            for size in range(LONGEST, 0, -1):
                if g := get(s[i : i + size]):
                    out.append(g)
                    break
            else:
                out.append(0)
        return out

    def _add(self, rows: np.ndarray) -> range:
        if self.used + len(rows) > len(self.table):
            grown = np.empty((self.used + len(rows) + CACHE_WORDS // 4, len(self.langs)), dtype=np.float32)
            grown[: self.used] = self.table[: self.used]
            self.table = grown
        self.table[self.used : self.used + len(rows)] = rows
        self.used += len(rows)
        return range(self.used - len(rows), self.used)

    def _learn(self, chunks: list[str]) -> None:
        """Rows for chunks between white space: the sum of their words' rows. An unseen word has the mean of its n-grams times the root of their number, as neighbours overlap."""
        row, parts = self.row, {c: WORD.findall(c) for c in chunks}
        if fresh := list({w for ws in parts.values() for w in ws if w not in row}):
            at = [self.places(w) for w in fresh]
            sizes = np.array([len(x) for x in at])
            sums = np.add.reduceat(self.gram_scores[[g for x in at for g in x]], np.cumsum(sizes) - sizes, axis=0)
            row.update(zip(fresh, self._add(sums / np.sqrt(sizes)[:, None]), strict=True))
        row.update((c, row[ws[0]] if ws else 0) for c, ws in parts.items() if len(ws) < 2)
        if many := [c for c, ws in parts.items() if len(ws) > 1]:
            row.update(zip(many, self._add(np.array([self.table[[row[w] for w in parts[c]]].sum(axis=0) for c in many])), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.langs:
            return out
        if len(self.row) > len(self.known) + CACHE_WORDS:
            self._forget()
        chunks = [t.lower().split() if t else [] for t in texts]
        full = [i for i, c in enumerate(chunks) if c]
        flat = [w for i in full for w in chunks[i]]
        if fresh := set(flat).difference(self.row):
            self._learn(sorted(fresh))
        if full:
            at = np.fromiter(map(self.row.__getitem__, flat), np.int64, len(flat))
            sizes = np.array([len(chunks[i]) for i in full])
            starts = np.cumsum(sizes) - sizes
            total = np.add.reduceat(self.table[at], starts, axis=0, dtype=np.float64)
            letters = np.maximum.reduceat(at, starts) > 0
            p = np.exp(total - total.max(axis=1, keepdims=True))
            best = p.argmax(axis=1)  # ties: the language that sorts first
            score = p[np.arange(len(full)), best] / p.sum(axis=1)
            for i, b, x, any_letter in zip(full, best.tolist(), score.tolist(), letters.tolist(), strict=True):
                if any_letter:
                    out[i] = (self.langs[b], x)
        return out


def word_counts(docs: Iterable[tuple[str, str]]) -> dict[str, Counter]:
    out: dict[str, Counter] = {}
    for lang, text in docs:
        out.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
    return out


def training_sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, most_docs: int = MOST_DOCS) -> DataFrame:
    """(lang, word, n) of the documents with the smallest id hashes of each language: docs_per_lang, or fewer where all languages together would exceed most_docs.
    Rows that repeat an id teach once a language, by their smallest text."""
    known = docs.where("lang is not null and text is not null")
    langs = known.select("lang").distinct().count()
    docs_per_lang = min(docs_per_lang, max(1, most_docs // max(1, langs)))
    ids = known.select("doc_id", "lang").withColumn("part", F.spark_partition_id() % PARTS)
    for group in (["lang", "part"], ["lang"]):  # the first of each part, then of those, so that no task reads a language whole
        w = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= docs_per_lang)
    ids = ids.select("doc_id", "lang")
    chosen = known.select("doc_id", "lang", "text").join(F.broadcast(ids.distinct()), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(lang, w, n) for lang, c in word_counts(zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True)).items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"])

    return chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, most_docs: int = MOST_DOCS) -> WordBackoff:
    """The model of docs(doc_id, text, lang); its size is bounded by the sample."""
    words: dict[str, Counter] = {}
    for r in training_sample(docs, docs_per_lang, most_docs).coalesce(FEW_PARTS).toLocalIterator(prefetchPartitions=True):
        words.setdefault(r.lang, Counter())[r.word] = r.n
    return WordBackoff({lang: Counter(dict(sorted(c.items()))) for lang, c in words.items()})


def predict_languages(docs: DataFrame, model: WordBackoff) -> DataFrame:
    """docs(doc_id, text) -> doc_id, lang_pred, score: the posterior of the predicted language under equal priors.

    Null text, and text without a letter, is 'und' with score 0, as is all text if nothing was learned. Whole texts
    are read, each row by itself: repeated rows and null ids return as they came. Other columns are left out.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = m.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose crc32 of the id is not divisible by 5; a null id neither teaches nor is held out."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    out = predict_languages(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
