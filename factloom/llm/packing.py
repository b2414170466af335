"""Best-fit packing by exact-complement hashing.

Documents are tokenized once and cut into pieces. Which lengths share a sequence is decided on the histogram of lengths alone, which has at
most `capacity` entries whatever the input: for each length, longest first, the gap that it leaves is looked up among
single lengths, sums of two and sums of three that are still available, and as many such combinations are
consumed as the counts allow. What is left is placed best-fit, also by counts. Pieces then find their place by their rank within their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frugal, read, staged, text_batches

CAPACITY, END_ID = 2048, 0
TOKENIZER = "word_bpe_49k.json"
#: Chunks between white space, and words, whose ids a task's table takes before it becomes the older one, which is kept too: some 100 MB at most. A job whose workers hold much
#: else takes small tables, which cost time alone. A worker that kept them from task to task took more memory and no less time.
TABLE_CHUNKS, SMALL_TABLE_CHUNKS = 400_000, 60_000
#: Texts whose chunks are held at once; chunks that are encoded at once, parted by the end-of-text string.
TEXTS_AT_ONCE, AT_ONCE, PART = 64, 2000, "<|endoftext|>"
#: The characters whose lower case and composed form are the same by any Unicode version, lines of them, the letters and numbers among them, and the vocabulary's rule for words of them.
PLAIN = "!-~\u00a1-\u012f\u0131-\u017f"
PLAIN_LINES = re.compile(f"^[{PLAIN}]*+$", re.MULTILINE)
LETTERS, NUMBERS = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORDS = re.compile(f"[{LETTERS}]+|\n|[{NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^{LETTERS}{NUMBERS}\n]+")
SPECIAL = "<|"
#: Parts chunks among ids, of which none is so large.
CUT = b"\xff" * 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the others in order from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class ChunkTokenizer:
    """Ids of whole texts, from those of the chunks between white space.

    The vocabulary's pre-tokenizer drops white space, and no token, composed character or special string reaches across it, so a
    text's ids are its chunks' ids in order; each chunk is encoded once. Only spaces, tabs and line ends part chunks. A chunk of Latin letters and
    signs is parted into words here, which go to the vocabulary's merges one by one; all others take the library's whole way. A word is its own chunk, so
    chunks and words share a table; from the older one entries come back when asked for.
    """

    def __init__(self, path: str, table_chunks: int = TABLE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.part_id = self.tokenizer.token_to_id(PART)
        self.most = table_chunks
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.four = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [ids for at in range(0, len(texts), TEXTS_AT_ONCE) for ids in self._encode_few(texts[at : at + TEXTS_AT_ONCE])]

    def _encode_few(self, texts: list[str | None]) -> list[bytes]:
        parts = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ") if t else [] for t in texts]
        if len(self.ids) > self.most:
            self.older, self.ids = self.ids, {}
        known = [list(map(self.ids.get, p)) for p in parts]
        if fresh := self._older({c for p, k in zip(parts, known, strict=True) if None in k for c, ids in zip(p, k, strict=True) if ids is None}):
            words = {c for c in fresh if c.isascii() and c.isalpha() and c.islower()}
            others = list(fresh.difference(words))
            joined = "\n".join(others)
            plain = PLAIN_LINES.findall(joined) if others else []
            if SPECIAL in joined:
                plain = [c for c in plain if SPECIAL not in c]
            self._learn(words, plain)
            rest = sorted(set(others).difference(plain))
            odd = [c for c in rest if PART in c]
            rest = [c for c in rest if PART not in c]
            for group in [[c] for c in odd] + [rest[i : i + AT_ONCE] for i in range(0, len(rest), AT_ONCE)]:
                self.ids.update(zip(group, self._encoded(group), strict=True))
        get = self.ids.__getitem__
        return [b"".join([get(c) if ids is None else ids for c, ids in zip(p, k, strict=True)] if None in k else k) for p, k in zip(parts, known, strict=True)]

    def _older(self, chunks: set[str]) -> set[str]:
        """Those of chunks, which the table has not, that the older one has not either; that one's are brought back."""
        back = chunks & self.older.keys()
        self.ids.update(zip(back, map(self.older.__getitem__, back), strict=True))
        return chunks - back if back else chunks

    def _learn(self, words: set[str], chunks: list[str]) -> None:
        """words: chunks that are words as they are; chunks: of plain characters."""
        found = WORDS.findall("\n".join(chunks).lower())
        ids, tokenize, letters, four = self.ids, self.model.tokenize, self.letters, self.four
        for w in words | self._older(set(found).difference(ids, "\n")):
            ids[w] = b"".join([four[t.id] for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(letters))])
        if chunks:
            ids["\n"] = CUT
            ids.update(zip(chunks, b"".join(map(ids.__getitem__, found)).split(CUT), strict=True))
            del ids["\n"]

    def _encoded(self, chunks: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode_batch_fast([PART.join(chunks)], add_special_tokens=False)[0].ids, dtype="<u4")
        if len(chunks) == 1:
            return [ids.tobytes()]
        cuts = np.flatnonzero(ids == self.part_id)
        return [ids[a:b].tobytes() for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """docs(doc_id, text) -> a row per piece, with its task's number and its rank among the task's pieces of its length."""
    text_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder, task, seen = ChunkTokenizer(tokenizer_path, table_chunks), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            rows = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), coder.encode(b.column("text").to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), PIECES + ", task int, task_rank long")


@dataclass
class Pattern:
    """So many sequences that hold these lengths, in this order."""

    lengths: list[int]
    times: int


def _complement(gap: int, left: np.ndarray) -> list[int] | None:
    """One, two or three available lengths that sum to gap; the longest first part wins. left: counts by length."""
    if gap < len(left) and left[gap] > 0:
        return [gap]
    there = left > 0
    pair = lambda g, most: _pair(g, most, left, there)
    if found := pair(gap, gap):
        return found
    for a in range(min(gap - 2, len(left) - 1), (gap + 2) // 3 - 1, -1):
        if there[a]:
            left[a] -= 1
            rest = _pair(gap - a, a, left, left > 0)
            left[a] += 1
            if rest:
                return [a, *rest]
    return None


def _pair(gap: int, most: int, left: np.ndarray, there: np.ndarray) -> list[int] | None:
    hi, lo = min(gap - 1, most, len(left) - 1), (gap + 1) // 2
    if hi < lo:
        return None
    both = there[lo : hi + 1] & there[gap - hi : gap - lo + 1][::-1]
    if gap % 2 == 0 and both[0] and left[lo] < 2:
        both[0] = False
    at = np.flatnonzero(both)
    return [lo + int(at[-1]), gap - lo - int(at[-1])] if len(at) else None


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up counts (length -> number of pieces, lengths 1 to capacity)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in counts.items():
        left[n] = k
    out: list[Pattern] = []
    if left[capacity]:
        out.append(Pattern([capacity], int(left[capacity])))
        left[capacity] = 0
    for n in range(capacity - 1, 0, -1):
        while left[n] > 0:
            left[n] -= 1
            parts = _complement(capacity - n, left)
            left[n] += 1
            if not parts:
                break
            whole = [n, *parts]
            times = min(int(left[x]) // whole.count(x) for x in set(whole))
            out.append(Pattern(whole, times))
            for x in whole:
                left[x] -= times
    return out + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Longest first into the fullest sequences with room; sequences of equal contents are one pattern."""
    open_: dict[int, list[Pattern]] = {}
    gaps = np.zeros(capacity + 1, dtype=bool)

    def put(p: Pattern) -> None:
        gap = capacity - sum(p.lengths)
        open_.setdefault(gap, []).append(p)
        gaps[gap] = True

    for n in range(capacity, 0, -1):
        k = int(left[n])
        while k:
            room = np.flatnonzero(gaps[n:])
            if len(room):
                gap = n + int(room[0])
                p = open_[gap].pop()
                gaps[gap] = bool(open_[gap])
                used = min(k, p.times)
                if used < p.times:
                    put(Pattern(p.lengths, p.times - used))
                put(Pattern([*p.lengths, n], used))
                k -= used
            else:
                each = capacity // n
                if k >= each:
                    put(Pattern([n] * each, k // each))
                if k % each:
                    put(Pattern([n] * (k % each), 1))
                k = 0
    return [p for ps in open_.values() for p in ps]


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): ranks of a length are dealt out in the patterns' order."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for p in patterns:
        offset = 0
        for n in p.lengths:
            at = used.get(n, 0)
            out.append((n, at, at + p.times, sequence, offset))
            used[n] = at + p.times
            offset += n
        sequence += p.times
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset; a row per piece.

    Null and empty text is the end id alone. Repeated rows and null ids are documents of their own. Empty tables give no rows;
    other columns are left out. Only the histogram of lengths, capacity entries at most, reaches the driver, and only the plan made of it is broadcast.
    """
    spark = docs.sparkSession
    pieces = staged(tokenized_pieces(docs, tokenizer_path, capacity, end_id, table_chunks), "packing-pieces")
    by_task = staged(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "packing-counts")
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(places(plan_patterns(counts, capacity)), "length long, first long, end long, sequence long, offset long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("task_rank"))
    out = ranked.join(F.broadcast(plan.withColumnRenamed("length", "of_length")), (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


ORACLE_SQL = None
