"""Alignment of two tokenizers' ids over the same bytes, by white-space anchors.

Both tokenizers encode the whole text. Byte offsets where tokens of both end, and where the next token of both is marked by a space, are verified
shared ends; they split a document into windows of token ids. A window's groups and links depend on its ids alone, so they are worked out
once for each pair of id tuples and remembered. A document then keeps its distinct id pairs with their occurrences; counting documents
by pair, and looking the counts up again, is grouping and joining on Spark.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read, staged, text_batches
from .packing import byte_letters

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bounds of a task's tables, of which an older one is kept. Longer chunks and windows are worked out each time.
CACHE_CHUNKS, CACHE_WORDS, CACHE_WINDOWS, LONGEST_CHUNK, LONGEST_WINDOW = 250_000, 250_000, 200_000, 64, 64
#: Words that are encoded at once; links of a window from which on they are counted by distinct ids.
AT_ONCE, MANY_LINKS = 2000, 4096
#: Most id pairs that are broadcast with their counts, the most frequent ones; the others are joined by a shuffle.
MOST_PAIRS = 500_000
#: Code points that a tokenizer may take for white space, or that stand for it, besides what regular expressions call so.
SPACE_LIKE = [*range(0x21), *range(0x7F, 0xA1), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x2581, 0x3000, 0xFEFF]
#: A character that is surely none, so that one space between two of them starts a token in both vocabularies.
SOLID = r"[^\s" + "".join(map(re.escape, map(chr, SPACE_LIKE))) + "]"
PARTS = re.compile(f"(?<={SOLID}) (?={SOLID})")
CLEAN = re.compile(f"{SOLID}(?s:.*{SOLID})?")
#: Latin letters by code point, and signs after a word that may be encoded apart from it.
LETTER = "A-Za-z" + "".join(f"{chr(x)}-{chr(y)}" for x, y in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F)))
TAIL_SIGNS = ".,;:!?)*#$%&"
DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _sizes(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each id, and whether it begins with a space."""
    return np.array([len(x) for x in spelled], dtype=np.int64), np.array([x[:1] == b" " for x in spelled])


class BytePairs:
    """A byte-level vocabulary: ids of " " + text, and each id's bytes. Strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        back = {ord(c): b for b, c in byte_letters().items()}
        vocabulary = self.library.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes[i] = bytes(back[ord(c)] for c in piece) if all(ord(c) in back for c in piece) else piece.encode()
        self.sizes, self.marked = _sizes(self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentence-piece vocabulary that adds the space itself; no piece holds a space mark after another character."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.vocab_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece of this vocabulary reaches across a space; texts cannot be encoded by their chunks")
        self.sizes, self.marked = _sizes(self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


#: A chunk's ids in both vocabularies, and whether both spell it back. UNCLEAN: a part that is no chunk of its own.
Chunk = tuple[bytes, bytes, bool]
UNCLEAN: Chunk = (b"", b"", False)


class Table(dict):
    """What a task remembers. A full table becomes the older one, from which entries come back when asked for; what is older still goes."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def turn(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()

    def missing(self, keys: set) -> set:
        """Those of keys that neither table has; the older one's are brought back."""
        absent = set(filterfalse(self.__contains__, keys))
        back = absent & self.older.keys()
        self.update(zip(back, map(self.older.__getitem__, back), strict=True))
        return absent - back


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """low, low + 1 and so on, size of them, one range after the other."""
    return np.repeat(low - (size.cumsum() - size), size) + np.arange(size.sum())


def _gathered(values: tuple[bytes, ...], used: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The values (of 32-bit words) that are used, joined from each end to the next."""
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    words = np.frombuffer(b"".join(values), "<u4")
    start, n = size.cumsum() - size, size[used]
    raw = words[_ranges(start[used], n)].tobytes()
    at = (4 * np.concatenate([[0], n.cumsum()])[ends]).tolist()
    return [raw[i:j] for i, j in zip(at, at[1:], strict=False)]


class Whole:
    """Ids of whole texts in both vocabularies, chunk by chunk between single spaces, as no token of either reaches across one.

    A chunk of one or two lines, each of Latin letters and signs after them, is encoded by words and signs where no token of the piece vocabulary joins a letter and
    such a sign (the byte-level one never does).
    """

    def __init__(self, a: BytePairs, b: Pieces):
        self.a, self.b = a, b
        self.chunks, self.words, self.tails = Table(CACHE_CHUNKS), Table(CACHE_WORDS), Table(CACHE_WORDS)
        joined = re.compile(f"[{LETTER}](.)", re.DOTALL)
        apart = set(TAIL_SIGNS).difference(*(set(joined.findall(x.decode(errors="ignore"))) for x in b.bytes))
        line = f"([{LETTER}]+)([{re.escape(''.join(sorted(apart)))}]*)" if apart else f"([{LETTER}]+)()"
        self.line_end = [v.bytes.index(b"\n") for v in (a, b)]
        lines = all(x == b"\n" or b"\n" not in x for x in b.bytes)
        self.plain = re.compile(f"{line}(?:(\n{line[1:]})?" if lines else f"{line}()()")

    def _same(self, a: list[int], b: list[int], spelled: bytes) -> bool:
        return all(b"".join([v.bytes[i] for i in ids]) == spelled for v, ids in ((self.a, a), (self.b, b)))

    def _learn_words(self, words: list[str], mark: str) -> None:
        """Words of Latin letters that begin with the mark (a space, which is left out, or a line end): encoded in one text, whose marks begin them."""
        for at in range(0, len(words), AT_ONCE):
            group, cut = words[at : at + AT_ONCE], []
            text = " ".join(group) if mark == " " else "a" + "".join(group)
            for v, line_end in zip((self.a, self.b), self.line_end, strict=True):
                ids = np.array(v.encode([text])[0], dtype="<u4")
                starts = [*(4 * np.flatnonzero(v.marked[ids] if mark == " " else ids == line_end)).tolist(), 4 * len(ids)]
                raw = ids.tobytes()
                cut.append([raw[x:y] for x, y in zip(starts, starts[1:], strict=False)])
                if b"".join(map(v.bytes.__getitem__, ids.tolist())) != b" " + text.encode() or len(cut[-1]) != len(group):
                    raise ValueError("a vocabulary does not spell words of Latin letters")
            self.words.update(zip(group, [(x, y, True) for x, y in zip(*cut, strict=True)], strict=True))

    def _learn_tails(self, signs: list[str]) -> None:
        if signs:
            coded = [v.encode(["a", *["a" + x for x in signs]]) for v in (self.a, self.b)]
            for x, a, b in zip(signs, *[[ids[len(c[0]) :] for ids in c[1:]] for c in coded], strict=True):
                self.tails[x] = (np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes(), self._same(a, b, x.encode()))

    def learn(self, chunks: set[str]) -> None:
        found = [(c, self.plain.fullmatch(c)) for c in self.chunks.missing(chunks)]
        plain = [(c, *m.groups("")) for c, m in found if m]
        odd = [c for c, m in found if not m]
        self.chunks.update(dict.fromkeys([c for c in odd if not CLEAN.fullmatch(c)], UNCLEAN))
        self.words.turn()
        self.tails.turn()
        columns = list(zip(*plain, strict=True)) or [()] * 5
        self._learn_words(sorted(self.words.missing(set(columns[1]))), " ")
        self._learn_words(sorted(self.words.missing(set(columns[3]).difference([""]))), "\n")
        self._learn_tails(sorted(self.tails.missing({*columns[2], *columns[4]}.difference([""]))))
        none = (b"", b"", True)
        word, tail = self.words.get, self.tails.get
        for c, w, signs, second, more in plain:
            (a, b, _), (ta, tb, same) = word(w), tail(signs, none)
            if second:
                (a2, b2, _), (ta2, tb2, same2) = word(second), tail(more, none)
                ta, tb, same = ta + a2 + ta2, tb + b2 + tb2, same and same2
            self.chunks[c] = (a + ta, b + tb, same)
        self.chunks.update(self._odd([c for c in odd if c not in self.chunks]))

    def _odd(self, chunks: list[str]) -> dict[str, Chunk]:
        """Encodes chunks as they are, also those at a text's ends that begin or end with white space."""
        ids = zip(chunks, self.a.encode(chunks), self.b.encode(chunks), strict=True)
        return {c: (np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes(), self._same(a, b, b" " + c.encode())) for c, a, b in ids}

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes] | None]:
        """A and B ids of each text, little-endian with 32 bits; None if it is empty, or if either's joined bytes are not those of a space and the text. A part is looked up once, however many texts of the list have it."""
        self.chunks.turn()
        parts = pc.split_pattern(pa.array([t or "" for t in texts], pa.large_string()), " ")
        ends, coded = parts.offsets.to_numpy(), parts.flatten().dictionary_encode()
        used, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(set(distinct))
        a, b, same = zip(*map(self.chunks.__getitem__, distinct), strict=True)
        faulty = np.logical_not(same)[used]
        faults = np.concatenate([[0], faulty.cumsum()])[ends]
        ids = [_gathered(x, used, ends) for x in (a, b)]
        out: list[tuple[bytes, bytes] | None] = []
        for n, t in enumerate(texts):
            if not t:
                out.append(None)
            elif faults[n] == faults[n + 1]:
                out.append((ids[0][n], ids[1][n]))
            else:
                own = [distinct[i] for i in used[ends[n] : ends[n + 1]].tolist()]
                found = ids[0][n], ids[1][n]
                if any(self.chunks[c] is UNCLEAN for c in own):
                    own = PARTS.split(t)
                    odd = self._odd([c for c in set(own) if self.chunks.get(c, UNCLEAN) is UNCLEAN])
                    x, y, _ = zip(*[odd.get(c) or self.chunks[c] for c in own], strict=True)
                    found = b"".join(x), b"".join(y)
                out.append(found if self._spelled(found, t) else None)
        for c in distinct:
            if len(c) > LONGEST_CHUNK:
                self.chunks.pop(c, None)
        return out

    def _spelled(self, ids: tuple[bytes, bytes], text: str) -> bool:
        a, b = (np.frombuffer(x, "<u4").tolist() for x in ids)
        return self._same(a, b, b" " + text.encode())


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([*values, np.zeros(0, dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int64), pa.int64()).cast(kind))


#: What a window adds to its document: its groups as text, their number, the number of links, all linked pairs (64 bits each, repeated as linked), or, of
#: a window with many links, none of these but its distinct pairs and their occurrences.
Window = tuple[str, int, int, bytes, tuple[np.ndarray, np.ndarray] | None]


class Aligner:
    """Windows of two token-id sequences over the same bytes, remembered by their ids."""

    def __init__(self, a: BytePairs, b: Pieces):
        self.a, self.b = a, b
        self.base = len(b.bytes)
        #: Ids as text with what follows them: another id of the group and side, or the end of the side.
        self.text = [f"{i}{end}" for v, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(len(v.bytes))]
        self.known = Table(CACHE_WINDOWS)  # by the A and B ids, with a word that is no id between them

    def align(self, documents: list[tuple[bytes, bytes]]) -> list[tuple[int, int, str, np.ndarray, np.ndarray]]:
        """Groups, links and digest of each document, given as A and B ids (little-endian, 32 bits) that spell the same bytes; its distinct pairs and how often each is linked.

        The documents lie one after the other: each begins with a space in both, so its start is an anchor too. A window is looked up once, however often they hold it; those that are not remembered are worked out together."""
        if not documents:
            return []
        self.known.turn()
        a, b = (np.frombuffer(b"".join(x), "<u4") for x in zip(*documents, strict=True))
        end_a, end_b = self.a.sizes[a].cumsum(), self.b.sizes[b].cumsum()
        shared = np.intersect1d(end_a[:-1][self.a.marked[a[1:]]], end_b[:-1][self.b.marked[b[1:]]], assume_unique=True)
        ends = np.append(shared, end_a[-1])
        to_a, to_b = np.searchsorted(end_a, ends) + 1, np.searchsorted(end_b, ends) + 1
        size_a, size_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        # a window as bytes: A ids, a word that is no id, B ids
        place = np.arange(len(ends))
        words = np.full(len(a) + len(b) + len(ends), 0xFFFFFFFF, dtype="<u4")
        words[np.arange(len(a)) + np.repeat(place + to_b - size_b, size_a)] = a
        words[np.arange(len(b)) + np.repeat(place + 1 + to_a, size_b)] = b
        offsets = np.concatenate([[0], 4 * (size_a + size_b + 1).cumsum()])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(words.tobytes())]).dictionary_encode()
        used, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = self.known.missing(set(distinct))
        if fresh:
            first = np.zeros(len(distinct), dtype=np.int64)
            first[used[::-1]] = place[::-1]
            cut = {k: 4 * n for k, n in zip(distinct, size_a[first].tolist(), strict=True) if k in fresh}
            solved = self.solve([(k[:n], k[n + 4 :]) for k, n in cut.items()])
            self.known.update({k: solved[k[:n], k[n + 4 :]] for k, n in cut.items()})
        texts, groups, links, raw, many = zip(*map(self.known.__getitem__, distinct), strict=True)
        for k in fresh:
            if len(k) > 8 * LONGEST_WINDOW:
                del self.known[k]
        last = np.searchsorted(ends, end_a[np.cumsum([len(x) // 4 for x, _ in documents]) - 1])  # each document's last window
        to = np.concatenate([[0], last + 1])
        sums = [np.concatenate([[0], np.array(x, dtype=np.int64)[used].cumsum()])[to] for x in (groups, links)]
        counted = self._counted(raw, many, used, to)
        out, used = [], used.tolist()
        for n, (i, j) in enumerate(zip(to.tolist(), to[1:].tolist(), strict=False)):
            digest = hashlib.sha256(";".join([texts[w] for w in used[i:j]]).encode()).hexdigest()
            out.append((int(sums[0][n + 1] - sums[0][n]), int(sums[1][n + 1] - sums[1][n]), digest, *counted[n]))
        return out

    def _counted(self, raw: tuple[bytes, ...], many: tuple, used: np.ndarray, to: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each document's distinct pairs, and how often they are linked, from those of its windows."""
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
        start, n = size.cumsum() - size, size[used]
        pairs = np.frombuffer(b"".join(raw), np.int64)[_ranges(start[used], n)]
        ends = np.concatenate([[0], n.cumsum()])[to].tolist()
        large, out = {i for i, m in enumerate(many) if m is not None}, []
        for k, (i, j) in enumerate(zip(ends, ends[1:], strict=False)):
            own, times = np.unique(pairs[i:j], return_counts=True)
            big = [many[w] for w in used[to[k] : to[k + 1]].tolist() if w in large] if large else []
            if big:
                every, at = np.unique(np.concatenate([own, *[p for p, _ in big]]), return_inverse=True)
                own, times = every, np.bincount(at, weights=np.concatenate([times, *[t for _, t in big]])).astype(np.int64)
            out.append((own, times))
        return out

    def solve(self, keys: list[tuple[bytes, bytes]]) -> dict[tuple[bytes, bytes], Window]:
        """Groups end where tokens of both end; all windows lie one after the other, as if they were one text."""
        if not keys:
            return {}
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in zip(*keys, strict=True))
        size_a, size_b = (np.array([len(k[i]) // 4 for k in keys]) for i in (0, 1))
        end_a, end_b = self.a.sizes[a].cumsum(), self.b.sizes[b].cumsum()
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        in_a, in_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        m, n = np.bincount(in_a, minlength=len(shared)), np.bincount(in_b, minlength=len(shared))
        of_group = np.searchsorted(end_a[size_a.cumsum() - 1], shared)
        links = np.bincount(of_group, weights=m.astype(float) * n, minlength=len(keys))
        if len(keys) > 1 and links.max() > MANY_LINKS:
            many = [k for k, x in zip(keys, links, strict=True) if x > MANY_LINKS]
            rest = [k for k, x in zip(keys, links, strict=True) if x <= MANY_LINKS]
            return self.solve(rest) | {k: w for key in many for k, w in self.solve([key]).items()}
        groups, links = np.bincount(of_group, minlength=len(keys)), links.astype(np.int64)
        before_a, before_b = m.cumsum() - m, n.cumsum() - n
        # texts: A ids of a group, then its B ids
        order = np.empty(len(a) + len(b), dtype=np.int64)
        last_a, last_b = end_a == shared[in_a], end_b == shared[in_b]
        order[np.arange(len(a)) + before_b[in_a]] = a + last_a * len(self.a.bytes)
        order[np.arange(len(b)) + (before_a + m)[in_b]] = b + 2 * len(self.a.bytes) + last_b * self.base
        words = list(map(self.text.__getitem__, order.tolist()))
        ends = (size_a + size_b).cumsum().tolist()
        texts = ["".join(words[i:j])[:-1] for i, j in zip([0, *ends], ends, strict=False)]
        if links[0] > MANY_LINKS:
            return {keys[0]: (texts[0], int(groups[0]), int(links[0]), b"", self._distinct(a, b, m, n, before_a, before_b))}
        # pairs: each A id with all B ids of its group
        times = n[in_a]
        first = np.repeat(before_b[in_a] - (times.cumsum() - times), times)
        raw = (np.repeat(a, times) * self.base + b[first + np.arange(len(first))]).tobytes()
        ends = (8 * links.cumsum()).tolist()
        return {k: (t, g, x, raw[i:j], None) for k, t, g, x, i, j in zip(keys, texts, groups.tolist(), links.tolist(), [0, *ends], ends, strict=False)}

    def _distinct(self, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray, before_a: np.ndarray, before_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs, times = [], []
        for i, j, k, x in zip(before_a.tolist(), m.tolist(), before_b.tolist(), n.tolist(), strict=True):
            (ui, ni), (uj, nj) = (np.unique(v, return_counts=True) for v in (a[i : i + j], b[k : k + x]))
            pairs.append((ui[:, None] * self.base + uj).ravel())
            times.append((ni[:, None] * nj).ravel())
        return np.concatenate(pairs), np.concatenate(times)


def linked_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """docs(doc_id, text) -> a row per document: its counts, its groups' digest, its distinct pairs (A id * size of B + B id) and their occurrences."""
    text_batches(docs.sparkSession)
    b_size = len(Pieces(path_b).bytes)
    wide = len(BytePairs(path_a).bytes) * b_size >= 1 << 31

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = Whole(BytePairs(path_a), Pieces(path_b))
        aligner = Aligner(coder.a, coder.b)
        none = np.zeros(0, dtype=np.int64)
        gc.disable()  # nothing here is cyclic, and the tables are large
        for batch in batches:
            rows, pairs, times = [], [], []
            coded = coder.encode(batch.column("text").to_pylist())
            aligned = iter(aligner.align([ids for ids in coded if ids is not None]))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                if ids is None:
                    rows.append((doc, 0, 0, 0, 0, ""))
                    pairs.append(none)
                    times.append(none)
                    continue
                groups, links, digest, p, n = next(aligned)
                rows.append((doc, len(ids[0]) // 4, len(ids[1]) // 4, groups, links, digest))
                pairs.append(p)
                times.append(n)
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [*[pa.int64()] * 5, pa.string()]
            lists = [_lists(pairs, pa.int64() if wide else pa.int32()), _lists(times, pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)] + lists, [*COLUMNS[:5], "groups_sha256", "pairs", "times"])
        gc.enable()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), f"{DOCUMENT}, pairs array<{'long' if wide else 'int'}>, times array<long>").withColumn("base", F.lit(b_size))


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, count (documents that hold it), best (1 if no pair of its A id has more, ties included; else 0)."""
    counts = linked.select("base", F.explode("pairs").alias("pair")).groupBy("base", "pair").agg(F.count("*").alias("count"))
    counts = staged(counts.withColumn("a", F.expr("pair div base")), "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row per row.

    A null or empty text, and one that either tokenizer does not spell back byte for byte (its joined tokens are not a space and the text), has no tokens: zeros
    and an empty digest. Rows that repeat an id, and null ids, are documents of their own and count as such; other columns are left alone. No rows give none.
    Pairs with equal counts are all best. The pairs with the highest counts are broadcast, at most most_pairs of them; the rest, whose counts are
    lower and so make no hot key, are joined by a shuffle.
    """
    linked = staged(linked_documents(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "alignment-documents")
    counts = staged(pair_counts(linked), "alignment-pairs")
    sizes = counts.groupBy((F.length(F.bin("count")) - 1).alias("power")).agg(F.count("*").alias("n")).collect()  # a row per power of two
    least = 0
    while sum(r["n"] for r in sizes if r["power"] >= least) > most_pairs:
        least += 1
    often = F.broadcast(counts.where(F.col("count") >= 1 << least))
    links = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    found = links.join(often, "pair", "left" if least else "inner")
    if least:
        rest = found.where("count is null").select("row", "pair", "times").join(counts.where(F.col("count") < 1 << least), "pair")
        found = found.where("count is not null").unionByName(rest)
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.col("count")).alias("count_sum"), F.sum(F.col("times") * F.col("best")).alias("n_best"))
    sums = sums.withColumnsRenamed({"row": "of_row"})
    joined = linked.join(sums, F.col("row") == F.col("of_row"), "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("count_sum", "n_best")}).select(*COLUMNS)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment of the byte-level and the sentence-piece vocabulary; odd rows as in align_tokens."""
    return align_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B))


def plain_alignment(texts: list[str | None], path_a: str, path_b: str) -> list[tuple]:
    """The same by the libraries' whole encoding and a walk over all bytes; for tests. n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    a, b = BytePairs(path_a), Pieces(path_b)
    all_links, rows, documents = [], [], Counter()
    for t in texts:
        x, y = (v.encode([t])[0] if t else [] for v in (a, b))
        if any(b"".join(v.bytes[i] for i in ids) != b" " + (t or "").encode() for v, ids in ((a, x), (b, y))):
            x, y = [], []
        groups, i, j, at_a, at_b = [([], [])] if x else [], 0, 0, 0, 0
        while i < len(x) or j < len(y):
            if at_a <= at_b and i < len(x):
                groups[-1][0].append(x[i])
                at_a += len(a.bytes[x[i]])
                i += 1
            else:
                groups[-1][1].append(y[j])
                at_b += len(b.bytes[y[j]])
                j += 1
            if at_a == at_b and (i < len(x) or j < len(y)):
                groups.append(([], []))
        links = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        documents.update(links.keys())
        all_links.append(links)
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        rows.append((len(x), len(y), len(groups), sum(links.values()), hashlib.sha256(text.encode()).hexdigest() if x else ""))
    most = Counter()
    for (p, _), n in documents.items():
        most[p] = max(most[p], n)
    return [(*r[:4], sum(n for (p, q), n in k.items() if documents[p, q] == most[p]), sum(n * documents[pq] for pq, n in k.items()), r[4]) for r, k in zip(rows, all_links, strict=True)]


__all__ = ["Aligner", "align_tokens", "op11_token_alignment", "plain_alignment"]
