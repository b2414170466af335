"""Secret scans: fixed patterns, and a linear-chain conditional random field that finds what they miss.

The field tags pieces (runs of letters and digits, or single signs) as B, I or O: beginning, inside and outside of a secret. Its features are the
piece's shape and length, the two pieces before and the one after it, and how code-like the text is. It is fitted by
maximum likelihood on a bounded sample of windows, some from all documents that the fixed patterns match and some from all others; the patterns give the labels. Each labelled window is
also shown under other names, without one, and with random strings of another alphabet and other lengths, so that the shape itself is learned; some of the others also in capitals. Whole texts are decoded by Viterbi. A piece that stays O under the most favourable
moves is O on every best path, so Viterbi runs only over the stretches between such pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read, staged, text_batches

#: The fixed patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
CUES = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: All that the fixed patterns match, and a little more, in one pattern that Java reads alike.
LIKELY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"""
#: Bounds of the sample: windows with a label, and windows of documents without one, each from another document.
SAMPLE_LABELLED, SAMPLE_PLAIN, WINDOW, PLAIN_EVERY = 300, 3000, 64, 4
LEAST_FOUND = 8
#: Pieces whose features a worker keeps; a full table starts anew.
CACHE_PIECES = 100_000
STEPS, RATE, PENALTY = 60, 0.2, 1e-4
PIECE = re.compile(r"[^\W_]+|[^\w\s]|_")
LENGTHS = (2, 4, 8, 12, 16, 20, 32, 40)
#: Pieces that neighbours see by name; all else is seen by shape.
NAMED = ("password", "passwd", "secret", "token", "apikey", "api", "key", "pwd", "auth", "bearer", "private", "credential", "credentials", "access", "=", ":", '"', "'", "+", "/", "_", ".", "-", ",", "@", "|")
#: The first of these name secrets; windows are shown under each of CUE_NAMES in turn.
N_CUES, CUE_NAMES = 14, ("pwd", "auth", "bearer", "private", "credential", "access")
SHAPES = ("sign", "digits", "hex", "lower", "upper", "title", "letters", "mixed", "other")
N_OWN = len(SHAPES) * (len(LENGTHS) + 1)
N_NEAR = len(NAMED) + len(SHAPES) * 3 + 1  # the last: none, at a text's ends
MASKED = len(NAMED) + 3 * SHAPES.index("lower") + 1
TAGS, B, I, O = 3, 0, 1, 2  # noqa: E741
_NAMED = {x: i for i, x in enumerate(NAMED)}


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, in code points, by start and kind."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(c in low for c in CUES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the fixed patterns' matches hold the secret itself: the labels."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    parts += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS] + [m.span() for m in HEX.finditer(text)]
    return sorted(parts)


def shape(piece: str) -> str:
    if not piece[0].isalnum():
        return "sign"
    if not piece.isascii():
        return "letters" if piece.isalpha() else "other"
    if piece.isdigit():
        return "digits"
    if piece.isalpha():
        return "lower" if piece.islower() else "upper" if piece.isupper() else "title" if piece.istitle() else "letters"
    return "hex" if not set(piece) - set("0123456789abcdef") else "mixed"


def own_feature(piece: str) -> int:
    return SHAPES.index(shape(piece)) * (len(LENGTHS) + 1) + sum(len(piece) >= n for n in LENGTHS)


def near_feature(piece: str) -> int:
    if (i := _NAMED.get(piece.lower())) is not None:
        return i
    return len(NAMED) + 3 * SHAPES.index(shape(piece)) + (len(piece) >= 4) + (len(piece) >= 16)


def file_feature(text: str) -> int:
    """0 to 3: none, few, some or many signs of code among the characters."""
    share = sum(map(text.count, '={}[];"')) / max(1, len(text))
    return (share > 0) + (share > 0.005) + (share > 0.03)


#: Feature groups: own, one before, two before, one after, file.
OFFSETS = np.cumsum([0, N_OWN, N_NEAR, N_NEAR, N_NEAR])
N_FEATURES = int(OFFSETS[-1]) + 4


def features(own: np.ndarray, near: np.ndarray, file: int) -> np.ndarray:
    """(pieces, 5): rows of the weight table."""
    none = N_NEAR - 1
    before = np.concatenate([[none], near[:-1]])
    before2 = np.concatenate([[none, none], near[:-2]])[: len(near)]
    after = np.concatenate([near[1:], [none]])
    return np.stack([own, before, before2, after, np.full(len(own), file)], axis=1) + OFFSETS


class ChainField:
    """weights (features, tags), moves (from, to)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self.codes: dict[str, int] = {}
        # A place is O on every best path if O leads by more than any moves into and out of another tag can make up for.
        gain_in, gain_out = (moves - moves[:, [O]]).max(axis=0), (moves - moves[[O], :]).max(axis=1)
        self.lead = (gain_in + gain_out)[:O]

    def decode(self, emissions: np.ndarray) -> list[int]:
        """Viterbi between two pieces that are O."""
        score, back = emissions[0] + self.moves[O], []
        for e in emissions[1:]:
            reach = score[:, None] + self.moves
            back.append(reach.argmax(axis=0))
            score = reach.max(axis=0) + e
        tag = int((score + self.moves[:, O]).argmax())
        tags = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            tags.append(tag)
        return tags[::-1]

    def _coded(self, pieces: list[str]) -> np.ndarray:
        codes = self.codes
        if len(codes) > CACHE_PIECES:
            codes.clear()
        for p in set(pieces).difference(codes):
            codes[p] = own_feature(p) * N_NEAR + near_feature(p)
        return np.fromiter(map(codes.__getitem__, pieces), np.int64, len(pieces))

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """Tagged secrets of whole texts, which are laid end to end."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        parts = [PIECE.findall(t) if t else [] for t in texts]
        full = [i for i, p in enumerate(parts) if p]
        if not full:
            return out
        sizes = np.array([len(parts[i]) for i in full])
        first = np.cumsum(sizes) - sizes
        own, near = np.divmod(self._coded([p for i in full for p in parts[i]]), N_NEAR)
        none = N_NEAR - 1
        before = np.concatenate([[none], near[:-1]])
        before[first] = none
        before2 = np.concatenate([[none], before[:-1]])
        before2[first] = none
        after = np.concatenate([near[1:], [none]])
        after[first + sizes - 1] = none
        at = [x + o for x, o in zip((own, before, before2, after, np.repeat([file_feature(texts[i]) for i in full], sizes)), OFFSETS, strict=True)]
        e = sum(self.weights[x] for x in at)
        loose = np.flatnonzero(((e[:, [O]] - e[:, :O]) <= self.lead).any(axis=1))
        if not len(loose):
            return out
        of = np.searchsorted(first, loose, side="right") - 1
        for doc in np.unique(of).tolist():
            i, places = full[doc], loose[of == doc]
            found = [m.span() for m in PIECE.finditer(texts[i])]
            for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                tags, start, last = self.decode(e[run]), None, 0
                for place, tag in zip([*(run - first[doc]).tolist(), 0], [*tags, O], strict=True):
                    if start is not None and tag != I:
                        out[i].append((found[start][0], found[last][1]))
                        start = None
                    if tag == B:
                        start = place
                    last = place
            out[i] = [(a, b) for a, b in out[i] if b - a >= LEAST_FOUND]
        return out


def _tagged(text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pieces and their tags by the labels."""
    found = [(m.start(), m.end()) for m in PIECE.finditer(text)]
    starts = np.array([a for a, _ in found])
    tags = np.full(len(found), O, dtype=np.int8)
    for a, b in secret_parts(text):
        inside = np.arange(*np.searchsorted(starts, [a, b]))
        fresh = inside[tags[inside] == O]
        tags[fresh] = I
        if len(fresh) and (fresh[0] == 0 or tags[fresh[0] - 1] == O):
            tags[fresh[0]] = B
    return found, tags


def _labelled(tags: np.ndarray) -> list[int]:
    return sorted({int(i) // WINDOW for i in np.flatnonzero(tags != O)})


def _windows(text: str, spread: int, only: list[int] | None = None) -> list[tuple[bytes, bytes]]:
    """(features, tags) of the windows with a label, or of only some; else of one window, chosen by spread."""
    found, tags = _tagged(text)
    if not found:
        return []
    pieces = [text[a:b] for a, b in found]
    rows = features(np.array([own_feature(p) for p in pieces]), np.array([near_feature(p) for p in pieces]), file_feature(text))
    windows = only or _labelled(tags) or [spread // PLAIN_EVERY % ((len(found) + WINDOW - 1) // WINDOW)] * (spread % PLAIN_EVERY == 0)
    return [(rows[w * WINDOW : (w + 1) * WINDOW].astype("<i4").tobytes(), tags[w * WINDOW : (w + 1) * WINDOW].tobytes()) for w in windows]


def training_windows(docs: DataFrame, labelled: int = SAMPLE_LABELLED, plain: int = SAMPLE_PLAIN) -> DataFrame:
    """The labelled windows of lowest hash among those of all documents, and a window of each of the documents of lowest hash without a label. Rows of the same id and text count once."""
    text_batches(docs.sparkSession)
    rows = docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("h"), "text")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(h, w) for h, t in zip(b.column("h").to_pylist(), b.column("text").to_pylist(), strict=True) for w in _labelled(_tagged(t)[1])]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32())], ["h", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [w for h, t, only in zip(*(b.column(c).to_pylist() for c in ("h", "text", "only")), strict=True) for w in _windows(t, h % 1_000_003 * PLAIN_EVERY, only)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.binary())], ["features", "tags"])

    hits = staged(rows.where(F.col("text").rlike(LIKELY)).mapInArrow(frugal(places), "h long, w int").distinct(), "secret-windows")
    some = hits.orderBy(F.xxhash64("h", "w"), "h", "w").limit(labelled).groupBy("h").agg(F.sort_array(F.collect_list("w")).alias("only"))
    others = rows.select("h").distinct().join(hits.select("h").distinct(), "h", "left_anti").orderBy("h").limit(plain)
    chosen = staged(some.unionByName(others.select("h", F.lit(None).cast("array<int>").alias("only"))), "secret-sample")
    return rows.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("h", "text", "only").mapInArrow(run, "features binary, tags binary")


def fit(docs: DataFrame, labelled: int = SAMPLE_LABELLED, plain: int = SAMPLE_PLAIN) -> ChainField | None:
    """A field fitted on the sample of docs(doc_id, text); None if no document holds a match of the fixed patterns."""
    rows = sorted((bytes(r.features), bytes(r.tags)) for r in training_windows(docs, labelled, plain).collect())  # labelled + plain at most, of WINDOW pieces each
    windows = [(np.frombuffer(f, "<i4").reshape(-1, 5), np.frombuffer(t, np.int8)) for f, t in rows]
    return fit_windows(windows)


def _reshaped(rows: np.ndarray, at: np.ndarray, to: str, near: bool = False) -> np.ndarray:
    """rows with the pieces at those places in another shape, of the same length; near: as their neighbours see them, too."""
    out, size = rows.copy(), len(LENGTHS) + 1
    out[at, 0] = SHAPES.index(to) * size + rows[at, 0] % size
    if near:
        for group, by in ((1, 1), (2, 2), (3, -1)):
            spot = np.flatnonzero(at) + by
            spot = spot[(spot >= 0) & (spot < len(rows))]
            seen = rows[spot, group] - OFFSETS[group]
            spot, seen = spot[(seen >= len(NAMED)) & (seen < N_NEAR - 1)], seen[(seen >= len(NAMED)) & (seen < N_NEAR - 1)]
            out[spot, group] = OFFSETS[group] + len(NAMED) + 3 * SHAPES.index(to) + (seen - len(NAMED)) % 3
    return out


def _masked(rows: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """rows with the named neighbours of what begins or is outside a secret replaced by a plain word's shape."""
    out = rows.copy()
    for group in (1, 2, 3):
        named = (out[:, group] - OFFSETS[group] < len(NAMED)) & (tags != I)
        out[named, group] = OFFSETS[group] + MASKED
    return out


def _renamed(rows: np.ndarray, tags: np.ndarray, turn: int) -> np.ndarray:
    """rows in which the words that name a secret give way to another of CUE_NAMES."""
    out, cue = rows.copy(), _NAMED[CUE_NAMES[turn % len(CUE_NAMES)]]
    for group in (1, 2, 3):
        at = out[:, group] - OFFSETS[group]
        out[(at < N_CUES) & (tags != I), group] = OFFSETS[group] + cue
    return out


def varied(features_: np.ndarray, tags: np.ndarray, turn: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A labelled window and variants of it: under other names, without a name, and with random strings of letters and digits of several lengths in place of hexadecimal ones.
    Capitals alone, which prose has too, are a secret only where a name says so."""
    hexes = (features_[:, 0] // (len(LENGTHS) + 1) == SHAPES.index("hex")) & (tags != O)
    mixed = _reshaped(features_, hexes, "mixed")
    shorter = mixed.copy()
    shorter[hexes, 0] -= 1 + turn % 3
    kinds = [features_, mixed, shorter]
    out = [(k, tags) for k in kinds] + [(_masked(k, tags), tags) for k in kinds] + [(_renamed(k, tags, turn + i), tags) for i, k in enumerate(kinds)]
    return [*out, (_renamed(_reshaped(features_, hexes, "upper"), tags, turn), tags)]


def contrary(features_: np.ndarray, tags: np.ndarray, turn: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A window without a label and, of each third one, a variant that is none either: its prose in capitals."""
    words = np.isin(features_[:, 0] // (len(LENGTHS) + 1), [SHAPES.index(x) for x in ("lower", "title", "letters")])
    return [(features_, tags)] + ([(_reshaped(features_, words, "upper", near=True), tags)] if turn % 3 == 0 else [])


def fit_windows(windows: list[tuple[np.ndarray, np.ndarray]]) -> ChainField | None:
    labelled = [w for w in windows if (w[1] != O).any()]
    if not labelled:
        return None
    plain = [w for w in windows if not (w[1] != O).any()]
    windows = [v for i, w in enumerate(plain) for v in contrary(*w, i)] + [v for i, w in enumerate(labelled) for v in varied(*w, i)]
    n = len(windows)
    x = np.zeros((n, WINDOW, 5), dtype=np.int64)
    y = np.full((n, WINDOW), O)
    there = np.zeros((n, WINDOW), dtype=bool)
    for i, (f, t) in enumerate(windows):
        x[i, : len(t)], y[i, : len(t)], there[i, : len(t)] = f, t, True
    w, moves = np.zeros((N_FEATURES, TAGS)), np.zeros((TAGS, TAGS))
    moves[O, I] = -4.0  # a secret begins with B
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, moves)]
    truth_w, truth_m = _truth(x, y, there)
    for step in range(1, STEPS + 1):
        mean_w, mean_m = _expected(x, there, w, moves)
        for p, grad, (m, v) in zip((w, moves), (mean_w - truth_w + PENALTY * n * w, mean_m - truth_m + PENALTY * n * moves), state, strict=True):
            m += 0.1 * (grad / n - m)
            v += 0.01 * ((grad / n) ** 2 - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ChainField(w, moves)


def _truth(x: np.ndarray, y: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    marks = np.eye(TAGS)[y] * there[..., None]
    w = np.stack([np.bincount(x.ravel(), np.repeat(marks[..., t].ravel(), 5), minlength=N_FEATURES) for t in range(TAGS)], axis=1)
    both = there[:, 1:] & there[:, :-1]
    return w, np.bincount((y[:, :-1] * TAGS + y[:, 1:])[both], minlength=TAGS * TAGS).reshape(TAGS, TAGS).astype(float)


def _expected(x: np.ndarray, there: np.ndarray, w: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected feature and move counts, by forward and backward passes over all windows at once."""
    e = sum(w[x[:, :, k]] for k in range(x.shape[2]))
    e = np.exp(e - e.max(axis=2, keepdims=True))
    e[~there] = 1.0
    t = np.exp(moves)
    n, size = there.shape
    fore, back = np.empty((n, size, TAGS)), np.ones((n, size, TAGS))
    fore[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, size):
        f = (fore[:, i - 1] @ t) * e[:, i]
        f /= f.sum(axis=1, keepdims=True)
        fore[:, i] = np.where(there[:, i, None], f, fore[:, i - 1])
    for i in range(size - 2, -1, -1):
        b = (back[:, i + 1] * e[:, i + 1]) @ t.T
        back[:, i] = np.where(there[:, i + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
    p = fore * back
    p = p / p.sum(axis=2, keepdims=True) * there[..., None]
    mean_w = np.stack([np.bincount(x.ravel(), np.repeat(p[..., k].ravel(), 5), minlength=N_FEATURES) for k in range(TAGS)], axis=1)
    pair = fore[:, :-1, :, None] * t * (e[:, 1:] * back[:, 1:])[:, :, None, :]
    pair = pair / pair.sum(axis=(2, 3), keepdims=True) * (there[:, 1:] & there[:, :-1])[..., None, None]
    return mean_w, pair.sum(axis=(0, 1))


def _reaches_beyond(start: int, end: int, base: list[tuple[str, int, int]]) -> bool:
    """Whether the base spans, by start, leave some of start to end uncovered."""
    for _, s, e in base:
        if s > start:
            break
        start = max(start, e)
    return start < end


def all_spans(texts: list[str | None], model: ChainField | None) -> list[list[tuple[str, int, int]]]:
    """Of each text the fixed patterns' spans and the field's that reach beyond them, by start and kind."""
    out = [base_spans(t) for t in texts]
    for i, tagged in enumerate(model.spans(texts) if model else []):
        if more := [("crf", a, b) for a, b in tagged if _reaches_beyond(a, b, out[i])]:
            out[i] = sorted(out[i] + more, key=lambda s: (s[1], KINDS.index(s[0])))
    return out


SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, model: ChainField | None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, spans (kind, start, end), for each row by itself.

    Null text is empty and has none. Whole texts are read, of any length. Repeated rows and null ids return as they came; other columns are left out.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in all_spans(b.column("text").to_pylist(), m)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got, _SPANS)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(run), f"doc_id long, spans {SPANS}")


def redacted_text(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, s, e in spans:
        if e > at:
            out += [text[at : max(at, s)], mark] if s >= at else []
            at = e
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, model: ChainField | None, mark: str = "[secret]") -> DataFrame:
    """docs with each span of text replaced by mark, overlapping ones as one, and n_chars, if there is such a column, made to fit.

    Texts without secrets, null ones too, and all other columns stay as they are.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            spans = all_spans(texts, m)
            new = [redacted_text(t, s, mark) if s else t for t, s in zip(texts, spans, strict=True)]
            cols = dict(zip(names, b.columns, strict=True)) | {"text": pa.array(new, pa.string())}
            if "n_chars" in cols:
                old = cols["n_chars"]
                cols["n_chars"] = pa.array([len(t) if s else n for t, s, n in zip(new, spans, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

    return docs.mapInArrow(frugal(run), docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, fit(docs))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), count("crf"))


ORACLE_SQL = None
