"""Token alignment, license notices and vector codes on odd rows (nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names), and against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from factloom.llm import license_notices, token_alignment, vector_codes
from factloom.llm.exact_topk import whole_numbers

DOCS = "doc_id long, text string, row string"
PATHS = public_tokenizers.path(token_alignment.TOKENIZER_A), public_tokenizers.path(token_alignment.TOKENIZER_B)
rng = random.Random(9)


def odd_texts(n: int) -> list[str]:
    pieces = [*"abcdeT'sll    \n\t.,;123żółć漢字é😀", *map(chr, (0x3000, 0xA0, 0x2581, 0x0B, 0x1C, 0x85, 0x200B, 0x301, 0xFB01)), "the ", " license", "<|endoftext|>", "<s>", "<0x41>", "don't", "word.\nNext ", "Straße.\nélan, ", "l'eau* ", "$$$ "]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 50))) for _ in range(n)]


TEXTS = [*odd_texts(400), None, "", " ", "a", "the cat sat. " * 3000, "x" * 3000, "aaaa bbbb" * 900, "the cat sat.", "the cat sat."]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i % 50 else None, t, "x") for i, t in enumerate(TEXTS)], DOCS)


@pytest.mark.parametrize("most_pairs", [token_alignment.MOST_PAIRS, 40])
def test_alignment_against_plain_walk(docs, most_pairs):
    """40: most pairs are joined by a shuffle."""
    got = Counter(map(tuple, token_alignment.align_tokens(docs, *PATHS, most_pairs=most_pairs).collect()))
    plain = token_alignment.plain_alignment(TEXTS, *PATHS)
    want = Counter((i if i % 50 else None, *p) for i, p in enumerate(plain))
    assert got == want
    assert sum(p[0] > 0 for p in plain) > 150 and sum(p[0] == 0 for p in plain) > 50


def test_alignment_of_no_rows(docs):
    assert token_alignment.align_tokens(docs.limit(0), *PATHS).count() == 0


def test_windows_are_remembered():
    a, b = token_alignment.BytePairs(PATHS[0]), token_alignment.Pieces(PATHS[1])
    aligner, coder = token_alignment.Aligner(a, b), token_alignment.Whole(a, b)
    ids = coder.encode(["one two three", "three two one"])
    aligner.align(ids)
    assert len(aligner.known) == 3  # a window a word
    solve, asked = aligner.solve, []
    aligner.solve = lambda keys: asked.extend(keys) or solve(keys)
    aligner.align(coder.encode(["two three one"]))
    assert not asked


def test_chunks_spell_whole_texts():
    a, b = token_alignment.BytePairs(PATHS[0]), token_alignment.Pieces(PATHS[1])
    coder, texts = token_alignment.Whole(a, b), odd_texts(1500)
    for t, got in zip(texts, coder.encode(texts), strict=True):
        x, y = a.encode([t])[0], b.encode([t])[0]
        spelled = all(b"".join(v.bytes[i] for i in ids) == b" " + t.encode() for v, ids in ((a, x), (b, y)))
        assert got == ((np.array(x, "<u4").tobytes(), np.array(y, "<u4").tobytes()) if spelled else None), t


def edits(pattern: str, text: str) -> int:
    """Least edits between the pattern and any run of whole words of the text."""
    row = [0]
    for d in text:
        row.append(0 if d == " " else row[-1] + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row[j] for j in range(len(text) + 1) if j == len(text) or text[j] == " ")


@pytest.mark.parametrize("characters_an_error", [10, license_notices.CHARACTERS_AN_ERROR])
def test_notices_against_edit_distance(characters_an_error):
    """No occurrence within the bound is lost by the exact parts, and none beyond it is found."""
    notices = license_notices.notices_of(license_notices.NOTICES, characters_an_error)
    finder, fill = license_notices.Finder(notices, license_notices.PHRASES), "the a of code this file use it under any".split()
    for _ in range(300):
        notice = rng.choice(notices)
        text = list(notice.text)
        for _ in range(rng.randint(0, notice.errors + 2)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "b", " ", "e"])
        text = " ".join([*rng.choices(fill, k=rng.randint(0, 5)), *"".join(text).split(), *rng.choices(fill, k=rng.randint(0, 5))])
        found = finder.matches(text)
        assert {notices[i].label for i, *_ in found} == {n.label for n in notices if edits(n.text, text) <= n.errors}, text
        assert all(edits(notices[i].text, text[a:b]) == e for i, a, b, e in found)


def test_license_rows(spark):
    texts = [
        "Released under the MIT License.", "released under the MIT-Licence; MIT license, mit license", None, "", " \n", "Licenced under the\nApache License, Version 2.0.",
        "Lizenz: żółć " + "wort " * 60_000 + "GNU General Public License", "a limit license", "mit licenseé", "Permission is herby granted, free of charge, to any person obtaining a copy",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "y"), (None, texts[0], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = license_notices.scan_licenses(df).collect()
    by = {r.doc_id: r for r in got if r.doc_id}
    assert len(got) == len(rows) and sum(r.base_labels == "mit" for r in got) == 4
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].last_word, by[1].labels, by[1].score) == (9, 2, 5, 7, "mit", 1.0)
    assert [(texts[1][s.start : s.end], s.errors) for s in by[1].spans] == [("released under the MIT-Licence", 1), ("MIT license", 0), ("mit license", 0)]
    assert (by[2].n_words, by[2].n_base, by[2].first_word, by[2].labels, by[2].score) == (0, 0, None, "", 0.0) and by[3].n_words == by[4].n_words == 0
    assert by[5].labels == by[5].base_labels == "apache" and by[5].spans[0].errors == 1
    assert by[6].first_word == by[6].last_word == 60_003 and by[6].base_labels == "gpl"
    assert not by[7].labels and not by[8].base_labels and by[9].labels == "mit" and not by[9].base_labels and 0.9 < by[9].score < 1
    assert license_notices.scan_licenses(df.limit(0)).count() == 0


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """The contract in Python's whole numbers."""
    size = len(rows[0][1]) // parts
    books = [[list(v[p * size : (p + 1) * size]) for _, v, _ in rows[:entries]] for p in range(parts)]
    gap = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))

    def near():
        return [[min((gap(v[p * size : (p + 1) * size], c), e) for e, c in enumerate(books[p])) for p in range(parts)] for _, v, _ in rows]

    for _ in range(rounds):
        got = near()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * size : (p + 1) * size] for (_, v, _), g in zip(rows, got, strict=True) if g[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    return [(i, "".join(f"{e:02x}" for _, e in g), sum(d for d, _ in g)) for (i, _, _), g in zip(rows, near(), strict=True)]


@pytest.mark.parametrize("huge", [False, True])
def test_codes_against_plain_rounds(spark, huge):
    r = np.random.RandomState(4)
    x = np.concatenate([r.randint(-40, 40, (120, 16)), np.repeat(r.randint(-40, 40, (1, 16)), 60, axis=0), r.randint(-2, 3, (60, 16))]).astype(float)
    if huge:
        x[5] *= 2.0**24
    rows = [(i, v.tolist(), i % 3 or None) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (None, x[3].tolist(), 1), (7, [1.0] * 16, 2), (2000, [1.0] * 8, 2), (2001, [], 2)]
    df = spark.createDataFrame(rows + odd, "vec_id long, v array<double>, label int").withColumn("code", F.lit("x")).repartition(3)
    got = vector_codes.compress_vectors(df, block_rows=50).collect()
    kept = sorted([*rows, odd[1], odd[2]], key=lambda t: (t[0] is None, t[0] or 0, t[1]))
    want = plain_codes([(i, [int(c) for c in v], k) for i, v, k in kept])
    assert Counter((t.vec_id, t.code, t.error) for t in got) == Counter(want)
    sums = Counter()
    for (_, _, e), (_, _, k) in zip(want, kept, strict=True):
        sums[k] += e
    labels = {i: k for i, _, k in rows if i != 7}
    assert all(t.label_error == sums[labels[t.vec_id]] for t in got if t.vec_id in labels)
    assert len({t.codebooks_sha256 for t in got}) == 1


def test_codes_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    bad = spark.createDataFrame([(1, None, 1), (2, [1.0, None] * 4, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] * 8, None)], kind).select("vec_id", whole_numbers(scale=4096.0).alias("v"), "label")
    assert vector_codes.compress_vectors(bad).count() == 0
    few = spark.createDataFrame([(1, [3.0] * 8, 1), (2, [5.0] * 8, None)], "vec_id long, v array<double>, label int")
    assert sorted((r.vec_id, r.code, r.error) for r in vector_codes.compress_vectors(few).collect()) == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    assert vector_codes.compress_vectors(few.where("vec_id > 2")).count() == 0
    assert vector_codes.compress_vectors(spark.createDataFrame([(1, [3.0] * 7, 1)], "vec_id long, v array<double>, label int")).count() == 0


def test_cover_tree():
    """Nesting, covering, separation; whole subtrees are assigned and few points are compared where clusters lie apart."""
    r = np.random.RandomState(1)
    points = (r.randint(0, 8, (600, 1)) * 1000 + r.randint(0, 20, (600, 4))).astype(float)
    order, nodes = vector_codes.cover_tree(points)
    assert sorted(order.tolist()) == list(range(600))
    p = points[order]
    for low, high, radius, first, children in nodes.tolist():
        own = p[int(low)]
        assert np.isclose(np.sqrt(((p[int(low) : int(high)] - own) ** 2).sum(axis=1)).max(), radius)
        if children:
            below = nodes[int(first) : int(first + children)]
            assert below[0][0] == low and below[-1][1] == high and (below[1:, 0] == below[:-1, 1]).all() and (below[:, 2] <= radius / 2).all()
            centres = p[below[:, 0].astype(int)]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2)) + np.eye(len(centres)) * 1e9
            assert gaps.min() > radius / 2
    tree = vector_codes.PartTree(p, nodes)
    entries = np.array([[i * 1000 + 10] * 4 for i in range(8)])
    codes, sums, counts = tree.assign(entries)
    assert (codes == vector_codes.distances(p.astype(np.int64), entries).argmin(axis=1)).all()
    assert (sums == np.array([p[codes == e].sum(axis=0) for e in range(8)])).all() and (counts == np.bincount(codes, minlength=8)).all()
    assert tree.compared == 0 and tree.decided < 60
