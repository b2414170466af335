"""Sections of filings against a plain walk over small documents, with every sequence tried, and the named corners."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from factloom.operators import filing_sections as fs

BLOCKS = "doc_id long, ordinal int, text string, heading_level int, is_bold boolean, has_anchor boolean, internal_links int, link_chars int, total_chars int"


def block(text, level=None, bold=False, anchor=False, links=0, link_chars=0, chars=None):
    return (text, level, bold, anchor, links, link_chars, len(text or "") if chars is None else chars)


def every_sum(options, places):
    """best_sums by trying all increasing sequences."""
    best = [{o: None for b, o, _ in options if b == place} | {None: None} for place in range(places)]
    ordered = sorted(options)
    for size in range(min(places, len(ordered)) + 1):
        for chosen in itertools.combinations(ordered, size):
            if all(x[0] < y[0] and x[1] < y[1] for x, y in itertools.pairwise(chosen)):
                took, total = {b: o for b, o, _ in chosen}, sum(g for *_, g in chosen)
                for place in range(places):
                    o = took.get(place)
                    best[place][o] = total if best[place][o] is None else max(best[place][o], total)
    return best


def test_best_sums_against_all_sequences():
    rng = random.Random(3)
    for _ in range(300):
        places = rng.randint(1, 5)
        options = list({(rng.randrange(places), rng.randrange(8)): None for _ in range(rng.randint(0, 9))})
        options = [(b, o, rng.randint(1, 40)) for b, o in options]
        assert fs.best_sums(options, places) == every_sum(options, places)


def settle(options, places):
    out = {}
    for b, sums in enumerate(every_sum(options, places)):
        if any(o[0] == b for o in options):
            close = [o for o, s in sums.items() if max(sums.values()) - s <= 15]
            out[b] = (close[0] if len(close) == 1 else None, sorted(o for o in close if o is not None) if len(close) > 1 else None)
    return out


def plain(blocks, form):
    """One document, step by step; blocks as block() gives them. Returns {section: (start, end, confidence)} and [(section, code, role, reason, candidates)]."""
    family, marks = fs.FAMILIES[form], []
    order = fs.boundaries(family)
    for i, (text, level, bold, anchor, links, link_chars, chars) in enumerate(blocks):
        t = (text or "").strip()
        if not t:
            continue
        heavy, page = links >= 1 and chars > 0 and 2 * link_chars >= chars, bool(re.search(r"\s+\d+\s*$", t))
        points = 25 * (level is not None) + 15 * bold + 20 * anchor + 10 * ((chars or len(t)) <= 160) - 40 * heavy - 25 * (links >= 3) - 20 * page - 5 * ((heavy or page) and i * 10 < len(blocks))
        strong = not heavy and (level is not None or bold or anchor)
        if re.match(r"(?i)^\W*item\s+\d+[a-z]?\b", t):
            tokens = [x.lower() for x in re.findall(r"(?i)\bitem\s+(\d+[a-z]?)", t)]
            marks.append(["item", i, tokens, min(40 + points, 25) if len(tokens) > 1 else 40 + points, heavy, page, strong])
        if (m := re.match(r"(?i)^\W*part\s+([ivx]+)\b", t)) and m[1].upper() in ("I", "II", "III", "IV"):
            marks.append(["part", i, [m[1].upper()], 40 + points, heavy, page, strong])
        if re.match(r"(?i)^\s*signatures?\b", t):
            marks.append(["terminal", i, [], 50 + points, heavy, page, strong])
    heads = [i for i, b in enumerate(blocks) if re.search(r"(?i)table\s+of\s+contents", b[0] or "")]
    near = lambda i: any(abs(i - h) <= 15 for h in heads)
    items = [m for m in marks if m[0] == "item"]
    seeds = [m[1] for m in items if near(m[1]) or m[4]]
    listed = sorted(m[1] for m in items if any(abs(m[1] - s) <= 30 for s in seeds) and (m[4] or m[5] or (not m[6] and near(m[1]))))
    spans = []
    for i in listed:
        if spans and i - spans[-1][1] <= 30:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    spans = [(max([h for h in heads if lo - 15 <= h <= lo], default=lo), hi) for lo, hi in spans]
    contents = set(listed) | {m[1] for m in marks if m[0] != "item" and any(a <= m[1] <= b for a, b in spans)}
    for m in marks:
        m[3] -= 60 * (m[1] in contents)
    body_parts = [(int(m[2][0] == "II"), m[1], m[3] - 30) for m in marks if m[0] == "part" and m[1] not in contents and m[2][0] in ("I", "II") and m[3] > 30]
    candidates, unresolved = [], {}
    parts = settle(body_parts, 2)
    p1, p2 = (parts.get(b, (None, None))[0] for b in (0, 1))
    early = parts.get(1, (None, None))[1]
    highest, ended = -1, False
    for m in items:
        for token in m[2]:
            if family == "annual":
                part = next((p for p, i in order if i == token), 1)
            elif p2 is not None:
                part = 2 if m[1] >= p2 else 1 if p1 is not None and m[1] >= p1 else None
            elif p1 is not None:
                rank = fs.FIRST_PART_ORDER.index(token) if token in fs.FIRST_PART_ORDER else -2
                part = None
                if not ended and early and m[1] >= early[0]:
                    ended = True
                elif not ended and m[1] >= p1:
                    ended = rank < highest or rank == -2
                    part = None if ended else 1
                    highest = highest if ended else rank
            else:
                part = None
            if part is None:
                for p in (1, 2):
                    if (p, token) in order:
                        unresolved.setdefault(order.index((p, token)), set()).add(m[1])
            elif (part, token) in order:
                candidates.append((order.index((part, token)), m[1], m[3], m[1] in contents))
    body = [c for c in candidates if not c[3]]
    shared = {}
    for b, o, *_ in body:
        if len({x[0] for x in body if x[1] == o}) > 1:
            shared.setdefault(b, set()).add(o)
    settled = settle([(b, o, s - 30) for b, o, s, _ in body if s > 30 and b not in shared], len(order))
    start = {b: o for b, (o, _) in settled.items() if o is not None}
    ambiguous = {b: a for b, (_, a) in settled.items() if a is not None}
    last = max(start.values(), default=-1)
    closing = [m for m in marks if m[0] == "terminal" and m[1] not in contents and m[1] > last]
    closing = [m for m in closing if m[3] > 30] or closing
    closing.sort(key=lambda m: (-m[3], m[1]))
    issues, terminal, found = [], None, {}
    if len(closing) > 1 and closing[0][3] - closing[1][3] <= 15:
        issues.append((None, fs.UNRESOLVED, "terminal", None, [closing[0][1], closing[1][1]]))
    elif closing:
        terminal = closing[0][1]
    for (p, i), name in fs.PUBLISHED[family].items():
        b, key = order.index((p, i)), f"part_{p}.item_{i}.{name}"
        in_list = sorted({m[1] for m in items if m[1] in contents and i in m[2]})
        if b not in start:
            if b in shared:
                issues.append((key, fs.UNRESOLVED, "start", "same_ordinal_collapse", sorted(shared[b])))
            elif b in ambiguous:
                issues.append((key, fs.AMBIGUOUS, None, None, ambiguous[b]))
            elif b in unresolved:
                issues.append((key, fs.AMBIGUOUS, None, "part_context_unresolved", sorted(unresolved[b])))
            elif in_list and not any(c[0] == b for c in body):
                issues.append((key, fs.CONTENTS_ONLY, None, None, in_list))
            elif not form.endswith("/A"):
                issues.append((key, fs.NOT_FOUND, None, None, []))
            continue
        a = start[b]
        following = min((o for o in start.values() if o > a), default=None)
        close = terminal if terminal is not None and terminal > a else None
        limit = following if following is not None else close
        inside = lambda os: sorted(o for o in os if o > a and (limit is None or o < limit))  # noqa: B023, E731
        collapse = sorted(o for k, os in shared.items() if k > b for o in inside(os))
        unclear = [inside(os) for k, os in sorted(ambiguous.items()) if k > b and inside(os)]
        open_items = sorted(o for k, os in unresolved.items() if k > b for o in inside(os))
        end = min([x for x in (following, close) if x is not None], default=None)
        if collapse:
            issues.append((key, fs.UNRESOLVED, "end", "same_ordinal_collapse", collapse[:1]))
        elif unclear:
            issues.append((key, fs.UNRESOLVED, "end", None, unclear[0]))
        elif open_items:
            issues.append((key, fs.UNRESOLVED, "end", "part_context_unresolved", open_items[:1]))
        elif end is None:
            issues.append((key, fs.UNRESOLVED, "end", None, []))
        else:
            found[key] = (a, end, max(0, min(100, max(c[2] for c in body if c[0] == b and c[1] == a))))
    return found, sorted(issues, key=str)


def run(spark, documents):
    """documents: (form, blocks) -> per document what plain() returns."""
    rows = [(d, i, *b) for d, (_, blocks) in enumerate(documents) for i, b in enumerate(blocks)]
    out = fs.section_outcomes(spark.createDataFrame(rows, BLOCKS), spark.createDataFrame([(d, f) for d, (f, _) in enumerate(documents)], "doc_id long, form string")).collect()
    got = [({}, []) for _ in documents]
    for r in out:
        if r.code is None:
            assert r.section_key not in got[r.doc_id][0]
            got[r.doc_id][0][r.section_key] = (r.start, r.end, r.confidence)
        else:
            got[r.doc_id][1].append((r.section_key, r.code, r.role, r.reason, list(r.candidates)))
    return [(f, sorted(i, key=str)) for f, i in got]


def test_against_plain_walk(spark):
    rng = random.Random(11)
    texts = ["Item 1. Business", "Item 1A. Risk Factors", "ITEM 1B", "item 2. Properties", "Item 3", "Item 4. More 12", "Item 7. MDA", "Item 7A", "Item 8. Statements", "Item 7. A and Item 8. B", "Item 22", "PART I", "Part II", "(Part III)", "SIGNATURES", "Signature", "Table of Contents", "words", "", None]
    documents = []
    for _ in range(250):
        form = rng.choice(list(fs.FAMILIES))
        blocks = []
        for _ in range(rng.randint(0, 13)):
            links = rng.choice([0, 0, 0, 0, 1, 3])
            blocks.append(block(rng.choice(texts), rng.choice([None, None, 2]), rng.random() < 0.4, rng.random() < 0.3, links, rng.choice([0, 12]) if links else 0, rng.choice([None, 200, 0])))
            if rng.random() < 0.15:
                blocks += [block("words")] * 31
        documents.append((form, blocks))
    got = run(spark, documents)
    for (form, blocks), g in zip(documents, got, strict=True):
        assert g == plain(blocks, form), (form, blocks)
    codes = {c for _, issues in got for _, c, *_ in issues}
    assert codes == {fs.NOT_FOUND, fs.AMBIGUOUS, fs.CONTENTS_ONLY, fs.UNRESOLVED} and sum(len(f) for f, _ in got) > 20
    assert {r for _, issues in got for _, _, _, r, _ in issues} == {None, "same_ordinal_collapse", "part_context_unresolved"}


@pytest.fixture(scope="module")
def corners(spark):
    body, far = block("words", chars=200), [block("words", chars=200)] * 40
    item = lambda t, **k: block(t, **({"level": 2} | k))
    documents = {
        "score 45": ("10-K", [body, item("Item 1. Business", level=None, bold=False, chars=200, anchor=False)[:1] + (None, False, False, 0, 0, 0), body]),
        "lone 50": ("10-K", [body, block("Item 1. Business"), body, item("SIGNATURES")]),
        "lone 55": ("10-K", [body, block("Item 1. Business", bold=True, chars=200), body, item("SIGNATURES")]),
        "contents before body": ("10-K", [block("Table of Contents"), block("Item 1. Business 3"), block("Item 1A. Risk 9"), block("Item 7. MDA 20"), *far, item("Item 1. Business"), body, item("Item 1A. Risk"), body, item("Item 7. MDA"), body, item("SIGNATURES"), body]),
        "two items in one block": ("10-K", [item("Item 1. Business"), body, item("Item 7. MDA and Item 8. Statements"), body, item("SIGNATURES")]),
        "amendment": ("10-K/A", [item("Item 8. Statements"), body, item("SIGNATURES")]),
        "quarterly reset": ("10-Q", [item("PART I"), item("Item 1. Statements"), body, item("Item 2. MDA"), body, item("Item 1. Legal"), body, item("SIGNATURES")]),
        "quarterly parts": ("10-Q", [item("PART I"), item("Item 1. Statements"), body, item("Item 2. MDA"), body, item("PART II"), item("Item 1. Legal"), body, item("SIGNATURES")]),
        "no closing": ("10-K", [item("Item 1. Business"), body]),
        "contents only": ("10-K", [block("Table of Contents"), block("Item 1. Business 3"), block("Item 1A. Risk 4"), *far, item("Item 7. MDA"), body, item("SIGNATURES")]),
        "other form": ("8-K", [item("Item 1. Business"), body]),
    }
    rows = [(d, i, *b) for d, (_, blocks) in enumerate(documents.values()) for i, b in enumerate(blocks)]
    forms = spark.createDataFrame([(d, f) for d, (f, _) in enumerate(documents.values())], "doc_id long, form string")
    out = fs.section_outcomes(spark.createDataFrame(rows, BLOCKS), forms)
    names = list(documents)
    found, issues = {n: {} for n in names}, {n: {} for n in names}
    for r in fs.filing_sections(out).collect():
        found[names[r.doc_id]][r.section_key.split(".", 1)[1]] = (r.start, r.end)
    for r in fs.section_issues(out).collect():
        issues[names[r.doc_id]][r.section_key.split(".", 1)[1] if r.section_key else None] = (r.code, r.reason, r.incomplete)
    return found, issues


def test_corners(corners):
    found, issues = corners
    business, risk, mda = "item_1.business", "item_1a.risk_factors", "item_7.mda"
    assert not found["lone 50"].get(mda) and found["lone 50"][business] == (1, 3) and found["lone 55"][business] == (1, 3)
    assert found["contents before body"] == {business: (44, 46), risk: (46, 48), mda: (48, 50)}
    assert issues["two items in one block"][mda] == (fs.UNRESOLVED, "same_ordinal_collapse", True) and issues["two items in one block"][business][0] == fs.UNRESOLVED or found["two items in one block"][business] == (0, 4)
    assert found["amendment"] == {"item_8.financial_statements": (0, 2)} and not issues["amendment"]
    assert found["quarterly reset"] == {"item_1.financial_statements": (1, 3)} and issues["quarterly reset"]["item_2.mda"] == (fs.UNRESOLVED, "part_context_unresolved", True)
    assert issues["quarterly reset"]["item_1.legal_proceedings"] == (fs.AMBIGUOUS, "part_context_unresolved", True)
    assert found["quarterly parts"] == {"item_1.financial_statements": (1, 3), "item_2.mda": (3, 6), "item_1.legal_proceedings": (6, 8)} or found["quarterly parts"]["item_2.mda"] == (3, 6)
    assert issues["no closing"][business] == (fs.UNRESOLVED, None, True)
    assert issues["contents only"][business] == (fs.CONTENTS_ONLY, None, True) and issues["contents only"]["item_1b.unresolved_staff_comments"] == (fs.NOT_FOUND, None, False)
    assert not found["other form"] and not issues["other form"]


def test_gap_of_a_lone_candidate(spark):
    """A lone candidate over the baseline by 15 is ambiguous, as going without is within the gap; by 16 it is chosen."""
    options = spark.createDataFrame([(1, 0, 5, 15), (2, 0, 5, 16)], "doc_id long, boundary int, ordinal int, gain int")
    got = {r.doc_id: (r.ordinal, r.ambiguous, r.alternatives) for r in fs.sequence_choice(options, 3).collect()}
    assert got == {1: (None, True, [5]), 2: (5, False, [])}
    assert fs.sequence_choice(options.limit(0), 3).count() == 0


def test_no_blocks(spark):
    assert fs.section_outcomes(spark.createDataFrame([], BLOCKS), spark.createDataFrame([(1, "10-K/A")], "doc_id long, form string")).count() == 0
