import re
from collections import Counter
from itertools import permutations

import numpy as np

from posttrend.llm import audit

DOCS = "doc_id long, text string, source string, part string, mask int"
LABELS = "doc_id long, quality int, toxic int"


def failing(docs):
    """The set of failed filters of each row."""
    out = []
    for doc_id, text, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, *_ in docs):
            fails.add("E")
        out.append(fails)
    return out


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = failing(docs)
    rows = {}
    for part in {d[2] or "" for d in docs}:
        here = [(f, d[0]) for f, d in zip(fails, docs) if (d[2] or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(here)
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[0]]
                left = [x for x in left if name not in x[0]]
                shapley[name] += len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), sum(name in f for f, _ in here) - len(gone), sum(f == {name} for f, _ in here),
                    sum(i in good for _, i in gone), sum(i in toxic for _, i in gone),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def _docs():
    long = lambda seed, n=260, extra="": " ".join(f"w{seed}x{i}" for i in range(n)) + extra
    texts = [
        None, "", "short", "SHOUT", "a # b", long(1), long(1), long(2, extra=" X" * 60), "z " * 400, "Z " * 400, long(3, extra=" 50%"),
        long(4, 199), long(4, 200), "É é " * 150, long(5) + "\n\t\x0b|", " \n ", long(6, 40_000),
    ]
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "x", 1) for i, t in enumerate(texts * 3)]
    rows += [(7, long(9), "s1", "x", 1)] * 3 + [(90, long(9), "s1", "x", 1), (None, long(9), "s1", "x", 1), (None, "only", "", None, None)]
    rows += [(200 + i, long(77), "hot", None, None) for i in range(150)]
    return rows


def test_counts_match_brute_force(make):
    docs = _docs()
    labels = [(i, (i % 3) - 1 if i % 7 else None, i % 2) for i in range(0, 260, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]
    cells = audit.filter_cells(make(docs, DOCS), make(labels, LABELS))
    got = {
        (r.part, r.filter_order, r.step): tuple(r[c] for c in audit.COUNTS) for r in audit.audit_orders(cells).collect()
    }
    want = brute(docs, labels)
    assert got.keys() == want.keys() and len(got) == 600 * len({d[2] or "" for d in docs})
    assert got == want


def test_steps_are_a_min_plus_product():
    every, position = audit.orders("ABC")
    steps = audit.removal_steps(3, position)
    for mask in range(8):
        for k, order in enumerate(every):
            found = [i + 1 for i, name in enumerate(order) if mask >> "ABC".index(name) & 1]
            assert steps[mask, k] == min(found, default=4)


def test_other_filters_and_many_parts(make):
    rng = np.random.default_rng(1)
    cells = [(f"p{p}", int(m), False, bool(m & 1), int(rng.integers(1, 9))) for p in range(150) for m in range(4)]
    got = audit.audit_orders(make(cells, "part string, mask int, good boolean, toxic boolean, n long"), "XY").collect()
    assert len(got) == 150 * 2 * 2
    by = {(p, m): n for p, m, _, _, n in cells}
    for r in got:
        x, y, both = by[r.part, 1], by[r.part, 2], by[r.part, 3]
        mine = x if r.filter_order[r.step - 1] == "X" else y
        assert r.unique_fails == mine and r.removed + r.redundant == mine + both
        assert r.shapley == 2 * mine + both


def test_empty_tables(make):
    labels = make([], LABELS)
    assert audit.audit_orders(audit.filter_cells(make([], DOCS), labels)).count() == 0
    rows = audit.audit_orders(audit.filter_cells(make([(1, "x", "a", "", 0)], DOCS), labels)).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)
