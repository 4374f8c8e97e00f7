import warnings

import numpy as np
import pytest

from posttrend.llm import mixing

SCHEMA = "doc_id long, text string, source string, lang string, copies string"


def rows(n=400):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        text = " ".join(["word"] * int(rng.integers(1, 300)))
        out.append((i, text + (" license" if i % 3 == 0 else " a | b" if i % 3 == 1 else ""), f"s{int(rng.integers(4) ** 2 // 3)}", "en" if i % 4 else "fr", "x"))
    return out


def brute(docs, fixed):
    cells = {}
    for d in docs:
        cells[d.source, d.lang, d.topic] = cells.get((d.source, d.lang, d.topic), 0) + d.n_tokens
    weight = dict.fromkeys(cells, 1.0)
    total = sum(cells.values())
    for _ in range(200):
        for k, name in enumerate(mixing.DIMENSIONS):
            now = {}
            for c in cells:
                now[c[k]] = now.get(c[k], 0) + cells[c] * weight[c]
            for c in cells:
                weight[c] *= fixed[name][c[k]] * total / now[c[k]]
    return weight


def test_weights_meet_targets(make):
    frame = make(rows(), SCHEMA)
    first = mixing.mixture(frame).collect()
    fixed = {d: {} for d in mixing.DIMENSIONS}
    for d in mixing.DIMENSIONS:
        values = sorted({r[d] for r in first})
        fixed[d] = {v: (i + 1) / sum(range(1, len(values) + 1)) for i, v in enumerate(values)}
    got = mixing.mixture(frame, fixed=fixed, budget=0.5).collect()
    want = brute(got, fixed)
    for r in got:
        assert r.expected == pytest.approx(0.5 * want[r.source, r.lang, r.topic], abs=1e-6)
        assert r.copies in (int(r.expected), int(r.expected) + 1) and r.kept == (r.copies > 0)
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.n_tokens * r.expected for r in got) == pytest.approx(0.5 * tokens, rel=1e-4)
    for d in mixing.DIMENSIONS:
        for v, share in fixed[d].items():
            assert sum(r.n_tokens * r.expected for r in got if r[d] == v) == pytest.approx(0.5 * tokens * share, rel=1e-5)
    assert sum(r.n_tokens * r.copies for r in got) == pytest.approx(0.5 * tokens, rel=0.15)


def test_odd_rows(make):
    data = [(1, "a b c", "s", "en", None), (1, "a b c", "s", "en", None), (2, None, None, None, "z"), (3, "", "s", "en", "z"), (None, "a", None, "en", "q")]
    frame = make(data, SCHEMA)
    got = mixing.mixture(frame, budget=1.0)
    assert got.count() == 5
    taken = {r.doc_id: r for r in got.collect()}
    assert taken[2].source == "?" and taken[2].copies == 0 and taken[3].copies == 0
    mixed = mixing.mix(frame, budget=2.0)
    assert mixed.columns == ["doc_id", "text", "source", "lang", "copies"]
    assert {r.doc_id for r in mixed.collect()} <= {1, None}
    assert mixing.mixture(make([], SCHEMA)).count() == 0 and mixing.mix(make([], SCHEMA)).count() == 0


def chain(n, hub=40):
    """Cells s0/a0, a0/s1, s1/a1, ...: what one margin takes moves along the chain cell by cell."""
    return [(i, " ".join(["w"] * (3 + i % 5)) + " a | b", f"s{(i + 1) // 2}", f"l{i // 2}", "x") for i in range(n) for _ in range(hub if i == 0 else 1)]


def test_slow_margins_are_met_or_said(make):
    frame = make(chain(4), SCHEMA)
    # Shares that some weights on these cells do have, far from the present ones: many rounds are needed.
    some = {(i + 1) // 2: 0 for i in range(4)}
    ideal = {i: (i % 3) + 1 for i in range(4)}
    source, lang = dict(some), {i // 2: 0 for i in range(4)}
    for i, w in ideal.items():
        source[(i + 1) // 2] += w / sum(ideal.values())
        lang[i // 2] += w / sum(ideal.values())
    fixed = {"source": {f"s{k}": v for k, v in source.items()}, "lang": {f"l{k}": v for k, v in lang.items()}}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert mixing.mixture(frame, fixed=fixed).count() == 43
    got = mixing.shares(frame, fixed=fixed).collect()
    assert len(got) == len(source) + len(lang) + 1 and all(abs(r.target - r.reached) < 1e-6 for r in got)
    with pytest.warns(UserWarning, match="missed"):
        assert mixing.mixture(frame, fixed=fixed, rounds=2).count() == 43

    # No weights on a single cell per source can have these: the miss is said, and listed.
    pairs = make([(1, "a b c", "s", "en", None), (2, "a b", "t", "fr", None)], SCHEMA)
    wrong = {"source": {"s": 0.5, "t": 0.5}, "lang": {"en": 0.9, "fr": 0.1}}
    with pytest.warns(UserWarning, match="missed by 0.4"):
        assert mixing.mixture(pairs, fixed=wrong).count() == 2
    assert {(r.value, round(r.reached, 6)) for r in mixing.shares(pairs, fixed=wrong).collect() if r.dimension == "source"} == {("s", 0.9), ("t", 0.1)}
    assert mixing.shares(make([], SCHEMA)).count() == 0


def test_sql_rests_with_the_weights(make, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, t, s, lang, c) for i, (_, t, s, lang, c) in enumerate(chain(3, 1))]
    got = {r.doc_id: (r.copies, r.expected) for r in mixing.mixture(make(rows, SCHEMA)).collect()}
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR, lang VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    found = db.execute(mixing.oracle()).fetch_df()
    assert len(found) == len(got)
    for r in found.itertuples():
        assert got[r.doc_id][0] == r.copies and got[r.doc_id][1] == pytest.approx(r.expected, abs=1e-6)
