import hashlib
import re

from posttrend.llm import infill


def brute(doc_id, text, cut=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one\n", "a\nb\nc", "a\r\nb c\x0bd\n", "é𝔘\nü\n\nß", "has <P> in it\nx", "<M>", "<S\n>",
    "x" * 300_000, "y\n" * 100_000, "".join(f"line {i}\n" for i in range(3000)) + "end", "\x00\n\x00",
]


def test_against_brute_force(make):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)] + [(None, "a\nb"), (3, "dup\nx"), (3, "dup\nx"), (-5, "q\nr\ns")]
    rows += [(1000 + i, "".join(f"{j} {i}\n" for j in range(i % 13))) for i in range(200)]
    got = infill.fill_in_middle(make(rows)).collect()
    want = [(d, *brute(d, t)) for d, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_round_trip_and_digests(make):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    hashed = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in infill.digests(make(rows)).collect():
        assert r.restored_sha256 == hashed(rows[r.doc_id][1] or "")
        assert r.output_sha256 == hashed(brute(*rows[r.doc_id])[-1])


def test_shares_marks_and_other_columns(make):
    rows = [(i, f"a{i}\nb\n", "x", "y") for i in range(300)]
    docs = make(rows, "key long, body string, h string, output string")
    draw = infill.Draw(cut_percent=30, spm_percent=0)
    marks = infill.Sentinels("{p}", "{s}", "{m}")
    got = infill.fill_in_middle(docs, id_col="key", text="body", draw=draw, marks=marks).collect()
    assert {r.form for r in got} == {"plain", "psm"}
    for r in got:
        assert r.form == brute(r.key, f"a{r.key}\nb\n", 30, 0)[1]
        assert r.form == "plain" or r.output.startswith("{p}")


def test_empty_table_and_plan(make, plan):
    assert infill.digests(make([])).count() == 0
    text = plan(infill.digests(make([(1, "a\nb")])))
    assert "Exchange" not in text


def test_slices_keep_every_row(make, monkeypatch):
    monkeypatch.setattr(infill, "SLICE", 10)
    import numpy as np
    import pyarrow as pa

    batch = pa.record_batch({"text": ["a" * k for k in (0, 3, 12, 0, 9, 2, 50)]})
    parts = list(infill._slices(batch))
    assert np.concatenate([p.column("text").to_numpy(zero_copy_only=False) for p in parts]).tolist() == batch.column("text").to_pylist()
