import hashlib
import random

from posttrend.llm import suffixes


def brute(rows):
    first = {}
    for doc, text in rows:
        body = (text or "").encode()
        if doc is not None:
            for i in range(len(body) - 49):
                g = body[i : i + 50]
                first[g] = min(first.get(g, doc), doc)
    out = {}
    for doc, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        if doc is not None:
            for i in range(len(body) - 49):
                if first[body[i : i + 50]] < doc:
                    gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, g in zip(body, gone) if not g)
        out.setdefault(doc, []).append((len(body), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return {d: sorted(v) for d, v in out.items()}


def corpus(seed):
    rng = random.Random(seed)
    alphabet = "ab é" if seed % 2 else "abcdefghij klmnopü"
    fresh = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [fresh(rng.choice([48, 49, 50, 51, 60, 200, 700])) for _ in range(12)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared)
            a = rng.randrange(max(1, len(p) // 3))
            parts += [p[a : len(p) - rng.randrange(3)], fresh(rng.choice([0, 1, 30, 90]))]
        rows.append((i * 3 % 71, "".join(parts)))
    return rows


def check(make, rows):
    got = {}
    for r in suffixes.remove_repeats(make(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert {d: sorted(v) for d, v in got.items()} == brute(rows)


def test_matches_brute_force(make, monkeypatch):
    check(make, corpus(1) + corpus(2)[:0])
    check(make, corpus(2))


def test_odd_rows(make):
    p = "".join(chr(97 + i * i % 23) for i in range(130))
    rows = [(5, p), (5, p), (4, "x" + p), (None, p), (6, None), (7, ""), (8, p[:49]), (9, p[:50]), (9, "zz" + p[3:60]), (1, "a" * 400), (2, "a" * 90 + "b")]
    check(make, rows)
    assert suffixes.remove_repeats(make([])).count() == 0


def places(text):
    return {(int(p - k.begin[j] + k.offset[j]), int(h)) for k in suffixes.packs([text]) for p, h, j in zip(k.places, k.hashes, k.piece)}


def test_long_text_in_segments(make, monkeypatch):
    texts = [t.encode() for _, t in corpus(4)[:30]]
    whole = [places(t) for t in texts]
    monkeypatch.setattr(suffixes, "SEGMENT", 70)
    assert [places(t) for t in texts] == whole and any(len(t) > 300 for t in texts)
