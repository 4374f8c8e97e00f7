import hashlib
import random

from posttrend.llm import lines


def brute(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        body = (text or "").encode()
        parts, at, n = [], 0, 0
        for a, b, chunk in lines.chunks(body):
            if chunk in seen:
                parts.append(body[at:a])
                at, n = b, n + 1
            seen.add(chunk)
        out[doc] = (n, b"".join([*parts, body[at:]]))
    return out


def corpus():
    rng = random.Random(9)
    shared = [f"shared line {i} {'x' * (i % 7)}" for i in range(60)]
    rows = []
    for i in range(120):
        body = [f"own {i} {k}" for k in range(rng.randint(0, 6))]
        at = rng.randrange(50)
        body += shared[at : at + rng.randint(0, 12)] + [""] * rng.randint(0, 2) + [f"tail {i}"] * rng.randint(0, 3)
        rows.append((i, "\n".join(body)))
    return rows + [(500, rows[3][1]), (501, None), (502, ""), (503, "\n\n\n"), (504, "a\nb"), (505, "b\na\nb\n")]


def test_matches_brute_force(make):
    rows = corpus()
    got = lines.line_report(make(rows)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got} == {d: (n, hashlib.sha256(t).hexdigest()) for d, (n, t) in want.items()}
    assert sum(r.n_removed for r in got) > 50


def test_boundaries_follow_the_content():
    body = "\n".join(f"line {i}" for i in range(200))
    before = {c for _, _, c in lines.chunks(body.encode())}
    after = {c for _, _, c in lines.chunks(("new first line\n" + body).encode())}
    assert len(before & after) >= len(before) - 4


def test_pipeline_form(make):
    block = "\n".join(f"passage {i}" for i in range(30))
    rows = [(1, block, "k"), (2, "own words\n" + block, "k"), (3, block, None), (None, None, "k"), (4, "", "k"), (5, "x", "k"), (5, "x", "k")]
    frame = make(rows, "doc_id long, text string, key string")
    got = lines.dedup_lines(frame, drop_emptied=True)
    assert got.columns == frame.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == block and "own words" in texts[2] and len(texts[2]) < len(block) // 2
    assert len(texts.get(3, "")) <= len("passage 29")
    assert texts[None] is None and texts[4] == "" and got.where("doc_id = 5").count() == 2
    assert lines.dedup_lines(make([])).count() == 0 and lines.line_report(make([])).count() == 0


def test_short_passages_and_long_lines_go(make, by_id):
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[words(30) for _ in range(size)] for size in (2, 3, 4, 5) for _ in range(6)] + [[words(51)] for _ in range(6)]
    rows, want = [], {}
    for i, passage in enumerate(passages):
        for doc, lead in ((i, 1), (1000 + i, i % 4)):
            before, after = [words(5) for _ in range(lead)], [words(5) for _ in range(i % 3)]
            rows.append((doc, "\n".join([*before, "", *passage, *after])))
            want[doc] = "\n".join([*before, "", *passage, *after] if doc < 1000 else [*before, *after])
    rows.append((2000, words(3) + "\n" + words(50)))
    rows.append((2001, rows[-1][1].split("\n")[1]))
    got = by_id(lines.dedup_lines(make(rows)))
    assert {d: got[d].text.rstrip("\n") for d in want} == want
    assert (got[2000].text, got[2001].text) == (rows[-2][1], rows[-1][1])


def test_every_line_stands_somewhere(make):
    rows = corpus()
    left = {line for r in lines.dedup_lines(make(rows)).collect() for line in (r.text or "").split("\n")}
    assert {line for _, text in rows for line in (text or "").split("\n") if line.strip()} <= left
