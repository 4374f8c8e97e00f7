import random
import re

import pytest

from posttrend.llm import decontaminate

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(window, len(b))
            runs = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out[d] = (len(w), sorted(hit), sorted(found))
    return out


def tables(seed):
    rng = random.Random(seed)
    letters = "abcdé"
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 5, 8, 30])))) for i in range(12)]
    items = [(i, t) for i, t in items if len(words(t)) != 1 or rng.random() < 0.1] + [(90, None), (91, ""), (92, items[-1][1])]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(letters + "xX") for _ in range(rng.choice([0, 4, 60, 200])))) for i in range(30)]
    docs += [(100 + i, f"Start. {t.upper()} end") for i, t in items if t] + [(200, None), (201, "")]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 10**6), (2, 20), (3, 10**6)])
def test_matches_brute_force(make, seed, block):
    docs, items = tables(seed)
    got = decontaminate.find_leaks(make(docs), make(items, ITEMS), window=5, block_words=block).collect()
    want = brute(docs, items, 5)
    import hashlib

    for r in got:
        n, hit, found = want[r.doc_id]
        assert r.n_words == n and [p for s in r.spans for p in range(s.begin, s.end)] == hit, r.doc_id
        assert (r.n_hit, r.n_items, r.contaminated) == (len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert len(got) == len(docs)


def test_removal(make):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [
        (1, f"A b c d e f g h i j k l m. {item.upper()}! and so on it goes", "x"), (2, item, "x"), (3, "clean  Text\n", None), (4, None, None),
        (5, "", "y"), (5, "", "y"),
    ]
    frame = make(docs, "doc_id long, text string, spans string")
    got = sorted(((r.doc_id, r.text, r.spans) for r in decontaminate.remove_leaks(frame, make([(1, item)], ITEMS)).collect()), key=repr)
    assert got == [
        (1, "A b c d e f g h i j k l m.! and so on it goes", "x"), (3, "clean  Text\n", None), (4, None, None), (5, "", "y"), (5, "", "y"),
    ]
    assert decontaminate.remove_leaks(frame, make([], ITEMS)).count() == 6
    assert decontaminate.find_leaks(make([]), make([], ITEMS)).count() == 0


def test_an_item_without_id_hits_but_is_not_named(make):
    row = decontaminate.find_leaks(make([(1, "x one two three y")]), make([(None, "one two three")], ITEMS)).first()
    assert (row.n_hit, row.n_items, row.contaminated) == (3, 0, True)
