import random

import pytest

from posttrend.llm import minhash
from posttrend.llm.components import components


def shingles(text, n):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows, n, threshold):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, groups=12, size=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120, 300]))]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((number, rng.choice([" ", "\n", "\t "]).join(words)))
            number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_components_match_brute_force(make, by_id, block):
    rows = corpus(block) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "a b c d e"), (906, "a b c d e")]
    got = by_id(minhash.near_duplicates(make(rows), shingle=4, block=block))
    want = brute(rows, 4, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_odd_rows(make):
    text = "one two three four five six seven"
    rows = [(1, text, 0), (1, text, 0), (None, text, 0), (2, text, 1), (3, None, 2)]
    got = minhash.near_duplicates(make(rows, "doc_id long, text string, n long")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)
    ]
    assert minhash.near_duplicates(make([])).count() == 0


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: parent[x] for p in pairs if p[0] != p[1] for x in p}
