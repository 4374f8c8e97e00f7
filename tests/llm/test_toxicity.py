import random
import zlib
from itertools import combinations

import numpy as np

from posttrend.llm import string_kernel as sk
from posttrend.llm import toxicity

LABELS = "doc_id long, toxic int"


def brute_kernel(a, b):
    """Normalised kernel of two strings, by listing all their triples."""

    def listed(s):
        out = {}
        for i, j, k in combinations(range(len(s)), 3):
            if k - i <= sk.SPAN:
                key = s[i] + s[j] + s[k]
                out[key] = out.get(key, 0) + sk.DECAY ** (k - i - 2)
        return out

    x, y = listed(a), listed(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / max(1e-12, (dot(x, x) * dot(y, y)) ** 0.5)


WORDS = ["^idiot", "^aaaaaa", "^abcabcabc", "^xyidxiotq", "^banana", "^los", "^loser", "^abababababababa"]


def test_kernel_matches_brute_force():
    kernel = sk.Kernel(WORDS)
    got = kernel.to_landmarks([*WORDS, "^anidea"])
    want = [[brute_kernel(a, b) for b in WORDS] for a in [*WORDS, "^anidea"]]
    assert np.allclose(got, want)
    # Nyström features of the landmarks give their kernel back.
    x = kernel.map(WORDS)
    assert np.allclose(x @ x.T, want[:-1], atol=1e-5)


def test_search_finds_the_best_of_all_strings():
    rng = np.random.default_rng(3)
    kernel = sk.Kernel(WORDS)
    v = rng.normal(size=kernel.turn.shape[1])
    weights = np.zeros(sk.CODES)
    weights[kernel.codes] = kernel.per_triple(v)
    letters = random.Random(4)
    texts = [" ".join("".join(letters.choices("abcdinotxyloser", k=letters.randint(1, 40))) for _ in range(30)).encode() for _ in range(40)]
    texts += [b"", b"!!", b"aaaaaa aaaaaa", "é ü 𝔘𝔘𝔘 idiot".encode(), b"i d i o t"]
    strings = sk.strings_of(texts)
    spelled = strings.spelled()
    values = kernel.map(spelled) @ v
    found = sk.search(strings, weights, [0.1, 0.3], len(texts))
    for t in range(len(texts)):
        mine = values[strings.text == t]
        assert np.isclose(found.best[t], max(0, mine.max(initial=0)), atol=1e-5)
        assert abs(found.reaching[t, 0] - (mine >= 0.1).sum()) == 0 and found.strings[t] == len(mine)
        if found.who[t] >= 0:
            assert np.isclose(values[found.who[t]], found.best[t], atol=1e-5)


def test_strings_of_texts():
    strings = sk.strings_of([b"Ab, c-d x y z\n", b"", b"q", b"w" * 40, b"!?"])
    spelled = strings.spelled()
    assert [w for w, t in zip(spelled, strings.text) if t == 0] == ["^ab", "^cd", "^xyz"]
    assert [w for w, t in zip(spelled, strings.text) if t == 2] == ["^q"]
    # Windows overlap by more than a triple spans.
    long = [(b, n) for b, n, t in zip(strings.begin, strings.size, strings.text) if t == 3]
    assert long[0][1] == sk.WIDTH and all(b + n - c >= sk.SPAN for (b, n), (c, _) in zip(long, long[1:]))
    assert long[-1][0] + long[-1][1] - long[0][0] == 41


def _corpus(n, seed=0):
    """Texts of invented words; those of label 1 have an insult, some of them only one with an insertion."""
    draw = random.Random(seed)
    parts = ["ba", "ke", "lo", "mi", "nu", "ra", "ti", "so", "ve", "di", "po", "shu"]
    word = lambda: "".join(draw.choices(parts, k=draw.randint(1, 4)))
    insults = ["grumblefig", "snotwick", "dolt"]
    rows = []
    for i in range(n):
        words = [word() for _ in range(draw.randint(20, 120))]
        toxic = int(draw.random() < 0.25)
        if toxic:
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(len(words))] = draw.choice(insults)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy_and_gaps(make):
    rows = _corpus(1500)
    docs = make([r[:2] for r in rows])
    labels = make([(i, y) for i, _, y in rows], LABELS)
    got = {r.doc_id: r for r in toxicity.judged(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, *_ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.7)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    # What is held out does not reach the model: other labels there change no score.
    other = make([(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows], LABELS)
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    again = toxicity.train(docs, other.where(~toxicity.held_out()))
    assert np.allclose(model.values, again.values) and np.allclose(model.slopes, again.slopes)
    # Insults with inserted characters, marks or gaps are still told from plain words.
    calm = " ".join(["bakelo", "miso", "tira", "nuke", "pove"] * 6)
    odd = ["grumble-fig", "g r u m b l e f i g", "grumxblefig", "snotwickk", "s.n.o.t.w.i.c.k", "snotxwick"]
    tried = [(k, f"{calm} {w} {calm}") for k, w in enumerate([*odd, "bakera"])]
    scores = {r.doc_id: r.score for r in toxicity.score(make(tried), model).collect()}
    assert min(scores[k] for k in range(len(odd))) > 0.5 > scores[len(odd)]


def test_odd_rows_and_missing_labels(make):
    rows = [(1, None), (1, None), (None, "x y"), (2, ""), (3, "?!"), (4, "ab " * 30_000), (5, "z" * 50_000)]
    docs = make([(*r, "a", 0.5) for r in rows], "doc_id long, text string, string string, score double")
    none = toxicity.judged(docs, make([], LABELS)).collect()
    assert len(none) == len(rows) and {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert {r.held_out for r in none if r.doc_id is None} == {False}
    only = make([(4, 1), (5, 1), (None, 0), (2, None)], LABELS)
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, only)).collect()} == {1.0}
    few = make([(4, 1), (4, 0), (5, 0), (2, 0), (3, 0), (1, 0)], LABELS)
    scores = {r.doc_id: r.score for r in toxicity.judged(docs, few).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[2] == scores[3] == scores[1]
    assert toxicity.judged(make([]), make([], LABELS)).count() == 0


def test_plan_of_scoring(make, plan):
    rows = _corpus(60)
    docs = make([r[:2] for r in rows])
    model = toxicity.train(docs, make([(i, y) for i, _, y in rows], LABELS))
    assert "Exchange" not in plan(toxicity.score(docs, model))
