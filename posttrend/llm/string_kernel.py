"""Strings cut from texts, their gap-weighted subsequences of three symbols, and a support vector machine on them.

The kernel of two strings sums, over all triples of symbols that stand in both in order, within ``SPAN`` places, the
product of their weights; a triple that leaves out ``k`` places weighs ``DECAY ** k``.  An inserted character costs a
factor, not the match.  Kernels are normalised.  A linear function of kernels to fixed landmarks is one number per
triple, so texts are scored without computing any kernel to a landmark.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np

SPAN = 5
DECAY = 0.8
WIDTH, STEP = 16, 8
CODES = 1 << 18
GAPS = [(a, b, DECAY ** (b - 2)) for a, b in combinations(range(1, SPAN + 1), 2)]
# Symbols 1 to 26 are letters, 27 to 36 digits, other letters share the 26 after them, and a string's first one is
# START; 0 is left out, BREAK parts strings.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ^"
START, BREAK = 63, 255


_LETTERS = np.frombuffer(f" {SYMBOLS}".encode("ascii"), np.uint8)


def _symbol_table() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        letter = chr(point)
        if letter.isspace():
            table[point] = BREAK
        elif letter.isalnum():
            lower = letter.lower()[0]
            table[point] = SYMBOLS.index(lower) + 1 if lower in SYMBOLS[:36] else 37 + ord(lower) % 26
    return table


_TABLE = _symbol_table()


class Strings(NamedTuple):
    """Symbols of all strings one after the other, where each begins, how long it is, and the text it is from."""

    symbols: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    text: np.ndarray

    def spelled(self) -> list[str]:
        """All strings in ``SYMBOLS``."""
        if not len(self.size):
            return []
        first = np.cumsum(self.size) - self.size
        at = np.repeat(self.begin - first, self.size) + np.arange(int(self.size.sum()))
        letters = np.insert(_LETTERS[self.symbols[at]], first[1:], ord("\n"))
        return letters.tobytes().decode("ascii").split("\n")


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    decoded = [t.decode("utf-8", "replace") for t in texts]
    sizes = np.fromiter((len(t) + 1 for t in decoded), np.int64, len(decoded))
    points = np.frombuffer(" ".join([*decoded, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = np.where(points < 1 << 16, _TABLE[np.minimum(points, 0xFFFF)], (37 + points % 26).astype(np.uint8))
    return symbols, np.repeat(np.arange(len(texts)), sizes)


def strings_of(texts: list[bytes]) -> Strings:
    """What stands between white space, without marks; single characters in a row are one string, and long strings
    are cut into windows of ``WIDTH`` that overlap by more than a triple can span."""
    symbols, text = _symbols(texts)
    there = symbols != 0
    symbols, text = symbols[there], text[there]
    inside = symbols != BREAK
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    size, owner = end - begin, text[begin]
    symbols = symbols[inside]
    begin = np.cumsum(size) - size
    single = size == 1
    joins = np.zeros(len(size), bool)
    joins[1:] = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
    begin, owner = begin[~joins], owner[~joins]
    symbols = np.insert(symbols, begin, START)
    begin = begin + np.arange(len(begin))
    size = np.diff(np.concatenate([begin, [len(symbols)]]))
    windows = np.maximum(0, -((WIDTH - size) // STEP)) + 1
    if len(size) and windows.max() > 1:
        nth = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.repeat(begin, windows) + nth * STEP
        size = np.minimum(WIDTH, np.repeat(size, windows) - nth * STEP)
        owner = np.repeat(owner, windows)
    return Strings(symbols, begin, size, owner)


def triples(strings: Strings):
    """Yields (string, triple's code, weight) for every pair of gaps."""
    size = strings.size
    which = np.repeat(np.arange(len(size)), size)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(strings.begin, size) + place
    left = size[which] - place
    symbols = strings.symbols.astype(np.int32)
    for a, b, weight in GAPS:
        fits = left > b
        i = at[fits]
        yield which[fits], (symbols[i] << 12) | (symbols[i + a] << 6) | symbols[i + b], weight


# The squared norm of a string of each size whose triples all differ; no other of that size has a smaller one.
LEAST_SQUARE = np.array([sum(max(0, n - b) * w * w for _, b, w in GAPS) for n in range(WIDTH + 1)])


def features(strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised features: string, code, value; each pair of string and code once."""
    parts = list(triples(strings))
    which = np.concatenate([p[0] for p in parts])
    code = np.concatenate([p[1] for p in parts]).astype(np.int64)
    weight = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    key, inverse = np.unique(which * CODES + code, return_inverse=True)
    value = np.bincount(inverse, weight, minlength=len(key))
    which, code = key // CODES, key % CODES
    square = np.bincount(which, value * value, minlength=len(strings.size))
    return which, code, value / np.sqrt(square[which])


def chosen(strings: Strings, which: np.ndarray) -> Strings:
    return Strings(strings.symbols, strings.begin[which], strings.size[which], strings.text[which])


def spelled_strings(words: list[str]) -> Strings:
    """Strings from their spelling in ``SYMBOLS``."""
    symbols = np.array([SYMBOLS.index(c) + 1 for w in words for c in w], np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    return Strings(symbols, np.cumsum(size) - size, size, np.arange(len(words)))


class Found(NamedTuple):
    """Per text: the function's largest value over its strings and which string has it (0 and -1 where none is above
    0, as the empty string, a part of every text, has value 0); how many strings reach each level (text, level); how
    many there are."""

    best: np.ndarray
    who: np.ndarray
    reaching: np.ndarray
    strings: np.ndarray


def search(strings: Strings, weights: np.ndarray, levels: list[float], n_texts: int) -> Found:
    """Values of the function that has ``weights`` per triple, over all strings.

    Norms are computed only for strings that can be the best of their text or reach a level (all above 0): a value is
    at most what it would be if the triples of its string all differed.
    """
    found = Found(
        np.zeros(n_texts), np.full(n_texts, -1, np.int64),
        np.zeros((n_texts, len(levels)), np.int64), np.bincount(strings.text, minlength=n_texts),
    )
    total = np.zeros(len(strings.size))
    for which, code, weight in triples(strings):
        total += np.bincount(which, weights[code], minlength=len(total)) * weight
    above = np.flatnonzero(total > 0)
    if not len(above):
        return found
    bound = total[above] / np.sqrt(LEAST_SQUARE[strings.size[above]])
    owner = strings.text[above]
    exact = np.full(len(above), -1.0)

    def settle(some: np.ndarray) -> None:
        which, code, value = features(chosen(strings, above[some]))
        exact[some] = np.bincount(which, value * weights[code], minlength=len(some))

    order = np.lexsort((bound, owner))
    first = order[np.flatnonzero(np.diff(owner[order], append=-1))]
    settle(first)
    reached = np.zeros(n_texts)
    reached[owner[first]] = exact[first]
    rest = np.flatnonzero((exact < 0) & (bound >= np.minimum(reached[owner], min(levels))))
    if len(rest):
        settle(rest)
    order = np.lexsort((-above, exact, owner))
    top = order[np.flatnonzero(np.diff(owner[order], append=-1))]
    found.best[owner[top]] = exact[top]
    found.who[owner[top]] = above[top]
    for i, level in enumerate(levels):
        found.reaching[:, i] = np.bincount(owner[exact >= level], minlength=n_texts)
    return found


class Kernel:
    """Nyström features: kernels to the landmarks, turned so that their products approximate the kernel."""

    def __init__(self, landmarks: list[str]):
        which, code, value = features(spelled_strings(landmarks))
        self.codes = np.unique(code)
        self.matrix = np.zeros((len(landmarks), len(self.codes)))
        self.matrix[which, np.searchsorted(self.codes, code)] = value
        values, vectors = np.linalg.eigh(self.matrix @ self.matrix.T)
        kept = values > 1e-6 * max(values.max(initial=0), 1e-12)
        self.turn = vectors[:, kept] / np.sqrt(values[kept])

    def to_landmarks(self, words: list[str], block: int = 512) -> np.ndarray:
        out = np.zeros((len(words), len(self.matrix)))
        for begin in range(0, len(words), block):
            which, code, value = features(spelled_strings(words[begin : begin + block]))
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = self.codes[place] == code
            dense = np.zeros((len(words[begin : begin + block]), len(self.codes)))
            dense[which[known], place[known]] = value[known]
            out[begin : begin + block] = dense @ self.matrix.T
        return out

    def map(self, words: list[str]) -> np.ndarray:
        return self.to_landmarks(words) @ self.turn

    def per_triple(self, v: np.ndarray) -> np.ndarray:
        """The function ``v`` on Nyström features as one value per triple of ``codes``."""
        return (self.turn @ v) @ self.matrix


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float, steps: int = 60) -> tuple[np.ndarray, float]:
    """L2 support vector machine with squared hinge loss, by Newton steps with halving; ``y`` is -1 or 1."""
    z = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.ones(z.shape[1])
    ridge[-1] = 1e-3  # the bias is hardly shrunk
    w = np.zeros(z.shape[1])

    def loss(w):
        slack = np.maximum(0, 1 - y * (z @ w))
        return 0.5 * ridge @ (w * w) + c * weight @ (slack * slack)

    now = loss(w)
    for _ in range(steps):
        margin = 1 - y * (z @ w)
        hit = margin > 0
        scale = 2 * c * weight[hit]
        gradient = ridge * w - z[hit].T @ (scale * y[hit] * margin[hit])
        hessian = np.diag(ridge) + (z[hit].T * scale) @ z[hit]
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and (then := loss(w - size * step)) > now:
            size /= 2
        w = w - size * step
        if now - then <= 1e-10 * (1 + now):
            break
        now = then
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights and offset that turn a few measures into the chance of label 1; targets are smoothed by the class
    sizes, so that separable measures keep finite weights."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.column_stack([x, np.ones(len(x))])
    shrink = np.full(z.shape[1], ridge)
    shrink[-1] = 1e-9
    w = np.zeros(z.shape[1])
    w[-1] = np.log((n1 + 1) / (n0 + 1))

    def loss(w):
        t = z @ w
        return (np.logaddexp(0, t) - target * t).sum() + 0.5 * shrink @ (w * w)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        hessian = (z.T * (p * (1 - p))) @ z + np.diag(shrink)
        step = np.linalg.solve(hessian, z.T @ (p - target) + shrink * w)
        size = 1.0
        while size > 1e-6 and (then := loss(w - size * step)) > now:
            size /= 2
        w = w - size * step
        if now - then <= 1e-12 * (1 + now):
            break
        now = then
    return w[:-1], float(w[-1])
