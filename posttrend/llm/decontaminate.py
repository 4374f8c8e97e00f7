"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised to words, words to numbers, and an automaton over all items of a block recognises every run of
words that occurs in an item.  Documents stream through it word by word while the length of the longest match that ends
at each word is tracked; a match of ``window`` words or more means that a whole window of an item stands there.  Items
shorter than a window are recognised as a whole.

The automaton is shipped to the tasks, so its size is bounded: items are read in blocks of at most ``block_words``
words, one automaton each, and the blocks' findings are joined per document.  Memory follows the block, not the
benchmark.

Cases: NULL or wordless items have no windows; NULL or empty documents have no words; repeated items each count under
their own id, an item without one hits words but is not named; repeated rows are judged one by one; an empty benchmark hits nothing; further columns are ignored by
``find_leaks`` and pass through ``remove_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored
from posttrend.llm.words import LETTER_WORD_BYTES, Words, slices

WINDOW = 10
BLOCK_WORDS = 250_000
MAX_COVERAGE = 0.5


class Automaton:
    """Suffix automaton over items given as lists of word hashes.

    ``run`` is exact on 64-bit word hashes.  ``ids`` holds what stands for an item, ``items`` per state the items in
    which the state's strings occur.
    """

    def __init__(self, ids: list, texts: list[list[int]], window: int):
        self.window = window
        vocabulary = sorted({w for t in texts for w in t})
        self.vocabulary = np.array(vocabulary, np.uint64)
        code = {w: i for i, w in enumerate(vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.items = [-1], [0], [set()]
        self.short: dict[int, set] = {}
        self.least = window
        ends = []
        for item, text in zip(ids, texts):
            if not text:
                continue
            self.least = min(self.least, len(text))
            last = 0
            for w in text:
                last = self._add(code[w], last)
                self.items[last].add(item)
            ends.append((item, [code[w] for w in text]))
        # What occurs in a state's string occurs in all its suffixes' states.
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.items[self.link[s]] |= self.items[s]
        for item, text in ends:
            if len(text) < window:
                s = 0
                for w in text:
                    s = self.next[s][w]
                self.short.setdefault(s, set()).add((item, len(text)))
        # Per state the nearest suffix state that is a whole short item.
        self.short_up = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=lambda s: self.length[s]):
            self.short_up[s] = s if s in self.short else self.short_up[self.link[s]] if self.link[s] > 0 else -1

    def _add(self, w: int, last: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, q, w)
        new = self._state({}, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        """A state of its own for the shorter strings of ``q``."""
        half = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[half] = self.link[q]
        self.link[q] = half
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = half
            p = self.link[p]
        return half

    def _state(self, moves: dict[int, int], length: int) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        self.items.append(set())
        return len(self.link) - 1

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The number of every word, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def run(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hit ranges (merged, half open) and the items found in a run of known words."""
        nxt, link, length, window, short_up = self.next, self.link, self.length, self.window, self.short_up
        state, matched = 0, 0
        ranges: list[list[int]] = []
        found = set()
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            state = nxt[state].get(w, 0)
            matched = matched + 1 if state else 0
            reach = 0
            if matched >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                found |= self.items[s]
                reach = window
            s = short_up[state] if state else -1
            while s > 0:
                for item, size in self.short[s]:
                    if size <= matched:
                        found.add(item)
                        reach = max(reach, size)
                s = short_up[link[s]] if link[s] > 0 else -1
            if reach:
                begin = i + 1 - reach
                while ranges and ranges[-1][1] >= begin:
                    begin = min(begin, ranges.pop()[0])
                ranges.append([begin, i + 1])
        return [tuple(r) for r in ranges], found

    def scan(self, words: Words) -> list[tuple[list[tuple[int, int]], set]]:
        """Per text the hit word ranges, from 0 in each text, and the items."""
        out = [([], set()) for _ in range(len(words.first) - 1)]
        known = self.known(words.hashes)
        yes = known >= 0
        text_of = np.repeat(np.arange(len(out)), np.diff(words.first))
        # Runs of known words within one text; shorter ones than any window cannot hit.
        if not len(yes) or self.vocabulary.size == 0:
            return out
        new = np.ones(len(yes) + 1, bool)
        new[1:-1] = (yes[1:] != yes[:-1]) | (text_of[1:] != text_of[:-1])
        cuts = np.flatnonzero(new)
        begin, end = cuts[:-1], cuts[1:]
        use = yes[begin] & (end - begin >= self.least)
        for a, b in zip(begin[use].tolist(), end[use].tolist()):
            ranges, found = self.run(known[a:b].tolist())
            if ranges:
                t = int(text_of[a])
                base = a - int(words.first[t])
                out[t][0].extend((x + base, y + base) for x, y in ranges)
                out[t][1].update(found)
        return out


def automata(benchmark: DataFrame, window: int, block_words: int, item_id: str, text: str) -> Iterator[Automaton]:
    """One automaton per block of items; the driver holds one block at a time."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    ids, texts, size = [], [], 0
    for row in rows.toLocalIterator():
        w = Words([row.t.encode()], LETTER_WORD_BYTES).hashes.tolist()
        if size and size + len(w) > block_words:
            yield Automaton(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(w)
        size += len(w)
    yield Automaton(ids, texts, window)


def _merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _hits(rows: DataFrame, benchmark: DataFrame, text: str, window: int, block_words: int, item_id: str, item_text: str) -> DataFrame:
    """Adds ``spans`` (hit word ranges), ``items`` and ``n_words`` to a table of the struct ``row``.

    One pass per block of items; between passes the findings are stored, so that no task ever holds two automata.
    """
    spark = rows.sparkSession
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, spans array<struct<begin:long,end:long>>, items array<string>"

    def one_pass(held):
        def scan(batches):
            for part, texts in slices(batches, f"row.{text}"):
                words = Words(texts, LETTER_WORD_BYTES)
                found = held.value.scan(words)
                old = part.to_pylist() if "items" in part.schema.names else None
                spans, items = [], []
                for i, (ranges, names) in enumerate(found):
                    names = {str(n) for n in names if n is not None}
                    if old:
                        ranges = ranges + [(s["begin"], s["end"]) for s in old[i]["spans"]]
                        names |= set(old[i]["items"])
                    spans.append([{"begin": a, "end": b} for a, b in _merged(ranges)])
                    items.append(sorted(names))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(np.diff(words.first), pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                    names=["row", "n_words", "spans", "items"],
                )

        return scan

    out = rows
    for automaton in automata(benchmark, window, block_words, item_id, item_text):
        if out is not rows:
            out = stored(out, "hits")
        out = out.mapInArrow(one_pass(spark.sparkContext.broadcast(automaton)), schema)
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and the hit word ``spans``."""
    rows = docs.select(F.struct(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).alias("row"))
    hits = _hits(rows, benchmark, "text", window, block_words, item_id, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return hits.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def _cut(text: bytes, begin: np.ndarray, end: np.ndarray, spans: list[dict]) -> str:
    parts, at = [], 0
    for s in spans:
        parts.append(text[at : int(begin[s["begin"]])].rstrip(b" "))
        at = int(end[s["end"] - 1])
    return b"".join([*parts, text[at:]]).decode()


def remove_leaks(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without hit spans; a document of which more than ``max_coverage`` of the words are hit goes altogether.

    Columns are those of ``docs``; untouched texts stay as they are, byte for byte (NULL stays NULL), and where a span
    goes, the spaces before it go too.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    hits = _hits(rows, benchmark, text, window, block_words, item_id, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    hits = hits.where(n_hit <= F.col("n_words") * max_coverage).drop("items", "n_words")

    def cut(batches):
        for part, texts in slices(batches, f"row.{text}"):
            spans = part.column("spans").to_pylist()
            words = Words([t if s else b"" for t, s in zip(texts, spans)], LETTER_WORD_BYTES)
            clean = []
            for i, (body, found) in enumerate(zip(texts, spans)):
                a, b = words.first[i], words.first[i + 1]
                begin, end = words.begin[a:b] - words.text_begin[i], words.end[a:b] - words.text_begin[i]
                clean.append(_cut(body, begin, end, found) if found else None)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(clean, pa.string())], names=["row", "clean"])

    out = hits.mapInArrow(cut, f"row {hits.schema['row'].dataType.simpleString()}, clean string")
    value = lambda c: F.coalesce("clean", F.col("row")[c]) if c == text else F.col("row")[c]
    return out.select(*[value(c).alias(c) for c in docs.columns])


def oracle() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH b AS (SELECT item_id, {words} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS g
    FROM (SELECT item_id, ws, least(len(ws), {WINDOW}) AS n, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT r, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS g
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT DISTINCT r, i, n, item_id FROM g JOIN win USING (n, g)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM hit GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
