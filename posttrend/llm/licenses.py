"""License scans: exact phrases, and a fuzzy search for short notices.

A notice may be found with up to ``errors`` edits.  Cut in ``errors + 1`` pieces, at least one piece stands unharmed in
every such place (pigeonhole), so an exact search for all pieces of all notices at once names the candidates; the regex
library then looks for the whole notice with bounded edits around each, and reports where it stands and with how many.
Edits must not turn one license into another: the words that tell a notice from its neighbours (``keys``) have to stand
in the place, short ones as they are, others with one edit at most; and where places of different licenses overlap, the
one with the smaller share of edits wins.

Texts are compared as words: A-Z lower-cased, words joined by single spaces.

Cases: a NULL, empty or wordless text has no places, empty labels and score 0; repeated rows are scanned one by one; an
empty table gives an empty table; further columns are ignored.  Of overlapping places with the same share of edits the
longer one wins, then the first in the list of notices.  Time grows in proportion to the text, however often a notice's
words recur in it, as stretches of candidates are searched piece by piece.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.words import LETTER_WORD_BYTES

# Phrases of the base search and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


class Notice(NamedTuple):
    label: str
    words: str
    errors: int
    keys: tuple[str, ...] = ()


# Short notices, normalised, and the words that tell them from their neighbours.
NOTICES = (
    Notice("agpl", "licensed under the gnu affero general public license version", 5, ("gnu", "affero")),
    Notice("apache-1", "licensed under the apache license version 1 1", 4, ("apache", "1")),
    Notice("apache-2", "licensed under the apache license version 2 0", 4, ("apache", "2")),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 8),
    Notice("cc-by", "licensed under a creative commons attribution 4 0 international license", 5, ("commons", "attribution")),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 2, ("cc", "by", "nc")),
    Notice("cc-by-nd", "licensed under cc by nd 4 0", 2, ("cc", "by", "nd")),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", 2, ("cc", "by", "sa")),
    Notice("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", 6, ("commons", "sharealike")),
    Notice("cc0", "to the extent possible under law the author has waived all copyright", 6, ("waived", "copyright")),
    Notice("gpl", "licensed under the gnu general public license version", 5, ("gnu", "general")),
    Notice("lgpl", "licensed under the gnu lesser general public license version", 5, ("gnu", "lesser")),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 8),
    Notice("mit", "released under the mit license", 2, ("mit",)),
    Notice("mpl-2", "subject to the terms of the mozilla public license v 2 0", 5, ("mozilla", "2")),
    Notice("reserved", "all rights reserved", 1),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
)
EXACT_KEY = 4  # keys of fewer letters must stand as they are
STRETCH = 8  # candidates are searched in stretches of so many lengths of the notice

_TO_SPACE = bytes(
    (b + 32 if 65 <= b <= 90 else b) if LETTER_WORD_BYTES[b + 32 if 65 <= b <= 90 else b] else 32 for b in range(256)
)


class Found(NamedTuple):
    label: str
    begin: int
    end: int
    errors: int
    score: float


def normalise(text: str | None) -> list[str]:
    return (text or "").encode().translate(_TO_SPACE).decode().split(" ") if text else []


def pieces(notice: Notice, times: int = 1) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about the same length, with their places; or ``times`` as many shorter ones."""
    n, parts = len(notice.words), times * (notice.errors + 1)
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def _searcher(notices: tuple[Notice, ...]):
    seeds: dict[str, list[tuple[int, int]]] = {}
    for number, notice in enumerate(notices):
        for at, piece in pieces(notice):
            seeds.setdefault(piece, []).append((number, at))
    machine = ahocorasick.Automaton()
    for piece, owners in seeds.items():
        machine.add_word(piece, (len(piece), owners))
    machine.make_automaton()
    return machine, [regex.compile(f"(?e)(?:{regex.escape(n.words, special_only=True)}){{e<={n.errors}}}") for n in notices]


def _one_edit(word: str, key: str) -> bool:
    """Whether at most one character was put in, left out or replaced."""
    if abs(len(word) - len(key)) > 1:
        return False
    a = next((i for i, (x, y) in enumerate(zip(word, key)) if x != y), min(len(word), len(key)))
    tail = len(word) - a, len(key) - a
    return any(word[a + i :] == key[a + j :] for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)) if i <= tail[0] and j <= tail[1])


def _has_keys(words: list[str], keys: tuple[str, ...]) -> bool:
    return all(key in words or len(key) >= EXACT_KEY and any(_one_edit(w, key) for w in words) for key in keys)


def _may_hold(text: str, notice: Notice, small: list[str], with_keys: bool) -> bool:
    """False where the notice cannot stand.  An edit harms one piece at most: of twice as many, ``errors + 2`` are
    unharmed.  Of a key with an edit, one half is."""
    if sum(piece in text for piece in small) < notice.errors + 2:
        return False
    keys = notice.keys if with_keys else ()
    return all(key[: len(key) // 2] in text or key[len(key) // 2 :] in text if len(key) >= EXACT_KEY else key in text for key in keys)


def fuzzy(text: str, notices: tuple[Notice, ...] = NOTICES, with_keys: bool = False) -> list[tuple[int, int, int, int]]:
    """``(notice, begin, end, errors)`` of notices in normalised text; per notice without overlaps, from left to right.

    ``with_keys``: leave out stretches in which a notice's keys cannot stand as well.
    """
    machine, patterns = _searcher(notices)
    windows: dict[int, list[list[int]]] = {}
    for last, (length, owners) in machine.iter(text):
        begin = last + 1 - length
        for number, at in owners:
            notice = notices[number]
            a = max(0, begin - at - notice.errors)
            b = min(len(text), begin - at + len(notice.words) + notice.errors)
            held = windows.setdefault(number, [])
            if held and a <= held[-1][1]:
                held[-1] = [min(a, held[-1][0]), max(b, held[-1][1])]
            else:
                held.append([a, b])
    out = []
    for number, held in windows.items():
        notice, free = notices[number], 0
        small = [piece for _, piece in pieces(notice, 2)]
        longest = len(notice.words) + notice.errors
        for a, b in held:
            # Stretches overlap by more than a place can be long.
            for begin in range(a, max(a + 1, b - longest), (STRETCH - 1) * longest):
                end = min(b, begin + STRETCH * longest)
                if not _may_hold(text[begin:end], notice, small, with_keys):
                    continue
                for m in patterns[number].finditer(text, max(begin, free), end):
                    out.append((number, m.start(), m.end(), sum(m.fuzzy_counts)))
                    free = max(free, m.end())
    return sorted(out)


def _nearest(spans: list[Found]) -> list[Found]:
    """Without the spans that overlap one of another label with a smaller share of edits."""
    kept: list[Found] = []
    for s in sorted(spans, key=lambda s: (-s.score, s.begin - s.end)):
        if all(s.label == k.label or s.end <= k.begin or k.end <= s.begin for k in kept):
            kept.append(s)
    return sorted(kept, key=lambda s: (s.begin, s.end, s.label))


def scan_text(text: str | None, phrases=PHRASES, notices: tuple[Notice, ...] = NOTICES):
    """``n_words``, base places as ``(word, label)``, and the ``Found`` notices with word places."""
    words = [w for w in normalise(text) if w]
    joined = " ".join(words)
    padded = f" {joined} "
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    word_at = lambda place: bisect_right(starts, place) - 1
    base = []
    for phrase, label in phrases:
        at = padded.find(f" {phrase} ")
        while at >= 0:
            base.append((word_at(at), label))
            at = padded.find(f" {phrase} ", at + 1)
    spans = []
    for number, a, b, errors in fuzzy(joined, notices, with_keys=True):
        notice = notices[number]
        first, last = word_at(a), word_at(max(a, b - 1)) + 1
        # A place may end where a key only begins: one more word belongs to it.
        if _has_keys(words[first : last + 1], notice.keys):
            spans.append(Found(notice.label, first, last, errors, round(1 - errors / len(notice.words), 6)))
    return len(words), base, _nearest(spans)


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", phrases=PHRASES, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row per document: counts, places, labels, the best score, and ``spans`` of the notices in words."""
    span = pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("errors", pa.int64()), ("score", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t, phrases, notices) for t in batch.column("text").to_pylist()]
            starts = [[at for at, _ in base] for _, base, _ in found]
            base_labels = [sorted({label for _, label in base}) for _, base, _ in found]
            labels = [sorted({*known, *(s.label for s in spans)}) for known, (_, _, spans) in zip(base_labels, found)]
            score = [max([1.0] * bool(base) + [s.score for s in spans], default=0.0) for _, base, spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([len(s) for s in starts], pa.int64()),
                    pa.array([min(s, default=None) for s in starts], pa.int64()), pa.array([max(s, default=None) for s in starts], pa.int64()),
                    pa.array([",".join(x) for x in base_labels], pa.string()), pa.array([",".join(x) for x in labels], pa.string()),
                    pa.array(score, pa.float64()), pa.array([[s._asdict() for s in spans] for _, _, spans in found], pa.list_(span)),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,begin:long,end:long,errors:long,score:double>>"
    )
    rows_in = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows_in.mapInArrow(rows, schema)
