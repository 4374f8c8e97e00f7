"""Filter interaction audit: what each filter removes in every order in which the filters could be run.

One pass over the texts gives each document the set of filters it fails, as a bit mask.  Equal (part, mask, labels) are
counted before anything is gathered, so a part is at most ``4 * 2 ** len(names)`` counts, however many documents it
has.  The removal step is a min-plus product: the mask matrix (0 where a filter fails, infinite where it does not)
combined with the position matrix (the inverse of each order) by minimum of sums is, per mask and order, the step at
which such documents go.  Counts are scattered to (part, order, step) by that step; what a filter finds already gone is
its failures less its removals.

Cases: a NULL text is an empty one, with no words, and fails the rule on short texts; a NULL part is the empty string;
labels that are NULL or missing count as 0, and an id labelled more than once has label 1 if any row says so; copies
are told by SHA-256 of the text.  Rows sharing one id are one by one members of their part, and none of them is a copy
of another with the same id; a NULL id is neither smaller nor larger than any id, so such rows are never copies.  An
empty table has no part and gives no rows; further columns stay out, whatever their names.  Very long texts take as
much memory in a task as a few dozen times their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored
from posttrend.llm.words import SPACE_WORD_BYTES, Words, slices

NAMES = "ABCDE"
PARTS_AT_ONCE = 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


class Limits(NamedTuple):
    """A document fails A below ``min_words``, B below ``distinct_percent`` of different words, C above
    ``upper_percent`` of capitals, D with any of ``marks``, E as a copy of a smaller id's text."""

    min_words: int = 200
    distinct_percent: int = 50
    upper_percent: int = 2
    marks: str = "#$%&*|"


def _in(characters: bytes) -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[list(characters)] = True
    return inside


def text_masks(texts: list[bytes], limits: Limits) -> np.ndarray:
    """Bits 0 to 3: whether each text fails A, B, C, D."""
    words = Words(texts, SPACE_WORD_BYTES, lower=False)
    n_words = np.diff(words.first)
    bounds = words.first.tolist()
    distinct = np.array([len(np.unique(words.hashes[a:b])) for a, b in zip(bounds, bounds[1:])], np.int64)
    upper, marked = _in(bytes(range(65, 91))), _in(limits.marks.encode())
    begins = (np.arange(256) & 0xC0) != 0x80

    # Each text is followed by one space, which is no capital and no mark, but a code point.
    def count(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[words.buffer], words.text_begin, dtype=np.int64)

    fails = (
        n_words < limits.min_words,
        100 * distinct < limits.distinct_percent * n_words,
        100 * count(upper) > limits.upper_percent * (count(begins) - 1),
        count(marked) > 0,
    )
    return sum(fail.astype(np.int32) << bit for bit, fail in enumerate(fails))


def _measured(docs: DataFrame, limits: Limits) -> DataFrame:
    """(id, part, text's SHA-256, mask of the first four filters) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            masks = pa.array(text_masks(texts, limits), pa.int32())
            yield pa.record_batch([part.column("id"), part.column("part"), digests, masks], names=["id", "part", "sha", "mask"])

    return docs.mapInArrow(run, "id bigint, part string, sha binary, mask int")


def filter_cells(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", part: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """Counts ``n`` per (part, mask, good, toxic); bit ``i`` of ``mask`` stands for filter ``NAMES[i]``."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
    )
    # Repeats of a row are one row with a count before they meet the labels.
    measured = _measured(rows, limits).groupBy("id", "part", "sha", "mask").agg(F.count(F.lit(1)).alias("n"))
    is_one = lambda c: F.max(F.coalesce(F.col(f"`{c}`") == 1, F.lit(False)))
    known = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("bigint").alias("id"))
    known = known.agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    marked = measured.join(known, "id", "left").select("id", "part", "sha", "mask", "n", flag("good"), flag("toxic"))
    # A group of copies is a few rows per part from here on; ``lo`` is its smallest id there.
    alike = marked.groupBy("sha", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("lo"), F.min_by("n", "id").alias("n_lo"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )
    alike = stored(alike, "audit")
    first = alike.groupBy("sha").agg(F.min("lo").alias("first"))
    # Both sides grow with the documents: a merge join, split where one text's rows are many.
    met = alike.join(first.hint("merge"), "sha")
    unique = F.col("n_null") + F.when(F.col("lo") == F.col("first"), F.col("n_lo")).otherwise(0)
    copy_bit = 1 << NAMES.index("E")
    cells = met.select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), unique.alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(copy_bit)).alias("mask"), (F.col("n") - unique).alias("n")),
        )),
    )
    # Documents that are no copies leave a copy count of 0 here, dropped so that parts hold only what they have.
    return cells.where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def orders(names: str) -> tuple[list[str], np.ndarray]:
    """All orders, and their position matrix: entry (filter, order) is the step, from 1, at which it runs."""
    every = ["".join(p) for p in permutations(names)]
    return every, np.array([[order.index(name) + 1 for order in every] for name in names], np.float64)


def removal_steps(n_filters: int, position: np.ndarray) -> np.ndarray:
    """(mask, order) -> the step at which documents of that mask go; one beyond the last for those that stay."""
    bits = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    masks = np.where(bits == 1, 0.0, np.inf)
    steps = np.full((len(masks), position.shape[1]), n_filters + 1.0)
    for f in range(n_filters):
        np.minimum(steps, masks[:, f, None] + position[None, f], out=steps)
    return steps.astype(np.int64)


def _audit(part: np.ndarray, mask: np.ndarray, weights: dict[str, np.ndarray], n_parts: int, position: np.ndarray) -> dict:
    """The counts, each as (part, order, step)."""
    n_filters, n_orders = position.shape
    gone_at = removal_steps(n_filters, position)[mask]

    def scatter(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((n_parts, n_orders, n_filters + 2), np.int64)
        np.add.at(out, (part[:, None], np.arange(n_orders)[None], gone_at), weight[:, None])
        return out[:, :, 1 : n_filters + 1]

    def per_filter(weight: np.ndarray, chosen) -> np.ndarray:
        out = np.zeros((n_parts, n_filters), np.int64)
        for f in range(n_filters):
            hit = chosen(f)
            np.add.at(out[:, f], part[hit], weight[hit])
        return out

    n = weights["n"]
    removed = scatter(n)
    at = np.argsort(position.T, axis=1)  # (order, step) -> filter
    total = np.zeros(n_parts, np.int64)
    np.add.at(total, part, n)
    fails = per_filter(n, lambda f: (mask >> f) & 1 == 1)
    alone = per_filter(n, lambda f: mask == 1 << f)
    shapley = np.zeros((n_parts, n_filters), np.int64)
    for step in range(n_filters):
        np.add.at(shapley, (np.arange(n_parts)[:, None], at[None, :, step]), removed[:, :, step])
    return {
        "kept": total[:, None, None] - np.cumsum(removed, axis=2), "removed": removed, "redundant": fails[:, at] - removed,
        "unique_fails": alone[:, at], "good_lost": scatter(weights["good"]), "toxic_lost": scatter(weights["toxic"]),
        "shapley": shapley[:, at],
    }


def audit_orders(cells: DataFrame, names: str = NAMES) -> DataFrame:
    """One row per part, order and step from the counts of ``filter_cells``, zeros included.

    ``names`` has one letter per bit; the rows of a part grow with the factorial of their number.
    """
    every, position = orders(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PARTS_AT_ONCE):
                some = batch.slice(begin, PARTS_AT_ONCE)
                lists = some.column("cells")
                cell = lists.flatten()
                field = lambda name: cell.field(cell.type.get_field_index(name)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                part = np.repeat(np.arange(some.num_rows), np.diff(lists.offsets.to_numpy()))
                n = field("n")
                weights = {"n": n, "good": n * field("good"), "toxic": n * field("toxic")}
                counts = _audit(part, field("mask"), weights, some.num_rows, position)
                size, steps = len(every) * len(names), np.arange(1, len(names) + 1, dtype=np.int32)
                yield pa.record_batch(
                    [some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), size))),
                     pa.array(every).take(pa.array(np.tile(np.repeat(np.arange(len(every)), len(names)), some.num_rows))),
                     pa.array(np.tile(steps, some.num_rows * len(every))), *[pa.array(counts[c].ravel()) for c in COUNTS]],
                    names=["part", "filter_order", "step", *COUNTS],
                )

    # At most 4 * 2 ** len(names) counts to a part.
    lists = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    return lists.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


def oracle(limits: Limits = Limits()) -> str:
    word = r"[^\x20\x09-\x0D]+"
    places = ", ".join(f"CASE WHEN {x} THEN instr(o, '{x}') ELSE 9 END" for x in NAMES)
    fails = " ".join(f"WHEN '{x}' THEN {x}" for x in NAMES)
    alone = " ".join(f"WHEN '{x}' THEN {x} AND NOT ({' OR '.join(y for y in NAMES if y != x)})" for x in NAMES)
    tables = ", ".join(f"letters l{i}" for i in range(5))
    apart = " AND ".join(f"l{i}.x <> l{j}.x" for i in range(5) for j in range(i))
    total = lambda test, name, weight="n": f"sum(CASE WHEN {test} THEN {weight} ELSE 0 END)::BIGINT AS {name}"
    return rf"""
WITH known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '{word}') AS ws, min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(ws) < {limits.min_words} AS A,
    100 * len(list_distinct(ws)) < {limits.distinct_percent} * len(ws) AS B,
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {limits.upper_percent} * length(t) AS C,
    regexp_matches(t, '[{limits.marks}]') AS D, coalesce(lo < w.doc_id, false) AS E
    FROM w LEFT JOIN known ON w.doc_id = known.doc_id),
cells AS (SELECT part, A, B, C, D, E, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, A, B, C, D, E),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT l0.x || l1.x || l2.x || l3.x || l4.x AS o FROM {tables} WHERE {apart}),
gone AS (SELECT *, least({places}) AS r FROM cells, orders),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
told AS (SELECT *, substr(o, step, 1) AS x FROM gone, steps),
judged AS (SELECT *, CASE x {fails} END AS fails, CASE x {alone} END AS alone FROM told),
sums AS (SELECT part, o, step, x, {total('r > step', 'kept')}, {total('r = step', 'removed')},
    {total('fails AND r < step', 'redundant')}, {total('alone', 'unique_fails')},
    {total('r = step', 'good_lost', 'good')}, {total('r = step', 'toxic_lost', 'toxic')} FROM judged GROUP BY part, o, step, x)
SELECT part, o AS filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM sums
"""
