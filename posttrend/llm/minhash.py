"""Near duplicates by bottom-k sketches from one hash function.

1. Every text becomes the set of its shingles' 64-bit hashes; the ``k`` smallest are its sketch.  Texts with equal sets
   (compared by a 128-bit digest of the whole set) form a class with its smallest id as representative; from here on
   only representatives count, so copies cost nothing.
2. Retained values are inverted to lists.  Two sets that reach the threshold share ``overlap`` retained values or more
   (five standard deviations below the expected number, or exactly for sets within ``k``), so it is enough to list each
   set under its ``size - overlap + 1`` rarest values.  Values that occur once are settled without a shuffle of their
   own; lists with the same members are looked at once.
3. Within a list, in blocks of bounded size, the union sketch estimates the similarity of pairs that share enough;
   pairs below ``threshold`` minus five deviations go.  What is left connects sets to clusters.
4. The sets of a cluster are built again in full and compared exactly, block by block.  Blocks give stars that connect
   what their pairs connect, never all pairs.

Lists and clusters of any length are split in blocks, so no task holds more than a block; a value as frequent as a third
of all rows costs blocks in proportion to the square of its distinct texts, and it is listed only for sets that have
nothing rarer.

Cases: NULL, empty and wordless texts have an empty set and stay alone; a NULL id stays alone and is kept; rows that
repeat an id count as one document with the union of their links; empty tables give empty tables; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored
from posttrend.llm.components import components
from posttrend.llm.words import SPACE_WORD_BYTES, Words, shingle_sets, slices

K = 32
BLOCK = 512
SHINGLE, THRESHOLD = 5, 80


def slack(threshold: int, k: int) -> float:
    """The lowest estimate to follow up: five standard deviations below the threshold."""
    j = threshold / 100
    return max(0.0, j - 5 * math.sqrt(j * (1 - j) / k))


def least_overlap(n: int, threshold: int, k: int) -> int:
    """Retained values that a set of ``n`` shares at least with any similar one."""
    return max(1, min(math.floor(slack(threshold, k) * k), -(-threshold * n // 100)))


def sketches(docs: DataFrame, shingle: int, k: int) -> DataFrame:
    """``doc_id, n, digest, sketch`` of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            sets = shingle_sets(Words(texts, SPACE_WORD_BYTES), shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "digest", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n long, digest binary, sketch array<long>")


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc, hashes``: every document's set, packed as little-endian 64-bit numbers."""

    def rows(batches):
        for part, texts in slices(batches, "text"):
            sets = shingle_sets(Words(texts, SPACE_WORD_BYTES), shingle)
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc"), packed], names=["doc", "hashes"])

    return docs.mapInArrow(rows, "doc long, hashes binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections.  Frequent elements go through a matrix product in slabs, rare ones pair by pair."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets) if m else np.zeros(0, np.int64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(values)))
    out = np.zeros((m, m), np.float32)
    rare = 4
    for c in range(2, rare + 1):
        at = starts[counts == c]
        for i in range(c):
            for j in range(i + 1, c):
                flat = np.bincount(owner[at + i] * m + owner[at + j], minlength=m * m) if len(at) else 0
                out += np.reshape(flat, (m, m)) if len(at) else 0
    out = out + out.T
    often = np.flatnonzero(counts > rare)
    for slab in np.array_split(often, max(1, -(-len(often) // 4096))):
        if len(slab):
            lengths = counts[slab]
            column = np.repeat(np.arange(len(slab)), lengths)
            within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            x = np.zeros((m, len(slab)), np.float32)
            x[owner[np.repeat(starts[slab], lengths) + within], column] = 1
            out += x @ x.T
    return out.astype(np.int64)


def union_sketch_passes(a: np.ndarray, b: np.ndarray, k: int, low: float) -> np.ndarray:
    """For rows of sketches padded with the largest number: does the union's sketch estimate at least ``low``?"""
    top = np.iinfo(np.int64).max
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    real = both != top
    rank = np.cumsum(~again & real, axis=1)
    inside = (rank <= k) & real
    return (again & inside).sum(axis=1) >= low * np.minimum(rank[:, -1], k) - 1e-9


def _by_key(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with the same key out of sorted batches."""
    last, held = None, None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = list(zip(*[columns[c] for c in key]))
        begin = 0
        for i in range(len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                part = {n: v[begin:i] for n, v in columns.items()}
                if last is not None and begin < len(keys) and keys[begin] == last:
                    for n in held:
                        held[n] += part[n]
                elif begin < len(keys):
                    if last is not None:
                        yield last, held
                    last, held = keys[begin], part
                begin = i
    if last is not None:
        yield last, held


def _pairs(block: dict[str, list]) -> np.ndarray:
    """Which pairs a block is to look at: those across its two chunks, or all if both are the same; sizes must fit."""
    side = np.array(block["side"])
    wanted = np.triu(np.ones((len(side), len(side)), bool), 1)
    if block["i"][0] != block["j"][0]:
        wanted &= side[:, None] != side[None, :]
    return wanted


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the groups of the pairs; every group is labelled by its smallest member."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low < high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def _stars(docs: list[int], label: np.ndarray) -> pa.RecordBatch | None:
    """Every member of a group with the group's first: connected as the pairs were, in fewer rows than members."""
    docs, at = np.array(docs, np.int64), np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(docs[at]), pa.array(docs[label[at]])], names=["a", "b"]) if len(at) else None


def _blocks(members: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Deals the members (``v, doc``, ...) of every list out to blocks ``v, i, j``, so that each pair meets in one."""
    rows = members.join(sizes, "v").withColumn("chunks", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("doc", F.lit(7)), F.col("chunks")).cast("int"))
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.withColumns({"i": F.least("side", "t"), "j": F.greatest("side", "t")}).drop("t", "chunks", "size")


def similar_pairs(docs: DataFrame, reps: DataFrame, shingle: int, threshold: int, k: int, block: int = BLOCK) -> DataFrame:
    """``a, b``: connects all representatives (``doc_id, n, sketch``) that similar pairs connect, and no others."""
    low = slack(threshold, k)
    key = ["v", "i", "j"]

    # Lists.  Values of one set only are known by their absence from ``common``.
    values = reps.select("doc_id", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    common = values.groupBy("v").agg(F.count("*").alias("freq")).where("freq > 1")
    most = F.floor(F.lit(low * k)).cast("long")
    need = F.greatest(F.lit(1), F.least(most, F.ceil(F.col("n") * threshold / 100.0 - 1e-9)))
    mine = values.join(common, "v").groupBy("doc_id").agg(
        F.first("n").alias("n"), F.first("s").alias("s"), F.array_sort(F.collect_list(F.struct("freq", "v"))).alias("held")
    )
    places = (F.col("s") - need + 1) - (F.col("s") - F.size("held"))
    mine = mine.select("doc_id", "n", F.explode(F.slice("held", 1, F.greatest(F.lit(0), places).cast("int"))).alias("p"))
    listed = stored(mine.select(F.col("p")["v"].alias("v"), F.col("doc_id").alias("doc"), "n"), "lists")
    sizes = listed.groupBy("v").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.sum(F.xxhash64("doc", F.lit(1)).cast("decimal(38,0)")).alias("y")
    ).where("size > 1")
    # Lists with the same members: one of them will do.
    sizes = sizes.groupBy("size", "x", "y").agg(F.min("v").alias("v")).select("v", "size")

    def estimate(batches):
        top = np.iinfo(np.int64).max
        for _, rows in _by_key(batches, key):
            m = len(rows["doc"])
            if m < 2:
                continue
            n = np.array(rows["n"])
            wanted = _pairs(rows) & (100 * np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]))
            found = [np.array(s, np.int64) for s in rows["sketch"]]
            least = np.array([least_overlap(x, threshold, k) for x in rows["n"]])
            wanted &= shared_counts(found) >= np.maximum(least[:, None], least[None, :])
            a, b = np.nonzero(wanted)
            padded = np.full((m, k), top, np.int64)
            for row, s in zip(padded, found):
                row[: len(s)] = s
            label = np.arange(m)
            for at in range(0, len(a), 20_000):
                x, y = a[at : at + 20_000], b[at : at + 20_000]
                apart = label[x] != label[y]
                x, y = x[apart], y[apart]
                passes = union_sketch_passes(padded[x], padded[y], k, low)
                label = merge(label, x[passes], y[passes])
            out = _stars(rows["doc"], label)
            if out is not None:
                yield out

    def verify(batches):
        for _, rows in _by_key(batches, key):
            sets = [np.frombuffer(h, np.int64) for h in rows["hashes"]]
            n = np.array([len(s) for s in sets])
            both = shared_counts(sets)
            linked = _pairs(rows) & (100 * both >= threshold * (n[:, None] + n[None, :] - both))
            out = _stars(rows["doc"], merge(np.arange(len(sets)), *np.nonzero(linked)))
            if out is not None:
                yield out

    near = _blocks(listed, sizes, 4 * block).join(reps.select(F.col("doc_id").alias("doc"), "sketch"), "doc")
    near = near.repartition(*key).sortWithinPartitions(*key).mapInArrow(estimate, "a long, b long")
    # Sets that estimates connect, in one way or another, are compared in full, each set once per block.
    clusters = components(near).select(F.col("component").alias("v"), F.col("node").alias("doc"))
    clusters = stored(clusters, "clusters")
    rows = _blocks(clusters, clusters.groupBy("v").agg(F.count("*").alias("size")), block)
    # A merge join at every size: the texts are the large side, and what is asked of them grows along.
    texts = docs.select(F.col("doc_id").alias("doc"), "text").join(clusters.select("doc").distinct().hint("merge"), "doc", "left_semi")
    whole = rows.join(full_sets(texts, shingle), "doc").repartition(*key).sortWithinPartitions(*key)
    return whole.mapInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD,
    k: int = K, block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Linked are documents whose shingle sets share at least ``threshold`` per cent of their union; a component is named
    by its smallest id, and that document is kept.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    base = stored(sketches(docs, shingle, k), "sketches")
    named = base.where("doc_id IS NOT NULL AND n > 0")
    reps = stored(named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    links = similar_pairs(docs, reps.drop("digest"), shingle, threshold, k, block)
    # Rows that repeat an id with other text tie their classes together.
    repeated = named.groupBy("doc_id").agg(F.count_distinct("digest").alias("texts")).where("texts > 1")
    same_id = named.join(repeated, "doc_id", "left_semi").join(reps.select("digest", F.col("doc_id").alias("rep")), "digest")
    links = links.unionByName(same_id.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = components(links)
    member = base.join(reps.select("digest", F.col("doc_id").alias("rep")), "digest", "left")
    member = member.join(found, F.col("rep") == F.col("node"), "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    out = member.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
