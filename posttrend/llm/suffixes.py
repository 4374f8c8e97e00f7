"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts in an earlier document go.

Only suffixes that can be repeated are sorted.

1. Anchors.  Every window of 50 bytes names one 28-byte string inside it, by content alone (the smallest 5-byte hash in
   the window, its place modulo 23), so equal windows name equal anchors; about one place in twenty is one.  Anchors are
   brought together; those of a single document are done with.
2. Contexts.  Around each place of a repeated anchor the other bytes of all windows that name it, 44 at most, are
   gathered under the anchor's 64-bit hash, equal ones next to each other: of those only the first document's is sorted,
   as the others are covered altogether.
3. Bucket-pointer refinement.  The suffixes of a batch of contexts are put in buckets by their first 8 bytes; a bucket
   of depth d is refined by sorting on the bucket of the suffix d bytes on, which doubles the depth, and the refined
   identifiers serve the next step: 8, 16 and, with an overlap, the 22 bytes of a window beside its anchor.  A window
   whose anchor, place of the anchor and last bucket an earlier document has too is a repeat.

Whole copies are settled before by the MD5 digest of their text.

Batches end between anchors, so memory follows the number of different contexts of one anchor at most.

Cases: NULL and empty texts have no bytes; texts under 50 bytes lose nothing; a document with a NULL id has no place in
the order: it neither loses bytes nor takes any; rows that repeat an id do not count against each other; empty tables
give empty tables; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored
from posttrend.llm.words import mix

LENGTH, ANCHOR, SEED = 50, 28, 5
STEP = LENGTH - ANCHOR + 1
SEGMENT = 1 << 18
BATCH_BYTES = 2 << 20
REST = LENGTH - ANCHOR
DEPTHS = (8, 16, REST)


def _loads(buffer: np.ndarray) -> np.ndarray:
    """The 64-bit number that begins at every byte (7 fewer than bytes)."""
    return np.lib.stride_tricks.as_strided(buffer.view(np.uint8), (max(0, len(buffer) - 7), 8), (1, 1)).copy().view(np.uint64)[:, 0]


def _anchors(buffer: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the anchors that the windows at ``start`` name, and the place that each of them names.
    ``buffer`` has 8 bytes to spare."""
    n = len(buffer) - 8
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), start
    words = _loads(buffer)
    seeds = n - SEED + 1
    place = np.arange(seeds, dtype=np.uint64)
    key = (mix(words[:seeds] & np.uint64((1 << (8 * SEED)) - 1)) & np.uint64(0xFFFFFFFFFF000000)) | place
    span = LENGTH - SEED + 1
    width = 1
    while width * 2 <= span:  # the smallest of ever wider windows
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
    chosen = (key[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    mark = np.zeros(n, bool)
    named = start + (chosen - start) % STEP
    mark[named] = True
    at = np.flatnonzero(mark)
    h = mix(words[at])
    for offset in (8, 16, ANCHOR - 8):
        h = mix(h ^ words[at + offset])
    return at, h.view(np.int64), named


class Pack:
    """Pieces of texts next to each other, with their anchors.

    A text longer than ``SEGMENT`` is cut in pieces that overlap so that each window lies in one of them.
    """

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.text = np.array([t for t, _, _ in pieces])
        self.offset = np.array([o for _, o, _ in pieces], np.int64)
        self.buffer = np.frombuffer(b"".join([p for _, _, p in pieces] + [b"\0" * 8]), np.uint8)
        size = np.array([len(p) for _, _, p in pieces], np.int64)
        self.end = np.cumsum(size)
        self.begin = self.end - size
        room = np.maximum(size - LENGTH + 1, 0)
        self.start = np.repeat(self.begin - (np.cumsum(room) - room), room) + np.arange(int(room.sum()))
        self.places, self.hashes, self.named = _anchors(self.buffer, self.start)
        self.piece = np.searchsorted(self.end, self.places, side="right")

    def contexts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Of the marked anchors: where their first window begins in the text, the number of bytes before the anchor,
        and the bytes of their windows without the anchor itself."""
        first, last = np.zeros(len(self.buffer), np.int64), np.zeros(len(self.buffer), np.int64)
        last[self.named] = self.start  # of equal places the last assignment stays
        first[self.named[::-1]] = self.start[::-1]
        places, piece = self.places[which], self.piece[which]
        begin, end = first[places], last[places] + LENGTH
        left = places - begin
        size = end - begin - ANCHOR
        ends = np.cumsum(size)
        within = np.arange(int(size.sum())) - np.repeat(ends - size, size)
        data = self.buffer[np.repeat(begin, size) + within + ANCHOR * (within >= np.repeat(left, size))]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        body = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
        return begin - self.begin[piece] + self.offset[piece], left, body


def packs(texts: list[bytes]) -> Iterator[Pack]:
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), SEGMENT):
            piece = text[at : at + SEGMENT + LENGTH - 1]
            if held and size + len(piece) > SEGMENT:
                yield Pack(held)
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield Pack(held)


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """``h, doc_id`` of every anchor."""

    def rows(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for pack in packs([t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]):
                owner = ids[pack.text[pack.piece]]
                yield pa.RecordBatch.from_arrays([pa.array(pack.hashes), pa.array(owner, pa.int64())], names=["h", "doc_id"])

    return docs.mapInArrow(rows, "h long, doc_id long")


def _shared(places: DataFrame) -> DataFrame:
    """The distinct rows ``h, doc_id`` of anchors with two documents or more, from rows in that order."""

    def rows(batches):
        last_h, last_doc, told = None, None, False  # told: whether the last row has been given out
        for batch in batches:
            h, doc = batch.column("h").to_numpy(), batch.column("doc_id").to_numpy()
            if last_h is not None:
                h, doc = np.concatenate([[last_h], h]), np.concatenate([[last_doc], doc])
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, doc = h[new], doc[new]
            same = h[1:] == h[:-1]
            give = np.zeros(len(h), bool)
            give[1:] |= same
            give[:-1] |= same
            # The first row may be the one carried over, and may have been given out before.
            known = told
            told = bool(give[-1]) or (len(h) == 1 and known)
            if known:
                give[0] = False
            last_h, last_doc = h[-1], doc[-1]
            if give.any():
                yield pa.RecordBatch.from_arrays([pa.array(h[give]), pa.array(doc[give])], names=["h", "doc_id"])

    return places.mapInArrow(rows, "h long, doc_id long")


def _contexts(joined: DataFrame) -> DataFrame:
    """Around the places of the anchors listed in ``hs``: ``h, doc_id, row, at, before, body``."""

    def rows(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            marks = np.array([_row_mark(t) for t in texts], np.int64)
            lists = batch.column("hs")
            salt = mix(np.arange(1, len(texts) + 1, dtype=np.uint64))
            wanted = lists.flatten().to_numpy().view(np.uint64)
            lengths = np.diff(lists.offsets.to_numpy())
            wanted = np.sort(mix(wanted ^ np.repeat(salt, lengths)))
            for pack in packs(texts):
                text = pack.text[pack.piece]
                asked = mix(pack.hashes.view(np.uint64) ^ salt[text])
                at = np.searchsorted(wanted, asked)
                at[at == len(wanted)] = 0
                which = np.flatnonzero(wanted[at] == asked)
                if len(which):
                    begin, left, body = pack.contexts(which)
                    text = text[which]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pack.hashes[which]), pa.array(ids[text], pa.int64()), pa.array(marks[text]), pa.array(begin), pa.array(left), body],
                        names=["h", "doc_id", "row", "at", "before", "body"],
                    )

    return joined.mapInArrow(rows, "h long, doc_id long, row long, at long, before long, body binary")


def _row_mark(body: bytes) -> int:
    """Tells rows of one id apart, in few bytes that change."""
    return len(body) << 20 | xxhash.xxh64_intdigest(body) & 0xFFFFF


def refine(bodies: list[bytes], anchor: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, place and bucket of all windows of the contexts, by bucket-pointer refinement.

    A window is its anchor, the number of its bytes before the anchor, and its ``REST`` other bytes: those are a suffix
    of the context's bytes, told apart to the depth ``REST``.
    """
    sizes = np.fromiter((len(b) for b in bodies), np.int64, len(bodies))
    first = np.cumsum(sizes) - sizes
    words = _loads(np.frombuffer(b"".join(bodies) + b"\0" * 8, np.uint8))
    owner = np.repeat(np.arange(len(bodies)), sizes)
    left = np.repeat(first + sizes, sizes) - np.arange(int(sizes.sum()))
    live = np.flatnonzero(left >= DEPTHS[0])
    bucket = np.zeros(len(left), np.int64)
    _, bucket[live] = np.unique(words[live], return_inverse=True)
    depth = DEPTHS[0]
    for deeper in DEPTHS[1:]:
        live = np.flatnonzero(left >= deeper)
        # The later offset's bucket reaches depth bytes from there: together they cover ``deeper`` bytes.
        pair = bucket[live] * (int(bucket.max()) + 1) + bucket[live + deeper - depth]
        refined = np.zeros(len(left), np.int64)
        _, refined[live] = np.unique(pair, return_inverse=True)
        bucket, depth = refined, deeper
    owner, place = owner[live], live - first[owner[live]]
    _, same = np.unique(anchor, return_inverse=True)
    return owner, place, (bucket[live] * (int(same.max()) + 1) + same[owner]) * STEP + before[owner] - place


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(starts) > LENGTH) + 1
    return [(int(part[0]), int(part[-1]) + LENGTH) for part in np.split(starts, cuts)]


def _repeats(contexts: DataFrame) -> DataFrame:
    """``doc_id, row, begin, end`` of covered bytes, from contexts sorted by anchor, bytes and document."""
    schema = "doc_id long, row long, begin long, end long"

    def settle(held: list[tuple], out: list[list]) -> None:
        """held: (doc, row, at, before, body, h) with different bytes, or equal ones of the first document only."""
        owner, place, bucket = refine([x[4] for x in held], np.array([x[5] for x in held]), np.array([x[3] for x in held]))
        docs = np.array([x[0] for x in held])[owner]
        order = np.lexsort((docs, bucket))
        new = np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])
        earliest = docs[order][new][np.cumsum(new) - 1]
        hit = np.zeros(len(owner), bool)
        hit[order] = docs[order] > earliest
        owner, place = owner[hit], place[hit]
        for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1) if len(owner) else []:
            doc, row, at = held[owner[part[0]]][:3]
            for a, b in _spans(place[part]):
                _add(out, doc, row, at + a, at + b)

    def _add(out, *values):
        for column, value in zip(out, values):
            column.append(value)

    def flush(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "row", "begin", "end"])

    def rows(batches):
        held: list[tuple] = []
        size, last, last_doc = 0, (None, None, None), None
        out: list[list] = [[], [], [], []]
        for batch in batches:
            for h, doc, row, at, before, body in zip(*(batch.column(c).to_pylist() for c in ("h", "doc_id", "row", "at", "before", "body"))):
                if h != last[0] and size > BATCH_BYTES:
                    settle(held, out)
                    held, size = [], 0
                if (h, before, body) == last:
                    if doc != last_doc:
                        _add(out, doc, row, at, at + len(body) + ANCHOR)
                        continue
                else:
                    last, last_doc = (h, before, body), doc
                held.append((doc, row, at, before, body, h))
                size += len(body)
            if len(out[0]) > 20_000:
                yield flush(out)
                out = [[], [], [], []]
        if held:
            settle(held, out)
        if out[0]:
            yield flush(out)

    return contexts.mapInArrow(rows, schema)


def _strip(joined: DataFrame) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"

    def rows(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, spans, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "copy"))):
                body = (text or "").encode()
                mark = _row_mark(body) if spans else 0
                merged: list[list[int]] = []
                for a, b in sorted((s["begin"], s["end"]) for s in spans or () if s["row"] == mark):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                if copy:
                    merged = [[0, len(body)]]
                parts, at = [], 0
                for a, b in merged:
                    parts.append(body[at:a])
                    at = b
                left = b"".join([*parts, body[at:]])
                values = len(body), len(body) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left
                for column, value in zip(out, values):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    return joined.mapInArrow(rows, schema)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the bytes that are left."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Whole copies are told by their digest.  The first of each text speaks for all, since its id is the smallest.
    named = docs.where("doc_id IS NOT NULL")
    digest = F.md5(F.col("text").cast("binary"))
    digests = named.where(F.octet_length("text") >= LENGTH).select("doc_id", digest.alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    copies = stored(digests.join(firsts, "digest").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("digest").alias("digests")), "copies")
    copy = F.coalesce(F.array_contains("digests", digest), F.lit(False))
    # Merge joins at every size: what is joined to the texts grows with them.
    copies = copies.hint("merge")
    # Each step is stored, so that no more than one step's shuffle files lie on the disks at a time.
    singles = named.join(copies, "doc_id", "left").where(~copy).select("doc_id", "text")
    places = _anchor_rows(singles).repartition("h").sortWithinPartitions("h", "doc_id")
    wanted = stored(_shared(places).groupBy("doc_id").agg(F.collect_set("h").alias("hs")), "wanted").hint("merge")
    joined = named.join(wanted, "doc_id").join(copies, "doc_id", "left").where(~copy).select("doc_id", "text", "hs")
    contexts = _contexts(joined).repartition("h").sortWithinPartitions("h", "before", "body", "doc_id")
    spans = _repeats(contexts).groupBy("doc_id").agg(F.collect_list(F.struct("row", "begin", "end")).alias("spans"))
    spans = stored(spans, "spans").hint("merge")
    found = named.join(spans, "doc_id", "left").join(copies, "doc_id", "left").select("doc_id", "text", "spans", copy.alias("copy"))
    rest = docs.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast(found.schema["spans"].dataType).alias("spans"), F.lit(False).alias("copy"))
    return _strip(found.unionByName(rest))
