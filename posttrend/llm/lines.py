"""Line dedup by overlapping runs of lines.

Every run of ``LEAST_LINES`` consecutive lines with text is proposed, whatever its place, and every single line of over
``LONG_WORDS`` words, so that a repeated passage of a few lines is found as a whole.  These chunks overlap.  Chunks that
occur more than once anywhere lose all but their first occurrence, in order of document id and place; a line goes where
any chunk over it goes.  So each line that goes also stands earlier, and its first occurrence always stays; but where
repeated chunks overlap, the first occurrence of one may itself lose a line to an earlier occurrence of another.

Hashes only propose: the bytes of every proposed chunk are gathered under its hash and compared, as the smallest and the
largest string that share it; chunks whose hashes agree and bytes do not are left alone.  Both the counting and the
comparison aggregate before they shuffle, so a chunk that stands in a third of all documents is one row per task.

Cases: NULL and empty texts have no chunks and stay as they are; documents that lose all their lines end up empty
(``dedup_lines`` keeps them, ``drop_emptied`` says otherwise); a NULL id comes first in the order, repeated ids and rows
are told apart by their text, and equal ones keep their chunks together; empty tables give empty tables; further columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored

LEAST_LINES = 2
LONG_WORDS = 50


def chunks(text: bytes, least: int = LEAST_LINES, long_words: int = LONG_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """``begin, end, bytes`` of every run of ``least`` lines with text and every line of over ``long_words`` words, in
    order of their begins; ``begin`` and ``end`` are bytes in the text.

    A line has the empty lines before it and its line end, which are no part of what a chunk says; the last line with
    text has the rest of the text.
    """
    lines: list[tuple[int, int, int]] = []  # where what goes with it begins, where it begins and ends
    at = begin = 0
    for line in text.split(b"\n"):
        end = at + len(line)
        if line.strip():
            lines.append((begin, at, end))
            begin = min(end + 1, len(text))
        at = end + 1
    goes_to = [*[b for b, _, _ in lines[1:]], len(text)]
    for i, (begin, at, end) in enumerate(lines):
        if least > 1 and end - at > 2 * long_words and len(text[at:end].split()) > long_words:
            yield begin, goes_to[i], text[at:end]
        last = i + least - 1
        if last < len(lines):
            yield begin, goes_to[last], text[at : lines[last][2]]


def _chunk_rows(docs: DataFrame, least: int, long_words: int) -> DataFrame:
    """``key, doc_id, no, hash`` of every chunk."""

    def rows(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, doc, text in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for no, (_, _, body) in enumerate(chunks((text or "").encode(), least, long_words)):
                    for column, value in zip(out, (key, doc, no, xxhash.xxh3_128_digest(body))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["key", "doc_id", "no", "hash"]
            )

    return docs.mapInArrow(rows, "key long, doc_id long, no long, hash binary")


def _bytes_of(docs: DataFrame, least: int, long_words: int) -> DataFrame:
    """``hash, body`` of the chunks whose numbers are listed in ``nos``."""

    def rows(batches):
        for batch in batches:
            out: list[list] = [[], []]
            for text, nos in zip(batch.column("text").to_pylist(), batch.column("nos").to_pylist()):
                wanted = set(nos)
                for no, (_, _, body) in enumerate(chunks((text or "").encode(), least, long_words)):
                    if no in wanted:
                        out[0].append(xxhash.xxh3_128_digest(body))
                        out[1].append(body)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], names=["hash", "body"])

    return docs.mapInArrow(rows, "hash binary, body binary")


def _removed(docs: DataFrame, least: int, long_words: int) -> tuple[DataFrame, DataFrame]:
    """All chunk rows, and ``key, nos`` of the chunks to remove."""
    found = stored(_chunk_rows(docs, least, long_words), "chunks")
    place = F.struct(F.col("doc_id"), F.col("key"), F.col("no"))
    often = found.groupBy("hash").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1")
    proposed = stored(found.join(often, "hash"), "proposed")
    asked = proposed.groupBy("key").agg(F.collect_list("no").alias("nos"))
    bodies = _bytes_of(docs.select("key", "text").join(asked.hint("merge"), "key").select("text", "nos"), least, long_words)
    # One string between the least and the greatest: all bytes agree.
    equal = bodies.groupBy("hash").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a = b").select("hash")
    later = proposed.where(place != F.col("first")).join(equal, "hash")
    return found, later.groupBy("key").agg(F.collect_list("no").alias("nos"))


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``key`` is the id, or for a NULL id a hash of the text: rows of one key have their chunks counted together."""
    body = F.col(f"`{text}`")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), body.alias("text"),
        F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.length(body), F.lit(-1)), F.xxhash64(body)).alias("key"),
    )


def _strip(rows_in: DataFrame, least: int, long_words: int) -> DataFrame:
    """Adds ``clean`` and counts to ``row, text, nos``; NULL ``nos`` means nothing to remove, ``clean`` is then NULL."""

    def rows(batches):
        for batch in batches:
            clean, n_chunks, n_removed, n_bytes = [], [], [], []
            for text, nos in zip(batch.column("text").to_pylist(), batch.column("nos").to_pylist()):
                body = (text or "").encode()
                found = list(chunks(body, least, long_words))
                drop = set(nos or ())
                parts, at = [], 0
                for no, (a, b, _) in enumerate(found):
                    if no in drop:
                        parts.append(body[at:a])
                        at = max(at, b)
                left = b"".join([*parts, body[at:]])
                clean.append(left.decode() if drop else None)
                n_chunks.append(len(found))
                n_removed.append(len(drop))
                n_bytes.append(len(body) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(clean, pa.string()), *[pa.array(c, pa.int64()) for c in (n_chunks, n_removed, n_bytes)]],
                names=["row", "clean", "n_chunks", "n_removed", "n_bytes_removed"],
            )

    kind = rows_in.schema["row"].dataType.simpleString()
    return rows_in.mapInArrow(rows, f"row {kind}, clean string, n_chunks long, n_removed long, n_bytes_removed long")


def _deduped(docs, id_col, text, least, long_words) -> DataFrame:
    keyed = _keyed(docs, id_col, text)
    _, removed = _removed(keyed.select("key", "doc_id", "text"), least, long_words)
    # Whole rows travel once: the text is taken out of them afterwards.  A merge join at every size, as both sides grow.
    joined = keyed.select("key", "row").join(removed.hint("merge"), "key", "left")
    return _strip(joined.select("row", F.col("row")[text].alias("text"), "nos"), least, long_words)


def line_report(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: int = LEAST_LINES, long_words: int = LONG_WORDS,
) -> DataFrame:
    """One row per document: its chunks, those removed, the bytes removed and the SHA-256 of the text that is left."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = _deduped(docs, "doc_id", "text", least, long_words)
    left = F.coalesce("clean", F.col("row")["text"], F.lit(""))
    return out.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_chunks", "n_removed", "n_bytes_removed", F.sha2(left.cast("binary"), 256).alias("kept_sha256")
    )


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least: int = LEAST_LINES, long_words: int = LONG_WORDS,
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``; with ``drop_emptied`` documents go that nothing is left of."""
    out = _deduped(docs, id_col, text, least, long_words)
    if drop_emptied:
        out = out.where("clean IS NULL OR trim(clean) <> ''")
    value = lambda c: F.coalesce("clean", F.col("row")[c]) if c == text else F.col("row")[c]
    return out.select(*[value(c).alias(c) for c in docs.columns])
