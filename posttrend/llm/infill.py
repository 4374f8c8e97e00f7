"""Fill-in-middle: texts cut into lines, two cuts drawn per document, the three pieces put in a new order.

Work goes batch by batch through ``pyarrow.compute``: texts are split into a list array of units, the lists are
flattened beside the index of the text each unit came from, a unit's ordinal within its text tells its role (prefix,
middle or suffix), the units of a role are filtered out, gathered into lists again, and joined.  All draws come from
SHA-256 of the seed and the id, so a repeated task gives the same rows.  There is no shuffle; a task holds a few copies
of a slice of ``SLICE`` bytes, or of its longest text.

Cases: a NULL text is an empty one; empty texts, and texts in which a sentinel stands, stay as they are (``plain``);
a NULL id draws as an empty id; repeated rows and ids are turned row by row, alike; an empty table gives an empty
table; further columns stay out of the result, whatever their names.  Line ends other than ``\\n`` are characters of
their line.  One very long line is one unit.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 4 << 20


class Sentinels(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Draw(NamedTuple):
    """Per cent of documents that are cut, and of these the share in the order suffix, prefix, middle."""

    seed: int = 7
    cut_percent: int = 100
    spm_percent: int = 50


TEXT = pa.large_string()
OUT = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", TEXT)]
)
LAYOUT = "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(id_column: Column, seed: int) -> Column:
    """The first four 8-digit groups of SHA-256 of ``seed:id``, as unsigned numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    return F.struct(*parts)


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lines with their line ends, the index of the text each is from, and its ordinal there."""
    pieces = pc.split_pattern(texts, "\n")
    flat, parent = pieces.flatten(), pc.list_parent_indices(pieces).to_numpy()
    size = np.diff(pieces.offsets.to_numpy())
    ordinal = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    last = ordinal == np.repeat(size, size) - 1
    # Every piece but the last of its text was ended by a line end; a last one without characters is no unit.
    ends = pc.if_else(pa.array(last), pa.scalar("", TEXT), pa.scalar("\n", TEXT))
    lines = pc.binary_join_element_wise(flat, ends, pa.scalar("", TEXT))
    real = ~last | (pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0)
    return lines.filter(pa.array(real)), parent[real], ordinal[real]


def gathered(lines: pa.Array, parent: np.ndarray, chosen: np.ndarray, n_texts: int) -> pa.Array:
    """Per text the chosen units, one after the other."""
    counts = np.bincount(parent[chosen], minlength=n_texts)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), lines.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", TEXT))


def turned(ids: pa.Array, texts: pa.Array, h: dict[str, np.ndarray], draw: Draw, marks: Sentinels) -> pa.RecordBatch:
    """One row per text: its number of units, its form, the sizes of two pieces, and the output."""
    lines, parent, ordinal = units(texts)
    n = np.bincount(parent, minlength=len(texts)).astype(np.int64)
    one, two = h["h1"] % (n + 1), h["h2"] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    prefix, middle, suffix = (
        gathered(lines, parent, chosen, len(texts))
        for chosen in (ordinal < low[parent], (ordinal >= low[parent]) & (ordinal < high[parent]), ordinal >= high[parent])
    )
    plain = pc.equal(pc.binary_length(texts), 0)
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    plain = pc.or_(plain, pa.array(h["h3"] % 100 >= draw.cut_percent))
    spm = pa.array(h["h4"] % 100 < draw.spm_percent)
    p, s, m, none = (pa.scalar(x, TEXT) for x in (*marks, ""))
    psm_out = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_out = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    size = lambda piece: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(piece))
    return pa.record_batch(
        [ids, pa.array(n), pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")), size(prefix), size(middle),
         pc.if_else(plain, texts, pc.if_else(spm, spm_out, psm_out))],
        schema=OUT,
    )


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE`` bytes of text, at least one row each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(size):
        before = size[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(size, before + SLICE, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def fill_in_middle(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", draw: Draw = Draw(), marks: Sentinels = Sentinels(),
) -> DataFrame:
    """One row per document: ``id_col``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts = pc.fill_null(part.column("text").cast(TEXT), pa.scalar("", TEXT))
                drawn = part.column("h")
                h = {f.name: drawn.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(drawn.type)}
                out = turned(part.column("id"), texts, h, draw, marks)
                yield out.set_column(5, "output", out.column("output").cast(pa.string()))

    one = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = one.withColumn("h", draws(F.col("id"), draw.seed)).mapInArrow(run, LAYOUT)
    return rows.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text an output was made of: its pieces cut out again at the sentinels and put back in order."""

    def between(first: str, then: str) -> Column:
        return F.substring_index(F.substring_index(output, then, 1), first, -1)

    middle = F.substring_index(output, marks.middle, -1)
    psm = F.concat(between(marks.prefix, marks.suffix), middle, between(marks.suffix, marks.middle))
    spm = F.concat(between(marks.prefix, marks.middle), middle, between(marks.suffix, marks.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, **options) -> DataFrame:
    """``fill_in_middle`` with SHA-256 of the output and of the text restored from it instead of the output."""
    rows = fill_in_middle(docs, **options)
    back = restored(F.col("output"), F.col("form"), options.get("marks", Sentinels()))
    hashes = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return rows.select("*", *hashes).drop("output")


def oracle(draw: Draw = Draw(), marks: Sentinels = Sentinels()) -> str:
    p, s, m = marks
    groups = ", ".join(f"('0x' || substr(x, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    held = " OR ".join(f"contains(t, '{mark}')" for mark in marks)
    joined = lambda a, b: f"array_to_string(list_slice(u, {a}, {b}), '')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    sha256('{draw.seed}:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, {groups} FROM d),
c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi FROM w),
p AS (SELECT doc_id, t, n, {joined('1', 'lo')} AS pre, {joined('lo + 1', 'hi')} AS mid, {joined('hi + 1', 'n')} AS suf,
    CASE WHEN t = '' OR {held} OR h3 % 100 >= {draw.cut_percent} THEN 'plain'
         WHEN h4 % 100 < {draw.spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid
        ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
