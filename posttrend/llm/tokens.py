"""Token counts per field and section, by the places of tokens in the whole document.

A document's fields are joined and encoded once, since a text cut in parts has other tokens at the cuts.  Byte-level
tokens put together give the document's bytes, so the running sum of their lengths is their place.  Fields, and the
sections of each, tile the same bytes: a section is a line with its line end, a field's last section has the separator
too.  Joining both interval lists says which tokens lie within one section and which cross a boundary.

A crossing token goes by ``rule``: ``start`` to the section with its first byte, ``most`` to the one with most of its
bytes (the earliest if equal); ``token_share`` always has the exact division by bytes.

Cases: a NULL or empty field takes part as an empty section with its separator only, and a document without any text
has no tokens but still its sections; repeated rows are counted one by one; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's own way to cut a text in words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = b"\n\n"
RULES = ("start", "most")


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    """One per Python worker: the encoding and every token's length in bytes."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def layout(fields: list[str | None]) -> tuple[bytes, np.ndarray, list[tuple[int, int]]]:
    """The joined document, the ends of its sections in bytes, and each section's field and number."""
    parts, ends, names, at = [], [], [], 0
    for f, value in enumerate(fields):
        body = (value or "").encode()
        lines = np.flatnonzero(np.frombuffer(body, np.uint8) == 10) + 1
        cuts = lines.tolist()
        if not cuts or cuts[-1] < len(body):
            cuts.append(len(body))
        body += SEPARATOR if f + 1 < len(fields) else b""
        cuts[-1] = len(body)
        ends.extend(at + c for c in cuts)
        names.extend((f, s) for s in range(len(cuts)))
        parts.append(body)
        at += len(body)
    return b"".join(parts), np.array(ends, np.int64), names


def attribute(token_end: np.ndarray, section_end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per section: tokens by ``rule``, crossing tokens that touch it, and tokens divided by bytes."""
    n = len(section_end)
    begin = np.concatenate([[0], token_end[:-1]]) if len(token_end) else token_end
    section_begin = np.concatenate([[0], section_end[:-1]])
    first = np.searchsorted(section_end, begin, side="right")
    last = np.searchsorted(section_end, token_end - 1, side="right")
    inside = first == last
    owned = np.bincount(first[inside], minlength=n)
    share = owned.astype(float)
    crossing = np.zeros(n, np.int64)
    for t in np.flatnonzero(~inside).tolist():
        touched = np.arange(first[t], last[t] + 1)
        size = np.minimum(section_end[touched], token_end[t]) - np.maximum(section_begin[touched], begin[t])
        share[touched] += size / (token_end[t] - begin[t])
        crossing[touched[size > 0]] += 1
        owned[touched[0] if rule == "start" else touched[int(np.argmax(size))]] += 1
    return owned, crossing, share


def count_tokens(
    docs: DataFrame, fields: tuple[str, ...] = ("text",), *, id_col: str = "doc_id", rule: str = "start",
    vocabulary: str = VOCABULARY, pattern: str = PATTERN,
) -> DataFrame:
    """One row per document, field and section: its place in the field in characters, and its tokens.

    ``begin`` and ``end`` leave line ends and separators out of the last section only where the field has none.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoder(vocabulary, pattern)
        for batch in batches:
            ids = batch.column("__id").to_pylist()
            values = [batch.column(f"__f{i}").to_pylist() for i in range(len(fields))]
            out: list[list] = [[] for _ in range(8)]
            held = 0
            for doc, *parts in zip(ids, *values):
                body, ends, names = layout(parts)
                tokens = np.asarray(encoding.encode_ordinary(body.decode()), np.int64)
                token_end = np.cumsum(lengths[tokens])
                owned, crossing, share = attribute(token_end, ends, rule)
                # Characters are bytes that do not continue another.
                chars = np.concatenate([[0], np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)])[np.concatenate([[0], ends])]
                n = len(names)
                field = np.fromiter((f for f, _ in names), np.int64, n)
                origin = chars[:-1][np.searchsorted(field, field)]
                columns = [doc] * n, field.tolist(), [s for _, s in names], chars[:-1] - origin, chars[1:] - origin, owned, crossing, np.round(share, 9)
                for column, new in zip(out, columns):
                    column.extend(new)
                held += n
                if held >= 50_000:
                    yield _batch(out, fields)
                    out, held = [[] for _ in range(8)], 0
            if held:
                yield _batch(out, fields)

    picked = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("__id"), *[F.col(f"`{f}`").cast("string").alias(f"__f{i}") for i, f in enumerate(fields)]
    )
    return picked.mapInArrow(
        rows, "doc_id long, field string, section long, begin long, end long, n_tokens long, n_crossing long, token_share double"
    )


def _batch(out: list[list], fields: tuple[str, ...]) -> pa.RecordBatch:
    doc, field, *rest = out
    kinds = [pa.int64()] * 5 + [pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array([fields[f] for f in field], pa.string()), *[pa.array(c, k) for c, k in zip(rest, kinds)]],
        names=["doc_id", "field", "section", "begin", "end", "n_tokens", "n_crossing", "token_share"],
    )
