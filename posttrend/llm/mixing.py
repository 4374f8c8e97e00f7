"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of source, language and topic; raking scales the cells' token weights to one target share
per source, per language and per topic in turn until the weights rest; a document is then taken ``budget * weight`` times
on average: the whole part always, the rest by a stable hash of its id, so that a run can be repeated.

Weights that rest have the wanted shares, unless no weights on the cells that exist can have them all; some such targets
are only neared without end, and after ``MOST_ROUNDS`` raking stops.  ``mixture`` and ``mix`` warn of a share that is
missed by more than ``MISSED``, and ``shares`` lists the wanted and the reached share of every value.

Cells are joined back by a broadcast only up to ``BROADCAST_CELLS`` cells, which is counted; beyond that by a shuffle
that adaptive execution splits where a cell is hot.

Cases: a NULL source, language or topic is the value ``?``; NULL and empty texts have no tokens: they do not count, and
are not taken; a NULL id is drawn by its text; repeated rows share their draw; an empty table gives an empty table;
further columns are ignored by ``mixture`` and pass through ``mix``.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posttrend.llm.common import SPACE_WORD
from posttrend.session import cut_lineage

DIMENSIONS = ("source", "lang", "topic")
MOST_ROUNDS = 400
TOLERANCE = 1e-9  # change of a weight in one round, as a part of the largest
MISSED = 1e-6
CHECK_EVERY = 4
TEMPERATURE = 0.5
BUDGET = 0.6
BROADCAST_CELLS = 100_000


def topic_of(text: Column) -> Column:
    """A coarse topic by the first rule that fits."""
    return (
        F.when(text.contains("icense"), "legal")
        .when(text.contains("@"), "contact")
        .when(text.contains(" | "), "table")
        .when(F.length(text) < 600, "brief")
        .when(text.isNotNull(), "prose")
    )


def _measured(docs: DataFrame, id_col: str, text: str, source: str, lang: str, topic: Column | None) -> DataFrame:
    body = F.col(f"`{text}`")
    name = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(body, F.lit(""))))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        name(F.col(f"`{source}`")).alias("source"), name(F.col(f"`{lang}`")).alias("lang"),
        name(topic_of(body) if topic is None else topic).alias("topic"),
        F.coalesce(F.regexp_count(body, F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))).alias("draw"),
    )


def targets(cells: DataFrame, dimension: str, temperature: float, fixed: dict[str, float] | None) -> DataFrame:
    """``value, target``: the shares in ``fixed``, or the present shares to the power of ``temperature``; adding up to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    if fixed is None:
        sums = sums.withColumn("part", F.pow(F.col("tokens").cast("double"), F.lit(temperature)))
    else:
        known = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])
        sums = sums.withColumn("part", F.coalesce(known[F.col(dimension)], F.lit(0.0)))
    total = sums.agg(F.sum("part")).first()[0] or 0.0
    return sums.select(dimension, (F.col("part") / F.lit(total) if total > 0 else F.lit(0.0)).alias("target"))


def rake(cells: DataFrame, wanted: dict[str, DataFrame], rounds: int = MOST_ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with ``weight``: weighted tokens have the wanted share in every dimension, as far
    as the cells that exist allow, and add up to the unweighted total."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    out = cells.withColumn("weight", F.lit(1.0)).withColumn("old", F.lit(0.0))
    for dimension, target in wanted.items():
        out = out.join(target.withColumnRenamed("target", f"t_{dimension}"), dimension)
    for r in range(rounds):
        out = out.withColumn("old", F.col("weight"))
        for dimension in wanted:
            now = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(dimension))
            out = out.withColumn("now", now)
            scale = F.when(F.col("now") > 0, F.col(f"t_{dimension}") * F.lit(total) / F.col("now")).otherwise(0.0)
            out = out.withColumn("weight", F.col("weight") * scale)
        if (r + 1) % CHECK_EVERY == 0 or r + 1 == rounds:
            out = cut_lineage(out)
            moved, most = out.agg(F.max(F.abs(F.col("weight") - F.col("old"))), F.max("weight")).first()
            if (moved or 0.0) <= tolerance * (most or 0.0):
                break
    return out.select(*cells.columns, "weight")


def _reached(raked: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """``dimension, value, target, reached`` of every value; a wanted value without tokens reaches 0."""
    total = F.lit(float(raked.agg(F.sum("tokens")).first()[0] or 0))
    parts = []
    for dimension, target in wanted.items():
        sums = raked.groupBy(dimension).agg(F.sum(F.col("tokens") * F.col("weight")).alias("mass"))
        share = F.when(total > 0, F.coalesce("mass", F.lit(0.0)) / total).otherwise(0.0)
        parts.append(target.join(sums, dimension, "left").select(F.lit(dimension).alias("dimension"), F.col(dimension).alias("value"), "target", share.alias("reached")))
    return reduce(DataFrame.unionAll, parts)


def _raked(measured, fixed, temperature, rounds) -> tuple[DataFrame, dict[str, DataFrame]]:
    cells = measured.where("n_tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    cells = cut_lineage(cells)
    wanted = {d: cut_lineage(targets(cells, d, temperature, (fixed or {}).get(d))) for d in DIMENSIONS}
    return rake(cells, wanted, rounds), wanted


def _weighted(docs, id_col, text, source, lang, topic, fixed, temperature, budget, rounds) -> DataFrame:
    measured = _measured(docs, id_col, text, source, lang, topic)
    raked, wanted = _raked(measured, fixed, temperature, rounds)
    missed = _reached(raked, wanted).agg(F.max(F.abs(F.col("target") - F.col("reached")))).first()[0] or 0.0
    if missed > MISSED:
        warnings.warn(f"no weights found that meet all targets: a share is missed by {missed:.2g}", stacklevel=3)
    weights = raked.drop("tokens")
    if weights.count() <= BROADCAST_CELLS:
        weights = F.broadcast(weights)
    expected = F.when(F.col("n_tokens") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0) * budget
    out = measured.join(weights, list(DIMENSIONS), "left").withColumn("expected", F.round(expected, 9))
    whole = F.floor("expected")
    return out.withColumn("copies", (whole + F.when(F.col("draw") < F.col("expected") - whole, 1).otherwise(0)).cast("long"))


def mixture(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: Column | None = None, fixed: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE,
    budget: float = BUDGET, rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """One row per document: its cell, tokens, the calibrated number of copies, those drawn, and ``kept``."""
    out = _weighted(docs, id_col, text, source, lang, topic, fixed, temperature, budget, rounds)
    return out.select(
        F.col("row")[id_col].alias("doc_id"), *DIMENSIONS, "n_tokens", F.round("expected", 6).alias("expected"), "copies",
        (F.col("copies") > 0).alias("kept"),
    )


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: Column | None = None, fixed: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE,
    budget: float = BUDGET, rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """The documents taken at least once, with all their columns and ``copies``."""
    out = _weighted(docs, id_col, text, source, lang, topic, fixed, temperature, budget, rounds).where("copies > 0")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "copies"], "copies")


def shares(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: Column | None = None, fixed: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE,
    rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """The share of tokens each source, language and topic should have and has: ``dimension, value, target, reached``."""
    return _reached(*_raked(_measured(docs, id_col, text, source, lang, topic), fixed, temperature, rounds))


def oracle() -> str:
    """The same in SQL, a round read from the one before it until the weights rest."""
    ctes = [
        r"""m AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang,
    coalesce(CASE WHEN contains(text, 'icense') THEN 'legal' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' | ') THEN 'table'
        WHEN length(text) < 600 THEN 'brief' WHEN text IS NOT NULL THEN 'prose' END, '?') AS topic,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0 AS draw FROM documents)""",
        "c0 AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS weight FROM m WHERE n_tokens > 0 GROUP BY ALL)",
        "tot AS (SELECT sum(tokens) AS total FROM c0)",
    ]
    for d in DIMENSIONS:
        ctes.append(
            f"t_{d} AS (SELECT {d}, pow(t, {TEMPERATURE}) / sum(pow(t, {TEMPERATURE})) OVER () AS target FROM (SELECT {d}, sum(tokens) AS t FROM c0 GROUP BY 1))"
        )
    # A round is the three scalings one inside the other; it reads the round before it until the weights rest.
    step = f"(SELECT source, lang, topic, tokens, round, weight AS old, weight FROM r WHERE round < {MOST_ROUNDS} AND NOT (round % {CHECK_EVERY} = 0 AND moved <= {TOLERANCE} * most))"
    for d in DIMENSIONS:
        step = (
            f"(SELECT source, lang, topic, tokens, round, old, weight * target * total / sum(tokens * weight) OVER (PARTITION BY {d}) AS weight "
            f"FROM {step} JOIN t_{d} USING ({d}), tot)"
        )
    ctes.append(
        "r AS (SELECT source, lang, topic, tokens, weight, 0 AS round, 1.0::DOUBLE AS moved, 1.0::DOUBLE AS most FROM c0 UNION ALL "
        "SELECT source, lang, topic, tokens, weight, round + 1, max(abs(weight - old)) OVER (), max(weight) OVER () FROM " + step + ")"
    )
    ctes.append("w AS (SELECT source, lang, topic, weight FROM r WHERE round = (SELECT max(round) FROM r))")
    ctes.append(
        f"e AS (SELECT m.*, round(CASE WHEN n_tokens > 0 THEN coalesce(weight, 0) ELSE 0 END * {BUDGET}, 9) AS x FROM m LEFT JOIN w USING (source, lang, topic))"
    )
    ctes.append("k AS (SELECT *, (floor(x) + CASE WHEN draw < x - floor(x) THEN 1 ELSE 0 END)::BIGINT AS copies FROM e)")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(x, 6) AS expected, copies, copies > 0 AS kept FROM k"
