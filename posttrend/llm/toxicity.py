"""Toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks.

A text is what stands between white space, as strings without marks (``string_kernel``).  Labels belong to texts, but
an insult is one string of many: strings that stand in more texts of label 1 than of label 0 begin as examples of label
1, then every round takes from each text the string the machine values most, as the witness of a label 1 or as a hard
example of label 0, and fits again.  A logistic function, fitted on texts kept back for it, turns the best value of a
text and the shares of its strings above a few levels into a score.

Training takes at most ``Options.most`` labelled rows per class, those with the smallest hashes of their ids; all that
reaches the driver is a few strings of at most 16 symbols and a few numbers per such row.  Scoring is one pass over all
texts without a shuffle; a task holds some hundred times a slice of a megabyte, or its longest text.

Cases: a NULL text is an empty one and, like a text without letters, has no string; its value is that of the empty
string.  Marks are left out, so ``i.d.i.o.t`` is a whole string, and so are single characters in a row.  Repeated rows
are scored alike; an id that is labelled more than once has its largest label, and of rows sharing an id the largest
text is trained on.  NULL ids and NULL labels train nothing.  Without rows of both labels every text gets the share of
label 1 among the labelled rows, 0 where there are none.  An empty table gives an empty table; further columns stay
out, whatever their names.  Of strings with the same value the first in the text is the witness.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import stored
from posttrend.llm.string_kernel import CODES, Kernel, fit_logistic, fit_svm, search, strings_of
from posttrend.llm.words import slices

# A string of its start and one letter has no triple.
SHORTEST = 3


class Options(NamedTuple):
    """``most``: labelled rows of label 0 and 1 to train on; ``held_back``: one in so many only for the last fit.
    ``candidates``: strings of label 1 to begin with; ``common`` and ``drawn``: strings of label 0, the most frequent
    and those with the smallest hashes.  ``c``: weight of the loss, ``rounds``: fits, ``landmarks``: strings of each of
    four kinds that the kernel is expanded in."""

    most: tuple[int, int] = (5000, 2500)
    held_back: int = 4
    candidates: int = 400
    common: int = 1000
    drawn: int = 3000
    c: float = 500.0
    rounds: int = 4
    landmarks: tuple[int, int, int, int] = (128, 64, 128, 64)
    levels: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75)


class Model(NamedTuple):
    """A value per triple of symbols, the machine's bias, and the last fit; ``constant``: the score of all texts."""

    codes: np.ndarray
    values: np.ndarray
    bias: float
    levels: tuple[float, ...]
    slopes: np.ndarray
    offset: float
    constant: float | None = None

    def measures(self, best: np.ndarray, reaching: np.ndarray, strings: np.ndarray) -> np.ndarray:
        share = 1000 * reaching / np.maximum(1, strings)[:, None]
        return np.column_stack([best + self.bias, np.log1p(share)])

    def searched(self, weights: np.ndarray, texts: list[bytes]):
        strings = strings_of(texts)
        # The value of a level is reached where the machine's value, bias included, does.
        return strings, search(strings, weights, [max(x - self.bias, 0.05) for x in self.levels], len(texts))

    def per_triple(self) -> np.ndarray:
        weights = np.zeros(CODES)
        weights[self.codes] = self.values
        return weights


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, o: Options) -> DataFrame:
    """(id, label, held_back, text) of the labelled rows to train on, stored."""
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isin(0, 1))
    known = known.groupBy(F.col(f"`{id_col}`").cast("bigint").alias("id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    drawn = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in enumerate(o.most)]
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # At most sum(o.most) rows of two numbers.
    rows = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), "id").groupBy("id", "label").agg(F.max("text").alias("text"))
    return stored(rows.withColumn("held_back", F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(o.held_back)) == 0), "toxicity")


def _string_counts(sample: DataFrame) -> DataFrame:
    """In how many texts of each label a string stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            strings = strings_of(texts)
            long = strings.size >= SHORTEST
            spelled = pa.array(strings.spelled(), pa.string()).filter(pa.array(long))
            rows = pa.table([pa.array(strings.text[long]), spelled], names=["at", "string"])
            rows = rows.group_by(["at", "string"]).aggregate([])
            label = part.column("label").take(rows.column("at").combine_chunks())
            yield pa.record_batch([rows.column("string").combine_chunks(), label], names=["string", "label"])

    pairs = sample.where("NOT held_back").select("text", "label").mapInArrow(run, "string string, label int")
    return pairs.groupBy("string").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))


def _witnesses(sample: DataFrame, model: Model) -> list:
    """The string each text is valued for, and its measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.per_triple()
        for part, texts in slices(batches, "text"):
            strings, found = model.searched(weights, texts)
            spelled = np.array([*strings.spelled(), ""], object)[found.who]
            x = model.measures(found.best, found.reaching, found.strings)
            yield pa.record_batch(
                [part.column("label"), part.column("held_back"), pa.array(spelled, pa.string()), pa.array(list(x))],
                names=["label", "held_back", "string", "x"],
            )

    layout = "label int, held_back boolean, string string, x array<double>"
    return sample.select("label", "held_back", "text").mapInArrow(run, layout).collect()


def _rising(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A logistic function that falls with none of the measures: those that would lower it are left out."""
    kept, slopes = list(range(x.shape[1])), np.zeros(x.shape[1])
    while True:
        some, offset = fit_logistic(x[:, kept], y)
        if not len(kept) or some.min() >= 0:
            slopes[kept] = some
            return slopes, offset
        kept.pop(int(some.argmin()))


def _shares(weights) -> np.ndarray:
    weights = np.asarray(list(weights), float)
    return weights / (2 * weights.sum()) if len(weights) else weights


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
    options: Options = Options(),
) -> Model:
    """A model from the rows of ``labels`` (all of them may be used for training; leave out those to be held out)."""
    o = options
    sample = _sample(docs, labels, id_col, text, label, o)
    sizes = {(r["label"], r["held_back"]): r["n"] for r in sample.groupBy("label", "held_back").agg(F.count("*").alias("n")).collect()}
    n0, n1 = (sum(n for (y, _), n in sizes.items() if y == want) for want in (0, 1))
    fit0, fit1 = sizes.get((0, False), 0), sizes.get((1, False), 0)
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), 0.0, o.levels, np.zeros(0), 0.0, n1 / max(1, n0 + n1))
    if not fit0 or not fit1:
        return nothing
    counts = stored(_string_counts(sample), "toxicity-strings")
    lift = F.log(((F.col("n1") + 0.5) * (fit0 + 1)) / ((F.col("n0") + 0.5) * (fit1 + 1)))
    rated = counts.select("string", (F.col("n1") * lift).alias("rate")).where("rate > 0")
    rated = {r["string"]: r["rate"] for r in rated.orderBy(F.col("rate").desc(), "string").limit(o.candidates).collect()}
    plain = counts.where("n0 > 0")
    common = plain.orderBy(F.col("n0").desc(), "string").limit(o.common).collect()
    drawn = plain.orderBy(F.xxhash64("string"), "string").limit(o.drawn).collect()
    ordinary = list(dict.fromkeys(r["string"] for r in [*drawn, *common]))
    if not rated or not ordinary:
        return nothing
    found: Counter[str] = Counter()
    hard: Counter[str] = Counter()
    model = nothing
    for step in range(o.rounds):
        first, then, against, calm = o.landmarks
        most = lambda counter, n: [w for w, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:n]]
        kernel = Kernel(list(dict.fromkeys([*list(rated)[:first], *most(found, then), *most(hard, against), *ordinary[:calm]])))
        words = [*rated, *found, *hard, *ordinary]
        weight = np.concatenate([_shares(rated.values()), _shares(found.values()), _shares(hard.values()), _shares([1] * len(ordinary))])
        y = np.concatenate([np.ones(len(rated) + len(found)), -np.ones(len(hard) + len(ordinary))])
        v, bias = fit_svm(kernel.map(words), y, weight, o.c)
        model = Model(kernel.codes, kernel.per_triple(v), bias, o.levels, np.zeros(0), 0.0)
        rows = _witnesses(sample, model)
        mine = lambda want: Counter(r["string"] for r in rows if r["label"] == want and not r["held_back"] and r["string"])  # noqa: E731, B023
        found = mine(1)
        for string, n in mine(0).items():
            hard[string] = max(hard[string], n)
    back = [r for r in rows if r["held_back"]]
    if len({r["label"] for r in back}) < 2:
        back = rows
    slopes, offset = _rising(np.array([r["x"] for r in back]), np.array([r["label"] for r in back]))
    return model._replace(slopes=slopes, offset=offset)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``score``, the machine's best ``value`` and the ``string`` that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.per_triple()
        for part, texts in slices(batches, "text"):
            strings, found = model.searched(weights, texts)
            witness = np.array(strings._replace(
                begin=strings.begin[found.who], size=strings.size[found.who], text=strings.text[found.who]
            ).spelled() if len(strings.size) else [""] * len(texts), object)
            witness[found.who < 0] = None
            if model.constant is not None:
                scores = np.full(len(texts), model.constant)
            else:
                x = model.measures(found.best, found.reaching, found.strings)
                scores = 1 / (1 + np.exp(-np.clip(x @ model.slopes + model.offset, -500, 500)))
            yield pa.record_batch(
                [part.column("id"), pa.array(scores), pa.array(found.best + model.bias), pa.array(witness, pa.string())],
                names=["id", "score", "value", "string"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "id bigint, score double, value double, string string").withColumnRenamed("id", id_col)


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept from training: CRC-32 of its id as text leaves 1 when divided by 3; a NULL id is not."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 3 == 1, F.lit(False))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, options: Options = Options()) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    model = train(docs, labels.where(~held_out()), options=options)
    rows = score(docs, model)
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
