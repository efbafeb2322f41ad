"""Quality of whole texts by a Naive Bayes support vector machine.

A text is a set of indicators: hashed word n-grams, and n-grams over the shapes
of its words ("Thing," is ``Aa,``; a word that repeats the one before is a shape
of its own). Each indicator is scaled by the log ratio of its smoothed counts
in good and bad texts, each text is scaled to length one, and a linear model
with hinge loss is fitted by dual coordinate descent. A logistic curve over the
margins of texts that were not fitted turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.buffers import gram_hashes, mix, slices, span_hashes, utf8, word_spans

WORD_BITS, SHAPE_BITS = 17, 15
WORD_GRAMS, SHAPE_GRAMS = 2, 3
DIMENSIONS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
FIT_ROWS = 8192
_REPEAT = np.uint64(0x5EED)

#: Byte to lower case, and to its class in a shape; 0 is white space.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER[[0x20, *range(0x09, 0x0E)]] = 0
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[0x41:0x5B] = ord("A")
SHAPE[0x61:0x7B] = ord("a")
SHAPE[0x80:] = ord("a")
SHAPE[0x30:0x3A] = ord("0")
SHAPE[[0x20, *range(0x09, 0x0E)]] = 0


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every different indicator of each text, in row order."""
    lower = LOWER[data]
    starts, ends, rows = word_spans(lower != 0, offsets)
    words = span_hashes(lower, starts, ends)
    shapes = SHAPE[data]
    # Runs of one class are one step of a shape.
    keep = np.ones(len(shapes), bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    shaped = span_hashes(shapes[keep], place[starts], place[ends])
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    shaped[same] = _REPEAT
    found = []
    for hashes, sizes, bits, base in (
        (words, WORD_GRAMS, WORD_BITS, 0),
        (shaped, SHAPE_GRAMS, SHAPE_BITS, 1 << WORD_BITS),
    ):
        for size in range(1, sizes + 1):
            grams = mix(gram_hashes(hashes, size) + np.uint64(size))
            whole = rows[: len(grams)] == rows[size - 1 :][: len(grams)]
            number = (grams[whole] >> np.uint64(64 - bits)).astype(np.int64) + base
            found.append((rows[: len(grams)][whole] << 20) | number)
    keys = np.unique(np.concatenate(found))
    return keys >> 20, keys & ((1 << 20) - 1)


@dataclass(frozen=True)
class QualityModel:
    """Per indicator the scaled weight and the square of its scale; bias and curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.bias)
        for a, b in slices(offsets):
            rows, numbers = indicators(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            total = np.bincount(rows, self.weight[numbers], b - a)
            length = np.sqrt(np.bincount(rows, self.square[numbers], b - a))
            out[a:b] += total / np.maximum(length, 1e-12)
        return out

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -60, 60)))


def dual_coordinate_descent(
    texts: list[np.ndarray], scale: np.ndarray, signs: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; ``cost`` bounds each dual."""
    w, bias = np.zeros(len(scale)), 0.0
    values = [scale[t] for t in texts]
    values = [v / max(np.sqrt(v @ v), 1e-12) for v in values]
    dual = np.zeros(len(texts))
    norm = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(texts)):
            t, v, y = texts[i], values[i], signs[i]
            slope = y * (w[t] @ v + bias) - 1
            new = min(max(dual[i] - slope / norm[i], 0.0), cost[i])
            if new != dual[i]:
                w[t] += (new - dual[i]) * y * v
                bias += (new - dual[i]) * y
                dual[i] = new
    return w, bias


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | x), by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(p - y) @ x + 1e-2 * a, (p - y).sum() + 1e-2 * b])
        h = p * (1 - p)
        cross = h @ x
        hessian = np.array([[h @ (x * x) + 1e-2, cross], [cross, h.sum() + 1e-2]])
        step = np.linalg.solve(hessian, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def one_label(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id, label``: ids whose rows all say 0 or all say 1; others teach nothing."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    return (
        known.where("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where("label = most")
        .select("id", "label")
    )


def bounded_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the same ones every time."""
    return labels.orderBy(F.xxhash64("id"), "id").limit(rows)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    cost: float = 4.0,
) -> QualityModel:
    """Learn from at most ``fit_rows`` labelled documents (a documented bound).

    ``labels`` holds ``id_col`` and ``label_col`` (0 or 1). Null labels, ids
    with both labels and labels without a document teach nothing. With labels
    of one kind only, or none, the model scores every text alike. The driver
    holds the indicators of the sample, at most DIMENSIONS numbers a text.
    """
    sample = bounded_sample(one_label(labels, id_col, label_col), fit_rows)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found: list[bytes] = []
            for a, b in slices(offsets):
                rows, numbers = indicators(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cuts = np.searchsorted(rows, np.arange(b - a + 1))
                numbers = numbers.astype(np.int32)
                found += [numbers[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["label", "numbers"]
            )

    # The sample is bounded by fit_rows, so it can be copied to every task.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    taught = (
        texts.join(F.broadcast(sample), "id")
        .select("label", "text")
        .mapInArrow(collect, "label int, numbers binary")
        .toArrow()
    )
    y = np.array(taught.column("label").to_pylist(), np.float64)
    found = [np.frombuffer(b, np.int32) for b in taught.column("numbers").to_pylist()]
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        none = np.zeros(DIMENSIONS, np.float32)
        return QualityModel(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))
    # The same order whatever the tasks were.
    order = sorted(range(len(y)), key=lambda i: (y[i], found[i].tobytes()))
    order = np.random.default_rng(1).permutation(np.array(order))
    y, found = y[order], [found[i] for i in order]
    held = np.arange(len(y)) % 4 == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held = np.zeros(len(y), bool)
    taught_rows = np.flatnonzero(~held)

    def counts(label: int) -> np.ndarray:
        rows = [found[i] for i in taught_rows if y[i] == label]
        return 1 + np.bincount(np.concatenate([np.zeros(0, np.int32), *rows]), minlength=DIMENSIONS)

    good, bad = counts(1), counts(0)
    scale = np.log(good / good.sum()) - np.log(bad / bad.sum())
    signs = np.where(y == 1, 1.0, -1.0)
    # Both classes weigh the same.
    share = y[taught_rows].mean()
    costs = np.where(y == 1, cost / (2 * share), cost / (2 * (1 - share)))
    w, bias = dual_coordinate_descent(
        [found[i] for i in taught_rows], scale, signs[taught_rows], costs[taught_rows]
    )
    squares = scale * scale
    seen = np.flatnonzero(held) if held.any() else taught_rows
    margins = np.array(
        [(scale[found[i]] @ w[found[i]]) / max(np.sqrt(squares[found[i]].sum()), 1e-12) + bias for i in seen]
    )
    slope, shift = logistic_curve(margins, y[seen])
    return QualityModel((scale * w).astype(np.float32), squares.astype(np.float32), bias, slope, shift)


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability that a text is good, from 0 to 1.

    Null counts as the empty text, which is scored by the bias alone. A column
    called ``name`` is replaced. Rows are scored each for itself, in any number.
    """

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.probabilities(model.margins(*utf8(texts))), pa.float64())

    udf = F.arrow_udf(score, "double")
    return docs.withColumn(name, udf(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
