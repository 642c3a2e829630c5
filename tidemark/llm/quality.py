"""Quality scores by logistic regression over hashed word n-grams.

Texts are cut into runs of letters and digits and runs of other signs. Features are single words,
neighbouring pairs, and runs of one to three word *shapes* (case, length class, repetition of an
earlier word, or the signs themselves); each is hashed into a fixed number of places. A text's
vector holds every feature's share of its features, so a score is a sparse dot product and does
not grow with length.

Weights come from follow-the-regularised-leader updates with a rate per place, taken over a
bounded sample of labelled rows in a fixed pseudo-random order. The model is one vector of
``2**BITS`` numbers, which is all that is sent to the executors.

Defined results: null and empty texts, and texts of white space, have no features and get the
score of the bias; repeated rows are scored one by one; other columns are kept; without any
labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import bounded_sample
from tidemark.llm.words import ALNUM, WHITE, hash_spans, mix, stream, text_blocks, word_spans

BITS = 20
#: Most labelled rows that the fit reads.
SAMPLE_ROWS = 5_000
EPOCHS = 3
RATE, SMOOTH, L1, L2 = 0.6, 1.0, 0.002, 0.02
#: Factor on feature shares, which are small numbers.
SCALE = 24.0
REJECT_BELOW = 0.3

_CLASSES = np.where(WHITE, 0, np.where(ALNUM, 1, 2)).astype(np.uint8)
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_F = stream(331, 8) | np.uint64(1)


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A small code of how each token looks; tokens of signs keep their hash."""
    sizes = ends - starts

    def inside(table: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(table[data])])
        return upto[ends] - upto[starts]

    upper, digit = inside(_UPPER), inside(_DIGIT)
    case = np.where(upper == 0, 0, np.where(upper == sizes, 3, np.where(upper == 1, 1, 2)))
    length = np.minimum(np.log2(sizes + 1).astype(np.int64), 5)
    code = case * 16 + length + np.where(digit > 0, 64, 0)
    again = np.zeros(len(hashes), np.int64)
    for back in (3, 2, 1):
        if len(hashes) > back:
            again[back:] = np.where(hashes[back:] == hashes[:-back], back, again[back:])
    shape = mix((code + 256 * again).astype(np.uint64))
    return np.where(_CLASSES[data[starts]] == 2, hashes, shape)


def _places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all texts, text after text, and where each text's features begin."""
    starts, ends, at = word_spans(data, bounds, _CLASSES)
    words = hash_spans(data, starts, ends)
    shapes = _shapes(data, starts, ends, words)
    n = len(words)
    out = np.zeros((n, 5), np.uint64)
    kept = np.zeros((n, 5), bool)
    room = np.zeros(n, np.int64)  # tokens left in the text from here
    room[:] = np.repeat(at[1:], np.diff(at)) - np.arange(n)

    def grams(column: int, values: np.ndarray, width: int) -> None:
        total = np.zeros(n, np.uint64)
        for place in range(width):
            total[: n - place] += values[place:] * _F[place]
        out[:, column] = mix(total + np.uint64(column + 1))
        kept[:, column] = room >= width

    for column, (values, width) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        if n:
            grams(column, values, width)
    many = kept.sum(axis=1)
    upto = np.concatenate([[0], np.cumsum(many)])
    return (out[kept] >> np.uint64(64 - BITS)).astype(np.int64), upto[at]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, _, data, bounds in text_blocks(batch.column("text")):
            places, at = _places(data, bounds)
            for i in range(len(bounds) - 1):
                place, count = np.unique(places[at[i] : at[i + 1]], return_counts=True)
                share = count / max(count.sum(), 1)
                rows.append((place.astype(np.int32).tobytes(), share.astype(np.float32).tobytes()))
        place, share = (pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), place, share], names=["doc_id", "label", "place", "share"]
        )


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights of each place, with the bias at the end."""
    size = (1 << BITS) + 1
    lean, seen, weights = np.zeros(size), np.zeros(size), np.zeros(size)

    def weight(at: np.ndarray) -> np.ndarray:
        z = lean[at]
        w = -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(seen[at])) / RATE + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            places, shares, label = examples[k]
            at, x = np.append(places, size - 1), np.append(shares * SCALE, 1.0)
            w = weight(at)
            slope = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(seen[at] + slope**2) - np.sqrt(seen[at])) / RATE
            lean[at] += slope - step * w
            seen[at] += slope**2
    touched = np.flatnonzero(seen)
    weights[touched] = weight(touched)
    return weights


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by("doc_id")
    columns = (table.column(c).to_pylist() for c in ("place", "share", "label"))
    examples = [
        (np.frombuffer(p, np.int32).astype(np.int64), np.frombuffer(s, np.float32).astype(np.float64), float(y))
        for p, s, y in zip(*columns, strict=True)
    ]
    return pa.table({"weights": [follow_leader(examples).astype(np.float32).tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learnt from at most about ``rows`` rows of ``labels`` (doc_id, label 0 or 1)."""
    chosen = bounded_sample(labels.select("doc_id", F.col("label").cast("int").alias("label")).dropna(), "doc_id", rows)
    # The sample's size is bounded, so it may be broadcast; the texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    features = sample.mapInArrow(_features, "doc_id long, label int, place binary, share binary")
    model = features.groupBy().applyInArrow(_fit, "weights binary").collect()
    if not model:
        return np.zeros((1 << BITS) + 1, np.float32)
    return np.frombuffer(model[0]["weights"], np.float32)


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    weights = model.value
    for batch in batches:
        scores = np.zeros(batch.num_rows)
        for first, last, data, bounds in text_blocks(batch.column("text")):
            places, at = _places(data, bounds)
            upto = np.concatenate([[0.0], np.cumsum(weights[places], dtype=np.float64)])
            many = np.maximum(np.diff(at), 1)
            scores[first:last] = (upto[at[1:]] - upto[at[:-1]]) / many * SCALE + weights[-1]
        yield batch.append_column("score", pa.array(1.0 / (1.0 + np.exp(-np.clip(scores, -35, 35)))))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with a column ``score`` between 0 and 1; a column of that name is replaced."""
    plain = docs.drop("score")
    model = docs.sparkSession.sparkContext.broadcast(weights)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(partial(_score, model=model), f"{fields}, score double")
