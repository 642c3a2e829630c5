"""Language of a text by unigram piece models summed over all segmentations.

The pieces are a fixed public vocabulary. Each language gives every piece a probability; a word's
probability is the sum over all ways to cut it into pieces, found by a forward pass, and a text's
is the product over its words. Probabilities are fitted by expectation maximisation: forward and
backward passes give the expected count of every piece in the sample's words.

A word is a run of ASCII letters and characters beyond ASCII, in lower case for A-Z, with a blank
before it, which is where the vocabulary marks beginnings of words. Distinct words of a block of
texts are scored once, many of one length at a time; words of more than ``LONGEST`` bytes, whose
probability can fall below the smallest double, one at a time in logarithms, place by place.

Defined results: null text and text without a letter is ``und`` with score 0; other texts get the
language with the highest posterior under equal priors, ties going to the smaller name; without
any learned language every text is ``und``; repeated rows are scored one by one.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import bounded_sample
from tidemark.llm.words import FOLD, hash_spans, mix, stream, text_blocks, word_spans

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UNKNOWN = "und"
#: Documents of each language that the fit reads, about.
SAMPLE_ROWS = 400
ROUNDS = 3
#: Bytes of the longest word summed in plain doubles; longer ones are summed in logarithms.
LONGEST = 40
#: Least probability of any piece; keeps a word's probability above the smallest double.
FLOOR = 1e-7
#: Part of the probability that the pieces of all languages share.
SHARED = 0.02
_BLOCK = 1 << 23
_WORDS_AT_ONCE = 1 << 15

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = 1
_POWERS = np.cumprod(np.array([1] + [0x9E3779B97F4A7C15] * 255, np.uint64))
_BYTES = stream(17, 256)


def _key(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of bytes."""
    out = np.zeros(len(rows), np.uint64)
    for column in range(rows.shape[1]):
        out = out * _POWERS[1] + _BYTES[rows[:, column]]
    return out


class Pieces:
    """Numbers of vocabulary pieces, looked up by hash in one array access or two."""

    BITS = 21

    def __init__(self, ranks: str):
        with open(ranks, "rb") as lines:
            pieces = {base64.b64decode(line.split()[0]) for line in lines}
        pieces |= {bytes([b]) for b in range(256)}
        self.pieces = sorted({p.translate(bytes(FOLD)) for p in pieces if b" " not in p[1:]})
        self.keys = np.array([_key(np.frombuffer(p, np.uint8)[None, :])[0] for p in self.pieces], np.uint64)
        assert len(np.unique(self.keys)) == len(self.keys)
        n = len(self.keys)
        self.keys = np.append(self.keys, np.uint64(0))  # entry n never matches: its length is 0
        self.widths = np.array([len(p) for p in self.pieces] + [0])
        self.lengths = np.unique(self.widths[:-1])
        self.first = np.full(1 << self.BITS, n, np.int32)
        self.second = np.full(1 << self.BITS, n, np.int32)
        slots = self._slots(self.keys[:-1])
        for number in range(n):
            table, slot = (self.first, slots[0]) if self.first[slots[0][number]] == n else (self.second, slots[1])
            assert table[slot[number]] == n, "two pieces share both places"
            table[slot[number]] = number

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(keys)
        return mixed >> np.uint64(64 - self.BITS), mixed & np.uint64((1 << self.BITS) - 1)

    def find(self, keys: np.ndarray, width: int) -> np.ndarray:
        """Number of each key's piece, or -1."""
        out = np.full(len(keys), -1, np.int32)
        a, b = self._slots(keys)
        for table, slot in ((self.first, a), (self.second, b)):
            number = table[slot]
            good = (self.keys[number] == keys) & (self.widths[number] == width)
            out[good] = number[good]
        return out


@functools.lru_cache(maxsize=1)
def vocabulary(ranks: str) -> Pieces:
    return Pieces(ranks)


def _matches(vocab: Pieces, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, rows, pieces) of every piece found in words of one length, by end."""
    n, length = rows.shape
    prefix = np.zeros((length + 1, n), np.uint64)
    for j in range(length):
        prefix[j + 1] = prefix[j] * _POWERS[1] + _BYTES[rows[:, j]]
    for end in range(1, length + 1):
        for begin in (end - vocab.lengths[vocab.lengths <= end][::-1]).tolist():
            number = vocab.find(prefix[end] - prefix[begin] * _POWERS[end - begin], end - begin)
            at = np.flatnonzero(number >= 0)
            if len(at):
                yield begin, end, at, number[at]


def _long_matches(vocab: Pieces, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and pieces of every piece found in one word, by end."""
    keys, found = np.zeros(len(word), np.uint64), []
    for width in range(1, min(int(vocab.lengths[-1]), len(word)) + 1):
        keys = keys[: len(word) - width + 1] * _POWERS[1] + _BYTES[word[width - 1 :]]
        number = vocab.find(keys, width)
        begins = np.flatnonzero(number >= 0)
        found.append((begins, begins + width, number[begins]))
    begins, ends, numbers = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.argsort(ends, kind="stable")
    return begins[order], ends[order], numbers[order]


def _log_sums(size: int, into: np.ndarray, out_of: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log sum over all paths from place 0 to each place, by steps in rising order of ``into``."""
    sums = np.full((size + 1, logs.shape[1]), -np.inf)
    sums[0] = 0.0
    at = np.searchsorted(into, np.arange(size + 2))
    for place in range(1, size + 1):
        steps = slice(at[place], at[place + 1])
        terms = sums[out_of[steps]] + logs[steps]
        top = terms.max(axis=0)
        sums[place] = top + np.log(np.exp(terms - top).sum(axis=0))
    return sums


def long_word_scores(vocab: Pieces, word: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length in each language."""
    begins, ends, numbers = _long_matches(vocab, word)
    return _log_sums(len(word), ends, begins, np.log(chances)[numbers])[-1]


def long_expected_counts(vocab: Pieces, word: np.ndarray, times: int, chances: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in one word of any length that occurs ``times``."""
    begins, ends, numbers = _long_matches(vocab, word)
    logs, size = np.log(chances)[numbers][:, None], len(word)
    forward = _log_sums(size, ends, begins, logs)[:, 0]
    # Backwards the same sums run over places counted from the end.
    order = np.argsort(size - begins, kind="stable")
    backward = _log_sums(size, (size - begins)[order], (size - ends)[order], logs[order])[::-1, 0]
    share = np.exp(forward[begins] + logs[:, 0] + backward[ends] - forward[-1])
    return np.bincount(numbers, share * times, len(chances))


def word_scores(vocab: Pieces, rows: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows of one length) in each language (pieces x languages)."""
    if rows.shape[1] > LONGEST + 1:
        return np.stack([long_word_scores(vocab, word, chances) for word in rows])
    forward = np.zeros((rows.shape[1] + 1, len(rows), chances.shape[1]))
    forward[0] = 1.0
    for begin, end, at, number in _matches(vocab, rows):
        forward[end, at] += forward[begin, at] * chances[number]
    return np.log(forward[-1])


def expected_counts(vocab: Pieces, rows: np.ndarray, times: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in words of one length that occur ``times`` each."""
    if rows.shape[1] > LONGEST + 1:
        return sum(long_expected_counts(vocab, word, many, chances) for word, many in zip(rows, times, strict=True))
    found = list(_matches(vocab, rows))
    forward = np.zeros((rows.shape[1] + 1, len(rows)))
    backward = np.zeros_like(forward)
    forward[0], backward[-1] = 1.0, 1.0
    for begin, end, at, number in found:
        forward[end, at] += forward[begin, at] * chances[number]
    out = np.zeros(len(chances))
    # Words that end at later places first: a piece's end must be complete before it is used.
    for begin, end, at, number in sorted(found, key=lambda m: -m[1]):
        backward[begin, at] += backward[end, at] * chances[number]
    for begin, end, at, number in found:
        share = forward[begin, at] * chances[number] * backward[end, at] / forward[-1, at]
        out += np.bincount(number, share * times[at], len(chances))
    return out


def _by_length(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length as rows of bytes, a blank before each, and their numbers; a word of
    more than ``LONGEST`` bytes comes alone."""
    sizes = ends - starts
    for one in np.flatnonzero(sizes > LONGEST):
        yield np.concatenate([[np.uint8(0x20)], FOLD[data[starts[one] : ends[one]]]])[None, :], np.array([one])
    for size in np.unique(sizes[sizes <= LONGEST]):
        same = np.flatnonzero(sizes == size)
        for i in range(0, len(same), _WORDS_AT_ONCE):
            some = same[i : i + _WORDS_AT_ONCE]
            rows = np.full((len(some), size + 1), 0x20, np.uint8)
            rows[:, 1:] = FOLD[data[starts[some][:, None] + np.arange(size)]]
            yield rows, some


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    hashes = hash_spans(data, starts, ends)
    return np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)


def _fit(table: pa.Table, ranks: str) -> pa.Table:
    """Piece probabilities of one language."""
    vocab = vocabulary(ranks)
    counts = np.zeros(len(vocab.pieces))
    chances = 0.05 ** np.minimum(vocab.widths[:-1], 4) ** 0.5  # before the first round: shorter is likelier
    chances /= chances.sum()
    for _ in range(ROUNDS):
        counts[:] = 0
        for _, _, data, bounds in text_blocks(table.column("text"), _BLOCK):
            starts, ends, _ = word_spans(data, bounds, _LETTERS)
            if not len(starts):
                continue
            _, first, _, times = _distinct(data, starts, ends)
            for rows, some in _by_length(data, starts[first], ends[first]):
                counts += expected_counts(vocab, rows, times[some], np.maximum(chances, FLOOR))
        chances = counts / max(counts.sum(), 1.0)
    return pa.table({"lang": table.column("lang")[:1].cast(pa.string()), "chances": pa.array([chances.tobytes()], pa.binary())})


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, ranks: str = RANKS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces x languages), from text and lang of ``docs``.

    ``rows`` bounds the documents of each language; the model has one number per language and piece.
    """
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sample = bounded_sample(known, "doc_id", rows, "lang").select("lang", "text")

    def fit_one(table: pa.Table) -> pa.Table:
        return _fit(table, ranks)

    models = sample.groupBy("lang").applyInArrow(fit_one, "lang string, chances binary").collect()
    models = sorted(models, key=lambda m: m["lang"])
    if not models:
        return [], np.zeros((0, 0))
    own = np.stack([np.frombuffer(m["chances"]) for m in models], axis=1)
    mixed = (1 - SHARED) * own + SHARED * own.mean(axis=1, keepdims=True)
    return [m["lang"] for m in models], np.maximum(mixed, FLOOR)


def _score(batches: Iterator[pa.RecordBatch], model, names: list[str], ranks: str) -> Iterator[pa.RecordBatch]:
    chances = model.value
    for batch in batches:
        labels: list[str] = [UNKNOWN] * batch.num_rows
        scores = np.zeros(batch.num_rows)
        for first, _, data, bounds in text_blocks(batch.column("text"), _BLOCK) if names else ():
            starts, ends, at = word_spans(data, bounds, _LETTERS)
            if not len(starts):
                continue
            vocab = vocabulary(ranks)
            _, where, which, _ = _distinct(data, starts, ends)
            logs = np.zeros((len(where), len(names)))
            for rows, some in _by_length(data, starts[where], ends[where]):
                logs[some] = word_scores(vocab, rows, chances)
            ascii_letter = data[starts] < 0x80
            for row in np.flatnonzero(np.diff(at)):
                span = slice(at[row], at[row + 1])
                if not ascii_letter[span].any() and not any(c.isalpha() for c in data[bounds[row] : bounds[row + 1]].tobytes().decode()):
                    continue
                total = logs[which[span]].sum(axis=0)
                best = int(total.argmax())
                labels[first + row] = names[best]
                scores[first + row] = 1.0 / np.exp(total - total[best]).sum()
        kept = [c for c in batch.schema.names if c not in ("lang_pred", "score")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(labels, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"]
        )


def predict(docs: DataFrame, names: list[str], chances: np.ndarray, ranks: str = RANKS) -> DataFrame:
    """``docs`` with lang_pred and score (posterior); columns of these names are replaced."""
    plain = docs.drop("lang_pred", "score")
    model = docs.sparkSession.sparkContext.broadcast(chances)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(partial(_score, model=model, names=names, ranks=ranks), f"{fields}, lang_pred string, score double")
