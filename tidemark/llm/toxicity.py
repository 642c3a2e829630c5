"""Toxicity by a weighted lexicon, matched with one Aho-Corasick automaton on folded text.

Folding takes look-alike letters of other scripts and full-width forms to Latin, drops combining
and invisible signs, lower-cases, and reads digits and signs between or before letters of a word
as the letters they stand for (``1d10t``, ``$tupid``). What is left between runs of letters is one
blank, so an entry begins with a blank and either ends with one (a whole word) or not (all words
that begin so).

The lexicon is learnt from labels: words and beginnings of words that occur in clearly more toxic
documents than clean ones (likelihood ratio over ``LEAST_RATIO``), the strongest of nested entries
only. An entry weighs the logarithm of how much more often it is used in toxic text. A phrase of
two words around an entry that is as clearly a clean one becomes an exception; callers may give
further ones. Matches inside an exception phrase do not count.

A document's total weight and its share of the words are the two inputs of a logistic curve,
fitted to the same sample. Length enters by the share alone, so a long clean text with a chance
match stays clean.

Counting and scoring run on Arrow batches. The driver gets candidates that passed the test, one
row a sampled document for the curve, and nothing that grows with the table.

Defined results: null and empty texts have no match and no words and score as such; repeated
rows are scored one by one; a column named score, toxic_weight or toxic_share is replaced, other
columns are kept; labels other than 0 and 1 and null labels are left out; without labels of both kinds the lexicon
is empty and every score 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import bounded_sample

#: Most labelled rows of each kind that the fit reads.
SAMPLE_ROWS = 6_000
#: Code points of the shortest and longest beginning of a word that may become an entry.
SHORTEST, LONGEST = 3, 9
#: Likelihood ratio (chi-square of one degree) above which an entry is no accident among millions of candidates.
LEAST_RATIO = 35.0
#: Documents that must hold a candidate.
LEAST_DOCS = 4
#: Words added to a text's length, so that one match in three words is no certainty.
FLOOR_WORDS = 8
#: Score from which a document counts as toxic.
TOXIC_FROM = 0.5

#: Letters of other scripts that look like Latin ones, and signs read as letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "l", "ɴ": "n", "ʀ": "r",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e", "£": "l"}

_STAND_IN = re.compile(r"(?<![^\W\d_])[0-9@$!|€£]{1,3}(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$!|€£]+(?=[^\W\d_])")
_LETTERS = re.compile(r"[^\W\d_]+")
_SIGN_TABLE = {ord(k): v for k, v in SIGNS.items()}


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    # All planes that hold look-alikes, marks or invisible signs.
    for point in (*range(0x80, 0x20000), *range(0xE0000, 0xE0200)):
        sign = chr(point)
        if unicodedata.category(sign) in ("Mn", "Me", "Cf"):
            table[point] = None
        elif unicodedata.decomposition(sign).startswith(("<wide>", "<font>", "<circle>", "<super>", "<sub>")):
            table[point] = unicodedata.normalize("NFKC", sign).lower()
    # What lower() leaves as a letter and a combining dot.
    table[0x130] = "i"
    for sign, plain in LOOK_ALIKES.items():
        table[ord(sign)] = plain
        table[ord(sign.upper()[0])] = plain if sign != "ı" else "i"
    return {k: v for k, v in table.items() if k >= 0x80}


_FOLD: dict[int, str | None] = {}


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    if not text:
        return []
    if not text.isascii():
        if not _FOLD:
            _FOLD.update(_fold_table())
        text = unicodedata.normalize("NFC", text).translate(_FOLD)
    text = _STAND_IN.sub(lambda m: m[0].translate(_SIGN_TABLE), text.lower())
    return _LETTERS.findall(text)


@dataclass
class Lexicon:
    """Weights of entries (" word " or " beginning"), exception phrases and the curve's numbers."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    #: Offset, factor of the logarithm of the weight, factor of the share.
    curve: tuple[float, float, float] = (-35.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            plain = f" {' '.join(fold(phrase))} "
            if plain.strip():
                # An entry that is also an exception never counts.
                found.add_word(plain, (len(plain), None))
        found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, words: list[str]) -> list[tuple[int, int, float]]:
    """(begin, end, weight) in the folded text of every counted match, one a word at most."""
    if not words or not len(automaton):
        return []
    best: dict[int, tuple[int, float]] = {}
    void: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        begin = end - length + 1
        if weight is None:
            void.append((begin, end))
        elif begin not in best or weight > best[begin][1]:
            best[begin] = (end, weight)
    if void:
        best = {b: (e, w) for b, (e, w) in best.items() if not any(first <= b and e <= last for first, last in void)}
    return [(b, e, w) for b, (e, w) in sorted(best.items())]


_TALLY = "entry string, toxic long, clean long, toxic_uses long, clean_uses long"
#: Entries that a task holds before it hands its counts on.
_HELD = 400_000


def _tallied(counts: dict[str, list[int]]) -> pa.RecordBatch:
    columns = zip(*counts.values(), strict=True) if counts else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
        ["entry", "toxic", "clean", "toxic_uses", "clean_uses"],
    )


def _tally(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """Documents and uses of what ``of`` finds in each, by label."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            for entry, uses in of(fold(text)).items():
                row = counts.setdefault(entry, [0, 0, 0, 0])
                row[1 - label] += 1
                row[3 - label] += uses
            if len(counts) > _HELD:
                yield _tallied(counts)
                counts = {}
    yield _tallied(counts)


def _candidates(words: list[str]) -> dict[str, int]:
    many = Counter(words)
    out: dict[str, int] = {}
    for word, uses in many.items():
        out[f" {word} "] = uses
        for n in range(SHORTEST, min(len(word), LONGEST) + 1):
            entry = f" {word[:n]}"
            out[entry] = out.get(entry, 0) + uses
    return out


def _phrases(words: list[str], automaton) -> dict[str, int]:
    """Pairs of neighbouring words of which one begins with an entry."""
    plain = f" {' '.join(words)} "
    at, number = {}, 0
    for k, sign in enumerate(plain):
        if sign == " ":
            at[k] = number
            number += 1
    out: dict[str, int] = {}
    for begin, _, _ in matches(automaton.value, words):
        i = at[begin]
        for first in (i - 1, i):
            if 0 <= first and first + 2 <= len(words):
                phrase = f"{words[first]} {words[first + 1]}"
                out[phrase] = out.get(phrase, 0) + 1
    return out


def _ratio(a, n1, b, n0):
    """Likelihood ratio of two shares a/n1 and b/n0 against one."""

    def part(k, n, p):
        return k * np.log(np.maximum(p, 1e-12)) + (n - k) * np.log(np.maximum(1 - p, 1e-12))

    p = (a + b) / (n1 + n0)
    return 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, p) - part(b, n0, p))


def choose(rows: list[tuple[str, int, int, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries and weights out of tallies (entry, documents and uses by label).

    Of nested entries the one with the larger ratio stays, the longer one of equals.
    """
    ranked = []
    for entry, a, b, uses1, uses0 in rows:
        ratio = float(_ratio(a, toxic, b, clean))
        if ratio >= LEAST_RATIO and a * clean > b * toxic:
            ranked.append((-round(ratio, 6), -len(entry), entry, uses1, uses0))
    weights: dict[str, float] = {}
    used: set[str] = set()  # beginnings of what was chosen
    for _, _, entry, uses1, uses0 in sorted(ranked):
        begins = {entry[:n] for n in range(1, len(entry) + 1)}
        if entry in used or any(b in weights for b in begins):
            continue
        used |= begins
        weights[entry] = float(np.log(((uses1 + 0.5) / toxic) / ((uses0 + 0.5) / clean)))
    return {e: w for e, w in weights.items() if w > 0}


_INPUTS = "toxic_weight double, toxic_share double"


def _inputs(batches: Iterator[pa.RecordBatch], lexicon) -> Iterator[pa.RecordBatch]:
    """Batches with the total weight of matches and the matches' weight per word."""
    automaton = lexicon.value.automaton()
    for batch in batches:
        weight, share = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = fold(text)
            weight[i] = sum(w for _, _, w in matches(automaton, words))
            share[i] = weight[i] / (len(words) + FLOOR_WORDS)
        yield batch.append_column("toxic_weight", pa.array(weight)).append_column("toxic_share", pa.array(share))


def _measured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    plain = docs.drop("toxic_weight", "toxic_share")
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in plain.schema.fields)
    return plain.mapInArrow(partial(_inputs, lexicon=sent), fields + _INPUTS)


def _design(weight: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.sqrt(share)], 1)


def fit_curve(weight: np.ndarray, share: np.ndarray, label: np.ndarray, importance: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton steps."""
    x, beta = _design(weight, share), np.zeros(3)
    ridge = np.diag([1e-6, 1e-3, 1e-3]) * importance.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        slope = x.T @ (importance * (p - label)) + ridge @ beta
        bend = (x * (importance * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon learnt from about ``rows`` labelled rows (doc_id, label 0 or 1) of each kind."""
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("label IN (0, 1)").dropna().dropDuplicates(["doc_id"])
    many = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(many) < 2:
        return Lexicon(exceptions=list(exceptions))
    chosen = bounded_sample(known, "doc_id", rows, "label")
    # The sample is bounded, so its ids may be broadcast; the texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    drawn = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(drawn) < 2:
        return Lexicon(exceptions=list(exceptions))

    def tally(of, least: str) -> list[tuple[str, int, int, int, int]]:
        found = sample.mapInArrow(partial(_tally, of=of), _TALLY).groupBy("entry")
        sums = found.agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "toxic_uses", "clean_uses")))
        return [tuple(r) for r in sums.where(least).collect()]

    # Only what is over-represented can pass the test, so only that is sent.
    over = f"toxic >= {LEAST_DOCS} AND toxic * {drawn[0]} > 1.5 * clean * {drawn[1]}"
    weights = choose(tally(_candidates, over), drawn[1], drawn[0])
    lexicon = Lexicon(weights, list(exceptions))
    sent = spark.sparkContext.broadcast(lexicon.automaton())
    under = f"clean >= {LEAST_DOCS} AND clean * {drawn[1]} > 1.5 * toxic * {drawn[0]}"
    for phrase, a, b, _, _ in tally(partial(_phrases, automaton=sent), under):
        if float(_ratio(b, drawn[0], a, drawn[1])) >= LEAST_RATIO:
            lexicon.exceptions.append(phrase)
    lexicon.exceptions.sort()
    seen = _measured(sample, lexicon).select("label", *(c.split()[0] for c in _INPUTS.split(", "))).toArrow()
    label = seen["label"].to_numpy().astype(float)
    # Each kind counts as often as it occurs among all labels.
    importance = np.where(label == 1, many[1] / drawn[1], many[0] / drawn[0])
    lexicon.curve = fit_curve(seen["toxic_weight"].to_numpy(), seen["toxic_share"].to_numpy(), label, importance)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with toxic_weight, toxic_share and score (0 to 1)."""
    offset, by_weight, by_share = lexicon.curve
    line = F.lit(offset) + by_weight * F.log1p("toxic_weight") + by_share * F.sqrt("toxic_share")
    found = _measured(docs.drop("score"), lexicon)
    return found.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), line)))))
