"""Spelling variants grouped under their usual form, found by a bidirectional FM-index.

Words are runs of Latin letters, A-Z lower-cased. Two words are near if one inserted, deleted or
replaced code point turns one into the other. The search scheme has two parts: with one error at
most, a word's left half or its right half is exact. The exact half is matched outwards from the
middle to its end of the word, backwards in the index; then the direction turns and the other half
is matched forwards with one error, in the index of the reversed text. Both hold the same
occurrences as intervals of suffix ranks, which are kept in step. The text of an index is the
vocabulary with a delimiter around every word, so a match that ends on delimiters is a word.

Half a word of six code points or more has three, so words that share a half share its outer
three: the vocabulary is dealt out by the first three code points for one part of the scheme and
by the last three for the other (on reversed words). A bucket of more than ``BLOCK`` words is cut
into blocks, and all its blocks of queries meet all its blocks of the index, so that no task holds
more than two blocks. A pair that both parts find counts in the first.

Only counts, and the best near word, leave a block: pairs are never written out.

Defined results: null and empty texts have no words; a null doc_id is written as an empty text;
repeated rows count again; words of any length are searched whole; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Code points of the shortest word; its halves share EDGE code points at least.
SHORTEST = 6
EDGE = 3
LEAST_USES = 5
#: How much more often a form must be used than its variant.
TIMES = 5
#: One run in so many loses a code point before words are counted; 0 leaves all as they are.
DAMAGE = 199
#: Words in one index.
BLOCK = 16_384
#: Distinct words that a task holds before it hands its counts on.
_HELD = 400_000
#: Places between two rows of stored ranks.
_STEP = 32

_RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END, _DELIMITER, _FIRST = 0, 1, 2


def words_of(doc_id: int | None, text: str | None, damage: int = DAMAGE) -> Counter[str]:
    """Words of at least SHORTEST code points and their uses."""
    out: Counter[str] = Counter()
    if not text:
        return out
    key = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, uses in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
        if damage:
            mark = zlib.crc32(run.encode(), key)
            if mark % damage == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            out[run] += uses
    return out


def _batch(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _count(batches: Iterator[pa.RecordBatch], damage: int) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.update(words_of(doc_id, text, damage))
            if len(counts) > _HELD:
                yield _batch(counts)
                counts = Counter()
    yield _batch(counts)


def vocabulary(docs: DataFrame, least: int = LEAST_USES, damage: int = DAMAGE) -> DataFrame:
    """word and n of all words used at least ``least`` times."""
    counted = docs.select("doc_id", "text").mapInArrow(partial(_count, damage=damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Starts of the sorted suffixes, by doubling the sorted length; the last code is unique."""
    many, width, rank = len(codes), 1, codes.astype(np.int64)
    while True:
        after = np.zeros(many, np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (many + 2) + after
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank[order] = steps
        if steps[-1] == many - 1:
            return order
        width *= 2


class Ranks:
    """The last column of the sorted suffixes, with counts of every code before any place."""

    def __init__(self, codes: np.ndarray, letters: int):
        self.order = suffix_order(codes)
        self.last = codes[self.order - 1].astype(np.uint8 if letters < 256 else np.uint16)
        room = -len(codes) % _STEP + _STEP
        padded = np.concatenate([self.last, np.full(room, letters, self.last.dtype)])
        self._rows = padded.reshape(-1, _STEP)
        used = np.zeros((len(self._rows), letters + 1), np.int32)
        np.add.at(used, (np.arange(len(padded)) // _STEP, padded), 1)
        before = np.cumsum(used, axis=0, dtype=np.int32) - used
        self._before = before[:, :letters]
        self._smaller = np.cumsum(self._before, axis=1, dtype=np.int32) - self._before
        #: Rank of the first suffix that begins with each code.
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=letters))])[:-1]

    def before(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Uses of ``code`` in the last column before ``place``."""
        row, rest = place // _STEP, place % _STEP
        inside = (self._rows[row] == code[:, None]) & (np.arange(_STEP) < rest[:, None])
        return self._before[row, code] + inside.sum(axis=1)

    def smaller(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Uses of smaller codes in the last column before ``place``."""
        row, rest = place // _STEP, place % _STEP
        inside = (self._rows[row] < code[:, None]) & (np.arange(_STEP) < rest[:, None])
        return self._smaller[row, code] + inside.sum(axis=1)

    def extend(self, code: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the pattern with ``code`` put before it."""
        begin = self.before(code, low)
        return self.first[code] + begin, self.before(code, low + size) - begin


class Index:
    """Words as codes, and the ranks of their delimited text read in both directions."""

    def __init__(self, words: list[str], queries: list[str]):
        points = np.unique(np.frombuffer("".join([*words, *queries]).encode("utf-32-le"), np.uint32))
        self.letters = len(points) + _FIRST
        self._points = points
        self.words = words
        body = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32)
        codes = np.where(body == 0, _DELIMITER, np.searchsorted(points, body) + _FIRST)
        end = np.array([_END])
        self.backward = Ranks(np.concatenate([codes, end]), self.letters)
        self.forward = Ranks(np.concatenate([codes[::-1], end]), self.letters)
        # A reversed word with its delimiters begins where the one before it ends; words by rank.
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in reversed(words)])])
        first = self.forward.first[_DELIMITER]
        ranked = self.forward.order[first : first + len(words) + 1]
        self._word = len(words) - 1 - np.searchsorted(starts, ranked)

    def encode(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All queries' codes on end, and where each begins."""
        flat = np.searchsorted(self._points, np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32)) + _FIRST
        return flat, np.concatenate([[0], np.cumsum([len(q) for q in queries])]).astype(np.int64)

    def _children(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) of all letters that may follow: those in a small interval, else all."""
        small = np.flatnonzero(size <= self.letters)
        state = np.repeat(small, size[small])
        inside = np.arange(len(state)) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
        pairs = np.unique(state * self.letters + self.forward.last[low[state] + inside])
        large = np.flatnonzero(size > self.letters)
        others = (large[:, None] * self.letters + np.arange(self.letters)).ravel()
        pairs = np.concatenate([pairs, others])
        state, letter = pairs // self.letters, pairs % self.letters
        kept = letter >= _FIRST
        return state[kept], letter[kept]

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words at one error from a query behind its first ``exact`` letters."""
        flat, at = self.encode(queries)
        length = np.diff(at)
        query = np.arange(len(queries))
        # The exact half, from its inner end to the delimiter, backwards.
        low, low_forward = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        size = np.full(len(queries), len(self.backward.last), np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        step = 0
        while len(query):
            last = step == exact[query]
            code = np.where(last, _DELIMITER, flat[np.minimum(at[query] + np.maximum(exact[query] - 1 - step, 0), len(flat) - 1)])
            skipped = self.backward.smaller(code, low + size) - self.backward.smaller(code, low)
            low_forward = low_forward + skipped
            low, size = self.backward.extend(code, low, size)
            whole, going = last & (size > 0), ~last & (size > 0)
            found.append((query[whole], low_forward[whole], size[whole]))
            query, low, low_forward, size = (x[going] for x in (query, low, low_forward, size))
            step += 1
        # The other half, forwards, with one error.
        query, low, size = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        place = exact[query]
        spent = np.zeros(len(query), bool)
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            inside = place < length[query]
            wanted = np.where(inside, flat[np.minimum(at[query] + place, len(flat) - 1)], _DELIMITER)
            ends = ~inside & spent
            goes = inside | ends
            fresh = np.flatnonzero(~spent)
            state, letter = self._children(low[fresh], size[fresh])
            state = fresh[state]
            other = inside[state] & (letter != wanted[state])
            # The next letter as it is (or the closing delimiter), another in its place, another before it.
            source = np.concatenate([np.flatnonzero(goes), state[other], state])
            code = np.concatenate([wanted[goes], letter[other], letter])
            moved = np.concatenate([np.ones(goes.sum(), np.int64), np.ones(other.sum(), np.int64), np.zeros(len(state), np.int64)])
            error = np.concatenate([spent[goes], np.ones(other.sum() + len(state), bool)])
            new_low, new_size = self.forward.extend(code, low[source], size[source])
            alive = new_size > 0
            done = alive & (code == _DELIMITER)
            hits.append((query[source[done]], self._word[new_low[done] - self.forward.first[_DELIMITER]]))
            alive &= ~done
            # The query's letter left out.
            dropped = np.flatnonzero(inside & ~spent)
            query, place, spent, low, size = (
                np.concatenate([query[source[alive]], query[dropped]]),
                np.concatenate([place[source[alive]] + moved[alive], place[dropped] + 1]),
                np.concatenate([error[alive], np.ones(len(dropped), bool)]),
                np.concatenate([new_low[alive], low[dropped]]),
                np.concatenate([new_size[alive], size[dropped]]),
            )
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([q for q, _ in hits]) * len(self.words) + np.concatenate([w for _, w in hits]))
        return pairs // len(self.words), pairs % len(self.words)


_FOUND = "word string, n_near long, near_n long, near string"


def _search(table: pa.Table) -> pa.Table:
    """Near words of a block of queries in a block of the index, one row a query that has any."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("side", "query", "word", "n")), strict=True))
    index = sorted((word, n) for _, query, word, n in rows if not query)
    queries = [word for _, query, word, _ in rows if query]
    out: list[tuple[str, int, int, str]] = []
    if index and queries:
        reverse = rows[0][0] == "right"
        turned = (lambda w: w[::-1]) if reverse else (lambda w: w)
        words = [w for w, _ in index]
        uses = np.array([n for _, n in index])
        left = np.array([len(q) // 2 for q in queries], np.int64)
        lengths = np.array([len(q) for q in queries], np.int64)
        known = Index([turned(w) for w in words], [turned(q) for q in queries])
        query, word = known.near([turned(q) for q in queries], lengths - left if reverse else left)
        if reverse and len(query):
            # What keeps the left half too was found by the other part.
            own = np.fromiter((not words[w].startswith(queries[q][: left[q]]) for q, w in zip(query, word, strict=True)), bool, len(query))
            query, word = query[own], word[own]
        # Words are sorted, so the smaller number is the smaller word.
        order = np.lexsort((word, -uses[word], query))
        query, word = query[order], word[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
        many = np.diff(np.append(first, len(query)))
        out = [(queries[query[i]], int(k), int(uses[word[i]]), words[word[i]]) for i, k in zip(first, many, strict=True)]
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n_near", "near_n", "near"])


def _numbers(many: Column) -> Column:
    return F.sequence(F.lit(0), many - 1)


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, near and near_n (the near word of largest n) of words that have any near one."""
    buckets = max(1, -(-vocab.count() // block) * 2)
    edges = F.explode(
        F.array(
            F.struct(F.lit("left").alias("side"), F.substring("word", 1, EDGE).alias("edge")),
            F.struct(F.lit("right").alias("side"), F.expr(f"right(word, {EDGE})").alias("edge")),
        )
    )
    dealt = vocab.select("word", "n", edges.alias("at")).select(
        "word", "n", "at.side", F.pmod(F.xxhash64("at.edge"), F.lit(buckets)).cast("int").alias("bucket")
    )
    dealt = materialize(dealt)
    sizes = dealt.groupBy("side", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sized = dealt.join(sizes, ["side", "bucket"])
    mine = F.pmod(F.xxhash64("word", F.lit("block")), "blocks").cast("int")
    index = sized.select("side", "bucket", mine.alias("of_index"), F.explode(_numbers(F.col("blocks"))).alias("of_query"), F.lit(False).alias("query"), "word", "n")
    queries = sized.select("side", "bucket", F.explode(_numbers(F.col("blocks"))).alias("of_index"), mine.alias("of_query"), F.lit(True).alias("query"), "word", "n")
    found = index.unionByName(queries).groupBy("side", "bucket", "of_index", "of_query").applyInArrow(_search, _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every row of ``forms`` (word, form), following forms to the last.

    A form is used several times as often as its word, so chains are short and have no rings;
    each round doubles the part of a chain that is behind."""
    ways = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(ways.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ways = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ways


def group(docs: DataFrame, least: int = LEAST_USES, times: int = TIMES, damage: int = DAMAGE, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words of ``docs`` (doc_id, text)."""
    vocab = materialize(vocabulary(docs, least, damage))
    near = near_words(vocab, block)
    usual = F.col("near_n") >= times * F.col("n")
    forms = materialize(
        vocab.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(usual, F.col("near")).alias("form"),
            F.when(usual, F.col("near_n")).alias("form_n"),
        )
    )
    found = roots(forms.where("form IS NOT NULL"))
    return forms.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
