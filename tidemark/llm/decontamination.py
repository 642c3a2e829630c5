"""Benchmark items found in documents with one Aho-Corasick automaton over their word windows.

Both sides are lower-cased in A-Z and cut into words of ASCII letters, digits and all characters
beyond ASCII. The words of a text, each between two single blanks, are scanned once; patterns
begin and end with a blank, so a match covers whole words. A window is a run of ``width`` item
words, or all words of a shorter item.

The automaton is built on each executor from the windows of the benchmark, which go out in blocks
of about ``BLOCK_WINDOWS``; a larger benchmark takes one scan per block, and the spans of all
blocks are united per document. Each scan but the last is written before the next one, so that a
task holds one automaton at a time.

Defined results: null text, and text without words, has 0 words and no hit; an item without words
occurs nowhere; equal items with different ids all count; repeated item rows count once; repeated
documents give one row each; an empty benchmark hits nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import set_aside
from tidemark.llm.words import ALNUM, FOLD, word_spans
from tidemark.session import materialize

WIDTH = 10
#: Windows in one automaton; about 100 bytes of patterns each.
BLOCK_WINDOWS = 1_000_000
_CLEAN = bytes(np.where(ALNUM, FOLD, 0x20).astype(np.uint8))
#: The last broadcast with its width and automaton. The broadcast is kept, so no other one can take its place in memory.
_built: list[tuple[object, int, ahocorasick.Automaton]] = []


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_CLEAN).split()


def windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    width = min(width, len(words))
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def _plain(words) -> str:
    """Words between blanks; one character a byte, so that offsets are bytes."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def build(items: list[tuple[str, str]], width: int) -> ahocorasick.Automaton:
    """Automaton whose matches give (words in the window, ids of its items)."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        for window in windows(words_of(text), width):
            owners.setdefault(window, set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        automaton.add_word(_plain(window), (len(window), sorted(ids)))
    automaton.make_automaton()
    return automaton


def _automaton(items, width: int) -> ahocorasick.Automaton:
    """One automaton a worker process and broadcast."""
    if not _built or _built[0][0] is not items or _built[0][1] != width:
        _built.clear()
        _built.append((items, width, build(items.value, width)))
    return _built[0][2]


def find(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
    """United spans of hit words [first, last + 1] and the ids of the items found."""
    spans: list[list[int]] = []
    found: set[str] = set()
    if not words or not len(automaton):
        return spans, found
    plain = _plain(words)
    at, number = 0, -1  # blanks counted so far: number of the word that ends at the blank
    for end, (length, ids) in automaton.iter(plain):
        number += plain.count(" ", at, end + 1)
        at = end + 1
        first = number - length
        if spans and first <= spans[-1][1]:
            # Matches come by their end; a longer window may begin before earlier spans.
            while len(spans) > 1 and first <= spans[-2][1]:
                spans.pop()
            spans[-1] = [min(first, spans[-1][0]), number]
        else:
            spans.append([first, number])
        found.update(ids)
    return spans, found


def _characters(raw: bytes, spans: list[list[int]]) -> list[dict[str, int]]:
    """Where spans of words begin and end in the original text, in code points."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [{"begin": int(upto[starts[a]]), "end": int(upto[ends[b - 1]])} for a, b in spans]


def _united(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


_WORDS = pa.list_(pa.list_(pa.int64()))
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_FOUND = {"n_words": "long", "hit_words": "array<array<long>>", "items": "array<string>", "spans": "array<struct<begin:long,end:long>>"}


def _scan(batches: Iterator[pa.RecordBatch], items, width: int, again: bool) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(items, width)
    for batch in batches:
        rows = []
        before = zip(*(batch.column(c).to_pylist() for c in ("hit_words", "items")), strict=True) if again else None
        for text in batch.column("text").to_pylist():
            raw = (text or "").encode()
            words = raw.translate(_CLEAN).split()
            hits, found = find(automaton, words)
            if again:
                old_hits, old_found = next(before)
                hits, found = _united(hits + old_hits), found.union(old_found)
            rows.append((len(words), hits, sorted(found), _characters(raw, hits) if hits else []))
        kept = [c for c in batch.schema.names if c not in _FOUND]
        added = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), _WORDS, pa.list_(pa.string()), _SPANS))]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + added, names=[*kept, *_FOUND])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids, sorted as strings), hit_words (spans of word
    numbers) and spans (the same in code points of the original text). Columns of these names
    are replaced."""
    spark = docs.sparkSession
    out = docs.drop("n_hit", *_FOUND)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    # A window has at least one word and one blank, so half the characters bound their number.
    size = items.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("size")).first()["size"]
    blocks = max(1, -(-size // (2 * block)))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields] + [f"{k} {v}" for k, v in _FOUND.items()])
    for number in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in mine])
        out = out.mapInArrow(partial(_scan, items=sent, width=width, again=number > 0), schema)
        if number < blocks - 1:
            out = materialize(out)
    return out.withColumn("n_hit", F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0]))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents in which no window occurs, with their own columns."""
    rows, own = set_aside(docs, ("n_hit", *_FOUND))
    return contamination(rows, benchmark, width).where("n_hit = 0").select(*own)
