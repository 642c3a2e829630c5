"""Packing of tokenized documents into sequences of a fixed length.

Lengths are whole numbers up to the sequence length, so a corpus of any size is described by one
count per length. The driver packs those counts, never documents: a *pattern* is a multiset of
lengths that share a sequence, with the number of sequences that look like it. Best fit in
falling order gives the first patterns. Local search then takes the emptiest underfull pattern as
donor and changes it against the other underfull ones: it exchanges one piece for one longer
piece, or one for two, or moves a piece over. The receiver ends fuller than before and fuller
than the donor was, so the sum of squared fill rises with every step, and donors run empty. It
stops when the number of sequences is the smallest possible for the token total, or when no step
is left.

Pieces find their place by rank: the pieces of one length are numbered over salted slices, and
number r of length L belongs to the sequence that the patterns' running counts name. Nothing is
collected but the counts per length (at most one row per possible length).

Defined results: null text is empty and has one token, the end mark; repeated rows are packed as
rows of their own; columns other than ``doc_id`` and ``text`` are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.words import WHITE, hash_spans, text_blocks
from tidemark.session import materialize

SEQUENCE = 2048
END_MARK = 0
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks, which is several times faster to apply to plain text.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# --- tokens ---------------------------------------------------------------------------------

#: White space beyond ASCII, which the tokenizer's pattern also joins to runs.
_WIDE_WHITE = re.compile("[\x85\xa0  -     　]")
#: Characters of distinct words encoded in one call.
_CALL = 1 << 18
#: Bytes of text whose distinct pieces are encoded together.
_BLOCK = 1 << 22


class Tokens:
    """Token ids of whole texts.

    The vocabulary's pattern always breaks before a white-space character that follows a character
    of another kind, so a text is cut there, and every distinct piece of a block of texts is
    encoded once. Texts with special tokens or with white space beyond ASCII go to the tokenizer
    as they are.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS, special: tuple[str, ...] | None = None):
        self.vocabulary = vocabulary
        self.special = special_tokens(vocabulary) if special is None else special
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.widths = np.zeros(max(table.values(), default=0) + 1, np.int64)
        for piece, rank in table.items():
            self.widths[rank] = len(piece)

    @functools.cached_property
    def whole(self) -> Tokenizer:
        """Only loaded where a text needs it."""
        return Tokenizer.from_file(self.vocabulary)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many spans, one after the other, and the number of ids of each span."""
        counts = np.zeros(len(starts), np.int64)
        out = []
        # A span that begins with white space and ends without can stand in a row with others.
        chained = WHITE[data[starts]] & ~WHITE[data[ends - 1]]
        chain = np.flatnonzero(chained)
        sizes = ends[chain] - starts[chain]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        i = 0
        while i < len(chain):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + _CALL, side="right")) - 1)
            places = np.arange(upto[i], upto[j]) + np.repeat(starts[chain[i:j]] - upto[i:j], sizes[i:j])
            ids = np.array(self.plain.encode_ordinary(data[places].tobytes().decode()), np.int64)
            done = np.cumsum(self.widths[ids])
            counts[chain[i:j]] = np.diff(np.searchsorted(done, upto[i : j + 1] - upto[i], side="right"))
            out.append(ids)
            i = j
        alone = np.flatnonzero(~chained)
        for k in alone:
            ids = np.array(self.plain.encode_ordinary(data[starts[k] : ends[k]].tobytes().decode()), np.int64)
            counts[k] = len(ids)
            out.append(ids)
        order = np.concatenate([chain, alone])
        flat = np.concatenate(out) if out else np.zeros(0, np.int64)
        begins = np.zeros(len(starts), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return flat, np.stack([begins, counts])

    def block(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each text of a block of UTF-8 bytes."""
        white = np.zeros(len(data) + 1, bool)
        white[1:] = WHITE[data]
        cut = white[1:] & ~white[:-1]
        cut = np.append(cut, True)
        cut[bounds] = True
        marks = np.flatnonzero(cut)
        starts, ends = marks[:-1], marks[1:]
        if len(starts):
            hashes = hash_spans(data, starts, ends, fold=False)
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            flat, (begins, counts) = self._encode(data, starts[first], ends[first])
            begins, counts = begins[which], counts[which]
        at = np.searchsorted(marks, bounds)
        for row in range(len(bounds) - 1):
            lo, hi = at[row], at[row + 1]
            raw = data[bounds[row] : bounds[row + 1]].tobytes()
            if self._odd(raw):
                yield np.array(self.whole.encode(raw.decode(), add_special_tokens=False).ids, np.uint32)
            elif lo == hi:
                yield np.zeros(0, np.uint32)
            else:
                n = counts[lo:hi]
                places = np.arange(n.sum()) + np.repeat(begins[lo:hi] - (np.cumsum(n) - n), n)
                yield flat[places].astype(np.uint32)

    def _odd(self, raw: bytes) -> bool:
        if any(mark.encode() in raw for mark in self.special):
            return True
        return not raw.isascii() and _WIDE_WHITE.search(raw.decode()) is not None


def special_tokens(vocabulary: str) -> tuple[str, ...]:
    return tuple(t.content for t in Tokenizer.from_file(vocabulary).get_added_tokens_decoder().values())


@functools.lru_cache(maxsize=1)
def tokens(vocabulary: str, ranks: str, special: tuple[str, ...]) -> Tokens:
    return Tokens(vocabulary, ranks, special)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % size or size
    return [(0, min(n, first))] + [(start, size) for start in range(first, n, size)]


def _pieces(batches: Iterator[pa.RecordBatch], size: int, encoding: tuple, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = tokens(*encoding)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    for batch in batches:
        keys = batch.column("doc_id")
        for first, _, data, bounds in text_blocks(batch.column("text"), _BLOCK):
            rows, numbers, pieces = [], [], []
            for row, ids in enumerate(encoder.block(data, bounds)):
                ids = np.append(ids, np.uint32(END_MARK)).astype("<u4")
                for number, (start, length) in enumerate(cuts(len(ids), size)):
                    part = ids[start : start + length]
                    rows.append(first + row)
                    numbers.append((number, start, length, zlib.crc32(part.tobytes())))
                    if keep_ids:
                        pieces.append(part)
            piece, start, length, crc = (pa.array(x) for x in zip(*numbers, strict=True))
            columns = [keys.take(pa.array(rows)).cast(pa.int64()), piece.cast(pa.int32()), start, length, crc]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(pieces, pa.list_(pa.uint32())).cast(pa.list_(pa.int32()))] * keep_ids, names=names)


# --- patterns -------------------------------------------------------------------------------

Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], size: int) -> Counter[Pattern]:
    """Best fit of falling lengths, for all pieces of one length at a time.

    A piece goes where the least room is left that still takes it; after that, the same sequence
    has even less room and is the best fit for the next equal piece, until that no longer fits.
    """
    open_bins: dict[int, Counter[Pattern]] = {}
    done: Counter[Pattern] = Counter()

    def put(pattern: Pattern, many: int) -> None:
        room = size - sum(pattern)
        if room:
            open_bins.setdefault(room, Counter())[pattern] += many
        else:
            done[pattern] += many

    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_bins if r >= length):
            each = room // length
            for pattern, many in list(open_bins[room].items()):
                if not left:
                    break
                full = min(many, left // each)
                if full:
                    put(pattern + (length,) * each, full)
                    left -= full * each
                if full < many and left:
                    put(pattern + (length,) * left, 1)
                    full, left = full + 1, 0
                open_bins[room][pattern] -= full
                if not open_bins[room][pattern]:
                    del open_bins[room][pattern]
            if not open_bins[room]:
                del open_bins[room]
            if not left:
                break
        each = size // length
        if left // each:
            put((length,) * each, left // each)
        if left % each:
            put((length,) * (left % each), 1)
    for patterns in open_bins.values():
        done.update(patterns)
    return done


def _step(giver: Pattern, taker: Pattern, size: int) -> tuple[Pattern, Pattern] | None:
    """The change between two sequences that fills ``taker`` most: a piece moved, one exchanged
    for a shorter one, two for one, or one for two that are longer together."""
    room, lead = size - sum(taker), sum(taker) - sum(giver)
    best, change = 0, None
    out_options = [(0, ())] + [(x, (x,)) for x in sorted(set(taker))]
    singles = sorted(set(giver))
    held = Counter(giver)
    # Distinct lengths of one sequence are few: 63 of them already add up to 2,016.
    pairs = [(a, b) for i, a in enumerate(singles) for b in singles[i:] if a != b or held[a] > 1]
    in_options = [(x, (x,)) for x in singles] + sorted((a + b, (a, b)) for a, b in pairs)
    for out, leaves in out_options:
        for into, enters in in_options:
            gain = into - out
            # Squared fill rises exactly when the moved amount exceeds what the giver leads by.
            if best < gain <= room and gain > -lead:
                best, change = gain, (leaves, enters)
    if change is None:
        return None
    leaves, enters = map(Counter, change)
    return tuple((Counter(giver) - enters + leaves).elements()), tuple((Counter(taker) - leaves + enters).elements())


def pack(counts: dict[int, int], size: int) -> Counter[Pattern]:
    """Patterns and how many sequences take each.

    Squared fill rises with every change, so the search ends: at the lower bound, or when no two
    underfull sequences have a step left.
    """
    found = Counter()
    for pattern, many in best_fit(counts, size).items():
        found[tuple(sorted(pattern, reverse=True))] += many
    fewest = -(-sum(length * many for length, many in counts.items()) // size)
    # Underfull patterns in the order in which they came or became more; up to ``clean`` of a donor
    # none of them can take from it.
    came = [p for p in found if sum(p) < size]
    clean: dict[Pattern, int] = {}
    failed: set[tuple[Pattern, Pattern]] = set()

    def change_of(giver: Pattern) -> tuple[Pattern, tuple[Pattern, Pattern]] | None:
        takers = {t for t in came[clean.get(giver, 0) :] if found[t] > (t == giver)}
        for taker in sorted(takers, key=lambda t: (sum(t), t), reverse=True):
            if (giver, taker) not in failed:
                if step := _step(giver, taker, size):
                    return taker, step
                failed.add((giver, taker))
        clean[giver] = len(came)
        failed.clear()
        return None

    while found.total() > fewest:
        under = sorted((sum(p), p) for p in found if sum(p) < size and clean.get(p, 0) < len(came))
        giver, change = next(((g, c) for _, g in under if (c := change_of(g))), (None, None))
        if change is None:
            break
        taker, step = change
        times = found[giver] // 2 if giver == taker else min(found[giver], found[taker])
        for pattern in (giver, taker):
            found[pattern] -= times
            if not found[pattern]:
                del found[pattern]
        for pattern in step:
            if pattern:
                pattern = tuple(sorted(pattern, reverse=True))
                found[pattern] += times
                if sum(pattern) < size:
                    came.append(pattern)
    return found


# --- places ---------------------------------------------------------------------------------


def _places(patterns: Counter[Pattern]) -> dict[int, np.ndarray]:
    """Per length: first rank, pieces a sequence, first sequence and first offset of each pattern."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter[int] = Counter()
    sequence = 0
    for pattern in sorted(patterns, reverse=True):
        many, offset = patterns[pattern], 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            table.setdefault(length, []).append((used[length], each, sequence, offset))
            used[length] += each * many
            offset += each * length
        sequence += many
    return {length: np.array(rows, np.int64).T for length, rows in table.items()}


def _place(batches: Iterator[pa.RecordBatch], table: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for value in np.unique(length):
            rows = np.flatnonzero(length == value)
            first, each, base, begin = table[int(value)]
            at = np.searchsorted(first, rank[rows], side="right") - 1
            number = rank[rows] - first[at]
            sequence[rows] = base[at] + number // each[at]
            offset[rows] = begin[at] + number % each[at] * value
        kept = [c for c in batch.schema.names if c != "rank"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
        )


def pack_documents(
    docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY, ranks: str = RANKS, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    With ``keep_ids`` the piece's ids follow as an array.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    cut = partial(_pieces, size=size, encoding=(vocabulary, ranks, special_tokens(vocabulary)), keep_ids=keep_ids)
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(cut, schema))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = _places(pack(counts, size))

    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("many"))
        .select("length", "salt", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("salt", "length").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("number", F.row_number().over(within))
        .join(bases, ["length", "salt"])
        .select(*pieces.columns, (F.col("base") + F.col("number") - 1).alias("rank"))
    )
    return ranked.mapInArrow(partial(_place, table=table), schema + ", sequence_id long, offset long")
