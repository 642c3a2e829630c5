"""Operators on documents against plain versions, with nulls, empty, long and repeated texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SCHEMA, jaccard, sample_texts, table
from tidemark.llm import decontamination, fingerprint, lines, minhash, packing, sharding, surrogates
from tidemark.session import scratch_folder


@pytest.fixture(scope="module")
def texts():
    return sample_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints(docs, texts):
    rows = {r["doc_id"]: r for r in fingerprint.edits(docs).collect()}
    plain = [t or "" for t in texts]
    assert len(rows) == len(plain)
    prints = defaultdict(set)
    for i, text in enumerate(plain):
        row, tail = rows[i * 7], len(text) // 4
        edited = text[: len(text) - tail] + plain[(i + 1) % len(plain)][:tail]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints[text].add(row["fingerprint"])
        prints[edited].add(row["edited_fingerprint"])
        assert 0 <= row["near_next"] <= 1 and (row["near_edited"] == 1.0) == (edited == text)
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for found in prints.values() for p in found}) == len(prints)


def test_fingerprint_locates_an_edit(spark):
    base = "\n".join(f"Line {i} of the text, with a few words." for i in range(40))
    rows = spark.createDataFrame([(base,), (base.replace("Line 20 ", "Row 20 "),)], "text string")
    first, second = (r["f"].split("|")[1].split(";") for r in rows.select(fingerprint.tree(fingerprint.values(F.col("text"))).alias("f")).collect())
    assert len(set(first) ^ set(second)) == 2


def test_lines(docs, texts):
    found = {(r["doc_id"], r["line"]): r["repeated"] for r in lines.repeats(docs).collect()}
    earlier, want = [], {}
    for i, text in enumerate(texts):
        for number, line in enumerate((text or "").split("\n")):
            words = set(line.lower().split())
            if words:
                want[i * 7, number] = any(jaccard(words, other) >= 0.8 for other in earlier)
                earlier.append(words)
    assert found == want
    assert any(want.values()) and not all(want.values())
    cleaned = lines.without_repeats(docs)
    assert cleaned.columns == docs.columns
    whole = {i * 7 for i in range(len(texts)) if (got := [v for (d, _), v in want.items() if d == i * 7]) and all(got)}
    assert {r["doc_id"] for r in cleaned.collect()} == {i * 7 for i in range(len(texts))} - whole


def _brute_components(texts, k):
    sets = []
    for text in texts:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for white in "\t\n\x0b\x0c\r":
            folded = folded.replace(white, " ")
        words = [w for w in folded.split(" ") if w]
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    label = list(range(len(sets)))
    moved = True
    while moved:
        moved = False
        for i in range(len(sets)):
            for j in range(i):
                if label[i] != label[j] and sets[i] and jaccard(sets[i], sets[j]) >= 0.8:
                    label[i] = label[j] = min(label[i], label[j])
                    moved = True
    return sets, label


@pytest.mark.parametrize("k", [2, 5])
def test_minhash(docs, texts, k):
    sets, label = _brute_components(texts, k)
    rows = {r["doc_id"]: r for r in minhash.components(docs, k).collect()}
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in rows.items()} == {
        i * 7: (len(sets[i]), label[i] * 7, label[i] == i) for i in range(len(texts))
    }


def test_minhash_large_group_of_near_copies(spark):
    """Variants whose pairs lie on both sides of the threshold."""
    import random

    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(60)] = f"x{rng.random()}"
        texts.append(" ".join(words))
    _, label = _brute_components(texts, 2)
    rows = {r["doc_id"]: r["component_id"] for r in minhash.components(table(spark, texts), 2).collect()}
    assert rows == {i * 7: label[i] * 7 for i in range(len(texts))}


def test_packing(docs, texts):
    size = 256
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    rows = packing.pack_documents(docs, size).collect()
    ids = {i * 7: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, tokens in ids.items():
        got = sorted(pieces[doc])
        assert [p for p, _, _ in got] == list(range(len(got)))
        assert [s for _, s, _ in got] == [sum(n for _, _, n in got[:i]) for i in range(len(got))]
        assert sum(n for _, _, n in got) == len(tokens) and all(n == size for _, _, n in got[1:])
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size


@pytest.mark.parametrize("text", ["<|endoftext|> a", "a   b c", "\n\n a\n ", "  a  b \t\n\n it's 12 --- \n", "", "naïve été"])
def test_tokens_equal_the_tokenizer(text):
    import pyarrow as pa

    from tidemark.llm.words import text_blocks

    encoder = packing.Tokens()
    column = pa.array([text, text + " x", text])
    got = [list(ids) for _, _, data, bounds in text_blocks(column) for ids in encoder.block(data, bounds)]
    assert got == [encoder.whole.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]


def test_local_search_empties_bins():
    counts = Counter({6: 2, 5: 1, 4: 2, 3: 1, 2: 1})
    first = packing.best_fit(dict(counts), 10)
    found = packing.pack(dict(counts), 10)
    assert found.total() == 3 <= first.total()
    used = Counter()
    for pattern, many in found.items():
        assert sum(pattern) <= 10
        for length in pattern:
            used[length] += many
    assert used == counts


@pytest.mark.parametrize("seed", range(6))
def test_local_search_ends_where_no_step_is_left(seed):
    rng = random.Random(seed)
    size = 60
    counts = Counter(rng.randint(1, 4) if seed % 2 and i % 3 == 0 else rng.randint(13, 33) for i in range(150))
    found = packing.pack(dict(counts), size)
    used = Counter()
    for pattern, many in found.items():
        assert sum(pattern) <= size
        for length in pattern:
            used[length] += many
    assert used == counts and found.total() <= packing.best_fit(dict(counts), size).total()
    if found.total() == -(-sum(length * many for length, many in counts.items()) // size):
        return
    bins = [p for p in found.elements() if sum(p) < size]
    for i, giver in enumerate(bins):
        moves = [(x,) for x in giver] + list(combinations(giver, 2))
        for taker in bins[:i] + bins[i + 1 :]:
            for into in moves:
                for out in [(), *((x,) for x in taker)]:
                    fill, rest = sum(taker) + sum(into) - sum(out), sum(giver) - sum(into) + sum(out)
                    better = fill**2 + rest**2 > sum(taker) ** 2 + sum(giver) ** 2
                    assert fill > size or rest > size or not better or fill < sum(taker)


def test_decontamination(spark, docs, texts):
    source = texts[3].split()
    items = [(1, " ".join(source[:14])), (2, "Word!"), (3, None), (4, ""), (20, "ba " * 3)]
    rows = [(str(i), t) for i, t in items]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    for block in (1_000_000, 5):
        got = {r["doc_id"]: r for r in decontamination.contamination(docs, bench, block=block).collect()}
        for i, text in enumerate(texts):
            words = decontamination.words_of(text)
            hit, ids = set(), set()
            for item, content in rows:
                for window in decontamination.windows(decontamination.words_of(content), 10):
                    for at in range(len(words) - len(window) + 1):
                        if tuple(words[at : at + len(window)]) == window:
                            hit |= set(range(at, at + len(window)))
                            ids.add(item)
            row = got[i * 7]
            assert (row["n_words"], row["n_hit"], row["items"]) == (len(words), len(hit), sorted(ids))
            for span in row["spans"]:
                assert set(decontamination.words_of(text[span["begin"] : span["end"]])) <= set(words)
    assert any(r["n_hit"] for r in got.values())


def test_automaton_belongs_to_its_broadcast():
    """A broadcast that is dropped leaves its address to the next one."""

    class Sent:
        def __init__(self, value):
            self.value = value

    for k in range(20):
        sent = Sent([(str(k), f"word{k}")])
        found = decontamination.find(decontamination._automaton(sent, 10), [f"word{k}".encode()])
        assert found == ([[0, 1]], {str(k)})
        del sent


def test_decontamination_blocks_over_many_tasks():
    """Four blocks and 30 tasks in a session of their own, whose Python workers are used again."""
    import subprocess
    import sys

    script = """
from pyspark.sql import functions as F
from tidemark.llm import decontamination
from tidemark.session import local_session

spark = local_session("blocks", 4, 4)
docs = spark.range(0, 600, 1, 30).select(F.col("id").alias("doc_id"), F.concat(F.lit("item"), F.col("id") % 40, F.lit(" and item"), (F.col("id") + 1) % 40).alias("text"))
bench = spark.createDataFrame([(str(i), f"item{i}") for i in range(40)], "item_id string, text string")
for block in (35, 70):
    for r in decontamination.contamination(docs, bench, block=block).collect():
        assert r["items"] == sorted(str((r["doc_id"] + k) % 40) for k in (0, 1)) and r["n_hit"] == 2, (block, r)
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def _feasible(sizes, capacity, shards):
    used, room = 1, capacity
    for s in sizes:
        if s > capacity:
            return False
        if s > room:
            used, room = used + 1, capacity
        room -= s
    return used <= shards


def test_minimax_cuts(spark):
    import random

    rng = random.Random(1)
    keys = sorted(rng.randrange(-(1 << 63), 1 << 63) for _ in range(700))
    sizes = [rng.choice([8, 20, 300, 5000]) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, size long")
    capacity, cuts = sharding.minimax_cuts(groups, 9, first_bits=3, step_bits=2)
    assert _feasible(sizes, capacity, 9) and not _feasible(sizes, capacity - 1, 9)
    bounds = [-(1 << 63), *cuts, 1 << 63]
    loads = [sum(s for k, s in zip(keys, sizes, strict=True) if a <= k < b) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert len(loads) <= 9 and max(loads) == capacity


def test_sharding(docs, texts):
    rows = sharding.shard(docs, 5).collect()
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"] // 7]
        assert r["size"] == len((text or "").encode()) + 8
        assert r["text_crc32"] == (None if text is None else zlib.crc32(text.encode()))
        by_text[text].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(len(s) == 1 for s in by_text.values())
    assert set(slots) <= set(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_surrogates(spark):
    texts = [
        "Write to anna.24@mail4.example.com or call (803) 555-5351, from 151.49.68.73.",
        'Again anna.24@mail4.example.com; token = "3e5cb3f9186ce4f749644b4847d287be561795be" 4111 1111 1111 1111',
        "Mr. John Smith met Mrs. Jane Smith and Mr. John Smith. 4795522935961213",
        "Господин Иван Петров",
        "Nothing here 12 and 1999, e.g. 3.14",
        None,
        "",
    ]
    docs = table(spark, [*texts, texts[0]])
    rows = {r["doc_id"]: r for r in surrogates.pseudonymize(docs, "k").collect()}
    assert len(rows) == 8 and rows[0]["text"] == rows[49]["text"]
    new = [rows[i * 7]["text"] for i in range(7)]
    assert new[4:] == texts[4:] and [rows[i * 7]["n_found"] for i in range(7)] == [3, 3, 4, 1, 0, 0, 0]
    for old in ("anna.24@mail4", "555-5351", "151.49.68.73", "3e5cb3f9", "4111 1111", "Smith", "4795522935961213", "Петров"):
        assert all(old not in t for t in new[:4])
    mail = new[0].split()[2]
    assert mail in new[1]
    men = [w for w in new[2].split(" met ")[0].split()[1:]]
    assert new[2].count(" ".join(men)) == 2 and men[0] in surrogates.GIVEN["latin", "male"]
    assert new[2].split("Mrs. ")[1].split()[0] in surrogates.GIVEN["latin", "female"]
    assert new[3].split()[1] in surrogates.GIVEN["cyrillic", "male"]
    number = [int(c) for c in new[1] if c.isdigit()][-16:]
    assert sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(number)) % 10 == 0
    assert surrogates.pseudonymize(docs, "other").where("doc_id = 0").first()["text"] != new[0]


def test_surrogates_of_one_entity_in_several_layouts(spark):
    secret = "9233a8ecf7c5" + "0a1b2c3d" * 3 + "0f0f"
    texts = [
        f"{secret} {secret.upper()} {secret[:20].upper()}{secret[20:]}",
        "4111 1111 1111 1111, 4111-1111-1111-1111, 4111111111111111",
        "(803) 555-5351, 803-555-5351, 803.555.5351",
        "Anna.B@Example.com anna.b@example.com",
        "Mr. John Smith, Mr Smith, Mr. Smith, Mrs. Jane Smith, Mr. Jack Smith, Mr John Smith",
    ]
    rows = {r["doc_id"] // 7: r for r in surrogates.pseudonymize(table(spark, texts), "k").collect()}
    assert [rows[i]["n_found"] for i in range(5)] == [3, 3, 3, 2, 6]
    low, up, mixed = rows[0]["text"].split()
    assert low == low.lower() != secret and up == low.upper() and mixed.lower() == low and len(low) == len(secret)
    for i, shape in ((1, ["dddd dddd dddd dddd", "dddd-dddd-dddd-dddd", "d" * 16]), (2, ["(ddd) ddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd"])):
        got = rows[i]["text"].split(", ")
        assert ["".join("d" if c.isdigit() else c for c in t) for t in got] == shape
        assert len({"".join(c for c in t if c.isdigit()) for t in got}) == 1
    first, second = rows[3]["text"].split()
    assert first.lower() == second and first[0].isupper() and second.islower()
    john, bare, dotted, jane, jack, again = (t.split() for t in rows[4]["text"].split(", "))
    assert {t[-1] for t in (john, bare, dotted, jane, jack, again)} == {john[2]} and john[2] != "Smith"
    assert john[1] == again[1] != jack[1] and [bare[0], dotted[0], again[0]] == ["Mr", "Mr.", "Mr"]


def test_surrogates_stay_distinct(spark):
    entities = spark.createDataFrame([(f"Mr. A{chr(97 + i % 26)}{chr(97 + i // 26)} B", "name") for i in range(300)], "entity string, kind string")
    rows = surrogates.assign(entities, "k").collect()
    assert len({r["surrogate"] for r in rows}) == 300


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert fingerprint.edits(empty).count() == 0
    assert lines.without_repeats(empty).count() == 0
    assert minhash.components(empty, 2).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert decontamination.contamination(empty, bench).count() == 0
    assert sharding.shard(empty).count() == 0
    assert surrogates.pseudonymize(empty, "k").count() == 0


def test_clashing_helper_columns_keep_their_values(spark, docs):
    names = ("_removed", "_whole", "_doc", "_text", "_new", "_key", "_content", "_node", "_later", "n_words", "Items", "n_hit", "spans", "score", "predicted")
    extra = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    bench = spark.createDataFrame([(1, "changed changed")], "item_id long, text string")
    folder = scratch_folder(spark)
    spark.createDataFrame([(7 * i, 1) for i in range(40)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    for found in (
        lines.without_repeats(extra),
        minhash.keep_one(extra),
        decontamination.without_contaminated(extra, bench),
        surrogates.pseudonymize(extra, "k"),
        corpus_pipeline.keep_quality(spark, extra, folder),
    ):
        assert found.columns[: len(extra.columns)] == extra.columns
        rows = found.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_keep_one_with_texts_that_share_an_id(spark):
    one, other, third = ("a b c d e f g h i j", "k l m n o p q r s t", "u v w x y z a b c d")
    rows = [(1, one), (5, one), (5, other), (7, other), (7, third), (9, third), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect()]
    texts = [t for _, t in kept if t]
    assert sorted(texts) == sorted([one, other, third]) and kept.count((9, None)) == 2
    assert (1, one) in kept


def test_clashing_columns(docs):
    extra = docs.select("*", *(F.lit(1).alias(c) for c in ("node", "label", "bucket", "line", "words", "place", "n_hit", "items", "kinds", "key", "size")))
    assert minhash.keep_one(extra).columns == extra.columns
    assert lines.without_repeats(extra).columns == extra.columns
    assert packing.pack_documents(extra).count() > 0 and sharding.shard(extra).count() == extra.count()
    assert surrogates.pseudonymize(extra, "k").count() == extra.count()


def test_lines_are_numbered_from_one_split(spark):
    """Each number looked its line up in a text split anew: the square of a text's lines."""
    docs = spark.createDataFrame([(1, "one two\n \nthree\tfour\n"), (2, None), (3, "")], "doc_id long, text string")
    found = lines._removed(docs)
    assert ", -1)[" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r["doc_id"]: r["lines"] for r in found.collect()} == {1: [0, 2], 2: [], 3: []}
