"""Phrases, toxicity and spelling variants against plain versions, with odd and empty input."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA
from tests.test_oracle import normal
from tidemark.llm import phrases, queries, toxicity, variants
from tidemark.llm.oracles import ORACLES

MIDDLE = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(None, None), ("", "en"), (" \t\n;", "en"), ("x" * 9_000, "en"), ("Le mot.entier", None), ("a b c d e f g h i j k l m n o p q r s t " * 400, "fr")]


def corpus(seed: int, many: int) -> list[tuple[str | None, str | None]]:
    rng = random.Random(seed)
    words = ["the", "cat", "sat", "ON", "mat", "été", "x", "dog", "ran", "far"]
    line = lambda: " ".join(rng.choice(words[: rng.randint(2, 10)]) for _ in range(rng.randint(1, 30)))
    passage = ". ".join(line() for _ in range(4))
    rows = [(rng.choice(["  ", "! ", "\t"]).join(line() for _ in range(rng.randint(1, 5))), rng.choice(["en", "fr", None])) for _ in range(many)]
    return rows + [(passage, "en")] * (many // 2) + ODD


def plain_phrases(rows, least: int, top: int, covered: int) -> set[tuple]:
    uses, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    uses[lang or "und"][tuple(words[i : i + size])] += 1
    out = set()
    for lang, counts in uses.items():
        found = {w: a for w, a in counts.items() if a >= least and len(w) > 1}
        around = Counter()
        for w, a in found.items():
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    around[w[i : i + size]] = max(around[w[i : i + size]], a)
        ranked = []
        for w, a in found.items():
            if 100 * around[w] >= covered * a and around[w]:
                continue
            score, k = min((2_000_000 * a // (counts[w[:k]] + counts[w[k:]]), k) for k in range(1, len(w)))
            ranked.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


@pytest.mark.parametrize(("spacing", "top"), [(2, 50), (16, 2_000)])
def test_phrases(spark, monkeypatch, spacing, top):
    rows = corpus(3, 60)
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], SCHEMA).withColumn("uses", F.lit("clash"))
    got = phrases.collocations(docs, least=5, top=top, spacing=spacing).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == plain_phrases(rows, 5, top, 80)


def test_phrases_in_slices(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITMAP_ENTRIES", 40)
    rows = corpus(4, 30)
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], SCHEMA)
    assert {tuple(r) for r in phrases.collocations(docs, least=5).collect()} == plain_phrases(rows, 5, 2_000, 80)
    assert phrases.collocations(docs.where("false")).count() == 0


def test_chunks_own_every_word_once(spark):
    rows = corpus(5, 40)
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], SCHEMA)
    chunks = [(r["chunk"], r["uses"]) for r in phrases.dictionary(docs, 2).collect()]
    owned = sum((len(c.rstrip(" ").split(" ")) - (3 if c.endswith(" ") else 0)) * n for c, n in chunks)
    assert owned == sum(len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t or "")) for t, _ in rows)
    by_lang = defaultdict(list)
    for r in phrases.dictionary(docs, 2).collect():
        by_lang[r["lang"]].append(r["chunk"])
    for found in by_lang.values():  # a chunk that goes on ends with a blank, and is no prefix of another one
        going = sorted(c for c in found if c.endswith(" "))
        assert not any(b.startswith(a) for a, b in zip(going, going[1:], strict=False))


def test_phrases_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{MIDDLE}/documents.parquet'")
    answer = con.execute(ORACLES["op11_phrases"])
    have = [d[0] for d in answer.description]
    got = queries.op11_phrases(spark, MIDDLE)
    assert sorted(have) == sorted(got.columns)
    assert normal([tuple(r[c] for c in have) for r in got.collect()]) == normal(answer.fetchall())


def test_fold_reads_disguises():
    words = ["1d10t", "іdіоt", "ＩＤＩＯＴ", "íd​iot", "IDIOT!!", "$tupid", "m0r0n$$$", "stüpid"]
    assert [toxicity.fold(w) for w in words] == [["idiot"], ["idiot"], ["idiot"], ["ídiot"], ["idiot"], ["stupid"], ["moron"], ["stüpid"]]
    assert toxicity.fold(None) == toxicity.fold("") == toxicity.fold("12 34!") == []


def test_matches_by_hand():
    rng = random.Random(8)
    lexicon = toxicity.Lexicon({" bad ": 2.0, " ugl": 1.5, " worse ": 3.0}, ["bad luck", "not ugly at all"])
    automaton = lexicon.automaton()
    for _ in range(300):
        words = [rng.choice(["bad", "luck", "ugly", "ugliest", "not", "at", "all", "worse", "fine"]) for _ in range(rng.randint(0, 14))]
        want = 0.0
        for i, word in enumerate(words):
            weight = 2.0 if word == "bad" else 1.5 if word.startswith("ugl") else 3.0 if word == "worse" else 0.0
            fair = words[i : i + 2] == ["bad", "luck"] or (i and words[i - 1 : i + 3] == ["not", "ugly", "at", "all"])
            want += 0.0 if fair else weight
        assert sum(w for _, _, w in toxicity.matches(automaton, words)) == pytest.approx(want)


def toxic_corpus(seed: int, many: int) -> list[tuple[int, str | None, int]]:
    rng = random.Random(seed)
    plain = ["river", "stone", "light", "paper", "green", "vilify", "table", "storm"]
    rows = []
    for i in range(many):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vermin", "v3rmin", "swinelike", "swinehood"])
        if not toxic and i % 9 == 0:
            words[:2] = ["swinehood", "forest"]  # a place name
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_lexicon_is_learnt_with_its_exceptions(spark):
    rows = toxic_corpus(6, 1_200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    lexicon = toxicity.fit(docs.drop("label"), docs.select("doc_id", "label"))
    assert " vermin " in lexicon.weights and any(e.startswith(" swine") for e in lexicon.weights)
    assert not any(e.strip() in ("river", "forest") for e in lexicon.weights)
    assert "swinehood forest" in lexicon.exceptions
    fresh = spark.createDataFrame(toxic_corpus(7, 200), "doc_id long, text string, label int")
    scored = toxicity.score(fresh, lexicon).collect()
    assert all(0 <= r["score"] <= 1 for r in scored)
    assert sum((r["score"] >= 0.5) == bool(r["label"]) for r in scored) > 0.98 * len(scored)


def test_tally_and_curve_by_hand(spark):
    rows = toxic_corpus(9, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    found = docs.mapInArrow(lambda b: toxicity._tally(b, toxicity._candidates), toxicity._TALLY).groupBy("entry").sum().collect()
    want = defaultdict(lambda: [0, 0, 0, 0])
    for _, text, label in rows:
        words = toxicity.fold(text)
        entries = Counter(e for w in words for e in {f" {w} ", *(f" {w[:n]}" for n in range(3, min(len(w), 9) + 1))})
        for entry, uses in entries.items():
            want[entry][1 - label] += 1
            want[entry][3 - label] += uses
    assert {r[0]: list(r[1:]) for r in found} == dict(want)
    rng = np.random.default_rng(1)
    weight, share = rng.random(400) * 5, rng.random(400)
    label = (rng.random(400) < 1 / (1 + np.exp(3 - 2 * np.log1p(weight)))).astype(float)
    curve = toxicity.fit_curve(weight, share, label, np.ones(400))
    x = toxicity._design(weight, share)
    slope = x.T @ (1 / (1 + np.exp(-x @ curve)) - label) + np.array([1e-6, 1e-3, 1e-3]) * 400 * curve
    assert np.abs(slope).max() < 1e-6


def test_toxicity_on_held_out_rows(spark):
    scored = queries.op12_toxicity(spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert scored.count() == 1000 and all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.1, "k"), (2, "", 0.2, "k"), (2, "", 0.2, "k"), (3, "bad " * 20_000, 0.3, "k")], "doc_id long, text string, score double, label string")
    none = toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, None), (3, 7)], "doc_id long, label int"))
    assert none.weights == {} and {r["score"] < 1e-9 for r in toxicity.score(docs, none).collect()} == {True}
    scored = toxicity.score(docs, toxicity.Lexicon({" bad ": 1.0}, [], (-3.0, 1.0, 1.0))).collect()
    assert len(scored) == 4 and [r["label"] for r in scored] == ["k"] * 4
    assert {r["doc_id"]: r["score"] >= 0.5 for r in scored} == {1: False, 2: False, 3: True}
    assert toxicity.score(docs.where("false"), none).count() == 0


def spellings(seed: int, many: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "z" * 400]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(many):
        words = []
        for _ in range(rng.randint(0, 60)):
            word = base[min(int(rng.expovariate(0.15)), len(base) - 1)]
            if rng.random() < 0.3:
                k = rng.randrange(len(word))
                word = rng.choice([word[:k] + word[k + 1 :], word[:k] + "c" + word[k:], word[:k] + "b" + word[k + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", "-", "\n", "1"]).join(words)))
    return rows + [(None, "Straße Straße"), (7, None), (8, ""), (9, "×÷×÷×÷×")] + [(3, rows[3][1])] * 6


def plain_variants(rows, least: int, damage: int) -> dict[str, tuple]:
    uses: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % damage == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            uses[run] += len(run) >= 6
    n = {w: k for w, k in uses.items() if k >= least}
    letters = sorted({c for w in n for c in w})
    near, form = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = [x for x in edits - {w} if x in n]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("block", [variants.BLOCK, 9])
def test_variants(spark, block):
    rows = spellings(11, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = variants.group(docs, least=2, damage=5, block=block).collect()
    want = plain_variants(rows, 2, 5)
    assert len(got) == len(want) and sum(v[0] is not None for v in want.values()) > 20
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert variants.group(docs.where("false")).count() == 0


def test_index_intervals_stay_in_step():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abd") for _ in range(rng.randint(1, 7))) for _ in range(200)})
    index = variants.Index(words, words)
    text = [chr(1), *(chr(1).join(words)), chr(1)]
    for side, plain in ((index.backward, "".join(text)), (index.forward, "".join(text[::-1]))):
        assert list(side.order) == sorted(range(len(plain) + 1), key=lambda i: plain[i:] + chr(0))
    query, found = index.near(words, np.array([len(w) // 2 for w in words]))
    got = {(words[q], words[w]) for q, w in zip(query, found, strict=True)}

    def one_behind(a: str, b: str) -> bool:
        keep = len(a) // 2
        x, y = a[keep:], b[keep:]
        edits = {x[:i] + x[i + 1 :] for i in range(len(x))} | {x[:i] + c + x[i + k :] for i in range(len(x) + 1) for c in "abd" for k in (0, 1)}
        return a != b and b.startswith(a[:keep]) and y in edits

    assert got == {(a, b) for a in words for b in words if one_behind(a, b)}
