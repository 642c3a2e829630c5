"""Classifiers by held-out accuracy, preference pairs by a plain version, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.helpers import SCHEMA
from tests.test_oracle import normal
from tidemark.llm import language, preferences, quality, queries
from tidemark.llm.oracles import ORACLES

MIDDLE = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    scored = queries.op3_quality(spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    assert scored.count() == 1000


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None), (3, " \n", None, None, None)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.score(docs.where("false"), quality.fit(docs, none)).count() == 0


def test_language_on_held_out_rows(spark):
    found = queries.op9_language(spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth.dropna(), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95


def test_language_edges(spark):
    learnt = spark.createDataFrame([(i, t, l, None, None) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 3)], SCHEMA)
    names, chances = language.fit(learnt)
    assert names == ["de", "en"]
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the dog " * 50), (5, "—"), (6, "und die Katze" + "e" * 300)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in language.predict(docs, names, chances).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 5)] == ["und"] * 4 and rows[4]["lang_pred"] == "en" and rows[6]["lang_pred"] == "de"
    nothing = language.fit(learnt.where("false"))
    assert {r["lang_pred"] for r in language.predict(docs, *nothing).collect()} == {"und"}


def test_forward_pass_sums_all_segmentations():
    import numpy as np

    vocab = language.vocabulary(language.RANKS)
    rng = np.random.default_rng(2)
    chances = rng.random((len(vocab.pieces), 1))
    number = {p: i for i, p in enumerate(vocab.pieces)}

    def total(word: bytes) -> float:
        return 1.0 if not word else sum(chances[number[word[:n]], 0] * total(word[n:]) for n in range(1, len(word) + 1) if word[:n] in number)

    word = b" there"
    got = language.word_scores(vocab, np.frombuffer(word, np.uint8)[None, :], chances)[0, 0]
    assert abs(np.exp(got) - total(word)) < 1e-9 * total(word)


def _segmentations(word: bytes, number: dict[bytes, int]):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in number:
            for rest in _segmentations(word[n:], number):
                yield [number[word[:n]], *rest]


@pytest.mark.parametrize("word", [" there", " Слово".lower(), " 日本"])
def test_expected_counts_over_all_segmentations(word):
    import numpy as np

    vocab, raw = language.vocabulary(language.RANKS), word.encode()
    chances = np.random.default_rng(3).random(len(vocab.pieces))
    want, whole = np.zeros(len(chances)), 0.0
    for cut in _segmentations(raw, {p: i for i, p in enumerate(vocab.pieces)}):
        weight = np.prod(chances[cut])
        whole += weight
        np.add.at(want, cut, weight)
    row = np.frombuffer(raw, np.uint8)
    for got in (language.expected_counts(vocab, row[None, :], np.array([2]), chances), language.long_expected_counts(vocab, row, 2, chances)):
        assert np.allclose(got, 2 * want / whole, rtol=1e-9)
    assert np.isclose(language.long_word_scores(vocab, row, chances[:, None])[0], np.log(whole), rtol=1e-12)


@pytest.mark.parametrize("text", ["donaudampfschifffahrtsgesellschaftskapitaen" * 3, "достопримечательность" * 6, "國際機場第二航廈" * 200])
def test_long_words_are_summed_whole(text):
    import math

    import numpy as np

    vocab, raw = language.vocabulary(language.RANKS), b" " + text.encode()
    chances = np.maximum(np.random.default_rng(4).random((len(vocab.pieces), 2)) * 1e-4, language.FLOOR)
    number, widest = {p: i for i, p in enumerate(vocab.pieces)}, max(map(len, vocab.pieces))
    assert widest > 12
    for lang in range(2):
        logs = [0.0]
        for end in range(1, len(raw) + 1):
            terms = [logs[b] + math.log(chances[number[raw[b:end]], lang]) for b in range(max(0, end - widest), end) if raw[b:end] in number]
            logs.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
        got = language.word_scores(vocab, np.frombuffer(raw, np.uint8)[None, :], chances)[0, lang]
        assert math.isclose(got, logs[-1], rel_tol=1e-12)


def test_preferences(spark):
    turns = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "good"), (1, "chosen", 2, "user", None),
        (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "bad"),
        (2, "chosen", 0, None, "a"), (2, "rejected", 0, None, "a"),
        (3, "chosen", 0, "user", "alone"),
    ]
    frame = spark.createDataFrame(turns, "pair_id long, side string, turn long, role string, text string")
    rows = {r["pair_id"]: r for r in preferences.pairs(frame).collect()}
    assert rows[1]["prompt"] == "<|user|>\nhi<|end|>\n" and rows[1]["n_common"] == 1
    for side, text in (("chosen", "good"), ("rejected", "bad")):
        begin, end = rows[1][f"{side}_mask"][0]
        assert rows[1][side][begin:end] == f"{text}<|end|>\n"
    assert (rows[2]["n_common"], rows[2]["chosen"], rows[2]["rejected"]) == (1, "", "")
    assert (rows[3]["prompt"], rows[3]["rejected"]) == ("", "")
    assert preferences.pairs(frame.where("false")).count() == 0


def test_preference_query_shares_prompts(spark):
    rows = queries.op2_preferences(spark, SF_SMALL).collect()
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").where("role = 'assistant'")
    assert sum(r["n_common"] > 0 and r["prompt"] != "" for r in rows) >= 0.9 * turns.select("conv_id").distinct().count()
    assert any(r["chosen_mask"] and r["rejected_mask"] and r["chosen"] != r["rejected"] for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for name_of in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{SF_SMALL}/{name_of}.parquet'")
    answer = connection.execute(ORACLES[name])
    have = [d[0] for d in answer.description]
    df = queries.QUERIES[name](spark, SF_SMALL)
    order = sorted(df.columns)
    assert sorted(have) == order
    want = [tuple(r[have.index(c)] for c in order) for r in answer.fetchall()]
    assert normal([tuple(r[c] for c in order) for r in df.collect()]) == normal(want)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept, before = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_SMALL).cache()
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= before.count(), name
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}
