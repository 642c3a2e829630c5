"""The event log of model versions: claims, state, aliases and legal moves."""

import pytest

from tidemark.operators import versions as v


def test_second_writer_of_a_state_is_refused(spark, tmp_path):
    root = str(tmp_path)
    assert v.head(spark, root) == -1 and v.events(spark, root).isEmpty()
    assert v.record(spark, root, [("1", "path", "/m/1"), ("1", "status", "champion"), ("1", "alias:champion", "held")], -1) == 0
    seen = v.head(spark, root)
    assert v.record(spark, root, [("2", "path", "/m/2")], seen) == 1
    with pytest.raises(v.StaleState):
        v.record(spark, root, [("3", "path", "/m/3")], seen)
    assert v.events(spark, root).count() == 4 and v.events(spark, root).select("seq").distinct().count() == 4
    v.claim(spark, root, 2)  # a writer that died before it wrote
    assert v.record(spark, root, [("2", "status", "challenger")], v.head(spark, root)) == 3
    for wrong in ([],):
        with pytest.raises(ValueError):
            v.record(spark, root, wrong, 3)


def test_claims_are_exclusive_between_threads(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def one(_):
        try:
            v.claim(spark, str(tmp_path), 7)
            return 1
        except v.StaleState:
            return 0

    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(one, range(24))) == 1


def log(spark, *changes):
    return spark.createDataFrame([(*c, None, i) for i, c in enumerate(changes)], v.EVENT_SCHEMA)


def test_state_and_names(spark):
    events = log(
        spark,
        ("1", "path", "/m/1"),
        ("1", "status", "champion"),
        ("1", "alias:champion", "held"),
        ("2", "path", "/m/2"),
        ("2", "status", "challenger"),
        ("2", "alias:challenger", "held"),
        ("1", "note", "x"),
        ("1", "note", None),
    )
    assert v.resolve(events, "@champion") == "1" and v.resolve(events, "2") == "2" and v.resolve(events, "/some/path") == "/some/path"
    for unknown in ("@nobody", "9"):
        with pytest.raises(LookupError):
            v.resolve(events, unknown)
    assert {(r["version"], r["field"]) for r in v.state(events).collect()} == {("1", "path"), ("1", "status"), ("1", "alias:champion"), ("2", "path"), ("2", "status"), ("2", "alias:challenger")}
    after = log(spark, *[tuple(r)[:3] for r in events.orderBy("seq").collect()], *v.moves(events, "1", "archived", "worse"), *v.moves(events, "2", "champion"))
    assert {r["alias"]: r["version"] for r in v.holders(after).collect()} == {"champion": "2"}
    rows = {r["version"]: r for r in v.described(after, ("status", "withdrawn_reason")).collect()}
    assert rows["1"]["status"] == "archived" and rows["1"]["withdrawn_reason"] == "worse" and rows["1"]["aliases"] == ""
    assert rows["2"]["aliases"] == "champion"
    assert all(r["legal"] for r in v.transitions(after).collect())
    for version, to in (("2", "challenger"), ("2", "champion"), ("1", "challenger"), ("3", "archived")):
        with pytest.raises(v.IllegalMove):
            v.moves(after, version, to)
    assert [r["legal"] for r in v.transitions(log(spark, ("1", "status", "archived"), ("1", "status", "champion"), ("1", "status", "challenger"))).orderBy("seq").collect()] == [False, True, False]


def test_a_name_that_moved_on_is_not_taken_back(spark):
    events = log(spark, ("1", "status", "challenger"), ("1", "alias:challenger", "held"), ("2", "status", "challenger"), ("2", "alias:challenger", "held"))
    assert ("1", "alias:challenger", None) not in v.moves(events, "1", "archived")
    assert v.holders(events).collect()[0]["version"] == "2"
