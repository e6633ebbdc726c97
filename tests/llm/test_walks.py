"""Walks lead to every holder of a token and take all tokens of a record, however many there are."""

import pytest

from kithweave.llm import entities


@pytest.mark.parametrize("ring", [entities.RING, 10])
def test_walks_reach_all_holders_and_tokens(spark, ring):
    """A token that all records hold, beside 11 that only one holds: each record is met by the walks over the one, with all its tokens."""
    none = []
    rows = [(i, "a" if i % 2 else "m", str(i), "GOLDEN", None, [f"UNDERHILL{i}X{j}" for j in range(11)], none) for i in range(60)]
    recs = spark.createDataFrame(rows, "rid bigint, side string, stored string, core string, code string, writers array<string>, artists array<string>")
    tok = entities.record_rows(recs).cache()
    own = {tuple(sorted(entities.row_of(t) for t in [f"P:{p}" for p in r[5]] + ["W:GOLDEN"])): r[0] for r in rows}
    walks = [(own[tuple(sorted(w.x))], own[tuple(sorted(w.y))]) for w in entities.walks_of(tok, ring).collect()]
    assert sorted(x for x, _ in walks) == list(range(60))  # one from each, all of its tokens
    shared = spark.createDataFrame([(i, [7]) for i in range(300)], "r bigint, k array<bigint>")
    walked = entities.walks_of(shared, ring).count()
    assert walked == 300 and 1 <= entities.walks_of(shared.limit(1), ring).count()
    far = shared.selectExpr("r", "array(7L, 1000L + r) k")
    met = {tuple(w.y) for w in entities.walks_of(far, ring).collect() if w.x != w.y}
    assert len(met) > 100  # of the 300 holders about half walk over the token they share, each to another one
