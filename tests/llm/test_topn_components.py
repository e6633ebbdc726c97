import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kithweave.llm.components import connected_components
from kithweave.llm.topn import top_n


def brute_groups(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def groups(spark, pairs, **kw):
    df = spark.createDataFrame([(a, b, 0) for a, b in pairs], "a string, b string, v int")
    rows = connected_components(df, **kw).collect()
    assert len(rows) == len({r.record_id for r in rows})
    return {r.record_id: r.group_id for r in rows}


def test_shapes_of_components(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)]
    random.Random(1).shuffle(chain)
    star = [("hub", f"s{i}") for i in range(60)]
    pairs = chain + star + [("x", "y"), ("y", "x"), ("x", "y"), ("self", "self"), (None, "z"), ("z", None), ("s3", "t1"), ("t1", "t2")]
    assert groups(spark, pairs) == brute_groups(pairs)


@pytest.mark.parametrize("plain_rounds", [0, 2, 1000])
def test_deep_giant(spark, plain_rounds):
    giant = [("a000", f"a{i:03}") for i in range(1, 20)] + [(f"b{i:03}", f"b{i + 1:03}") for i in range(15)] + [("a005", "b000"), ("x", "y"), ("y", "z"), ("q", "q"), ("b003", "b003")]
    assert groups(spark, giant, plain_rounds=plain_rounds) == brute_groups(giant)


def chain(n, order):
    ids = [f"{i:06}" for i in range(n)]
    if order == "shuffled":
        random.Random(n).shuffle(ids)
    pairs = list(zip(ids, ids[1:]))
    return pairs[::-1] if order == "descending" else pairs


@pytest.mark.parametrize("order,n", [("ascending", 1000), ("ascending", 5000), ("descending", 5000), ("shuffled", 1000), ("shuffled", 5000)])
def test_chains_of_any_order(spark, order, n):
    pairs = chain(n, order)
    assert groups(spark, pairs) == brute_groups(pairs)


def test_many_deep_components(spark):
    """A broom as the giant, whose hub is neither the smallest nor the largest record, beside chains, a ring and a tree."""
    rng = random.Random(7)
    handle = [(f"m{i:04}", f"m{i + 1:04}") for i in range(400)]
    broom = handle + [("m0200", f"{c}{i:03}") for i in range(300) for c in "az"]
    chains = [(f"{c}-{x}", f"{c}-{y}") for c in "bcdk" for x, y in chain(150, rng.choice(["ascending", "shuffled"]))]
    ring = [(f"r{i:03}", f"r{(i * 37 + 37) % 101:03}") for i in range(101)]
    tree = [(f"t{(i - 1) // 2:03}", f"t{i:03}") for i in range(1, 255)]
    pairs = broom + chains + ring + tree
    rng.shuffle(pairs)
    assert groups(spark, pairs) == brute_groups(pairs)


def test_no_pairs(spark):
    assert groups(spark, []) == {}
    assert groups(spark, [(None, None)]) == {}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_random_components(spark, pairs):
    pairs = [(f"n{a:02}", f"n{b:02}") for a, b in pairs]
    assert groups(spark, pairs) == brute_groups(pairs)


def test_top_n(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["g", "h", None]), rng.choice(["t1", "t2", "t3", "t4", "t5", None]), rng.choice([0.5, 0.7, 0.9, None, float("nan")]), "clash") for _ in range(400)]
    rows += [("one", "t9", 0.1, None), ("one", "t9", 0.4, None)]
    df = spark.createDataFrame(rows, "g string, i string, s double, rank string")
    best = {}
    for g, i, s, _ in rows:
        if g is not None and i is not None and s is not None and s == s:
            best[g, i] = max(best.get((g, i), s), s)
    want = set()
    for g in {g for g, _ in best}:
        order = sorted(((-s, i) for (x, i), s in best.items() if x == g))[:3]
        want |= {(g, i, -s, k) for k, (s, i) in enumerate(order, 1)}
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 3).collect()} == want
    assert top_n(df.limit(0), "g", "i", "s", 3).count() == 0


def test_group_limit_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as string) g", "cast(id as string) i", "rand(1) s")
    plan = top_n(df, "g", "i", "s", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
