"""A misspelt given name is told by how much rarer it is than the right one, however large the data are."""

import pytest

from kithweave.llm import variants


@pytest.mark.parametrize("families", [1, 3, 6])
def test_repeated_misspelling(spark, families):
    letters = "BDFGKLMNPRSTVZ"
    names = [f"{a}{b}ORDA{c}{a}SKI" for a, b, c in zip(letters * 5, letters[3:] * 7, letters[5:] * 9)][:70]
    names = sorted(set(names))[:60]
    values = [f"MATTHEW {n}" for n in names] + [f"MATHTEW {n}" for n in names[:families]] + [f"MARIA {n}" for n in names[:20]] + [f"MARIO {n}" for n in names[:20]]
    ent = {r.value: r.entity for r in variants.link_names(spark.createDataFrame([(v,) for v in values], "value string"), []).collect()}
    assert all(ent[f"MATTHEW {n}"] == ent[f"MATHTEW {n}"] for n in names[:families])
    assert all(ent[f"MARIA {n}"] != ent[f"MARIO {n}"] for n in names[:20])
