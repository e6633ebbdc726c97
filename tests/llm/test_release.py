"""What a step of problem 2 needed is off the disk when the next begins."""

import os

from kithweave.llm import entities
from kithweave.runtime import shared_dir


def test_training_leaves_no_files(spark):
    none = []
    rows = [(i, "a" if i % 2 else "m", str(i), f"GOLDEN RIVER {i}", None, ["ANNA UNDERHILL"], none) for i in range(20)]
    recs = spark.createDataFrame(rows, "rid bigint, side string, stored string, core string, code string, writers array<string>, artists array<string>")
    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    assert entities.train_vectors(recs).any()
    assert set(os.listdir(at)) == before
