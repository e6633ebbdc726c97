"""Names of a work and of a track paired one to one, by points."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.people import assign

RESULT = "apra_work_id string, track_id string, atap double, stap double, tap double, smp double, match_percent int, n_pairs int"


def assign_names(pairs: DataFrame) -> DataFrame:
    """pairs: (apra_work_id, track_id, apra_names array, muzooka_names array). Totals of points and the matched share of each pair of records.

    The names of one work and one track are a few; each row is worked on alone, so nothing is grouped or shuffled here.
    """

    def run(batches):
        for b in batches:
            rows = []
            for w, t, x, y in zip(b["apra_work_id"], b["track_id"], b["apra_names"], b["muzooka_names"]):
                r = assign([n for n in x if n], [n for n in y if n])
                rows.append((w, t, float(r["atap"]), float(r["stap"]), float(r["tap"]), float(r["smp"]), r["percent"], len(r["pairs"])))
            yield pd.DataFrame(rows, columns=["apra_work_id", "track_id", "atap", "stap", "tap", "smp", "match_percent", "n_pairs"])

    return pairs.select("apra_work_id", "track_id", "apra_names", "muzooka_names").mapInPandas(run, RESULT)
