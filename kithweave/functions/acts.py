"""Names of acts compared as wholes and as lists of parts."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from .credits import credit_parts, plain
from .people import name_points, pair_points, plain_reading, rule_score
from .similarity import jaro_winkler


def array_score(a: list[str], b: list[str], least: float = 0.8) -> float:
    """Mean over the parts of a of the best Jaro-Winkler above `least` with a part of b; two words in the other order are equal. 0 for an empty list."""
    if not len(a):
        return 0.0
    total = 0.0
    for x in a:
        turned = " ".join(reversed(x.split())) if len(x.split()) == 2 else None
        best = max((1.0 if y in (x, turned) else jaro_winkler(x, y) for y in b), default=0.0)
        total += best if best > least else 0.0
    return total / len(a)


def point_similarity(a: str | None, b: str | None) -> float:
    """Points of the best reading of a pair over the points of the larger name, at most 1."""
    most = max(name_points(a), name_points(b))
    return min(1.0, pair_points(a, b) / most) if most else 0.0


def composition_ratio(a: str | None, b: str | None) -> float:
    """Smaller over larger points of two names that have any points in common."""
    x, y = name_points(a), name_points(b)
    return min(x, y) / max(x, y) if max(x, y) and pair_points(a, b) > 0 else 0.0


def variant_flags(a: str | None, b: str | None, flag_a: str = "ORIGINAL", flag_b: str = "ORIGINAL") -> tuple[str, str]:
    """Which of two matched names is a VARIANT: one of several parts of which one is the other name. A flag that says so already stays."""
    if not a or not b:
        return "ORIGINAL", "ORIGINAL"
    p, q = credit_parts(a), credit_parts(b)
    return ("VARIANT" if len(p) > 1 and plain(b) in p else flag_a, "VARIANT" if len(q) > 1 and plain(a) in q else flag_b)


def _pair(fn, kind="double"):
    def over(a, b):
        @F.pandas_udf(kind)
        def run(x: pd.Series, y: pd.Series) -> pd.Series:
            known = lru_cache(maxsize=100_000)(fn)
            return pd.Series([known(p, q) for p, q in zip(x, y)], dtype="float64")

        return run(F.col(a), F.col(b))

    return over


rule_score_col, point_similarity_col, composition_ratio_col = _pair(rule_score), _pair(point_similarity), _pair(composition_ratio)


def array_score_col(a, b):
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([array_score(list(p), list(q)) for p, q in zip(x, y)], dtype="float64")

    return run(F.col(a), F.col(b))


def variant_flags_col(a, b):
    @F.pandas_udf("is_variant_a string, is_variant_m string")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([variant_flags(p, q) for p, q in zip(x, y)], columns=["is_variant_a", "is_variant_m"])

    return run(F.col(a), F.col(b))


def reading_col(a):
    """First name, surname, points and, for two words, the other order."""

    @F.pandas_udf("first string, last string, points double, other_first string, other_last string")
    def run(x: pd.Series) -> pd.DataFrame:
        rows = []
        for n in x:
            r, w = plain_reading(n), (n or "").split()
            rows.append((r.first, r.last, float(name_points(n)), *((w[1], w[0]) if len(w) == 2 else (None, None))))
        return pd.DataFrame(rows, columns=["first", "last", "points", "other_first", "other_last"])

    return run(F.col(a))


def map_words(c, mapping: dict[str, str]):
    """Words replaced by a map, inside the JVM."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.element_at(m, w), w)), " ")


def parts_from_json(c):
    """A list of parts kept as JSON text; an empty list for null."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
