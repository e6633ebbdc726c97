"""Queries of the core and their SQL, by name."""

from __future__ import annotations

from .operators import skew, split
from .plans import extras, older, reference

QUERIES = {"p6_found": skew.p6_found, "p6_title_stats": skew.p6_title_stats, "p7_found": split.p7_found, "p7_all_names": split.p7_all_names, **reference.QUERIES, **extras.QUERIES, **older.QUERIES}
SQL = {**skew.SQL, **reference.SQL, **extras.SQL, **older.SQL}
FLAGSHIP = "ref_title_matches"
