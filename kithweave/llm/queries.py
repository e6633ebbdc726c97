"""Queries of the operators for training data and their SQL, by name."""

from __future__ import annotations

from . import components, entities, lookalikes, mixing, quality, tokens, topn, variants

QUERIES = {
    "p1_found": variants.p1_found, "p1_entities": variants.p1_entities, "p2_found": entities.p2_found, "p2_matches": entities.p2_matches,
    "p3_found": topn.p3_found, "p3_ranked": topn.p3_ranked, "p4_found": components.p4_found, "p5_found": lookalikes.p5_found, "p5_canonical": lookalikes.p5_canonical,
    "p8_ids": tokens.p8_ids, "p8_counts": tokens.p8_counts,
    "p9_mix": mixing.p9_mix, "p9_shares": mixing.p9_shares,
    "p10_found": quality.p10_found, "p10_statistics": quality.p10_statistics,
}
SQL = {**topn.SQL, **components.SQL, **lookalikes.SQL, **tokens.SQL, **quality.SQL}
