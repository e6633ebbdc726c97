"""A foreign letter without a look-alike in a Latin word is a case too."""

from kithweave.llm import lookalikes


def test_letter_without_look_alike(spark, folder):
    d = folder(
        composers=([("C1", "VIKTOЖ DAZ"), ("C2", "VIKTOR DAZ"), ("C3", "ЖЖ"), ("C4", None), ("C5", "VIKТOR DAZ")], "composer_id string, composer string"),
        title_matches_lsh=([("M1", "CAFÉ")], "match_id string, muzooka_cleaned_title string"),
    )
    assert {tuple(r) for r in lookalikes.p5_found(spark, d).collect()} == {("composers", "C1"), ("composers", "C5")}
