"""Scalar string functions as built-in column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation that the title cleanser deletes.
TITLE_PUNCTUATION = ".,/#!$%^&*;:{}=-_`~()"
# Accented capitals and their plain letters.
ACCENTS = ("ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "AAAAAAEEEEIIIIOOOOOUUUUNC")


def squeeze(c: Column) -> Column:
    """Trimmed, with single blanks."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def drop_articles(c: Column, trailing: bool = True) -> Column:
    """Without one leading, and one trailing, article."""
    out = F.regexp_replace(squeeze(c), r"(?i)^(a|an|the)(\s+|$)", "")
    return F.regexp_replace(out, r"(?i)(^|\s+)(a|an|the)$", "") if trailing else out


def cleanse_title(c: Column) -> Column:
    """Capitals, no leading article, no punctuation but quotes and square brackets, single blanks; null becomes empty."""
    up = F.regexp_replace(F.upper(F.trim(c)), r"^(THE|A|AN)\s+", "")
    return F.coalesce(squeeze(F.translate(up, TITLE_PUNCTUATION, "")), F.lit(""))


def clean_form(c: Column) -> Column:
    """Lower case, everything but letters and digits a blank."""
    return squeeze(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def compact_form(c: Column) -> Column:
    """Lower case letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")


def no_article_form(c: Column) -> Column:
    return F.regexp_replace(clean_form(c), r"^(the|a|an) ", "")


def word_form(c: Column) -> Column:
    """Lower case, non-word characters blanks: the form that hashes are made of."""
    return squeeze(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", " "))


def iswc_key(c: Column) -> Column:
    """Letters and digits in capitals; empty for null."""
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]", ""))


def isrc_key(c: Column) -> Column:
    """Trimmed, without hyphens and blanks, the first twelve characters."""
    return F.substring(F.upper(F.replace(F.replace(F.trim(c), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))), 1, 12)


def clean_name(c: Column) -> Column:
    """Capitals, letters, digits and single blanks, no articles; the name itself where nothing is left."""
    bare = F.regexp_replace(F.upper(c), "['\"\\-_`&+\\[\\]]", "")
    bare = squeeze(F.regexp_replace(bare, "[^A-Z0-9 ]", " "))
    less = squeeze(F.regexp_replace(bare, r"\b(A|AN|THE)\b", " "))
    return F.when(less != "", less).otherwise(F.upper(F.trim(c)))


def normal_name(c: Column) -> Column:
    """Capitals, one leading bracket and quotes and hyphens deleted, accents dropped."""
    out = F.regexp_replace(F.upper(F.trim(c)), r"^[(\[{]", "")
    return squeeze(F.translate(F.translate(out, "'\"`-", ""), *ACCENTS))


def comparison_name(c: Column) -> Column:
    """A name for comparing: no bracketed text, capitals, no generation at its end, hyphens as blanks."""
    out = F.upper(F.trim(F.regexp_replace(c, r"\([^)]*\)", "")))
    out = F.trim(F.regexp_replace(out, r"\b(I{1,3}|IV|V|1ST|2ND|3RD|[4-9]TH)$", ""))
    return squeeze(F.replace(out, F.lit("-"), F.lit(" ")))


def strip_brackets(c: Column) -> Column:
    """Without bracketed text, in capitals."""
    return F.upper(F.trim(F.regexp_replace(c, r"\([^)]*\)", "")))


def slash_parts(c: Column) -> Column:
    """Values between slashes and semicolons, trimmed, blank ones left out."""
    return F.filter(F.transform(F.split(c, "[/;]"), lambda x: F.trim(x)), lambda x: x != "")


def shingles(c: Column, n: int = 3) -> Column:
    """Distinct substrings of n characters; none for shorter text."""
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substr(c, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def word_and_gram_tokens(c: Column) -> Column:
    """Words and three-character substrings, with repeats."""
    grams = F.when(F.length(c) >= 3, F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substr(c, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.filter(F.split(c, " "), lambda w: w != ""), grams)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 if either is empty or null."""
    a, b = F.upper(F.trim(a)), F.upper(F.trim(b))
    long = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1 - F.levenshtein(a, b) / long).otherwise(F.lit(0.0))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared words over the larger number of distinct words."""
    x, y = F.array_distinct(F.split(word_form(a), " ")), F.array_distinct(F.split(word_form(b), " "))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))


def title_similarity(a: Column, b: Column) -> Column:
    """The larger of the edit-distance ratio and 0.8 times the overlap of words, on word forms."""
    x, y = word_form(a), word_form(b)
    return F.greatest(levenshtein_ratio(x, y), 0.8 * token_overlap(a, b))


def is_truncated(ownership: Column, names: Column, n_a: Column, n_m: Column) -> Column:
    """Y where a names field was cut off: not fully owned, as long as the field allows, and fewer names than the other side has."""
    cut = (F.length(names) == 40) | ((F.length(names) == 39) & (F.right(names, F.lit(1)) == " "))
    return F.when((ownership == "N") & cut & (n_a < n_m), "Y").otherwise("N")


def same_flag(a: Column, b: Column) -> Column:
    """Y for equal values, N for others and for nulls."""
    return F.when(a == b, "Y").otherwise("N")
