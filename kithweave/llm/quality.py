"""Statistics of each text, and which texts are prose.

Each document is read once into a row of counts and ratios. Mergeable quantile sketches of every statistic are built per language and merged into one of all
languages, towards which the percentiles of languages with few documents are drawn. A value becomes a robust z-score by its language's median and deciles, widened by
the value's own sampling error in a short text, and texts in the far tails are no prose.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import bounded_rows, cut, table

_MATH = re.compile(r"\$\$[^$]*\$\$|\$[^$\n]*(?:\n[^$\n]+)?\$|\\\[.*?\\\]|\\begin\{(equation|align|eqnarray|displaymath|gather|multline)(\*?)\}.*?\\end\{\1\2\}", re.S)
_COMMAND = re.compile(r"\\[A-Za-z@]+\*?(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?|[{}~%]")
_WORD = re.compile(r"[^\W\d_]+")
_ENTRY = re.compile(r"\s*(?:\\item|\\bibitem|\\contentsline|[-*+•]\s|\d+[.)])")
_ROW = re.compile(r"&.*\\\\|\|.*\||\t.*\t|;.*;.*;|^[^,]*(?:,\s*\d+)+\s*$|\.{4}|\\dotfill|(?:-?\d[\d.]*\s*[,;]\s*){2}|^\s*\w+\s*=\s*[{\"]|^\s*@\w+\{")
_SENTENCE = re.compile(r"[.!?…](?=[\s\"'”»)]|$)")
_SHUFFLED = re.compile(r"(?<=[^\W\d_A-ZА-ЯÀ-Þ] )([A-ZА-ЯÀ-Þ][^\W\d_]*)")
#: Words of a window in which repetition is measured, so that long texts aren't taken for repetitive.
WINDOW_WORDS = 300
#: Words of a run: longer than a sentence, so that in prose of any length hardly any run comes twice.
RUN_WORDS = 25
#: Robust z-score beyond which a tail is far, documents' worth of the pooled percentiles in those of a language, accuracy of the sketches.
FAR, PRIOR, SKETCH_K = 4.0, 50, 200
#: The ninth decile of a normal distribution.
DECILE = 1.2815515655446004
#: A share of common words from which they tell the language.
TELLING_SHARE = 0.2

FIELDS = [
    ("n_chars", pa.int64()), ("n_words", pa.int64()), ("n_lines", pa.int64()), ("mean_word_length", pa.float64()), ("symbol_ratio", pa.float64()), ("digit_ratio", pa.float64()),
    ("upper_ratio", pa.float64()), ("punctuated_lines", pa.float64()), ("common_share", pa.float64()), ("entry_share", pa.float64()), ("row_share", pa.float64()), ("word_density", pa.float64()),
    ("n_sentences", pa.int64()), ("sentence_rate", pa.float64()), ("misplaced_capitals", pa.float64()), ("fresh_trigrams", pa.float64()), ("fresh_runs", pa.float64()), ("language", pa.string()),
]


def text_statistics(text: str | None, common: dict[str, frozenset[str]], declared: str | None = None) -> dict | None:
    """The statistics of a text; None for null, empty and blank ones."""
    if text is None or not text.strip():
        return None
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    plain = _MATH.sub(" ", text) if "\\" in text or "$" in text else text
    body = _COMMAND.sub(" ", plain) if "\\" in plain else plain
    words = _WORD.findall(body)
    n = len(words)
    low = [w.lower() for w in words]
    counts = Counter(low)
    best, hits = None, 0
    for lang, listed in sorted(common.items()):
        h = sum(counts[w] for w in listed if w in counts)
        if h > hits:
            best, hits = lang, h
    share = hits / n if n else 0.0
    name = (declared or "").strip().lower()[:2]
    language = best if share >= TELLING_SHARE else name if name in common else "und"
    lines = [x for x in plain.split("\n") if x.strip()]
    entry = sum(len(x) for x in lines if _ENTRY.match(x))
    row = sum(len(x) for x in lines if _ROW.search(x))
    kept = max(1, sum(map(len, lines)))
    listed = common.get(best, frozenset())
    misplaced = sum(m.lower() in listed for m in _SHUFFLED.findall(body))
    fresh, of = 0, 0
    for at in range(0, max(n - 2, 0), WINDOW_WORDS):
        w = low[at : at + WINDOW_WORDS + 2]
        if len(w) > 2:
            fresh += len(set(zip(w, w[1:], w[2:])))
            of += len(w) - 2
    runs = max(n - RUN_WORDS + 1, 0)
    fresh_runs = len(set(zip(*(low[i : i + runs] for i in range(RUN_WORDS))))) / runs if runs else 1.0
    sentences, size = len(_SENTENCE.findall(body)), len(text)
    letters = sum(len(w) for w in words)
    blanks, digits = sum(map(str.isspace, text)) if not text.isascii() else size - len("".join(text.split())), sum(text.count(c) for c in "0123456789")
    alnum = sum(map(str.isalnum, text))
    return {
        "n_chars": size, "n_words": n, "n_lines": len(lines), "mean_word_length": letters / n if n else 0.0, "symbol_ratio": (size - alnum - blanks) / size, "digit_ratio": digits / size,
        "upper_ratio": sum(w[0].isupper() for w in words) / n if n else 0.0, "punctuated_lines": sum(x.rstrip()[-1] in ".!?;:,…。" for x in lines) / max(1, len(lines)), "common_share": share,
        "entry_share": entry / kept, "row_share": row / kept, "word_density": n / size, "n_sentences": sentences, "sentence_rate": sentences / n if n else 0.0,
        "misplaced_capitals": misplaced / n if n else 0.0, "fresh_trigrams": fresh / of if of else 1.0, "fresh_runs": fresh_runs, "language": language,
    }


def common_lists(spark, sf_dir: str) -> dict[str, frozenset[str]]:
    """common_words is a reference table that doesn't grow; its size is checked all the same."""
    lists: dict[str, set[str]] = {}
    for r in bounded_rows(table(spark, sf_dir, "common_words").select("lang", "word").where("lang is not null and word is not null"), 100_000, "common_words"):
        lists.setdefault(r["lang"].strip().lower(), set()).add(r["word"].lower())
    return {k: frozenset(v) for k, v in lists.items()}


def document_statistics(df: DataFrame, common: dict[str, frozenset[str]], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, statistics...) of every document; the statistics of null, empty and blank texts are null. Whole texts are read; an empty table
    gives an empty result, repeated ids give a row each, other columns aren't read."""
    source = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    schema = pa.schema([("doc_id", pa.int64()), *FIELDS])
    ddl = "doc_id bigint, " + ", ".join(f"{n} {'bigint' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for n, t in FIELDS)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = [text_statistics(t, common, d) or {} for t, d in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([g.get(n) for g in got], t) for n, t in FIELDS)], schema=schema)

    return source.mapInArrow(run, ddl)


@dataclass(frozen=True)
class Scaled:
    """A statistic that is sketched: its value on a scale where the spread doesn't depend on its level, the error that a short text makes in it, and which tails are no prose."""

    value: str
    error: str
    low: bool = False
    high: bool = False


def share(value: str, of: str, **tails: bool) -> Scaled:
    """A share of `of` countable things: by the arcsine of its root, the error is half of one over the root of their number, whatever the share."""
    return Scaled(f"asin(sqrt(least(greatest(cast({value} AS double), 0D), 1D)))", f"0.5D / sqrt(greatest({of}, 1))", **tails)


#: The sketched statistics. Those without a tail to flag get their percentile and z-score all the same.
SCALED = {
    "common": share("common_share", "n_words", low=True, high=True),
    "sentences": share("n_sentences / greatest(n_words, 1)", "n_words", low=True),
    "entries": share("entry_share", "n_lines", high=True),
    "rows": share("row_share", "n_lines", high=True),
    "capitals": share("misplaced_capitals", "n_words", high=True),
    "density": share("n_words / n_chars", "n_chars", low=True),
    "fresh": share("fresh_trigrams", "n_words", low=True),
    "runs": share("fresh_runs", "n_words"),
    "words": Scaled("ln(n_words + 1D)", "0D"),
    "length": Scaled("mean_word_length", "mean_word_length / sqrt(greatest(n_words, 1))"),
    "symbols": share("symbol_ratio", "n_chars"),
    "digits": share("digit_ratio", "n_chars"),
    "upper": share("upper_ratio", "n_words"),
    "punctuated": share("punctuated_lines", "n_lines"),
}


def language_marks(values: DataFrame, names: list[str], group: str = "language") -> DataFrame:
    """(language, n, q_<name>...): the 101 percentiles of each column of `names` per language, and for '*' those of all.

    A KLL sketch of each column is built per language before the shuffle and merged after it; that of all is merged from the languages'. The percentiles of a language of n
    documents are drawn towards those of all as if PRIOR more documents had come from there: a language of few documents is measured mostly by what all have in common, one
    of many by itself, without a number at which it would change over.
    """
    grid = F.array(*(F.lit(i / 100) for i in range(101)))
    counts = [F.count(n).alias(f"n_{n}") for n in names]
    by = values.groupBy(F.coalesce(F.col(group), F.lit("und")).alias(group)).agg(F.count(F.lit(1)).alias("n"), *counts, *(F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names))
    by = cut(by, 1)
    # a sketch of nothing has no percentiles
    marks = lambda n, name: F.when(F.col(f"n_{n}") > 0, F.kll_sketch_get_quantile_double(n, grid)).alias(name)
    pooled = by.agg(F.sum("n").alias("n"), *(F.sum(f"n_{n}").alias(f"n_{n}") for n in names), *(F.kll_merge_agg_double(n).alias(n) for n in names)).where("n > 0")
    pooled = cut(pooled.select("n", *(marks(n, f"q_{n}") for n in names)), 1)
    own = by.select(group, "n", *(f"n_{n}" for n in names), *(marks(n, f"_{n}") for n in names)).join(F.broadcast(pooled.drop("n")))

    def drawn(n):
        docs, prior = F.col(f"n_{n}"), F.lit(float(PRIOR))
        return F.coalesce(F.zip_with(f"_{n}", f"q_{n}", lambda x, y: (x * docs + y * prior) / (docs + prior)), F.col(f"q_{n}")).alias(f"q_{n}")

    return own.select(group, "n", *map(drawn, names)).unionByName(pooled.withColumn(group, F.lit("*")))


def _up_to(marks, value):
    return F.filter(marks, lambda g: g <= value)


def tail_scores(values: DataFrame, names: list[str], group: str = "language") -> DataFrame:
    """values with z_<name> and p_<name>: robust z-score and percentile of the columns of `names` among their language's; nulls stay null.

    The middle is the median. The scale above it is the distance of the ninth decile, the scale below it that of the first, each as a multiple of a normal distribution's;
    nothing but the data sets it. Where a column e_<name> gives the error of a value itself, it widens the scale. Without any scale, a value off the median is infinitely far.
    """
    marks = cut(language_marks(values.where(F.coalesce(*(F.col(n) for n in names)).isNotNull()), names, group), 1)
    known = [r[0] for r in bounded_rows(marks.select(group).where(F.col(group) != "und"), 100_000, "languages")]
    joined = values.withColumn("_g", F.when(F.col(group).isin(known), F.col(group)).otherwise("*")).join(F.broadcast(marks.drop("n").withColumnRenamed(group, "_g")), "_g", "left")
    out = []
    for n in names:
        x, q = F.col(n), F.col(f"q_{n}")
        off = x - q[50]
        wide = F.when(off > 0, q[90] - q[50]).otherwise(q[50] - q[10]) / DECILE
        error = F.col(f"e_{n}") if f"e_{n}" in values.columns else F.lit(0.0)
        scale = F.sqrt(wide * wide + error * error)
        far = F.when(off == 0, 0.0).otherwise(F.signum(off) * F.lit(float("inf")))
        out.append(F.when(scale > 0, off / F.when(scale > 0, scale)).otherwise(F.when(off.isNotNull(), far)).alias(f"z_{n}"))
        out.append(F.when(x.isNotNull(), F.greatest(F.size(_up_to(q, x)) - 1, F.lit(0))).alias(f"p_{n}"))
    return joined.select(*values.columns, *out)


def quality(stats: DataFrame) -> DataFrame:
    """The statistics with a percentile and a robust z-score of each sketched one, and is_prose (null where the text is null, empty or blank)."""
    names = list(SCALED)
    told = F.col("n_chars").isNotNull()
    values = stats.select("*", *(F.when(told, F.expr(s.value)).alias(f"v_{n}") for n, s in SCALED.items()), *(F.when(told, F.expr(s.error).cast("double")).alias(f"e_v_{n}") for n, s in SCALED.items()))
    scored = tail_scores(values, [f"v_{n}" for n in names])
    junk = F.lit(False)
    for n, s in SCALED.items():
        z = F.col(f"z_v_{n}")
        junk = junk | ((z < -FAR) if s.low else F.lit(False)) | ((z > FAR) if s.high else F.lit(False))
    out = [c for n in names for c in (F.col(f"z_v_{n}").alias(f"z_{n}"), F.col(f"p_v_{n}").alias(f"p_{n}"))]
    return scored.select(*stats.columns, *out, F.when(told, ~junk).alias("is_prose"))


def _quality(spark, sf_dir: str) -> DataFrame:
    return quality(cut(document_statistics(table(spark, sf_dir, "documents"), common_lists(spark, sf_dir))))


def p10_found(spark, sf_dir: str) -> DataFrame:
    return _quality(spark, sf_dir).where("is_prose = false").select("doc_id").distinct()


def p10_statistics(spark, sf_dir: str) -> DataFrame:
    """Counts, ratios, percentiles, z-scores and is_prose of every document."""
    return _quality(spark, sf_dir)


SQL: dict[str, str] = {}
