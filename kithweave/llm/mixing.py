"""Sources mixed to target shares of tokens by systematic sampling.

Within a source every document is expected equally often. Prefix sums of the expected copies, from one random offset, emit a document once for each
integer they cross. Documents stand in order of size, so the copies drawn carry the source's share of the tokens and not just of the documents. Prefix sums
come from blocks: counts of blocks are summed up first, positions within a block after, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import bounded_rows, cut, table
from .tokens import count_tokens

#: Documents of a block of the prefix sum, rows that mix_targets may have.
BLOCK_DOCUMENTS, MOST_TARGETS = 20_000, 100_000
SEED = 17


def source_name(c):
    """Sources come in either letter case, padded, and with a blank or hyphen for the underscore; blank ones count as missing."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")
    return F.when(s != "", s)


def plan_mix(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(mix_name, source, wanted, scaled, max_repeats, source_tokens, source_documents, rate): a row for each target.

    Shares are scaled to add up to 1 over the sources that have tokens and may be drawn. The size of a mix is total_tokens, or else the tokens of its sources,
    lowered to what the caps allow, so every source reaches its share. rate is the expected number of copies of a document, 0 where none is drawn.
    Targets with a null name, source or share, or a share below 0, are left out; repeated target rows count once.
    """
    have = sized.where("source is not null and n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_documents"))
    t = targets.select("mix_name", source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("wanted"), F.col("max_repeats").cast("long").alias("max_repeats")).distinct()
    t = t.where("mix_name is not null and source is not null and wanted >= 0").join(have, "source", "left")
    by = Window.partitionBy("mix_name")
    usable = (F.col("source_tokens") > 0) & (F.col("wanted") > 0) & F.coalesce(F.col("max_repeats") > 0, F.lit(True))
    t = t.withColumn("_w", F.when(usable, F.col("wanted")).otherwise(0.0))
    t = t.withColumn("scaled", F.col("_w") / F.nullif(F.sum("_w").over(by), F.lit(0.0)))
    bound = F.min(F.when(F.col("scaled") > 0, F.col("max_repeats") * F.col("source_tokens") / F.col("scaled"))).over(by)
    size = F.lit(float(total_tokens)) if total_tokens is not None else F.sum(F.when(F.col("scaled") > 0, F.col("source_tokens"))).over(by).cast("double")
    t = t.withColumn("_size", F.least(size, bound))
    rate = F.when(F.col("scaled") > 0, F.col("scaled") * F.col("_size") / F.col("source_tokens")).otherwise(0.0)
    return t.select("mix_name", "source", "wanted", F.coalesce("scaled", F.lit(0.0)).alias("scaled"), "max_repeats", "source_tokens", "source_documents", rate.alias("rate"))


def ranked_documents(sized: DataFrame, documents_per_block: int = BLOCK_DOCUMENTS) -> DataFrame:
    """(source, doc_id, n_tokens, position): positions from 0 within each source, in order of size; documents without tokens or source have none."""
    d = sized.where("source is not null and n_tokens > 0").withColumn("_bin", F.floor(F.log2("n_tokens") * 4).cast("int"))
    sizes = d.groupBy("source", "_bin").count().select("source", "_bin", F.ceil(F.col("count") / documents_per_block).cast("int").alias("_salts"))
    # as many rows as sources have bins of size, some 100 each
    d = d.join(sizes, ["source", "_bin"]).withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("_salts")).cast("int")).drop("_salts")
    blocks = d.groupBy("source", "_bin", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source").orderBy("_bin", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "_bin", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_bin", "_salt").orderBy("n_tokens", F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
    return d.withColumn("_k", F.row_number().over(inside) - 1).join(blocks, ["source", "_bin", "_salt"]).select("source", "doc_id", "n_tokens", (F.col("_start") + F.col("_k")).alias("position"))


def draw(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, copy): a row for each copy drawn, copies counted from 1; no document more often than max_repeats."""
    rows = [(r["mix_name"], r["source"], r["rate"]) for r in bounded_rows(plan.where("rate > 0").select("mix_name", "source", "rate"), MOST_TARGETS, "mix_targets")]
    rates = F.broadcast(sized.sparkSession.createDataFrame(rows, "mix_name string, source string, rate double"))
    offset = F.pmod(F.xxhash64("mix_name", "source", F.lit(SEED)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    d = ranked_documents(sized).join(rates, "source").withColumn("_u", offset)
    upto = lambda k: F.floor(k * F.col("rate") + F.col("_u"))
    d = d.withColumn("_c", (upto(F.col("position") + 1) - upto(F.col("position"))).cast("int")).where("_c > 0")
    return d.select("mix_name", "source", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("_c"))).alias("copy"))


def sized_documents(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", source_name(F.col("source")).alias("source"), "text")
    return cut(count_tokens(docs, ["doc_id", "source"], "text"))


def p9_mix(spark, sf_dir: str) -> DataFrame:
    """The documents drawn for each mix, a row for each copy."""
    sized = sized_documents(spark, sf_dir)
    return draw(sized, plan_mix(sized, table(spark, sf_dir, "mix_targets")))


def p9_shares(spark, sf_dir: str) -> DataFrame:
    """Wanted and reached share of each source of each mix; a source without documents reaches 0."""
    sized = sized_documents(spark, sf_dir)
    plan = cut(plan_mix(sized, table(spark, sf_dir, "mix_targets")), 1)
    drawn = draw(sized, plan).groupBy("mix_name", "source", "doc_id", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    drawn = drawn.groupBy("mix_name", "source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.sum("copies").alias("drawn_rows"), F.max("copies").alias("most_copies"))
    out = plan.join(drawn, ["mix_name", "source"], "left")
    all_ = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return out.select(
        "mix_name", "source", F.col("wanted").alias("target_share"), F.col("scaled").alias("scaled_share"), F.coalesce(F.col("tokens") / all_, F.lit(0.0)).alias("reached_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("drawn_rows", F.lit(0)).alias("drawn_rows"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )


SQL: dict[str, str] = {}
