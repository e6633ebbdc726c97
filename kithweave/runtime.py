"""What every operator needs from the session: tables, lineage cuts, bounded driver reads."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only a local session, as in tests, may do without: it gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="kithweave-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named


#: Cuts made in the calls of `settled` that are running, innermost last.
_OPEN: list[list[DataFrame]] = []


def cut(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there, and a lost executor costs nothing before it."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kithweave_path = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def cut_each(parts: Iterable[DataFrame]) -> DataFrame:
    """The rows of all parts as one cut. Parts are made and written one after the other, and what one shuffles is off the disk when the next begins."""
    path = out = None
    for df in parts:
        path = path or f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        del df
        release(out.sparkSession)
    out._kithweave_path = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def settled(make: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """The result of `make`, or each of several, as a cut, itself if it is one; the cuts that were made on the way to it are removed, so only results stay in the shared folder."""
    _OPEN.append([])
    try:
        df, inner = make(), _OPEN[-1]
    except BaseException:
        for c in _OPEN.pop():
            drop_cut(c)
        raise
    _OPEN.pop()
    several = isinstance(df, tuple)
    out = tuple(map(kept, df if several else (df,)))
    paths = {d._kithweave_path for d in out}
    c = None
    for c in inner:
        if c._kithweave_path not in paths:
            drop_cut(c)
    if _OPEN:  # a result that `make` cut itself belongs to the outer call now
        _OPEN[-1].extend(d for d in out if not any(d is o for o in _OPEN[-1]))
    # the shuffle files of what led there go with its plans, once nothing refers to these
    del df, inner, c
    release(out[0].sparkSession)
    return out if several else out[0]


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage: the shuffle files of plans that nothing refers to any more are removed with them. Between two cuts that shuffle much, so that both aren't on disk at once.
    Twice, as the first collection only lets go of the plan that ran last."""
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.1)


def kept(df: DataFrame) -> DataFrame:
    """df as a cut, itself if it is one."""
    return df if hasattr(df, "_kithweave_path") else cut(df)


def drop_cut(df: DataFrame | None) -> None:
    """Removes the files of a cut that nothing reads any more."""
    path = getattr(df, "_kithweave_path", None)
    if path:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def bounded_rows(df: DataFrame, most: int, what: str) -> list:
    """Rows of a table whose size is bounded by its nature; more than `most` is an error, never a silent cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} holds more than {most} rows; it is no small reference table")
    return rows


def bounded_sample(df: DataFrame, most: int, keys: list[str]) -> list:
    """About `most` rows, chosen by the hash of their keys, so the same on every run; no more than twice as many reach the driver."""
    n = df.count()
    share = F.lit(min(1.0, most / n if n else 1.0) * 1_000_003)
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1_000_003)) < share).limit(2 * most).collect()


def clean_id(name: str):
    """Ids of title_matches_lsh come padded and in either letter case; blank ones count as missing."""
    c = F.upper(F.trim(F.col(name)))
    return F.when(c != "", c)
