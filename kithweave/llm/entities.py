"""Records of two catalogues matched without a shared key.

A graph joins records with their attributes and those with their tokens: persons, title words, identifiers. Random walks from every record train skip-gram vectors in
partitions, which are averaged; a token has a row of a hashed table, so every token of every record is covered. Records are blocked by several tables of hyperplane signs:
of their whole vectors, of a person with a part of the title, of identifiers. Pairs that meet are compared exactly by the cosines of their attributes, and the scores are
calibrated to a probability on pairs whose identifiers tell. That probability alone decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chars import bare
from ..functions.splitting import cached_splitter, is_placeholder
from ..operators.split import known_names
from ..runtime import bounded_rows, bounded_sample, clean_id, cut, cut_each, drop_cut, release, settled, table
from .variants import lead_words, named_words, parse_name

SEED = 11
#: Numbers in a vector of tokens and of a title; rows of the hashed table of trained vectors, which bounds the model whatever the number of tokens.
DIM, TITLE_DIM, ROWS = 32, 64, 1 << 14
#: Walks from each record, rounds of training, negative samples.
WALKS, ROUNDS, NEGATIVES = 1, 1, 2
#: Holders of a token from which on it has several rings.
RING = 2_000
#: Walks trained together in a partition, which makes a table of its own, the tables being averaged; pairs of a centre and its context taken from a walk.
CHUNK, PAIRS = 20_000, 24
#: Longest vector while training, and the weight of the trained direction beside the seed's.
LONGEST, COMPANY = 4.0, 0.5
#: Signs of a table of a person with a part of a title, of an identifier, of a whole record; tables of whole records.
VIEW_BITS, ID_BITS, WHOLE_BITS, WHOLE_TABLES = 28, 40, 20, 4
#: Rows of one side in a bucket from which on its other side is repeated for parts of it.
BUCKET_ROWS = 2_000
#: Shares of the buckets, and then of the works, that are gone through one after the other: all of them, but what they shuffle is not on disk at once.
BUCKET_SHARES, WORK_SHARES = 4, 8
#: Signs of two titles that may differ (of 63) for a pair to be compared: a cosine of zero differs in 31.5 on average, so what is left out are titles that are no more alike
#: than any two.
TITLE_SIGNS = 31
#: Labelled pairs that the scores are fitted and calibrated on, and the probability from which on a pair is the same.
SAMPLE_PAIRS, DECIDE = 20_000, 0.5
# Words without weight in titles.
WEAK = {"OF", "AND", "IN", "ON", "TO", "FOR", "AT", "WITH", "WITHOUT", "FROM", "BY"}
# Words that decorate a recording's title without changing the work.
DECOR = {"LIVE", "REMIX", "DEMO", "ACOUSTIC", "INSTRUMENTAL", "KARAOKE", "REMASTER", "REMASTERED", "EDIT", "MIX", "VERSION", "RADIO", "ORIGINAL", "EXTENDED", "SINGLE", "ALBUM", "MONO", "STEREO", "EXPLICIT", "CLEAN", "BONUS", "TRACK", "DELUXE"}
_TAIL = {"LIVE", "REMIX", "DEMO", "ACOUSTIC", "INSTRUMENTAL", "KARAOKE", "REMASTER", "REMASTERED", "EDIT", "MIX", "VERSION"}
_GUEST = re.compile(r"[(\[]\s*(?:FEAT|FT|FEATURING|WITH)\b[^)\]]*[)\]]|\s(?:FEAT|FT|FEATURING)\b\.?\s.*$")


def core_title(title: str | None) -> str:
    """A title without articles, guests, punctuation and the decoration of a recording at its end."""
    if not title:
        return ""
    words = re.findall(r"[^\W_]+", re.sub(r"['’`´]", "", _GUEST.sub(" ", bare(title))).replace("&", " AND ").replace("+", " AND "))
    words = [w for w in words if w not in ("THE", "A", "AN")] or words
    kept = list(words)
    if kept and kept[-1] in _TAIL:
        while kept and (kept[-1] in DECOR or re.fullmatch(r"(19|20)\d\d", kept[-1])):
            kept.pop()
    return " ".join(kept or words)


def valid_iswc(code: str | None) -> str | None:
    """The code as T and ten digits if its check digit is right; placeholders and mistyped codes are no codes."""
    c = re.sub(r"[^A-Z0-9]", "", (code or "").upper())
    if not re.fullmatch(r"T\d{10}", c):
        return None
    return c if (10 - (1 + sum((i + 1) * int(d) for i, d in enumerate(c[1:10]))) % 10) % 10 == int(c[10]) else None


def seed_vectors(tokens: list[str], dim: int = DIM) -> np.ndarray:
    """A row of fixed random numbers for each token, of length one on average."""
    raw = b"".join(xxhash.xxh3_128_digest(t.encode(), seed=i) for t in tokens for i in range(dim // 16))
    return (np.frombuffer(raw, dtype=np.uint8).reshape(-1, dim).astype(np.float32) - 127.5) / np.float32(73.9 * dim**0.5)


def row_of(token: str) -> int:
    """Spark's xxhash64, so that walks carry rows and not texts."""
    h = xxhash.xxh64(token.encode(), seed=42).intdigest()
    return (h - (1 << 64) if h >> 63 else h) % ROWS


# --- vectors ------------------------------------------------------------------------------------------------------------------------
def train_walks(walks: list[tuple[list[int], list[int]]], seed: int = SEED) -> dict[int, tuple[np.ndarray, int]]:
    """Skip-gram with negative samples over the tokens of two records that a walk joins, each token as its row of the hashed table; (trained direction, times seen) of each row met."""
    rng = np.random.default_rng(seed)
    sizes = np.array([len(x) + len(y) for x, y in walks], dtype=np.int64)
    if not sizes.sum():
        return {}
    rows = np.concatenate([np.asarray(part, dtype=np.int64) for walk in walks for part in walk])
    starts = np.repeat(np.cumsum(sizes) - sizes, PAIRS)
    pick = lambda: rows[np.minimum(starts + (rng.random(len(starts)) * np.repeat(sizes, PAIRS)).astype(np.int64), len(rows) - 1)]
    centres, contexts = pick(), pick()
    ok = (centres != contexts) & (np.repeat(sizes, PAIRS) > 0)
    centres, contexts = centres[ok], contexts[ok]
    if not len(centres):
        return {}
    met = np.unique(np.concatenate([centres, contexts]))
    cs, xs = np.searchsorted(met, centres), np.searchsorted(met, contexts)
    vec = seed_vectors([f"row {r}" for r in met])
    out = np.zeros_like(vec)
    seen = np.bincount(xs, minlength=len(met)).astype(np.float64)
    noise = np.cumsum(seen**0.75)
    rate, size = 0.2, 2048
    for _ in range(ROUNDS):
        order = rng.permutation(len(cs))
        for s in range(0, len(order), size):
            c, x = cs[order[s : s + size]], xs[order[s : s + size]]
            neg = np.searchsorted(noise, rng.random((len(c), NEGATIVES)) * noise[-1])
            targets = np.concatenate([x[:, None], np.minimum(neg, len(met) - 1)], axis=1)
            v, o = vec[c], out[targets]
            score = 1 / (1 + np.exp(-np.clip(np.einsum("bd,bkd->bk", v, o), -8, 8)))
            score[:, 0] -= 1
            step, flat = np.einsum("bk,bkd->bd", score, o), (score[:, :, None] * v[:, None, :]).reshape(-1, DIM)
            for m, i, g in ((vec, c, step), (out, targets.ravel(), flat)):
                # a row met often in one batch moves by the sum of its steps over the root of their number: its error shrinks no faster
                order_i = np.argsort(i, kind="stable")
                ids, first, often = np.unique(i[order_i], return_index=True, return_counts=True)
                m[ids] -= rate * np.add.reduceat(g[order_i], first, axis=0) / np.sqrt(often)[:, None]
                m[ids] /= np.maximum(np.linalg.norm(m[ids], axis=1, keepdims=True) / LONGEST, 1)
    return {int(r): (vec[i], int(seen[i])) for i, r in enumerate(met)}


def token_list():
    """P:, W: and I: tokens of a record's persons, title words and identifier."""
    none = F.array().cast("array<string>")
    return F.concat(
        F.transform(F.array_union("writers", "artists"), lambda p: F.concat(F.lit("P:"), p)), F.transform(_words(F.col("core")), lambda w: F.concat(F.lit("W:"), w)), F.when(F.col("code").isNotNull(), F.array(F.concat(F.lit("I:"), F.col("code")))).otherwise(none)
    )


def record_rows(recs: DataFrame) -> DataFrame:
    """(r, k): a record and its tokens by their hashes, whose remainders are their rows."""
    tok = recs.select(F.col("rid").alias("r"), F.array_distinct(F.transform(token_list(), lambda t: F.xxhash64(t))).alias("k"))
    return cut(tok.where("size(k) > 0"))


def walks_of(tok: DataFrame, ring: int = RING) -> DataFrame:
    """(x, y): rows of all tokens of every record and of a record that a walk over one of its tokens leads to. The holders of a token stand in a ring by hash, and a walk goes to the
    next one, so every holder of every token may be reached and none is left out. A token of more than `ring` holders has several rings, to which these are sent by hash; no token
    is gathered in one task. A token's only holder leads to itself."""
    each = tok.select("r", F.explode("k").alias("t"))
    hot = each.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ring).select("t", F.ceil(F.col("n") / ring).alias("rings"))
    to = None
    for i in range(WALKS):
        held = tok.withColumn("own", _pick(i)).select("r", "own", F.explode("k").alias("t")).select("r", "t", (F.col("t") == F.col("own")).alias("walks"))
        held = held.join(hot, "t", "left").withColumn("part", F.pmod(F.xxhash64("r", F.lit(i), F.lit("ring")), F.coalesce("rings", F.lit(1)))).drop("rings")
        by = Window.partitionBy("t", "part").orderBy(F.xxhash64("r", F.lit(i)), "r")
        to_next = held.withColumn("to", F.coalesce(F.lead("r").over(by), F.first("r").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))).where("walks").select("r", "to")
        to = to_next if to is None else to.unionByName(to_next)
    rows = lambda n, c: tok.select(F.col("r").alias(n), F.transform("k", _row).alias(c))
    return to.join(rows("r", "x"), "r").join(rows("to", "y"), "to").select("x", "y")


def _row(k):
    return F.pmod(k, F.lit(ROWS)).cast("int")


def _pick(i: int):
    return F.array_min(F.transform("k", lambda t: F.struct(F.xxhash64(t, F.col("r"), F.lit(i)).alias("h"), t.alias("t"))))["t"]


def train_vectors(recs: DataFrame) -> np.ndarray:
    """The table of trained directions, ROWS x DIM, zero where no token falls. Walks over all records are trained in partitions and averaged by how often a row was met; what
    comes to the driver is the table, whose size is fixed."""

    def run(batches):
        walks = []
        for b in batches:
            walks += zip(b["x"], b["y"])
            while len(walks) >= CHUNK:
                got, walks = train_walks(walks[:CHUNK]), walks[CHUNK:]
                yield frame(got)
        if walks:
            yield frame(train_walks(walks))

    def frame(got):
        return pd.DataFrame({"row": list(got), "n": [n for _, n in got.values()], "v": [v.tolist() for v, _ in got.values()]})

    tok = record_rows(recs)
    walks = walks_of(tok)
    trained = walks.repartition(max(1, recs.count() * WALKS // CHUNK)).mapInPandas(run, "row int, n bigint, v array<float>")
    mean = trained.groupBy("row").agg(F.sum("n").alias("n"), *(F.sum(F.col("v")[i] * F.col("n")).alias(f"v{i}") for i in range(DIM)))
    out = np.zeros((ROWS, DIM), dtype=np.float32)
    rows = bounded_rows(mean, ROWS, "trained rows")
    del walks, trained, mean
    drop_cut(tok)
    release(recs.sparkSession)
    if rows:
        at = np.array([r["row"] for r in rows])
        m = np.array([[r[f"v{i}"] / max(r["n"], 1) for i in range(DIM)] for r in rows], dtype=np.float32)
        m -= m.mean(axis=0)  # what all vectors have in common tells nothing apart
        out[at] = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-6)
    return out


class Sums:
    """Sums of vectors of tokens, the vectors remembered in one growing matrix."""

    def __init__(self, make, dim: int, most: int = 300_000):
        self.make, self.dim, self.most = make, dim, most
        self.index: dict[str, int] = {}
        self.matrix = np.zeros((0, dim), dtype=np.float32)

    def ids(self, lists: list[list[str]]) -> list[list[int]]:
        index = self.index
        if len(index) > self.most:
            index.clear()
            self.matrix = self.matrix[:0]
        old = len(index)
        out = [[index.setdefault(t, len(index)) for t in x] for x in lists]
        if len(index) > old:
            self.matrix = np.concatenate([self.matrix, self.make(list(index)[old:])])
        return out

    def sums(self, ids: list[list[int]]) -> np.ndarray:
        """A row for each list: the sum of its tokens' vectors."""
        out = np.zeros((len(ids), self.dim), dtype=np.float32)
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            flat = self.matrix[np.array([t for x in ids for t in x], dtype=np.int64)]
            out[full] = np.add.reduceat(flat, (np.cumsum(sizes) - sizes)[full], axis=0)
        return out


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-6)


def title_views(core: str) -> list[str]:
    """Parts of a title: its first and last half without blanks, with the length of the shorter of two titles a typing error apart, as which or beside which it stands. Of two such
    titles at least one part is the same; a letter or two between the halves keep a swap from touching both, and titles of other lengths share none."""
    c = (core or "").replace(" ", "")
    n = len(c)
    return [x for s in (n - 1, n) if s > 0 for h in [(s - 1) // 2] for x in (f"<{s}:{c[:h]}", f">{s}:{c[n - h :]}")]


def _signs(v: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return ((v @ planes > 0).astype(np.int64) << np.arange(planes.shape[1], dtype=np.int64)).sum(axis=-1)


_NUMERAL = re.compile(r"[IVX]+|\d+")


class Hasher:
    """Buckets, vector, title vector and title signs of records."""

    def __init__(self, trained: np.ndarray):
        self.tokens = Sums(lambda ts: _unit(seed_vectors(ts) + COMPANY * trained[[row_of(t) for t in ts]]), DIM)
        self.grams = Sums(lambda gs: seed_vectors(gs, TITLE_DIM), TITLE_DIM)
        rng = np.random.default_rng(SEED)
        plane = lambda d, b: rng.standard_normal((d, b)).astype(np.float32)
        self.view, self.ident, self.tables, self.title = plane(DIM, VIEW_BITS), plane(DIM, ID_BITS), [plane(DIM, WHOLE_BITS) for _ in range(WHOLE_TABLES)], plane(TITLE_DIM, 63)

    def titles(self, cores: list[str]) -> np.ndarray:
        """Of pairs and triples of letters without blanks, and of numerals, which tell titles apart however few letters they have."""
        marked = [f"^{c.replace(' ', '')}$" for c in cores]
        n = len(cores)
        ids = self.grams.ids([[c[i : i + k] for k in (2, 3) for i in range(len(c) - k + 1)] for c in marked] + [[f"N:{w}" for w in c.split() if _NUMERAL.fullmatch(w)] for c in cores])
        return _unit(_unit(self.grams.sums(ids[:n])) + 0.7 * self.grams.sums(ids[n:]))

    def batch(self, persons: list[list[str]], words: list[list[str]], cores: list[str], codes: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """For each record its buckets, its vector, its title's vector and the signs of that."""
        n = len(cores)
        ids = self.tokens.ids([[f"P:{p}" for p in x] for x in persons] + [[f"W:{w}" for w in x] for x in words])
        whole, title = _unit(self.tokens.sums([p + w for p, w in zip(ids[:n], ids[n:])])), self.titles(cores)
        some = np.array([r for r in range(n) if ids[r] or ids[n + r]], dtype=np.int64)
        of, keys = [np.repeat(some, WHOLE_TABLES)], [np.stack([_signs(whole[some], p) | ((2 + t) << 56) for t, p in enumerate(self.tables)], axis=1).ravel()]
        views = [title_views(c) if p else [] for p, c in zip(ids[:n], cores)]
        parts = seed_vectors([v for x in views for v in x])
        at, ps, ts, rs = 0, [], [], []
        for r, x in enumerate(views):
            k, p = len(x), ids[r]
            if k:
                ps += [i for i in p for _ in range(k)]
                ts += list(range(at, at + k)) * len(p)
                rs += [r] * (k * len(p))
            at += k
        if rs:
            of.append(np.array(rs, dtype=np.int64))
            keys.append(_signs(self.tokens.matrix[ps] + parts[ts], self.view) | (1 << 56))
        coded = [r for r, c in enumerate(codes) if c]
        if coded:
            of.append(np.array(coded, dtype=np.int64))
            keys.append(_signs(seed_vectors(["I:" + codes[r] for r in coded]), self.ident) | (60 << 56))
        of, keys = np.concatenate(of), np.concatenate(keys)
        order = np.lexsort((keys, of))
        of, keys = of[order], keys[order]
        first = np.ones(len(of), dtype=bool)
        first[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
        of, keys = of[first], keys[first]
        return np.split(keys, np.searchsorted(of, np.arange(1, n))), whole, title, _signs(title, self.title)


# --- records ------------------------------------------------------------------------------------------------------------------------
def _record_hash(side: str, id_col: str):
    """64 bits for a record of a side, by which what belongs to it travels; null for a null or blank id."""
    return F.when(clean_id(id_col).isNotNull(), F.xxhash64(F.lit(side), clean_id(id_col)))


def _people(spark, sf_dir: str, known: list[str]) -> DataFrame:
    """(h, writers, artists): the persons and acts of every record, by their leading words."""
    rows = None
    for side, name, id_col, value, writer in (("a", "adc_composers", "apra_work_id", "name", True), ("a", "adcartists", "apra_work_id", "name", False), ("m", "composers", "track_id", "composer", True), ("m", "recordings", "track_id", "artist_name", False)):
        part = table(spark, sf_dir, name).select(_record_hash(side, id_col).alias("h"), F.lit(writer).alias("writer"), F.col(value).alias("value")).where("h is not null and value is not null")
        rows = part if rows is None else rows.unionByName(part)
    state: dict = {}

    @F.pandas_udf("array<array<string>>")
    def words(s: pd.Series) -> pd.Series:
        if "f" not in state:
            state["f"] = cached_splitter(known)
        return pd.Series([[w for w in (parse_name(n)[0] for n in state["f"](v) if not is_placeholder(n)) if w] for v in s], dtype=object)

    held = rows.select("value").distinct().select(F.xxhash64("value").alias("v"), F.explode(words.asNondeterministic()("value")).alias("words"), F.lit(None).cast("string").alias("nick"))
    named = cut(named_words(held.withColumnRenamed("v", "value")).select(F.col("value").alias("v"), F.xxhash64("node").alias("n"), "node", "kept"))
    leads = settled(lambda: lead_words(named.select("node", "kept")).select(F.xxhash64("node").alias("n"), "leads"))
    leads = named.select("v", "n").join(leads, "n").groupBy("v").agg(F.array_distinct(F.flatten(F.collect_set("leads"))).alias("leads"))
    said = rows.select("h", "writer", F.xxhash64("value").alias("v")).join(leads, "v").select("h", "writer", F.explode("leads").alias("lead"))
    return said.groupBy("h").agg(F.array_sort(F.collect_set(F.when(F.col("writer"), F.col("lead")))).alias("writers"), F.array_sort(F.collect_set(F.when(~F.col("writer"), F.col("lead")))).alias("artists"))


def _title_parts(title, iswc):
    @F.pandas_udf("core string, code string")
    def run(titles: pd.Series, codes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"core": [core_title(t) for t in titles], "code": [valid_iswc(c) for c in codes]})

    return run(title, iswc)


def records(spark, sf_dir: str) -> DataFrame:
    """(rid, side, stored, core, code, writers, artists) of every work and track; repeated rows count once, a null id is no record. rid is a number by which records travel; it holds once the records are written."""
    a = table(spark, sf_dir, "adcworks").select(F.lit("a").alias("side"), F.col("apra_work_id").alias("stored"), _record_hash("a", "apra_work_id").alias("h"), "title", "iswc")
    m = table(spark, sf_dir, "tracks").select(F.lit("m").alias("side"), F.col("track_id").alias("stored"), _record_hash("m", "track_id").alias("h"), "title", "iswc")
    one = a.unionByName(m).where("h is not null").groupBy("h", "side").agg(F.min("stored").alias("stored"), F.max("title").alias("title"), F.max("iswc").alias("iswc"))
    one = one.withColumn("_t", _title_parts("title", "iswc")).select("h", "side", "stored", "_t.core", "_t.code")
    people = _people(spark, sf_dir, known_names(spark, sf_dir))
    none = F.array().cast("array<string>")
    made = one.join(people, "h", "left").withColumn("writers", F.coalesce("writers", none)).withColumn("artists", F.coalesce("artists", none))
    return made.drop("h").withColumn("rid", F.monotonically_increasing_id())


def _words(core):
    core = F.coalesce(core, F.lit(""))
    strong = F.filter(F.split(core, " "), lambda w: (w != "") & ~w.isin(sorted(WEAK)))
    return F.when(F.size(strong) > 0, strong).otherwise(F.filter(F.split(core, " "), lambda w: w != ""))


def hashed(recs: DataFrame, trained: np.ndarray | None = None) -> DataFrame:
    """recs with `keys`, the buckets of each record, `vec` and `title_vec`, its vectors, and `signs` of its title. trained: the table of train_vectors, made here unless given."""
    shared = recs.sparkSession.sparkContext.broadcast(train_vectors(recs) if trained is None else trained)
    state: dict = {}

    @F.pandas_udf("keys array<bigint>, vec binary, title_vec binary, signs bigint")
    def run(persons: pd.Series, words: pd.Series, core: pd.Series, code: pd.Series) -> pd.DataFrame:
        if "h" not in state:
            state["h"] = Hasher(shared.value)
        keys, whole, title, signs = state["h"].batch([sorted(p) for p in persons], [sorted(w) for w in words], [c or "" for c in core], list(code))
        # a byte a number: cosines are then right to a hundredth
        packed = lambda m: [v.tobytes() for v in np.rint(m * 127).astype(np.int8)]
        return pd.DataFrame({"keys": keys, "vec": packed(whole), "title_vec": packed(title), "signs": signs})

    return recs.withColumn("_h", run(F.array_union("writers", "artists"), _words(F.col("core")), "core", "code")).select("*", "_h.*").drop("_h")


# --- pairs --------------------------------------------------------------------------------------------------------------------------
def _share(of: str, i: int, n: int):
    return F.pmod(F.xxhash64(F.col(of), F.lit("share")), F.lit(n)) == i


def meetings(h: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(work, track) of different sides, by `rid`, once for each bucket that they share, if their titles may be alike by their signs or the bucket is an identifier's; a cut.

    A bucket with more works than bucket_rows is split by their hash, and its tracks are repeated for every part; no bucket meets in one task and none is cut.
    """
    keyed = h.select((F.col("side") == "a").alias("work"), "rid", "signs", F.explode("keys").alias("key"))
    # most buckets hold records of one side only; they go no further than their counts
    both = keyed.groupBy("key").agg(F.count_if("work").cast("int").alias("a"), F.count_if(~F.col("work")).cast("int").alias("m")).where("a > 0 and m > 0")
    both = cut(both.select("key", F.ceil(F.col("a") / bucket_rows).cast("int").alias("parts")))
    release(h.sparkSession)

    def of(i: int) -> DataFrame:
        met = keyed.where(_share("key", i, BUCKET_SHARES)).join(both, "key")
        a = met.where("work").select("key", F.col("rid").alias("work"), F.col("signs").alias("sa"), F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part"))
        m = met.where("not work").select("key", F.col("rid").alias("track"), F.col("signs").alias("sm"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        # by their signs as soon as they meet, so that others are not shuffled
        near = F.bit_count(F.col("sa").bitwiseXOR(F.col("sm"))) <= TITLE_SIGNS
        return a.join(m, ["key", "part"]).where(near | (F.shiftright("key", 56) == 60)).select("work", "track")

    pairs = cut_each(of(i) for i in range(BUCKET_SHARES))
    drop_cut(both)
    return pairs


def candidates(h: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The distinct pairs of meetings."""
    return meetings(h, bucket_rows).distinct()


def _cosine(left, right):
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        a, b = (_unit(np.frombuffer(b"".join(bytes(v) for v in s), dtype=np.int8).reshape(len(x), -1).astype(np.float64)) for s in (x, y))
        return pd.Series((a * b).sum(axis=1))

    return run(left, right)


def compare(spark, sf_dir: str, trained: np.ndarray | None = None) -> DataFrame:
    """Pairs that share a bucket, with the exact cosines of their vectors and titles and how their persons agree; a cut."""
    recs = settled(lambda: records(spark, sf_dir))
    h = cut(hashed(recs, trained))
    drop_cut(recs)
    release(spark)
    pairs = meetings(h)
    slim = cut(h.select(
        "rid", "side", "stored", F.xxhash64("core").alias("title_hash"), F.length("core").alias("letters"), F.xxhash64("code").alias("code_hash"), F.col("code").isNotNull().alias("coded"), "vec", "title_vec",
        F.transform("writers", lambda p: F.xxhash64(p)).alias("writers"), F.transform("artists", lambda p: F.xxhash64(p)).alias("artists"),
    ))
    drop_cut(h)
    side = lambda s, p: slim.where(F.col("side") == s).select(F.col("rid").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in slim.columns[2:]))
    shared = lambda c: F.size(F.array_intersect(f"work_{c}", f"track_{c}"))
    least = lambda c: F.least(F.size(f"work_{c}"), F.size(f"track_{c}"))
    most = lambda c: F.greatest(F.size(f"work_{c}"), F.size(f"track_{c}"))
    either = lambda p: F.array_union(f"{p}_writers", f"{p}_artists")
    both_coded, both_titled = F.col("work_coded") & F.col("track_coded"), (F.coalesce("work_letters", F.lit(0)) > 0) & (F.coalesce("track_letters", F.lit(0)) > 0)

    def of(i: int) -> DataFrame:
        # one shuffle by work makes pairs distinct and joins them
        mine = pairs.where(_share("work", i, WORK_SHARES)).repartition("work").distinct()
        full = mine.join(side("a", "work").where(_share("work", i, WORK_SHARES)), "work").join(side("m", "track"), "track")
        return full.select(
            F.col("work_stored").alias("apra_work_id"), F.col("track_stored").alias("muzooka_track_id"),
            (both_coded & (F.col("work_code_hash") == F.col("track_code_hash"))).alias("same_code"), (both_coded & (F.col("work_code_hash") != F.col("track_code_hash"))).alias("other_code"),
            _cosine("work_vec", "track_vec").alias("cosine"), F.when(both_titled, _cosine("work_title_vec", "track_title_vec")).otherwise(0.0).alias("title"),
            (both_titled & (F.col("work_title_hash") == F.col("track_title_hash"))).alias("same_title"), F.coalesce(F.least("work_letters", "track_letters"), F.lit(0)).alias("letters"),
            shared("writers").alias("writers"), least("writers").alias("least_writers"), most("writers").alias("most_writers"), shared("artists").alias("artists"), least("artists").alias("least_artists"),
            F.size(F.array_intersect(either("work"), either("track"))).alias("persons"),
        )

    return cut_each(of(i) for i in range(WORK_SHARES))


#: What is believed before any labelled pair is seen: that pairs of alike titles with a person in common are the same and others not, for each of these cosines of titles and
#: numbers of persons (writers shared, least and most of either side, performers shared, least), each pair counting as one labelled pair; and how often codes agree,
#: (share, pairs' worth), on the same and on other compositions. Beside thousands of labelled pairs they weigh nothing.
TYPICAL_TITLES, ALIKE_TITLES = (1.0, 0.85, 0.8, 0.6, 0.5, 0.2), 0.75
TYPICAL_PERSONS = [(1, 1, 1, 0, 0), (1, 1, 2, 0, 0), (2, 2, 2, 0, 0), (2, 2, 4, 0, 0), (2, 3, 3, 1, 1), (1, 1, 1, 1, 1), (0, 0, 0, 1, 1), (0, 0, 0, 2, 2), (0, 0, 1, 1, 2), (0, 0, 0, 0, 0), (0, 0, 2, 0, 0), (0, 1, 1, 0, 1), (0, 2, 2, 0, 0)]
ALIKE, CHANCE = (0.98, 50), (0.001, 1000)


# --- probability --------------------------------------------------------------------------------------------------------------------
FEATURES = ["cosine", "title", "same_title", "letters", "writers", "least_writers", "most_writers", "artists", "least_artists", "persons"]


def features(x: dict[str, np.ndarray]) -> np.ndarray:
    """What a pair is scored by: cosines, agreement of titles, writers and performers, and products of any two."""
    f = {k: np.asarray(x[k], dtype=np.float64) for k in FEATURES}
    told_w, told_a = f["least_writers"] > 0, f["least_artists"] > 0
    cols = [
        f["cosine"], f["title"], np.maximum(f["title"] - 0.7, 0), f["same_title"], np.log1p(np.maximum(f["letters"], 0)), told_w, f["writers"] > 0, f["writers"] / np.maximum(f["least_writers"], 1), f["writers"] / np.maximum(f["most_writers"], 1),
        np.minimum(f["writers"], 3), told_a, f["artists"] > 0, np.minimum(f["persons"], 3), f["persons"] > 0,
    ]
    base = np.stack([np.asarray(c, dtype=np.float64) for c in cols], axis=1)
    i, j = np.triu_indices(base.shape[1])
    return np.concatenate([np.ones((len(base), 1)), base, base[:, i] * base[:, j]], axis=1)


@dataclass
class Model:
    """Weights of the score, its calibration, and how often codes agree on the same and on other compositions."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    steps: list[tuple[float, float]]
    alike: float
    chance: float

    def score(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return ((features(x) - self.middle) / self.spread) @ self.weights

    def probability(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """Of being the same, by the calibrated score and then by what the codes say, where both have one."""
        at, level = np.array([s for s, _ in self.steps]), np.array([p for _, p in self.steps])
        g = np.interp(self.score(x), at, level)
        p = np.clip((g - self.chance) / max(self.alike - self.chance, 1e-6), 1e-4, 1 - 1e-4)
        same, other = np.asarray(x["same_code"], dtype=bool), np.asarray(x["other_code"], dtype=bool)
        yes, no = np.where(same, self.alike, np.where(other, 1 - self.alike, 1.0)), np.where(same, self.chance, np.where(other, 1 - self.chance, 1.0))
        return p * yes / (p * yes + (1 - p) * no)


def calibrate(scores: np.ndarray, truth: np.ndarray) -> list[tuple[float, float]]:
    """(score, probability), rising, by pooling neighbours that violate the order. A pool of n with y true stands at its mean score with (y + 0.5) / (n + 1)."""
    order = np.lexsort((truth, scores))
    pools: list[list[float]] = []
    level = lambda p: (p[1] + 0.5) / (p[2] + 1)
    for s, y in zip(scores[order], truth[order]):
        pools.append([float(s), float(y), 1.0])
        while len(pools) > 1 and level(pools[-2]) >= level(pools[-1]):
            last = pools.pop()
            pools[-1] = [x + z for x, z in zip(pools[-1], last)]
    return [(p[0] / p[2], level(p)) for p in pools]


def typical() -> list[dict]:
    out = []
    for letters in (5, 10, 20):
        for title in TYPICAL_TITLES:
            for w, least, most, a, least_a in TYPICAL_PERSONS:
                some = w + a > 0
                out.append({"same_code": some and title >= ALIKE_TITLES, "cosine": 0.2 + 0.3 * title + 0.3 * some, "title": title, "same_title": title == 1, "letters": letters, "writers": w, "least_writers": least, "most_writers": most, "artists": a, "least_artists": least_a, "persons": w + a})
    return out


def fit(rows: list) -> Model:
    """A ridge logistic score on labelled pairs, half of them for the weights and half for the calibration; all for both where they are few."""
    rows = typical() + list(rows)
    y = np.array([r["same_code"] for r in rows], dtype=np.float64)
    x = {k: np.array([float(r[k]) for r in rows]) for k in FEATURES}
    f = features(x)
    middle, spread = f.mean(axis=0), f.std(axis=0)
    middle[0], spread = 0, np.where(spread < 1e-9, 1, spread)
    z = (f - middle) / spread
    half = np.arange(len(y)) % 2 == 0
    if len(y) < 200 or not 0 < y[half].sum() < half.sum():
        half[:] = True
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), 1.0)
    ridge[0] = 1e-6
    a, t = z[half], y[half]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (t - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    rest = ~half if not half.all() else half
    steps = calibrate(z[rest] @ w, y[rest])
    # on pairs that are surely the same codes agree but for mistakes; on pairs that are surely not, by chance
    score = z[rest] @ w
    top, low = score >= np.quantile(score[y[rest] == 1], 0.5), score <= np.quantile(score[y[rest] == 0], 0.5)
    prior = lambda chosen, share, worth: float((y[rest][chosen].sum() + share * worth) / (chosen.sum() + worth))
    return Model(middle, spread, w, steps, prior(top, *ALIKE), prior(low, *CHANCE))


def match_entities(spark, sf_dir: str, trained: np.ndarray | None = None) -> DataFrame:
    """(apra_work_id, muzooka_track_id, confidence, cosine, title, writers, artists, same_code) of the pairs that are the same composition with probability DECIDE or more.

    Where few pairs have identifiers to learn from, TYPICAL pairs decide. Empty tables give an empty result.
    """
    scored = settled(lambda: compare(spark, sf_dir, trained))
    keys = ["apra_work_id", "muzooka_track_id"]
    rows = bounded_sample(scored.where("same_code or other_code").select(*keys, "same_code", *FEATURES), SAMPLE_PAIRS, keys)
    model = fit(sorted(rows, key=lambda r: (r[keys[0]], r[keys[1]])))
    out = [*keys, "confidence", "cosine", "title", "writers", "artists", "same_code"]

    @F.pandas_udf("double")
    def probability(*cols: pd.Series) -> pd.Series:
        return pd.Series(model.probability({k: c.to_numpy() for k, c in zip([*FEATURES, "same_code", "other_code"], cols)}))

    return scored.withColumn("confidence", probability(*FEATURES, "same_code", "other_code")).where(F.col("confidence") >= DECIDE).select(*out)


def p2_found(spark, sf_dir: str) -> DataFrame:
    return match_entities(spark, sf_dir).select("apra_work_id", "muzooka_track_id")


def p2_matches(spark, sf_dir: str) -> DataFrame:
    """As p2_found, with a confidence and what it rests on."""
    return match_entities(spark, sf_dir)


SQL: dict[str, str] = {}
