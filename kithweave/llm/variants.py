"""Variant spellings of names typed by people, linked by a trie join.

Every stored value that holds one name becomes the multiset of its words, so the order they are written in doesn't matter. All words are sharded into tries; a Levenshtein
automaton walks each trie and enumerates the words within bounded distance. Two names that agree in all words but one, or but a short form for its full form, are the
same person or act when the company the two words keep says that one is the other misspelt: most names that hold the rarer word exist with the other word too. Given
names are near each other as well, but MARIA and MARIO stand in different families most of the time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chars import bare
from ..functions.splitting import cached_splitter, is_placeholder
from ..operators.split import known_names
from ..runtime import cut, settled, table
from .components import connected_components

# Short forms of words in names of acts.
ABBREVIATIONS = {"ENS": "ENSEMBLE", "QT": "QUARTET", "QNT": "QUINTET", "STR": "STRING", "BROS": "BROTHERS", "ORCH": "ORCHESTRA", "COLL": "COLLECTIVE", "PROJ": "PROJECT", "EXP": "EXPRESS", "SIS": "SISTERS", "SYMPH": "SYMPHONY", "CH": "CHOIR"}
# Words of acts; they are no given names, so no initial stands for them.
ACT_WORDS = {"ENSEMBLE", "QUARTET", "QUINTET", "STRING", "BROTHERS", "ORCHESTRA", "COLLECTIVE", "PROJECT", "EXPRESS", "SISTERS", "SYMPHONY", "CHOIR", "TRIO", "DUO", "BAND", "PHILHARMONIC", "SOUND", "SYSTEM", "SOUNDSYSTEM", "DJ", "MC", "LITTLE", "OLD", "YOUNG", "DIE", "DER", "LOS", "LAS", "LES", "EL", "SINGERS", "GROUP", "CREW", "WITH", "VS"}
# Titles and suffixes that don't tell persons apart here.
TITLES = {"MR", "MRS", "MS", "MISS", "DR", "SIR", "JR", "SR", "PROF"}
# Words without weight in a name.
IDLE = {"THE", "AND"}
# Common short forms of given names.
NICKNAMES = {
    "ABIGAIL": "ABBY", "ALEXANDER": "ALEX AL SASHA", "ANDREW": "ANDY DREW", "ANTHONY": "TONY", "BENJAMIN": "BEN BENNY", "CATHERINE": "CATHY KATE KATIE", "CHARLES": "CHARLIE CHUCK", "CHRISTOPHER": "CHRIS KIT TOPHER",
    "DANIEL": "DAN DANNY", "DEBORAH": "DEB DEBBIE", "DOROTHY": "DOT DOTTIE DOLLY", "EDWARD": "ED EDDIE NED TED", "ELIZABETH": "LIZ BETH BETTY ELIZA LIZZIE", "FREDERICK": "FRED FREDDIE", "GERALD": "GERRY JERRY", "GREGORY": "GREG",
    "HENRY": "HARRY HANK", "JAMES": "JIM JIMMY JAMIE", "JENNIFER": "JEN JENNY", "JOHN": "JACK JOHNNY", "JOSEPH": "JOE JOEY", "KATHLEEN": "KATHY KATH", "LAWRENCE": "LARRY", "LEONARD": "LEN LENNY LEO", "MARGARET": "MAGGIE MEG PEGGY",
    "MATTHEW": "MATT", "MICHAEL": "MIKE MICK MICKEY", "NATHANIEL": "NATE NAT NATHAN", "NICHOLAS": "NICK NICKY", "PATRICIA": "PAT PATTY TRISH", "PETER": "PETE", "PHILIP": "PHIL", "REBECCA": "BECKY BECCA", "RICHARD": "DICK RICK RICH RICKY",
    "ROBERT": "ROB BOB BOBBY ROBBIE", "RONALD": "RON RONNIE", "SAMUEL": "SAM SAMMY", "STEPHEN": "STEVE", "SUSAN": "SUE SUSIE", "THEODORE": "TED THEO TEDDY", "THOMAS": "TOM TOMMY", "TIMOTHY": "TIM", "VICTORIA": "VICKY TORI",
    "VINCENT": "VINCE VINNIE", "WILLIAM": "BILL WILL BILLY WILLIE LIAM", "PHILHARMONIC": "PHIL",
}
#: Typing errors between two words (an adjacent swap is one), and between two names.
ERRORS, NAME_ERRORS = 1, 2
#: Share of the names of the rarer of two near words that must exist with the other word as well.
SHARED = 0.5
#: A word more widespread than its company, as given names are, is the misspelling of another only if it stands in this many times fewer names; so is one that no name
#: shares with the other.
MUCH_RARER = 10
#: Words of a trie; a shard with more is split into blocks, and its words are looked up in each.
TRIE_WORDS = 20_000

SEP = "\u0001"
_NICK = re.compile(r"[\"'“”‘’`´]([^\W\d_]{2,})[\"'“”‘’`´]")
_ASIDE = re.compile(r"\s*[(\[{][^()\[\]{}]*[)\]}]\s*$")


def parse_name(value: str) -> tuple[list[str], str | None]:
    """The words of one name, in their order after turning inversions back, and the short form in quotes, if any."""
    s = bare(value).strip()
    if len(s) > 2 and s[0] == s[-1] and s[0] in "\"'":
        s = s[1:-1]
    aside = _ASIDE.sub("", s)
    s = aside or s
    nick = _NICK.search(s)
    if nick:
        s = s[: nick.start()] + " " + s[nick.end() :]
    if s.count(",") == 1:
        left, right = (x.strip() for x in s.split(","))
        s = f"{right} {left}" if right else left
    s = re.sub(r"(?<![^\W\d_])([^\W\d_])\.(?=[^\W\d_]\.?(?![^\W\d_]))", r"\1", s)
    s = re.sub(r"['’`´.\"]", "", s)
    words = [ABBREVIATIONS.get(w, w) for w in re.findall(r"[^\W_]+", s)]
    kept = [w for w in words if w not in IDLE]
    kept = kept or words
    plain = [w for w in kept if w not in TITLES]
    return (plain if len(plain) > 1 else kept), (nick.group(1) if nick else None)


def single_names(values: DataFrame, known: list[str]) -> DataFrame:
    """(value, words, nick) of the distinct values that hold one name only and no placeholder."""
    state: dict = {}

    @F.pandas_udf("words array<string>, nick string")
    def parse(s: pd.Series) -> pd.DataFrame:
        if "f" not in state:
            state["f"] = cached_splitter(known)
        words, nicks = [], []
        for v in s:
            w, n = ([], None) if len(state["f"](v)) != 1 or is_placeholder(v) else parse_name(v)
            words.append(w)
            nicks.append(n)
        return pd.DataFrame({"words": words, "nick": nicks})

    return values.withColumn("_p", parse.asNondeterministic()("value")).select("value", "_p.words", "_p.nick").where(F.size("words") > 0)


def build_trie(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = w
    return root


def neighbours(trie: dict, word: str, errors: int) -> set[str]:
    """The words of the trie within `errors` insertions, deletions, substitutions and swaps of neighbouring letters of `word`."""
    out, n = set(), len(word)
    states = [(trie, 0, 0)]
    while states:
        node, i, e = states.pop()
        if e == errors:  # the automaton has no choice left
            while i < n:
                node = node.get(word[i])
                if node is None:
                    break
                i += 1
            else:
                if "" in node:
                    out.add(node[""])
            continue
        c = word[i] if i < n else None
        if c is None:
            if "" in node:
                out.add(node[""])
        else:
            states.append((node, i + 1, e + 1))
            if c in node:
                states.append((node[c], i + 1, e))
            if i + 1 < n and word[i + 1] != c and word[i + 1] in node and c in node[word[i + 1]]:
                states.append((node[word[i + 1]][c], i + 2, e + 1))
        for ch, child in node.items():
            if ch:
                states.append((child, i, e + 1))
                if c is not None and ch != c:
                    states.append((child, i + 1, e + 1))
    return out


def _keys(errors: int):
    """For words `w`: (key, store) of the shards that store a word and of those where it is looked up, such that two words within the bound meet.

    Of two such words the shorter one, of s letters, is stored. It has errors + 1 pieces of equal length with a letter between them, so an error, a swap too, touches one
    piece at most, and one is whole in the other word: at its start, at its end, or, for the middle piece of three, where it was or one letter off.
    """
    n, out = F.length("w"), []
    for less in range(errors + 1):
        s = n - less
        h = F.floor((s - errors) / (errors + 1)).cast("int")
        h = F.greatest(h, F.lit(0))
        pieces = [("<", F.substring(F.col("w"), F.lit(1), h), 0), (">", F.substring(F.col("w"), n - h + 1, h), 0)]
        if errors == 2:
            pieces += [("=", F.substring(F.col("w"), F.greatest(h + 2 + shift, F.lit(1)), h), shift) for shift in (-1, 0, 1)]
        for kind, piece, shift in pieces:
            key = F.concat_ws(" ", F.lit(kind), s, piece)
            out.append(F.when(s > 0, F.struct(key.alias("key"), F.lit(False).alias("store"))))
            if less == 0 and shift == 0:
                out.append(F.struct(key.alias("key"), F.lit(True).alias("store")))
    return F.array_distinct(F.filter(F.array(*out), lambda x: x.isNotNull()))


def trie_join(words: DataFrame, col: str = "main", errors: int = ERRORS, trie_words: int = TRIE_WORDS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words of `col` within `errors` typing errors, 0, 1 or 2. Null and empty words have no neighbours.

    A shard with more words than a trie takes is split into blocks: each word is stored in one block and looked up in all.
    """
    if errors not in (0, 1, 2):
        raise ValueError("shards are made for two errors at most; more come out over the names between")
    w = words.select(F.col(col).alias("w")).where(F.length(col) > 0).distinct()
    keyed = cut(w.select("w", F.explode(_keys(errors)).alias("k")).select("w", "k.key", "k.store"))
    hot = keyed.where("store").groupBy("key").count().select("key", F.ceil(F.col("count") / trie_words).cast("int").alias("blocks"))
    sized = keyed.join(hot, "key")  # a shard that stores nothing needs no look-up
    rows = sized.select("key", "w", "store", F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rows = rows.where("not store or own = block").select("key", "block", "store", "w")
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("store"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, stored, trie = None, [], None
        for batch in batches:
            pairs = set()
            for key, block, store, word in zip(batch["key"], batch["block"], batch["store"], batch["w"]):
                if (key, block) != at:
                    at, stored, trie = (key, block), [], None
                if store:
                    stored.append(word)
                    continue
                if trie is None:
                    trie = build_trie(stored)
                pairs.update((min(word, n), max(word, n)) for n in neighbours(trie, word, errors) if n != word)
            if pairs:
                yield pd.DataFrame(sorted(pairs), columns=["a", "b"])

    return rows.mapInPandas(run, "a string, b string").distinct()


def _typos(a, b):
    """Typing errors between two words, one or two; null for more."""
    swap = (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return F.when(swap | (F.levenshtein(a, b, 1) == 1), 1).when(F.levenshtein(a, b, 2) == 2, 2)


def named_words(parsed: DataFrame) -> DataFrame:
    """parsed with `node`, the sorted words that a name is compared by. Initials count only beside a single word: VIKTOR D. DRAZIN is DRAZIN VIKTOR, D. DRAZIN is DRAZIN and a D."""
    full = F.filter("words", lambda w: F.length(w) > 1)
    first = F.slice(F.filter("words", lambda w: F.length(w) == 1), 1, 1)
    kept = F.when(F.size(full) > 1, full).when(F.size(full) == 1, F.concat(full, first)).otherwise(F.col("words"))
    return parsed.select("value", "words", "nick", full.alias("full"), F.array_sort(kept).alias("kept")).withColumn("node", F.array_join("kept", SEP))


def _node_id():
    """A name's words as a number: 64 bits by which names travel through the joins."""
    return F.xxhash64("node")


def near_names(nodes: DataFrame, errors: int = ERRORS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """From names (nid, kept): their words with the company of each, how many names hold a word, near words, names that agree in all words but one near pair (a, b), and
    the near pairs whose company tells that one is the other misspelt."""
    each = nodes.select("nid", "kept", F.posexplode("kept").alias("at", "word"))
    company = F.xxhash64(F.array_join(F.concat(F.slice("kept", 1, F.col("at")), F.slice("kept", F.col("at") + 2, F.size("kept"))), SEP))
    each = each.select("nid", "word", F.size("kept").alias("n"), company.alias("company")).distinct()
    spread = cut(each.groupBy("word").agg(F.count_distinct("nid").alias("spread")))
    each = each.join(spread, "word")
    # how widespread the rarest of the company is
    rarest = each.groupBy("nid").agg(F.array_sort(F.collect_list("spread")).alias("_s"))
    each = each.join(rarest, "nid").withColumn("beside", F.when(F.col("n") == 1, None).when(F.get("_s", F.lit(0)) == F.col("spread"), F.get("_s", F.lit(1))).otherwise(F.get("_s", F.lit(0))))
    each = cut(each.withColumn("leads", F.col("spread") == F.get("_s", F.lit(0))).drop("_s"))
    long = each.where(F.length("word") > 1)
    pairs = cut(trie_join(spread.where(F.length("word") > 1).select(F.col("word").alias("main")), errors=errors))
    # most words have no near one and go no further
    some = cut(pairs.select(F.explode(F.array("a", "b")).alias("word")).distinct())
    long = long.join(some, "word", "left_semi")
    x = long.select(F.col("word").alias("a"), "company", F.col("nid").alias("na"), F.col("spread").alias("sa"), "beside")
    y = long.select(F.col("word").alias("b"), "company", F.col("nid").alias("nb"), F.col("spread").alias("sb"))
    one = cut(x.join(pairs, "a").join(y, ["b", "company"]).select("a", "b", "na", "nb", "sa", "sb", "beside"))
    told = one.groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"), F.min(F.least("sa", "sb")).alias("least"))
    misspelt = cut(told.where(F.col("both") >= SHARED * F.col("least")).select("a", "b"))
    # a word of many families tells families apart no more; it is misspelt where hardly any has the other one
    distinct = F.coalesce(F.least("sa", "sb") <= F.col("beside"), F.lit(True)) | (F.least("sa", "sb") * MUCH_RARER <= F.greatest("sa", "sb"))
    return each, spread, pairs, one.where(distinct), misspelt


def lead_words(named: DataFrame) -> DataFrame:
    """(node, leads) of names by `named_words`: the words by which a person is told from most others. Words and their misspellings are one class, by its smallest member; of a
    name's classes the one that fewest names hold leads, and those that are not MUCH_RARER times as widespread."""
    nodes = cut(named.groupBy("node").agg(F.first("kept").alias("kept")).withColumn("nid", _node_id()))
    each, _, _, one, misspelt = near_names(nodes.drop("node"))
    told = one.join(misspelt, ["a", "b"]).select("a", "b").distinct()
    classes = connected_components(told).select(F.col("record_id").alias("word"), F.col("group_id").alias("class"))
    held = cut(each.select("nid", "word").join(classes, "word", "left").select("nid", F.coalesce("class", "word").alias("class")).distinct())
    wide = held.join(held.groupBy("class").agg(F.count(F.lit(1)).alias("spread")), "class")
    # an initial leads only where there is nothing else; a name has few words, so its list is short
    listed = wide.groupBy("nid").agg(F.array_sort(F.collect_list(F.struct((F.length("class") < 2).alias("short"), "spread", "class"))).alias("w"))
    first = F.get("w", F.lit(0))
    leads = listed.select("nid", F.filter("w", lambda w: (w["short"] == first["short"]) & (w["spread"] < MUCH_RARER * first["spread"]))["class"].alias("leads"))
    return nodes.select("node", "nid").join(leads, "nid").select("node", "leads")


def link_names(values: DataFrame, known: list[str], errors: int = ERRORS) -> DataFrame:
    """(value, entity) of every distinct value that holds one name; values of one entity are spellings of one person or act.

    values: a column `value`. errors: typing errors between two words. Null and empty values, placeholders and fields of several names give no row; an empty table gives
    an empty result.
    """
    return settled(lambda: _link_names(values, known, errors))


def _link_names(values: DataFrame, known: list[str], errors: int) -> DataFrame:
    spark = values.sparkSession
    parsed = single_names(values.where("value is not null and trim(value) <> ''").distinct(), known)
    named = cut(named_words(parsed).withColumn("nid", _node_id()))
    nodes = cut(named.groupBy("nid").agg(F.first("kept").alias("kept")))
    each, spread, pairs, one, misspelt = near_names(nodes, errors)
    long = each.where(F.length("word") > 1)
    # 1: names that agree in all words but one
    edges = one.join(misspelt, ["a", "b"]).select("na", "nb")
    # and names that agree once two neighbouring words are written as one
    spaced = named.where("size(full) > 1").select("nid", "full", F.explode(F.sequence(F.lit(1), F.size("full") - 1)).alias("i"))
    closed = F.concat(F.slice("full", 1, F.col("i") - 1), F.array(F.concat(F.get("full", F.col("i") - 1), F.get("full", F.col("i")))), F.slice("full", F.col("i") + 2, F.size("full")))
    spaced = spaced.select(F.col("nid").alias("na"), F.xxhash64(F.array_join(F.array_sort(closed), SEP)).alias("nb")).distinct().join(nodes.select(F.col("nid").alias("nb")), "nb", "left_semi")
    edges = edges.unionByName(spaced)
    # 2: a short form with its full form in the same company
    fixed = spark.createDataFrame([(s, g) for g, short in NICKNAMES.items() for s in short.split()], "short string, long string")
    learned = named.where("nick is not null and size(full) = 2").select(F.col("nick").alias("short"), F.get("full", F.lit(0)).alias("long")).where("short <> long")
    alias = cut(fixed.unionByName(learned).distinct(), 1)
    short = long.select(F.col("word").alias("short"), "company", F.col("nid").alias("na")).join(alias, "short").select(F.col("long").alias("word"), "company", "na")
    edges = edges.unionByName(short.join(long.select("word", "company", F.col("nid").alias("nb")), ["word", "company"]).select("na", "nb"))
    # 3: two words differ: the rarest words of both names are near, and of the others one is misspelt or a short form
    lead = long.where("leads and n > 1").select("word", "nid")
    kept = lambda n: nodes.select(F.col("nid").alias(f"n{n}"), F.col("kept").alias(f"k{n}"))
    two = lead.select(F.col("word").alias("a"), F.col("nid").alias("na")).join(pairs, "a").join(lead.select(F.col("word").alias("b"), F.col("nid").alias("nb")), "b")
    two = two.join(kept("a"), "na").join(kept("b"), "nb").where(F.size("ka") == F.size("kb"))
    others = lambda k, x, l: F.array_except(F.col(k), F.concat(F.col(x), F.array(l)))
    two = two.select("na", "nb", "a", "b", others("ka", "kb", "a").alias("da"), others("kb", "ka", "b").alias("db")).where("size(da) = 1 and size(db) = 1")
    two = two.select("na", "nb", F.get("da", F.lit(0)).alias("p"), F.get("db", F.lit(0)).alias("q"), _typos(F.col("a"), F.col("b")).alias("e")).where(F.length("p") > 1).where(F.length("q") > 1)
    two = cut(two)
    both_ways = alias.unionByName(alias.select(F.col("long").alias("short"), F.col("short").alias("long"))).distinct()
    formed = two.join(both_ways, (F.col("p") == F.col("short")) & (F.col("q") == F.col("long"))).select("na", "nb")
    typed = two.where(F.col("e") + _typos(F.col("p"), F.col("q")) <= NAME_ERRORS)
    sp, sq = spread.select(F.col("word").alias("p"), F.col("spread").alias("cp")), spread.select(F.col("word").alias("q"), F.col("spread").alias("cq"))
    typed = typed.join(sp, "p").join(sq, "q").where((F.least("cp", "cq") == 1) | (F.least("cp", "cq") * MUCH_RARER <= F.greatest("cp", "cq"))).select("na", "nb")
    edges = edges.unionByName(formed.unionByName(typed))
    groups = settled(lambda: connected_components(edges, "na", "nb")).select(F.col("record_id").cast("bigint").alias("nid"), F.col("group_id").cast("bigint").alias("entity"))
    tagged = cut(nodes.select("nid").join(groups, "nid", "left").select("nid", F.coalesce("entity", "nid").alias("entity")))
    # 4: an initial goes to the one entity of its family that it fits: of the same word first, else of a neighbouring one
    initials = nodes.where("size(kept) = 2").select("nid", F.filter("kept", lambda w: F.length(w) == 1).alias("i"), F.filter("kept", lambda w: F.length(w) > 1).alias("w")).where("size(i) = 1")
    letters = initials.select("nid", F.get("i", F.lit(0)).alias("letter"), F.get("w", F.lit(0)).alias("word")).join(tagged, "nid").select("word", "letter", F.col("entity").alias("initial"))
    act = F.exists("full", lambda w: w.isin(sorted(ACT_WORDS)))
    firsts = named.where((F.size("full") > 1) & ~act).select("nid", "full", F.explode(F.array_distinct("full")).alias("word"))
    firsts = firsts.select("nid", "word", F.substring(F.get(F.filter("full", lambda w: w != F.col("word")), F.lit(0)), 1, 1).alias("letter")).distinct()
    fulls = firsts.join(tagged, "nid").groupBy("word", "letter").agg(F.min("entity").alias("lo"), F.max("entity").alias("hi"))
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    at_home = letters.join(fulls, ["word", "letter"]).select("initial", "lo", "hi", F.lit(0).alias("far"))
    nearby = letters.join(near, F.col("word") == F.col("a")).select("word", "initial", "letter", "b").join(fulls.withColumnRenamed("word", "b"), ["b", "letter"])
    nearby = nearby.where((F.concat("word", F.lit("S")) != F.col("b")) & (F.concat("b", F.lit("S")) != F.col("word"))).select("initial", "lo", "hi", F.lit(1).alias("far"))
    fits = at_home.unionByName(nearby).groupBy("initial", "far").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fits = fits.groupBy("initial").agg(F.min_by(F.struct("lo", "hi"), "far").alias("f")).where("f.lo = f.hi").select("initial", F.col("f.lo").alias("owner"))
    final = tagged.join(fits, F.col("entity") == F.col("initial"), "left").select("nid", F.coalesce("owner", "entity").alias("entity"))
    return named.select("value", "nid").join(final, "nid").select("value", "entity")


def stored_names(spark, sf_dir: str) -> DataFrame:
    cols = [("adc_composers", "name"), ("composers", "composer"), ("adcartists", "name"), ("recordings", "artist_name")]
    out = None
    for t, c in cols:
        part = table(spark, sf_dir, t).select(F.col(c).alias("value")).where("value is not null")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def p1_found(spark, sf_dir: str) -> DataFrame:
    linked = link_names(stored_names(spark, sf_dir), known_names(spark, sf_dir))
    a, b = linked.select("entity", F.col("value").alias("name_a")), linked.select("entity", F.col("value").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")


def p1_entities(spark, sf_dir: str) -> DataFrame:
    """(name, entity) of every stored value that holds one name."""
    return link_names(stored_names(spark, sf_dir), known_names(spark, sf_dir)).select(F.col("value").alias("name"), "entity")


SQL: dict[str, str] = {}
