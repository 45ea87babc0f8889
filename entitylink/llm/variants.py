"""Variant spellings of names: n-gram vectors, top-n cosine similarity join, average-linkage clusters.

1. Each distinct stored name is parsed (names.py); names with the same brand, given name and line are one *spelling*, one vector.
2. Spellings become vectors of the character trigrams of the brand, weighted by a smoothed inverse document frequency.
3. A join on what is left of a brand without one or two of its letters finds all spellings of one line, or of a line and none, whose difference
   typing slips explain; line and given name must agree, and the cosine must reach COSINE.
4. The TOP_N nearest of every spelling connect it; what lies beyond is compared only where it would connect further components.
5. Connected spellings are grouped by average linkage on the thresholded cosines (0 below the threshold), in which spellings of
   different lines or given names repel. Small components are linked in one task each, large ones in distributed rounds, on the
   same whole numbers, so that both give the same clusters.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import hash_to_min
from .lookalike import expand_variants
from .names import parse_name, plain
from .shared import Stage, records

#: A word of names is a place note if it stands in the own address of at least this share of the records with it.
TOWN_SHARE = 0.5
GRAM = 3
#: Share of the spellings added to each document frequency, and spellings added to their number: trigrams that a slip made, or that only a small
#: table makes look common, weigh nearly as the others.
SMOOTHING, PRIOR = 1e-2, 10_000
COSINE = 0.45
#: Typing slips that two spellings may differ by: half of it each from the common form.
SLIPS = 2.0
TOP_N = 8
LINKAGE = 0.25
#: Cosines are counted in whole thousandths: sums of them are exact in any order, so equal means are equal numbers.
UNIT = 1000
#: Components of at most so many spellings are linked in one task; larger ones by distributed rounds, with the same result.
IN_ONE_TASK = 400
#: Spellings of one key from which the key's left side is split over several tasks.
HOT_KEY = 2000
#: Letters up to which brands meet on all that deletions leave of them. Longer ones have at least 2 END + 1 letters, also the shorter of a pair.
LONG, END = 24, 11
# Odd numbers for hashes of letters and their places.
BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

# Fixed value: rows of a keyboard, for slips to a neighbouring key.
_ROWS = ["qwertyuiop", "asdfghjkl", "zxcvbnm"]
_AT = {ch: (r, c + r * 0.5) for r, row in enumerate(_ROWS) for c, ch in enumerate(row)}


def _neighbours(a: str, b: str) -> bool:
    if a == b:
        return True
    x, y = _AT.get(a), _AT.get(b)
    return bool(x and y and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1.1)


_BESIDE = {(a, b) for a in _AT for b in _AT if _neighbours(a, b)} | {("i", k) for k in _AT if _neighbours("l", k)} | {(k, "i") for k in _AT if _neighbours("l", k)}


def slips(a: str, b: str, most: float = 4.0) -> float:
    """Least cost of typing slips between two words: a letter left out or doubled, two swapped, a neighbouring key cost 1; any
    other letter in place of another costs 2. Costs above ``most`` are given as infinity."""
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) > most:
        return math.inf
    n, m = len(a), len(b)
    lead = 0
    while lead < min(n, m) and a[lead] == b[lead]:
        lead += 1
    lead = max(0, lead - 1)
    a, b = a[lead:], b[lead:]
    while len(a) > 1 and len(b) > 1 and a[-1] == b[-1] and a[-2] == b[-2]:
        a, b = a[:-1], b[:-1]
    n, m = len(a), len(b)
    before, last = None, list(range(m + 1))
    for i in range(1, n + 1):
        now = [i] + [0] * m
        x = a[i - 1]
        for j in range(1, m + 1):
            y = b[j - 1]
            if x == y:
                v = last[j - 1]
            else:
                v = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (1 if (x, y) in _BESIDE else 2))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    v = min(v, before[j - 2] + 1)
            now[j] = v
        if min(now) > most:
            return math.inf
        before, last = last, now
    return float(last[m]) if last[m] <= most else math.inf


#: All bits of a 64-bit number but the sign.
_LOW_BITS = (1 << 63) - 1


def lines_agree(a: str, b: str) -> bool:
    """Equal, missing on one side, or one cut after whole words of the other."""
    return a == b or not a or not b or a.startswith(b + " ") or b.startswith(a + " ")


def givens_agree(a: str, b: str) -> bool:
    """Equal, a short form that can stand for the other, or an initial of it. A given name against none disagrees."""
    if a == b:
        return True
    if not a or not b:
        return False
    if len(a) == 1 or len(b) == 1:
        return any(g.startswith(h) or h.startswith(g) for g in a.split("/") for h in b.split("/"))
    return bool(set(a.split("/")) & set(b.split("/")))


def allowed_slips(a: str, b: str) -> float:
    short = min(len(a), len(b))
    return 0.0 if short < 5 else 1.0 if short < 8 else SLIPS


_PARTS = T.StructType([T.StructField(f, T.StringType()) for f in ("brand", "given", "line", "folded")])


def _words(c: str) -> Column:
    return F.split(F.lower(c), r"[^\p{L}\p{M}]+")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _plain_words(texts: pd.Series) -> pd.Series:
    """The words of each text but its first one, without accents and look-alikes."""
    return pd.Series([sorted({w for w in re.findall(r"[^\W\d_]+", plain(t))[1:] if len(w) > 2}) for t in texts])


def town_words(recs: DataFrame) -> DataFrame:
    """``w``: words that names carry as a note of the place: where a name has such a word, not as its first, the record's own address
    mostly has it too. This holds for tables of any size."""
    both = recs.filter("name is not null and addr is not null").select("name", "addr").distinct()
    words = both.select(F.explode(F.array_distinct(F.slice(_words("name"), 2, 1 << 20))).alias("w"), _words("addr").alias("aw")).filter(F.length("w") > 2)
    seen = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("aw", F.col("w"))).alias("own"))
    return seen.filter((F.col("own") > 0) & (F.col("own") >= TOWN_SHARE * F.col("n"))).select("w")


@F.pandas_udf(_PARTS)
def _parts(texts: pd.Series, towns: pd.Series) -> pd.DataFrame:
    none = frozenset()
    return pd.DataFrame([parse_name(t, none if k is None else frozenset(k)) for t, k in zip(texts, towns)], columns=["brand", "given", "line", "folded"])


def spellings(recs: DataFrame) -> DataFrame:
    """``name, brand, given, line, folded, sid``: the distinct names with their parts; ``sid`` identifies the spelling.
    Names without any letter or digit are left out."""
    names = recs.select("name").filter(F.col("name").isNotNull()).distinct()
    towns = town_words(recs).select(F.explode(_plain_words(F.concat(F.lit("x "), "w"))).alias("w")).distinct()
    noted = names.select("name", F.explode(_plain_words("name")).alias("w")).join(towns, "w").groupBy("name").agg(F.collect_set("w").alias("towns"))
    return (
        names.join(noted, "name", "left").withColumn("p", _parts("name", "towns")).select("name", "p.*")
        .filter("folded <> ''").withColumn("sid", F.xxhash64("folded", "given", "line"))
    )


def _grams(column: str, n: int) -> Column:
    return F.expr(f"array_distinct(transform(sequence(1, greatest(length({column}) - {n - 1}, 1)), i -> substring({column}, i, {n})))")


def vectors(words: DataFrame) -> DataFrame:
    """``sid, vec, norm``: the weighted trigrams of each padded brand, a whole number each, and the squared length of the vector.

    A trigram's squared weight is the square of ln(1 + N / (df + SMOOTHING N)), in tenths; it fills the lowest 8 bits, a hash of the
    trigram those above. So the dot product of two vectors is the sum of the lowest bits of what they share.
    """
    g = words.select("sid", F.explode(_grams("padded", GRAM)).alias("gram"))
    total = words.agg((F.count(F.lit(1)) + PRIOR).alias("total"))
    w = F.log1p(F.col("total") / (F.col("df") + SMOOTHING * F.col("total")))
    code = F.shiftleft(F.xxhash64("gram"), 8).bitwiseOR(F.least(F.lit(255), F.round(10 * w * w)).cast("long"))
    codes = g.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(total)).select("gram", code.alias("code"))
    return g.join(codes, "gram").groupBy("sid").agg(F.collect_list("code").alias("vec"), F.sum(F.col("code").bitwiseAND(F.lit(255))).alias("norm"))


def _agree(a: str, b: str) -> str:
    """SQL of ``lines_agree`` and ``givens_agree`` between two aliases."""
    g, h = f"split({a}.given, '/')", f"split({b}.given, '/')"
    initial = f"exists({g}, g -> exists({h}, h -> startswith(g, h) or startswith(h, g)))"
    lines = f"({a}.line = {b}.line or {a}.line = '' or {b}.line = '' or startswith({a}.line, concat({b}.line, ' ')) or startswith({b}.line, concat({a}.line, ' ')))"
    givens = f"({a}.given = {b}.given or {a}.given <> '' and {b}.given <> '' and if(length({a}.given) = 1 or length({b}.given) = 1, {initial}, arrays_overlap({g}, {h})))"
    return f"({lines} and {givens})"


def _meet(left: DataFrame, right: DataFrame, keys: list[str], test: str) -> DataFrame:
    """``a, b``: rows of both sides with equal keys that pass the test. Keys of more than HOT_KEY left rows are split: the left rows over
    parts of about that size, the right rows to each of them, so no key is the work of one task."""
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > HOT_KEY).select(*keys, F.ceil(F.col("rows") / HOT_KEY).alias("parts"))
    split = lambda df, part: df.join(hot, keys, "left").withColumn("part", part).drop("parts")
    a = split(left, F.pmod("sid", F.coalesce("parts", F.lit(1))))
    b = split(right, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
    on = " and ".join(f"a.{k} = b.{k}" for k in [*keys, "part"])
    return a.alias("a").join(b.alias("b"), F.expr(on)).filter(test).select(F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b"))


def deletion_keys(brands: list[str]) -> list[np.ndarray]:
    """For each brand, hashes of what is left of it when no letter or as many letters as it may have slips are left out, and all numbers between.

    A slip leaves out, doubles, swaps or replaces one letter, so two brands that differ by ``k`` slips have the same rest after at most
    ``k`` deletions in each. Brands of more than LONG letters have none here. A hash is the sum of the letters' numbers times powers
    of BASE, 64 bits of it, so those of all rests come from three running sums; equal hashes of unlike rests cost a comparison only.
    """
    found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(brands)
    by_length: dict[int, list[int]] = {}
    for at, brand in enumerate(brands):
        by_length.setdefault(len(brand), []).append(at)
    for n, rows in by_length.items():
        if n > LONG:
            continue
        letters = np.array([[ord(ch) for ch in brands[at]] for at in rows], dtype=np.uint64).reshape(len(rows), n) + np.uint64(1)
        letters = letters * _MIX
        letters = (letters ^ (letters >> np.uint64(29))) * _MIX
        power = np.cumprod(np.full(n + 2, BASE, dtype=np.uint64))
        # running sums of letters that have none, one and two deletions before them
        q0, q1, q2 = (np.concatenate([np.zeros((len(rows), 1), dtype=np.uint64), np.cumsum(letters * power[2 - d : n + 2 - d], axis=1)], axis=1) for d in range(3))
        kept, most = [q0[:, n:]], allowed_slips("x" * n, "x" * n)
        if most >= 1:
            kept.append(q0[:, :-1] + q1[:, n:] - q1[:, 1:])
        if most >= 2:
            i, j = np.triu_indices(n, 1)
            kept.append(q0[:, i] + q1[:, j] - q1[:, i + 1] + q2[:, n:] - q2[:, j + 1])
        for at, hashes in zip(rows, np.concatenate(kept, axis=1).view(np.int64)):
            found[at] = np.unique(hashes)
    return found


@F.pandas_udf(T.ArrayType(T.LongType()))
def _deletion_keys(brands: pd.Series) -> pd.Series:
    return pd.Series(deletion_keys(list(brands)))


def _slipped(x: str, y: str) -> Column:
    """Whether typing slips explain the difference of two brands."""

    @F.pandas_udf("boolean")
    def explained(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([slips(v, w, SLIPS) <= allowed_slips(v, w) for v, w in zip(a, b)], dtype=bool)

    return explained(x, y)


def near_forms(forms: DataFrame) -> DataFrame:
    """``fa, fb``: all pairs of different rows of ``form, folded, block, has`` whose brands typing slips make of each other, with equal ``has``, and
    equal blocks or none on one side.

    They meet on what deletions leave of both, which few other brands share, so the pairs looked at grow as those found. A long brand has many
    such rests; two slips leave its first or its last END letters with at most one, so long ones meet on those without one letter.
    """
    tasks = max(2 * forms.sparkSession.sparkContext.defaultParallelism, int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a fixed number of partitions: few bytes become many rows here
    forms = forms.repartition(tasks, "form").dropDuplicates(["form"])
    block = "(a.block = b.block or a.block = hash('') or b.block = hash(''))"
    keyed = forms.select("form", F.hash("block").alias("block"), "has", F.explode(_deletion_keys("folded")).alias("key")).select("form", "block", (F.col("key") + F.col("has").cast("long")).alias("key"))
    # the optimiser takes the keys for as few bytes as the brands, and would broadcast them
    short = keyed.alias("a").hint("merge").join(keyed.alias("b").hint("merge"), F.expr(f"a.key = b.key and a.form < b.form and {block}")).select(F.col("a.form").alias("fa"), F.col("b.form").alias("fb"))
    ends = f"array_distinct(flatten(array(transform(sequence(1, {END}), i -> concat('^', substring(folded, 1, i - 1), substring(folded, i + 1, {END} - i))), transform(sequence(1, {END}), i -> concat('$', substring(right(folded, {END}), 1, i - 1), substring(right(folded, {END}), i + 1))))))"
    ended = forms.filter(F.length("folded") >= LONG - 1).select(F.col("form").alias("sid"), "folded", F.hash("block").alias("block"), "has", F.explode(F.expr(ends)).alias("key"))
    long = _meet(ended, ended, ["has", "key"], f"a.sid < b.sid and {block} and greatest(length(a.folded), length(b.folded)) > {LONG} and abs(length(a.folded) - length(b.folded)) <= 2 and levenshtein(a.folded, b.folded, 4) >= 0")
    pairs = short.unionByName(long.select(F.col("a").alias("fa"), F.col("b").alias("fb"))).distinct()
    brand = lambda f, as_: forms.select(F.col("form").alias(f), F.col("folded").alias(as_))
    return pairs.join(brand("fa", "x"), "fa").join(brand("fb", "y"), "fb").filter(_slipped("x", "y")).select("fa", "fb")


def similar_spellings(parts: DataFrame, stage: Stage) -> DataFrame:
    """``a, b, s``: pairs of spellings with a cosine of at least COSINE (``s``, in thousandths) which typing slips explain, of agreeing
    line and given name.

    Spellings of one brand, first word of the line, and given name or none, are one form. Pairs of forms are found first, all that slips explain; so the join is
    complete. Spellings then meet by their forms.
    """
    # nicknames begin with other letters than the name, so given names are compared only by being there
    words = parts.dropDuplicates(["sid"]).select("sid", "folded", "given", "line", F.concat(F.lit("^"), "folded", F.lit("$")).alias("padded"), F.split("line", " ")[0].alias("block"), (F.col("given") != "").alias("has"))
    words = stage.put("words", words.withColumn("form", F.xxhash64("folded", "block", "has")))
    full = stage.put("vectors", vectors(words))
    forms = stage.put("forms", near_forms(words.select("form", "folded", "block", "has")))
    own = words.select("sid", "form", "given", "line")
    near = own.join(forms, F.col("form") == F.col("fa")).select("sid", F.col("fb").alias("form"), "given", "line", F.lit(False).alias("own"))
    pairs = _meet(own.withColumn("own", F.lit(True)).unionByName(near), own, ["form"], f"(not a.own or a.sid < b.sid) and {_agree('a', 'b')}")
    dot = "aggregate(array_intersect(a.vec, b.vec), 0L, (t, x) -> t + (x & 255))"
    cosine = F.expr(f"cast(round({UNIT} * {dot} / sqrt(a.norm * b.norm)) as int)")
    close = pairs.alias("p").join(full.alias("a"), F.expr("p.a = a.sid")).join(full.alias("b"), F.expr("p.b = b.sid")).select("p.a", "p.b", cosine.alias("s"))
    return close.filter(F.col("s") >= round(COSINE * UNIT))


def nearest(edges: DataFrame, n: int) -> DataFrame:
    """The edges that are among the ``n`` of highest cosine of either end; ties by the other end's id."""
    ends = edges.select("a", "b", "s", F.explode(F.array(F.struct(F.col("a").alias("me"), F.col("b").alias("other")), F.struct(F.col("b").alias("me"), F.col("a").alias("other")))).alias("e"))
    top = ends.withColumn("turn", F.row_number().over(Window.partitionBy("e.me").orderBy(F.desc("s"), F.asc("e.other")))).filter(F.col("turn") <= n)
    return top.select("a", "b").distinct()


def connected(edges: DataFrame, stage: Stage, n: int) -> DataFrame:
    """``sid, component`` of all ends: components of the nearest edges first, then of the others as far as they lie between two of these.
    The result does not depend on ``n``."""
    near = stage.put("near", nearest(edges, n))
    ends = edges.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    first = stage.put("first", hash_to_min(near, ends, stage).select(F.col("vertex").alias("sid"), F.col("group").alias("component")))
    rest = edges.select("a", "b").join(near, ["a", "b"], "left_anti").join(first.select(F.col("sid").alias("a"), F.col("component").alias("ca")), "a").join(first.select(F.col("sid").alias("b"), F.col("component").alias("cb")), "b")
    rest = stage.put("rest", rest.filter("ca <> cb").select("ca", "cb").distinct())
    if rest.isEmpty():
        return first
    joined = stage.put("joined", hash_to_min(rest, first.select("component"), stage, "ca", "cb", "component").select(F.col("vertex").alias("component"), F.col("group").alias("whole")))
    return first.join(joined, "component").select("sid", F.col("whole").alias("component"))


def average_linkage(sim: np.ndarray, least: float = LINKAGE, keys: np.ndarray | None = None) -> np.ndarray:
    """Cluster number of each row: the two clusters of highest mean similarity merge until none reaches ``least``; of equal
    ones those of the smallest rows, or with ``keys``, distinct numbers of the rows, those whose keys differ in the lowest bits."""
    n = len(sim)
    label, size = np.arange(n), np.ones(n)
    total = sim.astype(float).copy()
    upper = np.triu(np.ones((n, n), dtype=bool), 1)
    alive = np.ones(n, dtype=bool)
    while alive.sum() > 1:
        mean = np.where(upper & alive[:, None] & alive[None, :], total / np.outer(size, size), -np.inf)
        at = int(np.argmax(mean))
        if keys is not None:
            ties = np.flatnonzero(mean == mean.flat[at])
            at = int(ties[np.argmin((keys[ties // n] ^ keys[ties % n]) & _LOW_BITS)])
        i, j = divmod(at, n)
        if mean[i, j] < least:
            break
        total[i, :] += total[j, :]
        total[:, i] += total[:, j]
        size[i] += size[j]
        alive[j] = False
        label[label == j] = i
    return label


def link_component(sids: list[int], givens: list[str], lines: list[str], edges) -> list[int]:
    """The cluster of each spelling of one component, named by its first spelling; the ids ascend."""
    if len(sids) == 2:
        return [sids[0], sids[0]]  # the one edge is above the threshold
    at = {sid: i for i, sid in enumerate(sids)}
    n = len(sids)
    kinds = sorted(set(zip(givens, lines)))
    apart = np.array([[not (lines_agree(m, k) and givens_agree(g, h)) for h, k in kinds] for g, m in kinds])
    kind = np.array([kinds.index(x) for x in zip(givens, lines)])
    sim = np.where(apart[kind[:, None], kind[None, :]], -float(UNIT), 0.0)
    for e in edges:
        i, j = at[e["a"]], at[e["b"]]
        sim[i, j] = sim[j, i] = e["s"]
    return [sids[k] for k in average_linkage(sim, LINKAGE * UNIT, np.array(sids, dtype=np.int64))]


def linkage_in_tasks(words: DataFrame, edges: DataFrame) -> DataFrame:
    """``sid, org`` of components that are small enough for one task: one array a component, many components an Arrow batch."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def orgs(members: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series([link_component([m["sid"] for m in group], [m["given"] for m in group], [m["line"] for m in group], pairs) for group, pairs in zip(members, links)])

    spark = words.sparkSession
    # a fixed number of partitions: few bytes are much work here, which merging partitions by bytes would put into a few tasks
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = words.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("sid", "given", "line"))).alias("members"))
    linked = edges.groupBy("component").agg(F.collect_list(F.struct("a", "b", "s")).alias("links"))
    both = packed.join(linked, "component").repartition(tasks, "component")
    return both.select("members", orgs("members", "links").alias("orgs")).select(F.explode(F.arrays_zip("members.sid", "orgs")).alias("m")).select("m.sid", F.col("m.orgs").alias("org"))


def linkage_rounds(vertices: DataFrame, edges: DataFrame, stage: Stage, least: float = LINKAGE, max_rounds: int = 500, repel: float = 0.0) -> DataFrame:
    """``sid, org`` by average linkage over rows: in each round, clusters that are each other's best merge. Pairs without an edge
    count as 0, or as ``-repel`` if their line or given name (then columns of ``vertices``) disagree; these are counted from the numbers
    of spellings by line and given name of two clusters, not from pairs.

    This is the way for components too large for one task. The mean similarity of a merged cluster never exceeds the larger of its
    parts', and pairs of equal means have one order for good, by the bits their ids differ in; so merging mutual bests in any order
    gives the clusters that merging the global best gives. That order is as good as random, so many equal pairs don't take many rounds.
    """
    named = ["given", "line"] if repel else []
    member = stage.put("member", vertices.select("sid", F.col("sid").alias("org"), F.lit(1.0).alias("weight"), *named))
    links = stage.put("links", edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s"))
    for _ in range(max_rounds):
        size = member.groupBy("org").agg(F.sum("weight").alias("n"))
        mean = links.join(size.select(F.col("org").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("org").alias("b"), F.col("n").alias("nb")), "b")
        # repulsion only lowers a mean, so it is counted where the edges alone reach the least
        mean = mean.withColumn("pairs", F.col("na") * F.col("nb")).filter(F.col("s") / F.col("pairs") >= least).select("a", "b", "s", "pairs")
        if repel:
            mean = stage.put("mean", mean)
            held = member.groupBy("org", "given", "line").agg(F.sum("weight").alias("n"))
            against = (
                mean.select("a", "b").join(held.alias("g"), F.expr("a = g.org")).join(held.alias("h"), F.expr("b = h.org")).filter(f"not {_agree('g', 'h')}")
                .groupBy("a", "b").agg(F.sum(F.expr("g.n * h.n")).alias("against"))
            )
            mean = mean.join(against, ["a", "b"], "left").withColumn("s", F.col("s") - repel * F.coalesce("against", F.lit(0.0)))
        mean = mean.select("a", "b", (F.col("s") / F.col("pairs")).alias("mean")).filter(F.col("mean") >= least)
        both = mean.unionByName(mean.select(F.col("b").alias("a"), F.col("a").alias("b"), "mean"))
        best = both.groupBy("a").agg(F.max(F.struct("mean", (-F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(F.lit(_LOW_BITS))).alias("tie"), "b")).alias("m"))
        best = stage.put("best", best.select("a", "m.b"))
        merge = best.alias("x").join(best.alias("y"), F.expr("x.a = y.b and x.b = y.a and x.a > x.b")).select(F.col("x.a").alias("old"), F.col("x.b").alias("new"))
        merge = stage.put("merge", merge)
        if merge.isEmpty():
            return member.select("sid", "org")
        member = stage.put("member", member.join(merge.withColumnRenamed("old", "org"), "org", "left").select("sid", F.coalesce("new", "org").alias("org"), "weight", *named))
        moved = links.join(merge.select(F.col("old").alias("a"), F.col("new").alias("ma")), "a", "left").join(merge.select(F.col("old").alias("b"), F.col("new").alias("mb")), "b", "left")
        moved = moved.select(F.coalesce("ma", "a").alias("a"), F.coalesce("mb", "b").alias("b"), "s").filter("a <> b")
        links = stage.put("links", moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")))
    raise RuntimeError(f"linkage is not complete after {max_rounds} rounds")


def organisations(recs: DataFrame, stage: Stage, keep_parts: bool = False) -> DataFrame:
    """``name, org``: the organisation of each distinct name of ``recs`` (``name, addr``); names of one organisation share ``org``.
    With ``keep_parts`` also the spelling ``sid`` and its parts."""
    parts = stage.put("parts", spellings(recs))
    edges = stage.put("edges", similar_spellings(parts, stage))
    component = stage.put("component", connected(edges, stage, TOP_N))
    sized = component.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    words = parts.dropDuplicates(["sid"]).select("sid", "given", "line").join(component, "sid").join(sized, "component")
    words = stage.put("members", words)
    of = edges.join(words.select(F.col("sid").alias("a"), "component", "n"), "a")
    clusters = linkage_in_tasks(words.filter(F.col("n") <= IN_ONE_TASK), of.filter(F.col("n") <= IN_ONE_TASK))
    large = words.filter(F.col("n") > IN_ONE_TASK)
    if not large.isEmpty():
        clusters = clusters.unionByName(linkage_rounds(large, of.filter(F.col("n") > IN_ONE_TASK), stage, LINKAGE * UNIT, repel=UNIT))
    clusters = stage.put("clusters", clusters)
    kept = ["sid", "folded", "given", "line"] if keep_parts else []
    return parts.join(clusters, "sid", "left").select("name", F.coalesce("org", "sid").alias("org"), *kept)


def same_organisation(live: DataFrame, stage: Stage) -> DataFrame:
    """``id_a, id_b``: records with different stored names of one organisation. Null names, and names without any letter or
    digit, pair with nothing; an empty table gives an empty result."""
    recs = stage.put("records", records(live))
    orgs = stage.put("orgs", organisations(recs.select("name", "addr"), stage))
    return expand_variants(recs.filter(F.col("name").isNotNull()).select("id", "name").join(orgs, "name"), "org")
