"""Which address records denote the same location: components, locale dictionaries, hierarchical keys.

An address is parsed into house number, street, kind of street, direction, unit, postal code, city and region. Records are
joined on keys of falling strength, each with a rule for what may be missing:

1. same house number and postal code; streets equal or a few letters apart;
2. a postal code is missing on one side: same house number and street; cities close, or one missing and regions alike;
3. a postal code is missing on one side: same house number and city; streets a few letters apart.

In all of them units must be equal, or missing on one side, and kinds and directions must not contradict each other.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookalike import expand_variants, visible_form
from .shared import Stage, records

# Spellings of kinds of streets, by locale (en, in, fr, de, bg).
KINDS = {
    "road": "road rd", "street": "street st str strasse ul ulitsa", "avenue": "avenue ave av", "drive": "drive dr drv", "court": "court ct crt", "lane": "lane ln la",
    "boulevard": "boulevard blvd boul bd bul bulevard bvd", "terrace": "terrace ter terr", "close": "close cl", "marg": "marg mg", "rue": "rue r", "chemin": "chemin chem ch", "place": "place pl platz",
    "allee": "allee", "weg": "weg wg", "highway": "highway hwy", "way": "way", "square": "square sq", "parkway": "parkway pkwy", "quai": "quai", "impasse": "impasse imp", "gasse": "gasse",
}
# Words between a street's name and its kind.
QUALIFIERS = {"main": "main", "m": "main", "cross": "cross", "x": "cross", "nagar": "nagar", "ngr": "nagar"}
# Directions.
DIRECTIONS = {"north": "n", "n": "n", "south": "s", "s": "s", "east": "e", "e": "e", "west": "w", "w": "w"}
# What may introduce a landmark, and landmarks.
_BESIDE = r"near|nr|opp|opposite|behind|beside|next to|across from|adjacent to|by|face a|pres de|a cote de|derriere|am|beim|neben|hinter|gegenuber|do|sreshtu|zad"
_LANDMARKS = r"old mill|water tower|water tank|depot|green|station|clock tower|old temple|temple|cinema hall|bus stand|post office|church|school|mairie|gare|eglise|bahnhof|rathaus|kirche|garata|market|park"
_LANDMARK = re.compile(rf"\b(?:{_BESIDE})\b\.?\s+(?:the\s+|la\s+|le\s+|der\s+|dem\s+)?(?:{_LANDMARKS})\b")
_LANDMARK_PART = re.compile(rf"(?:^|(?<=,))\s*(?:{_BESIDE})\b\.?\s+[^\d,]*(?=,|$)")
# Country names at the end of an address.
_COUNTRY = re.compile(
    r"(?:[\s,.]+|^)(?:united states of america|united states|u\s?\.?\s?s\s?\.?\s?a\b\.?|usa|us|india|bharat|in|france|fr|united kingdom|u\s?\.?\s?k\b\.?|uk|gb|great britain|england|germany|deutschland|de|bulgaria|balgariya|bg)[\s,.]*$"
)
_UNIT = re.compile(
    r"\b(?:suite|ste|unit|flat|apt|apartment|shop\s*no|sh\.?\s*no|shop|haus|hs|batiment|bat|ofis|office|of|room|rm|floor)\b\.?\s*(?:no\b\.?\s*|#\s*)?((?<=[\s.#])[a-z](?![a-z\d])|\d+[a-z]?)\b"
)
_UNIT_BEFORE = re.compile(r"\b(\d+)\s*/\s*(?=(?:0*no\b\.?\s*|#\s*)?\d)|(?:^|(?<=,))\s*#\s*(\d+[a-z]?)\s*(?=,|$)")
_NUMBER_MARK = re.compile(r"(?:\b0*(?:no|num|nr)\b\.?|[#№])\s*(?=\d)")
_GLUED_MARK = re.compile(r"\b0+no\.?\s*(?=\d)")
_UK_CODE = re.compile(r"\b([a-z]{1,2}\d[a-z\d]?)\s*(\d[a-z]{2})\b")
_PARTS = re.compile(r"\s[-–—]+\s|[,;|\n\r\t]+")
_TOKEN = re.compile(r"[^\W_]+|,")
_GLUED_KIND = re.compile(r"(.{3,}?)(strasse|str|allee|weg|wg|platz|pl|gasse)")
_KIND = {w: k for k, ws in KINDS.items() for w in ws.split()}
FIELDS = ("number", "street", "kind", "direction", "unit", "postal", "city", "region")


def _plain(text: str) -> str:
    apart = unicodedata.normalize("NFD", visible_form(text).casefold())
    return "".join(ch for ch in apart if unicodedata.category(ch) != "Mn") if not apart.isascii() else apart


def parse_address(text: str | None) -> tuple[str, ...] | None:
    """The components in the order of FIELDS, each a string, empty where missing. None for a text that is no real address
    (null, blank, a filler, or without any house number)."""
    if not text:
        return None
    t = _plain(text)
    if not any(ch.isdigit() for ch in t):
        return None
    t = _PARTS.sub(" , ", t)
    t = _LANDMARK.sub(" , ", t)
    t = _LANDMARK_PART.sub(" ", t)
    t = _COUNTRY.sub("", t)
    unit = ""

    def take_unit(m):
        nonlocal unit
        unit = unit or next(g for g in m.groups() if g).lstrip("0")
        return " , "

    t = _UNIT.sub(take_unit, t)
    t = _UNIT_BEFORE.sub(take_unit, t)
    t = _GLUED_MARK.sub("", _NUMBER_MARK.sub("", t))
    postal = ""
    if m := _UK_CODE.search(t):
        postal = m[1] + m[2]
        t = t[: m.start()] + " , " + t[m.end() :]
    tokens = _TOKEN.findall(t)
    numeric = [i for i, w in enumerate(tokens) if w[0].isdigit()]
    if not postal and numeric:
        long = [i for i in numeric if tokens[i].isdigit() and 5 <= len(tokens[i]) <= 6]
        found = None
        if len(long) == 1:
            found = long[0] if not tokens[long[0]].startswith("0") or len(numeric) > 1 and len(tokens[long[0]]) == 5 and not any(tokens[i].isdigit() and len(tokens[i]) == 4 for i in numeric) else None
        elif long:
            found = next((i for i in reversed(long) if not tokens[i].startswith("0")), long[-1])
        elif len(numeric) > 1:
            four = [i for i in numeric if len(tokens[i]) == 4 and tokens[i].isdigit() and tokens[i][0] != "0"]
            found = four[-1] if four else None
        if found is not None:
            postal = tokens[found]
            tokens[found] = ","
            numeric = [i for i in numeric if i != found]
    if not numeric:
        return ("", "", "", "", unit, postal, "", "") if postal else None
    at = numeric[0]
    number = tokens[at].lstrip("0") or "0"
    street, kind, direction, used = _street(tokens, at)
    city, region = [], ""
    for i, w in enumerate(tokens):
        if i in used or w == "," or w[0].isdigit():
            continue
        starts = i == 0 or tokens[i - 1] == ","
        if w == "st" and (starts or not city):
            city.append("saint")
        elif len(w) == 2 and w not in _KIND and w not in QUALIFIERS:
            region = region or w
        elif len(w) > 1 and not (w in _KIND and not kind):
            city.append(w[:-2] + "ville" if w.endswith("vl") and len(w) > 4 else w)
    return (number, street, kind, direction, unit, postal, "".join(city), region)


def _street(tokens: list[str], at: int) -> tuple[str, str, str, set[int]]:
    used, n = {at}, len(tokens)
    kind = direction = ""
    i = at + 1
    if i + 1 < n and tokens[i] == "," and (tokens[i + 1] in _KIND):
        i += 1
    while i < n and (tokens[i] in DIRECTIONS or tokens[i] in _KIND) and i + 1 < n and tokens[i + 1] != "," and not tokens[i + 1][0].isdigit():
        if tokens[i] in _KIND:
            kind = kind or _KIND[tokens[i]]
        else:
            direction = DIRECTIONS[tokens[i]]
        used.add(i)
        i += 1
    if i < n and tokens[i] != "," and not tokens[i][0].isdigit():
        words, j = [], i
        while j < n and tokens[j] != "," and not tokens[j][0].isdigit():
            if j > i and (tokens[j] in _KIND or tokens[j] in QUALIFIERS):
                break
            words.append(j)
            j += 1
        if not kind and j < n and (tokens[j] in _KIND or tokens[j] in QUALIFIERS):
            used.update(words)
            extra = ""
            while j < n and (tokens[j] in QUALIFIERS or tokens[j] in _KIND):
                used.add(j)
                if tokens[j] in _KIND:
                    kind = _KIND[tokens[j]]
                    break
                extra += QUALIFIERS[tokens[j]] + " "
                j += 1
            return "".join(tokens[k] for k in words), extra + kind, direction, used
        used.add(i)
        return tokens[i], kind, direction, used
    i = at - 1  # the number stands after the street
    if i >= 0 and tokens[i] in _KIND and i > 0 and tokens[i - 1] != ",":
        kind = _KIND[tokens[i]]
        used.add(i)
        i -= 1
    if i < 0 or tokens[i] == ",":
        return "", kind, direction, used
    used.add(i)
    street = tokens[i]
    if i > 0 and tokens[i - 1] in _KIND:
        kind = _KIND[tokens[i - 1]]
        used.add(i - 1)
    elif not kind and (m := _GLUED_KIND.fullmatch(street)):
        street, kind = m[1], _KIND[m[2]] if m[2] in _KIND else m[2]
    if i > 0 and tokens[i - 1] in DIRECTIONS:
        direction = DIRECTIONS[tokens[i - 1]]
        used.add(i - 1)
    return street, kind, direction, used


@F.pandas_udf(T.StructType([T.StructField(f, T.StringType()) for f in FIELDS]))
def parsed(texts: pd.Series) -> pd.DataFrame:
    rows = [parse_address(t if isinstance(t, str) else None) for t in texts]
    return pd.DataFrame([r if r else (None,) * len(FIELDS) for r in rows], columns=FIELDS)


def locations(addresses: DataFrame, stage: Stage) -> DataFrame:
    """``addr, place, number, ...``: the distinct addresses with their components and a text that names the parsed place.

    Addresses that are none are left out. The city of an address with a postal code is the one most addresses of that code give,
    so a missing or misspelt city does no harm where the code tells it.
    """
    p = addresses.select("addr").distinct().withColumn("p", parsed(F.col("addr"))).select("addr", "p.*").filter("number <> '' and street <> ''")
    p = stage.put("parsed", p)  # read twice: addresses are parsed once
    given = p.filter("postal <> '' and city <> ''").groupBy("postal", "city").agg(F.count(F.lit(1)).alias("n"))
    usual = given.groupBy("postal").agg(F.max(F.struct("n", "city")).alias("most")).filter("most.n > 1").select("postal", F.col("most.city").alias("usual"))
    p = p.join(usual, "postal", "left").withColumn("city", F.coalesce("usual", "city"))
    return p.select("addr", F.concat_ws("|", *FIELDS).alias("place"), *FIELDS)


def _close(a: str, b: str, more: int = 0):
    """Whether two words are few letters apart: one in short words, two from six letters, three from ten, and ``more`` in the longer."""
    x, y = F.col(a), F.col(b)
    short = F.least(F.length(x), F.length(y))
    allowed = F.when(short >= 10, 3 + more).when(short >= 6, 2 + more).when(short >= 4, 1).otherwise(0)
    return F.levenshtein(x, y) <= allowed


def _agree(name: str):
    """Equal, or missing on one side."""
    return F.expr(f"a.{name} = b.{name} or a.{name} = '' or b.{name} = ''")


def same_place_pairs(places: DataFrame) -> DataFrame:
    """``pa, pb``: pairs of distinct parsed places that denote the same location, by the three keys of the module.

    Candidates meet on the house number, the key's further part and the unit. A place without a unit meets those with one
    in a join of its own, so places of one building with different units never meet.
    """
    p = places.select("place", *FIELDS).dropDuplicates(["place"])
    coded, bare = p.filter("postal <> ''"), p.filter("postal = ''")
    alike = _agree("kind") & _agree("direction")
    street = (F.expr("a.street = b.street") | _close("a.street", "b.street")) & alike
    street_of_code = (F.expr("a.street = b.street") | _close("a.street", "b.street", 1)) & alike
    city = F.expr("a.city = b.city") | _close("a.city", "b.city") | F.expr("(a.city = '' or b.city = '') and a.region = b.region and a.region <> ''")
    found = []

    def meet(left: DataFrame, right: DataFrame, on: list[str], test, ordered: bool):
        for which in ("same", "given", "missing"):
            x, y, keys = left, right, list(on)
            if which == "same":
                keys.append("unit")
            elif which == "given":
                x, y = left.filter("unit <> ''"), right.filter("unit = ''")
            elif ordered:
                continue  # one table on both sides: the mirror of the join before
            else:
                x, y = left.filter("unit = ''"), right.filter("unit <> ''")
            cond = F.lit(True)
            for k in keys:
                cond = cond & F.expr(f"a.{k} = b.{k}")
            if which == "same" and ordered:
                cond = cond & F.expr("a.place < b.place")
            found.append(x.alias("a").join(y.alias("b"), cond).filter(test).select(F.expr("least(a.place, b.place)").alias("pa"), F.expr("greatest(a.place, b.place)").alias("pb")))

    meet(coded, coded, ["number", "postal"], street_of_code, True)
    for other, ordered in ((coded, False), (bare, True)):
        meet(bare, other, ["number", "street"], city & alike, ordered)
        meet(bare.filter("city <> ''"), other, ["number", "city"], street & F.expr("a.street <> b.street"), ordered)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def same_location(live: DataFrame, stage: Stage) -> DataFrame:
    """``id_a, id_b``: records with different stored addresses that denote the same location. Null, blank and filler
    addresses pair with nothing; an empty table gives an empty result."""
    recs = stage.put("records", records(live).filter(F.col("addr").isNotNull()).select("id", "addr"))
    places = stage.put("places", locations(recs, stage))
    pairs = same_place_pairs(places)
    at = recs.join(places.select("addr", "place"), "addr")
    within = expand_variants(at, "place", "addr")
    one, two = at.select(F.col("id").alias("ia"), F.col("place").alias("pa")), at.select(F.col("id").alias("ib"), F.col("place").alias("pb"))
    across = pairs.join(one, "pa").join(two, "pb").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
    return within.unionByName(across)
