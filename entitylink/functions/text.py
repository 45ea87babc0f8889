"""Scalar text expressions: leet reversal, ASCII folding, cleaning, numbers, postal codes, stems, character 3-grams.

All are built-in column expressions, so a scan, its cleaning and its projection stay in one generated stage.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that blocking ignores.
STOP_WORDS = """
inc corp corporation llp ltd limited pvt private co company services enterprises associates group holdings foundation trust society club international
center centre sarl sasu sci sa sas eurl fils freres cie societe and the of in at on for by et du de des la le road rd street st ave avenue drive dr court ct
lane ln boulevard blvd way place pl highway hwy floor flr block blk near opp opposite behind beside plot unit suite ste room rm office off hno house building
bldg nagar colony marg gali rasta chowk rue allee passage quai cours
""".split()
# Words dropped for the legal stem.
LEGAL_TERMS = """
inc corp corporation llp ltd limited pvt private co company services enterprises associates group holdings sa sarl sasu sci sas eurl cie gmbh llc plc
""".split()
# Digits and signs read as letters, in this order; domain endings.
LEET = [("0", "o"), ("1", "l"), ("3", "e"), ("5", "s"), ("@", "a")]
DOMAINS = "com|org|net|in|co|gov|edu|fr|io|biz|info"


@lru_cache
def fold_table() -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition makes of all characters, as far as ASCII is left: characters with one ASCII result as two
    aligned strings, those with several as a dictionary."""
    one_from, one_to, many = [], [], {}
    for code in range(0xA0, 0x20000):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF:
            continue
        ascii_part = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            one_from.append(ch)
            one_to.append(ascii_part)
        elif ascii_part:
            many[ch] = ascii_part
    return "".join(one_from), "".join(one_to), many


def _ranges(chars) -> str:
    """A character class of the characters, neighbours as ranges."""
    out, codes = "", sorted(map(ord, chars))
    start = last = codes[0]
    for code in [*codes[1:], -1]:
        if code != last + 1:
            out += f"\\x{{{start:X}}}-\\x{{{last:X}}}"
            start = code
        last = code
    return f"[{out}]"


def leet(c: Column) -> Column:
    """Digits and signs beside an ASCII letter as the letters they stand for."""
    for sign, letter in LEET:
        c = F.regexp_replace(c, f"(?<=[a-zA-Z]){sign}|{sign}(?=[a-zA-Z])", letter)
    return c


def ascii_fold(c: Column) -> Column:
    """Accents and compatibility forms to ASCII, other characters dropped, lower case."""
    source, target, many = fold_table()
    # characters with several letters are rare: only texts that hold one are taken apart
    pairs = F.create_map(*[F.lit(x) for item in many.items() for x in item])
    several = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")
    c = F.when(c.rlike("[^\\x00-\\x7F]"), F.translate(F.when(c.rlike(_ranges(many)), several).otherwise(c), source, target)).otherwise(c)
    return F.lower(F.regexp_replace(c, "[^\\x00-\\x7F]", ""))


def strip_domain(c: Column) -> Column:
    return F.regexp_replace(c, rf"\.({DOMAINS})\b", " ")


def clean(c: Column) -> Column:
    """Leet reversal, ASCII folding, domain endings and punctuation to spaces, single spaces. Null gives the empty string."""
    c = strip_domain(ascii_fold(leet(F.coalesce(c, F.lit("")))))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9\s]", " "), r"\s+", " "))


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def numbers(c: Column) -> Column:
    """Distinct runs of one to eight digits that stand alone, leading zeros dropped."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"\b(\d{1,8})\b"), 1), lambda x: x.cast("int").cast("string")))


def postal_codes(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"\b(\d{5,6})\b"), 1))


def compact(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def without(ws: Column, terms: list[str]) -> Column:
    return F.filter(ws, lambda w: ~w.isin(terms))


def legal_stem(c: Column) -> Column:
    return F.array_join(without(words(c), LEGAL_TERMS), " ")


def grams3(c: Column) -> Column:
    """The set of 3-character pieces; a shorter text is its own piece, an empty one has none."""
    several = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).when(F.length(c) < 3, F.array(c)).otherwise(several)
