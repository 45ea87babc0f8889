"""One consistent form for text that looks the same but is stored with different characters."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Stage, records

# Letters of other alphabets that look like a Latin letter (Unicode confusables, only pairs that common fonts draw alike).
LOOKS_LIKE = {
    # Cyrillic small
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ү": "y",
    # Cyrillic capital
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek small
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "υ": "u", "ϲ": "c", "ϳ": "j",
    # Greek capital
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
    # Latin letters outside the basic alphabet, Armenian, Cherokee
    "ɡ": "g", "ɑ": "a", "ı": "i", "օ": "o", "ս": "u", "հ": "h", "ց": "g", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T",
}
_MAP = str.maketrans(LOOKS_LIKE)
_INVISIBLE = regex.compile(r"[\p{Default_Ignorable_Code_Point}\p{Cf}]+")
_BLANKS = regex.compile(r"[\s\p{Z}]+")
_PLAIN = regex.compile(r"[!-~]+(?: [!-~]+)*")


def visible_form(text: str) -> str:
    """The form shared by all texts that look like this one: compatibility decomposition, invisible characters removed,
    look-alikes to Latin, composition, runs of any blanks to one space, none outside. Case, accents and punctuation stay.
    A text of invisible characters only becomes the empty string."""
    if _PLAIN.fullmatch(text):
        return text
    # look-alikes are mapped before and after decomposition: some have a decomposition that no longer looks like them
    apart = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text).translate(_MAP)).translate(_MAP)
    return _BLANKS.sub(" ", unicodedata.normalize("NFKC", apart)).strip()


def case_folded_form(text: str) -> str:
    """``visible_form`` with full case folding, for comparisons in which case does not count."""
    return unicodedata.normalize("NFC", visible_form(text).casefold())


def _series(one):
    return lambda values: values.map(one, na_action="ignore")


def visible_column(c: Column, fold_case: bool = False) -> Column:
    """The consistent form as a column; null stays null. Apply to distinct values: it is an Arrow-batched function."""
    one = _series(case_folded_form if fold_case else visible_form)

    @F.pandas_udf("string")
    def form(values: pd.Series) -> pd.Series:
        return one(values)

    return form(c)


def normalised_names(live: DataFrame) -> DataFrame:
    """``id, name, form, folded``: each record with its stored name, the consistent form and its case-folded variant."""
    named = records(live).filter(F.col("name").isNotNull()).select("id", "name")
    forms = named.select("name").distinct().withColumns({"form": visible_column(F.col("name")), "folded": visible_column(F.col("name"), True)})
    return named.join(forms, "name").select("id", "name", "form", "folded")


def expand_variants(named: DataFrame, key: str, value: str = "name") -> DataFrame:
    """``id_a, id_b``: all pairs of records with the same key and different values.

    Pairs are first formed between the distinct values of a key, then each value is replaced by its records: records with
    equal values never meet, and a key shared by many equal values costs no comparison. Keys with one value drop out
    before the join.
    """
    values = named.select(key, value).distinct()
    a, b = values.withColumnRenamed(value, "va"), values.withColumnRenamed(value, "vb")
    variants = a.join(b, key).filter("va < vb").select("va", "vb")
    one, two = named.select(F.col("id").alias("ia"), F.col(value).alias("va")), named.select(F.col("id").alias("ib"), F.col(value).alias("vb"))
    return variants.join(one, "va").join(two, "vb").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))


def same_to_the_eye(live: DataFrame, stage: Stage) -> DataFrame:
    """``id_a, id_b``: records whose stored names differ and look the same. Null names, and names without any visible
    character, pair with nothing."""
    named = stage.put("named", records(live).filter(F.col("name").isNotNull()).select("id", "name"))
    forms = named.select("name").distinct().withColumn("form", visible_column(F.col("name"))).filter("form <> ''")
    return expand_variants(stage.put("formed", named.join(forms, "name")), "form")
