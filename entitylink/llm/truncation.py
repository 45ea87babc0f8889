"""Texts that a field limit or a broken transfer cut off.

1. Hazards. For each source, and for lengths in characters and in bytes, the hazard of a length is the share of the texts of at
   least that length which end there. It is tested against the hazard of the lengths around it, with the false-discovery rate
   controlled in each source. Texts of one length and the same last letters count once, so reposts make no limit.
2. Endings. Corpus counts say how often a word stands at the end of a sentence and how often a word is the beginning of longer
   words. From them comes how much likelier a text ends as it does by being cut than by being finished. Broken markup counts as
   cut; stops, closed markup, links, signs and code count as finished. A mark such as "(read more)" is taken off first.
3. A text is flagged if both together make a cut likelier than not: at a significant length the excess of the hazard is the prior,
   elsewhere (cuts in transfer come at any length) a small one, so that there only telling endings are flagged.

All counts are over all documents, and everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Stage

NEAR, FAR = 25, 100
BLUR = 4
FALSE_DISCOVERY = 0.01
LEAST_EXCESS = 0.5
#: Odds that a text was cut in transfer, at a length that is nothing special.
TRANSFER_ODDS = 0.04
#: Distinct endings that the lengths close to a limit must have together.
LEAST_ENDINGS = 8
#: How much likelier a text ends without any stop, or with one, if it was cut.
WITHOUT_STOP, WITH_STOP = 8.0, 0.02
BROKEN = 500.0
MARKED = 1000.0
UNSEEN = 1.0

# Marks that sources put after a cut.
_MARK = r"(?i)\s*(?:\(\s*(?:read more|more|continued|continue reading|truncated|cut|\.\.\.|…)\s*\)|\[\s*(?:read more|more|continued|truncated|cut|\.\.\.|…)\s*\]|\bread more\b|<\s*truncated\s*>)[\s.…»>]*$"
_DOTS = r"\s*(?:\.\.\.+|…)\s*$"
# scripts without spaces between words count by character
_WORD = r"(?:[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]][\p{L}\p{M}\p{N}'’&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]*)"
_PIECES = rf"({_WORD})([^\p{{L}}\p{{M}}\p{{N}}]*)"
# the same for texts without any character of those scripts, whose blocks are these
_NO_SPACES = r"[\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{FE30}-\x{FE4F}\x{FF00}-\x{FFEF}\x{16FE0}-\x{1B2FF}\x{1F200}-\x{1F2FF}\x{20000}-\x{3FFFF}]"
_PLAIN_WORD = r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}'’]*+"
_PLAIN_PIECES = rf"{_PLAIN_WORD}[^\p{{L}}\p{{M}}\p{{N}}]*+"
_STOPS = r"[.!?…।॥。！？؟:;]|\n"
# an opened tag, bracket code, entity or address that does not end
_BROKEN_END = r"(?:<[a-zA-Z/!][^<>]{0,80}|\[/?[a-zA-Z*]{1,12}(?:=[^\]\n]{0,60})?|\[/?|</?|&(?:[a-zA-Z]{2,8}|#\d{0,5})|&(?:amp;)+[a-zA-Z]{1,6}|\b(?:https?:?/{0,2}|http|htt|www\.?)|https?://[a-z0-9-]{1,40}\.?)$"
_LINK_END = r"(?:https?://|www\.)[^\s]+\.[a-z]{2,}[^\s]*$"
_CODE_END = r"(?:\[/code\]|</code>|</pre>|```)\s*$"
# lines below the last line of dashes, or a signature in italics
_SIGNED = r"(?s)(?:^|\n)(?:-- ?|_{5,}|—+|-{4,})\n[^\n]{1,120}$"
_QUOTED_END = r"(?:^|\n)>[^\n]*(?:\[\.\.\.\]|\[…\]|…|\.\.\.)\s*$"


#: Characters of an ending that are judged; the last line is judged whole if it is longer. No pattern looks further back.
ENDING = 300
# blanks as the patterns' \\s counts them
_SPACES = " \t\n\x0b\f\r"


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Further columns that are computed once for each row, however often later columns use them."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _ending(c: str) -> Column:
    line = F.substring_index(c, "\n", -1)
    return F.when(F.length(line) > ENDING, F.concat(F.when(F.length(line) < F.length(c), "\n").otherwise(""), line)).otherwise(F.substring(c, -ENDING, ENDING))


def endings(documents: DataFrame) -> DataFrame:
    """``doc_id, source, chars, bytes, dotted, kind, last, ending``: the length and the ending of each text that has one.

    Texts are trimmed with built-in functions; every pattern then runs on the ending only, which holds all that it may match.
    """
    keep = ["doc_id", "source", "bytes"]
    df = documents.filter(F.col("text").isNotNull()).select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.octet_length("text").alias("bytes"), F.rtrim("text", F.lit(_SPACES)).alias("t"))
    df = _once(df, keep, shown=F.when(F.endswith("t", F.lit("nbsp;")), F.regexp_replace("t", r"(?:\s|&(?:amp;)*nbsp;)+$", "")).otherwise(F.col("t")))
    df = _once(df, keep, total=F.length("shown"), end=_ending("shown"))
    df = _once(df, [*keep, "total", "end"], marked=F.col("end").rlike(_MARK), dots=F.col("end").rlike(_DOTS))
    unmarked = F.when(F.col("marked"), F.regexp_replace("end", _MARK, "")).otherwise(F.col("end"))
    df = _once(df, [*keep, "total", "end", "marked", (~F.col("marked") & F.col("dots")).alias("dotted")], tail=F.when(F.col("marked") | F.col("dots"), F.regexp_replace(unmarked, _DOTS, "")).otherwise(F.col("end")))
    tail = F.col("tail")
    df = df.withColumn("chars", F.col("total") - F.length("end") + F.length(tail)).filter("chars > 0")
    # the last character decides which patterns can match at all
    df = _once(df, [*keep, "chars", "marked", "dotted", "end", "tail"], wordy=F.substring(tail, -1, 1).rlike(r"[\p{L}\p{M}\p{N}'’]"), shut=F.substring(tail, -1, 1))
    near = F.substring(tail, -100, 100)  # longer than anything broken that the patterns allow
    stopped = F.substring(F.rtrim(tail, F.lit("\"'”’»)]}*_")), -1, 1).isin(*".!?…।॥。！？؟")
    kind = (
        F.when((F.col("marked") | F.col("dotted") | F.endswith("end", F.lit("]"))) & F.col("end").rlike(_QUOTED_END), "quoted")
        .when(F.col("marked"), "marked")
        .when(F.col("shut").isin("]", ">", "`") & tail.rlike(_CODE_END) | tail.rlike("--|__|—") & tail.rlike(_SIGNED) | tail.rlike(r"://|www\.") & tail.rlike(_LINK_END), "finished")
        .when(near.rlike(_BROKEN_END), "broken")
        .when(stopped, "stopped")
        .when(F.substring(tail, -3, 3).rlike(r"(?:°\s?[CFcf]|[:;=]-?[()])$") | (F.col("shut") == ";") & tail.rlike(r"&(?:amp;)*[a-zA-Z#0-9]+;$"), "closed")
        .when(F.col("shut").isin(*",:(–—-") | F.substring(tail, -25, 25).rlike(r"\([^()\n]{0,24}$"), "open")
        .when(~F.col("wordy"), "closed")
        .otherwise("word")
    )
    of = lambda word: F.regexp_extract("tail", rf"({word})[^\p{{L}}\p{{M}}\p{{N}}]*$", 1)
    last = F.lower(F.when(tail.rlike(_NO_SPACES), of(_WORD)).otherwise(of(_PLAIN_WORD)))
    letters = F.regexp_replace(F.lower(F.substring("tail", -80, 80)), r"[^\p{L}]+", "")
    return df.select("doc_id", "source", "chars", "bytes", "dotted", kind.alias("kind"), last.alias("last"), F.xxhash64(F.substring(letters, -10, 10)).alias("ending"))


def hazards(ends: DataFrame) -> DataFrame:
    """``source, unit, length, n, at_risk, expected, excess``: lengths of significantly raised hazard."""
    long = ends.select("source", "ending", F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array("chars", "bytes"))).alias("unit", "length"))
    counts = long.distinct().groupBy("source", "unit", "length").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("source", "unit").orderBy("length")
    at_risk = counts.withColumn("at_risk", F.sum("n").over(by.rangeBetween(0, Window.unboundedFollowing)))
    # hazards of the lengths around; a length that no text has adds risk without an end, taken as the risk of the next length that exists
    around = lambda c: F.coalesce(F.sum(c).over(by.rangeBetween(-FAR, -NEAR)), F.lit(0)) + F.coalesce(F.sum(c).over(by.rangeBetween(NEAR, FAR)), F.lit(0))
    gap = F.col("length") - F.coalesce(F.lag("length").over(by), F.col("length") - 1)
    exposed = at_risk.withColumn("exposure", F.col("at_risk") * F.least(gap, F.lit(NEAR)))
    base = exposed.withColumn("rate", (around("n") + 0.5) / (around("exposure") + 1.0)).withColumn("expected", F.greatest(F.col("rate") * F.col("at_risk"), F.lit(0.05)))
    # the tail of the Poisson law by its exponential bound, which is never too small; a limit that marks or whole words blur shows in the lengths close by together
    wide = by.rangeBetween(-BLUR, BLUR)
    base = base.withColumns({"wide_n": F.sum("n").over(wide), "wide_expected": F.sum("expected").over(wide)})
    tail = lambda n, e: F.when(F.col(n) > F.col(e), F.exp(-(F.col(n) * F.log(F.col(n) / F.col(e)) - F.col(n) + F.col(e)))).otherwise(1.0)
    alone, blurred = tail("n", "expected"), tail("wide_n", "wide_expected")
    tested = base.withColumn("p", 2 * F.least(alone, blurred))
    ranked = tested.withColumn("turn", F.row_number().over(Window.partitionBy("source", "unit").orderBy("p"))).withColumn("tests", F.count(F.lit(1)).over(Window.partitionBy("source", "unit")))
    last_good = F.max(F.when(F.col("p") <= FALSE_DISCOVERY * F.col("turn") / F.col("tests"), F.col("turn"))).over(Window.partitionBy("source", "unit"))
    good = ranked.withColumn("last_good", last_good).filter(F.col("turn") <= F.col("last_good")).withColumn("excess", F.least(1 - F.col("wide_expected") / F.col("wide_n"), F.lit(1.0)))
    return good.filter((F.col("excess") >= LEAST_EXCESS) & (F.col("wide_n") >= LEAST_ENDINGS)).select("source", "unit", "length", "n", "at_risk", "expected", "excess")


def word_statistics(documents: DataFrame) -> DataFrame:
    """``word, n, finals``: how often a word stands inside the texts, and how often at the end of a sentence. The last word of a
    text is left out: it is what is judged."""
    pieces = F.when(F.col("text").rlike(_NO_SPACES), F.regexp_extract_all("text", F.lit(_PIECES), F.lit(0))).otherwise(F.regexp_extract_all("text", F.lit(_PLAIN_PIECES), F.lit(0)))
    each = documents.filter(F.col("text").isNotNull()).select(F.explode(F.array(pieces)).alias("p")).filter(F.size("p") > 1).select(F.explode(F.slice("p", 1, F.size("p") - 1)).alias("piece"))
    counted = each.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    words = counted.select(F.lower(F.regexp_extract("piece", rf"^{_WORD}", 0)).alias("word"), "n", F.when(F.regexp_extract("piece", rf"^{_WORD}([\s\S]*)$", 1).rlike(_STOPS), F.col("n")).otherwise(0).alias("finals"))
    return words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("finals").alias("finals"))


def beginnings(words: DataFrame, least: int = 5) -> DataFrame:
    """``begin, weight``: for each proper beginning of the words seen at least ``least`` times, how often a cut inside a word leaves it."""
    w = words.filter((F.col("n") >= least) & F.length("word").between(2, 40))
    return w.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, 1, i))")).alias("begin"), (F.col("n") / F.length("word")).alias("part")).groupBy("begin").agg(F.sum("part").alias("weight"))


def judged(documents: DataFrame, stage: Stage) -> DataFrame:
    """``doc_id, source, kind, odds``: the odds that each text was cut off, by length and ending. Null, empty and blank texts have none."""
    docs = documents.select("doc_id", "source", "text")
    ends = stage.put("ends", endings(docs))
    words = stage.put("words", word_statistics(docs))
    wanted = ends.filter("last <> ''").groupBy(F.col("last").alias("word")).agg(F.count(F.lit(1)).alias("ends"))
    total = words.agg(F.sum("n").alias("all_n"), F.sum("finals").alias("all_finals")).crossJoin(ends.agg(F.count(F.lit(1)).alias("texts")))
    begun = beginnings(words).withColumnRenamed("begin", "word").join(wanted.select("word"), "word", "left_semi")
    seen = wanted.join(words, "word", "left").join(begun, "word", "left").fillna(0, ["n", "finals", "weight"]).crossJoin(F.broadcast(total))
    left_over = F.col("n") / 2 + F.col("weight")
    # words that end many more texts than cuts can leave them at are how people end posts, as "thanks"
    surplus = F.greatest(F.lit(0.0), F.col("ends") - 3 - 10 * F.col("texts") * TRANSFER_ODDS * left_over / F.col("all_n"))
    finals = F.col("finals") + surplus * F.col("all_finals") / F.greatest(F.col("texts"), F.lit(1))
    ratio = seen.select(F.col("word").alias("last"), ((F.col("all_finals") / F.col("all_n")) * left_over / (finals + UNSEEN)).alias("ratio"))
    limits = stage.put("limits", hazards(ends))
    limit = lambda unit: limits.filter(F.col("unit") == unit).select("source", F.col("length").alias(unit), F.col("excess").alias(f"{unit}_excess"))
    full = ends.join(limit("chars"), ["source", "chars"], "left").join(limit("bytes"), ["source", "bytes"], "left").join(ratio, "last", "left")
    excess = F.greatest(F.coalesce("chars_excess", F.lit(0.0)), F.coalesce("bytes_excess", F.lit(0.0)))
    prior = F.when(excess > 0, excess / (1 - F.least(excess, F.lit(0.99)))).otherwise(TRANSFER_ODDS)
    by_word = WITHOUT_STOP * F.least(F.greatest(F.coalesce("ratio", F.lit(0.5)), F.lit(0.05)), F.lit(BROKEN))
    likelihood = (
        F.when(F.col("kind") == "marked", MARKED).when(F.col("kind") == "broken", BROKEN).when(F.col("kind").isin("stopped", "finished", "quoted"), 0.0).when(F.col("kind") == "closed", WITH_STOP).when(F.col("kind") == "open", WITHOUT_STOP * 10)
        .when(F.col("dotted") & (excess == 0), by_word / WITHOUT_STOP * 2).otherwise(by_word)
    )
    return full.select("doc_id", F.col("source"), "kind", "last", excess.alias("excess"), (prior * likelihood).alias("odds"))


def truncated(documents: DataFrame, stage: Stage) -> DataFrame:
    """``doc_id, at_limit`` of the texts that were cut off; ``at_limit`` tells those at a significant length from those cut in transfer."""
    return judged(documents, stage).filter(F.col("odds") > 1).select("doc_id", (F.col("excess") > 0).alias("at_limit")).distinct()


def truncation_rates(documents: DataFrame, stage: Stage) -> DataFrame:
    """``source, documents, truncated, at_limit, share``; a null source is its own row, a repeated row counts once."""
    docs = documents.select("doc_id", "source").distinct()
    found = docs.join(truncated(documents, stage), "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count("at_limit").alias("truncated"), F.count_if("at_limit").alias("at_limit"))
    return found.withColumn("share", F.col("truncated") / F.col("documents"))
