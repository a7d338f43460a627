"""Lexicon, frequency and edit-distance operators on a lossless token stream."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.text import LETTER
from ..tables import Scratch, map_column

FUNCTION_WORDS = "le la les du de des un une et ou au aux en dans par pour sur avec ce cet ces mon ton son mes tes ses nos vos".split()
PUNCTUATION = ".,;:!?()[]{}«»\"‘’'`*_–—…/\\|@#$%^&+=<>~°•·"
ROMAN_NUMBER = "(?i)^(?=[MDCLXVI])M{0,4}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})$"
FOREIGN = (
    "[^aeiouàâéèêëîïôùûü]{4,}", "(?:ck|oo|ee|ij|recht|ae)\\b", "\\bsch", "\\bth[^éèêëàâîïôùûü]",
    "\\b\\w*(?:atione|ione|orum|arum|ibus|onis)\\b", "\\b\\w{4,}ung\\b", "\\b\\w+(?:keit|heit|schaft)\\b", "\\bge[rst][a-z]{4,}\\b",
)


def tokens(df: DataFrame, pattern: str = "(\\S+|\\s+)", text: str = "text") -> DataFrame:
    """(doc_id, pos, tok); joining the tokens in order of pos gives the text again."""
    return df.select("doc_id", F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("pos", "tok"))


def rebuild(stream: DataFrame, tok: str = "tok") -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(tok).alias("t"))))
    return stream.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("text"))


#: Most rows of a map (old, new) that is broadcast; a larger one is joined.
MAP_ROWS = 1_000_000


def replaced(df: DataFrame, mapping: DataFrame, pattern: str, old: Column, key: Callable[[str], str], put: Callable[[str, str, str], str] = lambda tok, old, new: new) -> DataFrame:
    """df with every token of the text (a match of the pattern) whose key is mapped replaced by put(token, old, new), all rows and columns kept.

    A map of at most MAP_ROWS rows goes to the executors, and each text is rewritten where it is. For a larger map the distinct
    tokens alone are joined (`old` is the key as a column of tok), and each text gets the part of the map that it needs.
    """
    regex = re.compile(pattern, re.ASCII)
    scratch = Scratch(df.sparkSession, "replaced")
    pairs = scratch.save(mapping.select("old", "new").dropDuplicates(["old"]))

    def rewrite(text: str | None, known: dict[str, str]) -> str | None:
        return None if text is None else regex.sub(lambda m: put(m[0], k, known[k]) if (k := key(m[0])) in known else m[0], text)

    if pairs.count() <= MAP_ROWS:
        held = df.sparkSession.sparkContext.broadcast({r["old"]: r["new"] for r in pairs.toLocalIterator()})
        return map_column(df, "text", lambda text: rewrite(text, held.value))

    digest = F.xxhash64("text")
    asked = df.select(digest.alias("_digest"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))).alias("tok")).distinct()
    found = asked.join(pairs, old == F.col("old")).groupBy("_digest").agg(F.collect_list("old").alias("_olds"), F.collect_list("new").alias("_news"))
    joined = df.join(found, digest == F.col("_digest"), "left").drop("_digest")
    return map_column(joined, "text", lambda text, o, n: rewrite(text, {} if o is None else dict(zip(o, n, strict=True))), "_olds", "_news").drop("_olds", "_news")


def derive(df: DataFrame, least_documents: int) -> DataFrame:
    """A lexicon from the texts: forms in at least so many documents."""
    words = df.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"({LETTER}+)"), F.lit(1)))).alias("form"))
    return words.groupBy("form").count().filter(F.col("count") >= least_documents).select("form")


def known(words: DataFrame, lexicon: DataFrame, column: str) -> DataFrame:
    """LEX1: `known` is true if the word or its lower form is in the lexicon, has two letters and isn't all capitals."""
    w = F.col(column)
    forms = lexicon.select(F.col("form").alias("_form")).distinct()
    asked = words.select(w.alias("_word")).distinct().withColumn("_key", F.explode(F.array_distinct(F.array("_word", F.lower("_word")))))
    hits = asked.join(forms, F.col("_key") == F.col("_form"), "left_semi").select("_word").distinct().withColumn("_hit", F.lit(True))
    fits = (F.length(w) >= 2) & ~((F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w))
    return words.join(hits, w == F.col("_word"), "left").withColumn("known", F.coalesce("_hit", F.lit(False)) & fits).drop("_word", "_hit")


def commas(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """R10: a blank after a comma between two known words that aren't both of at most two letters. Only pairs around commas leave the texts."""
    pattern = f"(?<!{LETTER}){LETTER}++,{LETTER}++"
    near = df.filter(F.col("text").rlike(f",(?<={LETTER},)(?={LETTER})"))
    pairs = near.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("tok")).distinct()
    pairs = Scratch(df.sparkSession, "commas").save(pairs)
    pairs = pairs.withColumns({"a": F.substring_index("tok", ",", 1), "b": F.substring_index("tok", ",", -1)})
    pairs = known(known(pairs, lexicon, "a").withColumnRenamed("known", "ka"), lexicon, "b")
    fixed = pairs.filter("ka AND known AND NOT (length(a) <= 2 AND length(b) <= 2)").select(F.col("tok").alias("old"), F.concat("a", F.lit(", "), "b").alias("new"))
    return replaced(df, fixed, pattern, F.col("tok"), lambda tok: tok)


def splits(words: DataFrame, lexicon: DataFrame, blacklist: list[str] | None = None, most: int = 5) -> DataFrame:
    """LEX2, LEX3: (word, first, rest, place) proposals for unknown words of five letters or more.

    Longest function-word prefixes come first, then cuts from left to right; at most `most` for each word.
    """
    scratch = Scratch(words.sparkSession, "splits")
    words = scratch.save(words.select(F.lower("word").alias("word")).distinct().filter("length(word) >= 5"))
    words = known(words, lexicon, "word").filter("NOT known").select("word")
    if blacklist:
        words = words.filter(~F.col("word").isin(blacklist))
    cut = words.withColumn("cut", F.explode(F.sequence(F.lit(1), F.length("word") - 1)))
    cut = cut.withColumns({"first": F.expr("substring(word, 1, cut)"), "rest": F.expr("substring(word, cut + 1)")})
    prefix = F.col("first").isin(FUNCTION_WORDS)
    inner = (F.col("cut") >= 3) & (F.col("cut") <= F.length("word") - 3) & ~prefix
    cut = scratch.save(known(scratch.save(cut.filter(prefix | inner)), lexicon, "rest").filter("known").drop("known"))
    cut = known(cut, lexicon, "first").filter(prefix | F.col("known")).drop("known")
    order = W.partitionBy("word").orderBy(prefix.desc(), F.when(prefix, -F.col("cut")).otherwise(F.col("cut")))
    return cut.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).select("word", "first", "rest", "place")


def apply_map(df: DataFrame, mapping: DataFrame, pattern: str = "\\S+|\\s+") -> DataFrame:
    """LEX4, LEV5: tokens whose lower form is mapped (old, new) are replaced, the rest stays, empty texts too."""
    return replaced(df, mapping, pattern, F.lower("tok"), str.lower)


def proposals(splits: DataFrame, decided: DataFrame) -> DataFrame:
    """LEX4: (old, new) from the proposals (word, first, rest, place) and the table of decisions (word, verdict, result): a
    refused word stays, a corrected one takes the correction, an accepted or undecided one its first proposal."""
    first = splits.filter("place = 1").select("word", F.concat_ws(" ", "first", "rest").alias("split"))
    joined = first.join(decided.select("word", "verdict", "result"), "word", "left").filter("verdict IS NULL OR verdict <> 'refuse'")
    return joined.select(F.col("word").alias("old"), F.when(F.col("verdict") == "correct", F.col("result")).otherwise(F.col("split")).alias("new"))


def gated(near: DataFrame, most_auto: int = 1) -> DataFrame:
    """LEV6: of the corrections (word, correction, distance), those up to `most_auto` edits are applied (`auto`), the others go to a reader (`review`)."""
    return near.withColumn("regime", F.when(F.col("distance") <= most_auto, "auto").otherwise("review"))


def contexts(df: DataFrame, reach: int = 3) -> DataFrame:
    """LEX5: every word with `reach` words before and after it."""
    w = W.partitionBy("doc_id").orderBy("pos")
    stream = df.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("\\S+"), F.lit(0))).alias("pos", "word"))
    return stream.withColumn("context", F.array_join(F.collect_list("word").over(w.rowsBetween(-reach, reach)), " "))


def decisions(rows: DataFrame, key: str = "word") -> DataFrame:
    """LEX6: accepted corrections of a validation table; the last line of a key wins."""
    d = F.lower(F.trim("decision"))
    last = F.row_number().over(W.partitionBy(key).orderBy(F.desc("line")))
    said = rows.withColumn("verdict", F.when(d.isin("y", "ok"), "accept").when(d.isin("n", "non"), "refuse").when(d.isin("c", "corr"), "correct").otherwise("open"))
    return said.withColumn("_n", last).filter("_n = 1").drop("_n").withColumn("result", F.when(F.col("verdict") == "accept", F.col("suggestion")).when(F.col("verdict") == "correct", F.col("correction")))


def refusal_tally(refused: DataFrame, endings: tuple[str, ...] = ("eurs", "onc")) -> DataFrame:
    """LEX7"""
    return refused.agg(*(F.count_if(F.col("word").endswith(e)).alias(f"n_{e}") for e in endings))


def numeric(w: Column) -> Column:
    """UNK1"""
    return w.rlike("^[0-9]+$") | w.rlike(ROMAN_NUMBER) | w.rlike("^\\d+(?:[-–]\\d+)*$") | w.rlike("(?i)^[a-z]*-?\\d+[a-z]*$")


def structural(w: Column) -> Column:
    """UNK2"""
    return w.rlike("(?i)http|ark|www|gallica") | w.contains("/")


def foreign(w: Column) -> Column:
    """UNK5"""
    return F.lower(w).rlike("(?U)" + "|".join(FOREIGN))


def compounds(words: DataFrame, lexicon: DataFrame, sign: str = "-") -> DataFrame:
    """UNK3, UNK4: adds `valid`: hyphen compounds whole, joined or with all parts known; apostrophe forms of two parts with one known."""
    split = words.filter(F.col("word").contains(sign)).select("word").distinct()
    parts = split.withColumn("part", F.explode(F.array_distinct(F.split("word", sign))))
    parts = known(parts, lexicon, "part").groupBy("word").agg(F.bool_and("known").alias("every"), F.bool_or("known").alias("some"))
    if sign == "'":
        ok = parts.filter((F.size(F.split("word", sign)) == 2) & F.col("some"))
    else:
        whole = known(split.withColumn("joined", F.replace("word", F.lit(sign), F.lit(""))), lexicon, "joined").filter("known").select("word")
        ok = parts.filter("every").select("word").union(whole).union(known(split, lexicon, "word").filter("known").select("word"))
    ok = ok.select(F.col("word").alias("_ok")).distinct()
    return words.join(ok, F.col("word") == F.col("_ok"), "left").withColumn("valid", F.col("_ok").isNotNull()).drop("_ok")


#: More places than a text has tokens, and a number below every doc_id.
PLACES, NO_DOCUMENT = str(1 << 31), str(-(1 << 63) - 1)


def unknown_forms(df: DataFrame, lexicon: DataFrame, least: int = 2, most: int = 10) -> DataFrame:
    """UNK7, UNK8: (form, n, first_doc, first_pos) of unknown lower-case forms, most frequent first in the order of the export.

    The texts are read once: raw tokens are counted before they are cleaned and tested, and what the lexicon is asked about is written.
    """
    scratch, kind = Scratch(df.sparkSession, "unknown"), df.schema["doc_id"].dataType
    stream = df.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("(?U)([\\w'][\\w'-]{2,})"), F.lit(1))).alias("pos", "raw"))
    first, doc, pos = F.struct("doc_id", "pos"), F.col("first.doc_id"), F.col("first.pos")
    if isinstance(kind, IntegralType):  # as one number: a least struct would have all tokens sorted
        first = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(NO_DOCUMENT).cast("decimal(20,0)")) * F.lit(PLACES).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
        pos = F.expr(f"pmod(first, cast({PLACES} AS decimal(10,0)))")
        doc = F.nullif(((F.col("first") - pos) / F.lit(PLACES).cast("decimal(10,0)")).cast("decimal(20,0)"), F.lit(NO_DOCUMENT).cast("decimal(20,0)")).cast(kind)
    raws = stream.groupBy("raw").agg(F.count("*").alias("n"), F.min(first).alias("first"))
    raws = raws.withColumn("word", F.trim(F.translate("raw", PUNCTUATION.replace("'", ""), "")))
    raws = raws.filter((F.lower("word") == F.col("word")) & ~numeric(F.col("word")) & ~structural(F.col("word")) & ~foreign(F.col("word")))
    rare = scratch.save(raws.groupBy("word").agg(F.sum("n").alias("n"), F.min("first").alias("first")).filter(F.col("n").between(least, most)))
    lexicon = scratch.save(lexicon.select("form").distinct())
    rare = scratch.save(known(rare, lexicon, "word").filter("NOT known").drop("known"))
    rare = scratch.save(compounds(rare, lexicon).filter("NOT valid").drop("valid"))
    rare = compounds(rare, lexicon, "'").filter("NOT valid").drop("valid")
    return rare.select(F.col("word").alias("form"), "n", doc.alias("first_doc"), pos.cast("int").alias("first_pos"))


def learned_corrections(df: DataFrame, model: DataFrame) -> DataFrame:
    """UNK9: the token without its punctuation, lower, is looked up (old, new); the first occurrence in the raw token is replaced."""
    away = str.maketrans("", "", PUNCTUATION)
    clean = F.lower(F.trim(F.translate("tok", PUNCTUATION, "")))
    return replaced(df, model, "\\S+", clean, lambda tok: tok.translate(away).lower(), lambda tok, old, new: tok.replace(old, new, 1))


def of_language(df: DataFrame, stop_words: list[str], least: float = 0.1, text: str = "text") -> DataFrame:
    """UNK6: adds `in_language`: at least that share of a text's words are the language's function words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({LETTER}+)"), F.lit(1))
    hits = F.size(F.filter(words, lambda w: w.isin(stop_words)))
    return df.withColumn("in_language", (F.size(words) > 0) & (hits >= F.size(words) * F.lit(least)))


def osa(a: str, b: str, swap: int = 1, most: int = 2) -> int:
    """LEV1: optimal string alignment distance, most + 1 if above."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + swap)
            now.append(d)
        before, row = row, now
    return min(row[-1], most + 1)


def deletions(w: Column, most: int = 2) -> Column:
    """The word and all words with up to `most` letters taken out: words within that distance share one of them."""
    drop = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    one = F.array_distinct(drop(w))
    return F.array_distinct(F.concat(F.array(w), one, F.flatten(F.transform(one, drop))) if most == 2 else F.concat(F.array(w), one))


def osa_many(a: pd.Series, b: pd.Series, most: int = 2) -> np.ndarray:
    """osa of all pairs at once: the band of the matrix within `most` of its diagonal, a cell of all pairs at a time; most + 1 if above."""
    if not len(a):
        return np.zeros(0, dtype="int64")
    n, m = a.str.len().to_numpy(dtype="int64"), b.str.len().to_numpy(dtype="int64")
    x, y = (np.array(s.to_numpy(dtype=str)).view("uint32").reshape(len(s), -1) for s in (a, b))
    far = most + 1
    out = np.full(len(n), far, dtype="int64")
    cells: dict[tuple[int, int], np.ndarray] = {}
    for i in range(x.shape[1] + 1):
        for j in range(max(0, i - most), min(y.shape[1], i + most) + 1):
            if i == 0 or j == 0:
                d = np.full(len(n), i + j, dtype="int64")
            else:
                d = cells[i - 1, j - 1] + (x[:, i - 1] != y[:, j - 1])
                for near in ((i - 1, j), (i, j - 1)):
                    if near in cells:
                        d = np.minimum(d, cells[near] + 1)
                if i > 1 and j > 1:
                    swap = (x[:, i - 1] == y[:, j - 2]) & (x[:, i - 2] == y[:, j - 1])
                    d = np.where(swap, np.minimum(d, cells[i - 2, j - 2] + 1), d)
            cells[i, j] = d
            out = np.where((n == i) & (m == j), np.minimum(d, far), out)
        cells = {k: v for k, v in cells.items() if k[0] >= i - 1}
    return out


def nearest(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """LEV3: (word, correction, distance) where one lexicon form alone is nearest within two edits.

    The join is on deletion neighbourhoods, which lose no pair within their distance; the exact distance is checked in Arrow batches.
    Words with a form within one edit need no more: only the others are compared within two.
    """
    scratch = Scratch(words.sparkSession, "nearest")
    words, lexicon = scratch.save(words.select("word").distinct()), scratch.save(lexicon.select("form").distinct())

    @F.pandas_udf("int")
    def distance(a, b):
        return pd.Series(osa_many(a, b))

    distance.func.__annotations__ = {}

    def within(asked: DataFrame, most: int) -> DataFrame:
        """(word, distance, form, n): the least distance, one of the forms that have it, and their number."""
        keyed = lambda df, c: df.select(c, F.explode(deletions(F.col(c), most)).alias("_key"))
        pairs = keyed(asked, "word").join(keyed(lexicon, "form"), "_key").filter(F.abs(F.length("word") - F.length("form")) <= most).select("word", "form").distinct()
        near = pairs.withColumn("distance", distance("word", "form")).filter(F.col("distance") <= most)
        best = near.groupBy("word", "distance").agg(F.min("form").alias("form"), F.count("*").alias("n"))
        return scratch.save(best.groupBy("word").agg(F.min(F.struct("distance", "form", "n")).alias("b")).select("word", "b.*"))

    one = within(words, 1)
    best = one.union(within(words.join(one, "word", "left_anti"), 2))
    return best.filter("n = 1").select("word", F.col("form").alias("correction"), "distance")


def hapaxes(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """LEV2, LEV4: forms that occur once, of five letters, unknown and not foreign."""
    words = df.select(F.explode(F.regexp_extract_all("text", F.lit(f"(?U)\\b({LETTER}{{3,}})\\b"), F.lit(1))).alias("raw"))
    word = F.lower("raw")
    once = words.groupBy(word.alias("word")).agg(F.count("*").alias("n"), F.count_if(word == F.col("raw")).alias("low")).filter("n = 1 AND low = 1")
    fit = Scratch(df.sparkSession, "hapaxes").save(once.filter((F.length("word") >= 5) & ~foreign(F.col("word"))).select("word"))
    return known(fit, lexicon, "word").filter("NOT known").select("word")


def wilson(spark, n: int, z: float = 1.96) -> DataFrame:
    """LEV7: interval of the error rate for k errors in n checks."""
    ks = [(k,) for k in (0, 1, 2, 3, 5, 8, 10, 15, 20) if k <= n]
    p, m, zz = F.col("k") / F.lit(float(n)), F.lit(float(n)), z * z
    centre, half = (p + zz / (2 * m)) / (1 + zz / m), z * F.sqrt(p * (1 - p) / m + zz / (4 * m * m)) / (1 + zz / m)
    return spark.createDataFrame(ks, "k int").select("k", F.greatest(F.lit(0.0), centre - half).alias("low"), F.least(F.lit(1.0), centre + half).alias("high"))
