import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T

CASES = [
    (T.apostrophes, "l‘étude aujourd`hui", "l'étude aujourd'hui"),
    (T.dashes, "1870–1871", "1870-1871"),
    (T.controls, "mot​mot", "mot mot"),
    (T.controls, "﻿Introduction", "Introduction"),
    (T.controls, "a\r\n\n\nb", "a\n\nb"),
    (T.spaces, "a   b  \n c", "a b\nc"),
    (T.ordinals, "lr Janvier 1874; 2me PARTIE; 2™ PARTIE; I800", "1er Janvier 1874; 2e PARTIE; 2e PARTIE; 1800"),
    (lambda t: T.ordinals(t, True), "XIXme siècle", "XIXe siècle"),
    (T.months, "19 Août 1875 SESSION DE AOÛT aoùt", "19 août 1875 SESSION DE AOÛT août"),
    (T.abbreviations, "MM Asser pp 438-552 n° 59 St-Pétersbourg", "MM. Asser pp. 438-552 n.° 59 St.-Pétersbourg"),
    (T.all_punctuation, "nous;justifier", "nous ; justifier"),
    (T.all_punctuation, "réunion à 10:30", "réunion à 10:30"),
    (T.all_punctuation, "venir.La Belgique", "venir. La Belgique"),
    (T.romans, "T. Il, pp. 179 T. Vit, 1875", "T. II, pp. 179 T. VII, 1875"),
    (T.references, "T.VI, pp.582-584", "T. VI, pp. 582-584"),
    (T.references, "T. I,pp.118 et ss.", "T. I, pp. 118 et ss."),
    (T.quotes, 'in-8", 670 pp.', "in-8°, 670 pp."),
    (T.ligatures, "OEUVRE Oeuvre oeuvre", "ŒUVRE Œuvre œuvre"),
    (T.normalize_unicode, "é", "é"),
]


@pytest.mark.parametrize(("rule", "given", "wanted"), CASES)
def test_rule(spark, rule, given, wanted):
    assert spark.createDataFrame([(given,)], "t string").select(rule(F.col("t"))).first()[0] == wanted


def test_rules_are_idempotent_and_keep_nulls(spark):
    df = spark.createDataFrame([(c[1],) for c in CASES] + [(None,), ("",)], "t string")
    for rule in (T.apostrophes, T.dashes, T.spaces, T.ordinals, T.months, T.abbreviations, T.romans, T.references, T.quotes, T.ligatures):
        got = df.select(rule(F.col("t")).alias("a")).select("a", rule(F.col("a")).alias("b")).collect()
        assert all(r.a == r.b for r in got)


def test_differences(spark):
    row = spark.createDataFrame([("a b c", "a x c d")], "a string, b string").select(T.token_differences(F.col("a"), F.col("b")).alias("d"), T.audit(F.col("a"), F.col("b")).alias("u")).first()
    assert [tuple(x) for x in row.d] == [(1, "b", "x")]
    assert row.u.n_diff == 2


def mixed_texts(seed: int, n: int) -> list[str | None]:
    """Random strings of what the rules look for and of what is nearly so."""
    r = random.Random(seed)
    bits = [*"’‘  \n\t.,;:!?'\"°§-_013IVXLMoeé", "İ", "ſ", "́", "™", "T. Il", "T.VI", "pp.3", "et ss", 'in-8"', '\n\n"5', "abcd.Efg", "10:30", "I874", "I874™", "lr", "lre", "lRr", "oEuVre", "OeuvrE", "oeuvreſ", "OEİL"]
    bits += [x for a, _ in T.BEFORE for x in (a, f"{a} 3", f"{a} IV")] + [*T.TITLES, *T.LATIN, *T.MONTHS, *(m.capitalize() for m in T.MONTHS)]
    bits += [f(w) for w in T.LIGATURE_WORDS for f in (str, str.upper, str.capitalize)] + [f"{k}{e}" for k in ("1", "12", "XI", "٣") for e in (*T.E_ENDINGS, *T.MISREAD, "lre", "lr", "ere", "ère", "™", "ME", "do")]
    return [None, *("".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randrange(14))) for _ in range(n))]


@pytest.mark.parametrize(("joined", "single"), [
    (T.abbreviations, lambda t: T.fold(T.abbreviation_rules(), t)),
    (lambda t: T.abbreviations(t, ("loc", "éd")), lambda t: T.fold(T.abbreviation_rules(("loc", "éd")), t)),
    (T.ligatures, lambda t: T.fold(T.ligature_rules(), t)),
    (lambda t: T.ordinals(t, True), lambda t: T.fold(T.ordinal_rules(True), t)),
    (T.references, lambda t: T.fold(T.REFERENCE_RULES, t)),
    (T.romans, lambda t: T.fold(T.ROMAN_RULES, t)),
    (T.quotes, lambda t: T.fold(T.QUOTE_RULES, t)),
    (T.apostrophes, lambda t: F.translate(t, T.APOSTROPHES, "''''")),
    (T.all_punctuation, lambda t: F.regexp_replace(F.replace(F.regexp_replace(F.regexp_replace(t, f"(?<=[\\s\\S])(?<! ){T.SIGN}", " $1"), f"{T.SIGN}(?=[^ ])", "$1 "), F.lit(" ,"), F.lit(",")), f"({T.LETTER}{{4,}})\\.(?=[A-ZÀ-Ÿ][a-z])", "$1. ")),
])
def test_rules_joined_are_the_rules_one_by_one(spark, joined, single):
    df = spark.createDataFrame([(t,) for t in mixed_texts(11, 3000)], "t string").repartition(8)
    rows = df.select("t", joined(F.col("t")).alias("a"), single(F.col("t")).alias("b"))
    assert rows.filter("NOT (a <=> b)").collect() == []
    assert rows.filter("a <> t").count() > 20


def test_abbreviations_are_one_pass_and_equal_texts_are_not_taken_apart(spark):
    df = spark.createDataFrame([("MM Asser",), ("rien",)], "t string").repartition(1)
    plan = df.select(T.abbreviations(F.col("t")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") == 1
    taken = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(t):
        taken.add(1)
        return t

    rows = df.select(T.audit(F.col("t"), same("t")).alias("a"), T.token_differences(F.col("t"), F.col("t")).alias("d")).collect()
    assert [(r.a.n_diff, r.a.paragraphs_before, r.a.paragraphs_after, r.d) for r in rows] == [(0, 1, 1, [])] * 2
    assert taken.value == 2
