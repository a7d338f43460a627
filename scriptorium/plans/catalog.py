"""The registered queries on the driver's tables, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import entities as E
from ..operators import lexicon as L
from ..operators import statistics as S
from ..operators import structure as X
from ..sources.readers import press_blocks
from ..tables import Scratch
from . import noise
from . import oracles as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STEPS: dict[str, list[tuple[str, str]] | str] = {}
EDGE, END = "(^|[^\\pL\\pN_])", "($|[^\\pL\\pN_])"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def noisy(spark: SparkSession, d: str) -> DataFrame:
    return noise.corpus(table(spark, d, "documents"))


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def applied(steps: list[tuple[str, str]] | str) -> str:
    """SQL of a rule's steps on the column text."""
    return steps.replace("{x}", "text") if isinstance(steps, str) else O.replaced("text", *steps)


def rule(name: str, make: Callable[[Column], Column], steps: list[tuple[str, str]] | str | None = None) -> None:
    """A query of a text rule: a digest of each document's result, and whether it changed. steps: the same as RE2 replacements, or SQL in terms of x."""
    QUERIES[name] = lambda spark, d: noisy(spark, d).select("doc_id", "text", make(F.col("text")).alias("out")).select("doc_id", F.md5(F.col("out").cast("binary")).alias("digest"), (F.col("out") != F.col("text")).alias("changed"))
    if steps is None:
        return
    STEPS[name] = steps
    x = applied(steps)
    ORACLES[name] = f"SELECT doc_id, md5(o) AS digest, o <> text AS changed FROM (SELECT doc_id, text, {x} AS o FROM ({noise.sql()}))"


def re2(rules: list[T.Rule]) -> list[tuple[str, str]]:
    """Rules without lookarounds, in RE2's notation."""
    return [(r.pattern.replace("(?U)", "").replace("(?iU)", "(?i)"), r.replacement.replace("$", "\\")) for r in rules]


def around(word: str, to: str) -> tuple[str, str]:
    return f"{EDGE}{word}{END}", f"\\1{to}\\2"


rule("r02_apostrophes", T.apostrophes, f"translate({{x}}, {noise.quoted(T.APOSTROPHES)}, {noise.quoted(chr(39) * 4)})")
rule("r03_dashes", T.dashes, f"translate({{x}}, {noise.quoted(T.DASHES)}, '---')")
rule("r04_controls", T.controls, O.controls("{x}"))
rule("r05a_space_characters", T.space_characters, f"translate({{x}}, {noise.quoted(T.WIDE_SPACES)}, {noise.quoted(' ' * len(T.WIDE_SPACES))})")
rule("r05b_multiple_spaces", T.multiple_spaces, "array_to_string([trim(regexp_replace(v, ' {2,}', ' ', 'g')) for v in string_split({x}, chr(10))], chr(10))")
rule("r05_spaces", T.spaces, f"array_to_string([trim(regexp_replace(v, ' {{2,}}', ' ', 'g'), ' ' || chr(9)) for v in string_split(translate({{x}}, {noise.quoted(T.WIDE_SPACES)}, {noise.quoted(' ' * len(T.WIDE_SPACES))}), chr(10))], chr(10))")
_plain = [r for r in T.ordinal_rules(True) if not r.label.startswith("lone_l")]
_cut = next(k for k, r in enumerate(T.ordinal_rules(True)) if r.label == "lone_lr")
_lone = [("(^|[^a-zA-Z0-9])lr($|[^a-zA-Z])", "\\11er\\2"), ("(^|[^a-zA-Z0-9])lre($|[^a-zA-Z])", "\\11re\\2")]
rule("r06_ordinals", lambda t: T.ordinals(t, True), re2(_plain[:_cut]) + _lone + re2(_plain[_cut:]))
rule("r06x_exponents", T.exponents, [("\\b1er\\b", "1ʳ"), ("\\b1re\\b", "1ʳ"), ("\\b(\\d+)e\\b", "\\1ᵉ")])
rule("r07_months", T.months, [("Aoùt", "août"), ("aoùt", "août")] + [around(m.capitalize(), m) for m in T.MONTHS])
rule("r08_abbreviations", T.abbreviations, [(f"{EDGE}({a})({p})", "\\1\\2.\\3") for a, p in T.BEFORE] + [(f"{EDGE}({a})($|[^.\\pL\\pN_])", "\\1\\2.\\3") for a in (*T.TITLES, *T.LATIN) for _ in (1, 2)])
rule("r09_punctuation_fr", T.punctuation)
rule("r09_punctuation_en", lambda t: T.punctuation(t, "en"))
ORACLES["r09_punctuation_fr"] = O.DIGEST.format(O.punctuation(O.NOISE))
ORACLES["r09_punctuation_en"] = O.DIGEST.format(O.punctuation(O.NOISE, "en"))
rule("r09b_comma_space", T.comma_space, [(" ,", ",")])
rule("r09c_glued_stop", T.glued_stop, [(f"({T.LETTER}{{4,}})\\.([A-ZÀ-Ÿ][a-z])", "\\1. \\2")])
rule("r11_romans", T.romans, re2(T.ROMAN_RULES))
rule("r12_references", T.references, re2(T.REFERENCE_RULES[:4]) + [("\\bet(\\s+)ss($|[^.,;\\pL\\pN_])", "et\\1ss.\\2")])
rule("r13_quotes", T.quotes, [("\\b([Ii]n)([ -]?)(\\d+)\"", "\\1\\2\\3°"), ("(\\n\\n)\"(\\d)", "\\1\\2"), ("(\\n\\n)(\\d+)\" ", "\\1\\2° ")])
rule("r14_ligatures", T.ligatures, re2(T.ligature_rules()))
rule("r01_unicode", T.normalize_unicode, "nfc_normalize({x})")


def chained(df: DataFrame) -> DataFrame:
    """RP in stages of one projection each."""
    for _, f in T.CHAIN:
        df = df.withColumn("text", f(F.col("text")))
    return df


#: The chain's SQL, rule after rule; R06 without Roman numbers.
_arabic = [r for r in T.ordinal_rules() if not r.label.startswith("lone_l")]
_at = next(k for k, r in enumerate(T.ordinal_rules()) if r.label == "lone_lr")
_ordinals = re2(_arabic[:_at]) + _lone + re2(_arabic[_at:])


def _chain() -> str:
    sql = O.NOISE
    then = lambda steps: f"SELECT doc_id, before, {applied(steps)} AS text FROM ({sql})"
    for name in ("r02_apostrophes", "r03_dashes", "r04_controls", "r05_spaces"):
        sql = then(STEPS[name])
    sql = then(_ordinals)
    for name in ("r07_months", "r08_abbreviations"):
        sql = then(STEPS[name])
    sql = O.punctuation(sql)
    for name in ("r09b_comma_space", "r09c_glued_stop", "r11_romans", "r12_references", "r13_quotes", "r14_ligatures"):
        sql = then(STEPS[name])
    return O.DIGEST.format(sql)


@query("rp_chain", _chain())
def rp_chain(spark, d):
    done = chained(noisy(spark, d).withColumn("before", F.col("text")))
    return done.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), (F.col("text") != F.col("before")).alias("changed"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    done = T.spaces(T.dashes(T.apostrophes(t)))
    a, h = T.character_counts(t, T.APOSTROPHE_NAMES), T.character_counts(t, T.DASH_NAMES)
    rows = noisy(spark, d).select("lang", (done != t).cast("long").alias("changed"), a.alias("a"), h.alias("h"))
    return rows.groupBy("lang").agg(F.count("*").alias("n_documents"), F.sum("changed").alias("n_changed"), F.sum("a.curly").alias("curly"), F.sum("a.grave").alias("grave"), F.sum("h.em").alias("em"), F.sum("h.en").alias("en"))


QUERIES["flagship"] = flagship
_count = lambda p: f"len(regexp_extract_all(text, {noise.quoted(p)}))"
_spaces = f"array_to_string([trim(regexp_replace(v, ' {{2,}}', ' ', 'g'), ' ' || chr(9)) for v in string_split(translate(translate(translate(text, {noise.quoted(T.APOSTROPHES)}, ''''''''''), {noise.quoted(T.DASHES)}, '---'), {noise.quoted(T.WIDE_SPACES)}, {noise.quoted(' ' * len(T.WIDE_SPACES))}), chr(10))], chr(10))"
ORACLES["flagship"] = f"SELECT lang, count(*) AS n_documents, CAST(sum(CASE WHEN {_spaces} <> text THEN 1 ELSE 0 END) AS BIGINT) AS n_changed, CAST(sum({_count('’')}) AS BIGINT) AS curly, CAST(sum({_count('`')}) AS BIGINT) AS grave, CAST(sum({_count('—')}) AS BIGINT) AS em, CAST(sum({_count('–')}) AS BIGINT) AS en FROM ({noise.sql()}) GROUP BY lang"


def counts(name: str, make: Callable[[Column], Column], sql: dict[str, str] | None) -> None:
    QUERIES[name] = lambda spark, d: noisy(spark, d).select("doc_id", make(F.col("text")).alias("c")).select("doc_id", "c.*")
    if sql:
        ORACLES[name] = "SELECT doc_id, " + ", ".join(f"CAST({_count(p)} AS INT) AS {k}" for k, p in sql.items()) + f" FROM ({noise.sql()})"


counts("cnt2_apostrophes", lambda t: T.character_counts(t, T.APOSTROPHE_NAMES), T.APOSTROPHE_NAMES)
counts("cnt2_dashes", lambda t: T.character_counts(t, T.DASH_NAMES), T.DASH_NAMES)
counts("cnt3_controls", lambda t: T.class_counts(t, T.CONTROL_CLASSES), {k: O.re2(p) for k, p in T.CONTROL_CLASSES.items()})
counts("cnt4_spaces", lambda t: T.class_counts(t, T.SPACE_CLASSES), T.SPACE_CLASSES)
counts("cnt5_ordinals", lambda t: T.class_counts(t, T.ORDINAL_CLASSES), {k: p.replace("(?U)", "") for k, p in T.ORDINAL_CLASSES.items()})
counts("cnt7_abbreviations", T.abbreviation_counts, None)
counts("cnt8_punctuation", T.punctuation_problems, None)
counts("cnt9_references", lambda t: F.struct(*T.counted(T.REFERENCE_RULES, t)), None)
counts("cnt9_romans", lambda t: F.struct(*T.counted(T.ROMAN_RULES, t)), None)
ORACLES["cnt7_abbreviations"], ORACLES["cnt8_punctuation"] = O.abbreviation_counts(), O.problems()
ORACLES["cnt9_references"], ORACLES["cnt9_romans"] = O.counted(O.REFERENCES), O.counted(O.plain(T.ROMAN_RULES))
counts("cnt10_quotes", lambda t: F.struct(T.straight_quotes(t).alias("quotes")), {"quotes": '"'})


@query("cnt1_positional", f"SELECT doc_id, CAST({_count('[—–−]')} AS INT) AS n FROM ({noise.sql()}) WHERE {_count('[—–−]')} > 0")
def cnt1(spark, d):
    return noisy(spark, d).select("doc_id", T.positional_changes(F.col("text"), T.dashes(F.col("text"))).alias("n")).filter("n > 0")


_months = "|".join(m.capitalize() for m in T.MONTHS) + "|" + "|".join(T.MONTHS)


@query("cnt6_months", f"SELECT lower(m) AS month, m = lower(m) AS is_lower, count(*) AS n FROM (SELECT unnest(regexp_extract_all(regexp_replace(text, '[^\\pL\\pN_]+', '  ', 'g'), '(?:^| )({_months})(?: |$)', 1)) AS m FROM ({noise.sql()})) GROUP BY 1, 2")
def cnt6(spark, d):
    found = noisy(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(f"(?U)(?<!\\w)({_months})(?!\\w)"), F.lit(1))).alias("m"))
    return found.groupBy(F.lower("m").alias("month"), (F.lower("m") == F.col("m")).alias("is_lower")).agg(F.count("*").alias("n"))


@query("aud2_differences", O.differences(applied(_ordinals)))
def aud2(spark, d):
    t = F.col("text")
    return noisy(spark, d).select("doc_id", F.explode(T.token_differences(t, T.ordinals(t))).alias("v")).select("doc_id", "v.*")


@query("aud3_audit", O.audit({"apostrophes": applied(STEPS["r02_apostrophes"]), "dashes": applied(STEPS["r03_dashes"]), "ordinals": applied(_ordinals), "months": applied(STEPS["r07_months"]), "references": applied(STEPS["r12_references"])}))
def aud3(spark, d):
    t = F.col("text")
    stages = F.array(*(F.struct(F.lit(name).alias("stage"), T.audit(t, f(t), F.col("n")).alias("a")) for name, f in T.CHAIN if name in ("apostrophes", "dashes", "ordinals", "months", "references")))
    return noisy(spark, d).withColumn("n", T.paragraphs(t)).select(F.explode(stages).alias("s")).groupBy("s.stage").agg(F.sum("s.a.n_diff").alias("n_diff"), F.count_if(F.col("s.a.n_diff") > 0).alias("n_changed"), F.count_if(F.col("s.a.paragraphs_before") != F.col("s.a.paragraphs_after")).alias("n_broken"))


# Lexicon and repair
_LEX = "SELECT form FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]+')) AS form FROM documents) GROUP BY form HAVING count(*) >= 5"


@query("lex_derive", _LEX)
def lex_derive(spark, d):
    return L.derive(table(spark, d, "documents"), 5)


def lexicon(spark, d):
    """Written, as most plans ask it several times."""
    return Scratch(spark, "lexicon").save(L.derive(table(spark, d, "documents"), 5))


@query("lex1_known", f"WITH f AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-zA-ZÀ-ÿ]+')) AS word FROM documents), l AS ({_LEX}) SELECT word, (word IN (SELECT form FROM l) OR lower(word) IN (SELECT form FROM l)) AND length(word) >= 2 AND NOT (length(word) > 1 AND upper(word) = word AND lower(word) <> word) AS known FROM f")
def lex1(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(f"({T.LETTER}+)"), F.lit(1))).alias("word")).distinct()
    return L.known(words, lexicon(spark, d), "word")


@query("r10_commas", O.commas(_LEX))
def r10(spark, d):
    return L.commas(noisy(spark, d).select("doc_id", "text"), lexicon(spark, d)).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("lex3_splits", O.splits(_LEX))
def lex3(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({T.LETTER}+)"), F.lit(1))).alias("word")).distinct()
    return L.splits(words, lexicon(spark, d))


@query("lex4_apply", "SELECT doc_id, md5(array_to_string([CASE WHEN lower(v) = 'the' THEN 'THE' ELSE v END for v in regexp_extract_all(text, '\\S+|\\s+')], '')) AS digest FROM documents")
def lex4(spark, d):
    mapping = spark.createDataFrame([("the", "THE")], "old string, new string")
    return L.apply_map(table(spark, d, "documents"), mapping).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("lex5_contexts", "WITH w AS (SELECT doc_id, unnest(v) AS word, generate_subscripts(v, 1) - 1 AS pos FROM (SELECT doc_id, regexp_extract_all(text, '\\S+') AS v FROM documents)) SELECT doc_id, CAST(pos AS INT) AS pos, word, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS context FROM w")
def lex5(spark, d):
    return L.contexts(table(spark, d, "documents"))


@query("unk7_unknown_forms", O.unknown_forms(_LEX))
def unk7(spark, d):
    return L.unknown_forms(table(spark, d, "documents"), lexicon(spark, d))


@query("unk8_export", f"SELECT * FROM ({O.unknown_forms(_LEX)}) ORDER BY n DESC, first_doc, first_pos LIMIT 1000")
def unk8(spark, d):
    return L.unknown_forms(table(spark, d, "documents"), lexicon(spark, d)).orderBy(F.desc("n"), "first_doc", "first_pos").limit(1000)


@query("lev4_hapaxes", O.hapaxes(_LEX))
def lev4(spark, d):
    return L.hapaxes(table(spark, d, "documents"), lexicon(spark, d))


# SQL has no optimal string alignment (DuckDB's distance counts bytes and lets edits cross); tests hold this against brute force.
@query("lev3_nearest")
def lev3(spark, d):
    lex = lexicon(spark, d)
    return L.nearest(L.hapaxes(table(spark, d, "documents"), lex), lex)


@query("lev7_wilson", "SELECT CAST(k AS INT) AS k, round(greatest(0, c - h), 9) AS low, round(least(1, c + h), 9) AS high FROM (SELECT k, (p + z / (2 * n)) / (1 + z / n) AS c, 1.96 * sqrt(p * (1 - p) / n + z / (4 * n * n)) / (1 + z / n) AS h FROM (SELECT k, CAST(k AS DOUBLE) / 200.0::DOUBLE AS p, 200.0::DOUBLE AS n, (1.96 * 1.96)::DOUBLE AS z FROM (SELECT unnest([0, 1, 2, 3, 5, 8, 10, 15, 20]) AS k)))")
def lev7(spark, d):
    w = L.wilson(spark, 200)
    return w.select("k", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


# Structuring, on a volume made from the documents: a separator, a header, the text; and a table of contents.
def volume(spark, d):
    t = F.coalesce(F.col("text"), F.lit(""))
    page = lambda k, name: F.concat(F.lit("-" * 24 + "\n" + str(k) + f" {name}.\n"), t, F.lit("\n"))
    contents = F.lit("-" * 24 + "\n\nTABLE DES MATIÈRES.\nPages.\nPremière Partie.\n1\nI. — Statuts et règlements ..... 1\nA. — Membres (liste) ....... 3\nNotice sur la\nvie de Bluntschli ..... 4\nJanvier 1874 ... 12\n")
    return table(spark, d, "documents").select("doc_id", F.concat(page(1, "STATUTS"), page(3, "MEMBRES"), page(4, "NOTICES"), contents).alias("text"))


@query("str2_pages", f"SELECT * EXCLUDE raw_text, md5(raw_text) AS digest FROM ({O.pages()})")
def str2(spark, d):
    return X.pages(volume(spark, d)).select("doc_id", "num", "line_start", "line_end", "section_hint", F.md5(F.col("raw_text").cast("binary")).alias("digest"))


@query("str3_toc", "SELECT doc_id, n, title, page, level FROM documents, (VALUES (0, 'Première Partie', 1, 1), (1, 'I. — Statuts et règlements', 1, 2), (2, 'A. — Membres (liste)', 3, 3), (3, 'Notice sur la vie de Bluntschli', 4, 2), (4, 'Janvier 1874', 12, 3)) v(n, title, page, level)")
def str3(spark, d):
    return X.toc(volume(spark, d))


@query("str5_sections", f"SELECT * REPLACE (coalesce(page_end, -1) AS page_end) FROM ({O.sections()})")
def str5(spark, d):
    v = volume(spark, d)
    return X.sections(X.pages(v), X.toc(v)).withColumns({"raw_text": F.md5(F.col("raw_text").cast("binary")), "page_end": F.coalesce("page_end", F.lit(-1))})


@query("str6_islands", "WITH m AS (SELECT conv_id, turn, role, lag(role) OVER w AS p, lag(turn) OVER w AS q FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), s AS (SELECT *, sum(CASE WHEN q IS NOT NULL AND p IS NOT DISTINCT FROM role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM m) SELECT conv_id, CAST(island AS BIGINT) AS island, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM s GROUP BY ALL")
def str6(spark, d):
    return X.islands(table(spark, d, "conversations"), "conv_id", "turn", "role")


@query("str7_word_count", "SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INT) AS n FROM documents")
def str7(spark, d):
    return table(spark, d, "documents").select("doc_id", T.token_count(F.col("text")).alias("n"))


@query("toc1_start", O.toc_start())
def toc1(spark, d):
    return X.toc_start(volume(spark, d))


@query("toc4_clean", O.clean_toc())
def toc4(spark, d):
    return X.clean_toc(volume(spark, d))


@query("toc6_pages", "SELECT doc_id, 'Titre ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 500 + 1 AS INT) ELSE -14 END AS page FROM documents")
def toc6(spark, d):
    line = F.concat(F.lit("Titre "), F.col("doc_id").cast("string"), F.lit(" ..... "), F.when(F.col("doc_id") % 2 == 0, (F.col("doc_id") % 500 + 1).cast("string")).otherwise("xiv"))
    return table(spark, d, "documents").select("doc_id", X.page_of(line).alias("p")).select("doc_id", "p.*")


@query("toc7_classify", f"SELECT {O.classify('t')} AS level, count(*) AS n FROM (SELECT trim(line, ' ') AS t FROM ({O.lines('SELECT doc_id, text FROM documents WHERE text IS NOT NULL')})) GROUP BY 1")
def toc7(spark, d):
    lines = X.lines(table(spark, d, "documents"))
    return lines.select(X.classify(F.trim("line")).alias("level")).groupBy("level").agg(F.count("*").alias("n"))


@query("toc8_anomalies", O.anomalies())
def toc8(spark, d):
    lines = X.lines(table(spark, d, "documents")).select("doc_id", F.col("pos").alias("n"), X.page_of(F.col("line")).alias("p"))
    return X.anomalies(lines.select("doc_id", "n", "p.*").withColumn("level", X.classify(F.col("title"))))


@query("toc9_report", f"SELECT level, count(*) AS n, count(*) FILTER (page < 0) AS n_roman, count(*) FILTER (page IS NULL) AS n_missing FROM ({O.entries()}) GROUP BY level")
def toc9(spark, d):
    lines = X.lines(table(spark, d, "documents")).select("doc_id", F.col("pos").alias("n"), X.page_of(F.col("line")).alias("p"))
    return X.toc_report(lines.select("doc_id", "n", "p.*").withColumn("level", X.classify(F.col("title"))))


# Entities
@query("ent1_tokens", O.CAPITALS)
def ent1(spark, d):
    return E.capital_tokens(table(spark, d, "documents")).select("token", "n")


@query("ent3_clusters")
def ent3(spark, d):
    return E.clusters(E.capital_tokens(table(spark, d, "documents")))


@query("ent6_candidates")
def ent6(spark, d):
    return E.candidates(E.clusters(E.capital_tokens(table(spark, d, "documents"))))


@query("ent8_corrections", f"SELECT doc_id, CAST({_count('(?:^|[^a-zA-ZÀ-ÿ0-9_])Belgique')} AS INT) AS n_substitutions, md5(regexp_replace(text, '(^|[^a-zA-ZÀ-ÿ0-9_])Belgique', '\\1Royaume', 'g')) AS digest FROM ({noise.sql()})")
def ent8(spark, d):
    return E.apply_corrections(noisy(spark, d), [("Belgique", "Royaume")]).select("doc_id", "n_substitutions", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("ent9_section_type", O.section_types())
def ent9(spark, d):
    return X.toc(volume(spark, d)).select(E.section_type(F.col("title")).alias("section_type")).groupBy("section_type").agg(F.count("*").alias("n"))


@query("ent10_selection", "SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\\S+')) >= 10 AND doc_id NOT IN (SELECT doc_id FROM labels)")
def ent10(spark, d):
    s = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("section_id"), F.lit(1).alias("level"), T.token_count(F.col("text")).alias("word_count"))
    return E.to_process(s, table(spark, d, "labels").withColumnRenamed("doc_id", "section_id"), (1,)).select("doc_id")


def responses(spark, d):
    e = lambda label, end: F.concat(F.lit('{"surface":"a","canonical":"A","label":"' + label + '","start_char":0,"end_char":'), F.lit(end), F.lit(',"confidence":1.5}'))
    good = F.concat(F.lit('noise {"section_type":"rapport","entities":['), e("PERSON", "3"), F.lit(","), e("NONE", "3"), F.lit(","), e("ORG", "9999"), F.lit('],"positions":[{"acteur":"x","type":"soutien","objet":"o","texte_source":"t"},{"acteur":" ","type":"soutien"}]} tail'))
    return table(spark, d, "documents").select(F.col("doc_id").alias("section_id"), F.when(F.col("doc_id") % 5 == 0, "not json").otherwise(good).alias("raw"))


@query("ent13_entities", "SELECT doc_id AS section_id, k, label, CAST(1 AS DOUBLE) AS confidence, reason FROM documents, (VALUES (0, 'PERSON', NULL), (1, 'NONE', 'unknown label'), (2, 'ORG', 'offsets out of range')) v(k, label, reason) WHERE doc_id % 5 <> 0")
def ent13(spark, d):
    p = E.parsed(responses(spark, d))
    n = table(spark, d, "documents").select(F.col("doc_id").alias("section_id"), F.lit(100).alias("n"))
    return E.entities(p, n).select("section_id", "k", "label", "confidence", "reason")


@query("ent14_positions", "SELECT doc_id AS section_id, k, reason FROM documents, (VALUES (0, NULL), (1, 'no actor')) v(k, reason) WHERE doc_id % 5 <> 0")
def ent14(spark, d):
    return E.positions(E.parsed(responses(spark, d))).select("section_id", "k", "reason")


@query("ent15_parsed", "SELECT doc_id AS section_id, CASE WHEN doc_id % 5 = 0 THEN 'autre' ELSE 'rapport' END AS section_type, CASE WHEN doc_id % 5 = 0 THEN 'invalid JSON' END AS error FROM documents")
def ent15(spark, d):
    return E.parsed(responses(spark, d)).select("section_id", "section_type", "error")


@query("ent17_upsert", "SELECT o_orderkey AS section_id, CASE WHEN o_orderkey % 7 = 0 THEN 'new' ELSE 'old' END AS state FROM orders")
def ent17(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("section_id"))
    return E.upsert(o.withColumn("state", F.lit("old")), o.filter("section_id % 7 = 0").withColumn("state", F.lit("new")))


@query("ent18_update", "SELECT o_orderkey AS section_id, CASE WHEN o_orderkey % 3 = 0 THEN 'rapport' ELSE o_orderpriority END AS section_type FROM orders")
def ent18(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("section_id"), F.col("o_orderpriority").alias("section_type"))
    return E.update_types(o, o.filter("section_id % 3 = 0").withColumn("section_type", F.lit("rapport")))


@query("ent19_report", "SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def ent19(spark, d):
    return E.report(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


# Tables
def rounded(df: DataFrame, k: int = 6) -> DataFrame:
    return df.select(*(F.round(c, k).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


_NUM = ("l_quantity", "l_extendedprice", "l_discount")
_desc = " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max FROM lineitem" for c in _NUM)


@query("agg5_describe", _desc)
def agg5(spark, d):
    x = S.describe(table(spark, d, "lineitem"), list(_NUM))
    return x.select("name", "count", *(F.round(c, 4).alias(c) for c in ("mean", "std")), "min", *(F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")), "max")


@query("agg6_describe_objects", " UNION ALL ".join(f"(SELECT '{c}' AS name, CAST(sum(n) OVER () AS BIGINT) AS count, count(*) OVER () AS \"unique\", {c} AS top, n AS freq FROM (SELECT {c}, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, {c} LIMIT 1)" for c in ("p_brand", "p_type")))
def agg6(spark, d):
    return S.describe_objects(table(spark, d, "part"), ["p_brand", "p_type"])


@query("agg1_sums", "SELECT c_nationkey, round(sum(c_acctbal), 4) AS c_acctbal FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1")
def agg1(spark, d):
    return rounded(S.sums_by(table(spark, d, "customer"), "c_nationkey", ["c_acctbal"]), 4)


@query("agg3_total", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def agg3(spark, d):
    return table(spark, d, "orders").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("agg4_nulls", "SELECT " + ", ".join(f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")) + " FROM documents")
def agg4(spark, d):
    return S.null_counts(table(spark, d, "documents"))


_cells = "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2"


@query("agg8_shares", f"SELECT l_returnflag, l_linestatus, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS row_share, round(n / sum(n) OVER (PARTITION BY l_linestatus), 6) AS column_share, round(n / sum(n) OVER (), 6) AS total_share FROM ({_cells})")
def agg8(spark, d):
    return rounded(S.contingency(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus"))


@query("agg7_crosstab", "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS \"F\", count(*) FILTER (l_linestatus = 'O') AS \"O\" FROM lineitem GROUP BY 1")
def agg7(spark, d):
    return S.crosstab(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("agg7_margins", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def agg7m(spark, d):
    return S.margins(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("agg10_missing", "SELECT 'lang' AS name, round(avg(CASE WHEN lang = 'fr' THEN 1.0 ELSE 0.0 END), 6) AS share FROM documents")
def agg10(spark, d):
    return rounded(S.missing_share(table(spark, d, "documents"), ["lang"], "fr"))


@query("agg11_frequencies", "SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]{3,}')) AS w FROM benchmark) GROUP BY 1")
def agg11(spark, d):
    return table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({T.LETTER}{{3,}})"), F.lit(1))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


_pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _NUM for b in _NUM)


@query("sta1_pearson", _pairs)
def sta1(spark, d):
    return rounded(S.pearson(table(spark, d, "lineitem"), list(_NUM)))


@query("sta2_spearman", "WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem) SELECT count(*) AS n, round(corr(a, b), 6) AS rho FROM r")
def sta2(spark, d):
    return rounded(S.spearman(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select("n", "rho"))


_chi = "WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*)::DOUBLE AS o FROM orders GROUP BY 1, 2), g AS (SELECT c.*, ra.t AS ra, rb.t AS rb, (SELECT sum(o) FROM c) AS n FROM c JOIN (SELECT a, sum(o) AS t FROM c GROUP BY 1) ra USING (a) JOIN (SELECT b, sum(o) AS t FROM c GROUP BY 1) rb USING (b)), s AS (SELECT max(n) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k, sum(o * o / (ra * rb / n)) - max(n) AS chi2 FROM g)"


@query("sta4_chi_square", _chi + " SELECT CAST(n AS BIGINT) AS n, r, k, round(chi2, 6) AS chi2, (r - 1) * (k - 1) AS dof, round(sqrt(greatest(0, chi2 / n - (r - 1) * (k - 1) / (n - 1)) / least(k - (k - 1) ** 2 / (n - 1) - 1, r - (r - 1) ** 2 / (n - 1) - 1)), 6) AS cramer FROM s")
def sta4(spark, d):
    return rounded(S.chi_square(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority").select("n", "r", "k", "chi2", "dof", "cramer"))


@query("sta8_cramer_matrix", O.cramer_matrix("orders", ["o_orderstatus", "o_orderpriority"]))
def sta8(spark, d):
    return rounded(S.cramer_matrix(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"]))


@query("sta9_histogram", "SELECT CAST(least(10, floor((o_totalprice - lo) * 10 / (hi - lo)) + 1) AS INT) AS bin, count(*) AS n FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1")
def sta9(spark, d):
    return S.histogram(table(spark, d, "orders"), "o_totalprice")


@query("sta10_box", "WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders) SELECT round(q1, 4) AS q1, round(q2, 4) AS q2, round(q3, 4) AS q3, min(CASE WHEN o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN o_totalprice END) AS low, max(CASE WHEN o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN o_totalprice END) AS high, count(*) FILTER (NOT o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers FROM orders, q GROUP BY 1, 2, 3")
def sta10(spark, d):
    return rounded(S.box(table(spark, d, "orders"), "o_totalprice"), 4)


@query("sta11_density", O.density("customer", "c_acctbal"))
def sta11(spark, d):
    return rounded(S.density(table(spark, d, "customer"), "c_acctbal"), 9)


@query("sta12_lowess", O.lowess("part", "p_size", "p_retailprice", "p_brand"))
def sta12(spark, d):
    return rounded(S.lowess(table(spark, d, "part"), "p_size", "p_retailprice", "p_brand"), 4)


@query("mlx1_labels", "SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INT) AS code FROM customer")
def mlx1(spark, d):
    return S.label_encode(table(spark, d, "customer"), "c_mktsegment").select("c_custkey", F.col("c_mktsegment_code").alias("code"))


@query("mlx2_split", O.split("customer", "c_custkey"))
def mlx2(spark, d):
    return S.split(table(spark, d, "customer").select("c_custkey"), "c_custkey")


@query("mlx3_tree")
def mlx3(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"), T.token_count(F.coalesce("text", F.lit(""))).alias("w"), F.regexp_count("text", F.lit("[|#$%&]")).alias("s"))
    _, accuracy = S.decision_tree(docs.join(table(spark, d, "labels"), "doc_id").dropna(), ["n", "w", "s"], "quality", "doc_id")
    return spark.createDataFrame([(round(accuracy, 6),)], "accuracy double")


@query("prj4_ratio", "SELECT p_partkey, round(p_retailprice / p_size, 6) AS ratio FROM part WHERE p_brand = (SELECT min(p_brand) FROM part) AND p_size <> 0")
def prj4(spark, d):
    p = table(spark, d, "part")
    first = p.agg(F.min("p_brand").alias("p_brand"))
    return p.join(F.broadcast(first), "p_brand").filter("p_size <> 0").select("p_partkey", F.round(F.col("p_retailprice") / F.col("p_size"), 6).alias("ratio"))


@query("prj8_split_recode", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS head, CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS flag, year(o_orderdate) AS year FROM orders")
def prj8(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("head"), F.when(F.col("o_orderstatus").isin("F", "P"), 1).otherwise(0).alias("flag"), F.year("o_orderdate").cast("long").alias("year"))


@query("prj9_integral", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(l_quantity AS VARCHAR) END AS q FROM lineitem")
def prj9(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.integral_text(F.col("l_quantity")).alias("q"))


@query("prj12_log", "SELECT l_orderkey, l_linenumber, round(ln(coalesce(nullif(l_discount, 0), (SELECT min(l_discount) FROM lineitem WHERE l_discount > 0))), 6) AS x FROM lineitem")
def prj12(spark, d):
    return S.log_filled(table(spark, d, "lineitem"), "l_discount", "x").select("l_orderkey", "l_linenumber", F.round("x", 6).alias("x"))


@query("prj13_fill", "SELECT doc_id, coalesce(lang, 'manque') AS lang, coalesce(quality, 0) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def prj13(spark, d):
    return S.fill_by_type(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "lang", "quality"))


@query("join_left", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def join_left(spark, d):
    n = table(spark, d, "nation")
    c = table(spark, d, "customer")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("c_custkey", "n_name")


@query("win_running_max", "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM events")
def win_running_max(spark, d):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, d, "events").select("event_id", F.max("value").over(w).alias("top"))


@query("nst1_nested", "SELECT event_id, key FROM (SELECT event_id, unnest(json_keys(props)) AS key FROM events WHERE json_valid(props))")
def nst1(spark, d):
    return table(spark, d, "events").select("event_id", F.explode(F.json_object_keys("props")).alias("key"))


# Details, summaries, gates
@query("aud1_details", O.details("Vi[lt]|VIL|[MD]r? "))
def aud1(spark, d):
    return noisy(spark, d).select("doc_id", F.explode(T.details(F.col("text"), "Vi[lt]|VIL|[MD]r? ")).alias("m")).select("doc_id", "m.*")


@query("aud4_summary", f"SELECT count(*) AS n_stages, count(*) FILTER (n_changed > 0) AS n_stages_changed, CAST(sum(n_diff) AS BIGINT) AS n_diff, CAST(sum(n_broken) AS BIGINT) AS n_broken FROM ({ORACLES['aud3_audit']})")
def aud4(spark, d):
    return aud3(spark, d).agg(F.count("*").alias("n_stages"), F.count_if(F.col("n_changed") > 0).alias("n_stages_changed"), F.sum("n_diff").alias("n_diff"), F.sum("n_broken").alias("n_broken"))


_fr = ", ".join(f"'{w}'" for w in L.FUNCTION_WORDS)


@query("unk6_language", f"SELECT doc_id, len(w) > 0 AND len([x for x in w if x IN ({_fr})]) >= len(w) * 0.1 AS in_language FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{T.LETTER}+') AS w FROM documents)")
def unk6(spark, d):
    return L.of_language(table(spark, d, "documents"), L.FUNCTION_WORDS).select("doc_id", "in_language")


_verdict = "CASE length(word) % 4 WHEN 0 THEN 'refuse' WHEN 1 THEN 'correct' WHEN 2 THEN 'accept' END"


@query("lex4_proposals", f"SELECT word AS old, CASE WHEN v = 'correct' THEN reverse(word) ELSE first || ' ' || rest END AS new FROM (SELECT *, {_verdict} AS v FROM ({ORACLES['lex3_splits']})) WHERE place = 1 AND (v IS NULL OR v <> 'refuse')")
def lex4_proposals(spark, d):
    found = Scratch(spark, "splits").save(lex3(spark, d))
    decided = found.filter("place = 1").select("word", F.expr(_verdict).alias("verdict"), F.reverse("word").alias("result")).filter("verdict IS NOT NULL")
    return L.proposals(found, decided)


@query("lev6_gate")
def lev6(spark, d):
    return L.gated(lev3(spark, d)).groupBy("regime").agg(F.count("*").alias("n"))


@query("nst1_blocks", "SELECT 'd' || doc_id AS publication_date, 'T' AS publication_title, 'p' || page AS page_id, texte FROM (SELECT doc_id, page, unnest(string_split(text, chr(10))) AS texte FROM documents, (VALUES (1), (2)) v(page) WHERE doc_id % 3 <> 0) WHERE contains(lower(texte), 'the')")
def nst1_blocks(spark, d):
    blocks = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text")))
    page = lambda k: F.struct(F.lit(f"p{k}").alias("id"), F.when(F.col("doc_id") % 3 != 0, blocks).alias("blocks"))
    one = F.struct(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("publication_date"), F.lit("T").alias("publication_title"), F.array(page(1), page(2)).alias("pages"))
    return press_blocks(table(spark, d, "documents").select(F.array(one).alias("documents")), "the")


_two = "SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS a, count(*) FILTER (quality = 1 AND toxic = 0) AS b, count(*) FILTER (quality = 0 AND toxic = 1) AS c, count(*) FILTER (quality = 0 AND toxic = 0) AS d FROM labels"
_log = lambda n, k: f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1))"


@query("sta5_fisher", f"WITH t AS ({_two}), m AS (SELECT *, a + b + c + d AS n, a + b AS r, a + c AS k FROM t), x AS (SELECT *, exp({_log('k', 'x')} + {_log('(n - k)', '(r - x)')} - {_log('n', 'r')}) AS p FROM (SELECT *, unnest(range(greatest(0, r - (n - k)), least(r, k) + 1)) AS x FROM m)) SELECT round(max(a) * max(d) / (max(b) * max(c))::DOUBLE, 6) AS odds, round(least(1, sum(p) FILTER (p <= (SELECT p FROM x WHERE x.x = x.a) * (1 + 1e-7))), 6) AS p FROM x")
def sta5(spark, d):
    q = lambda x, y: F.count_if((F.col("quality") == x) & (F.col("toxic") == y))
    odds, p = S.fisher_exact(*table(spark, d, "labels").agg(q(1, 1), q(1, 0), q(0, 1), q(0, 0)).first())
    return spark.createDataFrame([(round(odds, 6), round(p, 6))], "odds double, p double")


@query("sta7_yates", "WITH c AS (SELECT quality, toxic, count(*)::DOUBLE AS o FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY ALL), g AS (SELECT o, sum(o) OVER (PARTITION BY quality) * sum(o) OVER (PARTITION BY toxic) / sum(o) OVER () AS e FROM c) SELECT round(sum((abs(o - e) - least(0.5, abs(o - e))) ** 2 / e), 6) AS chi2_yates, round(sum(o * o / e) - sum(o), 6) AS chi2 FROM g")
def sta7(spark, d):
    return rounded(S.chi_square(table(spark, d, "labels"), "quality", "toxic").select("chi2_yates", "chi2"))


_ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r_{c}" for c in _NUM)


@query("sta2_matrix", f"WITH r AS MATERIALIZED (SELECT {_ranks} FROM lineitem) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(r_{a}, r_{b}), 6) AS rho FROM r" for a in _NUM for b in _NUM))
def sta2_matrix(spark, d):
    return rounded(S.spearman_matrix(table(spark, d, "lineitem"), list(_NUM)).select("a", "b", "rho"))


@query("sta3_significance")
def sta3(spark, d):
    return rounded(S.spearman_matrix(table(spark, d, "part"), ["p_size", "p_retailprice"]), 9)


# Projections
@query("prj1_subset", "SELECT doc_id, lang FROM documents")
def prj1(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang")


@query("prj2_drop", "SELECT * EXCLUDE (text, source) FROM documents")
def prj2(spark, d):
    return table(spark, d, "documents").drop("text", "source", "not_there")


@query("prj3_nonzero", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_discount + l_tax <> 0) IS NOT FALSE")
def prj3(spark, d):
    return table(spark, d, "lineitem").filter(F.coalesce(F.col("l_discount") + F.col("l_tax") != 0, F.lit(True))).select("l_orderkey", "l_linenumber")


@query("prj5_given", "SELECT doc_id FROM documents WHERE source IS NOT NULL AND source <> 'src0'")
def prj5(spark, d):
    return table(spark, d, "documents").filter("source IS NOT NULL AND source <> 'src0'").select("doc_id")


@query("prj11_concat", "SELECT c_custkey, c_name || ' ' || c_mktsegment AS label FROM customer")
def prj11(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" "), "c_mktsegment").alias("label"))


@query("prj14_schema", "SELECT * FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'), ('source', 'string'), ('n_chars', 'bigint')) v(name, type)")
def prj14(spark, d):
    return spark.createDataFrame(table(spark, d, "documents").dtypes, "name string, type string")


@query("prj15_format", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS total FROM orders")
def prj15(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("total"))
