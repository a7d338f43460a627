"""Entity curation: variant clusters, validated corrections, model responses, upserts."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import Scratch, map_rows

STOP = "Le La Les Un Une Des Du De Au Aux En Par Pour Sur Avec Dans Que Qui Ce Il Elle Ils Elles Nous Vous Leur Leurs Institut Article Seance Session Rapport Commission Projet Comite Membre Membres Monsieur Messieurs Madame".split()
CAPITALISED = "(?U)\\b([A-ZÀÂÄÉÈÊËÎÏÔÖÙÛÜŸÆŒ][a-zA-ZÀ-ÿ-]{3,})\\b"
LABELS = ("PERSON", "ORG", "LIEU", "DATE", "ACTE", "EVENT", "CONCEPT")
POSITIONS = ("soutien", "opposition", "proposition", "reserve", "abstention", "autre")
SECTION_TYPES = {
    "seance_pleniere": "s[eé]ance|proc[eè]s.verbal|session.*plen|plen.*session|r[eé]union|assembl[eé]e",
    "notice_biographique": "notice|biograph|n[eé]crolog|membre.*d[eé]c[eè]d[eé]|in memoriam",
    "texte_traite": "convention|trait[eé]|d[eé]claration|protocole|(?:r[eè]glement|texte).*adopt[eé]",
    "tableau_chronologique": "tableau|liste.*membre|membre.*liste|chronolog",
    "bibliographie": "bibliograph|publications?|ouvrages?|travaux.*publi[eé]s",
    "statuts": "statuts?|r[eè]glement int[eé]rieur|r[eè]gles de proc[eé]dure",
    "rapport": "rapport|expos[eé] des motifs",
}
RESPONSE = "section_type STRING, entities ARRAY<STRUCT<surface:STRING,canonical:STRING,label:STRING,start_char:STRING,end_char:STRING,confidence:STRING,acte_type:STRING>>, positions ARRAY<STRUCT<acteur:STRING,type:STRING,objet:STRING,texte_source:STRING>>"


def capital_tokens(df: DataFrame) -> DataFrame:
    """ENT1: (token, n, first) of capitalised tokens of four letters or more."""
    found = df.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(CAPITALISED), F.lit(1))).alias("pos", "token"))
    return found.filter(~F.col("token").isin(STOP)).groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first"))


def bare(s: str) -> str:
    """ENT2"""
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).lower()


def ratio(a: str, b: str) -> float:
    """ENT4: 200 * longest common subsequence / total length, by Hyyrö's bit-parallel recurrence."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & masks.get(c, 0)
        s = (s + u | s - u) & full
    return 200.0 * (len(a) - s.bit_count()) / (len(a) + len(b))


#: Pairs of bare tokens of up to this length meet at a common subsequence, longer ones at a common segment.
SHORT = 16


def overlap(m: int, n: int, least: float) -> int:
    """The shortest common subsequence with which two strings of these lengths reach the least ratio."""
    common = max(0, math.ceil(least * (m + n) / 200.0) - 1)
    while 200.0 * common / (m + n) < least:
        common += 1
    return common


def meeting_keys(s: str, lengths: list[int], least: float) -> Iterator[tuple[str, int]]:
    """(key, side) such that two strings reach the least ratio only if a key of one on side 0 is one of the other's on side 1 (side 2 meets
    itself: equal lengths within SHORT). Within SHORT the key is a common subsequence of the needed length, which proves the ratio. Beyond,
    the longer string is cut into one segment more than there may be insertions and deletions, so that one segment is left whole."""
    for other in lengths:
        m, n = sorted((len(s), other))
        common = overlap(m, n, least)
        if common > m:
            continue
        side = 2 if m == n else int(len(s) == n)
        if n <= SHORT:
            for sub in {"".join(c) for c in combinations(s, common)}:
                yield f"{m} {n} -1 {sub}", side
            continue
        edits = m + n - 2 * common
        if edits >= n:  # no whole segment is sure
            yield f"{m} {n} -2 ", side
            continue
        cuts = [n * k // (edits + 1) for k in range(edits + 2)]
        for k in range(edits + 1):
            start, size = cuts[k], cuts[k + 1] - cuts[k]
            shifts = (e for e in range(-edits, edits + 1) if abs(e) + abs(m - n - e) <= edits)
            if len(s) == n:
                yield f"{m} {n} {k} {s[start : start + size]}", 1
            if len(s) == m:
                seen = {s[start + e : start + e + size] for e in shifts if 0 <= start + e <= m - size}
                yield from ((f"{m} {n} {k} {sub}", 0) for sub in seen)


def near_pairs(bare_tokens: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(ra, rb), ra < rb, of all (rank, bare) rows whose ratio reaches the least."""
    lengths = sorted(r[0] for r in bare_tokens.select(F.length("bare")).distinct().collect())

    def make():
        return lambda rank, s: [(key, side, rank, s if int(key.split(" ", 3)[2]) != -1 else None) for key, side in meeting_keys(s, lengths, least)]

    schema = pa.schema([("key", pa.string()), ("side", pa.int32()), ("rank", pa.int64()), ("bare", pa.string())])
    keyed = scratch.save(map_rows(bare_tokens, ["rank", "bare"], schema, "key string, side int, rank long, bare string", make))
    a, b = keyed.filter("side IN (0, 2)").alias("a"), keyed.filter("side IN (1, 2)").alias("b")
    met = a.join(b, F.col("a.key") == F.col("b.key")).filter("a.rank <> b.rank AND (a.side <> 2 OR a.rank < b.rank)")
    met = met.select(F.least("a.rank", "b.rank").alias("ra"), F.greatest("a.rank", "b.rank").alias("rb"), F.col("a.bare").alias("x"), F.col("b.bare").alias("y"))

    @F.pandas_udf("double")
    def score(x, y):
        return pd.Series([ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    proved = met.filter("x IS NULL").select("ra", "rb")
    scored = met.filter("x IS NOT NULL").dropDuplicates(["ra", "rb"]).filter(score("x", "y") >= least).select("ra", "rb")
    return scratch.save(proved.union(scored).distinct())


def greedy(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(rank, pivot_rank): each token, by rising rank, joins its first pivot or becomes one. A token without an undecided one before it
    is a pivot and takes its neighbours out; a round does so for all such tokens at once, which gives the sequential result."""
    left, gone = edges, []
    while not left.isEmpty():
        pivots = left.select("ra").distinct().join(left.select(F.col("rb").alias("ra")), "ra", "left_anti")
        gone.append(scratch.save(left.join(pivots, "ra", "left_semi").select(F.col("rb").alias("ra")).distinct()))
        left = left.join(gone[-1], "ra", "left_anti").join(gone[-1].withColumnRenamed("ra", "rb"), "rb", "left_anti")
        left = scratch.save(left.select("ra", "rb"))
    taken = reduce(DataFrame.union, gone, edges.select("ra").limit(0))
    # whoever was never taken is a pivot, even if all its edges went before its turn
    return edges.join(taken, "ra", "left_anti").groupBy(F.col("rb").alias("rank")).agg(F.min("ra").alias("pivot_rank"))


def ranked(toks: DataFrame, scratch: Scratch) -> DataFrame:
    """toks with `rank` from 1 by falling n, then first, then token; sorted by ranges, not in one partition."""
    order = [F.desc("n"), F.col("first"), F.col("token")]
    parts = int(toks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = scratch.save(toks.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part, offset, offsets = F.shiftright("at", 33), 0, {}
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets[r[0]] = offset
        offset += r[1]
    before = F.create_map(*(F.lit(x).cast("long") for kv in offsets.items() for x in kv))[part] if offsets else F.lit(0)
    return placed.withColumn("rank", before + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("at")


def clusters(found: DataFrame, least: float = 85.0) -> DataFrame:
    """ENT3: (cluster, pivot, token, score, n). Tokens join, by falling frequency, the first cluster whose pivot is near enough. Tokens
    with the same bare form share the lot of the first of them, so near pairs are looked for among distinct bare forms."""
    scratch = Scratch(found.sparkSession, "clusters")

    @F.pandas_udf("string")
    def plain(s):
        return s.map(bare)

    @F.pandas_udf("double")
    def score(x, y):
        return pd.Series([ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    toks = scratch.save(ranked(found.withColumn("bare", plain("token")), scratch))
    forms = scratch.save(toks.groupBy("bare").agg(F.min("rank").alias("rank")))
    homes = scratch.save(greedy(near_pairs(forms, least, scratch), scratch))
    lot = forms.join(homes, "rank", "left").select("bare", F.coalesce("pivot_rank", "rank").alias("pivot_rank"))
    members = toks.join(lot, "bare")
    several = members.groupBy("pivot_rank").count().filter("count > 1").select("pivot_rank")
    heads = toks.select(F.col("rank").alias("pivot_rank"), F.col("token").alias("pivot"), F.col("bare").alias("pivot_bare"))
    named = members.join(several, "pivot_rank").join(heads, "pivot_rank")
    return named.select(F.col("pivot_rank").cast("int").alias("cluster"), "pivot", "token", score("bare", "pivot_bare").alias("score"), "n")


def batches(rows: DataFrame, order: str, size: int = 40) -> DataFrame:
    """ENT5: batch numbers for an injected validator."""
    return rows.withColumn("batch", F.floor((F.row_number().over(W.orderBy(order)) - 1) / size).cast("int"))


def candidates(c: DataFrame) -> DataFrame:
    """ENT6: the validation table, one line for each cluster, lowest score first."""
    others = F.array_sort(F.collect_list(F.when(F.col("token") != F.col("pivot"), F.col("token"))))
    g = c.groupBy("cluster", "pivot").agg(F.min("score").alias("score_min"), F.sum("n").alias("nb_occurrences"), others.alias("v"))
    ids = F.format_string("c%04d", F.row_number().over(W.orderBy("score_min", "cluster")) - 1)
    return g.select(F.when(F.col("score_min") >= 95, "OK").otherwise("").alias("decision"), F.col("pivot").alias("forme_retenue"), F.array_join("v", " | ").alias("variantes"), "score_min", "nb_occurrences", ids.alias("cluster_id"))


def validated(rows: DataFrame) -> DataFrame:
    """ENT7: (cluster_id, variante, forme_retenue, problem) of lines marked OK; problem names what makes a line invalid."""
    ok = rows.filter(F.upper(F.trim("decision")) == "OK")
    problem = F.when(F.coalesce(F.trim("forme_retenue"), F.lit("")) == "", "no form").when(F.coalesce(F.trim("variantes"), F.lit("")) == "", "no variants")
    parts = F.explode_outer(F.filter(F.transform(F.split("variantes", "\\|"), F.trim), lambda v: v != ""))
    return ok.select("cluster_id", parts.alias("variante"), "forme_retenue", problem.alias("problem"))


def apply_corrections(df: DataFrame, rules: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """ENT8: whole-word replacements, longest variant first; `n_substitutions` counts them in that order."""
    out, counts = F.col(text), F.lit(0)
    for variant, form in sorted((r for r in rules if r[0] != r[1]), key=lambda r: -len(r[0])):
        pattern = f"(?U)(?<!\\w)\\Q{variant}\\E(?!\\w)"
        counts = counts + F.regexp_count(out, F.lit(pattern))
        out = F.regexp_replace(out, pattern, re.sub(r"([\\$])", r"\\\1", form))
    return df.withColumns({"n_substitutions": counts, text: out})


def section_type(title: Column) -> Column:
    """ENT9"""
    out, low = None, F.lower(title)
    for kind, pattern in SECTION_TYPES.items():
        out = F.when(low.rlike(pattern), kind) if out is None else out.when(low.rlike(pattern), kind)
    return out


def to_process(sections: DataFrame, done: DataFrame, levels: tuple[int, ...], least_words: int = 10, overwrite: bool = False, only: list[str] | None = None) -> DataFrame:
    """ENT10"""
    out = sections.filter(F.col("level").isin(list(levels)) & (F.col("word_count") >= least_words))
    if only:
        out = out.filter(F.col("section_id").isin(only))
    return out if overwrite else out.join(done.select("section_id"), "section_id", "left_anti")


def prompt(template: str, values: dict[str, Column], text: Column, most: int = 12000) -> Column:
    """ENT11: placeholders are replaced literally; a text over `most` characters is cut with a notice."""
    cut = F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n[texte tronqué]"))).otherwise(text)
    out = F.lit(template)
    for name, value in {**values, "text": cut}.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def json_object(raw: Column) -> Column:
    """ENT12"""
    inner = F.regexp_extract(raw, "(?s)\\{.*\\}", 0)
    return F.when(inner != "", inner).otherwise(F.trim(F.regexp_replace(raw, "(?m)^```.*$", "")))


def parsed(responses: DataFrame) -> DataFrame:
    """ENT15: responses (section_id, raw) parsed; invalid JSON gives type `autre`, empty lists and an error."""
    r = responses.withColumn("r", F.from_json(json_object(F.col("raw")), RESPONSE, {"mode": "PERMISSIVE"}))
    bad = F.col("r").isNull() | (F.col("r.section_type").isNull() & F.col("r.entities").isNull())
    return r.select("section_id", F.when(bad, "autre").otherwise(F.coalesce("r.section_type", F.lit("autre"))).alias("section_type"), F.col("r.entities").alias("entities"), F.col("r.positions").alias("positions"), F.when(bad, "invalid JSON").alias("error"))


def entities(parsed: DataFrame, lengths: DataFrame) -> DataFrame:
    """ENT13: one row for each entity with `reason` null if it is valid; lengths: (section_id, n)."""
    e = parsed.select("section_id", F.posexplode("entities").alias("k", "e")).select("section_id", "k", "e.*").join(lengths, "section_id")
    start, end = F.col("start_char").try_cast("int"), F.col("end_char").try_cast("int")
    missing = F.coalesce("surface", F.lit("")).eqNullSafe("") | F.coalesce("canonical", F.lit("")).eqNullSafe("") | F.col("label").isNull()
    reason = (
        F.when(missing, "missing field").when(~F.col("label").isin(*LABELS), "unknown label").when(start.isNull() | end.isNull(), "offsets not numeric")
        .when((start < 0) | (end <= start) | (end > F.col("n") + 50), "offsets out of range").when((F.col("label") == "ACTE") & F.col("acte_type").isNull(), "no acte_type")
    )
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.0))))
    return e.select("section_id", "k", "surface", "canonical", "label", start.alias("start_char"), end.alias("end_char"), confidence.alias("confidence"), "acte_type", reason.alias("reason"))


def positions(parsed: DataFrame) -> DataFrame:
    """ENT14"""
    p = parsed.select("section_id", F.posexplode("positions").alias("k", "p")).select("section_id", "k", "p.*")
    reason = F.when(F.coalesce(F.trim("acteur"), F.lit("")) == "", "no actor").when(~F.coalesce(F.col("type").isin(*POSITIONS), F.lit(False)), "unknown type")
    return p.withColumn("reason", reason)


def upsert(old: DataFrame, new: DataFrame, key: str = "section_id") -> DataFrame:
    """ENT17: rows of processed keys are replaced, others stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def update_types(sections: DataFrame, found: DataFrame) -> DataFrame:
    """ENT18"""
    known = found.select("section_id", F.col("section_type").alias("_new"))
    return sections.join(known, "section_id", "left").withColumn("section_type", F.coalesce("_new", "section_type")).drop("_new")


def report(rows: DataFrame, columns: list[str]) -> DataFrame:
    """ENT19: (field, value, n) in one pass over the rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))


def retried(ask, attempts: int = 3, wait: float = 0.0):
    """ENT16: the injected call, asked again after an error, `attempts` times at most; the last error is the answer's error."""
    import time

    def call(prompt: str) -> tuple[str | None, str | None]:
        error = None
        for k in range(attempts):
            try:
                return ask(prompt), None
            except Exception as e:  # any failure of the injected call counts as an attempt
                error = f"{type(e).__name__}: {e}"
                if wait and k + 1 < attempts:
                    time.sleep(wait)
        return None, error

    return call


def verified(sections: DataFrame, ask, instruction: str, most_words: int = 6000, attempts: int = 3) -> DataFrame:
    """TOC10: (section_id, response, error) of an injected verifier, asked for each section with the instruction and at most `most_words` words of its text."""
    schema = pa.schema([("section_id", pa.string()), ("response", pa.string()), ("error", pa.string())])

    def make():
        call = retried(ask, attempts)
        return lambda i, t: [(i, *call(instruction + "\n\n" + " ".join((t or "").split()[:most_words])))]

    return map_rows(sections.select(F.col("section_id").cast("string").alias("section_id"), "raw_text"), ["section_id", "raw_text"], schema, "section_id string, response string, error string", make)
