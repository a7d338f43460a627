"""Quality rules: a threshold table compiled into Spark projections (built-in expressions only).

Every metric is counted per row in the JVM; no shuffle, no Python. Ratios are compared in
integers (1000 * numerator against limit * denominator), so results do not depend on
floating-point rounding.

Defined cases: a null text counts as empty (no words, base_failed); one-word, blank and very
long texts need no special path; repeated rows and ids each give a row; an empty table gives
an empty result; `measure` keeps the other columns of the input, also those named like a metric, in
whose place the metric comes; `keep` keeps all of them as they are.
Repeated 3-word windows are sorted by the low 64 - log2(words) bits of a hash within one text, and
neighbours with equal bits are compared word by word, so no window is counted that isn't repeated.
(A repeated window could be missed only if another's hash fell between two of its places.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

STOP_WORDS = (
    "the of and to in is that for it as with was by on are be this or an from at a "
    "le la les des de et en un une du que est pour dans par sur avec au "
    "der die das und ist von zu mit den ein eine für im nicht sich auf "
    "el los las y del que se por con para una al lo como"
).split()

STOP_FORMS = sorted({f for x in STOP_WORDS for f in (x, x.capitalize())})


@dataclass(frozen=True)
class Limit:
    """A rule: 1000 * num / den must lie within [least, most]; rows with den under the floor pass."""

    name: str
    num: str
    den: str
    least: int | None = None
    most: int | None = None
    floor: int = 1  # rows with a smaller den pass

    def broken(self, m: Column) -> Column:
        x, d = m[self.num] * 1000, m[self.den]
        out = F.lit(False)
        if self.least is not None:
            out = out | (x < self.least * d)
        if self.most is not None:
            out = out | (x > self.most * d)
        return (d >= self.floor) & out

    def sql(self) -> str:
        tests = [f"{self.num}*1000 {s} {k}*{self.den}" for s, k in (("<", self.least), (">", self.most)) if k is not None]
        return f"({self.den} >= {self.floor} AND ({' OR '.join(tests)}))"


#: The threshold table.
LIMITS = (
    Limit("word_length", "word_chars", "n_words", 2000, 12000),
    Limit("symbols", "n_symbols", "n_words", None, 100),
    Limit("stop_words", "n_stop", "n_words", 20, None),
    Limit("duplicate_lines", "n_dup_lines", "n_lines", None, 300, 10),
    Limit("capitals", "n_capitals", "word_chars", None, 300),
    Limit("exclamations", "n_marks", "n_words", None, 300),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
EXTRA = ["n_lines", "n_stop", "n_capitals", "n_marks", "broken"]


def let(value: Column, body) -> Column:
    """body(value), with the value computed once; unlike a column of its own it can't be inlined again by the optimizer."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def metrics(text: Column, limits: tuple[Limit, ...] = LIMITS) -> Column:
    """A struct of RESULT and EXTRA for a text, as one expression."""
    t = F.coalesce(text, F.lit(""))
    has_word = lambda line: F.length(F.trim(line, F.lit(" \t\u000b\f\r"))) > 0
    rest = lambda x, k: F.slice(x, F.lit(k), F.size(x))
    left = lambda x, n: F.call_function("shiftleft", x, n)
    low = (1 << 31) - 1

    def repeats(w: Column, b: Column) -> Column:
        # A window is a long: its hash above, its place in the lowest b bits. Sorted, equal windows are neighbours.
        gram = lambda x, i: left(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), b).bitwiseOR(i)
        place = lambda x: x.bitwiseAND(left(F.lit(1).cast("long"), b) - 1)
        equal = lambda x, y: F.call_function("shiftrightunsigned", x.bitwiseXOR(y), b) == 0
        word = lambda x, k: F.get(w, place(x).cast("int") + k)
        same = lambda x, y: equal(x, y) & (word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2))
        both = lambda s: F.array_compact(F.zip_with(s, rest(s, 2), lambda x, y: F.when(same(x, y), place(x) * (low + 1) + place(y))))
        places = lambda p: F.concat(F.transform(p, lambda x: F.shiftright(x, 31)), F.transform(p, lambda x: x.bitwiseAND(F.lit(low))))
        covered = lambda q: F.zip_with(q, rest(q, 2), lambda x, y: F.least(F.lit(3).cast("long"), y - x))
        grams = F.sort_array(F.slice(F.transform(w, gram), F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))))
        total = lambda p: let(F.sort_array(places(p)), lambda q: F.aggregate(covered(q), F.lit(0).cast("long"), lambda acc, x: acc + x))
        return let(let(grams, both), total)

    def counts(w: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            let(F.ceil(F.log2(F.size(w) + 2)).cast("int"), lambda b: repeats(w, b)).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: x.isin(STOP_FORMS))).cast("long").alias("n_stop"),
            F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
            F.regexp_count(t, F.lit("!")).cast("long").alias("n_marks"),
        )

    def judged(m: Column) -> Column:
        base = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
        broken = F.array_join(F.array_compact(F.array(*(F.when(x.broken(m), F.lit(x.name)) for x in limits))), ",")
        return F.struct(*(m[c].alias(c) for c in (*RESULT, *EXTRA) if c not in ("base_failed", "kept", "broken")), base.alias("base_failed"), broken.alias("broken"))

    lines = F.filter(F.split(t, "\n"), has_word)
    return let(let(words(text), lambda w: let(lines, lambda x: counts(w, x))), judged)


def measure(df: DataFrame, text: str = "text", limits: tuple[Limit, ...] = LIMITS) -> DataFrame:
    """All of df's rows with the columns RESULT and EXTRA added; `broken` names the limits that a text breaks."""
    m = F.col("metrics")
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in (*RESULT, *EXTRA)))
    df = df.select(row.alias("row"), metrics(F.col(f"`{text}`"), limits).alias("metrics"))
    values = {c: m[c] for c in (*RESULT, *EXTRA) if c != "kept"} | {"kept": ~m["base_failed"] & (m["broken"] == "")}
    return df.select("row.*", *(x.alias(c) for c, x in values.items()))


def keep(df: DataFrame, text: str = "text", limits: tuple[Limit, ...] = LIMITS) -> DataFrame:
    """The rows of df whose text passes, with df's own columns."""
    return df.filter(let(metrics(F.col(f"`{text}`"), limits), lambda m: ~m["base_failed"] & (m["broken"] == "")))


def oracle(limits: tuple[Limit, ...] = LIMITS) -> str:
    """DuckDB SQL for the query's rows."""
    stop = ", ".join(f"'{x}'" for x in STOP_FORMS)
    gap, broken = "[\\x20\\x09-\\x0D]+", " OR ".join(x.sql() for x in limits)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS MATERIALIZED (SELECT r, doc_id, t, [x for x in string_split_regex(t, '{gap}') if x <> ''] AS w,
  [x for x in string_split(t, chr(10)) if regexp_replace(x, '{gap}', '', 'g') <> ''] AS ln FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM l WHERE len(w) >= 3)),
k AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n >= 2),
c AS (SELECT r, count(DISTINCT i + o) AS n FROM k, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
m AS (SELECT l.r, doc_id, len(w) AS n_words, length(regexp_replace(t, '{gap}', '', 'g')) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals, len(regexp_extract_all(t, '!')) AS n_marks,
  len([x for x in w if x IN ({stop})]) AS n_stop, len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words FROM l LEFT JOIN c ON l.r = c.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT}) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT}) AND NOT ({broken}) AS kept FROM m"""
