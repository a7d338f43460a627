"""Deterministic text rules as Column -> Column expressions.

Patterns carry (?U) so that word characters, digits and borders are Unicode-aware. A rule
table is data: `fold` chains it, `counted` also reports how often each rule fires on the text
as its predecessors left it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = "[a-zA-ZÀ-ÿ]"
ROMAN = "[IVXLCDM]"


@dataclass(frozen=True)
class Rule:
    pattern: str
    replacement: str
    label: str


def fold(rules: list[Rule], text: Column) -> Column:
    for r in rules:
        text = F.regexp_replace(text, r.pattern, r.replacement)
    return text


def counted(rules: list[Rule], text: Column) -> list[Column]:
    """One count for each rule, in order."""
    out = []
    for r in rules:
        out.append(F.regexp_count(text, F.lit(r.pattern)).alias(r.label))
        text = F.regexp_replace(text, r.pattern, r.replacement)
    return out


def regex_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def let(value: Column, body) -> Column:
    """body(value), with the value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# R01: Spark has no Unicode normalisation; an Arrow UDF does it a batch at a time.
def normalize_unicode(text: Column, form: str = "NFC") -> Column:
    import unicodedata

    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"unknown normal form {form}")

    @F.pandas_udf("string")
    def normal(s):
        return s.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    normal.func.__annotations__ = {}
    return normal(text)


# R02, R03
APOSTROPHES = "’‘‛`"
DASHES = "—–−"


def apostrophes(text: Column) -> Column:
    return F.regexp_replace(text, f"[{APOSTROPHES}]", "'")


def dashes(text: Column) -> Column:
    return F.regexp_replace(text, f"[{DASHES}]", "-")


# R04
def controls(text: Column, keep_tabs: bool = False, keep_breaks: bool = False) -> Column:
    """A control character becomes one blank if both its neighbours are printable, else it goes."""
    tab = "" if keep_tabs else "\\t"
    bad = f"[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x9F\\uFEFF\\u200B-\\u200F{tab}]"
    out = let(text, lambda t: guarded(t, bad, lambda x: F.regexp_replace(F.regexp_replace(x, f"{bad}(?<=[^\\p{{C}}\\p{{Z}}]{bad})(?=[^\\p{{C}}\\p{{Z}}])", " "), bad, "")))
    if keep_breaks:
        return out
    return let(F.replace(out, F.lit("\r"), F.lit("\n")), lambda t: F.when(t.contains("\n\n\n"), F.regexp_replace(t, "\n{3,}", "\n\n")).otherwise(t))


# R05
WIDE_SPACES = "               　"
LINE_ENDS = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x85\\u2028\\u2029]"


def space_characters(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WIDE_SPACES}]", " ")


def _lines(text: Column, each) -> Column:
    """Like splitlines and join: a final line end is lost."""
    parts = F.split(F.regexp_replace(text, f"(?:{LINE_ENDS})\\z", ""), LINE_ENDS)
    return F.array_join(F.transform(parts, each), "\n")


def multiple_spaces(text: Column, least: int = 2, keep_indent: bool = False) -> Column:
    run = f" {{{least},}}"
    if keep_indent:
        return _lines(text, lambda x: F.concat(F.regexp_extract(x, "^( *)", 1), F.trim(F.regexp_replace(F.ltrim(x), run, " "))))
    return _lines(text, lambda x: F.trim(F.regexp_replace(x, run, " ")))


def trim_lines(text: Column) -> Column:
    return F.regexp_replace(text, "(?m)^[ \\t]+|[ \\t]+$", "")


def spaces(text: Column, keep_indent: bool = False) -> Column:
    """Line by line, but in passes over the whole text, each made only where it has something to do."""
    if keep_indent:
        return multiple_spaces(space_characters(text), keep_indent=True)
    out = let(space_characters(text), lambda t: guarded(t, "[\\r\\x0B\\x0C\\x1C-\\x1E\\x85\\u2028\\u2029]|\\n\\z", lambda x: F.regexp_replace(F.regexp_replace(x, f"(?:{LINE_ENDS})\\z", ""), LINE_ENDS, "\n")))
    out = let(out, lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t))
    return let(out, lambda t: guarded(t, "(?m)^[ \\t]|[ \\t]$", trim_lines))


# R06: endings that stand for the ordinal "e" after a number, in order; then the particular ones.
E_ENDINGS = ("ième", "ieme", "ème", "eme")
MISREAD = ("me", "mo", "mc", "em")


def ordinal_rules(roman: bool = False) -> list[Rule]:
    after = lambda end, to: Rule(f"(?U)\\b(\\d+){end}\\b", f"$1{to}", f"n_{end}")
    out = [after(x, "e") for x in E_ENDINGS] + [after("lre", "re"), after("ere", "re"), Rule("(?U)\\b1ère\\b", "1re", "first_feminine"), after("lr", "er")]
    out += [after(x, "e") for x in MISREAD]
    out += [Rule("(?U)(\\d+)™", "$1e", "trademark"), after("ME", "E"), after("do", "de"), Rule("(?U)\\bI([0-9]{3})\\b", "1$1", "year")]
    lone = "(?<![a-zA-Z0-9]){}(?![a-zA-Z])"
    out += [Rule(lone.format("lr"), "1er", "lone_lr"), Rule(lone.format("lre"), "1re", "lone_lre"), Rule("(?U)\\blRr\\b", "1er", "lone_capital")]
    if roman:
        out += [Rule(f"(?U)\\b({ROMAN}+){x}\\b", "$1e", f"roman_{x}") for x in (*E_ENDINGS, "me")]
    return out


def joined_ordinal_rules(roman: bool = False) -> list[Rule]:
    """The same as ordinal_rules in fewer passes: a number's ending is the whole rest of its word, so that at most one rule fits it. The search begins at what is rare."""
    after = lambda ends, to: Rule(f"(?U)(?=\\d)\\b(\\d+)(?:{ends})\\b", f"$1{to}", to)
    out = [after("|".join((*E_ENDINGS, *MISREAD)), "e"), after("[le]re", "re"), Rule("(?U)(?=1)\\b1ère\\b", "1re", "first_feminine"), after("lr", "er")]
    out += [r for r in ordinal_rules() if r.label in ("trademark",)] + [after("ME", "E"), after("do", "de"), Rule("(?U)(?=I)\\bI([0-9]{3})\\b", "1$1", "year")]
    lone = "{0}(?<![a-zA-Z0-9]{0})(?![a-zA-Z])"
    out += [Rule(lone.format("lr"), "1er", "lone_lr"), Rule(lone.format("lre"), "1re", "lone_lre"), Rule("(?U)(?=lRr)\\blRr\\b", "1er", "lone_capital")]
    return out + ([Rule(f"(?U)(?={ROMAN})\\b({ROMAN}+)(?:{'|'.join((*E_ENDINGS, 'me'))})\\b", "$1e", "roman")] if roman else [])


def ordinals(text: Column, roman: bool = False) -> Column:
    """The rules run where one search finds a place for any of them; a number alone is none."""
    ends = "|".join((*E_ENDINGS, *MISREAD, "lre?", "ere", "ère", "™", "ME", "do"))
    place = f"[\\p{{Nd}}](?:{ends})|I[\\p{{Nd}}]{{3}}|(?<![a-zA-Z0-9])lre?(?![a-zA-Z])|lRr" + (f"|{ROMAN}(?:i?[eè]me|me)" if roman else "")
    return guarded(text, place, lambda t: fold(joined_ordinal_rules(roman), t))


def exponents(text: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(text, "(?U)\\b1er\\b", "1ʳ"), "(?U)\\b1re\\b", "1ʳ")
    return F.regexp_replace(out, "(?U)\\b(\\d+)e\\b", "$1ᵉ")


# R07
MONTHS = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()


def months(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("Aoùt"), F.lit("août")), F.lit("aoùt"), F.lit("août"))

    def lowered(t: Column) -> Column:
        for c in dict.fromkeys(m[0] for m in MONTHS):  # one pass for each initial
            rests = "|".join(m[1:] for m in MONTHS if m[0] == c)
            t = F.regexp_replace(t, f"(?U){c.upper()}(?<!\\w{c.upper()})(?=(?:{rests})(?!\\w))", c)
        return t

    return let(out, lambda t: guarded(t, "|".join(m.capitalize() for m in MONTHS), lowered))


# R08
TITLES = ("Mlles", "Mlle", "Mme", "MM", "Mgr", "Dr", "M")
LATIN = ("loc cit", "op cit", "ibid", "etc", "cf", "id")
TOME = "(?:I{1,3}|IV|VI{0,3}|IX|X{1,3}|XI{0,3}|XIV|XIX|XX{0,3})\\b"
BEFORE = (("pp", "[ \\t]+\\d"), ("p", "[ \\t]+\\d"), ("vol", "[ \\t]+[\\dIVXLCDM]"), ("t", f"[ \\t]+{TOME}"), ("art", "[ \\t]+[\\d§]"), ("n", "°"), ("St", "-"))


def abbreviation_rules(custom: tuple[str, ...] = ()) -> list[Rule]:
    out = [Rule(f"(?U)(?<!\\w)({a})(?={then})", "$1.", f"before_{a}") for a, then in BEFORE]
    plain = [*TITLES, *LATIN, *sorted(custom, key=len, reverse=True)]
    return out + [Rule(f"(?U)(?<!\\w)(\\Q{a}\\E)(?![.\\w])", "$1.", a) for a in plain]


def guarded(text: Column, pattern: str, body) -> Column:
    """body(text) where the pattern occurs, else the text as it is: one search instead of many."""
    return F.when(text.rlike(pattern), body(text)).otherwise(text)


def joined_abbreviations() -> Rule:
    """abbreviation_rules in one pass: a stop that one of them puts is nowhere near what another looks at. Words within words are turned away at once."""
    first = "".join(dict.fromkeys(a[0] for a in (*(a for a, _ in BEFORE), *TITLES, *LATIN)))
    before = "|".join(f"{a}(?={then})" for a, then in BEFORE)
    plain = "|".join(f"\\Q{a}\\E" for a in (*TITLES, *LATIN))
    return Rule(f"(?U)(?=[{first}])(?<![a-zA-Z])(?<!\\w)(?:{before}|(?:{plain})(?![.\\w]))", "$0.", "abbreviations")


def abbreviations(text: Column, custom: tuple[str, ...] = ()) -> Column:
    return fold([joined_abbreviations(), *abbreviation_rules(custom)[len(BEFORE) + len(TITLES) + len(LATIN) :]], text)


# R09
SIGN = "(?!(?<=\\d):\\d)([:;!?])"
SIGN_FIRST = "[:;!?](?<!\\d:(?=\\d))"  # the same, the sign looked for before its neighbours


def punctuation(text: Column, lang: str = "fr") -> Column:
    if lang == "fr":
        out = F.regexp_replace(text, f"{SIGN_FIRST}(?<=[^ ][:;!?])", " $0")
    else:
        out = F.regexp_replace(F.regexp_replace(text, "(?<=\\d) :(?=\\d)", ": "), f" {SIGN}", "$1")
    return F.regexp_replace(out, f"{SIGN_FIRST}(?=[^ ])", "$0 ")


def comma_space(text: Column) -> Column:
    return F.replace(text, F.lit(" ,"), F.lit(","))


def glued_stop(text: Column) -> Column:
    return F.regexp_replace(text, f"\\.(?<={LETTER}{{4}}\\.)(?=[A-ZÀ-Ÿ][a-z])", ". ")


def all_punctuation(text: Column, lang: str = "fr") -> Column:
    return glued_stop(comma_space(punctuation(text, lang)))


# R11 - R13
ROMAN_RULES = [
    Rule("(?U)\\bVil\\b", "VII", "vil"),
    Rule("(?U)\\bVIL\\b", "VII", "vil_capitals"),
    Rule("(?U)\\b(T\\.|I\\.)\\s*Il\\b", "$1 II", "tome_two"),
    Rule("(?U)\\bT\\.\\s*Vit\\b", "T. VII", "tome_seven"),
]
REFERENCE_RULES = [
    Rule(f"(?U)\\b(T\\.\\s*{ROMAN}{{1,8}}),\\s*pp\\.?\\s*(\\d)", "$1, pp. $2", "tome_pages"),
    Rule(f"(?U)\\b(T\\.)({ROMAN}{{1,8}})\\b", "$1 $2", "tome_space"),
    Rule("(?U)\\bpp\\.(\\d)", "pp. $1", "pages_space"),
    Rule("(?U)\\bet(\\s+)ss[,;]", "et$1ss.", "following_sign"),
    Rule("(?U)\\bet(\\s+)ss\\b(?![.,;])", "et$1ss.", "following_bare"),
]
QUOTE_RULES = [
    Rule('(?U)\\b([Ii]n)([ -]?)(\\d+)"', "$1$2$3°", "format"),
    Rule('(?U)(?<=\\n\\n)"(\\d)', "$1", "stray_before_number"),
    Rule('(?U)(?<=\\n\\n)(\\d+)" ', "$1° ", "degree_sign"),
]


#: What a text that a rule changes has at least.
NEEDS = {"vil": "Vil", "vil_capitals": "VIL", "tome_two": "Il", "tome_seven": "Vit", "tome_pages": "pp", "tome_space": "T.", "pages_space": "pp.", "following_sign": "ss", "following_bare": "ss", "format": '"', "stray_before_number": '\n\n"', "degree_sign": '" '}


def fold_needed(rules: list[Rule], text: Column) -> Column:
    """fold, each rule only where the text holds what it needs."""
    needed = lambda r: lambda t: F.when(t.contains(NEEDS[r.label]), F.regexp_replace(t, r.pattern, r.replacement)).otherwise(t)
    for r in rules:
        text = let(text, needed(r))
    return text


def romans(text: Column) -> Column:
    return fold_needed(ROMAN_RULES, text)


def references(text: Column) -> Column:
    return fold_needed(REFERENCE_RULES, text)


def quotes(text: Column) -> Column:
    return fold_needed(QUOTE_RULES, text)


# R14: words with a ligature, built from their stems.
LIGATURE_WORDS = [s + e for s, ends in (("oeuvre", ("", "s")), ("voeu", ("", "x")), ("moeurs", ("",)), ("coeur", ("", "s")), ("soeur", ("", "s")), ("oeil", ("",)), ("oeuf", ("", "s")), ("noeud", ("", "s")), ("boeuf", ("", "s")), ("choeur", ("", "s")), ("oequo", ("",))) for e in ends]


def ligature_rules() -> list[Rule]:
    out = []
    for w in LIGATURE_WORDS:
        to, first = w.replace("oe", "œ"), w.replace("oe", "œ")
        out += [
            Rule(f"(?U)\\b{w.upper()}\\b", to.upper(), f"{w}_capitals"),
            Rule(f"(?U)\\b{w[0].upper()}(?i:{w[1:]})\\b", first[0].upper() + first[1:], f"{w}_initial"),
            Rule(f"(?iU)\\b{w}\\b", to, w),
        ]
    return out


def joined_ligature_rules() -> list[Rule]:
    """ligature_rules for words in capitals, with an initial and in small letters, in a pass for each."""
    def of(words: list[str], two: str, to: str) -> Rule:
        heads = sorted({w[: w.index(two)] for w in words}, key=len, reverse=True)
        first = "".join(sorted({w[0] for w in words}))
        return Rule(f"(?U)(?=[{first}])\\b(?=(?:{'|'.join(words)})\\b)({'|'.join(heads)}){two}", f"$1{to}", f"joined_{two}")

    titles = [w.capitalize() for w in LIGATURE_WORDS]
    return [of([w.upper() for w in LIGATURE_WORDS], "OE", "Œ"), of([w for w in titles if w[0] == "O"], "Oe", "Œ"), of([w for w in titles if w[0] != "O"], "oe", "œ"), of(LIGATURE_WORDS, "oe", "œ")]


def ligatures(text: Column) -> Column:
    """Mixed capitals are left to the rules one by one, where a text has any; dotted and dotless capitals count as i."""
    words = "|".join(LIGATURE_WORDS)
    mixed = lambda t: guarded(t, f"(?iU)(?=[{''.join(sorted({w[0] for w in LIGATURE_WORDS}))}\u017F])\\b(?:{words})\\b", lambda x: fold(ligature_rules(), x))
    return guarded(text, "[oO][eE][uUiIqQ\u0130\u0131]", lambda t: let(fold(joined_ligature_rules(), t), mixed))


#: RP: the chain of rules in order, without the lexicon step (operators.lexicon.commas).
CHAIN = (
    ("apostrophes", apostrophes), ("dashes", dashes), ("controls", controls), ("spaces", spaces), ("ordinals", ordinals), ("months", months),
    ("abbreviations", abbreviations), ("punctuation", all_punctuation), ("romans", romans), ("references", references), ("quotes", quotes), ("ligatures", ligatures),
)


# Counters (CNT1 - CNT10)
def positional_changes(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    pair = F.zip_with(F.split(F.left(a, n), ""), F.split(F.left(b, n), ""), lambda x, y: (x != y).cast("int"))
    return F.aggregate(pair, F.lit(0), lambda acc, x: acc + x)


def character_counts(text: Column, characters: dict[str, str]) -> Column:
    return F.struct(*((F.length(text) - F.length(F.translate(text, c, ""))).alias(name) for name, c in characters.items()))


APOSTROPHE_NAMES = {"curly": "’", "opening": "‘", "reversed": "‛", "grave": "`", "straight": "'"}
DASH_NAMES = {"em": "—", "en": "–", "minus": "−", "hyphen": "-"}
CONTROL_CLASSES = {"c0": "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "delete": "\\x7F", "c1": "[\\x80-\\x9F]", "bom": "\\uFEFF", "zero_width": "[\\u200B-\\u200F]", "tab": "\\t", "return": "\\r"}
SPACE_CLASSES = {"wide": f"[{WIDE_SPACES}]", "multiple": " {2,}", "leading": "(?m)^[ \\t]+", "trailing": "(?m)[ \\t]+$"}
ORDINAL_CLASSES = {"correct": "(?U)\\b\\d+(?:er|re|e|de)\\b", "correctable": "(?U)\\b\\d+(?:lre|lr|me|mo|mc|em|ME|do|ième|ieme|ème|eme|ere)\\b|\\d+™|\\bI[0-9]{3}\\b"}


def class_counts(text: Column, classes: dict[str, str]) -> Column:
    return F.struct(*(regex_count(text, p).alias(k) for k, p in classes.items()))


def abbreviation_counts(text: Column) -> Column:
    word = "|".join(f"\\Q{a}\\E" for a in (*TITLES, *LATIN))
    return F.struct(regex_count(text, f"(?U)(?<!\\w)(?:{word})\\.").alias("with_stop"), regex_count(text, f"(?U)(?<!\\w)(?:{word})(?![.\\w])").alias("without_stop"))


def straight_quotes(text: Column) -> Column:
    return regex_count(text, '"')


def punctuation_problems(text: Column) -> Column:
    """One class for each sign: missing blank before, after, both, none."""
    signs = regex_count(text, "[:;!?]")
    hour = regex_count(text, "(?<=\\d):(?=\\d)")
    both = regex_count(text, f"(?<=[^ ]){SIGN}(?=[^ ])")
    before = regex_count(text, f"(?<=[^ ]){SIGN}(?![^ ])")
    after = regex_count(text, f"(?<![^ ]){SIGN}(?=[^ ])")
    return F.struct(signs.alias("signs"), hour.alias("hours"), both.alias("both"), before.alias("before"), after.alias("after"))


# AUD2, AUD3
def token_differences(a: Column, b: Column) -> Column:
    """(pos, before, after) of the tokens that differ, place by place; equal texts aren't taken apart."""
    none = F.array().cast("array<struct<pos:int,before:string,after:string>>")
    return let(F.struct(a.alias("x"), b.alias("y")), lambda t: F.when(t["x"] == t["y"], none).otherwise(let(_token_lists(t["x"], t["y"]), _differences)))


def _token_lists(a: Column, b: Column) -> Column:
    return F.struct(*(F.regexp_extract_all(t, F.lit("\\S+"), F.lit(0)).alias(n) for t, n in ((a, "x"), (b, "y"))))


def _differences(v: Column) -> Column:
    pairs = F.arrays_zip(v["x"], v["y"])
    placed = F.transform(pairs, lambda p, i: F.struct(i.alias("pos"), p["x"].alias("before"), p["y"].alias("after")))
    return F.filter(placed, lambda p: p["before"] != p["after"])  # a token without a partner compares as null


def details(text: Column, pattern: str, reach: int = 35) -> Column:
    """AUD1: (start, line, found, context) of every match of a pattern, with `reach` characters around it; offsets are code points."""
    import re

    import pandas as pd

    regex = re.compile(pattern)

    @F.pandas_udf("array<struct<start:int,line:int,found:string,context:string>>")
    def found(texts):
        out = []
        for t in texts:
            rows, line, at = [], 1, 0
            for m in regex.finditer(t or ""):
                line, at = line + t.count("\n", at, m.start()), m.start()
                rows.append({"start": at, "line": line, "found": m[0], "context": t[max(0, at - reach) : m.end() + reach]})
            out.append(rows)
        return pd.Series(out)

    found.func.__annotations__ = {}
    return found(text)


def token_count(text: Column) -> Column:
    """STR7"""
    return F.size(F.regexp_extract_all(text, F.lit("\\S+"), F.lit(0)))


def paragraphs(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n\n"), lambda p: F.trim(p) != ""))


def audit(before: Column, after: Column, n_before: Column | None = None) -> Column:
    """n_before: the paragraphs before, where they are known. Equal texts aren't taken apart."""

    def compared(t: Column) -> Column:
        same = t["x"] == t["y"]
        counts = let(_token_lists(t["x"], t["y"]), lambda v: F.size(_differences(v)) + F.abs(F.size(v["x"]) - F.size(v["y"])))
        return F.struct(F.when(same, 0).otherwise(counts).alias("n_diff"), t["n"].alias("paragraphs_before"), F.when(same, t["n"]).otherwise(paragraphs(t["y"])).alias("paragraphs_after"))

    return let(F.struct(before.alias("x"), after.alias("y"), (paragraphs(before) if n_before is None else n_before).alias("n")), compared)
