"""DuckDB SQL of queries whose patterns look around, walk lines or cross lists; RE2 has no lookaround, so neighbours are compared in lists."""

from __future__ import annotations

import re

from ..functions import text as T
from ..operators import entities as E
from ..operators import lexicon as L
from ..operators import structure as X
from . import noise

Q = noise.quoted
WORD = "\\pL\\pM\\p{Nd}\\p{Pc}"


def re2(pattern: str) -> str:
    """A pattern without lookarounds in RE2's notation: Unicode words and digits spelled out."""
    unicode = "(?U)" in pattern or "(?iU)" in pattern
    p = pattern.replace("(?U)", "").replace("(?iU)", "(?i)")
    p = re.sub(r"\\u([0-9A-Fa-f]{4})", r"\\x{\1}", p)
    p = re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), p)
    return p.replace("\\w", WORD if unicode else "\\w") if "[\\w" in p else p


def count(pattern: str, x: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({x}, {Q(pattern)})) AS INT)"


def replaced(x: str, *steps: tuple[str, str]) -> str:
    for p, r in steps:
        x = f"regexp_replace({x}, {Q(p)}, {Q(r)}, 'g')"
    return x


# R04
BAD = "[\\x{00}-\\x{08}\\x{0B}\\x{0C}\\x{0E}-\\x{1F}\\x{7F}-\\x{9F}\\x{FEFF}\\x{200B}-\\x{200F}\\t]"


def controls(x: str) -> str:
    between = (f"([^\\pC\\pZ]){BAD}([^\\pC\\pZ])", "\\1 \\2")
    return replaced(f"replace({replaced(x, between, between, (BAD, ''))}, chr(13), chr(10))", ("\\n{3,}", "\n\n"))


# R09: in a list of characters c, the sign at i that isn't an hour's colon
DIGIT = "[0-9]"
HOUR = f"(c[i] = ':' AND i > 1 AND i < len(c) AND regexp_matches(c[i - 1], '^{DIGIT}$') AND regexp_matches(c[i + 1], '^{DIGIT}$'))"
SIGN = f"(c[i] IN (':', ';', '!', '?') AND NOT {HOUR})"
BEFORE, AFTER = "(i > 1 AND c[i - 1] <> ' ')", "(i < len(c) AND c[i + 1] <> ' ')"


def each_character(x: str) -> str:
    return f"array_to_string(list_transform(range(1, len(c) + 1), lambda i: {x}), '')"


def punctuation(source: str, lang: str = "fr", columns: str = "doc_id, before") -> str:
    """SQL over a source with a column text (and the columns), the rule applied to text."""
    if lang == "fr":
        first = f"SELECT {columns}, {each_character(f'''CASE WHEN {SIGN} AND {BEFORE} THEN ' ' || c[i] ELSE c[i] END''')} AS text FROM (SELECT {columns}, string_split(text, '') AS c FROM ({source}))"
    else:
        hours = (f"({DIGIT}) :({DIGIT})", "\\1: \\2")
        first = f"SELECT {columns}, {replaced('text', hours, hours, (' ([:;!?])', chr(92) + '1'))} AS text FROM ({source})"
    return f"SELECT {columns}, {each_character(f'''CASE WHEN {SIGN} AND {AFTER} THEN c[i] || ' ' ELSE c[i] END''')} AS text FROM (SELECT {columns}, string_split(text, '') AS c FROM ({first}))"


NOISE = f"SELECT doc_id, text AS before, text FROM ({noise.sql()})"
DIGEST = "SELECT doc_id, md5(text) AS digest, text <> before AS changed FROM ({})"


def problems() -> str:
    n = lambda test: f"CAST(len(list_filter(range(1, len(c) + 1), lambda i: {test})) AS INT)"
    return (
        f"SELECT doc_id, {n('''c[i] IN (':', ';', '!', '?')''')} AS signs, {n(HOUR)} AS hours, {n(f'{SIGN} AND {BEFORE} AND {AFTER}')} AS both, "
        f"{n(f'{SIGN} AND {BEFORE} AND NOT {AFTER}')} AS before, {n(f'{SIGN} AND NOT {BEFORE} AND {AFTER}')} AS after FROM (SELECT doc_id, string_split(text, '') AS c FROM ({noise.sql()}))"
    )


def abbreviation_counts() -> str:
    """Signs that aren't part of words are doubled, so that each word has neighbours of its own."""
    forms = "|".join(re.escape(a).replace("\\ ", "  ") for a in (*T.TITLES, *T.LATIN))
    doubled = replaced("text", (f"([^{WORD}])", "\\1\\1"))
    return (
        f"SELECT doc_id, {count(f'(?:^|[^{WORD}])(?:{forms}){chr(92)}.', 'd')} AS with_stop, {count(f'(?:^|[^{WORD}])(?:{forms})(?:$|[^.{WORD}])', 'd')} AS without_stop "
        f"FROM (SELECT doc_id, {doubled} AS d FROM ({noise.sql()}))"
    )


def details(pattern: str, reach: int = 35) -> str:
    """Offsets from the lengths of the parts between matches and of the matches before."""
    return (
        f"SELECT doc_id, CAST(s AS INT) AS start, CAST(1 + length(text[1:s]) - length(replace(text[1:s], chr(10), '')) AS INT) AS line, found, text[greatest(1, s - {reach} + 1) : s + length(found) + {reach}] AS context FROM "
        "(SELECT doc_id, text, m[i] AS found, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM "
        f"(SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, text, string_split_regex(text, {Q(pattern)}) AS p, regexp_extract_all(text, {Q(pattern)}) AS m FROM ({noise.sql()}))))"
    )


def counted(rules: list[tuple[str, str, str]]) -> str:
    sql = f"SELECT doc_id, text FROM ({noise.sql()})"
    done: list[str] = []
    for p, r, label in rules:
        sql = f"SELECT doc_id, {''.join(x + ', ' for x in done)}{count(p)} AS {label}, {replaced('text', (p, r))} AS text FROM ({sql})"
        done.append(label)
    return f"SELECT doc_id, {', '.join(done)} FROM ({sql})"


def plain(rules: list[T.Rule]) -> list[tuple[str, str, str]]:
    return [(re2(r.pattern), r.replacement.replace("$", "\\"), r.label) for r in rules]


REFERENCES = [*plain(T.REFERENCE_RULES[:4]), (f"\\bet(\\s+)ss($|[^.,;{WORD}])", "et\\1ss.\\2", "following_bare")]


def differences(after: str) -> str:
    tokens = "regexp_extract_all({}, '\\S+')"
    return (
        f"SELECT doc_id, CAST(i - 1 AS INT) AS pos, x[i] AS before, y[i] AS after FROM (SELECT doc_id, x, y, unnest(range(1, greatest(len(x), len(y)) + 1)) AS i FROM "
        f"(SELECT doc_id, {tokens.format('text')} AS x, {tokens.format(after)} AS y FROM ({noise.sql()}))) WHERE x[i] <> y[i]"
    )


def audit(steps: dict[str, str]) -> str:
    parts = []
    paragraphs = "len([p for p in string_split({}, chr(10) || chr(10)) if trim(p, ' ') <> ''])"
    for name, after in steps.items():
        parts.append(
            f"SELECT '{name}' AS stage, CAST(sum(n) AS BIGINT) AS n_diff, count(*) FILTER (n > 0) AS n_changed, count(*) FILTER (a <> b) AS n_broken FROM (SELECT a, b, "
            f"len(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[i] <> y[i])) + abs(len(x) - len(y)) AS n FROM (SELECT {paragraphs.format('text')} AS a, {paragraphs.format('o')} AS b, "
            f"regexp_extract_all(text, '\\S+') AS x, regexp_extract_all(o, '\\S+') AS y FROM (SELECT text, {after} AS o FROM ({noise.sql()}))))"
        )
    return " UNION ALL ".join(parts)


# Lexicon
def known(w: str) -> str:
    return f"(({w} IN (SELECT form FROM l) OR lower({w}) IN (SELECT form FROM l)) AND length({w}) >= 2 AND NOT (length({w}) > 1 AND upper({w}) = {w} AND lower({w}) <> {w}))"


def commas(lexicon: str) -> str:
    pair = f"{T.LETTER}+,{T.LETTER}+"
    return (
        f"WITH l AS ({lexicon}), n AS (SELECT doc_id, text, regexp_extract_all(text, {Q(pair + '|[' + chr(92) + 's' + chr(92) + 'S]')}) AS v FROM ({noise.sql()})), "
        f"p AS (SELECT DISTINCT unnest(regexp_extract_all(text, {Q(pair)})) AS tok FROM n), q AS (SELECT tok, split_part(tok, ',', 1) AS a, split_part(tok, ',', 2) AS b FROM p), "
        f"f AS (SELECT tok, a || ', ' || b AS new FROM q WHERE {known('a')} AND {known('b')} AND NOT (length(a) <= 2 AND length(b) <= 2)), "
        "t AS (SELECT doc_id, unnest(v) AS tok, generate_subscripts(v, 1) AS i FROM n) "
        "SELECT doc_id, md5(string_agg(coalesce(f.new, t.tok), '' ORDER BY i)) AS digest FROM t LEFT JOIN f ON t.tok = f.tok GROUP BY doc_id"
    )


def splits(lexicon: str, most: int = 5) -> str:
    short = ", ".join(Q(w) for w in L.FUNCTION_WORDS)
    return (
        f"WITH l AS ({lexicon}), w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{T.LETTER}+')) AS word FROM documents), u AS (SELECT word FROM w WHERE NOT {known('word')} AND length(word) >= 5), "
        "c AS (SELECT word, cut, word[1:cut] AS first, word[cut + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word))) AS cut FROM u)), "
        f"k AS (SELECT *, first IN ({short}) AS prefix FROM c), f AS (SELECT * FROM k WHERE (prefix OR (cut >= 3 AND cut <= length(word) - 3)) AND {known('rest')} AND (prefix OR {known('first')})) "
        f"SELECT word, first, rest, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY prefix DESC, CASE WHEN prefix THEN -cut ELSE cut END) AS place FROM f) WHERE place <= {most}"
    )


END = f"(?:$|[^{WORD}])"
START = f"(?:^|[^{WORD}])"
FOREIGN = "|".join(
    ("[^aeiouàâéèêëîïôùûü]{4,}", f"(?:ck|oo|ee|ij|recht|ae){END}", f"{START}sch", f"{START}th[^éèêëàâîïôùûü]", f"(?:atione|ione|orum|arum|ibus|onis){END}", f"[{WORD}]{{4,}}ung{END}", f"[{WORD}](?:keit|heit|schaft){END}", f"{START}ge[rst][a-z]{{4,}}{END}")
)


def hapaxes(lexicon: str) -> str:
    return (
        f"WITH l AS ({lexicon}), t AS (SELECT unnest(regexp_extract_all(text, '[{WORD}]+')) AS raw FROM documents), "
        f"o AS (SELECT lower(raw) AS word, min(raw) AS raw FROM t WHERE regexp_matches(raw, '^{T.LETTER}{{3,}}$') GROUP BY 1 HAVING count(*) = 1) "
        f"SELECT word FROM o WHERE length(word) >= 5 AND raw = word AND NOT regexp_matches(word, {Q(FOREIGN)}) AND NOT {known('word')}"
    )


def unknown_forms(lexicon: str, least: int = 2, most: int = 10) -> str:
    roman = L.ROMAN_NUMBER.replace("(?=[MDCLXVI])", "")
    numbers = ("^[0-9]+$", roman, "^\\d+(?:[-–]\\d+)*$", "(?i)^[a-z]*-?\\d+[a-z]*$")
    not_word = " OR ".join(f"regexp_matches(word, {Q(p)})" for p in numbers)
    parts = lambda sign, test: f"SELECT word, {test} AS fits, count(*) AS k FROM (SELECT word, part, {known('part')} AS ok FROM (SELECT word, unnest(string_split(word, {Q(sign)})) AS part FROM r{'' if sign == '-' else 2} WHERE contains(word, {Q(sign)}))) GROUP BY word"
    return (
        f"WITH l AS ({lexicon}), t AS (SELECT doc_id, unnest(v) AS raw, generate_subscripts(v, 1) - 1 AS pos FROM (SELECT doc_id, regexp_extract_all(text, {Q(f"[{WORD}'][{WORD}'-]{{2,}}")}) AS v FROM documents)), "
        f"w AS (SELECT doc_id, pos, trim(translate(raw, {Q(L.PUNCTUATION.replace(chr(39), ''))}, ''), ' ') AS word FROM t), "
        f"c AS (SELECT word, count(*) AS n, min({{'d': doc_id, 'p': pos}}) AS first FROM w WHERE lower(word) = word AND NOT ({not_word}) AND NOT regexp_matches(word, '(?i)http|ark|www|gallica') AND NOT contains(word, '/') AND NOT regexp_matches(lower(word), {Q(FOREIGN)}) GROUP BY word), "
        f"r AS (SELECT * FROM c WHERE n BETWEEN {least} AND {most} AND NOT {known('word')}), "
        f"h AS ({parts('-', 'bool_and(ok)')}), r2 AS (SELECT * FROM r WHERE word NOT IN (SELECT word FROM h WHERE fits) AND NOT (contains(word, '-') AND {known(chr(114) + 'eplace(word, ' + Q('-') + ', ' + Q('') + ')')})), "
        f"a AS ({parts(chr(39), 'bool_or(ok)')}) "
        "SELECT word AS form, n, first.d AS first_doc, CAST(first.p AS INT) AS first_pos FROM r2 WHERE word NOT IN (SELECT word FROM a WHERE fits AND k = 2)"
    )


# Structure
def lines(source: str) -> str:
    """A row for each line of the source's texts; the last line end is dropped."""
    return f"SELECT doc_id, unnest(v) AS line, generate_subscripts(v, 1) - 1 AS pos FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n\\z', ''), chr(10)) AS v FROM ({source}))"


def volume() -> str:
    rule = "-" * 24 + "\n"
    page = lambda k, name: f"{Q(f'{rule}{k} {name}.' + chr(10))} || coalesce(text, '') || chr(10)"
    contents = "-" * 24 + "\n\nTABLE DES MATIÈRES.\nPages.\nPremière Partie.\n1\nI. — Statuts et règlements ..... 1\nA. — Membres (liste) ....... 3\nNotice sur la\nvie de Bluntschli ..... 4\nJanvier 1874 ... 12\n"
    return f"SELECT doc_id, {page(1, 'STATUTS')} || {page(3, 'MEMBRES')} || {page(4, 'NOTICES')} || {Q(contents)} AS text FROM documents"


def pages() -> str:
    left, right = Q(X.HEADER_LEFT), Q(X.HEADER_RIGHT)
    number = lambda x: f"TRY_CAST(translate(trim({x}, ' '), 'lOI', '101') AS INT)"
    return (
        f"WITH s AS (SELECT *, sum(CASE WHEN regexp_matches(line, '{X.SEPARATOR}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS page, trim(line, ' ') AS bare FROM ({lines(volume())})), "
        "a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY pos) - 1 AS place FROM s WHERE page > 0), "
        f"h AS (SELECT *, CASE WHEN regexp_matches(bare, {left}) THEN {number(f'regexp_extract(bare, {left}, 1)')} WHEN regexp_matches(bare, {right}) THEN {number(f'regexp_extract(bare, {right}, 2)')} END AS num, "
        f"trim(CASE WHEN regexp_matches(bare, {left}) THEN regexp_extract(bare, {left}, 2) WHEN regexp_matches(bare, {right}) THEN regexp_extract(bare, {right}, 1) END, ' ') AS hint FROM a), "
        "g AS (SELECT doc_id, page, min(CASE WHEN place BETWEEN 1 AND 6 AND bare <> '' AND num BETWEEN 1 AND 599 THEN place END) AS head, min(pos) AS line_start, max(pos) AS line_end, string_agg(CASE WHEN place > 0 THEN line END, chr(10) ORDER BY pos) AS body FROM h GROUP BY 1, 2), "
        "j AS (SELECT g.*, h.num, h.hint, row_number() OVER (PARTITION BY g.doc_id, h.num ORDER BY line_start) AS k FROM g JOIN h ON g.doc_id = h.doc_id AND g.page = h.page AND g.head = h.place) "
        "SELECT doc_id, num, CAST(line_start AS INT) AS line_start, CAST(line_end AS INT) AS line_end, hint AS section_hint, coalesce(body, '') AS raw_text FROM j WHERE k = 1"
    )


def sections() -> str:
    listed = "(0, 'Première Partie', 1, 1), (1, 'I. — Statuts et règlements', 1, 2), (2, 'A. — Membres (liste)', 3, 3), (3, 'Notice sur la vie de Bluntschli', 4, 2), (4, 'Janvier 1874', 12, 3)"
    return (
        f"WITH pp AS MATERIALIZED ({pages()}), t AS (SELECT doc_id, n, title, page AS page_start, level, lead(page) OVER (PARTITION BY doc_id ORDER BY page, n) - 1 AS page_end FROM documents, (VALUES {listed}) v(n, title, page, level)), "
        "e AS (SELECT t.*, least(coalesce(page_end, last), last) AS upto FROM t LEFT JOIN (SELECT doc_id, max(num) AS last FROM pp GROUP BY 1) m ON t.doc_id = m.doc_id), "
        "b AS (SELECT e.doc_id, n, title, level, page_start, page_end, list(raw_text ORDER BY num) FILTER (raw_text IS NOT NULL) AS body FROM e LEFT JOIN pp ON e.doc_id = pp.doc_id AND num BETWEEN page_start AND upto GROUP BY ALL), "
        "r AS (SELECT *, CASE WHEN coalesce(len(body), 0) = 0 THEN '' ELSE list_reduce(body, lambda a, x: a || chr(10) || '[page ' || page_start || ']' || chr(10) || x) END AS raw_text FROM b) "
        "SELECT doc_id, printf('s%04d', n) AS section_id, title, level, page_start, page_end, md5(raw_text) AS raw_text, CAST(len(regexp_extract_all(raw_text, '\\S+')) AS INT) AS word_count FROM r"
    )


def toc_start() -> str:
    return (
        f"SELECT doc_id, CAST(min(pos) AS INT) AS start FROM (SELECT *, first_value(CASE WHEN trim(line, ' ') <> '' THEN trim(line, ' ') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS next FROM ({lines(volume())})) "
        f"WHERE regexp_matches(line, '{X.SEPARATOR}') AND regexp_matches(next, '(?i)^TABLE DES MATI') GROUP BY doc_id"
    )


PARASITES = (X.SEPARATOR, "(?i)^\\d*\\s*TABLE\\s+DES\\s+MATI[ÈE]RES?\\.?\\s*\\d*\\s*$", "(?i)^Pages?\\.\\s*$", "(?i)^FIN\\s+DE\\s+LA\\s+PREMI[EÈ]RE?\\s+ANN[EÉ]E\\s*\\.?\\s*$", "^\\.\\.\\s*\\d+\\s*$")


def clean_toc() -> str:
    tests = " OR ".join(f"regexp_matches(trim(line, ' '), {Q(p)})" for p in PARASITES)
    return (
        f"WITH r AS (SELECT v.doc_id, pos, rtrim(regexp_replace(line, '(\\S) {{2,}}', '\\1 ', 'g'), ' ') AS line FROM ({lines(volume())}) v JOIN ({toc_start()}) t ON v.doc_id = t.doc_id WHERE pos >= start AND NOT ({tests})), "
        "b AS (SELECT *, trim(line, ' ') = '' AS blank FROM r), p AS (SELECT *, lag(blank, 1, true) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM b), "
        "k AS (SELECT * FROM p WHERE NOT (blank AND before) AND (blank OR length(trim(line, ' ')) >= 2)), z AS (SELECT *, max(CASE WHEN NOT blank THEN pos END) OVER (PARTITION BY doc_id) AS last FROM k) "
        "SELECT doc_id, CAST(pos AS INT) AS pos, line FROM z WHERE pos <= last"
    )


def classify(x: str) -> str:
    u = "A-ZÀÉÈÊÎÏÙÛÜ"
    tests = [(f"(?i)^{X.ORDER}|Sixi[eè]me?)\\s+partie", 1), ("^[IVX]+\\.\\s*[—\\-]+\\s*.+", 2), (f"^{X.MONTH}", 3), ("^[A-Z]\\.\\s*[—\\-]+\\s*.+", 3), ("^\\d{1,2}\\.\\s*[—\\-]?\\s*.+", 3)]
    tests += [(f"^[{u}][{X.LOW}][{WORD}\\-]*\\s*[(\\[]", 3), ("(?i)^(?:Annexes?[\\s.]*[A-Z]?[.\\s]*[—\\-]|Liste\\s+des)", 3), ("^(?:" + "|".join(X.THEMES) + ")", 3)]
    cases = " ".join(f"WHEN regexp_matches({x}, {Q(p)}) THEN {k}" for p, k in tests)
    return (
        f"CASE {cases} WHEN regexp_matches({x}, {Q(f'^[{u}]{{2,}}[{WORD}{chr(92)}s{chr(92)}-,.—]+$')}) AND length({x}) > 10 THEN 2 WHEN regexp_matches({x}, '^[a-zàéèê]\\)\\s*.+') THEN 4 "
        f"WHEN regexp_matches({x}, {Q(f'^[{u}][{X.LOW}][{WORD}{chr(92)}s{chr(92)}-]*$')}) AND NOT contains({x}, '—') THEN 3 ELSE 0 END"
    )


def entries() -> str:
    """(doc_id, n, title, page, level) of the documents' lines."""
    tail = Q(X.TAIL)
    value = "list_transform(string_split(upper(tail), ''), lambda x: CASE x WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 ELSE 1000 END)"
    roman = "list_sum(list_transform(range(1, len(v) + 1), lambda i: CASE WHEN i < len(v) AND v[i + 1] > v[i] THEN -v[i] ELSE v[i] END))"
    return (
        f"SELECT doc_id, n, title, page, {classify('title')} AS level FROM (SELECT doc_id, n, page, trim(regexp_replace(CASE WHEN page IS NULL THEN trim(line, ' ') ELSE trim(regexp_replace(line, {tail}, '', 'g'), ' ') END, '[\\.\\s·]{{3,}}$', ''), ' ') AS title FROM "
        f"(SELECT doc_id, n, line, CASE WHEN tail = '' THEN NULL WHEN regexp_matches(tail, '^[0-9]+$') THEN TRY_CAST(tail AS INT) ELSE CAST(-{roman} AS INT) END AS page FROM "
        f"(SELECT *, {value} AS v FROM (SELECT doc_id, pos AS n, line, regexp_extract(line, {tail}, 1) AS tail FROM ({lines('SELECT doc_id, text FROM documents WHERE text IS NOT NULL')})))))"
    )


def anomalies() -> str:
    tests = {"empty_title": "trim(title, ' ') = ''", "no_page": "page IS NULL", "unclassified": "level = 0", "page_above_500": "page > 500", "page_falls": "page BETWEEN 1 AND 500 AND page < top - 5"}
    each = " UNION ALL ".join(f"SELECT doc_id, CAST(n AS INT) AS n, '{k}' AS anomaly FROM e WHERE {t}" for k, t in tests.items())
    return f"WITH e AS MATERIALIZED (SELECT *, max(CASE WHEN page BETWEEN 1 AND 500 THEN page END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM ({entries()})) {each}"


def section_types() -> str:
    titles = ", ".join(f"({Q(t)})" for t in ("Première Partie", "I. — Statuts et règlements", "A. — Membres (liste)", "Notice sur la vie de Bluntschli", "Janvier 1874"))
    cases = " ".join(f"WHEN regexp_matches(lower(t), {Q(p)}) THEN '{k}'" for k, p in E.SECTION_TYPES.items())
    return f"SELECT CASE {cases} END AS section_type, count(*) AS n FROM documents, (VALUES {titles}) v(t) GROUP BY 1"


# Statistics
def cramer_matrix(table: str, columns: list[str]) -> str:
    parts = []
    for a in columns:
        for b in columns:
            parts.append(
                f"(WITH c AS (SELECT {a} AS a, {b} AS b, count(*)::DOUBLE AS o FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL), g AS (SELECT o, sum(o) OVER (PARTITION BY a) AS ra, sum(o) OVER (PARTITION BY b) AS rb, sum(o) OVER () AS n FROM c), "
                "s AS (SELECT max(n) AS n, (SELECT count(DISTINCT a) FROM c) AS r, (SELECT count(DISTINCT b) FROM c) AS k, sum(o * o / (ra * rb / n)) - max(n) AS chi2 FROM g) "
                f"SELECT '{a}' AS a, '{b}' AS b, round(sqrt(greatest(0, chi2 / n - (r - 1) * (k - 1) / (n - 1)) / least(k - (k - 1) ** 2 / (n - 1) - 1, r - (r - 1) ** 2 / (n - 1) - 1)), 6) AS cramer FROM s)"
            )
    return " UNION ALL ".join(parts)


def density(table: str, column: str, points: int = 50) -> str:
    return (
        f"WITH s AS (SELECT count({column}) AS n, stddev_samp({column}) * count({column}) ** -0.2 AS h, min({column}) AS lo, max({column}) AS hi FROM {table}), g AS (SELECT n, h, (lo - 3 * h) + ((hi + 3 * h) - (lo - 3 * h)) * i / {points - 1} AS x FROM s, range({points}) t(i)) "
        f"SELECT round(x, 9) AS x, round(sum(exp(-(((x - {column}) / h) ** 2) / 2)) / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density FROM g, {table} GROUP BY g.x"
    )


def lowess(table: str, x: str, y: str, by: str) -> str:
    return (
        f"WITH d AS (SELECT {by} AS grp, {x}::DOUBLE AS x, {y}::DOUBLE AS y, row_number() OVER w AS r, count(*) OVER (PARTITION BY {by}) AS n FROM {table} WINDOW w AS (PARTITION BY {by} ORDER BY {x}, {y})), "
        "p AS (SELECT a.grp, a.x, a.y, a.r, b.x AS bx, b.y AS yy, abs(b.x - a.x) AS away, row_number() OVER (PARTITION BY a.grp, a.r ORDER BY abs(b.x - a.x), b.r) AS k, greatest(2, ceil(a.n * (2.0::DOUBLE / 3.0::DOUBLE))) AS most FROM d a JOIN d b ON a.grp = b.grp), "
        "q AS (SELECT *, max(away) OVER (PARTITION BY grp, r) AS far FROM p WHERE k <= most), w AS (SELECT *, (1 - least(1, away / greatest(far, 1e-12)) ** 3) ** 3 AS w FROM q), "
        "s AS (SELECT grp, r, x, y, sum(w) AS sw, sum(w * bx) AS mx, sum(w * yy) AS my, sum(w * bx * bx) AS xx, sum(w * bx * yy) AS xy, avg(yy) AS plain FROM w GROUP BY ALL), "
        "v AS (SELECT *, CASE WHEN sw <> 0 THEN xx - mx * mx / sw ELSE 0 END AS var FROM s) "
        "SELECT grp, x, y, round(CASE WHEN sw = 0 THEN plain ELSE (my + (CASE WHEN var > 1e-12 THEN (xy - mx * my / sw) / var ELSE 0 END) * (x * sw - mx)) / sw END, 4) AS smooth FROM v"
    )


def split(table: str, key: str) -> str:
    return f"SELECT {key}, CAST('0x' || substr(md5({key} || ':42'), 1, 8) AS BIGINT) % 1000 < 700 AS in_training FROM {table}"


CAPITALS = f"SELECT token, count(*) AS n FROM (SELECT rtrim(unnest(regexp_extract_all(regexp_replace(text, '([^{WORD}-])', '\\1\\1', 'g'), '(?:^|[^{WORD}])([A-ZÀÂÄÉÈÊËÎÏÔÖÙÛÜŸÆŒ][a-zA-ZÀ-ÿ-]{{3,}})(?:$|[^{WORD}-])', 1)), '-') AS token FROM documents) WHERE length(token) >= 4 AND token NOT IN ({', '.join(Q(x) for x in E.STOP)}) GROUP BY token"
