"""Pages, tables of contents and sections from the lines of a document."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LINE_ENDS, MONTHS
from ..tables import parts

UP, LOW = "A-ZÀÉÈÊÎÏÙÛÜŒÆ", "a-zàéèêîïùûü"
ORDER = "(?:Premi[eè]re?|Deuxi[eè]me?|Troisi[eè]me?|Quatri[eè]me?|Cinqui[eè]me?"
SEPARATOR = "^-{20,}$"
HEADER_LEFT = f"^(\\d{{1,4}})\\s+([{UP}].{{2,70}}?)\\s*[.\\s]*$"
HEADER_RIGHT = f"^([{UP}].{{2,70}}?)[.\\s;,]+(\\d{{1,4}})\\s*$"
TOC_HEAD = "(?i)TABLE\\s+DES\\s+MATI"
MONTH = "(?:" + "|".join(m.capitalize() for m in MONTHS) + ")"
TAIL = "[\\.\\s\\-]{0,10}([ivxlcdmIVXLCDM]+|\\d+)\\s*$"
THEMES = ("Travaux spécialement", "Publications spécialement", "Publications relatives", "Monographies recommandant")


def tolerant_int(s: Column) -> Column:
    """STR1: an integer with l, O and I read as digits."""
    return F.translate(F.trim(s), "lOI", "101").try_cast("int")


def lines(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, pos, line)"""
    return df.select("doc_id", F.posexplode(F.split(F.regexp_replace(text, f"(?:{LINE_ENDS})\\z", ""), LINE_ENDS)).alias("pos", "line"))


def pages(df: DataFrame) -> DataFrame:
    """STR2: (doc_id, num, line_start, line_end, section_hint, raw_text) for each separator with a header in the six lines below."""
    of_doc = W.partitionBy("doc_id").orderBy("pos")
    stream = lines(df).withColumn("page", F.sum(F.col("line").rlike(SEPARATOR).cast("int")).over(of_doc)).filter("page > 0")
    inside = W.partitionBy("doc_id", "page").orderBy("pos")
    stream = stream.withColumn("at", F.row_number().over(inside) - 1)
    bare = F.trim("line")
    left, right = bare.rlike(HEADER_LEFT), bare.rlike(HEADER_RIGHT)
    num = F.when(left, tolerant_int(F.regexp_extract(bare, HEADER_LEFT, 1))).when(right, tolerant_int(F.regexp_extract(bare, HEADER_RIGHT, 2)))
    hint = F.when(left, F.regexp_extract(bare, HEADER_LEFT, 2)).when(right, F.regexp_extract(bare, HEADER_RIGHT, 1))
    ok = F.col("at").between(1, 6) & (bare != "") & num.between(1, 599)
    stream = stream.withColumn("head", F.when(ok, F.struct("at", num.alias("num"), F.trim(hint).alias("hint"))))
    grouped = stream.groupBy("doc_id", "page").agg(
        F.min("head").alias("head"), F.min("pos").alias("line_start"), F.max("pos").alias("line_end"),
        F.array_sort(F.collect_list(F.when(F.col("at") > 0, F.struct("pos", "line")))).alias("body"),
    ).filter("head IS NOT NULL")
    text = F.array_join(F.transform("body", lambda x: x["line"]), "\n")
    first = F.row_number().over(W.partitionBy("doc_id", "num").orderBy("line_start"))
    out = grouped.select("doc_id", F.col("head.num").alias("num"), "line_start", "line_end", F.col("head.hint").alias("section_hint"), text.alias("raw_text"))
    return out.withColumn("_n", first).filter("_n = 1").drop("_n")


def detect_level(title: Column) -> Column:
    """STR4"""
    return (
        F.when(title.rlike(f"^{ORDER})\\s+[Pp]artie\\.?\\s*$"), 1)
        .when(title.rlike("^[IVX]+\\.\\s*[—-]\\s*.+$"), 2)
        .when(title.rlike("^[A-Z]\\.\\s*[—-]\\s*.+$") | title.rlike("^[A-ZÀÉÈÊ][a-zàéèê]+\\s*[(\\[]") | title.rlike(f"^{MONTH}\\s+\\d{{4}}"), 3)
        .otherwise(2)
    )


def level_of(title: str) -> int:
    """detect_level on the driver's or a worker's side."""
    if re.match(f"{ORDER})\\s+[Pp]artie\\.?\\s*$", title):
        return 1
    if re.match("[IVX]+\\.\\s*[—-]\\s*.+$", title):
        return 2
    deep = ("[A-Z]\\.\\s*[—-]\\s*.+$", "[A-ZÀÉÈÊ][a-zàéèê]+\\s*[(\\[]", f"{MONTH}\\s+\\d{{4}}")
    return 3 if any(re.match(p, title) for p in deep) else 2


def toc_entries(text: str | None) -> list[tuple[str, int, int]]:
    """Titles may run over lines; a page number ends them, on their line or alone on the next."""
    all_lines = [x.strip() for x in (text or "").splitlines()]
    start = next((i for i, x in enumerate(all_lines) if re.search(TOC_HEAD, x)), None)
    out: list[tuple[str, int, int]] = []
    title: list[str] = []
    level = 2

    def close(parts: list[str], page: str, at: int) -> None:
        name = " ".join(" ".join(parts).strip().rstrip(".").split())
        if name and int(page) > 0:
            out.append((name, int(page), at))

    for x in [] if start is None else all_lines[start:]:
        if not x or re.search(TOC_HEAD, x) or x.lower() == "pages.":
            continue
        if m := re.search(r"[.\s…·]{2,}(\d{1,4})\s*$", x):
            head = x[: m.start()].strip().rstrip(".")
            close([*title, head], m[1], level if title else level_of(head))
            title = []
        elif title and re.fullmatch(r"\d{1,4}\s*", x):
            close(title, x.strip(), level)
            title = []
        elif level_of(x) == 1:
            title, level = [x], 1
        elif re.match(f"[{UP}]", x):
            title, level = [x], level_of(x)
        elif title:
            title.append(x)
    return out


#: The heading as a worker finds it, or what runs over a line's end: nothing before the first such place can be in the table.
TOC_ON = "(?isU)TABLE[\\s\\x1C-\\x1F]+DES[\\s\\x1C-\\x1F]+MATI.*"


def toc(df: DataFrame) -> DataFrame:
    """STR3: (doc_id, n, title, page, level); the state machine runs once a document, in Arrow batches. Only what follows the heading
    goes to the workers, a slice of rows at a time."""
    fields = [pa.field("n", pa.int32()), pa.field("title", pa.string()), pa.field("page", pa.int32()), pa.field("level", pa.int32())]

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                rows = [(k, n, *e) for k, x in enumerate(part.column("text").to_pylist()) for n, e in enumerate(toc_entries(x))]
                at, *columns = zip(*rows, strict=True) if rows else [()] * 5
                ids = part.column("doc_id").take(pa.array(at, pa.int64()))
                columns = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *columns], schema=pa.schema([part.schema.field("doc_id"), *fields]))

    near = df.select("doc_id", F.regexp_extract("text", TOC_ON, 0).alias("text")).filter("text <> ''")
    entry = (T.StructField("n", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("level", T.IntegerType()))
    return near.mapInArrow(run, T.StructType([df.schema["doc_id"], *entry]))


def sections(pages: DataFrame, toc: DataFrame, end_inclusive: bool = False) -> DataFrame:
    """STR5: pages from an entry's page to the one before the next entry's; page ranges are exploded, so this is an equi-join."""
    following = F.lead("page").over(W.partitionBy("doc_id").orderBy("page", "n"))
    ranged = toc.withColumn("page_start", F.col("page")).withColumn("page_end", following - (0 if end_inclusive else 1))
    last = pages.groupBy("doc_id").agg(F.max("num").alias("last"))
    ranged = ranged.join(last, "doc_id", "left").withColumn("_end", F.least(F.coalesce("page_end", "last"), "last"))
    nums = F.when(F.col("_end") >= F.col("page_start"), F.sequence("page_start", "_end"))
    spread = ranged.withColumn("num", F.explode_outer(nums))
    joined = spread.join(pages.select("doc_id", "num", "raw_text"), ["doc_id", "num"], "left")
    body = F.array_sort(F.collect_list(F.when(F.col("raw_text").isNotNull(), F.struct("num", "raw_text"))))
    marker = F.concat(F.lit("\n[page "), F.col("page_start").cast("string"), F.lit("]\n"))
    out = joined.groupBy("doc_id", "n", "title", "level", "page_start", "page_end").agg(body.alias("body"))
    text = F.aggregate("body", F.lit(""), lambda acc, x: F.when(acc == "", x["raw_text"]).otherwise(F.concat(acc, marker, x["raw_text"])))
    out = out.withColumn("raw_text", text).drop("body")
    ids = F.format_string("s%04d", "n")
    return out.select("doc_id", ids.alias("section_id"), "title", "level", "page_start", "page_end", "raw_text", F.size(F.regexp_extract_all("raw_text", F.lit("\\S+"), F.lit(0))).alias("word_count"))


def islands(rows: DataFrame, by: str, order: str, value: str, legacy: bool = False) -> DataFrame:
    """STR6: ranges of equal consecutive values: (by, island, value, first, last, n); legacy drops the last one and empty values."""
    w = W.partitionBy(by).orderBy(order)
    new = F.coalesce((F.lag(value).over(w).eqNullSafe(F.col(value))) & F.lag(order).over(w).isNotNull(), F.lit(False))
    marked = rows.withColumn("island", F.sum((~new).cast("int")).over(w))
    out = marked.groupBy(by, "island", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
    if legacy:
        out = out.withColumn("_last", F.max("island").over(W.partitionBy(by))).filter((F.col("island") < F.col("_last")) & (F.coalesce(value, F.lit("")) != "")).drop("_last")
    return out


END_OF_LINE = "[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x85\\u2028\\u2029]"
TOC_FROM = f"(?s)(?:\\A|(?<={END_OF_LINE}))-{{20,}}(?:{LINE_ENDS})(?: *(?:{LINE_ENDS})){{0,4}}+ *+(?i:TABLE DES MATI).*"


def toc_part(df: DataFrame) -> DataFrame:
    """(doc_id, start, text): the text from the first separator whose first non-blank line within five opens the table of contents, and the number of its first line."""
    rest = df.select("doc_id", "text", F.regexp_extract("text", TOC_FROM, 0).alias("_rest")).filter("_rest <> ''")
    before = F.left("text", F.length("text") - F.length("_rest"))
    return rest.select("doc_id", F.regexp_count(before, F.lit(LINE_ENDS)).alias("start"), F.col("_rest").alias("text"))


def toc_start(df: DataFrame) -> DataFrame:
    """TOC1: the line of the first separator whose first non-blank line within five opens the table of contents."""
    return toc_part(df).groupBy("doc_id").agg(F.min("start").alias("start"))


def parasitic(line: Column) -> Column:
    """TOC2"""
    bare = F.trim(line)
    patterns = (SEPARATOR, "(?i)^\\d*\\s*TABLE\\s+DES\\s+MATI[ÈE]RES?\\.?\\s*\\d*\\s*$", "(?i)^Pages?\\.\\s*$", "(?i)^FIN\\s+DE\\s+LA\\s+PREMI[EÈ]RE?\\s+ANN[EÉ]E\\s*\\.?\\s*$", "^\\.\\.\\s*\\d+\\s*$")
    out = bare.rlike(patterns[0])
    for p in patterns[1:]:
        out = out | bare.rlike(p)
    return out


def inner_spaces(line: Column) -> Column:
    """TOC3"""
    return F.rtrim(F.regexp_replace(line, "(?<=\\S) {2,}", " "))


def clean_toc(df: DataFrame) -> DataFrame:
    """TOC4: lines from the table's start without parasites and short lines, at most one blank in a row, no blank ends."""
    split = F.split(F.regexp_replace("text", f"(?:{LINE_ENDS})\\z", ""), LINE_ENDS)
    rows = toc_part(df).select("doc_id", "start", F.posexplode(split).alias("at", "line")).select("doc_id", (F.col("start") + F.col("at")).alias("pos"), "line")
    rows = rows.filter(~parasitic(F.col("line")))
    rows = rows.withColumn("line", inner_spaces(F.col("line"))).withColumn("blank", F.trim("line") == "")
    rows = rows.withColumn("before", F.lag("blank", 1, True).over(W.partitionBy("doc_id").orderBy("pos"))).filter("NOT (blank AND before)")
    rows = rows.filter("blank OR length(trim(line)) >= 2")
    last = F.max(F.when(~F.col("blank"), F.col("pos"))).over(W.partitionBy("doc_id"))
    return rows.withColumn("_last", last).filter("pos <= _last").select("doc_id", "pos", "line")


def roman_value(s: Column) -> Column:
    """TOC5: null if a sign isn't a roman digit."""
    up = F.upper(F.trim(s))
    value = F.create_map(*(F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv))
    digits = F.transform(F.split(up, ""), lambda c: F.element_at(value, c))
    signed = F.zip_with(digits, F.slice(digits, F.lit(2), F.size(digits)), lambda a, b: F.when(b > a, -a).otherwise(a))
    return F.when(up.rlike("^[IVXLCDM]+$"), F.aggregate(signed, F.lit(0), lambda acc, x: acc + x))


def page_of(line: Column) -> Column:
    """TOC6: struct(title, page); roman pages are negative."""
    tail = F.regexp_extract(line, TAIL, 1)
    page = F.when(tail == "", None).when(tail.rlike("^\\d+$"), tail.try_cast("int")).otherwise(-roman_value(tail))
    title = F.when(page.isNull(), F.trim(line)).otherwise(F.trim(F.regexp_replace(line, TAIL, "")))
    return F.struct(F.trim(F.regexp_replace(title, "[\\.\\s·]{3,}$", "")).alias("title"), page.alias("page"))


def classify(title: Column) -> Column:
    """TOC7: level of an entry, 0 if none fits; the first test that holds decides."""
    u, tests = "A-ZÀÉÈÊÎÏÙÛÜ", []
    tests += [(f"(?i)^{ORDER}|Sixi[eè]me?)\\s+partie", 1), ("^[IVX]+\\.\\s*[—\\-]+\\s*.+", 2), (f"^{MONTH}", 3), ("^[A-Z]\\.\\s*[—\\-]+\\s*.+", 3), ("^\\d{1,2}\\.\\s*[—\\-]?\\s*.+", 3)]
    tests += [(f"(?U)^[{u}][{LOW}][\\w\\-]*\\s*[(\\[]", 3), ("(?i)^(?:Annexes?[\\s.]*[A-Z]?[.\\s]*[—\\-]|Liste\\s+des)", 3), ("^(?:" + "|".join(THEMES) + ")", 3)]
    out = F.when(title.rlike(tests[0][0]), 1)
    for p, level in tests[1:]:
        out = out.when(title.rlike(p), level)
    out = out.when(title.rlike(f"(?U)^[{u}]{{2,}}[\\w\\s\\-,.—]+$") & (F.length(title) > 10), 2).when(title.rlike("^[a-zàéèê]\\)\\s*.+"), 4)
    return out.when(title.rlike(f"(?U)^[{u}][{LOW}][\\w\\s\\-]*$") & ~title.contains("—"), 3).otherwise(0)


def anomalies(entries: DataFrame) -> DataFrame:
    """TOC8: (doc_id, n, anomaly) of entries (doc_id, n, title, page, level)."""
    before = W.partitionBy("doc_id").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    top = F.max(F.when(F.col("page").between(1, 500), F.col("page"))).over(before)
    tests = {"empty_title": F.trim("title") == "", "no_page": F.col("page").isNull(), "unclassified": F.col("level") == 0, "page_above_500": F.col("page") > 500, "page_falls": F.col("page").between(1, 500) & (F.col("page") < top - 5)}
    found = F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))
    return entries.withColumn("_found", found).select("doc_id", "n", F.explode("_found").alias("anomaly"))


def toc_report(entries: DataFrame) -> DataFrame:
    """TOC9: entries, roman and missing pages by level."""
    return entries.groupBy("level").agg(F.count("*").alias("n"), F.count_if(F.col("page") < 0).alias("n_roman"), F.count_if(F.col("page").isNull()).alias("n_missing"))
