import math
import random
import re
import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium import tables
from scriptorium.functions import text as T
from scriptorium.tables import Scratch
from scriptorium.operators import entities as E
from scriptorium.operators import lexicon as L
from scriptorium.operators import statistics as S
from scriptorium.operators import structure as X
from scriptorium.plans.catalog import QUERIES


def lexicon(spark, *forms):
    return spark.createDataFrame([(f,) for f in forms], "form string")


def read_once(spark, texts):
    """(df, count): the texts as documents, and how many of them have been read so far."""
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.mapInArrow(through, df.schema), lambda: seen.value


def test_unknown_forms_read_each_text_once(spark):
    df, count = read_once(spark, ["zorglub zorglub l'inconnu porte-plume", "porte-plume zorglub aujou-demain", "aujou-demain l'inconnu maison maison"])
    got = {tuple(r) for r in L.unknown_forms(df, lexicon(spark, "porte", "plume", "maison", "inconnu")).collect()}
    assert got == {("zorglub", 3, 0, 0), ("aujou-demain", 2, 1, 2)}
    assert count() == 3


def test_unknown_forms_take_any_document_key(spark):
    rows = [(None, "zorglub"), (-5, "zorglub"), (7, "glubzor"), (7, "x glubzor"), (-(1 << 63), "bizor"), (3, "aaa bizor")]
    for kind in ("long", "string"):
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
        got = {r.form: (r.first_doc, r.first_pos) for r in L.unknown_forms(df, lexicon(spark, "le")).collect()}
        low = -(1 << 63) if kind == "long" else str(-(1 << 63))
        assert got == {"zorglub": (None, 0), "glubzor": (7 if kind == "long" else "7", 0), "bizor": (low, 0)}


def test_commas(spark):
    df = spark.createDataFrame([(1, "les membres,les autres"), (2, "Mancini,Asser")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.commas(df, lexicon(spark, "membres", "les")).collect()}
    assert got == {1: "les membres, les autres", 2: "Mancini,Asser"}


def test_splits(spark):
    words = spark.createDataFrame([("ledroit",), ("droitinternational",)], "word string")
    got = {(r.word, r.first, r.rest) for r in L.splits(words, lexicon(spark, "droit", "international", "le")).collect() if r.place == 1}
    assert got == {("ledroit", "le", "droit"), ("droitinternational", "droit", "international")}


def test_nearest(spark):
    words = spark.createDataFrame([("acles",), ("driot",), ("zzzzzz",)], "word string")
    got = {r.word: (r.correction, r.distance) for r in L.nearest(words, lexicon(spark, "actes", "droit", "maison")).collect()}
    assert got == {"acles": ("actes", 1), "driot": ("droit", 1)}


def test_nearest_reads_its_words_once(spark):
    df, count = read_once(spark, ["acles", "driot", "zzzzzz", "maisno"])
    got = {tuple(r) for r in L.nearest(df.select(F.col("text").alias("word")), lexicon(spark, "actes", "droit", "maison", "maisons")).collect()}
    assert got == {("acles", "actes", 1), ("driot", "droit", 1), ("maisno", "maison", 1)}
    assert count() == 4


def test_nearest_is_that_of_all_pairs(spark):
    rnd = random.Random(5)
    made = lambda k: sorted({"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 9))) for _ in range(k)})
    words, forms = made(120), made(60)
    want = set()
    for w in words:
        near = sorted((L.osa(w, f), f) for f in forms)
        if near[0][0] <= 2 and near[1][0] > near[0][0]:
            want.add((w, near[0][1], near[0][0]))
    got = L.nearest(spark.createDataFrame([(w,) for w in words], "word string"), lexicon(spark, *forms)).collect()
    assert {tuple(r) for r in got} == want and {d for _, _, d in want} >= {1, 2}
    a, b = pd.Series([w for w in words for _ in forms]), pd.Series([f for _ in words for f in forms])
    assert list(L.osa_many(a, b)) == [L.osa(x, y) for x, y in zip(a, b)]


def test_tokens_are_lossless(spark):
    df = spark.createDataFrame([(1, " a  b\nc "), (2, "x")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.rebuild(L.tokens(df)).collect()} == {1: " a  b\nc ", 2: "x"}


def test_replaced_holds_a_slice_of_a_batch_and_keeps_all_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "SLICE_BYTES", 20)
    schema = pa.schema([("k", pa.int64()), ("text", pa.string())])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 9, None, "b" * 9, "c" * 50, "d" * 15, "e" * 15])], schema=schema)
    assert [p.column("k").to_pylist() for p in tables.parts(batch, "text")] == [[0, 1, 2], [3], [4], [5]]
    assert [p.num_rows for p in tables.parts(batch.slice(0, 0), "text")] == []
    df = spark.createDataFrame([(k, f"The cat {k}" if k % 3 else None, [k]) for k in range(50)], "doc_id long, text string, other array<long>")
    mapping = spark.createDataFrame([("the", "THE")], "old string, new string")
    want = {(k, f"THE cat {k}" if k % 3 else None, (k,)) for k in range(50)}
    done = L.apply_map(df, mapping)
    assert "MapInArrow" in done._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.doc_id, r.text, tuple(r.other)) for r in done.collect()} == want and done.schema == df.schema
    monkeypatch.setattr(L, "MAP_ROWS", 0)
    assert {(r.doc_id, r.text, tuple(r.other)) for r in L.apply_map(df, mapping).collect()} == want


def test_map_is_computed_once(spark):
    read, count = read_once(spark, ["the", "cat"])
    df = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    L.apply_map(df, read.select(F.col("text").alias("old"), F.upper("text").alias("new"))).collect()
    assert count() == 2


def test_splits_are_proposed_from_one_reading(spark, tmp_path):
    text = "ledroit droit international le droitinternational maison"
    spark.createDataFrame([(k, text if k == 0 else "droit international le maison", "fr") for k in range(6)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["lex4_proposals"](spark, str(tmp_path))
    assert "documents.parquet" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in plan.collect()} == {("ledroit", "le droit"), ("droitinternational", "droit international")}


def test_commas_between_runs_of_letters(spark):
    rows = ["a,bc,de", "xx,membres,les,les", "les,membres", "é,les membres,", ",les", "les,membres,5les,les"]
    got = {r.text for r in L.commas(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), lexicon(spark, "membres", "les")).collect()}
    assert got == {"a,bc,de", "xx,membres,les, les", "les, membres", "é,les membres,", ",les", "les, membres,5les, les"}


def test_tree_reads_its_rows_once(spark):
    df, count = read_once(spark, [str(k) for k in range(200)])
    rows = df.select("doc_id", F.col("doc_id").cast("int").alias("n"), (F.col("doc_id") > 100).cast("int").alias("y"))
    _, accuracy = S.decision_tree(rows, ["n"], "y", "doc_id")
    assert accuracy > 0.9 and count() == 200


def old_toc_start(text):
    rows = re.split(T.LINE_ENDS, re.sub(f"(?:{T.LINE_ENDS})\\Z", "", text))
    for k, x in enumerate(rows):
        ahead = [y.strip(" ") for y in rows[k + 1 : k + 6] if y.strip(" ")]
        if re.search("^-{20,}$", x) and ahead and re.search("(?i)^TABLE DES MATI", ahead[0]):
            return k
    return None


def test_table_of_contents_is_found_without_a_row_for_each_line(spark):
    rnd, rule = random.Random(4), "-" * 20
    bits = [rule, rule + "-", "-" * 19, "TABLE DES MATIÈRES.", " table des mati", "x TABLE DES MATI", "TABLE DES", "MATI", "", "  ", "text", "I. — Statuts ..... 7"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["\n", "\n", "\r\n", "\r", "\u2028"]) for _ in range(rnd.randrange(12))) for _ in range(4000)] + [rule + "\n\n\n\n\nTABLE DES MATI", rule + "\n\n\n\n\n\nTABLE DES MATI"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {k: at for k, t in enumerate(texts) if (at := old_toc_start(t)) is not None}
    assert {r.doc_id: r.start for r in X.toc_start(df).collect()} == want and len(want) > 100
    plan = X.clean_toc(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Generate") == 1
    got = {}
    for r in X.clean_toc(df).collect():
        assert r.pos >= want[r.doc_id]
        got.setdefault(r.doc_id, []).append(r.line)
    assert got


def test_only_the_table_goes_to_the_workers(spark):
    bits = ["TABLE DES MATIÈRES.", "Table\u00a0des  matières", "TABLE\nDES MATI", "TABLE DES", "I. — Statuts ..... 7", "Notice sur la", "vie ..... 9", "Première Partie.", "12", "", "pages."]
    rnd = random.Random(6)
    texts = [None, *("".join(rnd.choice(bits) + rnd.choice(["\n", "\n", "\r\n", " ", "\x1c"]) for _ in range(rnd.randrange(12))) for _ in range(3000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    want = {(k, n, *e) for k, t in enumerate(texts) for n, e in enumerate(X.toc_entries(t))}
    found = X.toc(df)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 1000
    assert "regexp_extract" in found._jdf.queryExecution().optimizedPlan().toString()


def test_table_of_contents():
    text = "x\nTABLE DES MATIÈRES.\nPages.\nPremière Partie.\nI. — Statuts ..... 7\nNotice sur la\nvie ..... 9\n"
    assert X.toc_entries(text) == [("Première Partie. I. — Statuts", 7, 1), ("Notice sur la vie", 9, 2)]


def test_page_of_and_roman(spark):
    df = spark.createDataFrame([("Titre ..... 12",), ("Avant-propos .... xvii",), ("Sans page -",)], "t string")
    assert [tuple(r.p) for r in df.select(X.page_of(F.col("t")).alias("p")).collect()][:2] == [("Titre", 12), ("Avant-propos", -17)]


def test_classes_of_titles(spark):
    titles = {"Première Partie": 1, "I. — Statuts": 2, "Janvier 1874": 3, "A. — Membres": 3, "3. — Liste": 3, "Asser (Tobie)": 3, "a) détail": 4, "TABLEAU CHRONOLOGIQUE des actes": 2, "Bluntschli": 3, "«?»": 0}
    df = spark.createDataFrame([(t,) for t in titles], "t string").select("t", X.classify(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == titles


def test_clusters(spark):
    found = spark.createDataFrame([("Bluntschli", 9, 1), ("Bluntschll", 2, 2), ("Mancini", 5, 3), ("Manciui", 1, 4), ("Asser", 3, 5)], "token string, n long, first long")
    got = {(r.pivot, r.token) for r in E.clusters(found).collect()}
    assert got == {("Bluntschli", "Bluntschli"), ("Bluntschli", "Bluntschll"), ("Mancini", "Mancini"), ("Mancini", "Manciui")}


def brute_clusters(counted):
    """The reference's greedy; counted: (token, n) by falling n, ties by first occurrence."""
    made = []
    for token, n in counted:
        home = next((c for c in made if E.ratio(E.bare(token), E.bare(c[0][0])) >= 85), None)
        if home is None:
            made.append([(token, 100.0, n)])
        else:
            home.append((token, E.ratio(E.bare(token), E.bare(home[0][0])), n))
    return {(c[0][0], *row) for c in made if len(c) > 1 for row in c}


def test_clusters_are_the_greedy_of_rare_and_long_tokens(spark):
    rnd, forms = random.Random(3), []
    for _ in range(60):
        root = "".join(rnd.choice("abeéio") for _ in range(rnd.randrange(4, 30)))
        for _ in range(6):
            chars = list(root)
            for _ in range(rnd.randrange(1 + len(chars) // 5)):
                at = rnd.randrange(len(chars))
                chars[at : at + 1] = rnd.choice(["", rnd.choice("abeio"), chars[at] + rnd.choice("abeio")])
            forms.append(("".join(chars) or "a").capitalize())
            forms.append(forms[-1].upper())
    rows = [(t, rnd.randrange(1, 4), k) for k, t in enumerate(dict.fromkeys(forms))]
    found = spark.createDataFrame(rows, "token string, n long, first long")
    got = {(r.pivot, r.token, r.score, r.n) for r in E.clusters(found).collect()}
    assert got == brute_clusters([(t, n) for t, n, _ in sorted(rows, key=lambda r: (-r[1], r[2]))])
    assert max(len(t) for _, t, *_ in got) > E.SHORT


def test_greedy_keeps_a_pivot_whose_neighbours_go_first(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 5), (4, 5)], "ra long, rb long")
    assert {tuple(r) for r in E.greedy(edges, Scratch(spark, "test")).collect()} == {(2, 1), (5, 3)}


def test_cluster_queries_take_every_token(spark, tmp_path):
    text = "Bluntschli und Bluntschll. Mancini et Manciui, Mancini. Asser Bluntschli"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_clusters([("Bluntschli", 2), ("Mancini", 2), ("Bluntschll", 1), ("Manciui", 1), ("Asser", 1)])
    assert {(r.pivot, r.token, r.score, r.n) for r in QUERIES["ent3_clusters"](spark, str(tmp_path)).collect()} == want
    assert {(r.forme_retenue, r.variantes, r.nb_occurrences) for r in QUERIES["ent6_candidates"](spark, str(tmp_path)).collect()} == {("Bluntschli", "Bluntschll", 3), ("Mancini", "Manciui", 3)}


def test_corrections_quote_their_replacement(spark):
    df = spark.createDataFrame([("Manciui et Manciuis",)], "text string")
    row = E.apply_corrections(df, [("Manciui", "Man$cini\\")]).first()
    assert (row.text, row.n_substitutions) == ("Man$cini\\ et Manciuis", 1)


def test_tails_and_fisher():
    assert math.isclose(S.chi_square_tail(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(S.t_two_sided(2.228138851986274, 10), 0.05, rel_tol=1e-8)
    odds, p = S.fisher_exact(8, 2, 1, 5)
    assert odds == 20 and math.isclose(p, 0.03496503496503495, rel_tol=1e-9)


def test_quantiles_are_those_of_percentile_without_a_task_that_reads_all(spark):
    df = spark.range(0, 4001, numPartitions=6).select(F.when(F.col("id") % 7 != 0, F.hash("id") / 3).alias("a"), (F.col("id") % 5).alias("b"), F.lit(None).cast("double").alias("c"))
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    want = df.agg(*(F.percentile(c, F.lit(p)) for c in "abc" for p in shares)).first()
    assert [x for c in "abc" for x in S.quantiles(df, list("abc"), shares)[c]] == list(want)
    for plan in (S.describe(df, ["a", "b"]), S.box(df, "a")):
        assert "percentile" not in plan._jdf.queryExecution().optimizedPlan().toString().lower()
    r = S.describe(df, ["a", "c"]).collect()
    assert [(x.name, x["count"]) for x in r] == [("a", 3429), ("c", 0)] and r[1].q50 is None
    assert S.describe(df.limit(0), ["a"]).count() == 0 and S.box(df.limit(0), "a").count() == 0


def whole_lowess(rows, share=2 / 3):
    """Every row against every other of its group."""
    out = []
    for g in sorted({r[0] for r in rows}):
        pts = sorted((x, y) for h, x, y in rows if h == g)
        k = max(2, math.ceil(share * len(pts)))
        for v, own in pts:
            near = sorted(pts, key=lambda p: abs(p[0] - v))[:k]
            far = max(max(abs(x - v) for x, _ in near), 1e-12)
            w = [(1 - min(1, abs(x - v) / far) ** 3) ** 3 for x, _ in near]
            sw, mx, my = sum(w), sum(a * x for a, (x, _) in zip(w, near)), sum(a * y for a, (_, y) in zip(w, near))
            var = sum(a * x * x for a, (x, _) in zip(w, near)) - mx * mx / sw
            slope = (sum(a * x * y for a, (x, y) in zip(w, near)) - mx * my / sw) / var if var > 1e-12 else 0.0
            out.append((g, v, own, round((my + slope * (v * sw - mx)) / sw, 6)))
    return sorted(out)


def test_lowess_is_that_of_all_rows(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [("many", float(rnd.randrange(12)), float(rnd.randrange(50))) for _ in range(150)]
    rows += [("one", 4.0, float(k * k)) for k in range(7)] + [("heavy", 4.0, float(k * k % 17)) for k in range(9)] + [("heavy", 5.0, 3.0), ("single", 1.0, 2.0)]
    rows += [("free", rnd.random() * 9, rnd.random()) for _ in range(60)]
    monkeypatch.setattr(S, "LOWESS_POINTS", 5)
    got = S.lowess(spark.createDataFrame(rows, "g string, a double, b double"), "a", "b", "g").collect()
    assert sorted((r.grp, r.x, r.y, round(r.smooth, 6)) for r in got) == whole_lowess(rows)


def test_lowess_of_a_large_group_takes_a_task_for_each_thousand_points(spark):
    df = spark.range(200_000).select(F.lit("g").alias("g"), (F.col("id") % 50).alias("a"), (F.col("id") % 7919).alias("b"))
    began = time.time()
    assert S.lowess(df, "a", "b", "g").groupBy("x").agg(F.count_distinct("smooth").alias("n")).filter("n = 1").count() == 50
    assert time.time() - began < 60  # row against row is 40,000 million weights


def test_yates_and_cramer(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5
    r = S.chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    n, ad, bc = 65, 10 * 5, 20 * 30
    assert math.isclose(r.chi2, n * (ad - bc) ** 2 / (30 * 35 * 40 * 25), rel_tol=1e-9)
    assert math.isclose(r.chi2_yates, n * (abs(ad - bc) - n / 2) ** 2 / (30 * 35 * 40 * 25), rel_tol=1e-9)
