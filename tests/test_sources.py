"""Sources, sinks and the stream, each written to and read from files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import entities as E
from scriptorium.operators import lexicon as L
from scriptorium.sources import readers as R
from scriptorium.sources import writers as W
from scriptorium.streaming import normalise


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_texts_in_either_encoding(spark, tmp_path):
    put(tmp_path / "t/a.txt", "été\n\nfin")
    put(tmp_path / "t/b.txt", "été".encode("latin-1"))
    put(tmp_path / "t/c.txt", "")
    read = lambda **k: {os.path.basename(r.path): r.text for r in R.texts(spark, str(tmp_path / "t"), **k).collect()}
    assert read() == {"a.txt": "été\n\nfin", "b.txt": "été"}
    assert read(utf8_only=True)["b.txt"] is None


def test_lists(spark, tmp_path):
    lexicon = put(tmp_path / "lexicon.txt", " maison \n\nmaison\nété\nété\n")
    assert {r.form for r in R.lexicon(spark, lexicon).collect()} == {"maison", "été"}
    short = put(tmp_path / "short.txt", "# all\nM. # title\n\n Dr \n")
    assert [r.abbreviation for r in R.abbreviation_list(spark, short).collect()] == ["M.", "Dr"]


def test_tables(spark, tmp_path):
    tsv = put(tmp_path / "d.tsv", "﻿mot\tdecision\nledroit\ty\n")
    df = R.tsv(spark, tsv)
    assert df.columns == ["mot", "decision"] and df.first().mot == "ledroit"
    csv = put(tmp_path / "d.csv", "a;b\n1;x\n2;\n")
    assert R.csv(spark, csv, ";").dtypes[0] == ("a", "int") and R.csv(spark, csv, ";", "a string, b string").first().a == "1"


def test_excel(spark, tmp_path):
    pytest.importorskip("openpyxl")
    import pandas as pd

    pd.DataFrame({"a": [1, 2]}).to_excel(tmp_path / "d.xlsx", index=False)
    assert R.excel(spark, str(tmp_path / "d.xlsx")).count() == 2


def test_nested_json(spark, tmp_path):
    blocks = [{"id": "b1", "text": "Le Extradé"}, {"id": "b2", "text": "rien"}]
    doc = {"processes": [], "documents": [{"id": "d", "publication_date": "1870", "publication_title": "J", "pages": [{"id": "p", "blocks": blocks}, {"id": "q"}]}, {"id": "e", "pages": None}]}
    put(tmp_path / "j/x/a.json", json.dumps(doc, ensure_ascii=False))
    put(tmp_path / "j/b.json", json.dumps(doc, ensure_ascii=False))
    put(tmp_path / "j/c.txt", "no")
    df = R.json(spark, str(tmp_path / "j"), R.PRESS, recursive=True)
    assert df.count() == 2
    got = R.press_blocks(df).collect()
    assert len(got) == 4 and {r.page_id for r in got} == {"p"}
    assert [r.texte for r in R.press_blocks(df, "EXTRAD").distinct().collect()] == ["Le Extradé"]


def test_geojson(spark, tmp_path):
    at = put(tmp_path / "g.json", json.dumps({"type": "FeatureCollection", "features": [{"properties": {"dep": "75"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]}))
    row = R.geojson(spark, at).first()
    assert row.dep == "75" and json.loads(row.geometry)["type"] == "Point"


def test_earlier_output_and_options(spark, tmp_path, monkeypatch):
    assert R.earlier_output(spark, str(tmp_path / "none"), "a int").count() == 0
    at = put(tmp_path / "e/x.json", '{"a": 1}\nnot json\n{"a": 2}\n')
    assert {r.a for r in R.earlier_output(spark, at, "a int").collect()} == {1, 2}
    monkeypatch.setenv("SCRIPTORIUM_MIN_SCORE", "90")
    assert R.Options.from_environment() == R.Options(min_score=90.0)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(3, "ccc"), (1, "é"), (2, "bb")], "pos long, word string")
    W.text(df, str(tmp_path / "text"), "word")
    assert {r.value for r in spark.read.text(str(tmp_path / "text")).collect()} == {"ccc", "é", "bb"}
    W.tsv(df, str(tmp_path / "tsv"), [F.desc("pos")], 2)
    assert {r.word for r in R.tsv(spark, str(tmp_path / "tsv")).collect()} == {"ccc", "bb"}
    assert [(r.word, r.jugement) for r in W.judged_sample(df, 2).collect()] == [("é", ""), ("bb", "")]
    first, second = (W.model(df, str(tmp_path / "model"), v) for v in (1, 2))
    assert first != second and spark.read.json(second).count() == 3
    W.records(df, str(tmp_path / "records"))
    assert '{"pos":1,"word":"é"}' in {r.value for r in spark.read.text(str(tmp_path / "records")).collect()}
    assert W.structure(df, df, df, str(tmp_path / "volume"), dry_run=True).keys() == {"pages", "toc", "sections"} and not (tmp_path / "volume").exists()
    W.structure(df, df, df, str(tmp_path / "volume"))
    assert spark.read.parquet(str(tmp_path / "volume/toc")).count() == 3


def test_stream(spark, tmp_path):
    schema = "doc_id long, text string"
    rows = [(1, "l’étude — 3me"), (2, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    run = lambda: normalise.to_parquet(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    run()
    spark.createDataFrame([(3, "5ème")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    run()  # goes on from the checkpoint
    got = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "l'étude - 3e", 2: None, 3: "5e"}


def test_replacement_by_join_equals_the_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Le Droit, le  droit"), (1, "x"), (None, "droit"), (4, ""), (5, None)], "doc_id long, text string")
    mapping = spark.createDataFrame([("droit", "DROIT"), ("le", "la")], "old string, new string")
    said = lambda x: sorted(map(str, (r.text for r in x.collect())))
    want = sorted(["la Droit, la  DROIT", "x", "DROIT", "", "None"])
    assert said(L.apply_map(df, mapping)) == want
    model = said(L.learned_corrections(df, mapping))
    assert "Le Droit, la  DROIT" in model
    monkeypatch.setattr(L, "MAP_ROWS", 1)
    assert said(L.apply_map(df, mapping)) == want and said(L.learned_corrections(df, mapping)) == model


def test_decisions_and_gate(spark):
    rows = spark.createDataFrame([("a", "1", "y", "", 1), ("a", "1", "n", "", 2), ("b", "2", "corr", "z", 3), ("c", "3", "", "", 4)], "word string, suggestion string, decision string, correction string, line int")
    said = {r.word: (r.verdict, r.result) for r in L.decisions(rows).collect()}
    assert said == {"a": ("refuse", None), "b": ("correct", "z"), "c": ("open", None)}
    split = spark.createDataFrame([(w, w, "x", 1) for w in "abcd"], "word string, first string, rest string, place int")
    assert {r.old: r.new for r in L.proposals(split, L.decisions(rows)).collect()} == {"b": "z", "c": "c x", "d": "d x"}
    near = spark.createDataFrame([("p", "q", 1), ("r", "s", 2)], "word string, correction string, distance int")
    assert [r.regime for r in L.gated(near).orderBy("word").collect()] == ["auto", "review"]
    assert L.refusal_tally(spark.createDataFrame([("lecteurs",), ("donc",)], "word string")).first() == (1, 1)


def test_details_have_lines_and_context(spark):
    df = spark.createDataFrame([("aé\nT. Il, p\nIl",), (None,)], "t string")
    got = [[tuple(x) for x in r.d] for r in df.select(T.details(F.col("t"), "Il", 3).alias("d")).collect()]
    assert got == [[(6, 2, "Il", "T. Il, p"[0:3] + "Il" + ", p"), (12, 3, "Il", " p\nIl")], []]


def test_verifier_is_asked_again(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "bad")], "section_id long, raw_text string")

    def ask(prompt):
        if "bad" in prompt:
            raise ValueError("no")
        return prompt

    got = {r.section_id: (r.response, r.error) for r in E.verified(df, ask, "Check", most_words=2).collect()}
    assert got == {"1": ("Check\n\none two", None), "2": (None, "ValueError: no")}
    calls = []
    assert E.retried(lambda p: calls.append(p) or 1 / 0)("x")[1].startswith("ZeroDivisionError") and len(calls) == 3
