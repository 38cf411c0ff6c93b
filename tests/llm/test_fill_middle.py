"""Fill in the middle against a plain version, and the exact way back."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from retailmart.llm import fill_middle as fm
from retailmart.llm.fill_middle import fill_in_middle, restored


def brute(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def check(df):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    out = fill_in_middle(df)
    assert found(out) == sorted((brute(*d) for d in docs), key=str)
    back = restored(out).select("doc_id", "text")
    assert found(back) == sorted(((d, t or "") for d, t in docs), key=str)


def test_odd_documents(messy, no_docs):
    check(messy)
    assert restored(fill_in_middle(no_docs)).collect() == []


def test_given_documents(sample):
    check(sample)


@pytest.mark.parametrize("window", [1, 7, 1 << 20])
def test_any_window_gives_the_same(spark, monkeypatch, window):
    rng = random.Random(window)
    monkeypatch.setattr(fm, "WINDOW", window)
    monkeypatch.setattr(fm.CodePoints, "BLOCK", 5)
    pieces = ["<", "<P", "<P>", "S>", "M", ">", "é", "漢", "😀", "a", " ", "\n"]
    docs = [(k, "".join(rng.choice(pieces[:2] + pieces[3:]) for _ in range(rng.randrange(0, 30)))) for k in range(150)]
    docs += [(200 + k, "".join(rng.choice(pieces) for _ in range(9))) for k in range(30)] + [(300, "<"), (301, "P><P>")]
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))


def test_a_marker_over_two_texts_is_none(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["x<", "P>y", "<P", ">"] * 10)], "doc_id long, text string")
    check(df.coalesce(1))


def test_all_forms_and_shares(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text of a document").alias("text"))
    n = {r["form"]: r["count"] for r in fill_in_middle(docs).groupBy("form").count().collect()}
    assert 320 < n["plain"] < 480 and 0.17 < n["spm"] / (n["spm"] + n["psm"]) < 0.23


def test_way_back_reads_form_and_output_only(spark):
    rows = [("psm", "<P>ab<S>ef<M>cd"), ("spm", "<S>ef<P>ab<M>cd"), ("plain", "<P>x<S>"), ("psm", "<P><S><M>abc"), ("spm", "<S><P><M>")]
    back = restored(spark.createDataFrame(rows, "form string, output string"))
    assert [r.text for r in back.collect()] == ["abcdef", "abcdef", "<P>x<S>", "abc", ""]
    assert back.columns == ["form", "output", "text"]


def test_no_shuffle(sample):
    plan = restored(fill_in_middle(sample))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
