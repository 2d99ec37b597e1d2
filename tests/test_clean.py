import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.clean import clean, clean_and_filter, min_length, strip_marks

CASES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("Hello, World!!", "hello world"),
    ("don't stop", "dont stop"),
    ("snake_case (x)", "snake_case x"),
    ("a\t\tb\n c", "a b c"),
    ("<br /><br />Great", "br br great"),
    ("café ÉTÉ", "café été"),
    ("ét", "et"),
    ("½ ² Ⅷ", "½ ² ⅷ"),
    ("x y", "x y"),
    ("x\u0085y", "x y"),
    ("a​b", "ab"),
    ("日本語、テスト。", "日本語テスト"),
    ("123-45-6789", "123456789"),
    ("1234567890", "1234567890"),
    ("ΟΔΟΣ ΣΑΣ", "οδος σας"),
    ("a\x00b\x07c", "abc"),
]


def expected(text):
    """The cleaning rule in the standard library, as a brute-force check."""
    kept = "".join(c for c in text or "" if c.isalnum() or c == "_" or c.isspace())
    return " ".join(kept.lower().split())


@pytest.mark.parametrize("text,want", CASES)
def test_fixture_agrees_with_brute_force(text, want):
    assert expected(text) == want


def test_cases(spark):
    frame = spark.createDataFrame(list(enumerate(t for t, _ in CASES)), "i int, text string")
    got = {r.i: r.text for r in frame.select("i", clean(F.col("text")).alias("text")).collect()}
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES]


def test_every_code_point(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    frame = spark.createDataFrame(pd.DataFrame({"cp": points, "text": [f"x{chr(c)}y" for c in points]}))
    got = frame.select("cp", clean(F.col("text")).alias("c"), strip_marks(F.col("text")).alias("s")).toPandas()
    wrong = [hex(cp) for cp, text in zip(got.cp, got.c) if text != expected(f"x{chr(cp)}y")]
    assert wrong == []
    strip = re.compile(r"[^\w\s]")
    wrong = [hex(cp) for cp, text in zip(got.cp, got.s) if text != strip.sub("", f"x{chr(cp)}y")]
    assert wrong == []


def test_filter_counts_cleaned_characters(spark):
    frame = spark.createDataFrame(list(enumerate(t for t, _ in CASES)), "i int, text string")
    kept = {r.i for r in clean_and_filter(frame).collect()}
    assert kept == {i for i, (_, want) in enumerate(CASES) if len(want) >= 10}
    raw = {r.i for r in min_length(frame).collect()}
    assert raw == {i for i, (text, _) in enumerate(CASES) if text is not None and len(text) >= 10}


def test_text_is_cleaned_once(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = clean_and_filter(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("translate(") == 1
