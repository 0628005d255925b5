"""Paragraphs: the query as its SQL on odd texts, the rule on breaks and white space."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scriptoria.functions import text

#: Text and lines that are not blank.
ODD = [
    (None, None), ("", 0), ("   ", 0), ("\n\n\n", 0), ("a\nb", 2), ("a\n\nb\n\n\n\nc\n", 3), ("\na\r\n\r\nb\r\n", 3), ("a\n\t\nb", 3), (" \n\u00a0\u1680\n\u2007 \u3000\n\u202f\u205fa", 1),
    ("\u2028\n\u200b\n\ufeff\n\x1c\n\x0b\n\x0c", 6), ("\U0001f600\n \n\U0001f600", 2), (" " * 5000 + "\nа", 1),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_query_on_odd_texts(spark, tmp_path, ansi):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ODD)], "doc_id long, text string").write.parquet(path)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = entry.queries()["paragraph_split"](spark, str(tmp_path))
        got = sorted((r["doc_id"], r["n"], r["blocks"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{path}/*.parquet'")
    assert got == sorted(duck.execute(entry.oracle_sql()["paragraph_split"]).fetchall())
    assert [n for _, n, _ in got] == [n for _, n in ODD]


def test_blank_characters_are_those_of_the_sql(spark, tmp_path):
    """Every character of the basic plane on a line of its own."""
    path = f"{tmp_path}/documents.parquet"
    chars = [i for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    spark.createDataFrame([(i, chr(i)) for i in chars], "doc_id long, text string").write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{path}/*.parquet'")
    blank = {r[0] for r in duck.execute(f"select doc_id from ({entry.oracle_sql()['paragraph_split']}) where n = 0").fetchall()}
    assert {r["doc_id"] for r in entry.queries()["paragraph_split"](spark, str(tmp_path)).where("n = 0").collect()} == blank


def test_paragraphs_between_blank_lines(spark):
    rows = [(None, None), ("", []), (" \n\t\n\n\u00a0\ufeff\r\n\n", []), ("a\nb\n\n\nc", ["a\nb", "c"]), ("\n\n a \n\n\u2028\n\nb\n", [" a ", "b\n"]), ("a\n\n\u200b", ["a", "\u200b"])]
    made = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, x string").select("i", text.split_paragraphs(F.col("x")).alias("p"))
    assert [r["p"] for r in sorted(made.collect())] == [p for _, p in rows]
