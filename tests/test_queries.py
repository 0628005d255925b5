"""Every registered query of the engine against DuckDB on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]


def plain(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float) and value == int(value):
        return int(value)
    return value


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"create view {t[:-8]} as select * from '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in entry.oracle_sql():
        assert rows
        return
    cursor = duck.execute(entry.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    assert rows == sorted(repr(tuple(plain(r[found.index(c)]) for c in columns)) for r in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["slug", "siteYear", "month_label", "children", "n"]


def test_plan_prunes_and_pushes(spark):
    plan = entry.queries()["catalog_filtered_children"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    orders, lines = ([x for x in scans if f"{t}.parquet" in x] for t in ("orders", "lineitem"))
    assert orders and lines and all("o_totalprice" not in x for x in orders) and all("l_comment" not in x for x in lines)
    # the year is taken from a date column, so its filter stands on the scan; the chosen containers' keys reach the lines before they are nested
    assert plan.index("LeftSemi") > plan.index("collect_list")


def test_no_cartesian_in_evidence(spark):
    plan = entry.queries()["evidence_contains"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_evidence_of_short_and_long_claims(spark):
    from scriptoria.operators.evidence import claims_in_texts

    texts = ["the quick brown fox jumps over it", "quickly now", "a b  c", "foxes and the quick", "", None, "x the  quick", "jumps over"]
    claims = ["quick", "the quick", "quick brown fox", "e quick brown fox jumps ov", "quick brown fox jumps over it", "fox", "b  c", "a b", " ", "", None, "q", "ow", "the  q", "k br", "brown fox j", "over it.", "zzz"]
    c = spark.createDataFrame([(i, x) for i, x in enumerate(claims)], "ck int, c string")
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "tk int, t string")
    got = {(r["ck"], r["tk"]) for r in claims_in_texts(c, t, "ck", "c", "tk", "t").collect()}
    assert got == {(i, j) for i, x in enumerate(claims) for j, y in enumerate(texts) if x and x.strip() and y and x in y}


def test_evidence_in_a_very_long_word(spark):
    import random

    from scriptoria.operators.evidence import claims_in_texts

    draw = random.Random(3)
    token = "".join(draw.choice("abcdefgh0123+/") for _ in range(200_000))
    texts = [f"head {token} tail", token[50_000:50_040], "short words only", token[:15] + " " + token[16:40]]
    claims = [token[i : i + n] for i, n in ((0, 15), (1, 16), (14, 17), (15, 31), (16, 2), (31, 40), (99_999, 64), (199_990, 10), (50_010, 20))] + ["zz" + token[:20], token[10:20] + "zz", f"d {token[:9]}", f"{token[-9:]} t"]
    c = spark.createDataFrame(list(enumerate(claims)), "ck int, c string")
    t = spark.createDataFrame(list(enumerate(texts)), "tk int, t string")
    got = {(r["ck"], r["tk"]) for r in claims_in_texts(c, t, "ck", "c", "tk", "t").collect()}
    assert got == {(i, j) for i, x in enumerate(claims) for j, y in enumerate(texts) if x in y}
