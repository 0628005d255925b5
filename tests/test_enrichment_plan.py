"""The rules of titles and authors name their input once, and the enrichment split deals its rows out and makes them in one pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scriptoria.functions import authors, jsregex, lines, text
from scriptoria.operators import normalize

SF = "/root/testdata/sf0.001"
RULES = {
    "text_or_null": jsregex.text_or_null, "normal_author": authors.normal_author, "author_of_publication": authors.author_of_publication, "nominative": authors.nominative, "roman_parts": text.roman_parts,
    "part_line": text.part_line, "roman": text.roman, "normal_title": lambda x: normalize.normal_title(x, F.lit("Марк Л. Профет")), "without_author": lambda x: normalize.without_author(x, F.lit("Марк Л. Профет")),
}


@pytest.mark.parametrize("name", RULES)
def test_rule_names_its_input_once(spark, name):
    """Rules are nested, so an input named n times at each of k levels is worked out n ** k times."""
    assert str(RULES[name](F.col("theInput"))).count("theInput") == 1


def test_split_has_a_small_plan_in_one_pass(spark):
    df = entry.queries()["needs_enrichment_split"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("regexp_replace(") < 150
    assert len(df.inputFiles()) >= spark.sparkContext.defaultParallelism  # one file of one row group would be one task


def test_rules_on_odd_texts(spark):
    rows = [
        (None, None, None, False, None), ("", None, "", False, None), ("   ﻿", None, "   ﻿", False, None), (" аᙿĀ б　", "аᙿĀ б", " аᙿĀ б　", False, None),
        ("О (часть  03) и (ЧАСТЬ 12)", "О (часть  03) и (ЧАСТЬ 12)".replace("  ", " "), "О (Часть III) и (Часть 12)", False, None), ("(часть 1)", "(часть 1)", "(Часть I)", False, "Часть I"),
        ("через Марка", "через Марка", "через Марка", True, None), ("Призыв", "Призыв", "Призыв", True, None), ("часть  0 7 ", "часть 0 7", "часть  0 7 ", False, "Часть VII"), ("часть ab", "часть ab", "часть ab", False, None),
    ]
    made = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, x string").select(
        "i", jsregex.text_or_null(F.col("x")), text.roman_parts(F.col("x")), lines.any_of(F.col("x"), [r"^призыв$", r"^через\s+"]), text.part_line(F.col("x"), as_roman=True))
    assert [tuple(r)[1:] for r in sorted(made.collect())] == [r[1:] for r in rows]
