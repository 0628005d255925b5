"""Titles of inner documents: each source of a title is a column, and the first one that holds wins.

Lines are classified once (``flagged``), so the title rules work on flags; the steps are separate projections, which
keeps the expressions that Catalyst sees small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .jsregex import capture, first, index_of, matches, normal_spaces, trim
from .lines import ends_sentence, is_author_only, is_cover, is_formatted_title, is_generic, is_heading, is_lead_candidate, is_specific_heading, is_title_candidate
from .text import part_line


def flagged(paragraphs: Column) -> Column:
    """Paragraph structs as structs of text and flags."""
    return F.transform(paragraphs, lambda p: F.struct(
        p["text"].alias("text"), part_line(p["text"]).alias("part"), is_heading(p["text"]).alias("heading"), is_specific_heading(p["text"]).alias("specific"),
        is_title_candidate(p["text"]).alias("candidate"), is_author_only(p["text"]).alias("author"), is_cover(p["text"]).alias("cover"), is_generic(p["text"]).alias("generic"),
        is_lead_candidate(p["text"]).alias("lead"), is_formatted_title(p).alias("formatted"), ends_sentence(trim(p["text"])).alias("closed"),
        matches(trim(p["text"]), r"^[«\"„]?[а-яё]", "u").alias("lower"), matches(trim(p["text"]), r"^[а-яё]", "u").alias("bare_lower"), capture(p["text"], fixed.QUOTED, 1, "u").alias("quoted"),
    ))


def _with_part(title: Column, part: Column) -> Column:
    return F.concat(title, F.lit(" ("), part, F.lit(")"))


def _at(a: str, i: Column | int) -> Column:
    return F.get(F.col(a), F.lit(i) if isinstance(i, int) else i)


def _goes_on(closed: Column, following: Column) -> Column:
    """A title that is not closed goes on with a candidate line in lower case."""
    return F.coalesce(~closed & following["lower"] & following["candidate"], F.lit(False))


def _heading_with_next(heading: Column, following: Column) -> Column:
    more = following["part"].isNull() & ~following["author"] & ~following["cover"] & _goes_on(heading["closed"], following)
    return normal_spaces(F.when(F.coalesce(more, F.lit(False)), F.concat_ws(" ", heading["text"], following["text"])).otherwise(heading["text"]))


#: Sources in order of precedence.
SOURCES = ["heading_part", "body_part", "formatted", "course_part", "quoted", "header", "heading", "lead", "footer_quoted", "any_heading"]


def with_title(df: DataFrame, header: str, body: str, footer: str, title: str = "documentTitle", source: str = "titleSource") -> DataFrame:
    """Add the title and the name of its source; ``header``, ``body``, ``footer`` are columns of paragraph structs."""
    kept = df.columns
    out = df.withColumns({"_h": flagged(F.col(header)), "_b": flagged(F.col(body)), "_f": flagged(F.col(footer))})
    out = out.withColumns({
        "_hp": first(F.col("_h"), lambda x: x["part"].isNotNull())["part"], "_bp": first(F.col("_b"), lambda x: x["part"].isNotNull())["part"],
        "_hi": index_of(F.col("_h"), lambda x: x["heading"]), "_si": index_of(F.col("_h"), lambda x: x["specific"]),
        "_cand": F.filter("_h", lambda x: x["candidate"]), "_near": F.concat("_h", F.slice("_b", 1, 6)),
        "_fq": first(F.col("_f"), lambda x: x["quoted"].isNotNull())["quoted"],
    })
    out = out.withColumns({
        "_part": F.coalesce("_hp", "_bp"), "_fi": index_of(F.col("_near"), lambda x: x["formatted"]), "_quoted": first(F.col("_cand"), lambda x: x["quoted"].isNotNull())["quoted"],
        "_lead1": _at("_b", 0), "_lead2": _at("_b", 1), "_c1": _at("_cand", 0), "_c2": _at("_cand", 1), "_heading": _at("_h", F.col("_hi")), "_next": _at("_h", F.col("_hi") + 1),
        "_special": _at("_h", F.col("_si")), "_after": _at("_h", F.col("_si") + 1),
    })
    out = out.withColumns({"_n1": _at("_near", F.col("_fi")), "_n2": _at("_near", F.col("_fi") + 1), "_n3": _at("_near", F.col("_fi") + 2)})
    two = F.coalesce(F.col("_n2.formatted") & _goes_on(F.col("_n1.closed"), F.col("_n2")), F.lit(False))
    three = two & F.coalesce(F.col("_n3.formatted") & _goes_on(F.col("_n2.closed"), F.col("_n3")), F.lit(False))
    pair = F.coalesce(F.col("_c2.bare_lower"), F.lit(False))
    joined = F.when(pair, F.concat_ws(" ", "_c1.text", "_c2.text")).otherwise(F.col("_c1.text"))
    out = out.withColumns({"_joined": joined, "_open": ~F.when(pair, F.col("_c2.closed")).otherwise(F.col("_c1.closed")), "_two": two, "_three": three})
    out = out.withColumn("_full", F.when(F.coalesce(_goes_on(~F.col("_open"), F.col("_lead1")), F.lit(False)), normal_spaces(F.concat_ws(" ", "_joined", "_lead1.text"))).otherwise(F.col("_joined")))
    quoted = normal_spaces(F.col("_quoted"))
    found = {
        "heading_part": F.when(F.col("_part").isNotNull() & F.col("_special").isNotNull(), _with_part(_heading_with_next(F.col("_special"), F.col("_after")), F.col("_part"))),
        "body_part": F.when(F.col("_special").isNull() & F.col("_lead1.part").isNotNull() & F.col("_lead2.candidate") & (F.length("_lead2.text") > 0), _with_part(normal_spaces(F.col("_lead2.text")), F.col("_lead1.part"))),
        "formatted": F.when(F.col("_n1").isNotNull(), normal_spaces(F.concat_ws(" ", F.col("_n1.text"), F.when(F.col("_two"), F.col("_n2.text")), F.when(F.col("_three"), F.col("_n3.text"))))),
        "course_part": F.when(F.col("_hp").isNotNull() & matches(F.col("_heading.text"), r"^(Курс\s+лекций|Семинар|Учения)"), _with_part(normal_spaces(F.col("_heading.text")), F.col("_hp"))),
        "quoted": F.when(F.col("_quoted").isNotNull() & ~is_generic(F.col("_quoted")), F.when(F.col("_part").isNotNull(), _with_part(quoted, F.col("_part"))).otherwise(quoted)),
        "header": F.when((F.length("_full") > 0) & ~is_generic(F.col("_full")), normal_spaces(F.col("_full"))),
        "heading": F.when(F.col("_heading.specific"), _heading_with_next(F.col("_heading"), F.col("_next"))),
        "lead": first(F.slice("_b", 1, 6), lambda x: x["lead"])["text"],
        "footer_quoted": F.when(F.col("_fq").isNotNull() & ~is_generic(F.col("_fq")), normal_spaces(F.col("_fq"))),
        "any_heading": F.when(~F.col("_heading.generic"), normal_spaces(F.col("_heading.text"))),
    }
    out = out.withColumns({f"_t_{name}": found[name] for name in SOURCES})
    return out.select(
        *[F.col(f"`{c}`") for c in kept if c not in (title, source)], F.coalesce(*[f"_t_{s}" for s in SOURCES]).alias(title),
        F.coalesce(*[F.when(F.col(f"_t_{s}").isNotNull(), F.lit(s)) for s in SOURCES]).alias(source),
    )
