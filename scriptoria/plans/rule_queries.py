"""Single rules over texts made from the orders' keys and dates; each oracle applies the rule to the same rows in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import authors, dates, labels, lines, publication, text
from scriptoria.functions.jsregex import text_or_null
from scriptoria.operators import archive, exports, normalize, segment

from .registering import query
from .roles import table

# Names of the months and roman numerals, as the rules' results spell them.
_NAMES = "['Январь','Февраль','Март','Апрель','Май','Июнь','Июль','Август','Сентябрь','Октябрь','Ноябрь','Декабрь']"
_GENITIVES = "['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря']"
_ROMAN = "['I','II','III','IV','V','VI','VII','VIII','IX','X']"
#: Key, year, month, quarter, day and English month name of every order.
_ORDERS = "o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, quarter(o_orderdate)::INT AS q, day(o_orderdate)::INT AS d, strftime(o_orderdate, '%B') AS english FROM orders)"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.year(day).alias("y"), F.month(day).alias("m"), F.quarter(day).alias("q"), F.dayofmonth(day).alias("d"), F.date_format(day, "MMMM").alias("english"))


def _rule(name: str, made: str, rule: Callable[[Column], Column], want: str, kind: str = "VARCHAR") -> None:
    """Query ``name``: k, x, out.  Both engines make the input x from the same expression; ``want`` is the rule in SQL."""
    as_type = {"VARCHAR": "string", "INT": "int", "BOOLEAN": "boolean", "DOUBLE": "double"}[kind]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _orders(spark, sf_dir).withColumn("x", F.expr(made))
        return rows.select("k", "x", rule(F.col("x")).cast(as_type).alias("out"))

    run.__name__ = name
    query(f"WITH {_ORDERS}, i AS (SELECT *, {made} AS x FROM o) SELECT k, x, ({want})::{kind} AS out FROM i")(run)


def _pick(options: list[str], by: str) -> str:
    """One of some SQL expressions by a key: a CASE that both dialects have."""
    whens = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(options[:-1]))
    return f"(CASE {by} % {len(options)} {whens} ELSE {options[-1]} END)"


def _month(names: str) -> str:
    return "(CASE m " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(names.strip("[]").split(","), 1)) + " END)"


_S = "cast({} as string)"
_K, _Y, _M, _Q, _D = (_S.format(c) for c in "kymqd")

_rule("fn_text_or_null", _pick([f"concat('  a   ', {_Y}, ' b ')", "'   '", "cast(null as string)", f"concat('x', {_K})"], "k"), text_or_null, r"nullif(trim(regexp_replace(x, '\s+', ' ', 'g')), '')")
_rule("fn_tight_punctuation", f"concat('a , b ', {_pick([repr(c) for c in ',.!?;:-'], 'k')})", text.tight_punctuation, r"replace(regexp_replace(x, '\s+([,.!?;:])', '\1', 'g'), ' -', ' -')")
_rule("fn_year_spaces", _pick([f"concat('год ', substr({_Y}, 1, 1), ' ', substr({_Y}, 2, 2), '  ', substr({_Y}, 4, 1), ' г')", f"concat('год', {_Y}, 'год')", f"concat(substr({_Y}, 1, 3), ' ', substr({_Y}, 4, 1))"], "k"),
      text.year_spaces_closed, "CASE k % 3 WHEN 0 THEN 'год ' || y || ' г' WHEN 1 THEN 'год' || y || 'год' ELSE y::VARCHAR END")
_rule("fn_path_key", f"concat('ТретиЙ/Файл', {_K}, '.DOC')", text.path_key, "lower(nfc_normalize(x))")
_rule("fn_path_parts", _pick([f"concat('a/b', {_K}, '/c.tar.GZ')", f"concat('x', {_K})", "'d/.hid'", f"concat('p/', {_Y}, '.DOCX')"], "k"),
      lambda x: F.concat_ws("|", text.dirname(x), text.basename(x), text.stem(x), text.extension(x)),
      "SELECT dir || '|' || b || '|' || left(b, length(b) - length(e)) || '|' || lower(e) FROM (SELECT array_to_string(string_split(x, '/')[:-2], '/') AS dir, string_split(x, '/')[-1] AS b, CASE WHEN b LIKE '_%.%' THEN '.' || string_split(b, '.')[-1] ELSE '' END AS e)")
_rule("fn_swapped_doc", f"concat('a', {_K}, {_pick([repr('.doc'), repr('.docx'), repr('.pdf')], 'k')})", text.swapped_doc, "CASE WHEN ends_with(x, '.docx') THEN left(x, length(x) - 1) WHEN ends_with(x, '.doc') THEN x || 'x' END")
_rule("fn_short_digest", f"concat('a', {_K})", text.short_digest, "left(sha1(x), 12)")
_rule("fn_page_description", f"repeat(concat('word ', {_Y}, ' '), cast(k % 40 as int))", lambda x: text.page_description(F.array(x, x)), "left(x || ' ' || x, 160)")
_rule("fn_month_in_text", _pick([f"concat('в ', {_Y}, ' ', {_month(_NAMES)})", f"concat('1 ', {_month(_GENITIVES)}, ', ', {_Y})", f"concat('х', {_month(_GENITIVES)})", f"upper({_month(_GENITIVES)})"], "k"), dates.month_in_text, "CASE WHEN k % 4 <> 2 THEN m END", "INT")
_rule("fn_month_english_folder", f"concat({_Y}, '/', {_pick(['lpad(' + _M + ', 2, ' + repr('0') + ')', _M, repr('')], 'k')}, {_pick([repr('_'), repr(' '), repr('-'), repr('_')], 'k')}, english, '/x')", lambda x: dates.month_of_english_folder(F.split(x, "/")), "CASE WHEN k % 3 <> 2 THEN m END", "INT")
_slug = f"concat({_Y}, 'Q', cast(k % 6 as string), '-', cast(k % 5 as string))"
_valid = "(k % 6 BETWEEN 1 AND 4 AND k % 5 BETWEEN 1 AND 3)"
_rule("fn_month_of_slug", f"concat('x_', {_slug}, '_y')", dates.month_of_slug, f"CASE WHEN {_valid} THEN (k % 6 - 1) * 3 + k % 5 END", "INT")
_rule("fn_month_of_number", f"concat({_pick([repr(''), repr('0')], 'y')}, cast(k % 9 as string), '_x')", lambda x: dates.month_of_number(x, F.lit(2)), "CASE WHEN k % 9 BETWEEN 1 AND 3 THEN 3 + k % 9 WHEN k % 9 BETWEEN 4 AND 6 THEN k % 9 END", "INT")
_rule("fn_month_of_index", "concat('ЖМ 1_кв. ', cast(k % 6 as string), '_a')", lambda x: dates.month_of_index(x, F.lit(3)), "CASE WHEN k % 6 BETWEEN 1 AND 3 THEN 6 + k % 6 END", "INT")
_rule("fn_quarter_segment", _pick(["concat('Q', cast(k % 7 as string))", "concat(cast(k % 7 as string), '-й квартал')", "concat('за ', cast(k % 7 as string), ' квартал года')"], "k"), dates.quarter_of_segment, "CASE WHEN k % 7 BETWEEN 1 AND 4 THEN k % 7 END", "INT")
_rule("fn_year_in_path", _pick([f"concat('a/', {_Y}, '/b')", f"concat({_Y}, '/b')", f"concat('x', {_Y}, '/b')", f"concat('a/', {_Y})", "'a/1899/b'"], "k"), dates.year_in_path, "CASE WHEN k % 5 IN (0, 1, 3) THEN y END", "INT")
_rule("fn_year_guard", "cast(k % 4000 as int)", dates.plausible_year, "CASE WHEN k % 4000 BETWEEN 1000 AND 2999 THEN k % 4000 END", "INT")
_rule("fn_positive_guard", "cast(k % 5 - 2 as int)", dates.positive, "CASE WHEN k % 5 > 2 THEN k % 5 - 2 END", "INT")
_rule("fn_numeric_date", f"concat({_D}, '.', {_M}, '.', {_Y})", dates.numeric_date, "strftime(day, '%d.%m.%Y')")
_rule("fn_site_label", "cast(CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN null ELSE m END as int)", lambda x: dates.site_label(F.lit(None).cast("string"), F.lit(2020), x), f"CASE WHEN x > 0 THEN {_NAMES}[x] || ' 2020' ELSE '2020' END")
_rule("fn_month_label", _pick([f"concat({_month(_NAMES)}, ' 2020')", "'2020'"], "k"), lambda x: dates.month_only_label(x, F.lit(2020), F.lit(1)), f"CASE WHEN k % 2 = 0 THEN {_NAMES}[m] ELSE '2020' END")
_rule("fn_issue_title", _pick([f"concat({_month(_NAMES)}, ' ', {_Y})", "''", "cast(null as string)"], "k"), publication.issue_title, "'Жемчужины Мудрости' || coalesce('. ' || nullif(x, ''), '')")
_rule("fn_creation_label", _pick([f"concat('raw', {_K})", "''", "cast(null as string)"], "k"), lambda x: labels.creation_label(x, F.lit("1970-02-01"), F.lit(1970)), "coalesce(nullif(x, ''), '1970-02-01')")
_rule("fn_display_title", _pick([f"concat('T', {_K})", "cast(null as string)"], "k"), lambda x: labels.display_title(x, F.lit("header")), "coalesce('«' || x || '»', 'header')")
_rule("fn_is_canonical", f"concat('a/', {_slug}, {_pick([repr('.doc'), repr(''), repr(' new.doc')], 'k')})", archive.is_canonical, f"{_valid} AND k % 3 <> 2", "BOOLEAN")
_rule("fn_brochure_number", _slug, exports.brochure_number, f"CASE WHEN {_valid} THEN (k % 6 - 1) * 3 + k % 5 END", "INT")
_rule("fn_detect_format", f"concat('a/', {_pick([repr(c) for c in ('word', 'Архив', 'Печать', 'b', 'pdf-print', 'originals', 'pdf-mailing')], 'k')}, '/x', {_pick([repr(c) for c in ('.pdf', '.doc', '.txt', '.DOCX')], 'k')})",
      lambda x: archive.detect_format(x, text.extension(x)),
      "CASE k % 7 WHEN 0 THEN 'word' WHEN 6 THEN 'pdf-mailing' WHEN 4 THEN 'pdf-print' WHEN 5 THEN 'originals' WHEN 1 THEN 'originals' ELSE CASE WHEN k % 4 = 0 THEN CASE WHEN k % 7 = 2 THEN 'pdf-print' ELSE 'pdf-mailing' END WHEN k % 4 IN (1, 3) THEN 'word' ELSE 'originals' END END")
_rule("fn_page_count", _pick([f"concat('a|', {_D}, '|', {_M})", "'a|b'", f"concat(' ', {_D}, ' ')"], "k"), lambda x: segment.page_count(F.split(x, r"\|")), "CASE k % 3 WHEN 0 THEN greatest(d, m) WHEN 1 THEN 0 ELSE d END", "INT")
_rule("fn_part_line", _pick(["concat('(часть ', cast(k % 15 + 1 as string), ')')", "concat('Часть ', cast(k % 15 + 1 as string))", "'часть'"], "k"), lambda x: F.coalesce(text.part_line(x), F.lit("-")), "CASE WHEN k % 3 = 2 THEN '-' ELSE 'Часть ' || (k % 15 + 1) END")
_rule("fn_part_line_roman", _pick(["concat('(часть ', cast(k % 13 + 1 as string), ')')", "'x'"], "k"), lambda x: text.part_line(x, True), f"CASE WHEN k % 2 = 0 THEN 'Часть ' || coalesce({_ROMAN}[k % 13 + 1], (k % 13 + 1)::VARCHAR) END")
_rule("fn_is_cover", _pick([f"concat({_month(_NAMES)}, ' ', {_Y})", "'Жемчужины Мудрости'", f"concat('Далекий Бог ', {_K})", f"concat({_month(_NAMES)}, ' ', substr({_Y}, 1, 3), ' ', substr({_Y}, 4, 1))"], "k"), lines.is_cover, "k % 4 <> 2", "BOOLEAN")
_rule("fn_ratio", "cast(k % 997 as double) / 997", text.rounded_ratio, "round(x, 3)", "DOUBLE")
_rule("fn_issue_prefix", _pick([f"concat('2019Q2-3 new', {_K})", f"concat('ЖМ ', cast(k % 3 + 1 as string), '_кв. 2_Апрель_x', {_K})", f"concat('other', {_K})"], "k"), lambda x: exports.issue_prefix(x, F.lit("2019Q2-3")), "CASE k % 3 WHEN 0 THEN '2019Q2-3' WHEN 1 THEN 'ЖМ ' || (k % 3 + 1) || '_кв. 2_Апрель' ELSE 'ЖМ 3_кв. 2_' END")
_rule("fn_skipped", _pick([f"concat('a/.git/', {_K})", "'README.md'", "'a/readme.md'", f"concat('b/', {_K}, '.doc')"], "k"), archive.is_skipped, "k % 4 < 2", "BOOLEAN")
_rule("russian_dates", f"concat('была прочитана ', cast(k % 31 + 1 as string), ' ', {_month(_GENITIVES)}, ' ', {_Y}, ' года')", dates.russian_date, "strftime(try_strptime(concat(y, '-', m, '-', k % 31 + 1), '%Y-%m-%d'), '%Y-%m-%d')")
_rule("source_paths", _pick([f"concat('src/', {_Y}, '/Q', {_Q}, '/word/', {_Y}, 'Q', {_Q}, '-', cast((m - 1) % 3 + 1 as string), '.doc')", f"concat('src/', {_Y}, '/Q', {_Q}, '/word/', {_month(_NAMES)}, ' ', {_Y}, '.docx')", "'x/readme.doc'"], "k"),
      lambda x: F.concat_ws("|", *[F.coalesce(dates.source_publication(x)[c].cast("string"), F.lit("-")) for c in ("year", "quarter", "month", "rawLabel")]),
      f"CASE WHEN k % 3 = 2 THEN '-|-|-|-' ELSE concat(y, '|', q, '|', m, '|', lower({_NAMES}[m]), ' ', y) END")


def _cases(name: str, rule: Callable[[Column], Column], pairs: list[tuple[str, str]], kind: str = "VARCHAR") -> None:
    """Query ``name`` with one input expression for each branch of the rule, dealt by key, and what SQL makes of that branch's rows."""
    _rule(name, _pick([made for made, _ in pairs], "k"), rule, _pick([want for _, want in pairs], "k"), kind)


_YES, _NO, _NULL, _NULL_INT = "true", "false", "cast(null as string)", "cast(null as int)"
_NAME, _GENITIVE = _month(_NAMES), _month(_GENITIVES)
_WORDS, _LETTERS = "concat(repeat('слово ', cast(k % 30 as int)), 'конец.')", "repeat('а', cast(k % 300 + 1 as int))"

_cases("fn_without_author", lambda x: normalize.without_author(x, F.lit("Марк Л. Профет")), [
    (f"concat('Проповедь Марка Л. Профета о свете ', {_K})", "'Проповедь о свете ' || k"), (f"concat('Лекция Э. К. Профет о годе ', {_Y}, ' (Часть II )')", "'Лекция о годе ' || y || ' (Часть II)'"),
    (f"concat('Проповедь в праздник ', {_K})", "'Проповедь праздник ' || k"), (f"concat('Учения Элизабет Клэр Профет ', {_K}, ' , конец')", "'Учения ' || k || ', конец'"),
    (f"concat('О свете ( ', {_K}, ' )')", "'О свете (' || k || ')'")])
_cases("fn_ascii_slug", text.ascii_slug, [
    (f"concat('Брошюра № ', {_K})", "'broshyura-' || k"), (f"concat('--', {_K}, '--x--')", "k || '-x'"), (f"concat(repeat('ж', 40), {_K})", "repeat('zh', 24)"), (f"concat('Щи ', {_Y}, '_Ёж')", "'schi-' || y || '-ezh'")])
_cases("fn_year_in_text", dates.year_in_text, [
    (f"concat('в ', {_Y}, ' году')", "y"), (f"concat(substr({_Y}, 1, 3), ' ', substr({_Y}, 4, 1))", "y"), (f"concat('1', {_Y})", _NULL_INT), (f"concat('№0 за ', {_Y}, ', ', {_NAME})", "y"), ("'нет'", _NULL_INT)], "INT")
_rule("fn_iso_date", _pick([f"concat(' ', {_Y}, '-', lpad({_M}, 2, '0'), '-', lpad(cast(k % 35 as string), 2, '0'), ' ')", f"concat({_Y}, '-02-30')", f"concat('18', substr({_Y}, 3, 2), '-01-01')", _NULL, f"concat({_Y}, '-', {_M}, '-01')"], "k"),
      dates.iso_date, r"CASE WHEN regexp_full_match(trim(x), '(19|20)\d{2}-\d{2}-\d{2}') AND try_strptime(trim(x), '%Y-%m-%d') IS NOT NULL THEN trim(x) END")
_cases("fn_clean_author", authors.clean_author, [
    (f"concat('Лекция ', {_K}, ' Э. К. Профет')", "'Элизабет Клэр Профет'"), (f"concat('Проповедь Марка Л. Профета ', {_K})", "'Марк Л. Профет'"), (f"concat('Диктовка Эль Мории ', {_K})", "'Эль Мория ' || k"),
    (f"concat('Том ', {_K}, ' № ', {_M}, ' – Архангела Михаила – ', {_D}, ' ', {_GENITIVE}, ' ', {_Y}, ' г.')", "'Архангел Михаил'"), ("'«»'", _NULL), (_LETTERS, "CASE WHEN length(x) <= 100 THEN x END"),
    (f"concat('Курс лекций Возлюбленного Гелиоса ', {_K}, ' была прочитана')", "'Гелиоса ' || k")])
_cases("fn_normal_author", authors.normal_author, [
    (f"concat('э. к. профет ', {_K})", "'Элизабет Клэр Профет'"), ("'Марка Л. Профета'", "'Марк Л. Профет'"), (f"concat('Эль Мории ', {_K})", _NULL), (f"concat('возлюбленного Архангела Михаила ', {_K})", "'Архангел Михаил ' || k"),
    (f"concat('Господа Майтрейи ', {_K})", "'Господь Майтрейя ' || k"), (f"concat('Кто-то ', {_K}, '.')", _NULL), (_NULL, _NULL)])
_cases("fn_author_of_publication", authors.author_of_publication, [
    (f"concat('Том ', {_K}, ' № ', {_M}, ' – Имя ', {_Y}, ' – ', {_D}, ' ', {_GENITIVE}, ' ', {_Y}, ' г.')", "'Имя ' || y"), (f"concat('Том ', {_K}, ' № ', {_M}, ' – Э. К. Профет – ', {_Y})", _NULL),
    (f"concat('Том ', {_K}, ' – Посланник ', {_Y})", _NULL), (f"concat('Текст ', {_K}, ' – Имя')", _NULL), (f"concat('Том ', {_K})", _NULL)])
_cases("fn_display_author", authors.display_author, [
    ("'Господа Майтрейи'", "'Господь Майтрейя'"), (f"concat('Господа Майтрейи ', {_K})", "x"), ("'возлюбленного Гелиоса'", "'Возлюбленный Гелиос'"), (f"concat('возлюбленный Ланто ', {_K})", "'Возлюбленный Ланто ' || k"),
    ("'  '", _NULL), (f"concat(' A', {_K}, ' ')", "'A' || k")])
_cases("fn_is_heading", lines.is_heading, [
    (f"concat('Лекция «', {_K}, '»')", _YES), (f"concat('Лекционный зал ', {_K})", _NO), (f"concat(' КУРС  лекций ', {_K})", _YES), ("''", _NO), (f"concat('О лекция ', {_K})", _NO), ("'Семинар'", _YES)], "BOOLEAN")
_cases("fn_is_specific_heading", lines.is_specific_heading, [
    ("'Воскресная проповедь'", _NO), ("'Лекция Э.К. Профет'", _NO), (f"concat('Лекция Э.К. Профет ', {_K})", _YES), (f"concat('Лекция о ', {_K})", _YES), (f"concat('x', {_K})", _NO), ("'Лекции Марка Л. Профета'", _NO)], "BOOLEAN")
_cases("fn_is_attribution", lines.is_attribution, [
    (f"concat('Проповедь Марка «', {_K}, '» была прочитана ', {_D}, ' ', {_GENITIVE})", _YES), (f"concat('Диктовка ', {_K}, ' через Посланника')", _YES), (f"concat('Диктовка Эль Мории ', {_K})", _NO), (f"concat('Диктовка была ', {_K})", _NO)], "BOOLEAN")
_cases("fn_is_publication", lines.is_publication, [
    (f"concat('Том ', {_K}, ' № ', {_M})", _YES), (f"concat('том. ', {_K}, ', №', {_M})", _YES), (f"concat('Том № ', {_K})", _NO), (f"concat('x Том ', {_K}, ' № ', {_M})", _NO)], "BOOLEAN")
_cases("fn_is_title_candidate", lines.is_title_candidate, [
    (f"concat('Далекий Бог ', {_K})", _YES), (f"concat('через ', {_K})", _NO), (f"concat('ПРИЗЫВ ', {_K})", _NO), ("repeat('*', cast(k % 5 + 1 as int))", _NO), (f"concat('конец ', {_K}, ',')", _NO), (_WORDS, "k % 30 + 1 <= 18"),
    (f"concat('ретрит ', {_Y})", _NO), (f"concat('Часть ', {_M})", _NO), (f"concat('Лекция ', {_K})", _NO), (f"concat({_NAME}, ' ', {_Y})", _NO), (_LETTERS, "length(x) <= 150")], "BOOLEAN")
_cases("fn_is_weak_title", normalize.is_weak_title, [
    (f"concat('Сегодня утром ', {_K})", _YES), (f"concat('Сегодняшний день ', {_K})", _NO), (f"concat('(часть ', {_M}, ')')", _YES), (_LETTERS, "length(x) > 150"), (f"concat('О свете ', {_K})", _NO), (f"concat('конец ', {_K}, ',')", _YES),
    (_WORDS, "k % 30 + 1 > 18")], "BOOLEAN")
_cases("fn_document_title", lambda x: normalize.normal_title(x, F.lit(None).cast("string")), [
    (f"concat('«Жизнь ', {_K}, '»')", "'Жизнь ' || k"), (f"concat('(часть ', {_M}, ')')", _NULL), ("'Молитва'", _NULL), (f"concat('Лекция «Приливы ', {_K}, '» (часть ', cast(k % 10 + 1 as string), ')')", f"'Лекция «Приливы ' || k || '» (Часть ' || {_ROMAN}[k % 10 + 1] || ')'"),
    (_NULL, _NULL), (f"concat('  О   свете ', {_K}, ' , да')", "'О свете ' || k || ', да'")])
_cases("fn_is_trusted", lambda x: normalize.is_trusted(x, F.concat(F.lit("шапка\nТом "), F.col("k"), F.lit(" № "), F.col("m"), F.lit(" – Кто-то\nконец"))), [
    (f"concat('Том ', {_K}, ' № ', {_M}, ' – Кто-то')", _YES), (f"concat('Том ', {_K}, ' № ', {_M}, '5')", _NO), (f"concat('Том ', {_K}, ' № ', {_M}, '...')", _NO), (_NULL, _NO), ("'Кто-то'", _NO), (f"concat(' Том ', {_K}, '  № ', {_M}, ' ')", _YES)], "BOOLEAN")
_cases("fn_looks_weak", normalize.looks_weak, [(f"concat({_NAME}, ' ', {_Y})", _YES), (f"concat('ПРИЗЫВ ', {_K})", _YES), (_NULL, _YES), (f"concat('О трех царях ', {_K})", _NO)], "BOOLEAN")
_cases("fn_shown_header", lambda x: F.array_join(labels.shown_header(F.array(x, F.lit("Жемчужины Мудрости. Май"), F.concat(F.lit("x"), F.col("k"))), F.concat(F.lit("T"), F.col("y"))), "|"), [
    (f"concat('T', {_Y})", "'x' || k"), (f"concat('a', {_K})", "'a' || k || '|x' || k"), (f"concat('Жемчужины Мудрости ', {_K})", "'x' || k")])
_rule("fn_issue_parts", f"concat(' ', {_Y}, 'Q', {_Q}, '-', cast((m - 1) % 3 + 1 as string), ' ')", lambda x: F.concat_ws("|", *[labels.issue_parts(x)[c].cast("string") for c in ("slug", "year", "quarter")]), "trim(x) || '|' || y || '|' || q")


def _materials(x: Column) -> Column:
    def one(title: Column, master: Column, year: str) -> Column:
        return F.struct(title.alias("title"), master.alias("master"), F.lit("t").alias("type"), F.lit("d").alias("date"), F.lit(year).alias("year"))

    return F.array(one(F.concat(F.lit("Title "), F.col("k")), x, "2011"), one(F.lit("Other"), F.lit("M2"), "2012"))


_rule("fn_material_matches", "concat('M', cast(k % 4 as string))", lambda x: labels.material_matches(_materials(x), "title", "M2"), "k % 4 = 2", "BOOLEAN")
_cases("fn_document_type", publication.document_type, [
    (f"concat('Лекция ', {_K}, chr(10), 'Проповедь')", "'sermon'"), (f"concat('Лекция ', {_K}, ' диктовка')", "'dictation'"), (f"concat('курс  лекций ', {_K})", "'lectureCourse'"), (f"concat('о трех учениях ', {_K})", "'material'"),
    (f"concat('мои учения здесь ', {_K})", "'teaching'"), (f"concat('лекция ', {_K})", "'lecture'"), (f"concat({_K}, chr(10), 'Открывающий  призыв ', chr(10), 'y')", "'prayer'"), (f"concat('открывающий призыв души ', {_K})", "'material'"),
    (f"concat({_K}, chr(10), ' молитва')", "'prayer'")])
_cases("fn_publication_issue", lambda x: publication.publication_line(F.array(F.lit("нет"), x))["issue"], [
    (f"concat('Том ', {_K}, ' № ', {_M}, ', ', {_D}, ' – А – 2 мая 1960 г.')", "m || ', ' || d"), (f"concat('Том ', {_K}, ' №', {_M})", "m::VARCHAR"), (f"concat('№ ', {_K})", _NULL)])
_cases("fn_body_start", lambda x: segment.body_start(F.transform(F.split(x, r"\|"), lambda t: F.struct(t.alias("text")))), [
    (f"concat('a|Лекция ', {_K}, '|b|c|d')", "3"), (f"concat({_NAME}, ' ', {_Y}, '|', repeat('длинный текст ', 5))", "1"), (f"concat('a|b|c|d|e|', {_K})", "4"), ("'a|b'", "2"), (f"concat('Лекция ', {_K}, '|b')", "2"),
    ("concat(repeat('a|', cast(k % 20 as int)), 'Лекция x|b|c|d')", "CASE WHEN k % 20 < 14 THEN k % 20 + 2 ELSE 4 END")], "INT")
_cases("fn_magic", lambda x: archive.has_magic(F.unhex(x), F.when(F.col("y") % 2 == 0, ".doc").otherwise(".docx")), [
    ("concat('D0CF11E0', lpad(cast(k % 100 as string), 2, '0'))", "y % 2 = 0"), ("concat('504B0304', lpad(cast(k % 100 as string), 2, '0'))", "y % 2 = 1"), ("'D0CF'", _NO), ("'504B00'", _NO), (_NULL, _NO)], "BOOLEAN")
_cases("fn_inner_title", lambda x: exports.inner_title(x, F.when(F.col("k") % 3 == 2, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("h"), F.col("k")), F.concat(F.lit("l"), F.col("y"))))), [
    (f"concat('T', {_K})", "'T' || k"), (_NULL, "'l' || y"), (_NULL, "'Материал'")])
