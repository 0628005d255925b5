"""The written index, its scans, cover density and stems."""

from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scriptoria.functions.stemming import english, stem
from scriptoria.operators import catalog, postings, search

WORDS = ["a", "b", "c", "d", "e"]


def small_documents():
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 4))), " ".join(rng.choices(WORDS, k=rng.randint(0, 14))), str(i % 3)) for i in range(60)]
    return [*rows, (100, None, None, "0"), (101, "", "a a a a", None), (102, "a b", "", "9")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(small_documents(), "id int, head string, body string, part string")
    return postings.write_index(docs, ["id"], [("head", "A"), ("body", "C")], f"{tmp_path_factory.mktemp('index')}/i", block=F.col("part"))


def words_of(row):
    return [(w, x) for text, x in ((row[1], 1.0), (row[2], 0.2)) for w in (text or "").split()]


def holds(clause, window):
    """Whether a clause stands in a window {position: word}."""
    return any(all(window.get(p + k) == w for k, w in enumerate(clause)) for p in window)


def brute_score(row, asked):
    """Covers as published: from a start the first end at which the query holds, then the last begin; the next start is behind that begin."""
    words = words_of(row)
    terms = {w for a in asked for c, negated in a if not negated for w in c}
    entries = [(p, w, x) for p, (w, x) in enumerate(words, 1) if w in terms]
    true = lambda part: any(all(holds(c, {p: w for p, w, _ in part}) for c, negated in a if not negated) for a in asked)
    score, start = 0.0, 0
    while True:
        end = next((e for e in range(start, len(entries)) if true(entries[start : e + 1])), None)
        if end is None:
            return score
        begin = next(b for b in range(end, start - 1, -1) if true(entries[b : end + 1]))
        n = end - begin + 1
        score += n / sum(1 / x for *_, x in entries[begin : end + 1]) / (1 + entries[end][0] - entries[begin][0] - (n - 1))
        start = begin + 1


def brute_match(row, asked):
    window = {p: w for p, (w, _) in enumerate(words_of(row), 1)}
    return any(all(holds(c, window) != negated for c, negated in a) for a in asked)


QUERIES = {
    "a": [[(("a",), False)]], "a b": [[(("a",), False), (("b",), False)]], "a b c": [[((w,), False) for w in "abc"]], '"a b"': [[(("a", "b"), False)]], '"a a"': [[(("a", "a"), False)]],
    '"a b" c': [[(("a", "b"), False), (("c",), False)]], '"a b a" or e': [[(("a", "b", "a"), False)], [(("e",), False)]], "a or b c": [[(("a",), False)], [(("b",), False), (("c",), False)]],
    "a -d": [[(("a",), False), (("d",), True)]], 'c -"a b"': [[(("c",), False), (("a", "b"), True)]], '"a b" b "b c"': [[(("a", "b"), False), (("b",), False), (("b", "c"), False)]], "a nothing": [[(("a",), False), (("nothing",), False)]],
}


@pytest.mark.parametrize("q", QUERIES)
def test_matches_and_covers(spark, index, q):
    want = {r[0]: brute_score(r, QUERIES[q]) for r in small_documents() if brute_match(r, QUERIES[q])}
    got = {r["id"]: r["score"] for r in postings.matching(index, spark, q, scored=True).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_only_excluded(spark, index):
    docs = spark.createDataFrame(small_documents(), "id int, head string, body string, part string")
    got = {r["id"] for r in postings.matching(index, spark, "-a", docs).collect()}
    assert got == {r[0] for r in small_documents() if "a" not in [w for w, _ in words_of(r)]}
    with pytest.raises(ValueError):
        postings.matching(index, spark, "-a")
    assert postings.matching(index, spark, '"" -').isEmpty()


def test_scan_opens_folders_of_terms_and_blocks(spark, index):
    found = postings.matching(index, spark, "a b")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    partition = scan[scan.index("PartitionFilters") :]
    assert "bucket" in partition and all(str(postings.bucket_of(t)) in partition for t in "ab") and "In(term, [a,b])" in scan
    chosen = spark.createDataFrame([(i, str(i % 3)) for i in range(0, 60, 3)], "id int, block string")
    near = postings.rows_of(index, spark, ["a"], chosen)
    scan = next(x for x in near._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x)
    assert "block" in scan[scan.index("PartitionFilters") :]
    every, some = postings.rows_of(index, spark, ["a"]).count(), near.count()
    assert 0 < some < every and {r["block"] for r in near.collect()} == {"0"}
    # the bitmap leaves out other documents of the block that is opened
    few = spark.createDataFrame([(0, "0"), (3, "0")], "id int, block string")
    assert {r["id"] for r in postings.rows_of(index, spark, ["a"], few).collect()} <= {0, 3}
    got = {r["id"] for r in postings.matching(index, spark, "a", chosen=chosen).collect()}
    assert got == {r[0] for r in small_documents() if r[0] < 60 and r[0] % 3 == 0 and brute_match(r, QUERIES["a"])}
    assert postings.matching(index, spark, "a", chosen=chosen.limit(0)).isEmpty()


def test_files_hold_differences_in_order(spark, index):
    files = glob.glob(f"{index.path}/postings/**/*.parquet", recursive=True)
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata.row_group(0)
        places = next(meta.column(k) for k in range(meta.num_columns) if meta.column(k).path_in_schema.startswith("places"))
        assert "DELTA_BINARY_PACKED" in places.encodings
        t = pq.ParquetFile(f).read().to_pylist()
        assert t == sorted(t, key=lambda r: (r["term"], r["id"])) and all(r["places"] == sorted(r["places"]) for r in t)
    counts = {r["term"]: (r["documents"], r["places"]) for r in index.terms(spark).collect()}
    rows = [[w for w, _ in words_of(r)] for r in small_documents()]
    assert counts == {w: (sum(w in r for r in rows), sum(r.count(w) for r in rows)) for w in WORDS}


def test_facets_reach_the_postings(spark, tmp_path):
    years = [(f"s{i}", 1, f"A{i % 4}", None, f"a{i % 4}", "lecture" if i % 2 else "sermon", "свет", None, None, "о свете и мудрости " * (1 + i % 3), 2000 + i % 5) for i in range(40)]
    docs = spark.createDataFrame(years, "slug string, position int, authorName string, authorRaw string, authorSlug string, documentType string, documentTitle string, description string, creationRaw string, content string, siteYear int")
    cont = docs.select("slug", "siteYear", F.concat_ws("-", "siteYear", "slug").alias("siteSortDate"))
    docs, years = docs.drop("siteYear"), docs
    config = search.Config.russian(spark)
    index = postings.catalog_index(years, f"{tmp_path}/i", config, F.col("siteYear"))
    filters = catalog.Filters.of(siteYear="2001", authorSlug="a1", documentType="lecture", q='"свете и мудрость"')
    listed = postings.found_catalog(cont, docs, index, filters)
    want = [f"s{i}" for i in range(40) if i % 5 == 1 and i % 4 == 1]
    assert sorted(r["slug"] for r in listed.collect()) == sorted(want)
    every = postings.rows_of(index, spark, ["мудрост"]).count()
    some = postings.rows_of(index, spark, ["мудрост"], postings.facet_documents(cont, docs, filters)).count()
    assert every == 40 and some == len(want)


# Words and stems of the published English sample.
SAMPLE = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist consistent consist consistently consist consisting consist consists consist
consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol consolingly consol consols consol
consonant conson consort consort consorted consort consorting consort conspicuous conspicu conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir
constable constabl constables constabl constance constanc constancy constanc constant constant knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee
kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit
knives knive knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot skies sky dying die hopping hop hoping hope by by say say cry cri
generate generat generic generic communism communism gas gas gaps gap kiwis kiwi this this ties tie cries cri agreed agre feed feed luxuriated luxuri news news innings inning happiness happi rolling roll controlling control"""


def test_english_stems():
    words = SAMPLE.split()
    assert [english(w) for w in words[::2]] == words[1::2]
    assert stem("Running") == "run" and stem("мудростью") == stem("мудрость") and english("") == "" and english("'s") == "'s" and english("'") == "'"


def test_stems_never_fail():
    rng = random.Random(9)
    for _ in range(20_000):
        w = "".join(rng.choices("aeiouybdlst'ingfz", k=rng.randint(0, 12)))
        assert len(english(w)) <= len(w) + 1
