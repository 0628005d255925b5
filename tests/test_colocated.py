"""The catalog in buckets by slug within years: same rows, fewer exchanges, fewer files."""

from __future__ import annotations

import re

import pytest

from scriptoria.operators import catalog as C
from scriptoria.operators import colocated

CONTAINERS = [(f"s{i}", f"t{i}", 2000 + i % 3, 1 + i % 12, f"{2000 + i % 3}-{1 + i % 12:02d}-01") for i in range(40)]
DOCUMENTS = [(f"s{i}", p, "RAN"[(i + p) % 3], f"a{p % 2}", 1990 + p) for i in range(39) for p in range(1, 1 + i % 5)] + [("gone", 1, "R", "a1", 1990), (None, 1, "R", "a1", 1990)]


@pytest.fixture(scope="module")
def plain(spark):
    cont = spark.createDataFrame(CONTAINERS, "slug string, title string, siteYear int, siteMonth int, siteSortDate string")
    return cont, spark.createDataFrame(DOCUMENTS, "slug string, position int, documentType string, authorSlug string, creationYear int")


@pytest.fixture(scope="module")
def path(spark, plain, tmp_path_factory):
    target = f"file://{tmp_path_factory.mktemp('colocated')}/store"
    colocated.write(*plain, target, buckets=8)
    return target


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    names = sorted(df.columns)
    return [repr([r[c] for c in names]) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


FILTERS = [C.Filters(), C.Filters(siteYear=2001), C.Filters(siteYear=2002, documentType="R"), C.Filters(authorSlug="a1", creationYear=1993), C.Filters(siteYear=1900)]


@pytest.mark.parametrize("filters", FILTERS)
def test_same_listings(spark, plain, path, filters):
    store = colocated.open_store(spark, path)
    assert rows(store.catalog(filters)) == rows(C.catalog(*plain, filters))
    assert rows(store.offline_catalog(filters)) == rows(C.offline_catalog(*plain, filters))


def test_matched_keys(spark, plain, path):
    keys = spark.createDataFrame([("s4", 1), ("s4", 1), ("s9", 3), ("none", 1)], "slug string, position int")
    store = colocated.open_store(spark, path)
    assert rows(store.catalog(C.Filters(), keys)) == rows(C.catalog(*plain, C.Filters(), keys)) != []


def test_detail_reads_one_bucket(spark, plain, path, sorted_joins):
    store = colocated.open_store(spark, path)
    for slug, year in (("s13", 2001), ("s39", 2000), ("s13", 2000), ("gone", 2000)):
        assert rows(store.detail(year, slug)) == rows(C.detail(*plain, year, slug))
    found = store.detail(2001, "s13")._jdf.queryExecution().toString()
    assert found.count("SelectedBucketsCount: 1 out of 8") == 2


def test_nesting_has_no_exchange(spark, path, sorted_joins):
    store = colocated.open_store(spark, path)
    for listing in (store.catalog(C.Filters(siteYear=2001, documentType="R")), store.offline_catalog(C.Filters(siteYear=2001, documentType="R"))):
        found = plan(listing)
        assert "hashpartitioning" not in found and found.count("Exchange ") == 1 and "Exchange rangepartitioning" in found
        scans = re.findall(r"PartitionFilters: \[(.*?)\]", found)
        assert len(scans) >= 2 and all("siteYear" in s and "2001" in s for s in scans)


def test_opened_without_a_catalog(spark, plain, path):
    for name in ("containers", "documents"):
        spark.sql(f"DROP TABLE {colocated._table(path, name)}")
    store = colocated.open_store(spark, path)
    assert rows(store.catalog(C.Filters())) == rows(C.catalog(*plain, C.Filters()))
    assert store.documents.count() == len(DOCUMENTS)


def test_one_file_a_bucket_and_year(spark, path):
    files = colocated.open_store(spark, path).documents.inputFiles()
    assert len(files) <= 8 * 4 and len({(f.rsplit("/", 2)[1], re.search(r"_(\d{5})\.", f)[1]) for f in files}) == len(files)


def test_empty_tables_and_wrong_numbers(spark, plain, tmp_path):
    target = f"file://{tmp_path}/empty"
    colocated.write(plain[0].limit(0), plain[1].limit(0), target, buckets=4)
    assert rows(colocated.open_store(spark, target).catalog(C.Filters())) == []
    with pytest.raises(ValueError, match="positive"):
        colocated.write(*plain, f"file://{tmp_path}/none", buckets=0)


def test_unfinished_store_is_not_opened(spark, tmp_path):
    with pytest.raises(Exception, match="layout"):
        colocated.open_store(spark, f"file://{tmp_path}/nothing")
