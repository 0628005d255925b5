"""Merges, changes of listings, streams, provider and exports that settle."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from scriptoria import jobs
from scriptoria.operators import enrich, exports, freshness, merged
from scriptoria.streaming import windows


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path, rng, want = f"{tmp_path}/t", random.Random(1), {}
    frame = lambda rows: spark.createDataFrame(rows, "k int, v int, x string")
    for number in range(5):
        rows = [(rng.randrange(80), rng.randrange(4), f"{number}-{i}") for i in range(60 if not number else 4)]
        best = {}
        for k, v, x in rows:
            if k not in best or v > best[k][0]:
                best[k] = (v, x)
        rows = [(k, v, x) for k, (v, x) in best.items()]
        moved = {k for k, v, _ in rows if k not in want or v > want[k][0]}
        before = merged.manifest(spark, path, number - 1)["from"] if number else {}
        touched = merged.merge(frame(rows), path, ["k"], ["v"], number)
        buckets = {k: b for k, b in frame([(k, 0, "") for k in moved] or [(0, 0, "")]).select("k", F.pmod(F.xxhash64("k"), F.lit(16))).collect()}
        assert touched == sorted({buckets[k] for k in moved})
        now = merged.manifest(spark, path, number)["from"]
        assert {b for b in now if before.get(b) != now[b]} == set(map(str, touched))
        want |= {k: (v, x) for k, v, x in rows if k in moved}
        assert table(merged.read(spark, path)) == sorted((k, *r) for k, r in want.items())
        assert merged.merge(frame([(1, 99, "replayed")]), path, ["k"], ["v"], number) == []
    assert merged.manifests(spark, path) == [2, 3, 4] and table(merged.read(spark, path, 4)) == table(merged.read(spark, path))
    held = {(f.parent.parent.name, f.parent.name) for f in tmp_path.rglob("bucket=*/*.parquet")}
    named = {(f"change={c:012d}", f"bucket={b}") for n in (2, 3, 4) for b, c in merged.manifest(spark, path, n)["from"].items()}
    assert held == named


def test_merge_without_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert merged.read(spark, path) is None
    assert merged.merge(spark.createDataFrame([], "k int, x string"), path, ["k"]) == [] and merged.read(spark, path).count() == 0
    merged.merge(spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, x string"), path, ["k"], buckets=4)
    assert merged.merge(spark.createDataFrame([(1, "a"), (2, None)], "k int, x string"), path, ["k"]) == []
    assert len(merged.merge(spark.createDataFrame([(2, "b")], "k int, x string"), path, ["k"])) == 1
    assert table(merged.read(spark, path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_listing_changes(spark):
    t = lambda *rows: spark.createDataFrame(list(rows), "relativePath string, sha256 string, mtime int")
    before = t(("a", "1", 1), ("b", "2", 1), ("c", "3", 1), ("d", "4", 1), ("e", "4", 1), ("f", None, 1), ("g", "7", 1), ("h", None, None))
    after = t(("a", "1", 1), ("b", "9", 1), ("c", "3", 2), ("y", "4", 1), ("z", "8", 1), ("n", None, 1), ("h", None, None))
    got = {(r["state"], r["oldPath"], r["newPath"]) for r in freshness.listing_changes(before, after).collect()}
    assert got == {("same", "a", "a"), ("changed", "b", "b"), ("touched", "c", "c"), ("moved", "d", "y"), ("gone", "e", None), ("gone", "f", None), ("gone", "g", None), ("added", None, "z"), ("added", None, "n"), ("same", "h", "h")}
    assert freshness.listing_changes(before.limit(0), after.limit(0)).isEmpty()


def test_late_rows_and_sessions(spark, tmp_path):
    at = lambda minute: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    source = tmp_path / "in"
    batches = [[(1, 0), (1, 5), (2, 3), (1, 61)], [(1, 4), (1, 62), (2, 200)], [(1, 1), (2, 201), (1, 500)], [(1, 2), (1, 501)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame([(u, at(m)) for u, m in rows], "u int, ts timestamp").coalesce(1).write.parquet(f"{source}/b{k}")
    stream = spark.readStream.schema("u int, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
    for f in sorted(source.rglob("*.parquet")):
        import os

        os.utime(f, (int(f.parent.name[1:]) * 100 + 1e9,) * 2)
    out = f"{tmp_path}/tumbling"
    windows.write_closed(windows.windowed_counts(stream, "ts", "1 hour", "30 minutes", "u"), out, f"{out}-c")
    got = {(r["u"], (r["start"] - at(0)).seconds // 3600, r["n"]) for r in spark.read.parquet(out).collect()}
    # minute 1 comes in the third batch, when the batch before had the watermark 31: it counts; minute 2 comes in the fourth (170): late
    assert got == {(1, 0, 4), (2, 0, 1), (1, 1, 2), (2, 3, 2)}
    out = f"{tmp_path}/sessions"
    windows.write_closed(windows.session_counts(stream, "ts", "10 minutes", "30 minutes", "u"), out, f"{out}-c")
    got = {(r["u"], int((r["start"] - at(0)).total_seconds() // 60), int((r["end"] - at(0)).total_seconds() // 60), r["n"]) for r in spark.read.parquet(out).collect()}
    assert got == {(1, 0, 15, 3), (2, 3, 13, 1), (1, 61, 72, 2), (2, 200, 211, 2)}


def test_states_over_batches(spark, tmp_path):
    source, rows = tmp_path / "in", [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i % 3, "xyx"[(i * i) % 3]) for i in range(40)]
    for k in range(4):
        spark.createDataFrame(rows[10 * k : 10 * k + 10], "e int, ts timestamp, u int, kind string").coalesce(1).write.parquet(f"{source}/b{k}")
    stream = spark.readStream.schema("e int, ts timestamp, u int, kind string").option("recursiveFileLookup", True).parquet(str(source))
    path = f"{tmp_path}/t"
    windows.write_states(windows.key_states(stream, "u", "ts", "e", "kind"), path, f"{path}-c", "u")
    want = []
    for u in range(3):
        own = [k for *_, v, k in rows if v == u]
        want.append((u, len(own), sum(a != b for a, b in zip(own, own[1:], strict=False)), own[-1]))
    assert table(merged.read(spark, path)) == want


def asked(spark, n):
    return spark.createDataFrame([("s", i, f"candidate {i}") for i in range(n)], "slug string, position int, candidate string")


def test_provider_retries_and_partial_failure(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(candidates):
        with open(log, "a") as f:
            f.write(",".join(c.split()[1] for c in candidates) + "\n")
        tries = open(log).read().split("\n")
        if "candidate 4" in candidates and len([x for x in tries if x.startswith("3,")]) < 3:
            raise enrich.ProviderError(503, "busy")
        if "candidate 7" in candidates:
            raise enrich.ProviderError(400, "bad request")
        return [None if c.endswith("0") else c.upper() for c in candidates]

    got = enrich.partition_provider(call, size=3, retries=2, pause=0.0, width=1)(asked(spark, 11)).collect()
    assert [r["position"] for r in got] == list(range(11))
    assert [r["status"] for r in got] == [404, 200, 200, 200, 200, 200, 400, 400, 400, 200, 404]
    assert got[1]["record"] == "CANDIDATE 1" and got[7]["record"] is None and got[7]["error"] == "bad request"


def test_provider_budget_and_refusal(spark):
    got = enrich.partition_provider(lambda cs: ["r"] * len(cs), size=2, characters=50, width=1)(asked(spark, 8)).collect()
    assert [r["status"] for r in got] == [200] * 4 + [402] * 4
    short = enrich.partition_provider(lambda cs: ["r"], size=4, retries=0, width=1)(asked(spark, 4)).collect()
    assert {r["status"] for r in short} == {502}

    def refuse(cs):
        raise enrich.ProviderError(403, "403 Forbidden")

    with pytest.raises(Exception, match="not available"):
        enrich.partition_provider(refuse, width=2)(asked(spark, 8)).collect()


def test_exports_settle_every_task(spark, tmp_path):
    one = "struct<documentTitle:string,header:array<string>,body:array<string>,footer:array<string>>"
    good = [("T", ["h"], ["b"], [])]
    rows = [("s1", "2020", "A", None, good), ("s2", "2020", "B", None, None), ("s3", "2020", "C", None, [(None, None, [None], None)]), ("s4", "2020", "D", "x", good), ("s5", "2020", None, None, good)]
    issues = spark.createDataFrame(rows, f"slug string, year string, title string, siteLabel string, documents array<{one}>")
    found = {(r["slug"], r["format"]): (r["content"] is not None, r["error"]) for r in exports.run(issues).collect()}
    assert len(found) == 15
    for k in ("txt", "docx", "epub"):
        assert found["s1", k] == found["s4", k] == (True, None) and found["s2", k][1] and not found["s2", k][0]
    assert all(has or error for has, error in found.values())
    done = {r["path"]: r["error"] for r in exports.write_files(exports.run(issues), str(tmp_path)).collect()}
    assert done["downloads/2020/s1.docx"] is None and (tmp_path / "downloads/2020/s1.docx").exists()
    assert done["downloads/2020/s2.docx"] and not (tmp_path / "downloads/2020/s2.docx").exists()


def test_choice_of_sources(spark):
    paths = spark.createDataFrame([("a/2020/Q1/word/2020Q1-1.docx",), ("a/2020/Q2/word/2020Q2-1.docx",), ("a/2019/2-й квартал/x.docx",), ("2020Q1-1.docx",)], "path string")
    pick = lambda **k: [r[0] for r in jobs._chosen(paths, "path", **({"year": None, "slug": None} | k)).collect()]
    assert pick(quarter=2) == ["a/2020/Q2/word/2020Q2-1.docx", "a/2019/2-й квартал/x.docx"]
    assert pick(quarter=1, year=2020) == ["a/2020/Q1/word/2020Q1-1.docx"] and pick(quarter=1)[1:] == ["2020Q1-1.docx"]
    assert pick(file="x.docx") == ["a/2019/2-й квартал/x.docx"] and pick(file="2020Q1-1.docx") == ["a/2020/Q1/word/2020Q1-1.docx", "2020Q1-1.docx"]
