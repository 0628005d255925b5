"""The ten corpus operators against brute force, on a table with every odd row, on empty tables and on the smallest data."""

from __future__ import annotations

import collections
import hashlib
import os
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from scriptoria.llm import common, exact_dedup, fingerprint, langid, licences, minhash, mixing, packing, sieve, suffix_dedup, warc

SF = "/root/testdata/sf0.001"
VECTORS, LABELS = "vec_id long, embedding array<float>, label int", "doc_id long, quality int, toxic int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, part int, __gone int, h double"


def odd_texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base, passage = prose(300), prose(60)
    near = base.split()
    near[150] = "changed"
    return [
        None, "", " \t\n", "12 345 --", "a", "Ünï çödé Ä É", base, base, base.upper(), " ".join(near), prose(80) + "\n" + passage + "\n" + prose(50), prose(40) + " " + passage, passage,
        "x" * 30_000, "ab" * 40 + " " + "ab" * 40, prose(9_000), "word " * 500, "word " * 500, "one two three", "one two three four", "line one\nline two\nRELEASED under the MIT License. End",
        "tab\tand\x0bvertical\x0cfeed\rreturn nbsp", base, "\U0001f600 emoji \U0001f600", prose(12), prose(13),
    ]


def table(texts) -> list[tuple]:
    langs, sources = ["en", "de", None], ["a", "a", "a", None, "b", ""]
    return [(i * 3 + 1, t, langs[i % 3], sources[i % 6], None if i % 4 == 0 else len(t or ""), 7, "k", None, 1, 0.5) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    rows = table(odd_texts())
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    pages = [(1, "http://a.example/x?q=1#f", "<p>" + "z" * 200), (2, None, "<p>" + "z" * 200), (3, "https://www.a.example/x y\r\nInjected: 1", "short"), (4, "HTTP://u@B.example:80", "short"), (5, "x", None), (6, "x", "WARC/1.1\r\n\r\n" + "é" * 60), (None, "x", "<p>" + "z" * 200), (2, "y", "<p>" + "z" * 200)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2).write.parquet(f"{d}/pages.parquet")
    vectors = [(i, [float((i * k) % 7 - 3) for k in range(1, 9)], i % 4) for i in range(120)] + [(200, None, 1), (201, [0.0] * 8, 2), (202, [None] * 8, 1), (203, [1.0, 2.0], None)]
    spark.createDataFrame(vectors, VECTORS).repartition(3).write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 1), (16, 1, 1), (None, 1, 1), (19, None, None)], LABELS).write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([], VECTORS).write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{d}/labels.parquet")
    return d


def documents(spark, d):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]


def duck(d):
    c = duckdb.connect()
    for t in os.listdir(d):
        if t.endswith(".parquet"):
            p = f"{d}/{t}"
            c.execute(f"create view {t[:-8]} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return c


def same_as_sql(spark, d, name):
    df = entry.queries()[name](spark, d)
    cursor = duck(d).execute(entry.oracle_sql()[name])
    found = [x[0] for x in cursor.description]
    assert sorted(found) == sorted(df.columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r[c] for c in sorted(found)) for r in df.collect()) == key(tuple(r[found.index(c)] for c in sorted(found)) for r in cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op") and n[2].isdigit()])
def test_against_sql(spark, odd, name):
    if name == "op5_warc_index_merge":
        same_as_sql(spark, SF, name)
    else:
        same_as_sql(spark, odd, name)
        same_as_sql(spark, SF, name)


@pytest.mark.parametrize("name", [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)])
def test_empty_tables(spark, empty, name):
    assert entry.queries()[name](spark, empty).count() == 0


# 1 language identification


def test_langid_held_out_accuracy(spark):
    got = entry.queries()["op1_langid_ppm"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = got.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row["a"] > 0.97 and 0 <= row["low"] <= row["high"] <= 1


def test_langid_code_length_is_exact():
    texts, order = [b"abracadabra", b"abab", "\xe9t\xe9".encode()], 2
    grams = collections.Counter()
    for t in texts[:2]:
        padded = b"\0" * order + t
        grams.update(int.from_bytes(padded[i : i + order + 1], "big") for i in range(len(t)))
    model = langid.PpmModel(["x"], np.zeros(len(grams), int), np.array(list(grams), np.uint64), np.array(list(grams.values()), float), order)
    counts = [collections.Counter() for _ in range(order + 1)]
    for g, n in grams.items():
        raw = g.to_bytes(order + 1, "big")
        for k in range(order + 1):
            counts[k][raw[order - k :]] += n

    def bits(context, symbol):
        total = 0.0
        for k in range(order, -1, -1):
            ctx = context[order - k :]
            seen = {g[-1]: n for g, n in counts[k].items() if g[:-1] == ctx}
            n, d = sum(seen.values()), len(seen)
            if symbol in seen:
                return total - np.log2(seen[symbol] / (n + d))
            if n:
                total -= np.log2(d / (n + d))
        return total + 8

    for t in texts:
        padded = b"\0" * order + t
        want = sum(bits(padded[i : i + order], padded[i + order]) for i in range(len(t)))
        got = model.code_lengths(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0, 0]
        assert got == pytest.approx(want, rel=1e-5)


def brute_bits(texts_of, text, order):
    """Code length of ``text`` in one language's frozen trees, from the definition alone."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for t in texts_of:
        padded = b"\0" * order + t
        for i in range(len(t)):
            for k in range(order + 1):
                counts[k][padded[i + order - k : i + order + 1]] += 1
    seen = [collections.defaultdict(dict) for _ in range(order + 1)]
    for k in range(order + 1):
        for g, n in counts[k].items():
            seen[k][g[:-1]][g[-1]] = n
    total, padded = 0.0, b"\0" * order + text
    for i in range(len(text)):
        for k in range(order, -1, -1):
            own = seen[k].get(padded[i + order - k : i + order], {})
            n, d = sum(own.values()), len(own)
            if padded[i + order] in own:
                total -= np.log2(own[padded[i + order]] / (n + d))
                break
            total -= np.log2(d / (n + d)) if n else 0.0
        else:
            total += 8
    return total


@pytest.mark.parametrize("cells", [langid.DENSE_CELLS, 0])
def test_langid_whole_result_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(langid, "DENSE_CELLS", cells)
    rng = random.Random(6)
    alphabets = {"aa": "abcde ", "bb": "cdefg ", "cc": "efghi ", "dd": "cdefg "}
    rows = [(i, "".join(rng.choices(alphabets[k], k=rng.randint(1, 60))), k) for i, k in enumerate(rng.choices(list(alphabets), k=60))]
    rows += [(100, "zzz ÿ", None), (101, "", "aa"), (102, None, "bb"), (103, "12 3", None), (104, "Жизнь", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows}
    model = langid.fit(docs, ~langid.held_out())
    assert isinstance(model, langid.PpmModel if cells else langid.SparsePpm)
    own = {k: [t.encode() for i, t, x in rows if x == k and t is not None and not held[i]] for k in alphabets}
    got = {r["id"]: r for r in langid.predict(docs, model).collect()}
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        bits = {k: brute_bits(v, t.encode(), 4) for k, v in own.items()}
        best = min(bits.values())
        assert bits[got[i]["lang_pred"]] == pytest.approx(best, rel=1e-5) and got[i]["bits_per_byte"] == pytest.approx(best / len(t.encode()), rel=1e-5)
        assert got[i]["score"] == pytest.approx(1 / sum(2.0 ** max(-1000, best - x) for x in bits.values()), rel=1e-3)


def test_langid_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(i, "abcabc abc", k) for i, k in enumerate(["zz", "yy"] * 20)], "doc_id long, text string, lang string")
    model = langid.fit(docs, F.col("doc_id") < 40)
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"yy"}


def test_langid_many_languages(spark):
    docs = spark.range(4500).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.md5(F.col("id").cast("string"))).alias("text"), F.concat(F.lit("l"), (F.col("id") % 1500).cast("string")).alias("lang"))
    model = langid.fit(docs, F.lit(True))
    assert len(model.languages) == 1500 and isinstance(model, langid.SparsePpm)
    right = langid.predict(docs, model).where(F.col("lang_pred") == F.concat(F.lit("l"), (F.col("id") % 1500).cast("string"))).count()
    assert right > 4000


def test_language_stage_rejects_what_no_language_fits(spark):
    rng = random.Random(8)
    words = ["the", "of", "and", "house", "tree", "green", "running", "water"]
    rows = [(i, " ".join(rng.choices(words, k=20)), "en") for i in range(60)]
    rows += [(100, "Привет, как дела? " * 3, "ru"), (101, "A.", None), (102, "12 34", "en"), (103, "你好世界你好世界你好", None), (104, "tree house", None)]
    docs = spark.createDataFrame([r for r in rows if r[0] < 60 or not langid_held(r[0]) or r[2] is None], "doc_id long, text string, lang string")
    docs = docs.withColumn("lang", F.when(F.col("lang") == "en", F.col("lang")))
    kept = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    own = [t.encode() for i, t, k in rows if k == "en" and i < 60 and not langid_held(i)] + ([b"12 34"] if not langid_held(102) else [])
    want = {i for i, t in texts.items() if any(c.isalpha() for c in t) and brute_bits(own, t.encode(), 4) <= 8 * len(t.encode()) + 64}
    assert kept == want and 101 in kept and 104 in kept and 103 not in kept


def langid_held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_langid_odd_rows(spark, odd):
    got = {r["doc_id"]: r for r in entry.queries()["op1_langid_ppm"](spark, odd).collect()}
    for i, t in documents(spark, odd):
        letters = any(c.isalpha() for c in t or "")
        assert (got[i]["lang_pred"] == "und") == (not letters) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


# 2 exact dedup


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    rows = [(5, "A"), (5, "A"), (3, "a"), (None, "a"), (9, "b"), (9, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in exact_dedup.drop_copies(docs, "largest").collect())
    assert kept == [(-1, "a"), (5, "A"), (9, "b"), (9, "c")]


def test_hit_filter_rules_out_and_loses_nothing(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    hits = rows.limit(300)
    passed = exact_dedup.may_hit(rows, exact_dedup.hit_filter(hits))
    assert hits.join(passed, "digest", "left_anti").isEmpty() and 300 <= passed.count() < 320


# 3 substring dedup: against SQL above
# 4 mixing


def test_mixing_covers_and_limits(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "big" if i < 900 else "small", 1) for i in range(1000)], "doc_id long, text string, source string, __own int")
    out = mixing.mixed_rows(docs, 1.0, 2.0)
    assert out.columns == docs.columns
    counts = {r["source"]: (r["n"], r["ids"]) for r in out.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).collect()}
    assert counts["big"] == (900, 900) and counts["small"][1] == 100 and 190 <= counts["small"][0] <= 200


def test_mixing_meets_entropy(spark):
    docs = spark.createDataFrame([(i, "w " * 10, f"s{0 if i < 800 else i % 10}") for i in range(1000)], "doc_id long, text string, source string")
    weights = [r["weight"] for r in mixing.mix(docs, 0.9, 100.0).select("source", "weight").distinct().collect()]
    assert -sum(w * np.log(w) for w in weights) == pytest.approx(0.9 * np.log(len(weights)), abs=1e-4)


# 5 WARC


def test_loser_tree():
    rng = random.Random(1)
    for _ in range(200):
        runs = [sorted(rng.choices(range(40), k=rng.randint(0, 9))) for _ in range(rng.randint(1, 9))]
        assert list(warc.loser_tree_merge(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark, odd, tmp_path):
    pages = spark.read.parquet(f"{odd}/pages.parquet")
    path = f"file://{tmp_path}/warc"
    history = warc.archive_history(pages, path)
    rows = history.collect()
    payload = lambda h: (h or "").encode()
    want = collections.Counter((r["page_id"], len(payload(r["html"])), hashlib.sha256(payload(r["html"])).hexdigest()) for r in pages.collect())
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in rows) == want
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in rows if r["payload_bytes"] == 203)
    assert kinds == [(-1, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1)]
    ordered = [(r["url_key"], r["timestamp"], r["page_id"] or -1) for r in warc.merge_runs(warc.capture_runs(spark, path)).collect()]
    assert ordered == sorted(ordered)
    with open(f"{tmp_path}/warc/{rows[0]['archive']}", "rb") as f:
        f.seek(rows[0]["offset"])
        assert f.read(rows[0]["length"]).startswith(b"WARC/1.1\r\n")


def test_warc_archives_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SIZE_CLASSES", (100, 10_000))
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 40_000)
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.example/{i}", "x" * (20_000 if i % 50 == 0 else 5_000 if i > 250 else 10 + i % 3)) for i in range(300)], "page_id long, url string, html string").coalesce(1)
    rows = warc.archive_history(pages, f"file://{tmp_path}/warc").collect()
    assert len(rows) == 300 and {r["page_id"] for r in rows} == set(range(300))
    sizes = collections.Counter()
    for r in rows:
        sizes[r["archive"]] += r["length"]
    assert max(sizes.values()) < 60_000 and len({r["archive"].split("/")[0] for r in rows}) == 3


def test_warc_rejects_damage():
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Date: x\r\nWARC-Payload-Digest: sha256:00\r\nX-Payload-Length: 1\r\nContent-Length: 5\r\n\r\n\r\n\r\na\r\n\r\n"))


# 6 fingerprints


def check_fingerprints(spark, d):
    rows = sorted((i, t or "") for i, t in documents(spark, d))
    got = {r["doc_id"]: r for r in entry.queries()["op6_multiset_fingerprint"](spark, d).collect()}
    for k, (i, t) in enumerate(rows):
        q = len(t) // 4
        edited = t[: len(t) - q] + rows[(k + 1) % len(rows)][1][:q]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_next"] <= 1 and 0 <= got[i]["near_edited"] <= 1
    prints = collections.defaultdict(set)
    for i, t in rows:
        prints[t].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in prints.values()) and len({next(iter(x)) for x in prints.values()}) == len(prints)
    return got


def test_fingerprints(spark, odd):
    check_fingerprints(spark, odd)
    got = check_fingerprints(spark, SF).values()
    assert np.mean([r["near_edited"] for r in got]) > 0.6 and np.mean([r["near_next"] for r in got]) < 0.1


def test_fingerprint_ignores_order_and_adds(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta\nsecond line here now"), (2, "second line here now\nalpha beta gamma delta"), (None, "x"), (1, "y")], "doc_id long, text string")
    got = {r["n_chars"]: r["fingerprint"] for r in fingerprint.fingerprint_documents(docs).collect()}
    assert len([r for r in fingerprint.fingerprint_documents(docs).collect()]) == 4 and got[42 + 1 if 43 in got else 43 - 1 if 42 in got else max(got)]
    same = [r["fingerprint"] for r in fingerprint.fingerprint_documents(docs).collect() if r["n_chars"] > 10]
    assert len(set(same)) == 1
    kind = "struct<n:bigint,exact:array<bigint>,lanes:array<bigint>>"
    a, b = (2, [5, (1 << 32) - 1], [(1 << 32) - 1, 3]), (1, [7, 1], [1, 1 << 32])
    df = spark.createDataFrame([(a, b)], f"a {kind}, b {kind}")
    s = df.select(fingerprint.combine(F.col("a"), F.col("b")).alias("s"), "b", "a")
    assert tuple(s.first()["s"]) == (3, [12, 0], [0, 3 + (1 << 32)])
    back = s.select(fingerprint.combine(F.col("s"), F.col("b"), -1).alias("r"), "a").first()
    assert tuple(back["r"]) == tuple(back["a"])


def brute_fingerprint(text):
    """(n, exact lanes, signed likeness lanes) of a text, from the documented definition."""
    exact, n, ones = [0] * 8, 0, np.zeros(128, np.int64)
    for line in text.split("\n") if text else ():
        d = hashlib.sha256(line.encode()).digest()
        exact = [(e + int.from_bytes(d[4 * k : 4 * k + 4], "big")) % 2**32 for k, e in enumerate(exact)]
        w = line.split(" ")
        for piece, times in collections.Counter(tuple(w[i : i + 3]) for i in range(max(len(w) - 3, 0) + 1)).items():
            h = 42
            for x in piece:
                h = xxhash.xxh64_intdigest(x.encode(), h)
            second = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42))
            n += times
            ones += times * np.array([(x >> j) & 1 for x in (h, second) for j in range(64)])
    return n, exact, 2 * ones - n


def brute_likeness(a, b):
    if not a[0] or not b[0]:
        return float(a[0] == b[0])
    x, y = a[2].astype(float), b[2].astype(float)
    return min(1.0, max(0.0, (x @ y) / max(x @ x, y @ y)))


def test_fingerprints_against_brute_force(spark, odd):
    for d in (odd, SF):
        rows = sorted((i, t or "") for i, t in documents(spark, d))
        got = {r["doc_id"]: r for r in entry.queries()["op6_multiset_fingerprint"](spark, d).collect()}
        for k, (i, t) in enumerate(rows):
            follow = rows[(k + 1) % len(rows)][1]
            q = len(t) // 4
            own, edited, after = brute_fingerprint(t), brute_fingerprint(t[: len(t) - q] + follow[:q]), brute_fingerprint(follow)
            assert got[i]["near_edited"] == pytest.approx(brute_likeness(own, edited), abs=1e-9) and got[i]["near_next"] == pytest.approx(brute_likeness(own, after), abs=1e-9)
            for f, name in ((own, "fingerprint"), (edited, "edited_fingerprint")):
                if not f[0]:
                    assert got[i][name] == "0"
                    continue
                n, exact, lanes = got[i][name].split(":")
                assert int(n, 16) == f[0] and exact == "".join(f"{e:08x}" for e in f[1])
                ones = [(int(x, 16) >> (32 * p)) & 0xFFFFFFFF for x in lanes.split(".") for p in (0, 1)]
                # long j of hash k has bits j and j + 32
                assert [(f[2][64 * k + j + 32 * p] + f[0]) // 2 for k in range(2) for j in range(32) for p in (0, 1)] == ones


def test_fingerprint_of_a_long_text(spark):
    long = "a " * 2_600_000
    got = {r["id"]: r for r in fingerprint.fingerprint_documents(spark.createDataFrame([(1, long), (2, long + "b"), (3, "a a")], "doc_id long, text string")).collect()}
    assert int(got[1]["fingerprint"].split(":")[0], 16) == brute_fingerprint(long)[0] > 1 << 21
    assert got[1]["near_next"] == pytest.approx(brute_likeness(brute_fingerprint(long), brute_fingerprint(long + "b")), abs=1e-9) and got[1]["near_next"] > 0.99


# 7 suffix-array dedup


def brute_spans(rows, length):
    first = {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("limit", [100_000, 1])
def test_suffix_dedup(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "CLASS_LIMIT", limit)
    for d in (odd, SF):
        got = {r["doc_id"]: tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in entry.queries()["op7_suffix_array_dedup"](spark, d).collect()}
        assert got == brute_spans(documents(spark, d), 50)


def test_suffix_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1200] = data[:200]
    at = np.arange(2900)
    order, group = suffix_dedup.sort_suffixes(data, at, 50)
    raw = data.tobytes()
    strings = [raw[i : i + 50] for i in at[order]]
    assert strings == sorted(strings)
    assert all((a == b) == (g == h) for a, b, g, h in zip(strings, strings[1:], group, group[1:], strict=False))


def test_multikey_quicksort():
    rng = np.random.default_rng(5)
    for n, k in ((1, 2), (500, 1), (500, 3), (2000, 200)):
        keys = rng.integers(0, k, (n, 3)).astype(np.uint64)
        starts = np.unique(np.r_[0, rng.integers(0, n, 4)])
        order, first = suffix_dedup.multikey_quicksort(lambda i, depth: keys[i, depth // 8], np.arange(n), starts, 24)
        for lo, hi in zip(starts, np.append(starts[1:], n), strict=True):
            own = [tuple(x) for x in keys[order[lo:hi]]]
            assert own == sorted(tuple(x) for x in keys[lo:hi])
        same = [tuple(x) for x in keys[order]]
        want = [i for i in range(n) if i == 0 or i in starts or same[i] != same[i - 1]]
        assert first.tolist() == want


def test_blind_trie():
    rng = random.Random(9)
    for _ in range(200):
        length = rng.randint(1, 6)
        strings = [bytes(rng.choices(b"ab\x00\xff", k=length)) for _ in range(rng.randint(0, 40))]
        trie = suffix_dedup.BlindTrie()
        for i, x in enumerate(strings):
            trie.insert(x, i)
        groups = trie.groups()
        assert [strings[g[0]] for g in groups] == sorted(set(strings)) and sorted(i for g in groups for i in g) == list(range(len(strings)))
        assert all(len({strings[i] for i in g}) == 1 for g in groups)


# 8 packing


def test_packing(spark, odd):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for d in (odd, SF):
        rows = documents(spark, d)
        want = {}
        for (i, _), x in zip(rows, tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True):
            ids = np.array([*x.ids, 0], "<u4")
            edges = packing.cuts(len(ids), 2048)
            want |= {(i, k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))}
        got = entry.queries()["op8_best_fit_packing"](spark, d).collect()
        assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
        bins = collections.defaultdict(list)
        for r in got:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) * 1.02 + 1


def test_packing_added_tokens(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["see a<|endoftext|>b", "<|endoftext|>", "one \n <|endoftext|> <|endoftext|><|endoftext|>\n two", "<|endoftext|", "<|endof<|endoftext|>text|>", "word <|endoftext|> " * 900]
    want = {}
    for i, x in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
        ids = np.array([*x.ids, 0], "<u4")
        edges = packing.cuts(len(ids), 2048)
        want |= {(i, k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))}
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_cuts():
    assert packing.cuts(5, 4) == [0, 1, 5] and packing.cuts(4, 4) == [0, 4] and packing.cuts(8, 4) == [0, 4, 8] and packing.cuts(1, 4) == [0, 1]


def test_local_search_never_worse():
    rng = random.Random(2)
    emptied = 0
    for _ in range(30):
        lengths = collections.Counter(rng.randint(1, 60) for _ in range(200))
        items = lambda bins: sum((collections.Counter({x: n * p.count(x) for x in set(p)}) for p, n in bins.items()), collections.Counter())
        squares = lambda bins: sum(sum(p) ** 2 * n for p, n in bins.items())
        alone = collections.Counter({(x,) * k: n // k for x, n in lengths.items() if (k := max(1, min(64 // x, n)))}) + collections.Counter((x,) * (n % k) for x, n in lengths.items() if (k := max(1, min(64 // x, n))) and n % k)
        for start in (packing.best_fit(lengths, 64), alone):
            after, steps = packing.local_search(start, 64)
            assert items(start) == items(after) == lengths and all(sum(p) <= 64 for p in after) and sum(after.values()) <= sum(start.values())
            assert squares(after) > squares(start) if steps else after == start
            emptied += sum(start.values()) - sum(after.values())
    assert emptied > 100


def test_local_search_empties_a_bin_by_each_kind_of_exchange():
    # a move; then two for one (20 and 10 for 28) and a move
    assert packing.local_search(collections.Counter([(60,), (4,), (5, 5)]), 64) == ({(60, 4): 1, (5, 5): 1}, 1)
    assert packing.local_search(collections.Counter([(34, 28), (20, 10), (36,)]), 64) == ({(34, 20, 10): 1, (36, 28): 1}, 2)
    # one for one: 34 goes for 24
    assert packing.local_search(collections.Counter({(40,): 1, (30, 24): 1, (34,): 1}), 64)[0] == {(40, 24): 1, (34, 30): 1}


def test_local_search_is_reached(spark):
    """On the smallest documents best fit leaves bins above the lower bound, so exchanges are made."""
    from public_tokenizers import path

    cut = packing.pieces(spark.read.parquet(f"{SF}/documents.parquet"), path("byte_bpe_50k.json"))
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    start = packing.best_fit(lengths, 2048)
    after, steps = packing.local_search(start, 2048)
    assert steps > 0 and sum(after.values()) <= sum(start.values())


# 9 licences


def test_licence_rules(spark):
    s = licences.SENTENCES
    text = f"{s['apache_under']}\nUnknown words here\n{s['apache_basis']} {s['apache_see']}\nreleased UNDER the   MIT license"
    row = licences.scan(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")).orderBy("id").collect()
    assert row[0]["licences"] == "Apache-2.0;MIT" and row[0]["n_sentences"] == 4 and row[1]["licences"] == row[2]["licences"] == ""


def test_licence_wrapped_lines(spark):
    s = licences.SENTENCES
    fill = lambda *k, lead="", width=72: "\n".join(lead + x for x in textwrap.wrap(" ".join(s[x] for x in k), width))
    mit = "\n\n".join([s["mit_name"], fill("mit_grant"), fill("mit_condition"), fill("mit_warranty")])
    texts = {
        "MIT": [mit, mit.replace("\n", "\r\n"), "A title\n" + fill("mit_grant", lead=" * ", width=40) + "\n *\n" + fill("mit_condition", lead=" * ", width=40) + "\n int main()"],
        "Apache-2.0": [fill("apache_under", "apache_basis", "apache_see", lead="# ", width=60)],
        "GPL-3.0-or-later": [fill("gpl_free", "gpl_hope", "gpl_details")],
        "BSD-3-Clause": [fill("bsd_redistribution") + "\n\n" + fill("bsd_endorse")],
        "MPL-2.0": [s["mpl_notice"], "Words. " + s["mpl_notice"] + " Words", fill("mpl_notice", width=30)],
        "": ["\n\n".join(textwrap.wrap(s["isc_grant"], 72)), "words " + s["isc_grant"], fill("isc_grant")[:-30]],
    }
    rows = [(i, t, want) for i, (t, want) in enumerate((t, k) for k, v in texts.items() for t in v)]
    got = {r["id"]: (r["licences"], r["sentence_ids"]) for r in licences.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert {i: x for i, (x, _) in got.items()} == {i: want for i, _, want in rows}
    assert got[0][1] == got[1][1] == "mit_name;mit_grant;mit_condition;mit_warranty"


# 10 MinHash near dedup


def brute_components(rows, numerator, k=5):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= numerator * (len(sets[a]) + len(sets[b]) - shared):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


@pytest.mark.parametrize("block", [512, 2])
def test_near_dedup(spark, odd, monkeypatch, block):
    monkeypatch.setattr(minhash.agreeing_in_lists, "__defaults__", (block,))
    monkeypatch.setattr(minhash.joining_links, "__defaults__", (block,))
    for d in (odd, SF):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in entry.queries()["op10_minhash_near_dedup"](spark, d).collect()}
        assert got == brute_components(documents(spark, d), 85)


def test_collisions_by_prefix_and_skips():
    rng = np.random.default_rng(7)
    for n, coordinates, threshold in ((1, 8, 5), (40, 16, 10), (120, 64, 40), (60, 8, 8), (60, 8, 1), (65, 16, 10), (64, 16, 10), (90, 8, 8), (90, 8, 1)):
        sig = rng.integers(0, 3, (n, coordinates)).astype(np.uint32)
        sig[n // 2 :] = np.where(rng.random((n - n // 2, coordinates)) < 0.3, sig[n // 2 :], sig[: n - n // 2])
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if (sig[i] == sig[j]).sum() >= threshold}
        assert set(minhash.collisions(sig, threshold, lambda i, n=n: np.arange(n) > i)) == want


def test_near_dedup_large_group(spark):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(120)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    got = {r["id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), numerator=85, threshold=40).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 85).items()}


def test_near_dedup_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (None, "q r s t u v")], "doc_id long, text string")
    got = sorted((r["id"] or -1, r["component_id"] or -1) for r in minhash.near_duplicates(docs, numerator=85, threshold=40).collect())
    assert got == [(-1, -1), (1, 1), (1, 1), (2, 1)]


def test_joining_links_repeated_id_with_empty_text(spark):
    some = np.arange(10, dtype=np.uint64).tobytes()
    clusters = spark.createDataFrame([(1, i, i, 3) for i in (1, 2, 3)], "cluster long, id long, part long, n long")
    sets = spark.createDataFrame([(1, some), (2, some), (3, some), (3, b"")], "id long, shingles binary")
    got = minhash.components(minhash.joining_links(clusters, sets, 85)).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1)]


# helpers and the pipeline


def test_filters_lose_nothing(spark):
    docs = spark.range(2000).repartition(5)

    def hashes(batch):
        v = batch.column(0).to_numpy().astype(np.uint64)
        h = (v % np.uint64(700)) * np.uint64(0x9E3779B97F4A7C15)
        yield h, v

    found = sieve.repeat_filter(docs, ["id"], hashes)
    h = np.arange(700, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert sieve.marked(found, h).all()
    sketch = sieve.count_sketch(docs, ["id"], lambda b: (x[0] for x in hashes(b)))
    assert (sieve.cell_of(sketch, h) >= 2).all()


def test_stages(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = common.materialise(stage(spark, docs, odd), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    texts = [t for _, t in documents(spark, odd)]
    rows = [(r["text"], r["lang"], langid_held(r["doc_id"])) for r in spark.read.parquet(f"{odd}/documents.parquet").collect()]
    own = {k: [t.encode() for t, x, held in rows if x == k and t is not None and not held] for k in ("en", "de")}
    fits = lambda t: any(brute_bits(v, t.encode(), 4) <= 8 * len(t.encode()) + 64 for v in own.values())
    with_letters = [t for t in texts if any(c.isalpha() for c in t or "") and fits(t)]
    assert sizes[0] == len(with_letters)
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    assert sizes[1] == len({lower(t) for t in with_letters})
    assert sizes[2] <= sizes[1] and sizes[3] >= sizes[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, odd)
    assert packed.where("start = 0").count() == sizes[3]


def test_near_stage_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in minhash.drop_near_duplicates(docs, 80).select("doc_id").collect()}
    assert kept == {c for _, c in brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], 80).values()}


def test_components(spark):
    from scriptoria.llm.components import components

    rng = random.Random(4)
    for n, m in ((30, 20), (200, 150), (60, 59)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != n - 1 else [(i, i + 1) for i in range(m)]
        up = list(range(n))

        def top(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 1)], "u long, v long")).collect()}
        assert got == {x: top(x) for e in edges if e[0] != e[1] for x in e}
