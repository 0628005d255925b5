"""Vector near-duplicates, the filter audit and hard negatives: against brute force, SQL and odd rows."""

from __future__ import annotations

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scriptoria.llm import embedding_dedup, filter_audit, hard_negatives

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, id long, digest string, v int, copies int"


def odd_vectors(n: int = 260, k: int = 24) -> list[tuple]:
    """Random vectors, a hot group of copies, near copies around the threshold, and every odd row."""
    rng = np.random.default_rng(5)
    own = [rng.normal(size=k) for _ in range(n)]
    rows = [list(map(float, x)) for x in own]
    rows += [list(map(float, own[3]))] * 40
    for share in np.linspace(0.2, 0.7, 60):  # cosines on both sides of 0.9
        rows.append(list(map(float, own[7] + share * np.linalg.norm(own[7]) / np.sqrt(k) * rng.normal(size=k))))
    rows += [[float(3 * x) for x in own[9]], [-float(x) for x in own[9]], None, [], [0.0] * k, [-0.0] * k, [1.0, *[None] * (k - 1)], [float("nan")] * k, [float("inf"), *[1.0] * (k - 1)], [1.0, 2.0], [2.0, 4.0], [1e38] * k, [3e38] * k, [1e-40, *[0.0] * (k - 1)], [2e-40, *[0.0] * (k - 1)]]
    labels = [0, 0, 0, 1, 2, None, 9]
    out = [(i, x, labels[i % 7], 1, "d", 2, 3) for i, x in enumerate(rows)]
    return [*out, (5, rows[8], 1, 1, "d", 2, 3), (5, rows[5], 1, 1, "d", 2, 3), (None, rows[3], 1, 1, "d", 2, 3), (1_000_050, rows[1], None, 1, "d", 2, 3)]


def usable(x) -> bool:
    return x is not None and len(x) > 0 and all(c is not None and np.isfinite(c) for c in x)


def brute_links(rows, threshold=0.9):
    """(id, links, component) of each row."""
    v = [np.array(x, np.float32).astype(np.float64) if i is not None and usable(x) and any(np.float32(c) != 0 for c in x) else None for i, x, *_ in rows]
    links, up = [0] * len(rows), {i: i for i, *_ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if v[a] is not None and v[b] is not None and len(v[a]) == len(v[b]):
                p, q = v[a] / np.abs(v[a]).max(), v[b] / np.abs(v[b]).max()
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((top(rows[a][0]), top(rows[b][0])))
                    up[y] = x
    return sorted(((i, n, top(i), i == top(i)) for (i, *_), n in zip(rows, links, strict=True)), key=repr)


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame(odd_vectors(), VECTORS).repartition(3).write.parquet(f"{d}/embeddings.parquet")
    return d


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile", [7, 64, 4096])
def test_near_vectors(spark, vectors, tile):
    rows = spark.read.parquet(f"{vectors}/embeddings.parquet")
    got = embedding_dedup.near_vectors(rows, tile=tile)
    assert got.columns == ["id", "n_links", "component_id", "kept"]
    assert found(got) == brute_links(odd_vectors())


def test_near_vectors_at_other_thresholds(spark, vectors):
    rows = spark.read.parquet(f"{vectors}/embeddings.parquet")
    for threshold in (0.55, 0.999):
        assert found(embedding_dedup.near_vectors(rows, threshold=threshold, tile=50)) == brute_links(odd_vectors(), threshold)


def test_far_tiles_are_not_multiplied(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 32))
    rows = [(i, [float(x) for x in centres[i % 8] + 0.02 * rng.normal(size=32)]) for i in range(800)]
    coded = embedding_dedup.coded(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v").withColumn("copies", F.lit(1).cast("long"))
    tiles = embedding_dedup.packed_tiles(embedding_dedup.tiled(embedding_dedup.near_pivots(coded, 64), 50))
    n = tiles.count()
    assert embedding_dedup.units(tiles, 0.9).select("a", "b").distinct().count() < 0.4 * n * (n + 1) / 2
    got = found(embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=50))
    assert got == [(i, 99, i % 8, i < 8) for i in sorted(range(800), key=lambda i: repr((i, 99)))]


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    for k in (1, 3, 64, 1500):
        m = rng.normal(size=(40, k)) * rng.choice([1, 1e-3, 50], size=(40, k))
        scaled, norm, _ = embedding_dedup.scaled_rows(m)
        unit = scaled / norm[:, None]
        tile = object.__new__(embedding_dedup._Tile)
        tile.ids = np.arange(40)
        tile.codes, tile.scale, tile.inner, tile.outer = embedding_dedup.quantise(unit)
        cosine, met = unit @ unit.T, set()
        for i, j, low, high in embedding_dedup.bounded_pairs(tile, tile, 0.5, True):
            assert (low <= cosine[i, j]).all() and (cosine[i, j] <= high).all()
            met |= set(zip(i.tolist(), j.tolist(), strict=True))
        assert {(a, b) for a in range(40) for b in range(a + 1, 40) if cosine[a, b] >= 0.5} <= met


def test_forest_joins_what_edges_join():
    rng = random.Random(3)
    for _ in range(30):
        n = rng.randint(2, 40)
        e = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(1, 50))]
        u, v = embedding_dedup.forest(np.array([a for a, _ in e]), np.array([b for _, b in e]))
        assert len(u) < n

        def parts(edges):
            label = {x: x for ab in e for x in ab}
            for _ in range(n):
                for a, b in edges:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert parts(e) == parts(list(zip(u.tolist(), v.tolist(), strict=True)) + [(a, a) for a, _ in e])


# filter audit


def brute_masks(rows):
    out, first = [], {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in rows:
        t = t or ""
        words = [w for w in t.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > first[t]]
        out.append((i, part or "", sum(f << k for k, f in enumerate(fails))))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base, long = prose(120), prose(20_000)
    texts = [None, "", " \t\x0b\x0c\r\n", base, base, base + " ", base[:-1] + "#", base.upper(), prose(49), prose(50), "w " * 60, "É" * 300, "é x " * 60, long, long, long[:-1] + "Z", long[:200] + "Z" + long[201:], "A" * 4 + "b" * 76, "A" * 4 + "b" * 75, "\U0001f600" * 5000, "x" * 5_000_000, "x" * 5_000_000, " " * 1_000_000, base, None, "", "a|b"]
    rows = [(3 * i + 1, t, ["a", "a", None, "", "b"][i % 5]) for i, t in enumerate(texts)]
    return [*rows, (None, base, "a"), (10, base, "a"), (10, prose(70), "b"), (13, base, "c")]


@pytest.fixture(scope="module")
def audited(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("audited"))
    rows = [(*r, 1, "m", 2, "h", 3) for r in odd_rows()]
    spark.createDataFrame(rows, "doc_id long, text string, source string, id long, mask string, len int, h string, part int").repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(1, 1, 0, 5), (4, 1, 1, 5), (13, 0, 1, 5), (13, 1, None, 5), (None, 1, 1, 5), (40, None, 1, 5), (999, 1, 1, 5), (10, 1, 0, 5)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, id int").write.parquet(f"{d}/labels.parquet")
    return d


def test_masks(spark, audited):
    assert found(filter_audit.masks(spark.read.parquet(f"{audited}/documents.parquet"))) == brute_masks(odd_rows())


def test_masks_when_hashes_collide(spark, audited, monkeypatch):
    """Only the full comparison tells texts apart here."""
    monkeypatch.setattr(filter_audit, "block_hashes", lambda text, edges: F.array(*[F.lit(7).cast("long") for _ in edges]))
    monkeypatch.setattr(filter_audit, "FIRST_BLOCK", 8)
    rows = [(i, f"{'ab'[i % 2]}{i % 3}{'x' * (i % 4)}", "s") for i in range(60)]
    assert found(filter_audit.masks(spark.createDataFrame(rows, "doc_id long, text string, source string"))) == brute_masks(rows)


def same_as_sql(spark, d, name):
    df = entry.queries()[name](spark, d)
    c = duckdb.connect()
    for t in os.listdir(d):
        if t.endswith(".parquet"):
            p = f"{d}/{t}"
            c.execute(f"create view {t[:-8]} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    cursor = c.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == sorted(map(repr, cursor.fetchall()))
    return df


def test_audit(spark, audited):
    df = same_as_sql(spark, audited, "op12_filter_audit")
    assert df.count() == 600 * 4


def test_audit_of_shortest_block(spark, audited, monkeypatch):
    monkeypatch.setattr(filter_audit, "FIRST_BLOCK", 3)
    monkeypatch.setattr(filter_audit, "GROWTH", 2)
    assert filter_audit.block_edges(10) == [(0, 3), (3, 9), (9, 21)]
    docs = spark.read.parquet(f"{audited}/documents.parquet").where("length(text) < 2000 or text is null")
    assert found(filter_audit.masks(docs)) == brute_masks([r for r in odd_rows() if len(r[1] or "") < 2000])


# hard negatives


def brute_negatives(rows, anchors=lambda i: i % 50 == 0, positives=5, negatives=3):
    """By the contract, in Python's integers."""
    own = {}
    for i, x, label, *_ in rows:
        if i is not None and label is not None and usable(x):
            v = [int(np.floor(256 * float(np.float32(c)))) for c in x]
            packed = np.array(v, "<i8").tobytes()
            own[i] = min(own.get(i, (99, 0, b"", 0)), ((label + 1) % 10 if i % 7 == 0 else label, len(v), packed, v))
    out = []
    for a in filter(anchors, own):
        score = {b: sum(p * q for p, q in zip(own[a][3], own[b][3], strict=True)) for b in own if b != a and own[b][1] == own[a][1]}
        score = {b: s for b, s in score.items() if abs(s) < 1 << 63}
        best = sorted(((-s, b) for b, s in score.items() if own[b][0] == own[a][0]))[:positives]
        for ps, p in best:
            fits = sorted((-s, b) for b, s in score.items() if own[b][0] != own[a][0] and 50 * -ps <= 100 * s <= 95 * -ps)[:negatives]
            out += [(a, p, k, b, -ps, -s) for k, (s, b) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def small_vectors():
    rows = [r for r in odd_vectors() if r[1] is None or not any(c is not None and np.isfinite(c) and abs(c) > 1e30 for c in r[1])]
    return [(i, [float("nan") if c is None else c for c in x] if x is not None else None, *rest) for i, x, *rest in rows]


@pytest.mark.parametrize("size", [(3, 17), (1024, 8192)])
def test_hard_negatives(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "ANCHORS", size[0])
    monkeypatch.setattr(hard_negatives, "ROWS", size[1])
    rows = small_vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = found(hard_negatives.hard_negatives(df, F.col("id") % 5 == 0, label))
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and len(got) > 200


def test_hard_negatives_with_ties_and_wide_values(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)], rng.randint(0, 2)) for i in range(150)]
    rows += [(1000 + i, [float(rng.randint(-3, 3)) * 10.0**rng.randint(0, 9) for _ in range(3)], rng.randint(0, 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows.append((2001, [1e30, 1.0, 1.0], 1))  # takes no part
    df = df.union(spark.createDataFrame(rows[-1:], df.schema))
    rows = rows[:-1]
    assert found(hard_negatives.hard_negatives(df, F.col("id") % 3 == 0, label)) == brute_negatives(rows, lambda i: i % 3 == 0)


def test_planes_narrow_to_exact_scores():
    rng = np.random.default_rng(7)
    a, r = rng.integers(-300, 300, (9, 16)), rng.integers(-300, 300, (50, 16))
    base, planes = hard_negatives.bit_planes(r)
    want = a @ r.T
    seen = []

    def keep(i, j, low, high):
        assert (low <= want[i, j]).all() and (want[i, j] <= high).all()
        seen.append(float((high - low).max()))
        return high >= 20_000

    i, j, score = hard_negatives.narrowed(a, base, planes, np.ones((9, 50), bool), keep)
    assert seen == sorted(seen, reverse=True) and seen[-1] == 0
    assert set(zip(i.tolist(), j.tolist(), score.tolist(), strict=True)) == {(p, q, int(want[p, q])) for p in range(9) for q in range(50) if want[p, q] >= 20_000}
    i, j, score = hard_negatives.exact(a, base, planes, np.ones((9, 50), bool))
    assert (score == want.ravel()).all()


@pytest.mark.parametrize("name", ["op11_embedding_near_dedup", "op12_filter_audit", "op13_hard_negatives"])
def test_sql(spark, name):
    same_as_sql(spark, SF, name)


@pytest.mark.parametrize("name", ["op11_embedding_near_dedup", "op12_filter_audit", "op13_hard_negatives"])
def test_empty_tables(spark, tmp_path, name):
    for t, schema in (("embeddings", VECTORS), ("documents", "doc_id long, text string, source string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    assert found(entry.queries()[name](spark, str(tmp_path))) == []


# very long texts


def test_ids_of_long_blanks():
    import public_tokenizers
    import tokenizers

    from scriptoria.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, whole = packing.encoder(path), tokenizers.Tokenizer.from_file(path)
    n = 70_000
    for t in (" " * 1_200_000, "\n" * 1_200_000 + " x", "a" + "\t" * n + "b", "it's" + " \n" * n + "'s", "a\xa0" + " " * n + "\x1c", "a" + " " * n + "<|endoftext|>" + " " * n + "z", "x" * 1_000_000):
        assert packing.token_ids(enc, t) == whole.encode(t, add_special_tokens=False).ids


def test_language_sample_is_bounded_in_bytes(spark):
    from scriptoria.llm import langid

    docs = spark.createDataFrame([(i, "ab" * 500, ["en", "de"][i % 2]) for i in range(400)] + [(1000, "x" * 50_000, "fr")], "doc_id long, text string, lang string")
    every = langid.training_rows(docs, F.lit(True), 1000, 20_000)
    assert every.count() == 401
    some = langid.training_rows(docs, F.lit(True), 1000, 20_000, max_bytes=150_000).groupBy("lang").agg(F.sum(F.length("text")).alias("b")).collect()
    assert {r["lang"] for r in some} == {"en", "de", "fr"} and all(0 < r["b"] < 90_000 for r in some if r["lang"] != "fr")


LONG_TEXTS = ["x" * 5_000_000, " " * 5_000_000, "ab " * 1_600_000, "\n" * 1_200_000 + "end"]


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("long"))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*LONG_TEXTS, *LONG_TEXTS[:2], "a b c"], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n.split("_")[0] not in ("op5", "op6", "op11", "op12", "op13")])
def test_long_texts(spark, long_texts, name):
    rows = entry.queries()[name](spark, long_texts).collect()
    if name.startswith("op8"):
        tokens = {1: 625_000, 2: 5_000_000, 5: 625_000, 6: 5_000_000}
        got: dict[int, int] = {}
        for r in rows:
            got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert {i: got[i] - 1 for i in tokens} == tokens
    elif name.startswith("op9"):
        assert not any(getattr(r, "doc_id", None) not in range(1, 8) for r in rows)
    else:
        assert len(rows) >= 7
    if "kept" in (rows[0].asDict() if rows else {}):
        gone = {r["doc_id"] for r in rows if not r["kept"]}
        assert gone == ({1, 2} if name.startswith("op2") else {5}), gone
