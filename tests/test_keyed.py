"""Row numbers, lists and quantiles of hot, null and empty keys; the shared
folder; record files too large to read whole."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslake import session
from corpuslake.functions.text import selected_states
from corpuslake.operators.hotkeys import key_quantiles
from corpuslake.operators.keyed import listed, numbered, ranked
from corpuslake.plans.inventory import similar_names
from corpuslake.sources import readers


def rows_of(spark, n=4000):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(90)}", rng.randrange(300), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, v long, part long").repartition(7)


def test_numbers_are_global_and_within_keys(spark):
    rows, df = rows_of(spark)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], r[2]))
    got = {r.part: r.no for r in numbered(df, ["k", "v", "part"], "no", 5).collect()}
    assert got == {r[2]: i for i, r in enumerate(order)}
    place, want = {}, {}
    for k, _, i in order:
        place[k] = place.get(k, 0) + 1
        want[i] = place[k]
    assert {r.part: r.n for r in ranked(df, ["k"], ["v", "part"], "n").collect()} == want
    down = {r.part: r.n for r in ranked(df, ["k"], [F.col("v").desc(), F.col("part").desc()], "n").collect()}
    assert all(down[i] == place[k] + 1 - want[i] for k, _, i in rows)
    for taken in (lambda: numbered(df, ["k"], "v"), lambda: ranked(df, ["k"], ["v"], "part"), lambda: listed(df.withColumnRenamed("part", "p").withColumnRenamed("k", "part"), ["part"], ["v"], F.col("v"), 5, "l")):
        with pytest.raises(ValueError):
            taken()
    assert numbered(df.limit(0), ["k"], "no").count() == ranked(df.limit(0), ["k"], ["v"], "n").count() == 0


def test_lists_are_short_and_whole(spark):
    rows, df = rows_of(spark)
    got = listed(df, ["k"], ["part"], F.col("part"), 100, "items").collect()
    assert max(len(r["items"]) for r in got) == 100
    for k in {r[0] for r in rows}:
        mine = sorted((r.part, r["items"]) for r in got if r.k == k)
        assert [x for _, items in mine for x in items] == sorted(r[2] for r in rows if r[0] == k)
        assert [p for p, _ in mine] == list(range(len(mine)))
    odd = spark.createDataFrame([(None, 2, None), (None, 1, "a"), ("x", 1, None)], "k string, o int, v string")
    assert {(r.k, r.part): list(r["items"]) for r in listed(odd, ["k"], ["o"], F.col("v"), 9, "items").collect()} == {(None, 0): ["a", None], ("x", 0): [None]}
    assert listed(df.limit(0), ["k"], ["part"], F.col("part"), 9, "items").count() == 0


def test_quantiles_of_hot_null_and_rare_keys(spark):
    rows, df = rows_of(spark)
    rows += [("empty", None, -1)]
    df = df.unionByName(spark.createDataFrame([("empty", None, -1)], "k string, v long, part long"))
    got = {r.key: r for r in key_quantiles(df, "k", "v", [0.5, 0.9, lambda n: n], bins=8).collect()}
    for k in {r[0] for r in rows}:
        values = sorted(r[1] for r in rows if r[0] == k and r[1] is not None)
        assert got[k].n == len(values)
        if values:
            assert list(got[k].q) == [values[max(1, -(-len(values) * q // 10)) - 1] for q in (5, 9, 10)]
        else:
            assert got[k].q is None
    assert key_quantiles(df.limit(0), "k", "v", [0.5]).count() == 0


def test_a_cluster_must_name_the_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Scala:
                    @staticmethod
                    def getCheckpointDir():
                        class Empty:
                            @staticmethod
                            def isDefined():
                                return False

                        return Empty

                return Scala

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Session)
    kept = session.write_shared(spark.range(3), "kept")
    assert kept.count() == 3
    session.clear_shared(spark)
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0]).count()


def test_files_too_large_to_read_whole_are_read_by_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text("[\n" + ",\n".join(json.dumps({"x": i}) for i in range(50)) + "\n]")
    (tmp_path / "b.json").write_text('{\n"hasPart": [{"x": 100},\n{"x": 101}]\n}')
    whole = sorted(json.loads(r.record)["x"] for r in readers.json_records(spark, str(tmp_path)).collect())
    assert whole == [*range(50), 100, 101]
    monkeypatch.setattr(readers, "WHOLE", 100)
    assert sorted(json.loads(r.record)["x"] for r in readers.json_records(spark, str(tmp_path)).collect()) == whole
    (tmp_path / "b.json").unlink()
    (tmp_path / "a.json").unlink()
    assert readers.json_records(spark, str(tmp_path)).count() == 0


def test_selected_states():
    assert selected_states(["ny, CA", None, "", "ca,X1,tex,Ny", "or"]) == ["NY", "CA", "OR"]


def test_similar_names_are_those_of_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, rng.choice("ab"), " ".join(rng.sample(words, rng.randrange(0, 6)))) for i in range(120)] + [(500, "a", None), (501, None, "w1 w2")]
    df = spark.createDataFrame(rows, "id long, g string, n string").withColumn("w", F.lit(1))
    for least in (0.4, 0.6):
        want = set()
        for i, g, n in rows:
            for j, h, m in rows:
                a, b = set((n or "").split()), set((m or "").split())
                if i < j and g == h and g and a and b and (len(a & b) >= least * len(a | b) or a <= b or b <= a):
                    want.add((i, j))
        assert {(r.left_key, r.right_key) for r in similar_names(df, "id", "g", "n", least).collect()} == want


def test_cdx_files_and_packed_bytes(spark, tmp_path):
    import gzip
    import zlib

    folder = tmp_path / "CC-MAIN-2021-04"
    folder.mkdir()
    with gzip.open(folder / "cdx-00000.gz", "wt") as f:
        f.write('com,a)/ 2021 {"url": "http://a", "status": "200", "length": "7"}\nbroken\n')
    got = readers.cdx(spark, str(tmp_path)).first()
    assert (got.url, got.status, got.length, got.collection) == ("http://a", 200, 7, "CC-MAIN-2021-04")
    df = spark.createDataFrame([(bytearray(x),) for x in (gzip.compress(b"one"), zlib.compress(b"two"), b"<!DOCTYPE html><p>", b"")] + [(None,)], "b binary")
    assert [r[0] and bytes(r[0]) for r in df.select(readers.inflate("b")).collect()] == [b"one", b"two", b"<!DOCTYPE html><p>", b"" or bytearray(), None]
    assert [r[0] for r in df.select(readers.looks_like_html(F.col("b"))).collect()][2:] == [True, False, None]


def test_vector_index_recall_and_hot_lists(spark, monkeypatch):
    """Against exact search: all lists probed give the same; as many as the
    fit asks for at least 0.9. One list holds a third of all vectors and is split."""
    from corpuslake.operators import vectors

    monkeypatch.setattr(vectors, "BLOCK", 60)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    data = np.concatenate([centres[0] + 0.1 * rng.normal(size=(500, 16)), centres[rng.integers(0, 30, 1000)] + 0.4 * rng.normal(size=(1000, 16))])
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(9000, None), (9001, []), (None, data[0].tolist())]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("list", F.lit(0))
    asked = df.where("id % 20 = 0")
    pick = lambda x: {(r.query_id, r.id) for r in x.collect()}
    exact = pick(vectors.top_k(df.where("id is not null"), asked, "id", "v", 5))
    assert pick(vectors.index_top_k(df, asked, "id", "v", 5, lists=32, probes=32)) == exact
    near = pick(vectors.index_top_k(df, asked, "id", "v", 5, lists=32))
    assert len(near & exact) >= 0.9 * len(exact) and 1 <= vectors.fit_index(df, "id", "v", 32)[1] < 16
    assert vectors.index_top_k(df.limit(0), asked, "id", "v", 5).count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no test tables here")
def test_vector_index_recall_on_the_test_vectors(spark):
    from corpuslake.plans import catalog

    pick = lambda name: {(r.query_id, r.vec_id) for r in catalog.QUERIES[name](spark, "/root/testdata/sf0.01").collect()}
    near, exact = pick("vector_index_topk"), pick("cosine_topk")
    assert len(near & exact) >= 0.9 * len(exact)
