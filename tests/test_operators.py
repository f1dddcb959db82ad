import hashlib
import json

import numpy as np
from pyspark.sql import functions as F

from corpuslake.functions import text as X, url as U
from corpuslake.functions.cid import canonical_any, cid_of_text, cid_v1
from corpuslake.operators.components import connected_components
from corpuslake.operators.documents import subsections, tree_issues
from corpuslake.operators.hotkeys import key_quantiles
from corpuslake.operators.keyed import best_by_key, latest_by_key, numbered, priority_union, runs
from corpuslake.operators.vectors import top_k
from corpuslake.sources import readers, sinks


def value(spark, column, **row):
    df = spark.createDataFrame([tuple(row.values())] if row else [(1,)], ", ".join(f"{k} string" for k in row) or "x int")
    return df.select(column).first()[0]


def test_key_quantiles_against_sorting(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", int(v)) for v in rng.integers(-(10**12), 10**12, 3000)] + [("cold", 5), ("cold", 5), ("one", -7), (None, 3), ("empty", None)]
    df = spark.createDataFrame(rows, "key string, v long").withColumn("lo", F.lit("clash"))
    got = {r.key: r for r in key_quantiles(df, "key", "v", [0.0, 0.5, 0.9, 1.0], bins=7).collect()}
    assert set(got) == {"hot", "cold", "one", None, "empty"}
    hot = sorted(v for k, v in rows if k == "hot")
    assert got["hot"].q == [hot[0], hot[1499], hot[2699], hot[2999]]
    assert got["cold"].q == [5] * 4 and got[None].q == [3] * 4 and got["empty"].q is None and got["empty"].n == 0
    assert key_quantiles(df.limit(0), "key", "v", [0.5]).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 102), (101, 102), (5, 5), (None, 7), (102, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(1, 31)} == {1} and {got[i] for i in (100, 101, 102)} == {100} and len(got) == 33
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_runs_cover_every_row_once(spark):
    rows = [("f", i, v) for i, v in enumerate(["a", "a", None, None, "b", "a"])] + [("g", 0, "a")]
    got = runs(spark.createDataFrame(rows, "f string, p int, v string"), "v", "p", ["f"]).collect()
    assert sorted((r.f, r.start, r.v, r.length) for r in got) == [("f", 0, "a", 2), ("f", 2, None, 2), ("f", 4, "b", 1), ("f", 5, "a", 1), ("g", 0, "a", 1)]


def test_fold_is_sequential_replay(spark):
    rng = np.random.default_rng(2)
    rows = [(f"u{rng.integers(5)}", i, None if rng.random() < 0.4 else f"c{i}") for i in range(200)]
    state = {}
    for u, i, c in rows:
        n, _, old = state.get(u, (0, None, None))
        state[u] = (n + 1, i, c if c is not None else old)
    df = spark.createDataFrame(rows, "u string, i int, c string").repartition(7)
    got = latest_by_key(df, "u", F.col("i"), ["i"], ["c"])
    assert {r.u: (r.attempts, r.i, r.c) for r in got.collect()} == state


def test_best_row_ties_keep_the_first(spark):
    df = spark.createDataFrame([("k", 1, 3), ("k", 2, 3), ("k", 3, None), (None, 4, 1)], "k string, o int, q int")
    assert {(r.k, r.o) for r in best_by_key(df, ["k"], [F.col("q")], F.col("o")).collect()} == {("k", 1), (None, 4)}


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.v == r.n for r in numbered(df, ["v"], "n", 5).collect())


def test_priority_union(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert {(r.k, r.v, r.tier) for r in priority_union([a, b], "k").collect()} == {("x", 1, 0), ("y", 3, 1)}


def test_top_k_is_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 8))
    v[7] = v[3]  # a tie
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(999, None)], "id long, v array<double>")
    got = top_k(df, df.where("id % 20 = 0"), "id", "v", 4)
    for q in range(0, 300, 20):
        s = v @ v[q]
        want = sorted(range(300), key=lambda i: (-round(s[i], 9), i))[:4]
        assert [r.id for r in sorted(got.where(F.col("query_id") == q).collect(), key=lambda r: r["rank"])] == want


def test_cid_is_hashlib(spark):
    for t in ('{"a":"é","b":1}', "", "x" * 5000):
        assert value(spark, cid_v1(F.col("t")), t=t) == cid_of_text(t)
    assert cid_of_text('{"a":"é","b":1}') == "baguqeeravjmpxkcigyr35u34dmbo37gl3wnfgeryg7bax6smwqcjte5cq4xa"
    assert value(spark, canonical_any(F.col("t")), t='{"b": 1.0, "a": {"y": 1, "x": "é"}, "cid": "q"}') == '{"a":{"x":"é","y":1},"b":1.0}'
    assert value(spark, canonical_any(F.col("t")), t="[1") is None


def test_shard_is_hashlib(spark):
    for u in ("https://x.gov/", "", "ü"):
        want = int.from_bytes(hashlib.sha256(u.encode()).digest()[:8], "big") % 4
        assert value(spark, U.shard(F.col("u"), 4), u=u) == want
    assert value(spark, U.shard(F.col("u"), 1), u="x") == 0


def test_url_functions(spark):
    u = F.col("u")
    assert value(spark, U.host_rev(u), u="A.b..Gov.") == "gov,b,a"
    assert value(spark, U.domain(u), u="HTTPS://www.X.gov:80/p?q") == "x.gov:80"
    assert value(spark, U.typed_domain(u), u=" https://www.X.gov/path ") == "x.gov"
    assert value(spark, U.seed(u), u="http://a//b///c/?q#f") == "http://a/b/c"
    assert value(spark, U.registrable(u), u="a.b.ca.us") == "b.ca.us"
    assert value(spark, U.last_segment_title(u), u="http://a/x/city-of%20light/") == "City Of Light"
    assert value(spark, U.crawl_year(u), u="CC-MAIN-2019-25") == 2019 and value(spark, U.crawl_year(u), u="x") is None
    assert value(spark, U.find_urls(u), u="see http://a/b, https://c;x") == ["http://a/b", "https://c"]
    df = spark.createDataFrame([("gov,x",), ("gov,x,a",), ("gov,xy",), (None,)], "h string")
    assert df.where(U.within(F.col("h"), "www.X.gov")).count() == 2 and df.where(U.within(F.col("h"), "")).count() == 0


def test_text_functions(spark):
    t = F.col("t")
    assert value(spark, X.norm(t), t="  x \t") == "x" and value(spark, X.collapse(t), t=" a \n b ") == "a b"
    assert value(spark, X.first_true(t, F.lit("z")), t="  ") == "" and value(spark, X.first_true(t, F.lit("z")), t="") == "z"
    assert value(spark, X.html_title(t), t="<TITLE a='b'>\n A  title - Site</title>") == "A title"
    assert value(spark, X.listed_states(F.array(t), "stalled"), t="stalled:az,IN,az") == ["AZ", "IN"]
    assert value(spark, X.jaccard(X.name_tokens(t), X.name_tokens(F.lit("The Fire of Office"))), t="fire office") == 1.0


def test_subsections():
    got = subsections("Head (1) one (a) x (b) y (2) two (a) (1) again")
    assert [(r["path"], r["depth"]) for r in got] == [("", 0), ("1", 1), ("1/a", 2), ("1/b", 2), ("2", 1), ("2/a", 2)]
    assert got[1]["text"] == "one again" and subsections(None)[0]["text"] == ""


def test_tree_issues(spark):
    rows = [(1, "1", 1, "1", "number", "x"), (1, "3", 1, "3", "number", ""), (2, "1", 1, "1", "number", "y")]
    df = spark.createDataFrame(rows, "id int, path string, depth int, token string, kind string, text string")
    assert {tuple(r) for r in tree_issues(df, "id").collect()} == {(1, "gap"), (1, "empty")}


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"hasPart": [{"x": 1}, {"x": 2}]}))
    (tmp_path / "b.json").write_text('[{"x": 3}, 7]')
    (tmp_path / "c.json").write_text('{"x": 4}\nbroken\n{"x": 5}\n')
    got = readers.json_records(spark, str(tmp_path))
    assert sorted(json.loads(r.record)["x"] for r in got.collect()) == [1, 2, 3, 4, 5]
    lines = spark.createDataFrame([('{"url": "http://a", "timestamp": "2"}',), ('com,a)/ 3 {"url": "http://b"}',), ("x 4 http://c z",), ("",), ("# no",)], "l string")
    assert sorted(map(tuple, readers.parse_cdx_any(lines, "l").collect())) == [("http://a", "2"), ("http://b", "3"), ("http://c", "4")]
    (tmp_path / "t.csv").write_text('gnis,place_name,state_code,source_url,status\n12,"A, B",OR,"http://x, http://y",ok\nbad, C ,WA,,\n')
    rows = readers.towns_csv(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.gnis, r.place_name) for r in rows] == [(12, "A, B"), (0, "C")]
    assert readers.files(spark, str(tmp_path), "*.csv").count() == 1


def test_page_and_archive_readers(spark):
    import gzip

    member = gzip.compress(b"WARC/1.0\r\nX: 1\r\n\r\nHTTP/1.1 200\r\nA: b\r\n\r\n<html>body")
    df = spark.createDataFrame([(bytearray(member),), (bytearray(b"x"),), (None,)], "b binary")
    assert [r[0] and bytes(r[0]) for r in df.select(readers.warc_body("b")).collect()] == [b"<html>body", None, None]
    html = "<script>x</script><p>One  two<br>three <a href='../q'>go <b>on</b></a>"
    df = spark.createDataFrame([(html, "http://a/b/c"), (None, None)], "h string, u string")
    assert df.select(readers.html_lines("h")).first()[0] == ["One two", "three go on"]
    assert [tuple(x) for x in df.select(readers.html_links("h", "u")).first()[0]] == [("http://a/q", "go on")]
    assert value(spark, readers.xml_first(F.col("x"), "/a/c", "/a/b"), x="<a><b> t </b></a>") == "t"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "k string, v int")
    sinks.parquet(df, str(tmp_path / "p"), sort=["k"])
    sinks.by_key(df, str(tmp_path / "k"), "k")
    sinks.jsonl(df, str(tmp_path / "j"))
    sinks.manifest(spark, {"n": 3}, str(tmp_path / "m.json"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == spark.read.parquet(str(tmp_path / "k")).count() == spark.read.json(str(tmp_path / "j")).count() == 3
    assert json.loads((tmp_path / "m.json").read_text()) == {"n": 3}


def test_row_groups_of_whole_and_broken_files(spark, tmp_path):
    spark.range(1000).repartition(2).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "broken.parquet").write_bytes(b"PAR1 cut off")
    got = readers.row_groups(spark, str(tmp_path / "t"), "id").collect()
    assert sum(r.rows for r in got) == 1000 and len({r.path for r in got}) == 2
    assert min(int(r.low) for r in got) == 0 and max(int(r.high) for r in got) == 999 and {r.row_group for r in got} == {0}
