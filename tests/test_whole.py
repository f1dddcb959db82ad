"""Queries that do the whole of what a query bound to its SQL does in part."""

import itertools
import random

from corpuslake.operators.keyed import ranked
from corpuslake.plans import catalog, inventory

from .oracle import both


def made(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_names_of_one_brand_and_any_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("corpuslake.plans.inventory.HOT", 5)  # every word is hot
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("red blue big hot ring bolt nut the cap".split(), k=rng.randrange(1, 7))), f"b{i % 2}", i) for i in range(80)] + [(98, None, "b0", 98), (99, "the", "b0", 99)]
    folder = made(spark, tmp_path, "part", rows, "p_partkey long, p_name string, p_brand string, p_size int")
    words = {k: set((n or "").split()) - {"the"} for k, n, _, _ in rows}
    want = set()
    for (a, _, x, _), (b, _, y, _) in itertools.combinations(rows, 2):
        i, u = words[a] & words[b], words[a] | words[b]
        if x == y and i and (len(i) / len(u) >= 0.4 or i in (words[a], words[b])):
            want.add((a, b, round(len(i) / len(u), 6)))
    assert any(s < 0.4 for _, _, s in want)
    assert sorted(map(tuple, catalog.QUERIES["names_similar_brand"](spark, folder).collect())) == sorted(want)


def test_hits_beyond_4000_characters(spark, tmp_path):
    folder = made(spark, tmp_path, "documents", [(1, "x " * 3000 + "shall § menu"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, catalog.QUERIES["text_quality_whole"](spark, folder).collect())) == [(1, 2, 1, 6), (2, 0, 0, 0)]


def test_every_real_line_is_parsed(spark, tmp_path):
    folder = made(spark, tmp_path, "events", [(i, f'{{"k": {i * 2}}}') for i in range(1, 15)] + [(21, "no json")], "event_id long, props string")
    assert sorted(map(tuple, catalog.QUERIES["jsonl_lenient_every"](spark, folder).collect())) == [(i, i * 2) for i in range(1, 15)]


def test_names_of_repeated_keys_and_of_many_rows(spark, tmp_path, monkeypatch):
    """Rows are paired as in the SQL: a key's rows with other keys, each by its
    own name; the rows of one name in many blocks and tasks."""
    monkeypatch.setattr("corpuslake.plans.inventory.BLOCK", 4)
    monkeypatch.setattr("corpuslake.plans.inventory.PAIRS", 100)
    rows = [(1, "red bolt", "b"), (1, "red bolt", "b"), (1, "hot cap", "b"), (2, "Bolt, red", "b"), (3, "cap", "b"), (None, "cap", "b"), (4, "cap", None)] + [(10 + i, "big nut", "c") for i in range(60)]
    folder = made(spark, tmp_path, "part", rows, "p_partkey long, p_name string, p_brand string")
    got, want = both(spark, catalog.QUERIES["names_match"], catalog.SQL["names_match"], folder)
    assert got == want and len(want) == 2 + 1 + 60 * 59 // 2
    assert catalog.QUERIES["names_match"](spark, folder).rdd.getNumPartitions() >= 18  # no task lists all


def test_rows_of_different_names_meet_in_blocks(spark, tmp_path, monkeypatch):
    """Names with a third to all of their words in common, of more rows than a
    block has, with keys of several rows: the SQL's rows, each as often."""
    monkeypatch.setattr("corpuslake.plans.inventory.BLOCK", 3)
    rng = random.Random(4)
    rows = [(rng.randrange(60), rng.choice(["red bolt", "bolt of red", "red hot bolt", "red", "big bolt nut", "", "the"]), f"b{rng.randrange(2)}") for _ in range(120)]
    folder = made(spark, tmp_path, "part", rows, "p_partkey long, p_name string, p_brand string")
    got, want = both(spark, catalog.QUERIES["names_similar_brand"], catalog.SQL["names_similar_brand"], folder)
    assert got == want and len(want) > len(set(want)) and len({s for *_, s in want}) > 3


def test_no_names_are_sent_to_the_driver(spark, tmp_path, monkeypatch):
    """Many names are small compressed, so Spark would broadcast them through
    the driver: only one row for each partition may be."""
    monkeypatch.setattr("corpuslake.plans.inventory.COMPARED", 50, raising=False)
    sent = lambda df: (df.collect(), df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0].count("BroadcastHashJoin"))[1]
    names = [(i, f"red bolt x{i % 20}", "b") for i in range(60)]
    folder = made(spark, tmp_path, "part", names, "p_partkey long, p_name string, p_brand string")
    assert sent(catalog.QUERIES["names_similar_brand"](spark, folder)) == 0
    sets = inventory.similar_sets(spark.createDataFrame([("b", f"bolt red x{i}") for i in range(20)], "scope string, name string"), 0.4)
    assert sent(sets) == 0 and sets.count() == 190
    assert sent(ranked(spark.createDataFrame([(i % 7, i) for i in range(70)], "k long, v long"), ["k"], ["v"], "n")) == 2  # the rows of the partitions before, for rows and firsts
