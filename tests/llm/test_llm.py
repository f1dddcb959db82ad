import itertools
import json
import os
import random
import re
from collections import Counter
from math import comb

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

llm = pytest.importorskip("corpuslake.llm")

from corpuslake.llm import abusive, best_record, containers, encode, main_content, near_duplicates, page_lines, repeated_lines, template_residue  # noqa: E402
from corpuslake.llm.records import record_text  # noqa: E402

ENC = encode.encoder(encode.tokenizer_path())
WORDS = "alpha beta gamma delta omega permit zone council river bridge school market annual order notice".split()


# -- 1: near duplicates -----------------------------------------------------
def sets(text, k):
    w = re.findall("[a-z0-9]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}, len(w)


def test_near_duplicates_are_those_of_brute_force(spark):
    rng = random.Random(5)
    fresh = lambda n: [rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n)]
    rows = []
    for i in range(40):
        base = fresh(120)
        rows.append(("t", f"k{i}a", " ".join(base)))
        for j in range(rng.randrange(4)):
            other = list(base)
            for _ in range(rng.randrange(1, 14)):
                other[rng.randrange(len(other))] = "x" + str(rng.randrange(10**6))
            rows.append(("t", f"k{i}{'bcde'[j]}", " ".join(other)))
    rows += [("t", "copy", rows[0][2].upper() + "!"), ("u", "k0a", rows[0][2]), ("t", "short", "a b c"), ("t", "empty", ""), ("t", "null", None), ("t", None, "x " * 80), ("t", "long", "w " * 30000)]
    df = spark.createDataFrame(rows, "grp string, key string, text string").withColumn("bands", F.lit(1)).repartition(3)
    pairs, members = near_duplicates.near_duplicates(df, "key", "text", "grp", k=3, threshold=0.6, least_words=50)
    got = {tuple(r) for r in near_duplicates.expand(pairs, members).collect()}
    want = set()
    for (g, a, s), (h, b, t) in itertools.combinations([r for r in rows if r[1] and r[2]], 2):
        (p, n), (q, m) = sets(s, 3), sets(t, 3)
        if g == h and min(n, m) >= 50 and len(p & q) >= 0.6 * len(p | q):
            want.add((g, min(a, b), max(a, b)))
    assert got == want and ("t", "copy", "k0a") in got
    empty, _ = near_duplicates.near_duplicates(df.limit(0), "key", "text", "grp")
    assert empty.count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    need = near_duplicates.least_matches(0.6)
    assert list(need) == sorted(need) and all(m < 0.6 * n for m, n in zip(need, range(16, 129, 16)))


def test_few_pairs_at_the_threshold_are_lost():
    assert (1 - 0.6**near_duplicates.ROWS) ** near_duplicates.BANDS < 0.001
    alive = {0: 1.0}  # chance of each number of equal values, of a pair at 0.6
    for m in near_duplicates.least_matches(0.6):
        after = Counter()
        for k, p in alive.items():
            for j in range(near_duplicates.STEP + 1):
                after[k + j] += p * comb(near_duplicates.STEP, j) * 0.6**j * 0.4 ** (near_duplicates.STEP - j)
        alive = {k: p for k, p in after.items() if k >= m}
    assert sum(alive.values()) > 0.9998


def test_star_of_pairs_is_split(spark, monkeypatch):
    """One text with most of the pairs: cells stay small, no pair is lost."""
    monkeypatch.setattr(near_duplicates, "GROUP", 20)
    base = [f"w{i}" for i in range(300)]
    rows = [("k", " ".join(base))] + [(f"k{j}", " ".join(base[: 5 * j] + [f"v{j}x{i}" for i in range(5)] + base[5 * j + 5 :])) for j in range(60)]
    df = spark.createDataFrame(rows, "key string, text string")
    pairs, members = near_duplicates.near_duplicates(df, "key", "text", k=3, threshold=0.93)
    got = {(r.key_a, r.key_b) for r in near_duplicates.expand(pairs, members).collect()}
    want = {tuple(sorted((a, b))) for (a, s), (b, t) in itertools.combinations(rows, 2) if len(sets(s, 3)[0] & sets(t, 3)[0]) > 0.93 * len(sets(s, 3)[0] | sets(t, 3)[0])}
    assert got == want and 60 <= len(want) < 70


# -- 2: repeated lines ------------------------------------------------------
def test_repeated_lines_and_sequences(spark):
    docs = [(f"d{i}", f"Top {i}\nown text {'abc'[i % 3] * (i + 1)}\n\xa0Foot  note\r\nLAST") for i in range(9)] + [("e", ""), ("n", None), (None, "Top 1")]
    df = spark.createDataFrame(docs, "key string, text string")
    src = spark.createDataFrame([(k, "s") for k, _ in docs] + [("d0", "s"), ("d1", "other"), ("d2", None)], "key string, src string")
    lines = repeated_lines.sourced_lines(df, "key", "text", src, "src")
    marked = repeated_lines.mark_lines(lines, repeated_lines.frequent_lines(lines, 8))
    assert {(r.doc, r.line_no) for r in marked.collect()} == {(f"d{i}", n) for i in range(9) for n in (1, 3, 4)}
    assert {tuple(r) for r in repeated_lines.mark_sequences(lines, 8).collect()} == {tuple(r) for r in marked.collect()}
    seqs = repeated_lines.frequent_sequences(marked, 8, longest=3)
    assert sorted(len(r.seq) for r in seqs.collect()) == [1, 1, 1, 2, 2, 3]
    left = {r.key: r.text for r in repeated_lines.remove_lines(df, "key", "text", marked).collect()}
    assert left["d0"] == "own text a" and left["n"] is None and left["e"] == ""


def test_sequences_of_any_length_and_gap(spark):
    rng = random.Random(5)
    docs = [(f"d{i}", "\n".join(rng.sample("abcdefg", rng.randrange(3, 8)) + rng.choices("abc", k=2))) for i in range(14)]
    docs += [(f"e{i}", "\n".join("abcdefg")) for i in range(4)]
    df = spark.createDataFrame(docs, "key string, text string")
    src = spark.createDataFrame([(k, k[0]) for k, _ in docs], "key string, src string")
    lines = repeated_lines.sourced_lines(df, "key", "text", src, "src")
    marked = repeated_lines.mark_lines(lines, repeated_lines.frequent_lines(lines, 4))
    want = {}
    for site in "de":
        found = Counter(q for k, text in docs if k[0] == site for q in {q for n in range(1, 10) for q in itertools.combinations(text.split("\n"), n)})
        for q, n in found.items():
            if n >= 4:
                want[site, len(q)] = want.get((site, len(q)), 0) + 1
    assert max(n for _, n in want) == 7 and want["e", 4] == 35
    # The lines of all frequent sequences are those of the first level.
    singles = {(site, q) for site in "de" for k, t in docs if k[0] == site for q in t.split("\n") if sum(q in u.split("\n") for j, u in docs if j[0] == site) >= 4}
    assert {(r.doc, r.line_no) for r in repeated_lines.mark_sequences(lines, 4).collect()} == {(k, n + 1) for k, t in docs for n, q in enumerate(t.split("\n")) if (k[0], q) in singles}
    assert {(r.src, r.length): int(r.sequences) for r in repeated_lines.sequence_counts(marked, 4).collect()} == want
    listed = repeated_lines.frequent_sequences(marked, 4, gap=None).collect()
    assert Counter((r.src, len(r.seq)) for r in listed) == want
    assert max(len(r.seq) for r in repeated_lines.frequent_sequences(marked.where("src = 'e'"), 4).collect()) == 7


def test_hosts(spark):
    df = spark.createDataFrame([("HTTPS://user@WWW.City.example:80/x",), ("no url",), (None,)], "u string")
    assert [r[0] for r in df.select(repeated_lines.host_of(F.col("u"))).collect()] == ["city.example", None, None]


# -- 3: template residue ----------------------------------------------------
def test_training_reads_few_pages_at_a_time(spark, monkeypatch):
    """What the driver keeps of its sample is passages, not the features of all
    lines; the model is the same, bit by bit, however many are read at a time."""
    rows = [(f"k{i}", "\n".join(random.Random(i).choices(["Home | News | Contact", "The fee is due {{date}}: see (Rule 4).", "Error 404", "", "Hours are posted. Call first.", "Lorem ipsum"], k=i % 7)) or None) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, text string")
    failed, models, most = df.where("key like '%4'").select("key"), [], []
    for n in (7, 1000):
        read, real = [], page_lines.Lines
        monkeypatch.setattr(template_residue, "AT_A_TIME", n, raising=False)
        monkeypatch.setattr(template_residue, "Lines", lambda pages, read=read, real=real: (read.append(len(pages)), real(pages))[1])
        models.append(template_residue.fit(df, "key", "text", failed))
        most.append(max(read))
    assert most[0] <= 7 < most[1]
    assert models[0].odds.any() and (models[0].odds == models[1].odds).all() and (models[0].lines[0] == models[1].lines[0]).all()


def test_residue_on_held_out_pages(spark):
    rng = random.Random(3)
    say = lambda: f"The {rng.choice(WORDS)} board shall {rng.choice(['file', 'post', 'amend'])} the {rng.choice(WORDS)} permit within {rng.randrange(90)} days of notice and keep a copy of the record."
    good = [[say() for _ in range(rng.randrange(3, 12))] for _ in range(300)]
    for g in good[::6]:
        g.append("Letters about the levy use merge fields such as {{case_number}}, which the clerk fills in.")
    sorry = ["Sorry, this page does not exist or has moved.", "Your request could not be completed by the server.", "Check the address for mistakes and try the request again.", "If the fault goes on, tell the help desk of this server."]
    latin = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed tempor incididunt ut labore magna aliqua."
    bad = [["Error 404", *rng.sample(sorry, 2), f"Incident {i}"] for i in range(60)] + [["Error 500", *sorry * 3] for _ in range(2)]
    bad += [["Please enable JavaScript to view this page."]] * 8 + [["# {{title}}", "{{body}}", "By {{author}}"]] * 8
    bad += [[latin] * 3] * 6 + [[say() for _ in range(6)] + [latin] * 12]
    assert sum(map(len, bad[60])) > 600
    pages = [(f"g{i}", "\n".join(g)) for i, g in enumerate(good)] + [(f"b{i}", "\n".join(b)) for i, b in enumerate(bad)] + [("n", None), ("e", ""), ("w", " \n"), (None, "Error 404")]
    df = spark.createDataFrame(pages, "key string, text string").withColumn("is_bad", F.lit(1))
    train = df.where("key not like '%3'")
    failed = train.where("key like 'b%' and key < 'b4'").select("key").unionByName(train.where("key like 'g1%'").select("key"))
    model = template_residue.fit(train, "key", "text", failed)
    got = {r.key for r in template_residue.residue(df, "text", model, "key").where("is_residue").collect()}
    assert {k for k, _ in pages if k and k.startswith("b")} <= got and not [k for k in got if k and not k.startswith("b")]
    # Signs only start the training: without any at scoring it is the same.
    d = page_lines.Lines([t.split("\n") if t else [] for _, t in pages])
    found = template_residue.decide(template_residue.Words(d, main_content.viterbi(d, *model.lines)), model.odds)
    assert {k for (k, _), x in zip(pages, found) if x} == got
    none = template_residue.fit(df.limit(0), "key", "text", failed, df.limit(0))
    assert template_residue.residue(df.limit(0), "text", none, "key").count() == 0
    with pytest.raises(ValueError):
        template_residue.residue(df.withColumn("is_residue", F.lit(1)), "text", none, "is_residue")


# -- 4: main content --------------------------------------------------------
def site_page(rng, i, phrase):
    say = lambda n: " ".join(f"The {rng.choice(WORDS)} board shall {rng.choice(['file', 'post', 'amend'])} the {rng.choice(WORDS)} permit within {rng.randrange(90)} days of the {rng.choice(WORDS)} notice." for _ in range(n))
    name = lambda: f"{rng.choice(WORDS).title()} {rng.choice(WORDS)} for the {rng.choice(WORDS)} {rng.choice(WORDS)}"
    page = [("Home | News | Permits", 1), (f"Home > Town > {name()}", 1), (f"Posted by Ann Lee on 2024-01-{i % 28 + 1:02d}", 1), ("", 0)]
    page += [(f"Section {rng.randrange(90)}. {name()}", 0), (say(rng.randrange(1, 5)), 0), (f"- Item {rng.randrange(9)}: approve the {name()}, Hill", 0), (say(2), 0)]
    page += [("Related pages", 1), (f"- {name()}", 1), (f"- {name()}", 1)] if i % 3 == 0 else []
    return page + [(phrase, 1), ("Share this page: Email | Print | Copy link", 1), (f"© {2000 + i % 25} Town of X. All rights reserved.", 1)]


def test_main_content(spark):
    """Held-out pages; a notice longer than any other line and in no list is
    found, as it repeats over the training pages; null, empty and blank texts
    give no line; texts judged residue give none."""
    rng = random.Random(8)
    phrase = "Visitors are asked to note that the clerk keeps visit counts of each reader for as long as the archive stands, and that whoever reads on is taken to have heard of this, to be content with it, and to want no other word about it from the clerk or from the town."
    assert not page_lines.kind_of(phrase) and len(phrase) > 170
    pages = [site_page(rng, i, phrase) for i in range(260)]
    rows = [(f"k{i}", "\n".join(x for x, _ in p)) for i, p in enumerate(pages)]
    df = spark.createDataFrame([*rows, ("n", None), ("e", ""), ("b", " \n "), (None, "Menu")], "key string, text string").withColumn("n", F.lit(0))
    model = template_residue.fit(df.where("substr(key, -1) <> '7'"), "key", "text", df.limit(0).select("key"))
    got = {(r.key, r.line_no) for r in template_residue.furniture_lines(df, "text", model, F.col("key") == "b", "key").collect()}
    want = {(f"k{i}", n + 1) for i, p in enumerate(pages) for n, (x, y) in enumerate(p) if y}
    held = lambda s: {x for x in s if x[0] and x[0][-1] == "7"}
    assert len(held(got & want)) >= 0.98 * len(held(want)) and len(held(got) - want) <= 0.02 * len(held(want))
    assert {n for k, n in got if k == "k7"} == {n for k, n in want if k == "k7"}
    assert not {k for k, _ in got} & {"n", "e", "b"}
    assert template_residue.furniture_lines(df.limit(0), "text", model, F.lit(True), "key").count() == 0
    # Labels by hand go before those by wordings.
    hand = [([x for x, _ in p], [y if x else -1 for x, y in p]) for p in pages[:200]]
    model = template_residue.fit(df, "key", "text", df.limit(0).select("key"), labelled=hand)
    assert {(r.key, r.line_no) for r in template_residue.furniture_lines(df.where("key like '%7'"), "text", model, F.lit(False), "key").collect()} == held(want)
    lines = [[x for x, _ in p] for p in pages[:200]]
    model = main_content.fit_pages(lines, [[y if x else -1 for x, y in p] for p in pages[:200]])
    d = page_lines.Lines([[x for x, _ in pages[203]]])
    assert (d.numbers[main_content.viterbi(d, *model) > 0] + 1).tolist() == sorted(n for k, n in want if k == "k203")


def test_viterbi_is_exhaustive_search():
    rng = np.random.default_rng(4)
    w, t = rng.normal(size=(main_content.FEATURES, 3)), rng.normal(size=(3, 3))
    pages = [[rng.choice(["Menu", "The town {x} is closed.", "- a", "A, b: c", "\xa0"]) for _ in range(n)] for n in (1, 4, 0, 5, 2)]
    d = page_lines.Lines(pages)
    e, got = main_content._emissions(d, w), main_content.viterbi(d, w, t)
    for at, n in zip(d.start, d.sizes):
        def total(path):
            return sum(e[at + i, s] for i, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:]))

        assert tuple(got[at : at + n]) == max(itertools.product(range(3), repeat=int(n)), key=total)
    assert d.page.tolist() == [i for i, p in enumerate(pages) for x in p if x.strip()]


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    pages = [["Menu", "The town hall is closed.", "- a"], ["b"], ["c d", "e.", "f", "g"]]
    d = page_lines.Lines(pages)
    w, t, y = rng.normal(size=(main_content.FEATURES, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, 8)

    def likelihood(t):
        e, out = main_content._emissions(d, w), 0.0
        for at, n in zip(d.start, d.sizes):
            score = lambda p: sum(e[at + i, s] for i, s in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:]))
            out += score(y[at : at + n]) - np.log(sum(np.exp(score(p)) for p in itertools.product(range(3), repeat=int(n))))
        return out

    _, moves = main_content._gradient(d, y, w, t)
    for a, b in itertools.product(range(3), repeat=2):
        step = np.zeros((3, 3))
        step[a, b] = 1e-5
        assert abs((likelihood(t + step) - likelihood(t - step)) / 2e-5 - moves[a, b]) < 1e-5


def test_line_kinds():
    assert page_lines.kind_of("Skip\xa0to  main content") == "top" and page_lines.kind_of("Subscribe to the X bulletin") == "share"
    assert page_lines.is_menu("- Home") and page_lines.is_menu("Jobs   News   Maps") and not page_lines.is_menu("The town hall is closed.")


# -- 6: best record ---------------------------------------------------------
def test_best_record(spark):
    rows = [(1, "OR", "A-1", "http://www.x/p/", "s1"), (2, "or", "a1", None, "s2"), (3, "OR", None, "HTTPS://X/p#f", "s3"), (4, "WA", "A1", None, "s1"), (5, None, "A1", None, "s1"), (6, "WA", None, None, "s1")]
    df = spark.createDataFrame(rows, "id long, state string, ident string, url string, source string")
    keys = [best_record.plain_identifier(F.col("ident")), best_record.plain_address(F.col("url"))]
    groups = {r.id: r.group_id for r in best_record.group_rows(df, "id", F.upper("state"), keys).collect()}
    assert groups == {1: 1, 2: 1, 3: 1}
    claims = spark.createDataFrame(
        [(1, "f", "x", "bad", 1, 5), (1, "f", "y", "good", 2, 3), (1, "f", "y", "good", 3, 3), (1, "f", "x", "odd", 4, 9), (1, "g", None, "good", 2, 3), (2, "f", "z", None, 9, None)],
        "grp long, field string, value string, source string, id long, t long",
    ).withColumn("t", F.timestamp_seconds("t"))
    rank = {"good": 1, "bad": 2}
    r = best_record.source_reliability(claims, rank)
    assert r["good"] >= r["bad"] >= r["odd"]
    got = {(x.grp, x.field): x.id for x in best_record.choose(claims, r, rank, "id", "t", together=False).collect()}
    assert got == {(1, "f"): 2, (2, "f"): 9}
    assert best_record.source_reliability(claims.limit(0), rank) == {}
    with pytest.warns(RuntimeWarning):
        best_record.source_reliability(claims, None, rounds=1, settled=1e-9)


def test_truth_discovery_finds_planted_bad_sources(spark):
    """Two sources that mostly err and agree by chance only lose to those that
    don't, though they make the first claims and outnumber one of them; no
    rank says so. Null sources and values claim nothing."""
    rng = random.Random(6)
    rows = []
    for g in range(200):
        for i, (s, right) in enumerate([("bad1", 0.2), ("bad2", 0.2), ("good1", 0.95), ("good2", 0.9), ("good3", 0.9)]):
            if rng.random() < 0.7:
                rows.append((g, "f", "true" if rng.random() < right else f"x{rng.randrange(3)}", s, 10 * g + i))
    df = spark.createDataFrame([*rows, (0, "f", "y", None, 5000), (0, "f", None, "bad1", 5001)], "grp long, field string, value string, source string, id long").withColumn("t", F.lit(None).cast("timestamp"))
    r = best_record.source_reliability(df, None)
    assert min(r["good1"], r["good2"], r["good3"]) > max(r["bad1"], r["bad2"]) + 0.2
    got = [x.value for x in best_record.choose(df, r, {}, "id", "t", together=True).collect()]
    plain = [x.value for x in best_record.choose(df, {s: 1.0 for s in r}, {}, "id", "t", together=True).collect()]
    assert got.count("true") > plain.count("true") and got.count("true") > 0.9 * len(got)


def test_a_null_source_and_an_unranked_one_are_alike(spark):
    """Neither has a rank: the later claim goes first, then the least id."""
    df = spark.createDataFrame([(1, "f", "a", None, 1, 9), (1, "f", "b", "odd", 2, 5), (2, "f", "a", None, 3, 5), (2, "f", "b", "odd", 4, 9)], "grp long, field string, value string, source string, id long, t long").withColumn("t", F.timestamp_seconds("t"))
    r = best_record.source_reliability(df, {"good": 1})
    assert {x.grp: x.id for x in best_record.choose(df, r, {"good": 1}, "id", "t", together=False).collect()} == {1: 1, 2: 4}


def test_best_rows_need_no_estimates(spark, tmp_path, monkeypatch):
    """The order of trust, recency and id decides p6_found: no stage estimates
    what can't change it. Only p6_truth follows the sources' agreement."""
    from corpuslake.llm import queries
    from tests.oracle import both

    made = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made("source_trust", [("court", 1), ("agency", 2), ("mirror", 2)], "source_kind string, trust_rank int")
    kinds = {"f1": " Court", "f2": "agency", "f3": "mirror", "f4": "odd", "f5": None}
    made("source_record", [(f, k) for f, k in kinds.items()], "source_file string, source_kind string")
    rows, rng = [], random.Random(7)
    for g in range(40):  # the court is alone against all others
        for f in rng.sample(sorted(kinds), rng.randrange(2, 6)):
            got = {"identifier": f"A-{g}", "name": "other" if f == "f1" else "same", "retrieved_at": f"2024-01-0{rng.randrange(1, 4)}T00:00:00"}
            rows.append((len(rows), "OR", f, json.dumps({k: v for k, v in got.items() if k != "retrieved_at" or rng.random() < 0.8})))
    made("candidate_row", rows, "candidate_id long, state string, source_file string, row_json string")
    truth = {r.group_id: r.candidate_id for r in queries.p6_truth(spark, str(tmp_path)).collect()}

    def estimated(*_):
        raise AssertionError("p6_found estimates reliabilities")

    monkeypatch.setattr(queries, "source_reliability", estimated)
    got, want = both(spark, queries.p6_found, queries.SQL["p6_found"], str(tmp_path))
    assert got == want and len(got) == 40
    assert any(truth[g] != c for c, _, g in got)


# -- 8: encoding ------------------------------------------------------------
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\r\x1c\x85\xa0'sé漢🙂<|endoftext|>")), max_size=80))
def test_ids_are_the_librarys_and_decode_back(text):
    ids = ENC.ids(text)
    whole = ENC.tokenizer.encode(text, add_special_tokens=False)
    assert ids == whole.ids and ENC.decode(ids) == text
    starts, ends = ENC.offsets(text, ids)
    assert list(zip(starts.tolist(), ends.tolist())) == [tuple(o) for o in whole.offsets]


def test_encode_frame(spark):
    df = spark.createDataFrame([(1, "Hi 🙂🙂", "c"), (2, "", "c"), (3, None, "c"), (3, None, "c"), (4, "<|endoftext|>", "c")], "id int, text string, count string")
    got = {r.id: r.ids for r in encode.encode(df, "text").collect()}
    assert got[2] == got[3] == [] and 50256 not in got[4]
    assert encode.encode(df.limit(0), "text").count() == 0
    assert {r.id: r.again for r in encode.decode(encode.encode(df, "text"), text="again").collect()}[1] == "Hi 🙂🙂"
    with pytest.raises(ValueError):
        encode.token_counts(df, "text", "count")


# -- 9: containers ----------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_bins_hold_everything_and_beat_best_fit(sizes):
    bins = containers.complete_bins(sizes, 40)
    assert sorted(itertools.chain(*bins)) == sorted(sizes) and all(sum(b) <= 40 for b in bins)
    assert len(bins) <= len(containers.best_fit(sizes, 40))


def test_bin_completion_finds_the_optimum_best_fit_misses():
    sizes = [5, 4, 4, 3, 2, 2]
    assert len(containers.best_fit(sizes, 10)) == 3 and len(containers.complete_bins(sizes, 10)) == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(2, 12), max_size=9))
def test_without_budgets_the_packing_is_optimal(sizes):
    def least(rest, rooms):
        if not rest:
            return len(rooms)
        options = {room: i for i, room in enumerate(rooms) if room >= rest[0]}
        tries = [least(rest[1:], [*rooms[:i], rooms[i] - rest[0], *rooms[i + 1 :]]) for i in options.values()]
        return min([*tries, least(rest[1:], [*rooms, 14 - rest[0]]) if len(rooms) < len(sizes) else 99])

    assert len(containers.complete_bins(sizes, 14, None, None, None)) == (least(sorted(sizes, reverse=True), []) if sizes else 0)


def test_pack(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 3, 50, 90, 100, 250, 1234])) for i in range(500)] + [(500, None), (None, 5)]
    specs = spark.createDataFrame([(1, 100), (2, 300), (3, 0), (2, 300), (None, 9)], "spec_id int, capacity_tokens int")
    got = containers.pack(spark.createDataFrame(rows, "id long, size int"), "id", "size", specs).collect()
    for spec, cap in ((1, 100), (2, 300)):
        mine = [r for r in got if r.spec_id == spec]
        per, fill = {}, {}
        for r in mine:
            per.setdefault(r.id, []).append((r.start, r.n))
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n
        assert {i: sum(n for _, n in p) for i, p in per.items()} == {i: s or 0 for i, s in rows if i is not None}
        assert max(fill.values()) <= cap and all(len(p) == 1 or sum(n for _, n in p) > cap for p in per.values())
        assert sum(fill.values()) / (cap * len(fill)) > 0.9
    assert containers.pack(spark.createDataFrame([], "id long, size int"), "id", "size", specs).count() == 0


# -- 10: abusive content ----------------------------------------------------
def test_spelling():
    assert abusive.plain_word("iiiidiot!!") == "idiot" and abusive.plain_word("m-o-r-o-n") == "moron" and abusive.plain_word("dirtbаg") == "dirtbag"
    assert abusive.plain_word("s**neless") == "<masked>" and abusive.plain_word("1d10t") == "idiot" and abusive.plain_word("12") == "#"
    assert abusive.sentences("you i d i o t s here") == ["you idiots here"]


def test_class_prior_has_no_jump():
    priors = [abusive.class_prior(n, 1000, 0.3) for n in range(60)]
    steps = np.diff(priors)
    assert abusive.class_prior(0, 0, 0.3) == abusive.PRIOR
    assert (steps > 0).all() and steps.max() < 1.01 * steps.min()
    assert abs(abusive.class_prior(60_000, 1_000_000, 0.3) - 0.018) < 1e-4


def test_abusive_on_held_out_documents(spark):
    rng = random.Random(1)
    say = lambda: f"The {rng.choice(WORDS)} board shall {rng.choice(['file', 'post', 'amend'])} the {rng.choice(WORDS)} permit within {rng.randrange(90)} days."
    mean = ["You {a} {n}, drop dead.", "What a {a} bunch of {n}s run this office.", "To the {n} who denied my permit: choke on it."]
    rude = lambda: rng.choice(mean).format(a=rng.choice(["stupid", "filthy", "useless"]), n=rng.choice(["moron", "clown", "liar", "coward"]))
    quote = "The tenant testified that the manager had called them a moron and the board found the claim proven."
    docs = []
    for i in range(900):
        parts = [say() for _ in range(rng.randrange(2, 8))]
        if i % 9 == 1:
            parts.append(quote)
        if i % 10 == 0:
            parts.insert(rng.randrange(len(parts)), rude())
        docs.append((i, " ".join(parts)))
    df = spark.createDataFrame([*docs, (1000, None), (1001, ""), (1002, " ")], "id long, text string").withColumn("x", F.lit(1))
    labels = spark.createDataFrame([(i, 1 if i % 10 == 0 else 0) for i in range(0, 450)] + [(3, None)], "id long, bad int")
    model = abusive.fit(df, labels, "id", "text", "bad")
    got = {r.id for r in abusive.score(df, "text", model).where(F.col("score") >= abusive.THRESHOLD).collect()}
    want = {i for i in range(450, 900) if i % 10 == 0}
    held = {i for i in got if 450 <= i}
    assert len(held & want) >= 0.9 * len(want) and len(held - want) <= 0.1 * len(want)


# -- records and queries ----------------------------------------------------
def test_record_text(spark):
    raws = ['{"text": "a"}', '{"text": "", "full_text": "b"}', '{"record": {"full_text": "c"}}', '{"text": "cut', None, "{}", "[1]"]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    assert [r[0] for r in df.select(record_text(F.col("raw"))).collect()] == ["a", "b", "c", None, None, None, None]


FOLDER = "/root/testdata/sf0.001"


WITHOUT_SQL = {"p2_sequences", "p3_found", "p4_found", "p8_ids", "p9_containers", "p9_waste", "p10_found", "p10_rates"}
here = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables here")


@here
def test_queries_with_sql(spark):
    from corpuslake.llm import queries
    from tests.oracle import both

    assert set(queries.QUERIES) - set(queries.SQL) == WITHOUT_SQL
    for name, sql in queries.SQL.items():
        got, want = both(spark, queries.QUERIES[name], sql)
        assert got == want and got, name


@here
def test_queries_without_sql(spark):
    """Values that must hold of the results over a whole folder."""
    from corpuslake.llm import queries

    run = lambda name: queries.QUERIES[name](spark, FOLDER).collect()
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()
    docs, pages = {d.doc_id: d.text for d in read("documents")}, {r.content_cid: r.text for r in read("cid_content")}

    lines = repeated_lines.frequent_lines(queries._site_lines(spark, FOLDER), queries.SUPPORT)
    first = {r.src: r["count"] for r in lines.groupBy("src").count().collect()}
    assert {r.site: int(r.sequences) for r in run("p2_sequences") if r.length == 1} == first

    out = {r.content_cid for r in run("p3_found")}
    assert 0 < len(out) < 0.2 * len(pages) and all((pages[c] or "").strip() for c in out)
    aside = [r for r in run("p4_found") if r.rec_table == "cid_content"]
    assert aside and not {r.rec_key for r in aside} & out and len({(r.rec_key, r.line_no) for r in aside}) == len(aside)
    assert all(pages[r.rec_key].split("\n")[r.line_no - 1].strip() for r in aside)

    assert {r.doc_id: list(r.ids) for r in run("p8_ids")} == {i: ENC.ids(t) for i, t in docs.items()}

    specs = {r.spec_id: r.capacity_tokens for r in read("container_spec")}
    packed = run("p9_containers")
    for spec, capacity in specs.items():
        per, fill = Counter(), Counter()
        for r in packed:
            if r.spec_id == spec:
                per[r.doc_id] += r.n
                fill[r.container_id] += r.n
        assert per == Counter({i: len(ENC.ids(t)) for i, t in docs.items()}) and max(fill.values()) <= capacity
    assert all(r.at_least <= r.containers <= 1.02 * r.at_least + 2 for r in run("p9_waste"))

    found = {r.doc_id for r in run("p10_found")}
    rates = run("p10_rates")
    assert found <= set(docs) and sum(r.flagged for r in rates) == len(found) and sum(r.documents for r in rates) == len(docs)
