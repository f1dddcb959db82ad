"""Queries over vectors, names and hosts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as X, url as U
from ..operators.keyed import listed, numbered
from ..operators.vectors import index_top_k, top_k
from ..session import write_shared
from ..tables import table


def l2_normalize(spark, d):
    v = table(spark, d, "embeddings")
    n = X.l2_normalise(F.col("embedding"))
    return v.select("vec_id", F.round(X.dot(n, n), 6).alias("norm"), F.round(n[0], 6).alias("first"))


def vector_ids(spark, d):
    """Contiguous ids in the order of label and id."""
    return numbered(table(spark, d, "embeddings").select("label", "vec_id"), ["label", "vec_id"], "position").select("vec_id", "position")


def cosine_topk(spark, d):
    """The five nearest of every vector whose id is divisible by 20."""
    v = table(spark, d, "embeddings").select("vec_id", X.l2_normalise(F.col("embedding")).alias("n"))
    return top_k(v, v.where("vec_id % 20 = 0"), "vec_id", "n", 5).select("query_id", F.col("id").alias("vec_id"), "rank", F.round("score", 4).alias("score"))


def vector_index_topk(spark, d):
    """The five nearest of every vector whose id is divisible by 20, by the
    index over all vectors."""
    v = table(spark, d, "embeddings").select("vec_id", X.l2_normalise(F.col("embedding")).alias("n"))
    return index_top_k(v, v.where("vec_id % 20 = 0"), "vec_id", "n", 5).select("query_id", F.col("id").alias("vec_id"), "rank", F.round("score", 4).alias("score"))


def vector_index_exact(spark, d):
    """The same with every list probed: equal to exact search."""
    v = table(spark, d, "embeddings").select("vec_id", X.l2_normalise(F.col("embedding")).alias("n"))
    return index_top_k(v, v.where("vec_id % 20 = 0"), "vec_id", "n", 5, probes=64).select("query_id", F.col("id").alias("vec_id"), "rank", F.round("score", 4).alias("score"))


def embed_join_labels(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "label", F.round(X.dot(F.col("embedding"), F.col("embedding")), 4).alias("energy"))
    return v.join(table(spark, d, "doc_labels").select(F.col("doc_id").alias("vec_id"), "abusive"), "vec_id", "left")


def names_similar(spark, d):
    """Pairs of parts of one brand and size whose names have at least 0.4 of
    their words in common; blocks of brand, size and word keep pairs few."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", X.name_tokens(F.col("p_name")).alias("t"))
    w = p.select("*", F.explode("t").alias("w"))
    a, b = w.alias("a"), w.alias("b")
    same = (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.p_size") == F.col("b.p_size")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.p_partkey") < F.col("b.p_partkey"))
    j = a.join(b, same).where(F.col("a.w") == F.array_min(F.array_intersect("a.t", "b.t")))  # each pair once
    s = X.jaccard(F.col("a.t"), F.col("b.t"))
    return j.where(s >= 0.4).select(F.col("a.p_partkey").alias("left_key"), F.col("b.p_partkey").alias("right_key"), F.round(s, 6).alias("similarity"))


#: Names of one word of one brand that a task compares with the others.
HOT = 1000
#: Rows of one name whose keys are listed together: a cell has so many squared pairs at most.
BLOCK = 256
#: Pairs that a task lists, about.
PAIRS = 16_000_000
#: Names with a word in common that a task compares, about.
COMPARED = 2_000_000


def similar_sets(names: DataFrame, least: float) -> DataFrame:
    """scope, a, b, similarity of pairs (a < b) of one scope of the names
    (scope, name: distinct words joined by spaces), each once, that have at
    least `least` of their words in common, or where the words of one are among
    the other's.

    Candidates share a word that is among the rarest of both (so many that the
    share can't be reached without them), or that is the rarest word of one;
    they are verified exactly, at the rarest word in common. Words of many
    names are spread over several tasks, of about `COMPARED` candidates. No
    side is broadcast, however small it is when compressed.
    """
    p = names.select("scope", "name", F.explode(F.split("name", " ")).alias("w"))
    many = p.groupBy("scope", "w").agg(F.count("*").alias("n"))
    t = p.join(many.hint("merge"), ["scope", "w"]).groupBy("scope", "name").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("t"))
    size = F.size("t")
    rare = size - F.ceil(size * least - 1e-9) + 1
    w = t.select("scope", "name", F.col("t.w").alias("t"), rare.alias("rare"), F.posexplode("t").alias("pos", "x"))
    w = w.select("scope", "name", "t", "pos", (F.col("pos") < F.col("rare")).alias("rare"), "x.w", F.ceil(F.col("x.n") / HOT).cast("int").alias("salts"))
    total = many.agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)).first()[0] or 0
    parts = max(names.sparkSession.sparkContext.defaultParallelism, math.ceil(total / COMPARED))
    a = w.withColumn("salt", F.pmod(F.xxhash64("name"), F.col("salts")).cast("int")).repartition(parts, "scope", "w", "salt").alias("a")
    b = w.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).repartition(parts, "scope", "w", "salt").alias("b")
    same = (F.col("a.scope") == F.col("b.scope")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.name") < F.col("b.name"))
    near = (F.col("a.rare") & F.col("b.rare")) | (F.col("a.pos") == 0) | (F.col("b.pos") == 0)
    both, size_a, size_b = F.array_intersect("a.t", "b.t"), F.size("a.t"), F.size("b.t")
    s = F.size(both) / (size_a + size_b - F.size(both))
    # The side that is dealt out by salts is the one that the join keeps in memory.
    j = b.join(a.hint("merge"), same).where(near).where(F.col("a.w") == both[0]).where((s >= least) | (F.size(both) == F.least(size_a, size_b)))
    return j.select("a.scope", F.col("a.name").alias("a"), F.col("b.name").alias("b"), F.round(s, 6).alias("similarity"))


def similar_names(names: DataFrame, key: str, scope: str, name: str, least: float) -> DataFrame:
    """left_key, right_key, similarity of pairs of one scope whose names have
    at least `least` of their words in common, or the words of one are among
    the other's.

    Names of the same words are compared once, and their rows only met as
    pairs of blocks of keys, in tasks of about `PAIRS` pairs: no pair is
    shuffled, and no side of a join is sent to the driver. Null and empty names
    are in no pair, nor are rows of one key.
    """
    words = F.array_join(X.name_tokens(F.col(name)), " ")
    rows = names.select(F.col(key).alias("key"), F.col(scope).alias("scope"), words.alias("name")).where("key is not null and scope is not null and name <> ''")
    lists = write_shared(listed(rows, ["scope", "name"], ["key"], F.col("key"), BLOCK, "keys"), "names")
    sets = lists.groupBy("scope", "name").agg(F.max("part").alias("last"), F.sum(F.size("keys")).alias("n"))
    last = lambda c: sets.select("scope", F.col("name").alias(c), F.col("last").alias(f"last_{c}"), F.col("n").alias(f"n_{c}")).hint("merge")
    pairs = similar_sets(sets.select("scope", "name"), least).unionByName(sets.where("n > 1").select("scope", F.col("name").alias("a"), F.col("name").alias("b"), F.lit(1.0).alias("similarity")))
    pairs = write_shared(pairs.join(last("a"), ["scope", "a"]).join(last("b"), ["scope", "b"]), "names-pairs")
    total = pairs.agg(F.sum(F.col("n_a").cast("double") * F.col("n_b") / F.when(F.col("a") == F.col("b"), 2).otherwise(1)).alias("n")).first().n or 0
    one = F.col("a") == F.col("b")
    cells = pairs.select("*", F.explode(F.sequence(F.lit(0), "last_a")).alias("i"))
    cells = cells.select("scope", "a", "b", "i", one.alias("one"), "similarity", F.explode(F.sequence(F.when(one, F.col("i")).otherwise(0), "last_b")).alias("j"))
    of = lambda c, part, keys: lists.select("scope", F.col("name").alias(c), F.col("part").alias(part), F.col("keys").alias(keys)).hint("merge")
    cells = cells.join(of("a", "i", "x"), ["scope", "a", "i"]).join(of("b", "j", "y"), ["scope", "b", "j"])
    cells = cells.repartition(max(names.sparkSession.sparkContext.defaultParallelism, math.ceil(total / PAIRS)), "scope", "a", "i", "b", "j")
    # Keys of a block and blocks of a name are in order: of two equal blocks each pair of places is taken once.
    cells = cells.select((F.col("one") & (F.col("i") == F.col("j"))).alias("half"), "similarity", "y", F.posexplode("x").alias("p", "x"))
    cells = cells.select("half", "similarity", "p", "x", F.posexplode("y").alias("q", "y")).where((~F.col("half") | (F.col("p") < F.col("q"))) & (F.col("x") != F.col("y")))
    return cells.select(F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key"), "similarity")


def names_similar_brand(spark, d):
    """Pairs of parts of one brand whose names have at least 0.4 of their
    words in common, or the words of one are among the other's."""
    return similar_names(table(spark, d, "part"), "p_partkey", "p_brand", "p_name", 0.4)


def branch_guess(spark, d):
    """Kind of site by its host, with a confidence."""
    h = U.host(F.col("url"))
    kind = X.first_match([("county", h.contains("county")), ("town", h.contains("town")), ("law", h.startswith("law.") | h.startswith("code.") | h.startswith("rules.")), ("government", h.contains(".gov."))], F.lit("other"))
    conf = F.when(kind == "other", 0.2).when(h.contains(".gov."), 0.9).otherwise(0.6)
    return table(spark, d, "url_cid_latest").where("url is not null").select(h.alias("host"), kind.alias("kind"), conf.alias("confidence")).distinct()


def entity_merge(spark, d):
    """One entity for each host: most used scheme spelling, kinds of content
    as sorted sets, first time seen, best page by status and length."""
    t = table(spark, d, "url_cid_latest").where("url is not null").withColumn("host", U.host(F.col("url")))
    score = F.struct(F.when(F.col("last_status_code") == 200, 1).otherwise(0), -F.length("url"), F.col("url"))
    return t.groupBy("host").agg(
        F.count("*").alias("pages"), F.array_join(F.array_sort(F.collect_set(F.lower(F.trim("last_status")))), "|").alias("statuses"),
        F.min("last_finished_at").alias("first_seen"), F.max_by("url", score).alias("best"),
    )


def warc_pointer_rank(spark, d):
    """The five best fetches of each source: good status, then newest."""
    score = F.when(F.col("status_code") == 200, 10).otherwise(0) + F.when(F.col("archive_url").isNotNull(), 1).otherwise(0)
    w = Window.partitionBy("fetch_source").orderBy(score.desc(), F.desc("fetch_id"))
    t = table(spark, d, "fetch_result").where("fetch_source is not null").distinct()
    return t.select("fetch_source", "fetch_id", F.row_number().over(w).alias("place")).where("place <= 5")


def portal_rank(spark, d):
    """Best page of each host; pages with a forbidden word never win."""
    path = F.lower(F.regexp_replace("url", r"^[^/]*//[^/]*", ""))
    s = F.when(path.contains("minutes"), F.lit(-1_000_000_000)).otherwise(X.weighted([(5, path.contains("code")), (3, path.contains("ordinance")), (2, path.contains("rules"))]) - F.length("url"))
    t = table(spark, d, "url_cid_latest").where("url is not null").select(U.host(F.col("url")).alias("host"), "url", s.alias("s")).where("s > -1000000000")
    return t.groupBy("host").agg(F.max_by("url", F.struct("s", "url")).alias("url"))


def gap_sets(spark, d):
    """Hosts that were attempted but never fetched, and the other way round."""
    a = table(spark, d, "scrape_attempts").where("url is not null").select(U.host(F.col("url")).alias("host")).distinct()
    b = table(spark, d, "fetch_result").where("url is not null").select(U.host(F.col("url")).alias("host")).distinct()
    one = a.join(b, "host", "left_anti").select("host", F.lit("not_fetched").alias("gap"))
    return one.unionByName(b.join(a, "host", "left_anti").select("host", F.lit("not_attempted").alias("gap")))


def customer_orders(spark, d):
    """Customers with their newest order, those without one too."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("newest"), F.count("*").alias("orders"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_nationkey", "newest", F.coalesce("orders", F.lit(0)).alias("orders"))


QUERIES = {
    f.__name__: f
    for f in (
        l2_normalize, vector_ids, cosine_topk, vector_index_topk, vector_index_exact, embed_join_labels, names_similar, names_similar_brand, branch_guess, entity_merge, warc_pointer_rank, portal_rank, gap_sets, customer_orders,
    )
}

_H = "regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', ''), '^.*@', ''), ':\\d*$', '')"
_U = f"t as (select *, {_H} as host from url_cid_latest where url is not null)"
_KIND = "case when contains(host, 'county') then 'county' when contains(host, 'town') then 'town' when regexp_matches(host, '^(law|code|rules)\\.') then 'law' when contains(host, '.gov.') then 'government' else 'other' end"
SQL = {
    "l2_normalize": """with n as (select vec_id, embedding::double[] as e, sqrt(list_inner_product(embedding::double[], embedding::double[])) as s from embeddings)
        select vec_id, round(list_inner_product(list_transform(e, lambda x: x / s), list_transform(e, lambda x: x / s)), 6) as norm, round(e[1] / s, 6) as first from n""",
    "vector_ids": "select vec_id, row_number() over (order by label, vec_id) - 1 as position from embeddings",
    "cosine_topk": """with v as (select vec_id, embedding::double[] as e, sqrt(list_inner_product(embedding::double[], embedding::double[])) as s from embeddings),
        p as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e) / (q.s * v.s) as score from v q, v where q.vec_id % 20 = 0),
        r as (select *, row_number() over (partition by query_id order by round(score, 9) desc, vec_id) as rank from p) select query_id, vec_id, rank, round(score, 4) as score from r where rank <= 5""",
    "vector_index_exact": "",
    "embed_join_labels": "select vec_id, label, round(list_inner_product(embedding::double[], embedding::double[]), 4) as energy, abusive from embeddings left join doc_labels on doc_id = vec_id",
    "names_similar": """with p as (select p_partkey, p_brand, p_size, list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda x: x not in ('', 'the', 'of', 'and', 'for', 'a'))) as t from part),
        j as (select a.p_partkey as l, b.p_partkey as r, len(list_intersect(a.t, b.t)) as i, len(a.t) + len(b.t) as n from p a join p b on a.p_brand = b.p_brand and a.p_size = b.p_size and a.p_partkey < b.p_partkey)
        select l as left_key, r as right_key, round(i::double / (n - i), 6) as similarity from j where i > 0 and i::double / (n - i) >= 0.4""",
    "names_similar_brand": """with p as (select p_partkey, p_brand, list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda x: x not in ('', 'the', 'of', 'and', 'for', 'a'))) as t from part),
        j as (select a.p_partkey as l, b.p_partkey as r, len(list_intersect(a.t, b.t)) as i, len(a.t) + len(b.t) as n, least(len(a.t), len(b.t)) as k from p a join p b on a.p_brand = b.p_brand and a.p_partkey < b.p_partkey)
        select l as left_key, r as right_key, round(i::double / (n - i), 6) as similarity from j where i > 0 and (i::double / (n - i) >= 0.4 or i = k)""",
    "branch_guess": f"with {_U} select distinct host, {_KIND} as kind, case when {_KIND} = 'other' then 0.2 when contains(host, '.gov.') then 0.9 else 0.6 end::double as confidence from t",
    "entity_merge": f"""with {_U} select host, count(*) as pages, coalesce(array_to_string(list_sort(list(distinct lower(trim(last_status))) filter (where last_status is not null)), '|'), '') as statuses, min(last_finished_at) as first_seen,
        first(url order by case when last_status_code = 200 then 1 else 0 end desc, length(url), url desc) as best from t group by host""",
    "warc_pointer_rank": """with t as (select distinct * from fetch_result where fetch_source is not null), r as (select fetch_source, fetch_id, row_number() over (partition by fetch_source
        order by case when status_code = 200 then 10 else 0 end + case when archive_url is not null then 1 else 0 end desc, fetch_id desc) as place from t) select * from r where place <= 5""",
    "portal_rank": f"""with {_U}, s as (select host, url, lower(regexp_replace(url, '^[^/]*//[^/]*', '')) as p from t),
        r as (select host, url, case when contains(p, 'code') then 5 else 0 end + case when contains(p, 'ordinance') then 3 else 0 end + case when contains(p, 'rules') then 2 else 0 end - length(url) as s from s where not contains(p, 'minutes'))
        select host, first(url order by s desc, url desc) as url from r group by host""",
    "gap_sets": f"""with a as (select distinct {_H} as host from scrape_attempts where url is not null), b as (select distinct {_H} as host from fetch_result where url is not null)
        select host, 'not_fetched' as gap from a where host not in (select host from b) union all select host, 'not_attempted' from b where host not in (select host from a)""",
    "customer_orders": "select c_custkey, c_nationkey, max(o_orderkey) as newest, count(o_orderkey) as orders from customer left join orders on o_custkey = c_custkey group by 1, 2",
}
SQL["vector_index_exact"] = SQL["cosine_topk"]
