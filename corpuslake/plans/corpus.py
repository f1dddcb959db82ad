"""Queries of the document corpus: quality, best rows, identifiers, graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..functions.cid import cid_v1
from ..operators.documents import line_rows, segment, subsection_tree, tree_issues
from ..operators.keyed import best_by_key, first_by_key, listed
from ..session import write_shared
from ..tables import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def nested_haspart_explode(spark, d):
    """Documents put under their source as parts, at most 100 in one record,
    and taken out again."""
    t = _docs(spark, d).where("source is not null").select("source", "doc_id", F.struct("doc_id", "lang", F.length(X.norm(F.col("text"))).alias("chars")).alias("part"))
    whole = listed(t, ["source"], ["doc_id"], F.col("part"), 100, "hasPart").select("source", F.to_json(F.struct("hasPart")).alias("j"))
    back = F.from_json("j", "hasPart array<struct<doc_id: long, lang: string, chars: int>>")["hasPart"]
    return whole.select("source", F.explode(back).alias("p")).select("source", "p.doc_id", "p.lang", "p.chars")


def best_row_dedupe(spark, d):
    """Best document of each citation: longest text, then has a state, then
    least id. Lengths are shuffled, not texts."""
    key = F.upper(F.regexp_replace("official_cite", "[^A-Za-z0-9]", ""))
    t = _docs(spark, d).where("official_cite is not null").select(key.alias("k"), "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"), F.col("state_code").isNotNull().alias("s"))
    return best_by_key(t, ["k"], [F.col("n"), F.col("s")], F.col("doc_id")).select("k", "doc_id")


def _quality(spark, d, first=None):
    legal, noise = X.hits(F.lower("text"), r"\b(?:section|shall|pursuant)\b|§", first), X.hits(F.lower("text"), r"\b(?:click|cookie|menu)\b", first)
    return _docs(spark, d).select("doc_id", legal.alias("legal"), noise.alias("noise"), (legal * 5 - noise * 4).alias("score"))


def text_quality(spark, d):
    """Legal and noise hits in the first 4000 characters, and their score."""
    return _quality(spark, d, 4000)


def text_quality_whole(spark, d):
    """Legal and noise hits in the whole text, and their score."""
    return _quality(spark, d)


def state_extract(spark, d):
    """State of a document: its code, else the end of its source's name."""
    code = F.when(F.upper(F.trim("state_code")).rlike("^[A-Z]{2}$"), F.upper(F.trim("state_code")))
    return _docs(spark, d).select("doc_id", F.coalesce(code, F.nullif(F.regexp_extract("source", r"^([a-z]+)_", 1), F.lit("")), F.lit("unknown")).alias("state"))


def _scored(spark, d):
    t, low = F.coalesce("text", F.lit("")), F.lower(F.coalesce("text", F.lit("")))
    rules = [
        (2, F.length(t) >= 1200), (1, F.length(t) >= 300), (2, low.contains("section")), (1, low.contains("shall")),
        (-3, low.contains("cookie")), (-4, F.length(t) < 40), (1, F.col("official_cite").isNotNull()),
    ]
    return _docs(spark, d).select("doc_id", "lang", X.weighted(rules).alias("score"))


def row_score(spark, d):
    return _scored(spark, d).select("doc_id", "score")


def clean_threshold(spark, d):
    """Kept and dropped documents of each language at a score of 2."""
    return _scored(spark, d).groupBy("lang").agg(F.count("*").alias("seen"), F.count_if(F.col("score") >= 2).alias("kept"), F.count_if(F.col("score") < 2).alias("dropped"))


def _reason(spark, d):
    t = F.coalesce("text", F.lit(""))
    r = X.first_match([("no_text", t == ""), ("blank", F.trim(t) == ""), ("short", F.length(t) < 100), ("no_source", F.col("source").isNull()), ("no_lang", F.col("lang").isNull())])
    return _docs(spark, d).select("doc_id", r.alias("reason"))


def reject_reason(spark, d):
    return _reason(spark, d)


def reject_histogram(spark, d):
    return _reason(spark, d).groupBy(F.coalesce("reason", F.lit("accept")).alias("reason")).agg(F.count("*").alias("n"))


def family_infer(spark, d):
    """Family of a document by the first rule, with its documents' ids' span."""
    low = F.lower(F.coalesce("text", F.lit("")))
    fam = X.first_match([("court", low.contains("court")), ("ordinance", low.contains("ordinance")), ("permit", low.contains("permit")), ("notice", low.contains("notice"))], F.lit("other"))
    return _docs(spark, d).groupBy(fam.alias("family")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


def cid_v1_query(spark, d):
    t = _docs(spark, d).where("text is not null")
    return t.select("doc_id", cid_v1(F.col("text")).alias("cid"))


def cid_dedupe(spark, d):
    """First document of each identifier."""
    t = _docs(spark, d).where("text is not null").select("doc_id", cid_v1(F.col("text")).alias("cid"))
    return first_by_key(t, ["cid"], F.col("doc_id")).select("cid", "doc_id")


def partition_manifest(spark, d):
    """Documents, those with text and distinct texts of each language and of
    all."""
    t = _docs(spark, d).select(F.coalesce("lang", F.lit("none")).alias("lang"), F.md5("text").alias("h"))
    return t.rollup("lang").agg(F.count("*").alias("documents"), F.count("h").alias("with_text"), F.countDistinct("h").alias("texts"))


_REF = r"section \d+-\d+-\d+"


def _edges(spark, d):
    t = _docs(spark, d).where("text is not null")
    cites = t.select(F.concat(F.lit("doc:"), F.col("doc_id")).alias("source_id"), F.explode(F.regexp_extract_all("text", F.lit(_REF), F.lit(0))).alias("r"))
    cites = cites.select("source_id", F.concat(F.lit("ref:"), F.expr("substring(r, 9)")).alias("target_id"), F.lit("cites").alias("edge_type"))
    state = t.where("state_code is not null").select(F.concat(F.lit("doc:"), F.col("doc_id")).alias("source_id"), F.concat(F.lit("state:"), F.upper("state_code")).alias("target_id"), F.lit("in_state").alias("edge_type"))
    return cites.unionByName(state).where("source_id <> target_id").distinct()


def kg_edges(spark, d):
    """Distinct citation and state edges of the documents."""
    return _edges(spark, d)


def kg_nodes(spark, d):
    """Nodes of both ends; the first type of a node stays."""
    return _nodes(write_shared(_edges(spark, d), "kg-edges"))


def _nodes(e: DataFrame) -> DataFrame:
    ends = e.select(F.col("source_id").alias("node_id")).unionByName(e.select(F.col("target_id").alias("node_id"))).distinct()
    return ends.select("node_id", F.split_part("node_id", F.lit(":"), F.lit(1)).alias("node_type"))


def kg_stats(spark, d):
    return _edges(spark, d).groupBy("edge_type").agg(F.count("*").alias("edges"), F.countDistinct("source_id").alias("sources"), F.countDistinct("target_id").alias("targets"))


def kg_tagged(spark, d):
    """Nodes and edges as one table, each with an identifier of its content."""
    e = write_shared(_edges(spark, d), "kg-edges")  # used three times
    n = _nodes(e)
    null = F.lit(None).cast("string")
    rows = n.select(F.lit("node").alias("record_type"), F.col("node_id").alias("a"), null.alias("b")).unionByName(
        e.select(F.lit("edge").alias("record_type"), F.col("source_id").alias("a"), F.col("target_id").alias("b"))
    )
    return rows.select("record_type", "a", "b", cid_v1(F.concat_ws("|", "record_type", "a", "b")).alias("cid"))


def key_cid_index(spark, d):
    """Identifier of each citation: documents with a text come before those
    without."""
    t = _docs(spark, d).where("official_cite is not null").select(
        F.upper(F.regexp_replace("official_cite", "[^A-Za-z0-9]", "")).alias("key"), "doc_id", F.when(F.col("text").isNotNull(), 2).otherwise(1).alias("priority")
    )
    best = best_by_key(t, ["key"], [F.col("priority")], F.col("doc_id"))
    return best.select("key", cid_v1(F.concat(F.lit("doc:"), F.col("doc_id"))).alias("cid"), "priority")


def semantic_text(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.join_parts("\n", F.col("p_name"), F.col("p_brand"), F.col("p_type"), least=9).alias("text"))


def section_segment(spark, d):
    """Sections of the documents' lines."""
    return segment(line_rows(_docs(spark, d), "doc_id", "text"), "doc_id", r"^(Rule|Article|Section) \d")


def html_title(spark, d):
    """Titles of pages made of the documents."""
    page = F.concat(F.lit("<html><head><TITLE lang='en'>\n "), F.col("doc_kind"), F.lit("  of   "), F.coalesce("source", F.lit("")), F.lit(" - Site</TITLE></head>"))
    return _docs(spark, d).where("doc_kind is not null").select("doc_id", X.html_title(page).alias("title"))


def html_links_query(spark, d):
    """Absolute links of pages made of the fetches: an absolute link, one from
    the root and one beside the page."""
    from ..sources.readers import html_links

    t = table(spark, d, "fetch_result").where("url is not null").select("fetch_id", "url", "archive_url").distinct()
    page = F.concat(
        F.lit('<p>See <a href="'), F.coalesce("archive_url", F.lit("")), F.lit('">copy  <b>of it</b></a> <a class="x" href="/root/'), F.col("fetch_id"),
        F.lit('?a=1">root</a> <a>none</a><a href="beside.html">beside</a><script>var a = "<a href=\'no\'>";</script>'),
    )
    base = F.concat(F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]+)", 1), F.lit("/dir/page.html?q=1"))
    got = t.select("fetch_id", F.explode(html_links(page, base)).alias("l"))
    return got.select("fetch_id", F.col("l.url").alias("link"), F.col("l.text").alias("text"))


def subsection_tree_query(spark, d):
    return subsection_tree(_docs(spark, d).select("doc_id", "text"), "doc_id", "text").select("doc_id", "path", "depth", "kind")


def _planted(spark, d):
    """A text of numbered parts for each document: every fifth skips a number
    and every seventh leaves a part empty."""
    gap, empty = F.col("doc_id") % 5 == 0, F.col("doc_id") % 7 == 0
    last = [F.when(gap, F.lit(x)).otherwise(F.lit(y)) for x, y in (("(909) z ", "(903) z "), ("(910) ", "(904) "), ("(911) v", "(905) v"))]
    tail = F.concat(F.lit("\n(901) x (902) y "), last[0], last[1], F.when(empty, "").otherwise("u "), last[2])
    return _docs(spark, d).select("doc_id", F.concat(F.lit("Head."), tail).alias("text"))


def tree_issues_query(spark, d):
    return tree_issues(subsection_tree(_planted(spark, d), "doc_id", "text"), "doc_id")


def warning_breakdown(spark, d):
    return tree_issues_query(spark, d).groupBy("issue").agg(F.count("*").alias("documents"))


def union_by_name(spark, d):
    """Two kinds of rows with different columns as one table."""
    a = _docs(spark, d).select("doc_id", "lang", F.lit("documents").alias("origin"))
    b = table(spark, d, "doc_labels").select("doc_id", "abusive", F.lit("labels").alias("origin"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("origin", "lang", "abusive").agg(F.count("*").alias("n"))


def latest_edition(spark, d):
    """Latest order of each customer, by a date written in a text."""
    o = table(spark, d, "orders").withColumn("t", F.concat(F.lit("edition of "), F.date_format("o_orderdate", "yyyy-MM-dd")))
    day = F.to_date(F.regexp_extract("t", r"(\d{4}-\d{2}-\d{2})", 1))
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct(day, "o_orderkey")).alias("o_orderkey"))


QUERIES = {
    "nested_haspart_explode": nested_haspart_explode, "best_row_dedupe": best_row_dedupe, "text_quality": text_quality, "text_quality_whole": text_quality_whole, "state_extract": state_extract,
    "row_score": row_score, "clean_threshold": clean_threshold, "reject_reason": reject_reason, "reject_histogram": reject_histogram,
    "family_infer": family_infer, "cid_v1": cid_v1_query, "cid_dedupe": cid_dedupe, "partition_manifest": partition_manifest, "kg_edges": kg_edges,
    "kg_nodes": kg_nodes, "kg_stats": kg_stats, "kg_tagged": kg_tagged, "key_cid_index": key_cid_index, "semantic_text": semantic_text,
    "section_segment": section_segment, "html_title": html_title, "html_links": html_links_query, "subsection_tree": subsection_tree_query,
    "tree_issues": tree_issues_query, "warning_breakdown": warning_breakdown, "union_by_name": union_by_name, "latest_edition": latest_edition,
}


def _cid(x: str) -> str:
    """SQL of the identifier of a text expression."""
    h = f"('01a9021220' || sha256({x}))"
    part = lambda at, n: f"lpad(to_base(('0x' || substr({h}, {at}, {n}))::bigint, 32), 8, '0')"
    tail = f"lpad(to_base(('0x' || substr({h}, 71, 4) || '0')::bigint, 32), 4, '0')"
    body = " || ".join([*(part(1 + 10 * i, 10) for i in range(7)), tail])
    return f"('b' || translate({body}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'abcdefghijklmnopqrstuvwxyz234567'))"


_SCORE = """case when length(t) >= 1200 then 2 else 0 end + case when length(t) >= 300 then 1 else 0 end + case when contains(lower(t), 'section') then 2 else 0 end
    + case when contains(lower(t), 'shall') then 1 else 0 end - case when contains(lower(t), 'cookie') then 3 else 0 end - case when length(t) < 40 then 4 else 0 end
    + case when official_cite is not null then 1 else 0 end"""
_D = "d as (select *, coalesce(text, '') as t from documents)"
_REASON = "case when t = '' then 'no_text' when trim(t, ' ') = '' then 'blank' when length(t) < 100 then 'short' when source is null then 'no_source' when lang is null then 'no_lang' end"
_EDGES = f"""e as (select distinct * from (
      select 'doc:' || doc_id as source_id, 'ref:' || substr(unnest(regexp_extract_all(text, '{_REF}')), 9) as target_id, 'cites' as edge_type from documents where text is not null
      union all select 'doc:' || doc_id, 'state:' || upper(state_code), 'in_state' from documents where text is not null and state_code is not null))"""
_NODES = "n as (select distinct node_id, split_part(node_id, ':', 1) as node_type from (select source_id as node_id from e union all select target_id from e))"
_KEY = "upper(regexp_replace(official_cite, '[^A-Za-z0-9]', '', 'g'))"
SQL = {
    "html_links": """with t as (select distinct fetch_id, url, archive_url from fetch_result where url is not null), o as (select *, lower(regexp_extract(url, '^[a-zA-Z]+://', 0)) || regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) as o from t)
        select fetch_id, archive_url as link, 'copy of it' as text from o where archive_url <> '' union all select fetch_id, o || '/root/' || fetch_id || '?a=1', 'root' from o
        union all select fetch_id, o || '/dir/beside.html', 'beside' from o""",
    "tree_issues": "select doc_id, 'gap' as issue from documents where doc_id % 5 = 0 union all select doc_id, 'empty' from documents where doc_id % 7 = 0",
    "warning_breakdown": """with i as (select 'gap' as issue from documents where doc_id % 5 = 0 union all select 'empty' from documents where doc_id % 7 = 0)
        select issue, count(*) as documents from i group by 1""",
    "nested_haspart_explode": "select source, doc_id, lang, length(regexp_replace(coalesce(text, ''), '^[\\s\\p{Z}\\x0b\\x85]+|[\\s\\p{Z}\\x0b\\x85]+$', '', 'g'))::int as chars from documents where source is not null",
    "best_row_dedupe": f"""select {_KEY} as k, doc_id from documents where official_cite is not null
        qualify row_number() over (partition by {_KEY} order by length(coalesce(text, '')) desc, (state_code is not null) desc, doc_id) = 1""",
    "text_quality": """with c as (select doc_id, len(regexp_extract_all(left(lower(coalesce(text, '')), 4000), '\\b(?:section|shall|pursuant)\\b|§'))::int as legal,
        len(regexp_extract_all(left(lower(coalesce(text, '')), 4000), '\\b(?:click|cookie|menu)\\b'))::int as noise from documents) select *, legal * 5 - noise * 4 as score from c""",
    "text_quality_whole": """with c as (select doc_id, len(regexp_extract_all(lower(coalesce(text, '')), '\\b(?:section|shall|pursuant)\\b|§'))::int as legal,
        len(regexp_extract_all(lower(coalesce(text, '')), '\\b(?:click|cookie|menu)\\b'))::int as noise from documents) select *, legal * 5 - noise * 4 as score from c""",
    "state_extract": "select doc_id, coalesce(case when regexp_matches(upper(trim(state_code)), '^[A-Z]{2}$') then upper(trim(state_code)) end, nullif(regexp_extract(source, '^([a-z]+)_', 1), ''), 'unknown') as state from documents",
    "row_score": f"with {_D} select doc_id, {_SCORE} as score from d",
    "clean_threshold": f"with {_D}, s as (select lang, {_SCORE} as score from d) select lang, count(*) as seen, count_if(score >= 2) as kept, count_if(score < 2) as dropped from s group by 1",
    "reject_reason": f"with {_D} select doc_id, {_REASON} as reason from d",
    "reject_histogram": f"with {_D} select coalesce({_REASON}, 'accept') as reason, count(*) as n from d group by 1",
    "family_infer": f"""with {_D} select case when contains(lower(t), 'court') then 'court' when contains(lower(t), 'ordinance') then 'ordinance' when contains(lower(t), 'permit') then 'permit'
        when contains(lower(t), 'notice') then 'notice' else 'other' end as family, count(*) as n, min(doc_id) as first_id, max(doc_id) as last_id from d group by 1""",
    "cid_v1": f"select doc_id, {_cid('text')} as cid from documents where text is not null",
    "cid_dedupe": f"select {_cid('text')} as cid, min(doc_id) as doc_id from documents where text is not null group by text",
    "partition_manifest": "select l as lang, count(*) as documents, count(text) as with_text, count(distinct text) as texts from (select coalesce(lang, 'none') as l, text from documents) group by rollup(l)",
    "kg_edges": f"with {_EDGES} select * from e",
    "kg_nodes": f"with {_EDGES}, {_NODES} select * from n",
    "kg_stats": f"with {_EDGES} select edge_type, count(*) as edges, count(distinct source_id) as sources, count(distinct target_id) as targets from e group by 1",
    "kg_tagged": f"""with {_EDGES}, {_NODES}, r as (select 'node' as record_type, node_id as a, null as b from n union all select 'edge', source_id, target_id from e)
        select *, {_cid("concat_ws('|', record_type, a, b)")} as cid from r""",
    "key_cid_index": f"""with k as (select {_KEY} as key, doc_id, case when text is not null then 2 else 1 end as priority from documents where official_cite is not null
        qualify row_number() over (partition by {_KEY} order by priority desc, doc_id) = 1) select key, {_cid("('doc:' || doc_id)")} as cid, priority from k""",
    "semantic_text": "select p_partkey, array_to_string(list_filter([trim(p_name), trim(p_brand), trim(p_type)], lambda x: length(x) >= 9), chr(10)) as text from part",
    "section_segment": """with l as (select doc_id, i as line_no, p[i] as line from (select doc_id, p, unnest(range(1, len(p) + 1)) as i from (select doc_id, string_split(text, chr(10)) as p from documents where text is not null))),
        s as (select *, sum(case when regexp_matches(line, '^(Rule|Article|Section) \\d') then 1 else 0 end) over (partition by doc_id order by line_no rows unbounded preceding) as section from l)
        select doc_id, section::bigint as section, arg_min(line, line_no) as title, count(*) as lines from s group by 1, 2""",
    "html_title": "select doc_id, doc_kind || ' of' || case when coalesce(source, '') = '' then '' else ' ' || source end as title from documents where doc_kind is not null",
    "union_by_name": """select origin, lang, abusive, count(*) as n from (select lang, null as abusive, 'documents' as origin from documents union all select null, abusive, 'labels' from doc_labels) group by 1, 2, 3""",
    "latest_edition": "select o_custkey, arg_max(o_orderkey, row(o_orderdate::date, o_orderkey)) as o_orderkey from orders group by 1",
}
