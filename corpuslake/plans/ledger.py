"""Queries of ledgers and searches: stages, signatures, retries, budgets,
captures by year, two-hop index searches, inventories of hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import text as X, url as U
from ..operators.keyed import inversions, numbered, ranked
from ..session import shared_path
from ..sources import sinks
from ..tables import table
from .inventory import _H, similar_names

#: The moment that ages are counted to, so that results stay the same.
NOW = "2024-01-30 12:00:00"


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "domain_index").distinct()


# ---- stages and runs ------------------------------------------------------
def stage_state(spark, d):
    """State of each file (user) in each stage (type): its last event counts;
    a file is failed where the last one has a low value."""
    last = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    t = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("events"), last.alias("l"))
    return t.select("user_id", "event_type", "events", F.col("l.event_id").alias("event_id"), F.when(F.col("l.value") < 10, "failed").otherwise("done").alias("state"))


def stage_query(spark, d):
    """Files that failed in one stage."""
    return stage_state(spark, d).where("event_type = 'purchase' and state = 'failed'").select("user_id")


def run_signature(spark, d):
    """Runs to be done: by the signature of their parameters, those that no
    successful run has."""
    sign = F.sha2(F.concat_ws("|", "url", F.coalesce("method_used", F.lit(""))), 256)
    t = table(spark, d, "scrape_attempts").where("url is not null").select(sign.alias("signature"), F.lower(F.trim("status")).alias("status"))
    return t.select("signature").distinct().join(t.where("status = 'success'").select("signature"), "signature", "left_anti")


def resume_batches(spark, d):
    """Batches of 100 events that are not yet done: the ledger knows those up
    to the middle."""
    t = table(spark, d, "events").select(F.floor(F.col("event_id") / 100).alias("batch")).groupBy("batch").agg(F.count("*").alias("events"))
    done = t.agg(F.floor(F.max("batch") / 2).alias("done"))  # one row
    return t.join(F.broadcast(done), F.col("batch") > F.col("done")).select("batch", "events")


def ttl_cache(spark, d):
    """URLs whose latest state is older than 300 days: to be fetched again."""
    age = (F.unix_micros(_now()) - F.unix_micros("last_finished_at")) / 86_400_000_000
    return table(spark, d, "url_cid_latest").where(F.col("last_finished_at").isNotNull() & (age > 300)).select("url", F.floor(age).alias("days"))


def timeouts(spark, d):
    """Worker and supervisor limits of a budget in seconds; none for none."""
    v = F.col("value")
    worker = F.when(v <= 20, 0.0).otherwise(F.greatest(v + 30, v * 1.5))
    return table(spark, d, "events").select("event_id", F.round(worker, 6).alias("worker"), F.round(F.when(worker <= 0, 0.0).otherwise(F.greatest(worker + 20, worker * 1.75)), 6).alias("supervisor"))


def _retry_text() -> Column:
    """The end of an event's pause, as text in three spellings."""
    at = F.col("ts").cast("timestamp") + F.expr("make_interval(0, 0, 0, 20, 0, 0, 0)")
    z, plain = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.col("event_id") % 3 == 0, z).when(F.col("event_id") % 3 == 1, plain).otherwise(F.concat(plain, F.lit("+00:00")))


def retry_times(spark, d):
    """Seconds until a retry, of texts with Z, an offset or no zone (UTC)."""
    bare = F.regexp_replace(_retry_text(), r"(Z|[+-]\d\d:\d\d)$", "")
    at = F.try_to_timestamp(bare, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, d, "events").select("event_id", F.round(X.seconds_left(at, _now()), 3).alias("seconds"))


def stalled_states(spark, d):
    """States named in issues such as `document-recovery-stalled:AZ,IN`."""
    t = table(spark, d, "candidate_row").where("state is not null").withColumn("code", F.upper(F.trim("state")))
    issues = F.array(F.concat(F.lit("document-recovery-stalled:"), F.col("code"), F.lit(",zz1,"), F.lower("code")), F.lit("other:QQ"), F.concat(F.lit("document-recovery-stalled:"), F.col("code")))
    return t.select("candidate_id", F.array_join(X.listed_states(issues, "document-recovery-stalled"), ",").alias("states"))


def pending_report(spark, d):
    """Users with their pending retry and last summary; idle without one."""
    t = table(spark, d, "events")
    summary = t.groupBy("user_id").agg(F.count("*").alias("events"))
    pending = t.where("event_type = 'error'").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("at"))
    left = X.seconds_left(F.col("at") + F.expr("interval 2 days"), _now())
    status = F.when(left > 0, "pending_retry").otherwise("idle")
    return summary.join(pending, "user_id", "left").select("user_id", "events", status.alias("status"), F.coalesce(F.round(left, 3), F.lit(0.0)).alias("seconds"))


def discovery_summary(spark, d):
    """Records, states with records and without a text, of each collection of files."""
    kind = F.split_part("source_file", F.lit("/"), F.lit(2))
    t = table(spark, d, "candidate_row").where("source_file is not null").withColumn("s", F.upper(F.trim("state")))
    has = F.coalesce(F.get_json_object("row_json", "$.text"), F.get_json_object("row_json", "$.full_text"), F.lit("")) != ""
    return t.groupBy(kind.alias("corpus")).agg(F.count("*").alias("records"), F.countDistinct("s").alias("states"), F.countDistinct(F.when(has, F.col("s"))).alias("states_with_text"), F.count_if(~has).alias("gaps"))


def finished_pending(spark, d):
    """The requested states in two lists: with enough rows, and without."""
    asked = spark.createDataFrame([(s,) for s in ("ME", "KS", "PA", "QQ", "WY", "CA")], "state string")
    n = table(spark, d, "candidate_row").groupBy(F.upper(F.trim("state")).alias("state")).agg(F.count("*").alias("n"))
    t = asked.join(n, "state", "left").select("state", (F.coalesce("n", F.lit(0)) >= 3).alias("finished"))
    return t.groupBy("finished").agg(F.array_join(F.array_sort(F.collect_list("state")), ",").alias("states"))  # as long as the request


def manifest_requested(spark, d):
    """Rows of each requested state by the manifest; 0 where it has none."""
    asked = spark.createDataFrame([(s,) for s in ("ME", "KS", "PA", "QQ", "WY", "CA")], "state string")
    n = table(spark, d, "candidate_row").groupBy(F.upper(F.trim("state")).alias("state")).agg(F.count("*").alias("n"))
    return asked.join(n, "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("rows"))


# ---- index files ----------------------------------------------------------
def missing_conversions(spark, d):
    """Index shards without a Parquet file of theirs, of the first 40 shards
    of each collection."""
    t = _index(spark, d).where("cc_collection is not null")
    have = t.select("cc_collection", F.regexp_extract("shard_file", r"^(cdx-\d+\.gz)", 1).alias("gz")).distinct()
    want = t.select("cc_collection").distinct().join(F.broadcast(spark.range(40).select(F.format_string("cdx-%07d.gz", "id").alias("gz"))))
    return want.join(have, ["cc_collection", "gz"], "left_anti")


def meta_two_hop(spark, d):
    """URLs of a domain by two hops: the index names its host and files, the
    URL table is read for hosts that have any."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim("domain")), r"^www\.", ""), r"\.$", "")
    shards = _index(spark, d).where("crawl_year >= 2020").select("shard_file", plain.alias("host"))
    files = shards.where(F.col("host").endswith(".example")).select("shard_file").distinct()
    hosts = shards.join(files, "shard_file", "left_semi").select("host").distinct()
    return table(spark, d, "url_cid_latest").where("url is not null").select("url", U.host(F.col("url")).alias("host")).join(hosts, "host", "left_semi")


def layout_dispatch(spark, d):
    """Captures of each domain whatever the index layout: an older layout has
    counted rows, a newer one a row for each capture."""
    t = table(spark, d, "domain_index")
    n = F.sum("row_count") if "row_count" in t.columns else F.count("*")
    return t.where("domain is not null").groupBy("domain").agg(n.alias("captures"))


def exact_url_preferred(spark, d):
    """Captures of an address: those of exactly its spelling if there are
    any, else those of all spellings."""
    key = F.lower(F.regexp_replace(U.seed(F.col("url")), r"^https?://(www\.)?", ""))
    asked = table(spark, d, "url_cid_latest").where("url is not null").select(F.col("url").alias("asked"), key.alias("k")).distinct()
    have = table(spark, d, "fetch_result").where("url is not null").select("fetch_id", "url", key.alias("k")).distinct()
    j = asked.join(have, "k").withColumn("exact", (F.col("url") == F.col("asked")).cast("int"))
    best = j.groupBy("asked").agg(F.max("exact").alias("exact"))
    return j.join(best, ["asked", "exact"]).select(F.col("asked").alias("url"), "fetch_id", "exact")


def search_by_year(spark, d):
    """The five best pointers of each domain in each of the newest three
    years; the domain's rows are ranked without gathering them."""
    t = _index(spark, d).where("domain is not null and crawl_year >= 2022").select(F.lower("domain").alias("domain"), "crawl_year", "parquet_file", "row_offset", "row_count").distinct()
    r = ranked(t, ["domain", "crawl_year"], [F.col("row_count").desc_nulls_last(), F.col("parquet_file").asc_nulls_last(), F.col("row_offset").asc_nulls_last()], "place")
    return r.where("place <= 5").select("domain", "crawl_year", "place", "row_count")


def budget_files(spark, d):
    """A budget of 300 pointers over all files in their order: each file gives
    what the files before it left."""
    t = _index(spark, d).select("parquet_file", "row_offset", "domain")
    n = numbered(t, ["parquet_file", "row_offset", "domain"], "no").where("no < 300")
    return n.groupBy("parquet_file").agg(F.count("*").alias("taken"))


def limit_collections(spark, d):
    """At most 40 pointers of each collection, then at most 150 in all, in
    order of collection, file and row."""
    t = _index(spark, d).where("cc_collection is not null").select("cc_collection", "parquet_file", "row_offset", "domain", "row_count")
    own = ranked(t, ["cc_collection"], ["parquet_file", "row_offset", "domain", "row_count"], "n").where("n <= 40")
    return numbered(own, ["cc_collection", "n"], "no").where("no < 150").select("cc_collection", "n", "no")


def recency_order(spark, d):
    """Collections by year and name, newest first."""
    t = _index(spark, d).where("cc_collection is not null").select("cc_collection", U.crawl_year(F.col("cc_collection")).alias("year")).distinct()
    return numbered(t, [F.col("year").desc_nulls_last(), F.col("cc_collection").desc()], "position")


def latest_collections(spark, d):
    """The three latest collections, by year and name."""
    return recency_order(spark, d).where("position < 3").select("cc_collection", "position")


def file_status(spark, d):
    """Share of sorted and unsorted index files, in percent."""
    t = inversions(_index(spark, d), F.col("domain"), "row_offset", ["parquet_file"])
    c = t.groupBy(F.when(F.col("inversions") == 0, "sorted").otherwise("unsorted").alias("status")).agg(F.count("*").alias("files"))
    whole = t.agg(F.count("*").alias("whole"))  # one row
    return c.join(F.broadcast(whole)).select("status", "files", F.round(F.col("files") * 100.0 / F.col("whole"), 4).alias("percent"))


def sort_verify(spark, d):
    """The index sorted, written, read back and checked: rows and inversions."""
    path = shared_path(spark, "sorted")
    t = numbered(_index(spark, d).select("domain", "parquet_file", "row_offset", "row_count"), ["domain", "parquet_file", "row_offset", "row_count"], "no")
    sinks.parquet(t, path, sort=["no"])
    back = spark.read.parquet(path)
    # A range of numbers is checked in its own window; its first row against the last of the range before.
    part = back.withColumn("p", F.floor(F.col("no") / 1000))
    w = Window.partitionBy("p").orderBy("no")
    inside = part.select((F.lag("domain").over(w) > F.col("domain")).alias("bad"))
    ends = part.groupBy("p").agg(F.min_by("domain", "no").alias("first"), F.max_by("domain", "no").alias("last"))
    over = ends.alias("a").join(ends.alias("b"), F.col("b.p") == F.col("a.p") + 1).select((F.col("a.last") > F.col("b.first")).alias("bad"))
    return inside.unionByName(over).agg(F.count_if("bad").alias("inversions")).join(F.broadcast(back.agg(F.count("*").alias("rows"))))


# ---- hosts ----------------------------------------------------------------
def url_more_parts(spark, d):
    """Further ways to a domain: the third part of the address, its letters in
    reverse, as people type it, and the last part of the path as a title."""
    u = F.col("url")
    third = F.coalesce(F.try_element_at(F.split(u, "/"), F.lit(3)), F.lit(""))
    return table(spark, d, "url_cid_latest").where("url is not null").select("url", third.alias("third"), F.reverse(U.host(u)).alias("reversed"), U.typed_domain(u).alias("typed"), U.last_segment_title(u).alias("title"))


def agency_paths(spark, d):
    """Pages whose path is that of an agency or a directory."""
    agency = F.col("url").rlike(r"(?i)/(agency|agencies|departments?|boards?|commissions?)/|/(ordinances?|rules?)/[a-z0-9_-]+")
    return table(spark, d, "url_cid_latest").where("url is not null").select("url", agency.alias("agency"), F.lower("url").rlike(r"/(directory|index|list|archive)\b").alias("directory"))


def agency_inventory(spark, d):
    """Government hosts as entities: classified, merged over all sources that
    name them, with a slug, sorted aliases and sources, and a confidence that
    grows with the sources."""
    parts = [
        table(spark, d, "url_cid_latest").select(F.lit("latest").alias("src"), "url"), table(spark, d, "fetch_result").select(F.lit("fetched").alias("src"), "url"),
        table(spark, d, "scrape_attempts").select(F.lit("attempted").alias("src"), "url"),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("url is not null")
    host = U.host(F.col("url"))
    kind = X.first_match([("county", host.contains("county")), ("law", host.rlike(r"^(law|code|rules)\.")), ("city", host.rlike(r"^(city|town)"))])
    t = every.select("src", host.alias("host"), U.domain(F.col("url")).alias("alias"), kind.alias("kind")).where("kind is not null").distinct()
    g = t.groupBy("host", "kind").agg(F.array_join(F.array_sort(F.collect_set("alias")), "|").alias("aliases"), F.array_join(F.array_sort(F.collect_set("src")), "|").alias("sources"), F.countDistinct("src").alias("n"))
    return g.select("host", "kind", U.slug(F.col("host")).alias("slug"), "aliases", "sources", F.round(F.col("n") / 3, 6).alias("confidence"))


def portal_seeds(spark, d):
    """The best page of each kind of site and of each registrable domain, one
    for each."""
    path = F.lower(F.regexp_replace("url", r"^[^/]*//[^/]*", ""))
    s = X.weighted([(5, path.contains("rules")), (3, path.contains("docs")), (1, path.contains("news"))]) * 1000 - F.length("url")
    t = table(spark, d, "url_cid_latest").where("url is not null").select(U.registrable(U.host(F.col("url"))).alias("site"), "url", s.alias("s"))
    return t.groupBy("site").agg(F.max_by("url", F.struct("s", "url")).alias("seed"))


def names_match(spark, d):
    """Pairs of parts of one brand whose names have at least 0.6 of their words
    in common, or the words of one are among the other's."""
    return similar_names(table(spark, d, "part"), "p_partkey", "p_brand", "p_name", 0.6)


def fetched_unlisted(spark, d):
    """Latest URLs that no fetch has yet."""
    done = table(spark, d, "fetch_result").where("url is not null").select("url")
    return table(spark, d, "url_cid_latest").where("url is not null").select("url").distinct().join(done, "url", "left_anti")


def cross_totals(spark, d):
    """Totals over the tables of several workers, and their difference to the
    first in percent."""
    part = lambda name, w, n: table(spark, d, name).select(F.lit(name).alias("store"), F.col(w).alias("worker"), F.col(n).alias("bytes"))
    t = part("scrape_attempts", "worker_id", "content_bytes").unionByName(part("fetch_result", "worker_id", "content_bytes"))
    g = t.groupBy("worker").agg(F.count_if(F.col("store") == "scrape_attempts").alias("attempts"), F.count_if(F.col("store") == "fetch_result").alias("fetches"), F.sum("bytes").alias("bytes"))
    return g.withColumn("change_percent", F.when(F.col("attempts") > 0, F.round((F.col("fetches") - F.col("attempts")) * 100.0 / F.col("attempts"), 6)))


def resolve_bounded(spark, d):
    """Pointers of each domain: those of its newest year only, at most three
    of each collection, and at most ten in all."""
    t = _index(spark, d).where("domain is not null and crawl_year is not null and cc_collection is not null").select(F.lower("domain").alias("domain"), "crawl_year", "cc_collection", "parquet_file", "row_offset", "row_count").distinct()
    newest = t.groupBy("domain").agg(F.max("crawl_year").alias("crawl_year"))
    t = t.join(newest, ["domain", "crawl_year"])
    order = [F.col("row_count").desc_nulls_last(), F.col("parquet_file").asc_nulls_last(), F.col("row_offset").asc_nulls_last()]
    own = ranked(t, ["domain", "cc_collection"], order, "n").where("n <= 3")
    return ranked(own, ["domain"], [*order, F.col("cc_collection").asc()], "place").where("place <= 10").select("domain", "place", "row_count")


def kind_filter(spark, d):
    """Sites of one kind of the inventory only, with a confidence of two thirds."""
    return agency_inventory(spark, d).where("kind = 'law' and confidence >= 0.6").select("host", "slug")


_QUERIES = (
    cross_totals, resolve_bounded, kind_filter, stage_state, stage_query, run_signature, resume_batches, ttl_cache, timeouts, retry_times, stalled_states, pending_report, discovery_summary,
    finished_pending, manifest_requested, missing_conversions, meta_two_hop, layout_dispatch, exact_url_preferred, search_by_year, budget_files,
    limit_collections, recency_order, latest_collections, file_status, sort_verify, url_more_parts, agency_paths, agency_inventory, portal_seeds,
    names_match, fetched_unlisted,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_NOW = f"timestamp '{NOW}'"
_I = "i as (select distinct * from domain_index)"
_YEAR = "try_cast(string_split(cc_collection, '-')[3] as int)"
_SEED = "regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^:/])/{2,}', '\\1/', 'g'), '/+$', '')"
_SITE = f"array_to_string(list_slice(string_split({_H}, '.'), -(case when ends_with({_H}, '.us') then 3 else 2 end), -1), '.')"
_STAGE = "s as (select user_id, event_type, count(*) as events, arg_max(event_id, (ts, event_id)) as event_id, case when arg_max(value, (ts, event_id)) < 10 then 'failed' else 'done' end as state from events group by all)"
SQL = {
    "cross_totals": """with t as (select 'a' as s, worker_id as worker, content_bytes as bytes from scrape_attempts union all select 'f', worker_id, content_bytes from fetch_result),
        g as (select worker, count_if(s = 'a')::bigint as attempts, count_if(s = 'f')::bigint as fetches, sum(bytes)::bigint as bytes from t group by 1)
        select *, case when attempts > 0 then round((fetches - attempts) * 100.0 / attempts, 6)::double end as change_percent from g""",
    "resolve_bounded": f"""with {_I}, t as (select distinct lower(domain) as domain, crawl_year, cc_collection, parquet_file, row_offset, row_count from i where domain is not null and crawl_year is not null and cc_collection is not null),
        y as (select * from t qualify crawl_year = max(crawl_year) over (partition by domain)),
        o as (select * from y qualify row_number() over (partition by domain, cc_collection order by row_count desc nulls last, parquet_file nulls last, row_offset nulls last) <= 3)
        select domain, row_number() over (partition by domain order by row_count desc nulls last, parquet_file nulls last, row_offset nulls last, cc_collection) as place, row_count from o qualify place <= 10""",
    "kind_filter": "",
    "stage_state": f"with {_STAGE} select * from s",
    "stage_query": f"with {_STAGE} select user_id from s where event_type = 'purchase' and state = 'failed'",
    "run_signature": """with t as (select sha256(url || '|' || coalesce(method_used, '')) as signature, lower(trim(status)) as status from scrape_attempts where url is not null)
        select distinct signature from t where signature not in (select signature from t where status = 'success')""",
    "resume_batches": "with t as (select event_id // 100 as batch, count(*) as events from events group by 1) select batch, events from t where batch > (select max(batch) // 2 from t)",
    "ttl_cache": f"with t as (select url, (epoch_us({_NOW}) - epoch_us(last_finished_at)) / 86400000000.0 as age from url_cid_latest) select url, floor(age)::bigint as days from t where age > 300",
    "timeouts": """with t as (select event_id, case when value <= 20 then 0.0::double else greatest(value + 30, value * 1.5) end as w from events)
        select event_id, round(w, 6) as worker, round(case when w <= 0 then 0.0::double else greatest(w + 20, w * 1.75) end, 6) as supervisor from t""",
    "retry_times": f"select event_id, greatest(0.0::double, round((epoch_us(date_trunc('second', ts::timestamp) + interval 20 day) - epoch_us({_NOW})) / 1e6, 3)) as seconds from events",
    "stalled_states": "select candidate_id, case when regexp_matches(upper(trim(state)), '^[A-Z]{2}$') then upper(trim(state)) else '' end as states from candidate_row where state is not null",
    "pending_report": f"""with s as (select user_id, count(*) as events, max(ts) filter (where event_type = 'error') as last from events group by 1),
        t as (select user_id, events, greatest(0.0::double, (epoch_us(last::timestamp + interval 2 day) - epoch_us({_NOW})) / 1e6) as l, last from s)
        select user_id, events, case when last is not null and l > 0 then 'pending_retry' else 'idle' end as status, case when last is null then 0.0::double else round(l, 3) end as seconds from t""",
    "discovery_summary": """with t as (select split_part(source_file, '/', 2) as corpus, upper(trim(state)) as s, coalesce(row_json->>'text', row_json->>'full_text', '') <> '' as has from candidate_row where source_file is not null)
        select corpus, count(*) as records, count(distinct s) as states, count(distinct s) filter (where has) as states_with_text, count_if(not has)::bigint as gaps from t group by 1""",
    "finished_pending": """with a as (select unnest(['ME', 'KS', 'PA', 'QQ', 'WY', 'CA']) as state), n as (select upper(trim(state)) as state, count(*) as n from candidate_row group by 1),
        t as (select state, coalesce(n, 0) >= 3 as finished from a left join n using (state)) select finished, string_agg(state, ',' order by state) as states from t group by 1""",
    "manifest_requested": """with a as (select unnest(['ME', 'KS', 'PA', 'QQ', 'WY', 'CA']) as state), n as (select upper(trim(state)) as state, count(*) as n from candidate_row group by 1)
        select state, coalesce(n, 0) as rows from a left join n using (state)""",
    "missing_conversions": f"""with {_I}, h as (select distinct cc_collection, regexp_extract(shard_file, '^(cdx-\\d+\\.gz)', 1) as gz from i where cc_collection is not null),
        w as (select distinct cc_collection, format('cdx-{{:07d}}.gz', n) as gz from i, range(40) r(n) where cc_collection is not null) select * from w anti join h using (cc_collection, gz)""",
    "meta_two_hop": f"""with {_I}, s as (select shard_file, regexp_replace(regexp_replace(lower(trim(domain)), '^www\\.', ''), '\\.$', '') as host from i where crawl_year >= 2020),
        h as (select distinct host from s where shard_file in (select shard_file from s where ends_with(host, '.example')))
        select url, {_H} as host from url_cid_latest where url is not null and {_H} in (select host from h)""",
    "layout_dispatch": "select domain, sum(row_count)::bigint as captures from domain_index where domain is not null group by 1",
    "exact_url_preferred": f"""with a as (select distinct url as asked, lower(regexp_replace({_SEED}, '^https?://(www\\.)?', '')) as k from url_cid_latest where url is not null),
        h as (select distinct fetch_id, url, lower(regexp_replace({_SEED}, '^https?://(www\\.)?', '')) as k from fetch_result where url is not null),
        j as (select asked, fetch_id, (url = asked)::int as exact from a join h using (k)) select asked as url, fetch_id, exact from j qualify exact = max(exact) over (partition by asked)""",
    "search_by_year": f"""with {_I}, t as (select distinct lower(domain) as domain, crawl_year, parquet_file, row_offset, row_count from i where domain is not null and crawl_year >= 2022)
        select domain, crawl_year, row_number() over (partition by domain, crawl_year order by row_count desc nulls last, parquet_file nulls last, row_offset nulls last) as place, row_count from t qualify place <= 5""",
    "budget_files": f"""with {_I}, n as (select parquet_file, row_number() over (order by parquet_file nulls last, row_offset nulls last, domain nulls last) - 1 as no from i)
        select parquet_file, count(*) as taken from n where no < 300 group by 1""",
    "limit_collections": f"""with {_I}, o as (select cc_collection, row_number() over (partition by cc_collection order by parquet_file nulls last, row_offset nulls last, domain nulls last, row_count nulls last) as n from i where cc_collection is not null)
        select cc_collection, n, row_number() over (order by cc_collection, n) - 1 as no from o where n <= 40 qualify no < 150""",
    "recency_order": f"with {_I}, t as (select distinct cc_collection, {_YEAR} as year from i where cc_collection is not null) select *, row_number() over (order by year desc nulls last, cc_collection desc) - 1 as position from t",
    "latest_collections": f"with {_I}, t as (select distinct cc_collection, {_YEAR} as year from i where cc_collection is not null) select cc_collection, row_number() over (order by year desc nulls last, cc_collection desc) - 1 as position from t qualify position < 3",
    "file_status": f"""with {_I}, l as (select parquet_file, lag(domain) over (partition by parquet_file order by row_offset) > domain as bad from i),
        t as (select parquet_file, case when count_if(bad) = 0 then 'sorted' else 'unsorted' end as status from l group by 1)
        select status, count(*) as files, round(count(*) * 100.0 / (select count(*) from t), 4)::double as percent from t group by 1""",
    "sort_verify": "select 0::bigint as inversions, count(*) as rows from (select distinct * from domain_index)",
    "url_more_parts": f"""select url, coalesce(string_split(url, '/')[3], '') as third, reverse({_H}) as reversed,
        regexp_replace(split_part(regexp_replace(lower(trim(url)), '^[a-z]+://', ''), '/', 1), '^www\\.', '') as typed,
        array_to_string(list_transform(string_split(regexp_replace(url_decode(replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '/([^/]+)/?$', 1), '+', ' ')), '[-_]+', ' ', 'g'), ' '),
          lambda w: upper(w[1]) || lower(w[2:])), ' ') as title from url_cid_latest where url is not null""",
    "agency_paths": """select url, regexp_matches(url, '(?i)/(agency|agencies|departments?|boards?|commissions?)/|/(ordinances?|rules?)/[a-z0-9_-]+') as agency,
        regexp_matches(lower(url), '/(directory|index|list|archive)\\b') as directory from url_cid_latest where url is not null""",
    "agency_inventory": f"""with e as (select 'latest' as src, url from url_cid_latest union all select 'fetched', url from fetch_result union all select 'attempted', url from scrape_attempts),
        t as (select distinct src, {_H} as host, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', '') as alias from e where url is not null),
        k as (select *, case when contains(host, 'county') then 'county' when regexp_matches(host, '^(law|code|rules)\\.') then 'law' when regexp_matches(host, '^(city|town)') then 'city' end as kind from t)
        select host, kind, regexp_replace(regexp_replace(lower(host), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug, string_agg(distinct alias, '|' order by alias) as aliases,
          string_agg(distinct src, '|' order by src) as sources, round(count(distinct src) / 3.0, 6)::double as confidence from k where kind is not null group by host, kind""",
    "portal_seeds": f"""with t as (select {_SITE} as site, url, lower(regexp_replace(url, '^[^/]*//[^/]*', '')) as p from url_cid_latest where url is not null),
        s as (select site, url, (case when contains(p, 'rules') then 5 else 0 end + case when contains(p, 'docs') then 3 else 0 end + case when contains(p, 'news') then 1 else 0 end) * 1000 - length(url) as s from t)
        select site, first(url order by s desc, url desc) as seed from s group by 1""",
    "names_match": """with p as (select p_partkey, p_brand, list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda x: x not in ('', 'the', 'of', 'and', 'for', 'a'))) as t from part),
        j as (select a.p_partkey as l, b.p_partkey as r, len(list_intersect(a.t, b.t)) as i, len(a.t) + len(b.t) as n, least(len(a.t), len(b.t)) as k from p a join p b on a.p_brand = b.p_brand and a.p_partkey < b.p_partkey)
        select l as left_key, r as right_key, round(i::double / (n - i), 6) as similarity from j where i > 0 and (i::double / (n - i) >= 0.6 or i = k)""",
    "fetched_unlisted": "select distinct url from url_cid_latest where url is not null and url not in (select url from fetch_result where url is not null)",
}
SQL["kind_filter"] = f"select host, slug from ({SQL['agency_inventory']}) where kind = 'law' and confidence >= 0.6"
