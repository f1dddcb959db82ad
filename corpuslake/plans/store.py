"""Queries of the scrape store: folds, histories, anti joins, status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as X, url as U
from ..operators.hotkeys import key_quantiles
from ..operators.keyed import latest_by_key, ranked
from ..tables import table


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts without the rows that were loaded twice."""
    return table(spark, d, "scrape_attempts").distinct()


def _order():
    return F.struct(F.coalesce(F.unix_micros("finished_at"), F.lit(-1)), F.col("attempt_id"))


def upsert_url_latest(spark, d):
    """Last attempt of each URL, the number of attempts, and the last content
    that was there."""
    carry = ["status", "status_code", "method_used", "finished_at"]
    return latest_by_key(_attempts(spark, d), "url", _order(), carry, ["content_cid", "content_type"])


def upsert_cid_content(spark, d):
    """Content table folded from the attempts: first and last sight, most
    bytes, the earliest method, the latest type."""
    t = _attempts(spark, d).where("content_cid is not null and finished_at is not null")
    o = F.struct("finished_at", "attempt_id")
    return t.groupBy("content_cid").agg(
        F.min("finished_at").alias("first_seen_at"), F.max("finished_at").alias("last_seen_at"), F.max("content_bytes").alias("content_bytes"),
        F.min_by("method_used", F.when(F.col("method_used").isNotNull(), o)).alias("first_method"),
        F.max_by("content_type", F.when(F.col("content_type").isNotNull(), o)).alias("content_type"),
    )


def url_cid_history(spark, d):
    return table(spark, d, "scrape_attempts").where("url is not null and content_cid is not null").select("url", "content_cid", "finished_at", "worker_id").distinct()


def url_cid_map(spark, d):
    """Fetched URLs with the content they have now, if any."""
    f = table(spark, d, "fetch_result").where("url is not null").select("url").distinct()
    return f.join(table(spark, d, "url_cid_latest").select("url", "last_content_cid", "last_status"), "url", "left")


def resume_anti(spark, d):
    """Attempted URLs that never succeeded."""
    t = table(spark, d, "scrape_attempts").where("url is not null")
    good = t.where(F.lower(F.trim("status")) == "success").select("url")
    return t.select("url").distinct().join(good, "url", "left_anti")


def link_frontier(spark, d):
    """Links of a page to its own domain that were never attempted."""
    f = table(spark, d, "fetch_result").select(F.col("url").alias("source_url"), F.concat(U.seed(F.col("url")), F.lit("/next")).alias("found"))
    same = f.where(U.domain(F.col("source_url")) == U.domain(F.col("found"))).select(F.col("found").alias("url")).distinct()
    return same.join(table(spark, d, "scrape_attempts").select("url"), "url", "left_anti")


def archive_status(spark, d):
    """Latest archive fact of each URL, counted: in any archive, in the web
    archive, errors."""
    t = table(spark, d, "fetch_result").where("url is not null")
    last = t.groupBy("url").agg(F.max_by(F.struct("fetch_source", "archive_url", "status_code"), "fetch_id").alias("r"))
    return last.agg(
        F.count("*").alias("urls"), F.count_if(F.col("r.archive_url").isNotNull()).alias("archived"),
        F.count_if((F.col("r.fetch_source") == "wayback") & F.col("r.archive_url").isNotNull()).alias("in_wayback"),
        F.count_if(F.coalesce(F.col("r.status_code") >= 400, F.lit(False))).alias("errors"),
    )


def attempt_numbers(spark, d):
    """Attempt number of each attempt of an URL by time."""
    w = Window.partitionBy("url").orderBy(F.asc_nulls_last("finished_at"), "attempt_id")
    return _attempts(spark, d).where("url is not null").select("attempt_id", "url", F.row_number().over(w).alias("nth"))


def status_carry(spark, d):
    """Change of size against the attempt before it."""
    w = Window.partitionBy("url").orderBy(F.asc_nulls_last("finished_at"), "attempt_id")
    t = _attempts(spark, d).where("url is not null and content_bytes is not null")
    return t.select("attempt_id", (F.col("content_bytes") - F.lag("content_bytes").over(w)).alias("delta"))


def latency_stats(spark, d):
    """Least, greatest, mean and median of each type; the median comes from
    refined histograms, so no type's values are gathered."""
    t = table(spark, d, "events").select("event_type", F.round(F.col("value") * 1_000_000).cast("long").alias("v"))
    q = key_quantiles(t, "event_type", "v", [lambda n: F.floor((n + 1) / 2), lambda n: F.floor(n / 2) + 1], bins=2048)
    r = lambda c: F.round(c / 1e6, 6)
    return q.select(F.col("key").alias("event_type"), r(F.col("low")).alias("least"), r(F.col("high")).alias("most"), r(F.col("total") / F.col("n")).alias("mean"), r((F.col("q")[0] + F.col("q")[1]) / 2).alias("median"))


def run_compare(spark, d):
    """Two slices of a run side by side, with the change in percent."""
    t = table(spark, d, "events").agg(
        F.count_if(F.col("event_type") == "view").alias("a"), F.count_if(F.col("event_type") == "click").alias("b")
    )
    return t.select("a", "b", F.when(F.col("a") > 0, F.round((F.col("b") - F.col("a")) * 100.0 / F.col("a"), 6)).alias("change_percent"))


def jsonl_lenient_parse(spark, d):
    """Event properties, with every seventh row cut off, read leniently."""
    t = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4)).otherwise(F.col("props")).alias("p"))
    return t.select("event_id", F.from_json("p", "k int")["k"].alias("k")).where("k is not null")


def jsonl_lenient_every(spark, d):
    """Properties of every event, read leniently among cut-off copies."""
    t = table(spark, d, "events").select("event_id", F.col("props").alias("p"))
    broken = t.where("event_id % 7 = 0").select("event_id", F.substring("p", 1, 4).alias("p"))
    return t.unionByName(broken).select("event_id", F.from_json("p", "k int")["k"].alias("k")).where("k is not null")


def best_summary(spark, d):
    """Best event of each user by rank of its type, then value, then time."""
    rank = F.when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 2).otherwise(1)
    t = table(spark, d, "events").where("user_id is not null")
    return t.groupBy("user_id").agg(F.max_by("event_id", F.struct(rank, "value", "ts", "event_id")).alias("event_id"), F.max(rank).alias("rank"))


def pending_retry(spark, d):
    """Seconds left of a retry an hour after each user's last event."""
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    t = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("last"))
    left = X.seconds_left(F.col("last") + F.expr("interval 3 days"), now)
    return t.select("user_id", F.round(left, 6).alias("seconds_left"), F.when(left > 0, "pending_retry").otherwise("idle").alias("state"))


def cycle_gate(spark, d):
    """First unmet condition of each user's event counts."""
    t = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.sum("value").alias("v"))
    gate = X.first_match([("too_few", F.col("n") < 60), ("errors", F.col("errors") * 5 > F.col("n")), ("low", F.col("v") < 3000)], F.lit("pass"))
    return t.select("user_id", gate.alias("gate"))


def coverage_ratio(spark, d):
    """Which documents of a source carry a citation, as sets and a ratio."""
    t = table(spark, d, "documents").where("source is not null and state_code is not null")
    g = t.groupBy("source").agg(F.collect_set("state_code").alias("a"), F.collect_set(F.when(F.col("official_cite").isNotNull(), F.col("state_code"))).alias("b"))
    return g.select("source", F.size(F.array_except("a", "b")).alias("missing"), F.round(F.size("b") / F.size("a"), 6).alias("coverage"))


def batch_assign(spark, d):
    """Fixed-size batches of the sorted URLs of each shard."""
    t = table(spark, d, "url_cid_latest").select("url", U.shard(F.col("url"), 7).alias("shard"))
    return ranked(t, ["shard"], ["url"], "n").select("url", "shard", F.floor((F.col("n") - 1) / 25).cast("int").alias("batch"))


def status_classify(spark, d):
    """Share of each class of attempt, in percent."""
    c = X.first_match(
        [("unknown", F.col("status").isNull()), ("ok", F.lower(F.trim("status")) == "success"), ("gone", F.col("status_code").isin(404, 410)), ("refused", F.col("status_code").isin(401, 403, 429))],
        F.lit("error"),
    )
    t = table(spark, d, "scrape_attempts").groupBy(c.alias("class")).agg(F.count("*").alias("n"))
    return t.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


QUERIES = {
    f.__name__: f
    for f in (
        upsert_url_latest, upsert_cid_content, url_cid_history, url_cid_map, resume_anti, link_frontier, archive_status, attempt_numbers, status_carry,
        latency_stats, run_compare, jsonl_lenient_parse, jsonl_lenient_every, best_summary, pending_retry, cycle_gate, coverage_ratio, batch_assign, status_classify,
    )
}

_A = "a as (select distinct * from scrape_attempts)"
SQL = {
    "upsert_url_latest": f"""with {_A}, r as (select *, row_number() over (partition by url order by finished_at desc nulls last, attempt_id desc) as rn,
          count(*) over (partition by url) as n from a where url is not null)
        select url, n as attempts, status, status_code, method_used, finished_at,
          (select x.content_cid from r x where x.url = r.url and x.content_cid is not null order by x.rn limit 1) as content_cid,
          (select x.content_type from r x where x.url = r.url and x.content_type is not null order by x.rn limit 1) as content_type from r where rn = 1""",
    "upsert_cid_content": f"""with {_A}, t as (select * from a where content_cid is not null and finished_at is not null)
        select content_cid, min(finished_at) as first_seen_at, max(finished_at) as last_seen_at, max(content_bytes) as content_bytes,
          first(method_used order by finished_at, attempt_id) filter (where method_used is not null) as first_method,
          last(content_type order by finished_at, attempt_id) filter (where content_type is not null) as content_type from t group by 1""",
    "url_cid_history": "select distinct url, content_cid, finished_at, worker_id from scrape_attempts where url is not null and content_cid is not null",
    "url_cid_map": "select f.url, last_content_cid, last_status from (select distinct url from fetch_result where url is not null) f left join url_cid_latest u using (url)",
    "resume_anti": "select distinct url from scrape_attempts a where url is not null and not exists (select 1 from scrape_attempts b where b.url = a.url and lower(trim(b.status)) = 'success')",
    "link_frontier": """with f as (select url as s, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^:/])/{2,}', '\\1/', 'g'), '/+$', '') || '/next' as url from fetch_result)
        select distinct url from f where url is not null and not exists (select 1 from scrape_attempts a where a.url = f.url)""",
    "archive_status": """with l as (select url, arg_max(row(fetch_source, archive_url, status_code), fetch_id) as r from fetch_result where url is not null group by url),
        m as (select url, r[1] as s, r[2] as u, r[3] as c from l)
        select count(*) as urls, count(u) as archived, count_if(s = 'wayback' and u is not null) as in_wayback, count_if(coalesce(c >= 400, false)) as errors from m""",
    "attempt_numbers": f"with {_A} select attempt_id, url, row_number() over (partition by url order by finished_at nulls last, attempt_id) as nth from a where url is not null",
    "status_carry": f"with {_A} select attempt_id, content_bytes - lag(content_bytes) over (partition by url order by finished_at nulls last, attempt_id) as delta from a where url is not null and content_bytes is not null",
    "latency_stats": "select event_type, round(min(value), 6) as least, round(max(value), 6) as most, round(avg(value), 6) as mean, round(median(value), 6) as median from events group by 1",
    "run_compare": "with t as (select count_if(event_type = 'view') as a, count_if(event_type = 'click') as b from events) select a, b, case when a > 0 then round((b - a) * 100.0::double / a, 6) end as change_percent from t",
    "jsonl_lenient_parse": "select event_id, (props->>'k')::int as k from events where event_id % 7 <> 0 and props->>'k' is not null",
    "jsonl_lenient_every": "select event_id, (props->>'k')::int as k from events where props->>'k' is not null",
    "best_summary": """with t as (select *, case event_type when 'purchase' then 3 when 'signup' then 2 else 1 end as r from events where user_id is not null)
        select user_id, first(event_id order by r desc, value desc, ts desc, event_id desc) as event_id, max(r) as rank from t group by 1""",
    "pending_retry": """with t as (select user_id, greatest(0.0, (epoch_us(max(ts)) + 3 * 86400000000 - epoch_us(timestamp '2024-01-30 12:00:00')) / 1e6) as s from events group by 1)
        select user_id, round(s, 6) as seconds_left, case when s > 0 then 'pending_retry' else 'idle' end as state from t""",
    "cycle_gate": """with t as (select user_id, count(*) as n, count_if(event_type = 'error') as e, sum(value) as v from events group by 1)
        select user_id, case when n < 60 then 'too_few' when e * 5 > n then 'errors' when v < 3000 then 'low' else 'pass' end as gate from t""",
    "coverage_ratio": """with t as (select source, count(distinct state_code) as a, count(distinct case when official_cite is not null then state_code end) as b
        from documents where source is not null and state_code is not null group by 1) select source, (a - b)::int as missing, round(b::double / a, 6) as coverage from t""",
    "batch_assign": "with t as (select url, (('0x' || substr(sha256(url), 1, 16))::ubigint % 7)::int as shard from url_cid_latest) select url, shard, ((row_number() over (partition by shard order by url) - 1) // 25)::int as batch from t",
    "status_classify": """with t as (select case when status is null then 'unknown' when lower(trim(status)) = 'success' then 'ok' when status_code in (404, 410) then 'gone'
        when status_code in (401, 403, 429) then 'refused' else 'error' end as class, count(*) as n from scrape_attempts group by 1)
        select class, n, round(n * 100.0::double / sum(n) over (), 4) as percent from t""",
}
