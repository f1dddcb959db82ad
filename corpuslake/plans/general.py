"""Queries of the core's own problems (5: timestamps, 7: hot keys)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.hotkeys import key_quantiles, key_totals
from ..operators.timestamps import normalise
from ..session import write_shared
from ..tables import table


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    """worker_id -> zone; a fixed table of the workers, so it is broadcast."""
    return F.broadcast(table(spark, folder, "worker_zone").groupBy("worker_id").agg(F.min("tz_name").alias("tz_name")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each distinct value of the three fields that is an instant."""
    zones = _zones(spark, folder)
    fetch = table(spark, folder, "fetch_result").select("fetch_id", "worker_id", "fetched_at", "archive_timestamp")
    tries = table(spark, folder, "scrape_attempts").select("attempt_id", "worker_id", "started_at", "finished_at")
    fetch, tries = fetch.join(zones, "worker_id", "left"), tries.join(zones, "worker_id", "left")
    parts = []
    for name, key, df, field, how in (
        ("fetch_result", "fetch_id", fetch, "fetched_at", {"zone": "tz_name"}),
        ("fetch_result", "fetch_id", fetch, "archive_timestamp", {"capture": True}),
        ("scrape_attempts", "attempt_id", tries, "started_at", {"zone": "tz_name", "before": "finished_at"}),
    ):
        parts.append(
            normalise(df, field, "utc_us", **how)
            .where("utc_us is not null")
            .select(F.lit(name).alias("rec_table"), F.col(key).alias("rec_key"), F.lit(field).alias("field_name"), "utc_us")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def _captures(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct index rows with the domain in its plain spelling."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim("domain")), r"^www\.", ""), r"\.$", "")
    return table(spark, folder, "domain_index").distinct().select(F.when(plain != "", plain).alias("domain"), "row_count")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Domains with at least a hundredth of all captures.

    The totals of all keys are one mergeable pass that is written; the grand
    total is the sum of the keys' totals, so the rows are read once.
    """
    per = write_shared(key_totals(_captures(spark, folder), "domain", "row_count"), "p7-totals")
    grand = per.agg(F.sum("total").alias("grand"))  # one row
    return per.join(F.broadcast(grand)).where("key is not null and total * 100 >= grand").select(F.col("key").alias("domain"))


def p7_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """n, total, median and 9th decile of row_count for every domain."""
    q = key_quantiles(_captures(spark, folder), "domain", "row_count", [0.5, 0.9])
    return q.select(F.col("key").alias("domain"), "n", "total", F.col("q")[0].alias("median"), F.col("q")[1].alias("p90"))


QUERIES = {"p5_found": p5_found, "p7_found": p7_found, "p7_quantiles": p7_quantiles}

_PLAIN = r"regexp_replace(regexp_replace(lower(trim(domain)), '^www\.', ''), '\.$', '')"
_CAPTURES = f"select nullif({_PLAIN}, '') as domain, row_count from (select distinct * from domain_index)"

def _instants_sql() -> str:
    """The instants by SQL: each format's parts by its pattern, the calendar
    and the zones by the database."""
    import re

    from ..operators.timestamps import _CAPTURE, MONTHS, ZONE_MINUTES, _formats

    white = "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]"
    values = f"""v as (select distinct t, i, f, regexp_replace(x, '^{white}+|{white}+$', '', 'g') as x, tz, stop, cap from (
        select 'fetch_result' as t, fetch_id as i, 'fetched_at' as f, fetched_at as x, z.tz_name as tz, null::timestamptz as stop, false as cap from fetch_result left join z using (worker_id)
        union all select 'fetch_result', fetch_id, 'archive_timestamp', archive_timestamp, 'UTC', null, true from fetch_result
        union all select 'scrape_attempts', attempt_id, 'started_at', started_at, z.tz_name, finished_at::timestamptz, false from scrape_attempts left join z using (worker_id)) where x is not null)"""
    parts = []
    for n, (letter, pattern) in enumerate([_CAPTURE, *_formats()]):
        names = list(re.compile(pattern).groupindex)
        groups = "[" + ", ".join(f"'{x}'" for x in names) + "]"
        full = "(?i)^(?:" + pattern.replace("'", "''") + ")$"
        at = {x[1:]: f"g.{x}" for x in names}
        get = lambda k, at=at: at.get(k, "''")
        epoch = {"u": ("us", 1_000_000), "v": ("vs", 1000), "w": ("ws", 1)}.get(letter)
        direct = f"try_cast(g.{epoch[0]} as hugeint) * {epoch[1]}" + (" + try_cast(rpad(substr(g.uf, 1, 6), 6, '0') as hugeint)" if letter == "u" else "") if epoch else "null::hugeint"
        cols = ", ".join(f"{get(k) if not epoch else repr('')} as p_{k}" for k in "ymdhnsfzip")
        parts.append(f"select {n} as form, t, i, f, x, tz, stop, cap, {cols}, {direct} as direct from (select *, regexp_extract(x, '{full}', {groups}) as g from v where regexp_matches(x, '{full}'){' and cap' if n == 0 else ''})")
    month = "case " + " ".join(f"when starts_with(lower(p_m), '{m}') then {i + 1}" for i, m in enumerate(MONTHS)) + " else try_cast(p_m as int) end"
    minutes = "case lower(p_z) " + " ".join(f"when '{z}' then {m}" for z, m in ZONE_MINUTES.items()) + " end"
    return f"""with z as (select worker_id, min(tz_name) as tz_name from worker_zone group by 1), {values},
        p as (select * from ({" union all ".join(parts)}) qualify row_number() over (partition by t, i, f, x, tz, stop order by form) = 1),
        c as (select *, try_cast(p_y as int) as y, case when p_m = '' then 1 else {month} end as mo, case when p_d = '' then 1 else try_cast(p_d as int) end as d,
          case when p_p <> '' then case when try_cast(p_h as int) between 1 and 12 then try_cast(p_h as int) % 12 + case when lower(p_p) = 'p' then 12 else 0 end end
            when p_h = '' then case when cap then 0 end else try_cast(p_h as int) end as h,
          case when p_n = '' then 0 else try_cast(p_n as int) end as n, case when p_s = '' then 0 else try_cast(p_s as int) end as s,
          case when p_f = '' then 0 else try_cast(rpad(substr(p_f, 1, 6), 6, '0') as int) end as us from p),
        w as (select *, case when h between 0 and 23 and n <= 59 and s <= 59 then try_cast(format('{{:04d}}-{{:02d}}-{{:02d}} {{:02d}}:{{:02d}}:{{:02d}}.{{:06d}}', y, mo, d, h, n, s, us) as timestamp) end as wall,
          case when regexp_matches(p_z, '^[+-]') then case when p_z[1] = '-' then -1 else 1 end * (p_z[2:3]::int * 60 + coalesce(nullif(replace(p_z, ':', '')[4:5], '')::int, 0)) else {minutes} end as shift,
          case when p_i <> '' then p_i else tz end as place from c),
        b as (select *, case when p_z = '' and place is not null then wall at time zone place end as one from w where direct is null),
        e as (select *, (one - interval 1 hour) as early, (one + interval 1 hour) as late from b),
        r as (select *, case when (early at time zone place) = wall then early else one end as first, case when (late at time zone place) = wall then late else one end as second from e),
        o as (select t, i, f, direct::bigint as utc_us from p where direct is not null
          union all select t, i, f, epoch_us(wall) - shift::bigint * 60000000 from w where direct is null and p_z <> '' and wall is not null and shift is not null
          union all select t, i, f, epoch_us(case when stop - second >= interval 0 minute and stop - second <= interval 15 minute and not (stop - first >= interval 0 minute and stop - first <= interval 15 minute) then second else first end)
            from r where wall is not null and (one at time zone place) = wall)
        select distinct t as rec_table, i as rec_key, f as field_name, utc_us from o where utc_us is not null"""


SQL = {
    "p5_found": _instants_sql(),
    "p7_found": f"""
        with c as ({_CAPTURES})
        select domain from c where domain is not null group by domain
        having sum(row_count) * 100 >= (select sum(row_count) from c)""",
    "p7_quantiles": f"""
        with c as ({_CAPTURES}),
        r as (select domain, row_count, row_number() over (partition by domain order by row_count) as rn,
              count(row_count) over (partition by domain) as n from c where row_count is not null),
        t as (select domain, count(row_count) as n, sum(row_count)::bigint as total from c group by domain)
        select t.domain, t.n, t.total,
          (select max(row_count) from r where r.domain is not distinct from t.domain and rn = greatest(1, ceil(r.n * 0.5))) as median,
          (select max(row_count) from r where r.domain is not distinct from t.domain and rn = greatest(1, ceil(r.n * 0.9::double))) as p90
        from t""",
}
