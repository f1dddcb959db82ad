"""Streaming queries over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import seconds_left
from ..session import shared_path
from ..streaming.folds import file_stream, fold_latest, to_table, windowed_counts
from ..tables import table


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    s = file_stream(spark, d, schema, "events.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_latest(spark, d):
    """Last event and number of events of each user, folded from a stream."""
    return fold_latest(_events(spark, d), "user_id", F.struct("ts", "event_id"), ["event_id", "event_type"])


def stream_incremental(spark, d):
    """The same over a folder that grows: three runs with one ledger, each of
    which reads only the files that came since the run before."""
    place, source = shared_path(spark, "incremental"), shared_path(spark, "arriving")
    e = table(spark, d, "events")
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for run in range(3):
        e.where(third == run).write.mode("append").parquet(source)
        got = fold_latest(file_stream(spark, source, e.schema, "*.parquet"), "user_id", F.struct("ts", "event_id"), ["event_id", "event_type"], place)
    return got


def retry_countdown(spark, d):
    """Reports of each user's pending retry until nothing is left, at most 20:
    seconds left at each and how long to sleep until the next (a day at most)."""
    now, day = F.lit("2024-01-30 12:00:00").cast("timestamp"), 86_400
    t = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("last"))
    t = t.select("user_id", F.floor(seconds_left(F.col("last") + F.expr("interval 12 days"), now)).alias("left"))
    t = t.select("user_id", "left", F.explode(F.sequence(F.lit(0), F.least(F.lit(19), F.ceil(F.col("left") / day)).cast("int"))).alias("report"))
    now_left = F.greatest(F.lit(0), F.col("left") - F.col("report") * day)
    return t.select("user_id", "report", now_left.alias("seconds_left"), F.least(now_left, F.lit(day)).alias("sleep"))


def stream_windowed(spark, d):
    """Events of each type in each six hours."""
    t = to_table(windowed_counts(_events(spark, d), "ts", "event_type", F.window("ts", "6 hours")), "complete")
    return t.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sliding(spark, d):
    """Events of each type in each day, begun every twelve hours."""
    t = to_table(windowed_counts(_events(spark, d), "ts", "event_type", F.window("ts", "24 hours", "12 hours")), "complete")
    return t.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n")


def stream_sessions(spark, d):
    """Sessions of each user: no more than two hours between events."""
    s = _events(spark, d).withWatermark("ts", "1 hour").groupBy(F.session_window("ts", "2 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
    t = to_table(s.select("w", "user_id", "n"), "complete")
    return t.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


QUERIES = {f.__name__: f for f in (stream_latest, stream_incremental, retry_countdown, stream_windowed, stream_sliding, stream_sessions)}
_LAST = "select user_id, first(event_id order by ts desc, event_id desc) as event_id, first(event_type order by ts desc, event_id desc) as event_type, count(*) as n from events group by 1"
SQL = {
    "stream_incremental": _LAST,
    "retry_countdown": """with t as (select user_id, greatest(0, floor((epoch_us(max(ts)::timestamp + interval 12 day) - epoch_us(timestamp '2024-01-30 12:00:00')) / 1e6))::bigint as l from events group by 1),
        r as (select user_id, l, unnest(range(0, least(19, ceil(l / 86400.0))::int + 1)) as report from t)
        select user_id, report::int as report, greatest(0, l - report * 86400) as seconds_left, least(greatest(0, l - report * 86400), 86400) as sleep from r""",
    "stream_latest": _LAST,
    "stream_windowed": "select epoch_us(ts) // 21600000000 * 21600000000 as start_us, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "stream_sliding": "select (epoch_us(ts) // 43200000000 - k) * 43200000000 as start_us, event_type, count(*) as n from events, range(2) r(k) group by 1, 2",
    "stream_sessions": """with l as (select user_id, ts, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts) < 7200000000 then 0 else 1 end as f from events),
        s as (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) as i from l) select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, i""",
}
