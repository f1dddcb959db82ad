"""Queries of the capture-index workload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import url as U
from ..operators.keyed import inversions, numbered, priority_union, runs
from ..sources.readers import parse_cdxj
from ..tables import table


def _urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "url_cid_latest").select("url", "last_status_code", "last_content_bytes", "attempts", "last_content_cid").withColumn(
        "host_rev", U.host_rev(U.host(F.col("url")))
    )


def scan_project_filter(spark, d):
    return table(spark, d, "documents").where("n_chars > 500 and lang = 'en'").select("doc_id", "n_chars")


def cdxj_parse(spark, d):
    """Index lines made of the URL table, read back as the index reader does."""
    t = table(spark, d, "url_cid_latest").where("last_finished_at is not null")
    js = F.to_json(F.struct("url", F.col("last_content_type").alias("mime"), F.col("last_status_code").cast("string").alias("status"), F.col("last_content_bytes").cast("string").alias("length")))
    line = F.concat_ws(" ", U.host_rev(U.host(F.col("url"))), F.date_format("last_finished_at", "yyyyMMddHHmmss"), js)
    broken = t.select(F.concat(F.lit("broken "), F.col("url")).alias("line"))
    return parse_cdxj(t.select(line.alias("line")).unionByName(broken), "line").select("ts", "url", "mime", "status", "length")


def url_parts(spark, d):
    u = F.col("url")
    cols = {"domain": U.domain(u), "plain": U.plain_domain(u), "origin": U.origin(u), "bare": U.without_query(u), "seed": U.seed(u),
            "site": U.registrable(U.host(u)), "safe": U.path_safe(u), "slug": U.slug(u)}
    return table(spark, d, "url_cid_latest").select("url", *[c.alias(n) for n, c in cols.items()])


_HOST = "regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', ''), '^.*@', ''), ':\\d*$', '')"
_REV = f"array_to_string(list_reverse(list_filter(string_split({_HOST}, '.'), lambda x: x <> '')), ',')"
_URLS = f"select url, last_status_code, last_content_bytes, attempts, last_content_cid, {_REV} as host_rev from url_cid_latest"


def host_rev(spark, d):
    return _urls(spark, d).select("url", "host_rev")


def domain_prefix_search(spark, d):
    """All URLs of a domain and its subdomains."""
    return _urls(spark, d).where(U.within(F.col("host_rev"), "corthwick.example") | U.within(F.col("host_rev"), "gov.example")).select("url").distinct()


def url_substring_search(spark, d):
    return table(spark, d, "url_cid_latest").where(F.col("url").contains("permit") & F.col("url").startswith("https://")).select("url")


def domain_pointers(spark, d):
    """Runs of one host in the sorted table: first row, rows, least and
    greatest URL. The sort is range-partitioned, runs are totals by host."""
    rows = numbered(_urls(spark, d), ["host_rev", "url"], "row_no")
    return rows.groupBy("host_rev").agg(F.min("row_no").alias("row_offset"), F.count("*").alias("row_count"), F.min("url").alias("first_url"), F.max("url").alias("last_url"))


def pointer_lookup(spark, d):
    """The rows of the busiest host, by its pointer's row range."""
    rows = numbered(_urls(spark, d), ["host_rev", "url"], "row_no")
    pointers = rows.groupBy("host_rev").agg(F.min("row_no").alias("o"), F.count("*").alias("n"))
    busiest = pointers.orderBy(F.desc("n"), "host_rev").limit(1)  # one row
    return rows.join(F.broadcast(busiest.select("o", "n")), (F.col("row_no") >= F.col("o")) & (F.col("row_no") < F.col("o") + F.col("n"))).select("url", "row_no")


def file_runs(spark, d):
    """Runs of one domain in each index file."""
    return runs(table(spark, d, "domain_index").distinct(), "domain", "row_offset", ["parquet_file"])


def sortedness_check(spark, d):
    t = table(spark, d, "domain_index").distinct()
    return inversions(t, F.col("domain"), "row_offset", ["parquet_file"])


def list_domains_topk(spark, d):
    t = table(spark, d, "domain_index").where("domain is not null").groupBy("domain").agg(F.sum("row_count").alias("captures"), F.count("*").alias("pointers"))
    return t.orderBy(F.desc("captures"), "domain").limit(20)


def index_stats(spark, d):
    return table(spark, d, "domain_index").agg(
        F.countDistinct("domain").alias("domains"), F.count("*").alias("pointers"), F.countDistinct("parquet_file").alias("files"), F.sum("row_count").alias("captures")
    )


def collection_stats(spark, d):
    return table(spark, d, "domain_index").groupBy("cc_collection").agg(F.countDistinct("domain").alias("domains"), F.sum("row_count").alias("captures"))


def domains_global(spark, d):
    per = table(spark, d, "domain_index").where("domain is not null").groupBy("domain", "cc_collection").agg(F.sum("row_count").alias("n"))
    return per.groupBy("domain").agg(F.count("cc_collection").alias("collections"), F.sum("n").alias("captures"))


def collection_year_filter(spark, d):
    """Latest crawl of each domain, newest year first, by the crawl id."""
    t = table(spark, d, "domain_index").where("domain is not null").withColumn("year", U.crawl_year(F.col("cc_collection"))).where("year between 2018 and 2022")
    return t.groupBy("domain").agg(F.max("year").alias("newest"), F.countDistinct("cc_collection").alias("crawls"))


def shard_names(spark, d):
    return spark.range(300).select(F.format_string("cdx-%05d.gz", "id").alias("shard_file"))


def incremental_unprocessed(spark, d):
    """Index files that the ledger of processed ones lacks. The ledger knows
    the crawls before 2023."""
    t = table(spark, d, "domain_index").where("parquet_file is not null")
    done = t.where("crawl_year < 2023").select("parquet_file")
    return t.select("parquet_file").distinct().join(done, "parquet_file", "left_anti")


def prefer_sorted_variant(spark, d):
    """Of the variants of a file (sorted or not) the sorted one."""
    f = table(spark, d, "domain_index").select("parquet_file").distinct()
    odd = f.where(F.length("parquet_file") % 2 == 0).select(F.regexp_replace("parquet_file", r"\.parquet$", ".sorted.parquet").alias("parquet_file"))
    every = f.unionByName(odd).withColumn("base", F.regexp_replace("parquet_file", r"(\.sorted)?\.parquet$", ""))
    return every.groupBy("base").agg(F.max_by("parquet_file", F.struct(F.col("parquet_file").contains(".sorted."), F.col("parquet_file"))).alias("chosen"))


def source_priority(spark, d):
    """Contents of an URL from the first source that has any: the latest
    state, else the attempts, else the fetches."""
    latest = table(spark, d, "url_cid_latest").where("last_content_cid is not null").select("url", F.col("last_content_bytes").alias("bytes"))
    tries = table(spark, d, "scrape_attempts").where("content_cid is not null and url is not null").groupBy("url").agg(F.max("content_bytes").alias("bytes"))
    fetched = table(spark, d, "fetch_result").where("url is not null").groupBy("url").agg(F.max("content_bytes").alias("bytes"))
    return priority_union([latest, tries, fetched], "url").select("url", "bytes", "tier")


def url_resolve_topn(spark, d):
    """At most three captures of each URL, best status, then latest id."""
    from pyspark.sql import Window

    t = table(spark, d, "fetch_result").where("url is not null").select("fetch_id", "url", "status_code").distinct()
    score = F.when(F.col("status_code") == 200, 2).when(F.col("status_code").between(300, 399), 1).otherwise(0)
    w = Window.partitionBy("url").orderBy(score.desc(), F.desc("fetch_id"))
    return t.withColumn("place", F.row_number().over(w)).where("place <= 3").select("url", "fetch_id", "place")


def shard_assign(spark, d):
    return table(spark, d, "url_cid_latest").select("url", U.shard(F.col("url"), 7).alias("shard"))


def split_urls(spark, d):
    t = table(spark, d, "fetch_result").select("fetch_id", F.concat_ws(", ", "url", "archive_url").alias("t")).distinct()
    return t.select("fetch_id", F.explode(U.find_urls(F.col("t"))).alias("found")).distinct()


def bfs_hops(spark, d, hops: int = 2):
    """Documents and citations within some steps of the most cited section,
    over the citation links both ways. Each step joins only the frontier and
    drops what was reached."""
    from ..session import write_shared
    from .corpus import kg_edges

    e = kg_edges(spark, d).where("edge_type = 'cites'").select(F.col("source_id").alias("u"), F.col("target_id").alias("v"))
    start = e.groupBy("v").count().orderBy(F.desc("count"), "v").limit(1).select(F.col("v").alias("node_id"), F.lit(0).alias("hop"))
    links = write_shared(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), "bfs-links")
    seen = write_shared(start, "bfs")
    front = seen
    for hop in range(1, hops + 1):
        nxt = links.join(front.select(F.col("node_id").alias("u")), "u").select(F.col("v").alias("node_id")).distinct().join(seen, "node_id", "left_anti")
        front = write_shared(nxt.withColumn("hop", F.lit(hop)), "bfs")
        seen = seen.unionByName(front)
    return seen


QUERIES = {
    f.__name__: f
    for f in (
        scan_project_filter, cdxj_parse, url_parts, host_rev, domain_prefix_search, url_substring_search, domain_pointers, pointer_lookup, file_runs,
        sortedness_check, list_domains_topk, index_stats, collection_stats, domains_global, collection_year_filter, shard_names, incremental_unprocessed,
        prefer_sorted_variant, source_priority, url_resolve_topn, shard_assign, split_urls, bfs_hops,
    )
}

SQL = {
    "scan_project_filter": "select doc_id, n_chars from documents where n_chars > 500 and lang = 'en'",
    "cdxj_parse": "select strftime(last_finished_at at time zone 'UTC', '%Y%m%d%H%M%S') as ts, url, last_content_type as mime, last_status_code as status, last_content_bytes as length from url_cid_latest where last_finished_at is not null and url is not null",
    "host_rev": f"select url, {_REV} as host_rev from url_cid_latest",
    "domain_prefix_search": f"select distinct url from ({_URLS}) where host_rev = 'example,corthwick' or starts_with(host_rev, 'example,corthwick,') or host_rev = 'example,gov' or starts_with(host_rev, 'example,gov,')",
    "url_substring_search": "select url from url_cid_latest where contains(url, 'permit') and starts_with(url, 'https://')",
    "url_parts": f"""select url, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)), '^www\\.', '') as domain,
        regexp_extract(url, 'https?://([^/:]+)', 1) as plain,
        case when regexp_extract(lower(url), '^(https?://[^/?#]+)', 1) = '' then '' else regexp_extract(lower(url), '^(https?://[^/?#]+)', 1) || '/' end as origin,
        regexp_replace(url, '[?#].*$', '') as bare,
        regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^:/])/{{2,}}', '\\1/', 'g'), '/+$', '') as seed,
        array_to_string(list_slice(string_split({_HOST}, '.'), -(case when ends_with({_HOST}, '.us') then 3 else 2 end), -1), '.') as site,
        regexp_replace(url, '[^a-zA-Z0-9._-]', '_', 'g') as safe,
        regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from url_cid_latest""",
    "domain_pointers": f"""with r as (select *, row_number() over (order by host_rev nulls last, url) - 1 as row_no from ({_URLS}))
        select host_rev, min(row_no) as row_offset, count(*) as row_count, min(url) as first_url, max(url) as last_url from r group by host_rev""",
    "pointer_lookup": f"""with r as (select *, row_number() over (order by host_rev nulls last, url) - 1 as row_no from ({_URLS})),
        p as (select host_rev, min(row_no) as o, count(*) as n from r group by 1 order by n desc, host_rev limit 1)
        select url, row_no from r, p where row_no >= o and row_no < o + n""",
    "file_runs": """with t as (select distinct * from domain_index),
        f as (select *, case when lag(domain) over w is not distinct from domain and lag(row_offset) over w is not null then 0 else 1 end as f from t window w as (partition by parquet_file order by row_offset)),
        i as (select *, sum(f) over (partition by parquet_file order by row_offset rows unbounded preceding) as isl from f)
        select parquet_file, domain, min(row_offset) as start, count(*) as length from i group by parquet_file, domain, isl""",
    "sortedness_check": """with t as (select parquet_file, domain, lag(domain) over (partition by parquet_file order by row_offset) as b from (select distinct * from domain_index))
        select parquet_file, count(*) as rows, count_if(b > domain) as inversions from t group by parquet_file""",
    "list_domains_topk": "select domain, sum(row_count)::bigint as captures, count(*) as pointers from domain_index where domain is not null group by 1 order by 2 desc, 1 limit 20",
    "index_stats": "select count(distinct domain) as domains, count(*) as pointers, count(distinct parquet_file) as files, sum(row_count)::bigint as captures from domain_index",
    "collection_stats": "select cc_collection, count(distinct domain) as domains, sum(row_count)::bigint as captures from domain_index group by 1",
    "domains_global": "select domain, count(distinct cc_collection) as collections, sum(row_count)::bigint as captures from domain_index where domain is not null group by 1",
    "collection_year_filter": "with t as (select *, try_cast(string_split(cc_collection, '-')[3] as int) as year from domain_index where domain is not null) select domain, max(year) as newest, count(distinct cc_collection) as crawls from t where year between 2018 and 2022 group by 1",
    "shard_names": "select format('cdx-{:05d}.gz', i) as shard_file from range(300) t(i)",
    "incremental_unprocessed": "select distinct parquet_file from domain_index t where parquet_file is not null and not exists (select 1 from domain_index u where u.parquet_file = t.parquet_file and u.crawl_year < 2023)",
    "prefer_sorted_variant": """with f as (select distinct parquet_file from domain_index),
        e as (select parquet_file from f union all select regexp_replace(parquet_file, '\\.parquet$', '.sorted.parquet') from f where length(parquet_file) % 2 = 0)
        select regexp_replace(parquet_file, '(\\.sorted)?\\.parquet$', '') as base, coalesce(max(parquet_file) filter (where contains(parquet_file, '.sorted.')), max(parquet_file)) as chosen from e group by 1""",
    "source_priority": """with e as (select url, last_content_bytes as bytes, 0 as tier from url_cid_latest where last_content_cid is not null
        union all select url, max(content_bytes), 1 from scrape_attempts where content_cid is not null and url is not null group by url
        union all select url, max(content_bytes), 2 from fetch_result where url is not null group by url)
        select * from e where tier = (select min(tier) from e x where x.url = e.url)""",
    "url_resolve_topn": """with t as (select distinct fetch_id, url, status_code from fetch_result where url is not null),
        r as (select url, fetch_id, row_number() over (partition by url order by case when status_code = 200 then 2 when status_code between 300 and 399 then 1 else 0 end desc, fetch_id desc) as place from t)
        select * from r where place <= 3""",
    "shard_assign": "select url, (('0x' || substr(sha256(url), 1, 16))::ubigint % 7)::int as shard from url_cid_latest",
    "split_urls": "with t as (select distinct fetch_id, concat_ws(', ', url, archive_url) as t from fetch_result) select distinct fetch_id, unnest(regexp_extract_all(t, 'https?://[^\\s,;]+')) as found from t",
    "bfs_hops": """with recursive e as (select distinct 'doc:' || doc_id as u, 'ref:' || substr(unnest(regexp_extract_all(text, 'section \\d+-\\d+-\\d+')), 9) as v from documents where text is not null),
        l as (select u, v from e union select v, u from e),
        b as (select v as node_id, 0 as hop from (select v from e group by 1 order by count(*) desc, v limit 1) union select l.v, b.hop + 1 from b join l on l.u = b.node_id where b.hop < 2)
        select node_id, min(hop) as hop from b group by 1""",
}
