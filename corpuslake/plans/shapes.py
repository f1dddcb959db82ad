"""Queries that write a table in some shape and read it back: index lines, JSON
in its forms, CSV, XML, HTML, archive members, file lists and all sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import url as U
from ..session import shared_path
from ..sources import readers, sinks
from ..tables import table


def _urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "url_cid_latest").where("url is not null and last_finished_at is not null")


def batched_scan(spark, d):
    """Rows of each language counted in Arrow batches, then added up."""

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            for x in pc.value_counts(b.column(0)).to_pylist():
                yield pa.RecordBatch.from_pylist([{"lang": x["values"], "n": x["counts"]}], schema=pa.schema([("lang", pa.string()), ("n", pa.int64())]))

    t = table(spark, d, "documents").select("lang").mapInArrow(count, "lang string, n long")
    return t.groupBy("lang").agg(F.sum("n").alias("n"))


def footer_groups(spark, d):
    """Row groups and rows of the index by the Parquet footers alone, with the
    files whose first column's row groups overlap. No row is read."""
    path = os.path.join(d, "domain_index.parquet")
    return readers.row_groups(spark, path, "row_count").agg(F.countDistinct("path").cast("long").alias("files"), F.sum("rows").alias("rows"))


def cdx_detect(spark, d):
    """Index lines in three forms among comments and blank lines."""
    t = _urls(spark, d)
    ts = F.date_format("last_finished_at", "yyyyMMddHHmmss")
    key = U.host_rev(U.host(F.col("url")))
    forms = [
        F.to_json(F.struct("url", ts.alias("timestamp"))), F.concat_ws(" ", key, ts, F.to_json(F.struct("url"))), F.concat_ws(" ", key, ts, F.col("url"), F.lit("text/html 200 - - 0 1 x.warc.gz")),
    ]
    kind = F.pmod(F.length("url"), F.lit(3))
    line = F.when(kind == 0, forms[0]).when(kind == 1, forms[1]).otherwise(forms[2])
    noise = t.select(F.explode(F.array(F.lit("# CDX N b a m s k r M S V g"), F.lit("   "))).alias("line"))
    path = shared_path(spark, "cdx")
    sinks.text(t.select(line.alias("line")).unionByName(noise), path, "gzip")
    return readers.parse_cdx_any(spark.read.text(path), F.col("value")).select("url", "ts")


def json_shapes(spark, d):
    """Records out of files that hold a list, an object, an object with parts,
    or one object a line; lines that are none are dropped."""
    t = table(spark, d, "candidate_row").select("candidate_id", F.to_json(F.struct("candidate_id", "state")).alias("j"))
    group = t.withColumn("g", F.floor(F.col("candidate_id") / 25))
    g = group.groupBy("g").agg(F.array_join(F.collect_list("j"), ",").alias("l"), F.array_join(F.collect_list("j"), "\n").alias("n"))  # 25 rows each
    form = F.when(F.col("g") % 3 == 0, F.concat(F.lit("[\n"), "l", F.lit("\n]"))).when(F.col("g") % 3 == 1, F.concat(F.lit('{"@id":"x",\n"hasPart":['), "l", F.lit("\n]}"))).otherwise(F.concat("n", F.lit("\nnot json\n[1]\n")))
    path = shared_path(spark, "shapes")
    g.select(form.alias("value"), "g").write.partitionBy("g").option("lineSep", "\n").text(path)
    got = readers.json_records(spark, path).select(F.from_json("record", "candidate_id long, state string").alias("r"))
    return got.select("r.candidate_id", "r.state").where("candidate_id is not null")


def csv_roundtrip(spark, d):
    """Places as CSV with quoted commas and line ends, read back with numbers
    that are 0 where they can't be read."""
    t = table(spark, d, "supplier").select(
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(" x ")).otherwise(F.col("s_suppkey").cast("string")).alias("gnis"), F.concat("s_name", F.lit(', "the" town')).alias("place_name"),
        F.lit(" OR ").alias("state_code"), F.concat(F.lit("https://a.example/"), "s_suppkey", F.lit(",https://b.example/")).alias("source_url"), F.lit("ok").alias("status"),
    )
    path = shared_path(spark, "towns")
    sinks.csv(t, path)
    return readers.towns_csv(spark, path)


def xml_entities(spark, d):
    """First of several paths of an XML record that gives any text."""
    s = table(spark, d, "supplier")
    name = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("<Name>"), "s_name", F.lit("</Name>"))).otherwise(F.concat(F.lit("<Title><Text> "), "s_name", F.lit(" </Text></Title>")))
    xml = F.concat(F.lit("<Entity><Id>"), "s_suppkey", F.lit("</Id><Name2/>"), name, F.lit("</Entity>"))
    return s.select("s_suppkey", readers.xml_first(xml, "/Entity/Name2", "/Entity/Name", "/Entity/Title/Text").alias("name"))


def html_lines_query(spark, d):
    """Visible lines of pages made of the documents, scripts left out."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    page = F.concat(F.lit("<html><head><style>p {x: y}</style></head><body><p>"), F.regexp_replace(safe, "\n", "</p>\n<p>"), F.lit("</p><script>var x = '<p>no</p>';</script></body></html>"))
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(readers.html_lines(page)).alias("line"))
    return t.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length(F.regexp_replace("line", " ", ""))).alias("chars"))


def warc_bodies(spark, d):
    """HTTP bodies of archive members, packed and plain, and whether they look
    like pages. What is no member gives none."""
    head = "WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    t = table(spark, d, "documents").where("text is not null")
    raw = F.when(F.col("doc_id") % 10 == 0, F.encode(F.lit("no member"), "UTF-8")).otherwise(F.encode(F.concat(F.lit(head + "<HTML>"), "text"), "UTF-8"))
    raw = F.when(F.col("doc_id") % 2 == 0, readers.deflate(raw)).otherwise(raw)
    body = readers.warc_body(raw)
    return t.select("doc_id", body.alias("b")).select("doc_id", F.length("b").alias("bytes"), F.coalesce(readers.looks_like_html(F.col("b")), F.lit(False)).alias("page"))


def inflate_query(spark, d):
    """Packed bytes unpacked by their header; others stay."""
    t = table(spark, d, "documents").where("text is not null")
    raw = F.encode("text", "UTF-8")
    return t.select("doc_id", F.length(readers.inflate(F.when(F.col("doc_id") % 2 == 0, readers.deflate(raw)).otherwise(raw))).alias("bytes"))


def chapter_links(spark, d):
    """Links of an index page that lead to chapters: absolute, distinct, in
    order of their number."""
    t = table(spark, d, "documents").where("official_cite is not null").select(F.regexp_extract("official_cite", r"(\d+)", 1).alias("c")).distinct()
    page = F.concat(F.lit('<a href="/ch/'), "c", F.lit('.html">x</a> <a href="../ch/'), "c", F.lit('.html#top">y</a><a href="/other">z</a>'))
    links = t.select(F.explode(readers.html_links(page, F.lit("https://laws.example/a/b/index.html"))).alias("l")).select(U.without_query(F.col("l.url")).alias("url"))
    return links.where(F.col("url").rlike(r"/ch/\d+\.html$") & F.col("url").startswith("https://laws.example/ch/")).select("url", F.regexp_extract("url", r"/ch/(\d+)\.html$", 1).cast("int").alias("chapter")).distinct()


def file_columns(spark, d):
    """Rows of each collection and state by the paths of their files."""
    path = shared_path(spark, "tree")
    t = table(spark, d, "candidate_row").where("state is not null").select(F.upper(F.trim("state")).alias("state"), F.concat(F.lit("run_"), F.pmod("candidate_id", F.lit(3))).alias("run"), "candidate_id")
    t.write.partitionBy("run", "state").parquet(path)
    back = spark.read.option("recursiveFileLookup", "true").parquet(path).select(F.col("_metadata.file_path").alias("p"))
    return back.groupBy(F.regexp_extract("p", r"/(?:run=)([^/]+)/", 1).alias("run"), F.regexp_extract("p", r"state=([A-Z]{2})/", 1).alias("state")).agg(F.count("*").alias("rows"))


def corrupt_files(spark, d):
    """Rows that can be read of a folder in which one file is cut off."""
    path = shared_path(spark, "corrupt")
    table(spark, d, "nation").coalesce(1).write.parquet(path)
    sinks.bytes_file(spark, os.path.join(path, "broken.parquet"), b"PAR1 cut off")
    return spark.read.option("ignoreCorruptFiles", "true").schema("n_nationkey long, n_name string").parquet(path).select("n_name")


# ---- sinks ----------------------------------------------------------------
def sink_parquet(spark, d):
    """Sorted and compressed Parquet: rows and keys after reading back."""
    path = shared_path(spark, "sink")
    sinks.parquet(table(spark, d, "orders").select("o_orderkey", "o_custkey"), path, sort=["o_custkey"], rows=1000)
    return spark.read.parquet(path).groupBy("o_custkey").agg(F.count("*").alias("orders"))


def sink_row_groups(spark, d):
    """Rows after writing with small row groups; none is lost at their ends."""
    path = shared_path(spark, "groups")
    sinks.parquet(table(spark, d, "orders").select("o_orderkey"), path, codec="snappy", group_bytes=64 * 1024)
    return readers.row_groups(spark, path, "o_orderkey").agg(F.sum("rows").alias("rows"))


def sink_by_key(spark, d):
    """One folder for each state beside the combined table, read by folder."""
    path = shared_path(spark, "bykey")
    t = table(spark, d, "candidate_row").where("state is not null").select(F.upper(F.trim("state")).alias("state_code"), "candidate_id")
    sinks.by_key(t, path, "state_code")
    return spark.read.parquet(path).where("state_code in ('ME', 'KS')").select("state_code", "candidate_id")


def sink_jsonl(spark, d):
    """JSON lines written twice, the second time appended."""
    path = shared_path(spark, "jsonl")
    t = table(spark, d, "nation").select("n_nationkey", "n_name")
    sinks.jsonl(t, path)
    sinks.jsonl(t, path)
    return readers.jsonl(spark, path, "n_nationkey long, n_name string")


def sink_manifest(spark, d):
    """A manifest replaced in one step, read back as key and value."""
    n = table(spark, d, "region").count()
    path = shared_path(spark, "manifest") + ".json"
    sinks.manifest(spark, {"rows": -1}, path)
    sinks.manifest(spark, {"rows": n, "name": "region"}, path)
    got = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return got.select(F.explode("m").alias("key", "value"))


def graph_json(spark, d):
    """Citation edges as JSON with sorted keys, read back."""
    from .corpus import kg_edges

    path = shared_path(spark, "graph")
    sinks.graph(kg_edges(spark, d), path)
    return spark.read.schema("edge_type string, source_id string, target_id string").json(path)


def sink_csv(spark, d):
    path = shared_path(spark, "csv")
    t = table(spark, d, "region").select("r_regionkey", "r_name")
    sinks.csv(t, path)
    return spark.read.option("header", "true").schema("r_regionkey long, r_name string").csv(path)


_QUERIES = (
    batched_scan, footer_groups, cdx_detect, json_shapes, csv_roundtrip, xml_entities, warc_bodies, chapter_links, file_columns, corrupt_files,
    sink_parquet, sink_row_groups, sink_by_key, sink_jsonl, sink_manifest, graph_json, sink_csv,
)
QUERIES = {**{f.__name__: f for f in _QUERIES}, "html_lines": html_lines_query, "inflate": inflate_query}

_REF = "section \\d+-\\d+-\\d+"
SQL = {
    "batched_scan": "select lang, count(*) as n from documents group by 1",
    "footer_groups": None,
    "cdx_detect": "select url, strftime(last_finished_at at time zone 'UTC', '%Y%m%d%H%M%S') as ts from url_cid_latest where url is not null and last_finished_at is not null",
    "json_shapes": "select candidate_id, state from candidate_row",
    "csv_roundtrip": """select case when s_suppkey % 5 = 0 then 0 else s_suppkey end::bigint as gnis, s_name || ', "the" town' as place_name, 'OR' as state_code,
        'https://a.example/' || s_suppkey || ',https://b.example/' as source_url, 'ok' as status from supplier""",
    "xml_entities": "select s_suppkey, s_name as name from supplier",
    "html_lines": """with l as (select doc_id, unnest(string_split(text, chr(10))) as raw from documents where text is not null),
        k as (select doc_id, regexp_replace(raw, '[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+', '', 'g') as x from l)
        select doc_id, count(*) as lines, sum(length(x))::bigint as chars from k where x <> '' group by 1""",
    "warc_bodies": "select doc_id, case when doc_id % 10 <> 0 then strlen(text) + 6 end::int as bytes, doc_id % 10 <> 0 as page from documents where text is not null",
    "inflate": "select doc_id, strlen(text)::int as bytes from documents where text is not null",
    "chapter_links": """select distinct 'https://laws.example/ch/' || regexp_extract(official_cite, '(\\d+)', 1) || '.html' as url, regexp_extract(official_cite, '(\\d+)', 1)::int as chapter
        from documents where official_cite is not null and regexp_extract(official_cite, '(\\d+)', 1) <> ''""",
    "file_columns": "select 'run_' || (candidate_id % 3) as run, upper(trim(state)) as state, count(*) as rows from candidate_row where state is not null group by all",
    "corrupt_files": "select n_name from nation",
    "sink_parquet": "select o_custkey, count(*) as orders from orders group by 1",
    "sink_row_groups": "select count(*) as rows from orders",
    "sink_by_key": "select upper(trim(state)) as state_code, candidate_id from candidate_row where upper(trim(state)) in ('ME', 'KS')",
    "sink_jsonl": "select n_nationkey, n_name from nation union all select n_nationkey, n_name from nation",
    "sink_manifest": "select 'rows' as key, count(*)::varchar as value from region union all select 'name', 'region'",
    "graph_json": f"""select distinct 'doc:' || doc_id as source_id, 'ref:' || substr(unnest(regexp_extract_all(text, '{_REF}')), 9) as target_id, 'cites' as edge_type from documents where text is not null
        union select 'doc:' || doc_id, 'state:' || upper(state_code), 'in_state' from documents where text is not null and state_code is not null""",
    "sink_csv": "select r_regionkey, r_name from region",
}
SQL["footer_groups"] = "select 1::bigint as files, count(*) as rows from domain_index"
