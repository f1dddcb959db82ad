"""Readers for capture indexes, JSON in its several shapes, CSV, XML, HTML and
archive members. All return DataFrames and leave rows where they are."""

from __future__ import annotations

import gzip
import zlib
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_CDX = "url string, mime string, `mime-detected` string, status string, digest string, length string, offset string, filename string"


def cdxj_columns(line: Column) -> dict[str, Column]:
    """Columns of a `surt timestamp {json}` line; null where it is malformed."""
    part = F.split(line, " ", 3)
    j = F.from_json(F.try_element_at(part, F.lit(3)), _CDX)
    return {
        "surt": F.try_element_at(part, F.lit(1)), "ts": F.try_element_at(part, F.lit(2)), "url": j["url"], "mime": j["mime"],
        "mime_detected": j["mime-detected"], "status": j["status"].try_cast("int"), "digest": j["digest"],
        "length": j["length"].try_cast("long"), "offset": j["offset"].try_cast("long"), "filename": j["filename"],
    }


def parse_cdxj(lines: DataFrame, line: str) -> DataFrame:
    """Strict CDXJ: lines without a JSON object with an url are dropped."""
    return lines.select(*[c.alias(n) for n, c in cdxj_columns(F.col(line)).items()]).where("url is not null")


def parse_cdx_any(lines: DataFrame, line: str) -> DataFrame:
    """url, ts of JSON lines, CDXJ lines and blank-separated CDX lines (URL in
    the third place); blank and # lines are skipped."""
    x = F.trim(line)
    parts = F.split(x, r"\s+")
    whole = F.when(x.startswith("{"), F.from_json(x, "url string, timestamp string"))
    cdxj = F.from_json(F.regexp_extract(x, r"^\S+ \S+ (\{.*)$", 1), "url string")
    url = F.when(x.startswith("{"), whole["url"]).when(x.rlike(r"^\S+ \S+ \{"), cdxj["url"]).otherwise(F.try_element_at(parts, F.lit(3)))
    ts = F.when(x.startswith("{"), whole["timestamp"]).otherwise(F.try_element_at(parts, F.lit(2)))
    return lines.where((x != "") & ~x.startswith("#")).select(url.alias("url"), ts.alias("ts")).where("url is not null")


def cdx(spark: SparkSession, path: str) -> DataFrame:
    """CDXJ text files (gzip too) with their collection and year by path."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    cols = cdxj_columns(F.col("value"))
    collection = F.regexp_extract("file_path", r"(CC-MAIN-\d{4}-\d+)", 1)
    return lines.select(*[c.alias(n) for n, c in cols.items()], "file_path", collection.alias("collection")).where("url is not null")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with an explicit schema; lines that are no object are dropped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("j"), "value").where(F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{")).select("j.*")


#: Files up to so many bytes may be read whole as one JSON value.
WHOLE = 64 << 20


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """file_path, record (JSON text) of files that hold a list, an object, an
    object with `hasPart`, or one object a line. Lines and items that are no
    JSON object are dropped.

    Files of at most WHOLE bytes are read as one value. Larger ones are read
    by lines, so no task holds one; a larger file must have an object, or an
    item of its list, on each line (a comma at its end is taken off).
    """
    found = files(spark, path)
    listed = found.select("path", (F.col("length") <= WHOLE).alias("small")).collect()  # names of files only
    small, large = [r.path for r in listed if r.small], [r.path for r in listed if not r.small]
    parts = []
    if small:
        whole = spark.read.text(small, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.trim("value").alias("v"))
        lines = F.filter(F.split("v", "\n"), lambda x: F.trim(x) != "")
        # The parser ignores what follows a value, so several lines of which
        # the first is a value of its own are not parsed as one.
        by_line = (F.size(lines) > 1) & F.try_parse_json(F.try_element_at(lines, F.lit(1))).isNotNull()
        parsed = F.when(~by_line, F.try_parse_json("v"))
        part = F.coalesce(F.try_variant_get(parsed, "$.hasPart", "array<variant>"), F.try_variant_get(parsed, "$", "array<variant>"), F.when(parsed.isNotNull(), F.array(parsed)))
        items = F.transform(part, lambda x: F.to_json(x))
        parts.append(whole.select("file_path", F.explode(F.coalesce(items, lines)).alias("record")))
    if large:
        parts.append(spark.read.text(large).select(F.col("_metadata.file_path").alias("file_path"), F.regexp_replace(F.trim("value"), ",$", "").alias("record")))
    if not parts:
        return spark.createDataFrame([], "file_path string, record string")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.where(F.try_parse_json("record").isNotNull() & F.trim("record").startswith("{"))


def towns_csv(spark: SparkSession, path: str) -> DataFrame:
    """gnis, place_name, state_code, source_url, status; gnis is 0 if unread."""
    raw = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true").csv(path)
    cols = [F.coalesce(F.trim(F.col("gnis")).try_cast("long"), F.lit(0)).alias("gnis")]
    return raw.select(*cols, *[F.trim(c).alias(c) for c in ("place_name", "state_code", "source_url", "status")])


def xml_first(xml: Column, *paths: str) -> Column:
    """Text at the first of the XPath expressions that gives any."""
    return F.coalesce(*[F.nullif(F.trim(F.xpath_string(xml, F.lit(p))), F.lit("")) for p in paths])


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of all files below path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def row_groups(spark: SparkSession, path: str, column: str) -> DataFrame:
    """path, row_group, rows, bytes, low, high (as text) of each row group by
    the files' footers, read where the executors are. Files that can't be read
    are left out."""

    def read(batches):
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        schema = pa.schema([("path", pa.string()), ("row_group", pa.int32()), ("rows", pa.int64()), ("bytes", pa.int64()), ("low", pa.string()), ("high", pa.string())])
        for b in batches:
            for name in b.column(0).to_pylist():
                try:
                    system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                    meta = pq.read_metadata(place, filesystem=system)
                except (OSError, pa.ArrowInvalid):
                    continue
                at, out = meta.schema.names.index(column), []
                for i in range(meta.num_row_groups):
                    g = meta.row_group(i)
                    s = g.column(at).statistics
                    known = s is not None and s.has_min_max
                    out.append({"path": name, "row_group": i, "rows": g.num_rows, "bytes": g.total_byte_size, "low": str(s.min) if known else None, "high": str(s.max) if known else None})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select("path").mapInArrow(read, "path string, row_group int, rows long, bytes long, low string, high string")  # contents are not read


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.lines, self.hidden, self.open = [], [""], 0, None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        if tag == "a":
            self.open = (dict(attrs).get("href"), [])
        if tag in ("br", "p", "div", "li", "tr", "h1", "h2", "h3", "h4", "table", "ul", "td"):
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1
        if tag == "a" and self.open:
            if self.open[0]:
                self.links.append((self.open[0], " ".join("".join(self.open[1]).split())))
            self.open = None

    def handle_data(self, data):
        if not self.hidden:
            self.lines[-1] += data
            if self.open:
                self.open[1].append(data)


def _page(html: str | None) -> _Page:
    p = _Page()
    p.feed(html or "")
    p.close()
    return p


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])))
def html_links(html: pd.Series, base: pd.Series) -> pd.Series:
    """Absolute links and their texts, in page order."""

    def one(h, b):
        out = []
        for href, text in _page(h).links:
            try:
                out.append({"url": urljoin(b or "", href), "text": text})
            except ValueError:
                continue
        return out

    return pd.Series([one(h, b) for h, b in zip(html, base)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_lines(html: pd.Series) -> pd.Series:
    """Visible lines, white space collapsed, blank ones left out."""
    return html.map(lambda h: [x for x in (" ".join(s.split()) for s in _page(h).lines) if x])


@F.pandas_udf(T.BinaryType())
def warc_body(member: pd.Series) -> pd.Series:
    """HTTP body of a (gzip) WARC member; null if it isn't one."""

    def one(raw):
        try:
            data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
            return data.split(b"\r\n\r\n", 2)[2]
        except (IndexError, OSError, TypeError, EOFError, zlib.error):
            return None

    return member.map(one)


@F.pandas_udf(T.BinaryType())
def deflate(raw: pd.Series) -> pd.Series:
    """Bytes packed as a gzip member."""
    return raw.map(lambda b: None if b is None else gzip.compress(b, 1, mtime=0))


@F.pandas_udf(T.BinaryType())
def inflate(raw: pd.Series) -> pd.Series:
    """gzip or deflate bytes unpacked by their header; others as they are."""

    def one(b):
        if b is None:
            return None
        for bits in (31, 15, -15):
            try:
                if bits == 31 and b[:2] != b"\x1f\x8b":
                    continue
                return zlib.decompress(b, bits)
            except zlib.error:
                continue
        return b

    return raw.map(one)


def looks_like_html(raw: Column) -> Column:
    return F.lower(F.decode(F.substring(raw, 1, 512), "ISO-8859-1")).rlike(r"<(?:!doctype html|html|head|body|title)")

