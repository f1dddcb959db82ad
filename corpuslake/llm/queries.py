"""Queries of the llm problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.components import connected_components
from ..session import write_shared
from ..tables import table
from . import abusive, template_residue
from .best_record import MOST_SOURCES, choose, group_rows, plain_address, plain_identifier, source_reliability
from .containers import pack
from .encode import decode, encode, token_counts
from .near_duplicates import expand, near_duplicates
from .records import record_text
from .repeated_lines import host_of, mark_sequences, remove_lines, sequence_counts, sourced_lines

#: A line is boilerplate of a site if so many of its contents have it.
SUPPORT = 8


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """rec_table, rec_key, text of the contents and the source records."""
    pages = table(spark, folder, "cid_content").select(F.lit("cid_content").alias("rec_table"), F.col("content_cid").alias("rec_key"), "text")
    records = table(spark, folder, "source_record").select(
        F.lit("source_record").alias("rec_table"), F.col("record_id").alias("rec_key"), record_text(F.col("raw")).alias("text")
    )
    return pages.unionByName(records)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of rows with at least 0.6 of their three-word sequences in common."""
    pairs, members = near_duplicates(texts(spark, folder), "rec_key", "text", "rec_table", k=3, threshold=0.6, least_words=50)
    return expand(pairs, members).withColumnRenamed("grp", "rec_table")


def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Each row in a group of the pairs of p1_found: the group's least key and
    the number of other texts it is linked with. Copies of a text (the same
    words in the same order) are one text, and are no links."""
    pairs, members = near_duplicates(texts(spark, folder), "rec_key", "text", "rec_table", k=3, threshold=0.6, least_words=50)
    found = connected_components(pairs, "a", "b")
    links = pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("links"))
    size = members.groupBy("cls").agg(F.count("*").alias("copies"))
    out = members.join(size, "cls").join(links, "cls", "left").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    out = out.where("copies > 1 or links > 0").withColumn("component", F.coalesce("component", "cls"))
    least = out.groupBy("component").agg(F.min("key").alias("group_id"))
    return out.join(least, "component").select(F.col("grp").alias("rec_table"), F.col("key").alias("rec_key"), "group_id", F.coalesce("links", F.lit(0)).alias("links"))


def _site_lines(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "url_cid_latest").select(F.col("last_content_cid").alias("content_cid"), host_of(F.col("url")).alias("site"))
    return sourced_lines(table(spark, folder, "cid_content").select("content_cid", "text"), "content_cid", "text", urls, "site")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that recur in at least 8 contents of one site of the content."""
    marked = mark_sequences(_site_lines(spark, folder), SUPPORT)
    return marked.select(F.col("doc").alias("content_cid"), "line_no").distinct()


def p2_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """How many frequent sequences of each length, over any gaps, a site has."""
    return sequence_counts(mark_sequences(_site_lines(spark, folder), SUPPORT), SUPPORT).withColumnRenamed("src", "site")


def p2_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Every content with its site's repeated lines and sequences taken out."""
    docs = table(spark, folder, "cid_content").select("content_cid", "text")
    return remove_lines(docs, "content_cid", "text", mark_sequences(_site_lines(spark, folder), SUPPORT)).select("content_cid", F.length("text").alias("chars_left"))


def _page_model(spark: SparkSession, folder: str) -> template_residue.PageModel:
    every = texts(spark, folder)
    tries = table(spark, folder, "scrape_attempts").where("status_code >= 400").select(F.col("content_cid").alias("rec_key"))
    last = table(spark, folder, "url_cid_latest").where("last_status_code >= 400").select(F.col("last_content_cid").alias("rec_key"))
    pages, others = every.where("rec_table = 'cid_content'"), every.where("rec_table = 'source_record'")
    return template_residue.fit(pages, "rec_key", "text", tries.unionByName(last), others)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Contents that are an error page, a script demand, filler or a template."""
    pages = table(spark, folder, "cid_content").select("content_cid", "text")
    return template_residue.residue(pages, "text", _page_model(spark, folder), "content_cid").where("is_residue").select("content_cid")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are not main body, of all texts but those of p3: one model,
    one pass over the texts."""
    every, model = texts(spark, folder), _page_model(spark, folder)
    return template_residue.furniture_lines(every, "text", model, F.col("rec_table") == "cid_content", "rec_table", "rec_key")


_ROW = "identifier string, legislationIdentifier string, name string, title string, text string, full_text string, url string, sourceUrl string, source_url string, effective_date string, effectiveDate string, retrieved_at string"


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    """candidate_row with its fields (null if blank), their alternatives
    merged, and the kind of its file."""
    j = F.from_json("row_json", _ROW)
    first = lambda *names: F.coalesce(*[F.when(F.trim(F.regexp_replace(j[n], r"(?U)\s+", " ")) != "", j[n]) for n in names])
    kind = F.regexp_replace(F.trim(F.lower("source_kind")), "[ _]+", "_")
    trust = table(spark, folder, "source_trust").select(F.regexp_replace(F.trim(F.lower("source_kind")), "[ _]+", "_").alias("kind"), "trust_rank")
    files = table(spark, folder, "source_record").select("source_file", kind.alias("kind")).where("kind is not null and source_file is not null")
    files = files.distinct().join(F.broadcast(trust), "kind", "left").groupBy("source_file").agg(F.min_by("kind", F.struct(F.coalesce("trust_rank", F.lit(1 << 30)), "kind")).alias("source"))
    rows = table(spark, folder, "candidate_row").select(
        "candidate_id", F.upper(F.trim("state")).alias("state"), "source_file",
        first("identifier", "legislationIdentifier").alias("identifier"), first("name", "title").alias("name"),
        first("text", "full_text").alias("text"), first("url", "sourceUrl", "source_url").alias("url"),
        first("effective_date", "effectiveDate").alias("effective_date"), F.try_to_timestamp(j["retrieved_at"]).alias("retrieved_at"),
    )
    return rows.join(files, "source_file", "left")


_FIELDS = ("name", "text", "effective_date")


def _claims(spark: SparkSession, folder: str, digest: Callable[[Column], Column]) -> tuple[DataFrame, dict[str, int]]:
    """Claims with a digest of each value, and the ranks. The queries name
    rows, so the values themselves don't go on."""
    rows = _candidates(spark, folder)
    groups = group_rows(rows, "candidate_id", F.when(F.col("state") != "", F.col("state")), [plain_identifier(F.col("identifier")), plain_address(F.col("url"))])
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in _FIELDS]))
    claims = rows.select("candidate_id", "source", "retrieved_at", *[digest(F.col(f)).alias(f) for f in _FIELDS]).join(groups, "candidate_id")
    claims = claims.select(F.col("group_id").alias("grp"), "candidate_id", "source", "retrieved_at", fields.alias("c"))
    kinds = table(spark, folder, "source_trust").select(F.regexp_replace(F.trim(F.lower("source_kind")), "[ _]+", "_").alias("kind"), "trust_rank")
    kinds = kinds.where("kind is not null and trust_rank is not null").groupBy("kind").agg(F.min("trust_rank").alias("trust_rank")).limit(MOST_SOURCES + 1).collect()
    if len(kinds) > MOST_SOURCES:
        raise ValueError("too many kinds of sources")
    rank = {r.kind: r.trust_rank for r in kinds}
    return claims.select("grp", "candidate_id", "source", "retrieved_at", "c.field", "c.value"), rank


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The row that supplies each field of each group's record: of those that
    have it, by rank of trust, then recency, then id. No reliabilities are
    estimated: held to fall with the rank they can't change this order."""
    claims, rank = _claims(spark, folder, lambda v: F.when(v.isNotNull(), True))
    best = choose(claims, {}, rank, "candidate_id", "retrieved_at", together=False)
    return best.select(F.col("grp").alias("group_id"), F.col("field").alias("field_name"), "candidate_id")


#: Rounds of estimation of p6_truth, whose SQL has as many.
ROUNDS = 10


def p6_truth(spark: SparkSession, folder: str) -> DataFrame:
    """The highest-supported value of each field when equal values vote
    together, by reliabilities that nothing but the claims decide."""
    claims, rank = _claims(spark, folder, F.md5)
    claims = write_shared(claims, "claims")
    best = choose(claims, source_reliability(claims, None, ROUNDS, 0.0), rank, "candidate_id", "retrieved_at", together=True)
    return best.select(F.col("grp").alias("group_id"), F.col("field").alias("field_name"), "candidate_id", F.round("support", 6).alias("support"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids of every document by byte_bpe_50k."""
    return encode(table(spark, folder, "documents").select("doc_id", "text"), "text")


def p8_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of every document's text, decoded from its ids."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decode(encode(docs, "text"), text="again").select("doc_id", F.md5("again").alias("digest"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, or piece of one that exceeds it, in each capacity."""
    sizes = token_counts(table(spark, folder, "documents").select("doc_id", "text"), "text", "n_tokens")
    return pack(sizes, "doc_id", "n_tokens", table(spark, folder, "container_spec"))


def p9_waste(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of each capacity, how many no packing can do without, and
    the share of their room in use."""
    specs = table(spark, folder, "container_spec").where("spec_id is not null and capacity_tokens > 0").groupBy("spec_id").agg(F.max("capacity_tokens").alias("capacity"))
    used = p9_containers(spark, folder).where("n > 0").groupBy("spec_id").agg(F.countDistinct("container_id").alias("containers"), F.sum("n").alias("tokens"))
    least = F.ceil(F.col("tokens") / F.col("capacity"))
    return used.join(F.broadcast(specs), "spec_id").select("spec_id", "containers", least.alias("at_least"), F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("fill"))


def _abuse(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = abusive.fit(docs, table(spark, folder, "doc_labels"), "doc_id", "text", "abusive")
    return abusive.score(docs.select(*columns, "text"), "text", model)


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that insult, threaten, degrade or are sexually explicit."""
    return _abuse(spark, folder, "doc_id").where(F.col("score") >= abusive.THRESHOLD).select("doc_id")


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, flagged documents and their rate for each source."""
    hit = F.count_if(F.col("score") >= abusive.THRESHOLD)
    return _abuse(spark, folder, "source").groupBy("source").agg(F.count("*").alias("documents"), hit.alias("flagged"), F.round(hit / F.count("*"), 6).alias("rate"))


QUERIES = {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p2_sequences": p2_sequences, "p2_cleaned": p2_cleaned, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p6_truth": p6_truth, "p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip, "p9_containers": p9_containers, "p9_waste": p9_waste, "p10_found": p10_found, "p10_rates": p10_rates}

_LINES = """
    l as (select content_cid, i as line_no, p[i] as raw from
      (select content_cid, p, unnest(range(1, len(p) + 1)) as i from
        (select content_cid, string_split(text, chr(10)) as p from cid_content where text is not null))),
    k as (select content_cid, line_no,
      trim(regexp_replace(regexp_replace(lower(raw), '[0-9]', '', 'g'), '[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g')) as line from l),
    s as (select distinct last_content_cid as content_cid, regexp_replace(regexp_replace(regexp_replace(
      regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$', ''), '^www\\.', '') as site
      from url_cid_latest where last_content_cid is not null and url is not null),
    j as (select * from k join s using (content_cid) where line <> '' and site <> ''),
    f as (select site, line from j group by all having count(distinct content_cid) >= 8)"""

_BEST = """
    with recursive r as (select candidate_id, upper(trim(state)) as state, source_file, row_json as j, F(identifier,legislationIdentifier) as identifier,
      F(name,title) as name, F(text,full_text) as text, F(url,sourceUrl,source_url) as url, F(effective_date,effectiveDate) as effective_date,
      try_cast(row_json->>'retrieved_at' as timestamp) as got_at from candidate_row),
    k as (select candidate_id, 'i|' || state || '|' || lower(regexp_replace(identifier, '[^\\p{L}\\p{N}]+', '', 'g')) as key from r where identifier is not null
      union all select candidate_id, 'u|' || state || '|' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '#.*$', ''),
        '^[a-z][a-z0-9+.-]*://', ''), '^www\\.', ''), '/$', '') from r where url is not null),
    m as (select key, min(candidate_id) as low from k where state_ok group by key),
    e as (select distinct k.candidate_id as u, m.low as v from k join m using (key)),
    b as (select u, v from e union select v, u from e),
    w as (select candidate_id as id, candidate_id as n from r union select w.id, b.v from w join b on w.n = b.u),
    g as (select id as candidate_id, min(n) as group_id from w group by id),
    s as (select source_file, min(trust_rank) as rank from (select source_file, regexp_replace(trim(lower(source_kind)), '[ _]+', '_', 'g') as kind from source_record) q
      join source_trust t on t.source_kind = q.kind group by 1),
    c as (select group_id, r.*, rank from r join g using (candidate_id) left join s using (source_file)
      where group_id in (select group_id from g group by 1 having count(*) > 1)),
    f as (select group_id, candidate_id, rank, got_at, 'name' as field_name, name as value from c union all select group_id, candidate_id, rank, got_at, 'text', text from c
      union all select group_id, candidate_id, rank, got_at, 'effective_date', effective_date from c)
    select group_id, field_name, candidate_id from f where value is not null
    qualify row_number() over (partition by group_id, field_name order by rank nulls last, got_at desc nulls last, candidate_id) = 1"""
_BEST = _BEST.replace("where state_ok ", "")
for _names in ("identifier,legislationIdentifier", "name,title", "text,full_text", "url,sourceUrl,source_url", "effective_date,effectiveDate"):
    _parts = ", ".join(f"case when trim(regexp_replace(row_json->>'{n}', '\\s+', ' ', 'g')) <> '' then row_json->>'{n}' end" for n in _names.split(","))
    _BEST = _BEST.replace(f"F({_names})", f"coalesce({_parts})")

_TRUTH = _BEST[: _BEST.rindex("select group_id, field_name, candidate_id from f")] + """,
    k2 as (select source_file, arg_min(kind, (coalesce(trust_rank, 1073741824), kind)) as source from
      (select distinct source_file, regexp_replace(trim(lower(source_kind)), '[ _]+', '_', 'g') as kind from source_record) q
      left join (select regexp_replace(trim(lower(source_kind)), '[ _]+', '_', 'g') as kind, trust_rank from source_trust) t using (kind)
      where kind is not null and source_file is not null group by 1),
    h as (select f.*, k2.source from f join candidate_row using (candidate_id) left join k2 using (source_file) where value is not null),
    n as (select group_id, field_name, value, source, count(*) as n from h where source is not null group by all),
    w0 as (select distinct source, 1.0::double as w from n)"""
for _i in range(1, ROUNDS + 1):
    _TRUTH += f""",
    w{_i} as (select source, sum(share * n) / sum(n) as w from (select source, n, sum(n * w) over (partition by group_id, field_name, value)
      / sum(n * w) over (partition by group_id, field_name) as share from n join w{_i - 1} using (source)) group by source)"""
_TRUTH += f"""
    select group_id, field_name, candidate_id, round(votes, 6) as support from
      (select h.*, round(sum(coalesce(w, 0)) over (partition by group_id, field_name, value), 9) as votes from h left join w{ROUNDS} using (source))
    qualify row_number() over (partition by group_id, field_name order by votes desc, rank nulls last, got_at desc nulls last, candidate_id) = 1"""

_PAIRS = """
    with recursive d as (select 'cid_content' as rec_table, content_cid as rec_key, text from cid_content union all
      select 'source_record', record_id, case when json_valid(raw) then coalesce(nullif(raw->>'$.text', ''), nullif(raw->>'$.full_text', ''),
        nullif(raw->>'$.record.text', ''), nullif(raw->>'$.record.full_text', '')) end from source_record),
    w as (select rec_table, rec_key, regexp_extract_all(lower(text), '[a-z0-9]+') as w from d where text is not null),
    m as (select rec_table, rec_key, w, min(rec_key) over (partition by rec_table, array_to_string(w, ' ')) as cls from w where len(w) >= 50),
    s as (select rec_table, rec_key as cls, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as x from m where rec_key = cls),
    n as (select rec_table, cls, count(*) as n from s group by all),
    c as (select a.rec_table, a.cls as a, b.cls as b, count(*) as c from s a join s b on a.rec_table = b.rec_table and a.x = b.x and a.cls < b.cls group by all),
    p as (select c.rec_table, a, b from c join n as na on na.rec_table = c.rec_table and na.cls = a join n as nb on nb.rec_table = c.rec_table and nb.cls = b
      where c >= 0.6 * (na.n + nb.n - c) - 1e-9)"""

SQL: dict[str, str] = {
    "p1_found": f"""{_PAIRS},
    e as (select ma.rec_table, ma.rec_key as x, mb.rec_key as y from p join m as ma on ma.rec_table = p.rec_table and ma.cls = a join m as mb on mb.rec_table = p.rec_table and mb.cls = b
      union all select ma.rec_table, ma.rec_key, mb.rec_key from m as ma join m as mb on ma.rec_table = mb.rec_table and ma.cls = mb.cls and ma.rec_key < mb.rec_key)
    select distinct rec_table, least(x, y) as key_a, greatest(x, y) as key_b from e""",
    "p1_groups": f"""{_PAIRS},
    e as (select rec_table, a as u, b as v from p union all select rec_table, b, a from p),
    l as (select rec_table, u as cls, count(*) as links from e group by all),
    r as (select distinct rec_table, cls as id, cls as n from m union select r.rec_table, r.id, e.v from r join e on r.rec_table = e.rec_table and r.n = e.u),
    g as (select rec_table, id as cls, min(n) as group_id from r group by all),
    k as (select rec_table, cls, count(*) as copies from m group by all)
    select rec_table, rec_key, group_id, coalesce(links, 0) as links from m join g using (rec_table, cls) join k using (rec_table, cls) left join l using (rec_table, cls)
    where copies > 1 or links > 0""",
    "p2_cleaned": f"""with {_LINES}, x as (select distinct content_cid, line_no from j join f using (site, line)),
    y as (select content_cid, sum(length(raw)) + count(*) - 1 as n from l anti join x using (content_cid, line_no) group by 1)
    select content_cid, (case when text is not null then coalesce(n, 0) end)::int as chars_left from cid_content left join y using (content_cid)""",
    "p6_found": _BEST,
    "p6_truth": _TRUTH,
    "p2_found": f"with {_LINES} select distinct content_cid, line_no::int as line_no from j join f using (site, line)",
    "p8_roundtrip": "select doc_id, md5(coalesce(text, '')) as digest from documents",
}
