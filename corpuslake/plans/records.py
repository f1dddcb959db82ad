"""Queries of candidate and source records: selection, fields, states, quality,
identifiers, orders and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..functions.cid import canonical_any, cid_v1
from ..operators.keyed import best_by_key, listed, numbered
from ..sources import sinks
from ..session import shared_path
from ..tables import table
from .corpus import _cid, kg_nodes

_FIELDS = ("identifier", "legislationIdentifier", "name", "title", "text", "full_text", "url", "sourceUrl", "source_url", "legislationJurisdiction", "retrieved_at", "effective_date")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """candidate_row with the fields of its JSON as strings; one parse."""
    j = F.from_json("row_json", ", ".join(f"{n} string" for n in _FIELDS))
    return table(spark, d, "candidate_row").select("candidate_id", "state", "source_file", "row_json", j.alias("j")).select("candidate_id", "state", "source_file", "row_json", "j.*")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# ---- selection ------------------------------------------------------------
ASKED = ["me, ks,PA", "bad1", "", "Ca,me", "vt"]


def state_select(spark, d):
    """Rows of the asked states, with the place of the state in the request."""
    asked = X.selected_states(ASKED)
    place = F.array_position(F.array(*[F.lit(s) for s in asked]), F.upper(F.trim("state")))
    return table(spark, d, "candidate_row").where(F.upper(F.trim("state")).isin(asked)).select("candidate_id", place.cast("int").alias("place"))


def _file_state() -> Column:
    return F.nullif(F.regexp_extract("source_file", r"(?:state[_-]|STATE-)([A-Z]{2})\.[a-z]+$", 1), F.lit(""))


def leak_guard(spark, d):
    """Rows kept and dropped of each file: a row of another state than its
    file's is a leak; rows that name none, and files that name none, pass."""
    own = F.when(F.upper(F.trim("state")).rlike("^[A-Z]{2}$"), F.upper(F.trim("state")))
    leak = F.coalesce(own != _file_state(), F.lit(False))
    return table(spark, d, "candidate_row").groupBy("source_file").agg(F.count_if(~leak).alias("kept"), F.count_if(leak).alias("dropped"))


def candidate_paths(spark, d):
    """Files that are candidates of the law corpus, by their path."""
    p = F.lower("source_file")
    return table(spark, d, "source_record").where("source_file is not null").select("source_file").distinct().where(p.contains("state_laws") | (p.contains("upload") & p.contains("/parsed/jsonld/")))


def alternative_names(spark, d):
    """Fields under their alternative names: the first that isn't empty (its
    blanks stripped after the choice), and the first that isn't null."""
    pick = lambda *n: X.first_true(*[F.col(c) for c in n])
    return _rows(spark, d).select("candidate_id", pick("sourceUrl", "source_url", "url").alias("url"), pick("identifier", "legislationIdentifier").alias("identifier"), pick("name", "title").alias("name"), F.coalesce("title", "name").alias("picked"))


def _state() -> Column:
    """State of a row: its code, its US-XX jurisdiction, the head of its
    identifier, the name of its file."""
    two = F.when(F.upper(X.norm(F.col("state"))).rlike("^[A-Z]{2}$"), F.upper(X.norm(F.col("state"))))
    part = lambda c, p: F.nullif(F.regexp_extract(F.upper(c), p, 1), F.lit(""))
    return F.coalesce(two, part(X.norm(F.col("legislationJurisdiction")), "^US-([A-Z]{2})$"), part(X.first_true(F.col("identifier"), F.col("legislationIdentifier")), "^([A-Z]{2})[-_ ]"), _file_state())


def state_infer(spark, d):
    """State of each row; the code is looked at in every second row only as
    half of the rows stand for such without one."""
    half = _rows(spark, d).withColumn("state", F.when(F.col("candidate_id") % 2 == 0, F.col("state")))
    return half.select("candidate_id", _state().alias("state"))


# ---- quality and best rows ------------------------------------------------
_LEGAL, _NOISE = r"\b(?:section|shall|pursuant|statute|rule)\b|§", r"\b(?:click|cookie|menu|rtf1|ansi)\b"


def quality_tuple(text: Column) -> Column:
    """(not raw RTF, legal hits * 5 - noise hits * 4 over the whole text,
    length) of a text; (0, -999, 0) of an empty one."""
    t = X.norm(text)
    low = F.lower(t)
    good = F.struct(F.when(t.rlike(r"^\{\\rtf"), 0).otherwise(1).alias("plain"), (X.hits(low, _LEGAL) * 5 - X.hits(low, _NOISE) * 4).alias("score"), F.length(t).alias("chars"))
    return F.when(t == "", F.struct(F.lit(0).alias("plain"), F.lit(-999).alias("score"), F.lit(0).alias("chars"))).otherwise(good)


def text_quality_tuple(spark, d):
    return _docs(spark, d).select("doc_id", quality_tuple(F.col("text")).alias("q")).select("doc_id", "q.*")


def best_quality_row(spark, d):
    """Best row of each rule: by address, else identifier and name, else name;
    highest quality tuple, then an address, then the longest name, then least id.
    Only lengths and scores are shuffled, no texts."""
    pick = lambda *n: X.first_true(*[F.col(c) for c in n])
    url, ident, name = pick("sourceUrl", "source_url", "url"), pick("identifier", "legislationIdentifier"), pick("name", "title")
    key = F.when(url != "", F.concat(F.lit("u|"), F.lower(url))).when(ident != "", F.concat(F.lit("i|"), F.lower(ident), F.lit("|"), F.lower(name))).otherwise(F.concat(F.lit("n|"), F.lower(name)))
    t = _rows(spark, d).select("candidate_id", key.alias("k"), quality_tuple(pick("text", "full_text")).alias("q"), (url != "").alias("u"), F.length(name).alias("n"))
    return best_by_key(t, ["k"], [F.col("q.plain"), F.col("q.score"), F.col("q.chars"), F.col("u"), F.col("n")], F.col("candidate_id")).select("k", "candidate_id", "q.score", "q.chars")


#: Signs of a court rule and what they weigh.
COURT_SIGNS = [(120, "local court rules"), (90, "civil procedure"), (90, "criminal procedure"), (70, "court rules"), (60, "civil practice|criminal practice"), (50, "special civil"), (30, "/rules|/court_rules/|legal-resources/rules")]


def court_quality(spark, d):
    """Score of each document as a court rule, by signs in its kind, source and
    text, its name, and its length."""
    signal = F.lower(F.concat_ws(" ", F.translate("doc_kind", "_", " "), F.translate("source", "_", " "), "text"))
    name = F.translate(F.coalesce("doc_kind", F.lit("")), "_", " ")
    rules = [(w, signal.rlike(p)) for w, p in COURT_SIGNS] + [(20, name.isin("rules", "court rules", "local court rules")), (-100, name.startswith("how you know") | name.startswith("read more"))]
    return _docs(spark, d).select("doc_id", (X.weighted(rules) + F.least(F.floor(F.length(X.norm(F.col("text"))) / 20), F.lit(25))).cast("int").alias("score"))


def jurisdiction_infer(spark, d):
    """Nation named in a source: by a table of aliases, else the longest name
    that it contains. The table is fixed and small, so it is broadcast."""
    n = table(spark, d, "nation").select(F.lower("n_name").alias("name"), "n_nationkey")
    s = _docs(spark, d).where("source is not null").select("source").distinct().withColumn("h", F.concat(F.translate(F.lower("source"), "_", " "), F.lit(" nation_"), (F.length("source") % 25).cast("string")))
    got = s.join(F.broadcast(n), F.col("h").contains(F.col("name")), "left")
    return got.groupBy("source").agg(F.max_by("n_nationkey", F.struct(F.length("name"), "name")).alias("nation"))


# ---- identifiers ----------------------------------------------------------
def stable_ids(spark, d):
    """SHA-1 identifiers at full length, 16 and 12 digits."""
    h = F.sha1(F.col("source_file"))
    return table(spark, d, "source_record").where("source_file is not null").select("record_id", h.alias("full"), F.substring(h, 1, 16).alias("id16"), F.substring(h, 1, 12).alias("id12"))


def digest_ids(spark, d):
    """The digest of a text as an identifier of what has no other."""
    return _docs(spark, d).where("text is not null").select("doc_id", F.coalesce("official_cite", F.concat(F.lit("sha256-"), F.sha2("text", 256))).alias("id"))


def canonical_cid(spark, d):
    """Identifier of each row's JSON in canonical form (keys sorted, compact)."""
    c = canonical_any(F.col("row_json"))
    return table(spark, d, "candidate_row").select("candidate_id", c.alias("c")).where("c is not null").select("candidate_id", cid_v1(F.col("c")).alias("cid"))


def cid_index(spark, d):
    """The narrow side index of identifiers, written and read back."""
    path = shared_path(spark, "cid-index")
    t = _docs(spark, d).where("text is not null").select(cid_v1(F.col("text")).alias("cid"), "doc_id", "official_cite", "lang")
    sinks.index(t, path, ["cid", "doc_id"])
    return spark.read.parquet(path)


# ---- orders ---------------------------------------------------------------
def score_sort(spark, d):
    """Documents by falling score; ties keep their order of id."""
    low = F.lower(F.coalesce("text", F.lit("")))
    t = _docs(spark, d).select("doc_id", (X.hits(low, _LEGAL) - X.hits(low, _NOISE)).alias("score"))
    return numbered(t, [F.col("score").desc(), F.col("doc_id").asc()], "position").select("doc_id", "score", "position")


def section_sort(spark, d):
    """Citations in natural order of their last number; others come last."""
    minor = F.regexp_extract("official_cite", r"(\d+)\D*$", 1).try_cast("int")
    t = _docs(spark, d).where("official_cite is not null").select("doc_id", "official_cite", F.coalesce(minor, F.lit(1_000_000_000)).alias("minor"))
    return numbered(t, ["minor", "official_cite", "doc_id"], "position").select("doc_id", "minor", "position")


def cid_sort(spark, d):
    t = _docs(spark, d).where("text is not null").select("doc_id", cid_v1(F.col("text")).alias("cid"))
    return numbered(t, ["cid", "doc_id"], "position").select("doc_id", "position")


def title_sort(spark, d):
    """Sections by the number before the first point, 999 where there is none."""
    t = _docs(spark, d).select("doc_id", F.coalesce(F.regexp_extract(F.coalesce("official_cite", F.lit("")), r"(\d+)", 1).try_cast("int"), F.lit(999)).alias("title"))
    return numbered(t, ["title", "doc_id"], "position").select("doc_id", "title", "position")


# ---- lists ----------------------------------------------------------------
def rows_by_key(spark, d):
    """Records of each file as lists of at most 50, in order of id."""
    t = table(spark, d, "source_record").where("source_file is not null").select("source_file", "record_id")
    return listed(t, ["source_file"], ["record_id"], F.col("record_id"), 50, "ids").select("source_file", "part", F.array_join("ids", ",").alias("ids"))


def list_clean(spark, d):
    """Items of a free list: split, stripped, empty ones left out."""
    raw = F.split(F.concat_ws(";", "source", F.lit("  "), "doc_kind", F.lit(""), "lang"), ";")
    clean = F.filter(F.transform(raw, X.norm), lambda x: x != "")
    return _docs(spark, d).select("doc_id", F.array_join(clean, "|").alias("items"))


def json_links(spark, d):
    """Web links among the values of each row's JSON, in order of their keys."""
    links = F.filter(F.map_values(F.from_json("row_json", "map<string,string>")), lambda v: v.startswith("http://") | v.startswith("https://"))
    return table(spark, d, "candidate_row").select("candidate_id", F.array_join(F.array_sort(F.array_distinct(links)), " ").alias("links"))


def kg_rows(spark, d):
    """Rows out of nested blocks: those that have a state and an address."""
    block = _rows(spark, d).select("source_file", F.array(F.struct("candidate_id", "state", X.first_true(F.col("sourceUrl"), F.col("source_url"), F.col("url")).alias("url"))).alias("statutes"))
    return block.select(F.explode("statutes").alias("s")).select("s.*").where("state is not null and trim(state) <> '' and url <> ''").select("candidate_id", "url")


def defaults_fill(spark, d):
    """Curated entries with defaults for what they leave out."""
    return _rows(spark, d).select("candidate_id", F.coalesce("name", "title", F.lit("unnamed")).alias("name"), F.coalesce("effective_date", F.lit("1900-01-01")).alias("effective_date"), F.lit("candidate").alias("kind"))


# ---- document lines -------------------------------------------------------
def chapter_slug(spark, d):
    """Chapter of a citation: zeros before it dropped, a letter after it kept."""
    raw = F.regexp_extract(F.lower("official_cite"), r"(\d+)([a-z]?)", 0)
    number, letter = F.regexp_extract(raw, r"^0*(\d+)", 1), F.regexp_extract(raw, r"([a-z])$", 1)
    return _docs(spark, d).where("official_cite is not null").select("doc_id", F.concat(number, letter).alias("slug"), F.concat(F.lit("Chapter "), number, F.upper(letter)).alias("display"))


def title_line(spark, d):
    """The first heading and the first line with a year of each text, looked
    for in all of its lines."""
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.trim(x))
    head = F.try_element_at(F.filter(lines, lambda x: x.rlike(r"^(Section|Article|Rule) \d")), F.lit(1))
    edition = F.try_element_at(F.filter(lines, lambda x: x.rlike(r"\b20\d\d\b")), F.lit(1))
    return _docs(spark, d).where("text is not null").select("doc_id", head.alias("title"), F.regexp_extract(edition, r"\b(20\d\d)\b", 1).alias("edition"))


def chapter_range(spark, d):
    """Distinct chapters cited that lie within a range, in order."""
    c = _docs(spark, d).where("text is not null").select(F.explode(F.regexp_extract_all("text", F.lit(r"section (\d+)-\d+-\d+"), F.lit(1))).alias("c"))
    c = c.select(F.col("c").try_cast("int").alias("chapter")).where("chapter between 10 and 40").distinct()
    return numbered(c, ["chapter"], "position")


def line_counts(spark, d):
    """Lines that aren't blank, against the count that was recorded (a line
    for each 80 characters); the greater counts."""
    have = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.trim(x) != ""))
    said = F.coalesce(F.floor(F.col("n_chars") / 80).cast("int"), F.lit(0))
    return _docs(spark, d).select("doc_id", have.alias("lines"), F.greatest(have, said).alias("recovered"))


def canonical_nodes(spark, d):
    """Citation nodes only, by the prefix of their id."""
    return kg_nodes(spark, d).where(F.col("node_id").startswith("ref:")).select("node_id")


def kg_first_nodes(spark, d):
    """Nodes with the type of their first appearance, by document and then by
    the order of what it names: itself, its state, what it cites."""
    t = _docs(spark, d).where("text is not null")
    named = F.array(F.struct(F.concat(F.lit("doc:"), "doc_id").alias("node_id"), F.coalesce("doc_kind", F.lit("document")).alias("node_type")))
    state = F.when(F.col("state_code").isNotNull(), F.array(F.struct(F.concat(F.lit("state:"), F.upper("state_code")).alias("node_id"), F.lit("state").alias("node_type")))).otherwise(F.array())
    cites = F.transform(F.regexp_extract_all("text", F.lit(r"section \d+-\d+-\d+"), F.lit(0)), lambda x: F.struct(F.concat(F.lit("ref:"), F.regexp_replace(x, "^section ", "")).alias("node_id"), F.coalesce("doc_kind", F.lit("document")).alias("node_type")))
    e = t.select("doc_id", F.posexplode(F.concat(named, state, cites)).alias("pos", "n")).select("doc_id", "pos", "n.*")
    return e.groupBy("node_id").agg(F.min_by("node_type", F.struct("doc_id", "pos")).alias("node_type"))


def key_fallback(spark, d):
    """Key of each record: from its identifier, else its name, else its
    address, by one pattern; none without any."""
    parts = [F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d{3})[^0-9]?(\d{3})[^0-9]?(\d{4})", 0), F.lit("")) for c in (F.col("identifier"), F.col("legislationIdentifier"), F.col("name"), F.col("url"))]
    return _rows(spark, d).select("candidate_id", F.regexp_replace(F.coalesce(*parts), "[^0-9]", "").alias("key"))


def payload_merge(spark, d):
    """New payloads over what is there: a field that is there stays."""
    old = _rows(spark, d).select("candidate_id", F.nullif(X.norm(F.col("name")), F.lit("")).alias("name"), "effective_date")
    new = _rows(spark, d).select("candidate_id", F.col("title").alias("new_name"), F.lit("2024-01-01").alias("new_date"))
    return old.join(new, "candidate_id").select("candidate_id", F.coalesce("name", "new_name").alias("name"), F.coalesce("effective_date", "new_date").alias("effective_date"))


def hashed_encoder(texts: list[str | None], size: int = 32):
    """A stand-in for an embedding model: counts of hashed words, over their
    length; all zero without words."""
    import hashlib

    import numpy as np

    out = np.zeros((len(texts), size))
    for i, t in enumerate(texts):
        for w in (t or "").lower().split():
            out[i, hashlib.md5(w.encode()).digest()[0] % size] += 1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embed_texts(df: DataFrame, text: str, out: str, encoder=hashed_encoder) -> DataFrame:
    """df with, in place of text, its vector by an encoder (a function from a
    list of texts to rows of numbers), batch by batch; one may load its model
    on first use. Null texts are encoded as the encoder says."""
    import pyarrow as pa
    from pyspark.sql import types as T

    def run(batches):
        for b in batches:
            rows = encoder(b.column(b.schema.get_field_index(text)).to_pylist())
            yield b.drop_columns([text]).append_column(out, pa.array([list(map(float, r)) for r in rows], pa.list_(pa.float64())))

    if out in df.columns and out != text:
        raise ValueError(f"{out} exists")
    return df.mapInArrow(run, T.StructType([*(f for f in df.schema.fields if f.name != text), T.StructField(out, T.ArrayType(T.DoubleType()))]))


def embed_documents(spark, d):
    """Length and words' share of each document's vector."""
    v = embed_texts(_docs(spark, d).select("doc_id", "text"), "text", "v")
    return v.select("doc_id", F.size("v").alias("dimensions"), F.round(X.dot(F.col("v"), F.col("v")), 6).alias("norm"))


_QUERIES = (
    kg_first_nodes, key_fallback, payload_merge, embed_documents, state_select, leak_guard, candidate_paths, alternative_names, state_infer, text_quality_tuple, best_quality_row, court_quality, jurisdiction_infer,
    stable_ids, digest_ids, canonical_cid, cid_index, score_sort, section_sort, cid_sort, title_sort, rows_by_key, list_clean, json_links, kg_rows,
    defaults_fill, chapter_slug, title_line, chapter_range, line_counts, canonical_nodes,
)
QUERIES = {f.__name__: f for f in _QUERIES}


def _first(*names: str) -> str:
    """SQL of first_true: the first name that isn't empty, then stripped."""
    return "trim(coalesce(" + ", ".join(f"nullif(row_json->>'{n}', '')" for n in names) + ", ''), ' \t\n\r ')"


_URL, _IDENT, _NAME, _TEXT = _first("sourceUrl", "source_url", "url"), _first("identifier", "legislationIdentifier"), _first("name", "title"), _first("text", "full_text")
_FILE_STATE = "nullif(regexp_extract(source_file, '(?:state[_-]|STATE-)([A-Z]{2})\\.[a-z]+$', 1), '')"


def _hits(t: str, p: str) -> str:
    return f"len(regexp_extract_all({t}, '{p}'))"


def _q(t: str) -> str:
    low = f"lower({t})"
    return f"""case when {t} = '' then 0 when regexp_matches({t}, '^\\{{\\\\rtf') then 0 else 1 end as plain,
        (case when {t} = '' then -999 else {_hits(low, _LEGAL)} * 5 - {_hits(low, _NOISE)} * 4 end)::int as score, length({t})::int as chars"""


_LOW = "lower(coalesce(text, ''))"
SQL = {
    "kg_first_nodes": """with t as (select doc_id, text, state_code, coalesce(doc_kind, 'document') as kind from documents where text is not null),
        l as (select doc_id, regexp_extract_all(text, 'section \\d+-\\d+-\\d+') as l, kind from t),
        e as (select doc_id, 0 as pos, 'doc:' || doc_id as node_id, kind as node_type from t union all select doc_id, 1, 'state:' || upper(state_code), 'state' from t where state_code is not null
          union all select doc_id, 1 + i, 'ref:' || substr(l[i], 9), kind from (select doc_id, l, kind, unnest(range(1, len(l) + 1)) as i from l))
        select node_id, arg_min(node_type, (doc_id, pos)) as node_type from e group by 1""",
    "key_fallback": "select candidate_id, regexp_replace(coalesce(" + ", ".join(f"nullif(regexp_extract(coalesce(row_json->>'{n}', ''), '(\\d{{3}})[^0-9]?(\\d{{3}})[^0-9]?(\\d{{4}})', 0), '')" for n in ("identifier", "legislationIdentifier", "name", "url")) + "), '[^0-9]', '', 'g') as key from candidate_row",
    "payload_merge": "select candidate_id, coalesce(nullif(trim(row_json->>'name', ' \t\n\r '), ''), row_json->>'title') as name, coalesce(row_json->>'effective_date', '2024-01-01') as effective_date from candidate_row",
    "embed_documents": "select doc_id, 32 as dimensions, case when regexp_matches(coalesce(text, ''), '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]') then 1.0 else 0.0 end::double as norm from documents",
    "state_select": "select candidate_id, list_position(['ME', 'KS', 'PA', 'CA', 'VT'], upper(trim(state)))::int as place from candidate_row where upper(trim(state)) in ('ME', 'KS', 'PA', 'CA', 'VT')",
    "leak_guard": f"""with t as (select source_file, coalesce((case when regexp_matches(upper(trim(state)), '^[A-Z]{{2}}$') then upper(trim(state)) end) <> {_FILE_STATE}, false) as leak from candidate_row)
        select source_file, count_if(not leak)::bigint as kept, count_if(leak)::bigint as dropped from t group by 1""",
    "candidate_paths": "select distinct source_file from source_record where contains(lower(source_file), 'state_laws') or (contains(lower(source_file), 'upload') and contains(lower(source_file), '/parsed/jsonld/'))",
    "alternative_names": f"select candidate_id, {_URL} as url, {_IDENT} as identifier, {_NAME} as name, coalesce(row_json->>'title', row_json->>'name') as picked from candidate_row",
    "state_infer": f"""select candidate_id, coalesce(case when candidate_id % 2 = 0 and regexp_matches(upper(trim(state)), '^[A-Z]{{2}}$') then upper(trim(state)) end,
        nullif(regexp_extract(upper(trim(coalesce(row_json->>'legislationJurisdiction', ''))), '^US-([A-Z]{{2}})$', 1), ''),
        nullif(regexp_extract(upper({_IDENT}), '^([A-Z]{{2}})[-_ ]', 1), ''), {_FILE_STATE}) as state from candidate_row""",
    "text_quality_tuple": f"with t as (select doc_id, regexp_replace(coalesce(text, ''), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') as x from documents) select doc_id, {_q('x')} from t",
    "best_quality_row": f"""with t as (select candidate_id, {_URL} as url, {_IDENT} as ident, {_NAME} as name, {_TEXT} as x from candidate_row),
        k as (select *, case when url <> '' then 'u|' || lower(url) when ident <> '' then 'i|' || lower(ident) || '|' || lower(name) else 'n|' || lower(name) end as k, {_q('x')} from t)
        select k, candidate_id, score, chars from k qualify row_number() over (partition by k order by plain desc, score desc, chars desc, url <> '' desc, length(name) desc, candidate_id) = 1""",
    "court_quality": "with t as (select doc_id, lower(concat_ws(' ', replace(doc_kind, '_', ' '), replace(source, '_', ' '), text)) as s, replace(coalesce(doc_kind, ''), '_', ' ') as name, regexp_replace(coalesce(text, ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') as x from documents) select doc_id, ("
    + " + ".join(f"case when regexp_matches(s, '{p}') then {w} else 0 end" for w, p in COURT_SIGNS)
    + " + case when name in ('rules', 'court rules', 'local court rules') then 20 else 0 end - case when starts_with(name, 'how you know') or starts_with(name, 'read more') then 100 else 0 end + least(length(x) // 20, 25))::int as score from t",
    "jurisdiction_infer": """with s as (select distinct source, replace(lower(source), '_', ' ') || ' nation_' || (length(source) % 25) as h from documents where source is not null)
        select source, arg_max(n_nationkey, (length(n_name), lower(n_name))) as nation from s left join nation on contains(h, lower(n_name)) group by source""",
    "stable_ids": "select record_id, sha1(source_file) as full, substr(sha1(source_file), 1, 16) as id16, substr(sha1(source_file), 1, 12) as id12 from source_record where source_file is not null",
    "digest_ids": "select doc_id, coalesce(official_cite, 'sha256-' || sha256(text)) as id from documents where text is not null",
    "cid_index": None,
    "score_sort": f"with t as (select doc_id, ({_hits(_LOW, _LEGAL)} - {_hits(_LOW, _NOISE)})::int as score from documents) select doc_id, score, row_number() over (order by score desc, doc_id) - 1 as position from t",
    "section_sort": "with t as (select doc_id, official_cite, coalesce(try_cast(nullif(regexp_extract(official_cite, '(\\d+)\\D*$', 1), '') as int), 1000000000) as minor from documents where official_cite is not null) select doc_id, minor, row_number() over (order by minor, official_cite, doc_id) - 1 as position from t",
    "cid_sort": None,
    "title_sort": "with t as (select doc_id, coalesce(try_cast(nullif(regexp_extract(coalesce(official_cite, ''), '(\\d+)', 1), '') as int), 999) as title from documents) select doc_id, title, row_number() over (order by title, doc_id) - 1 as position from t",
    "rows_by_key": """with t as (select source_file, record_id, row_number() over (partition by source_file order by record_id) as n from source_record where source_file is not null)
        select source_file, ((n - 1) // 50)::int as part, string_agg(record_id, ',' order by n) as ids from t group by all""",
    "list_clean": "select doc_id, array_to_string(list_filter(list_transform(string_split(concat_ws(';', source, '  ', doc_kind, '', lang), ';'), lambda x: trim(x)), lambda x: x <> ''), '|') as items from documents",
    "json_links": """with t as (select candidate_id, unnest(json_keys(row_json)) as k, row_json from candidate_row), v as (select candidate_id, json_extract_string(row_json, '$."' || k || '"') as v from t),
        l as (select candidate_id, string_agg(v, ' ' order by v) as links from (select distinct * from v) where starts_with(v, 'http://') or starts_with(v, 'https://') group by 1)
        select candidate_id, coalesce(links, '') as links from candidate_row left join l using (candidate_id)""",
    "kg_rows": f"select candidate_id, {_URL} as url from candidate_row where trim(state) <> '' and {_URL} <> ''",
    "defaults_fill": "select candidate_id, coalesce(row_json->>'name', row_json->>'title', 'unnamed') as name, coalesce(row_json->>'effective_date', '1900-01-01') as effective_date, 'candidate' as kind from candidate_row",
    "chapter_slug": """with t as (select doc_id, regexp_extract(lower(official_cite), '(\\d+)([a-z]?)', 0) as r from documents where official_cite is not null)
        select doc_id, regexp_extract(r, '^0*(\\d+)', 1) || regexp_extract(r, '([a-z])$', 1) as slug, 'Chapter ' || regexp_extract(r, '^0*(\\d+)', 1) || upper(regexp_extract(r, '([a-z])$', 1)) as display from t""",
    "title_line": """with t as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x)) as l from documents where text is not null)
        select doc_id, list_filter(l, lambda x: regexp_matches(x, '^(Section|Article|Rule) \\d'))[1] as title, regexp_extract(list_filter(l, lambda x: regexp_matches(x, '\\b20\\d\\d\\b'))[1], '\\b(20\\d\\d)\\b', 1) as edition from t""",
    "chapter_range": """with c as (select distinct try_cast(unnest(regexp_extract_all(text, 'section (\\d+)-\\d+-\\d+', 1)) as int) as chapter from documents where text is not null)
        select chapter, row_number() over (order by chapter) - 1 as position from c where chapter between 10 and 40""",
    "line_counts": """with t as (select doc_id, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> ''))::int as lines, coalesce(n_chars // 80, 0)::int as said from documents)
        select doc_id, lines, greatest(lines, said) as recovered from t""",
    "canonical_nodes": "select distinct 'ref:' || substr(unnest(regexp_extract_all(text, 'section \\d+-\\d+-\\d+')), 9) as node_id from documents where text is not null",
}
SQL["cid_index"] = f"select {_cid('text')} as cid, doc_id from documents where text is not null"
SQL["cid_sort"] = f"with t as (select doc_id, {_cid('text')} as cid from documents where text is not null) select doc_id, row_number() over (order by cid, doc_id) - 1 as position from t"
SQL["canonical_cid"] = f"""with t as (select candidate_id, '{{' || array_to_string(list_transform(list_sort(list_filter(json_keys(row_json), lambda k: k not in ('cid', 'ipfs_cid'))),
    lambda k: '"' || k || '":' || (row_json->('$."' || k || '"'))::varchar), ',') || '}}' as text from candidate_row where json_valid(row_json))
    select candidate_id, {_cid('text')} as cid from t"""
