"""Lines and line sequences that many documents of one source share.

Distributed PrefixSpan over line identifiers: the frequent single lines are
counted first; each level then extends a frequent sequence by the lines that
follow in a document, until a level has none. Over any gaps its first
occurrence in a document stands for all later ones, as whatever follows those
follows it; with a bounded gap each occurrence is a projection. Only
frequent lines stay in the projected documents; counts are combined before
they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_shared

#: Salts for joins of lines with their source's frequent lines, so that a
#: source with a third of all documents is spread.
SALTS = 16


def host_of(url: Column) -> Column:
    """Host of an URL: lower case, without user, port and leading www."""
    authority = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"(:\d*)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", host)


def line_ids(text: Column) -> Column:
    """Array of one 64-bit id for each line of text, null for empty lines.

    Equal ids are lines equal after lower-casing, dropping digits 0-9, making
    white space runs one space and trimming.
    """
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", ""), r"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")
    clean = F.transform(F.split(plain, "\n", -1), lambda x: F.trim(x))
    return F.transform(clean, lambda x: F.when(x != "", F.xxhash64(x)))


def sourced_lines(docs: DataFrame, key: str, text: str, sources: DataFrame, source: str) -> DataFrame:
    """key, lines, sources: documents with line ids and their distinct sources.

    sources has key and source pairs (a document may have several). Null keys,
    texts and sources are left out. The line ids are written once, so a text
    is read and normalised once however often they are used.
    """
    per = sources.where(F.col(key).isNotNull() & F.col(source).isNotNull()).select(key, source).distinct()
    lines = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, line_ids(F.col(text)).alias("lines"))
    return write_shared(per.join(lines, key).select(F.col(key).alias("doc"), F.col(source).alias("src"), "lines"), "ps-lines")


def frequent_lines(lines: DataFrame, support: int) -> DataFrame:
    """src, line, n: lines in at least `support` distinct documents of src.

    A line counts once for each document, so documents must be distinct for a
    source; counts are combined before the shuffle.
    """
    once = lines.select("src", F.explode(F.array_distinct(F.filter("lines", lambda x: x.isNotNull()))).alias("line"))
    return once.groupBy("src", "line").agg(F.count("*").alias("n")).where(F.col("n") >= support)


def mark_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """doc, src, line_no (from 1), line of each occurrence of a frequent line."""
    at = lines.select("doc", "src", F.posexplode("lines").alias("pos", "line")).where("line is not null")
    at = at.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    many = frequent.select("src", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return at.join(many, ["src", "line", "salt"]).select("doc", "src", (F.col("pos") + 1).cast("int").alias("line_no"), "line")


def mark_sequences(lines: DataFrame, support: int) -> DataFrame:
    """doc, src, line_no, line of each line that lies in an occurrence of a
    frequent sequence of any length, single lines included.

    PrefixSpan's first level decides these rows: each line of a sequence that
    `support` documents of a source have is itself in all of them, so longer
    frequent sequences, over whatever gaps, consist of lines that the first
    level has found and add none. What the longer ones are is listed by
    frequent_sequences and counted by sequence_counts.
    """
    return mark_lines(lines, frequent_lines(lines, support))


def _items(marked: DataFrame) -> DataFrame:
    """src, doc, line, at (from 1 among the document's frequent lines), prev:
    where the document has the line before that (0: nowhere)."""
    from pyspark.sql import Window

    items = marked.select("src", "doc", "line", F.row_number().over(Window.partitionBy("src", "doc").orderBy("line_no")).alias("at"))
    before = F.lag("at", 1, 0).over(Window.partitionBy("src", "doc", "line").orderBy("at"))
    return write_shared(items.withColumn("prev", before), "ps-items")


def frequent_sequences(marked: DataFrame, support: int, longest: int | None = None, gap: int | None = 1) -> DataFrame:
    """src, seq (array of line ids), n: sequences of frequent lines in at least
    `support` distinct documents of a source, up to `longest` lines if given.

    A step may pass over gap - 1 other frequent lines (None: over any number).
    Every part of a frequent sequence is frequent, so each level joins only
    what the level before left; a document's projections are rows, never one
    gathered list.
    """
    items = _items(marked)
    # Without a gap the first occurrence has all that later ones have after it.
    level = (items if gap else items.where("prev = 0")).select("src", "doc", F.array("line").alias("seq"), "at")
    out, size = None, 1
    while True:
        counted = level.select("src", "doc", "seq").distinct().groupBy("src", "seq").agg(F.count("*").alias("n")).where(F.col("n") >= support)
        counted = write_shared(counted, "ps-counted")
        out = counted if out is None else out.unionByName(counted)
        if size == longest or counted.isEmpty():
            return out
        left = level.join(counted.select("src", "seq"), ["src", "seq"], "left_semi")
        step = items.select("src", "doc", "line", "prev", F.col("at").alias("to"))
        near = (F.col("to") > F.col("at")) & (F.col("to") <= F.col("at") + gap if gap else F.col("prev") <= F.col("at"))
        level = left.join(step, ["src", "doc"]).where(near).select("src", "doc", F.concat("seq", F.array("line")).alias("seq"), F.col("to").alias("at"))
        level, size = write_shared(level, "ps-level"), size + 1


def sequence_counts(marked: DataFrame, support: int) -> DataFrame:
    """src, length, sequences: how many sequences of each length are in at
    least `support` distinct documents of a source, over any gaps.

    PrefixSpan without listing the sequences, of which n common lines have
    2^n: sequences that end at the same places of the same documents have the
    same extensions, so a level keeps such a state once with the number of its
    sequences. Levels go on until none is frequent. A state is known by two
    64-bit hashes over its places; numbers beyond 38 digits are an error.
    """
    items = _items(marked).select("src", "doc", "line", "prev", F.col("at").alias("to"))
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
    number = "decimal(38,0)"
    level = items.select("src", "doc").distinct().select("src", "doc", F.lit(0).alias("at"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    states = level.select("src", "x", "y").distinct().withColumn("ways", F.lit(1).cast(number))
    out, size = None, 0
    while True:
        size += 1
        # The next place of each line: after `at`, and not there between.
        step = level.join(items, ["src", "doc"]).where("to > at and prev <= at").select("src", "x", "y", "line", "doc", "to")
        step = write_shared(step, "ps-step")
        place = [F.bit_xor(F.xxhash64("doc", "to")).alias("x2"), F.bit_xor(F.xxhash64("to", F.lit(size), "doc")).alias("y2")]
        often = step.groupBy("src", "x", "y", "line").agg(F.count("*").alias("n"), *place).where(F.col("n") >= support)
        often = often.join(states, ["src", "x", "y"]).groupBy("src", "x2", "y2").agg(F.sum("ways").cast(number).alias("ways"), F.min(F.struct("x", "y", "line")).alias("one"))
        often = write_shared(often, "ps-states")
        counted = often.groupBy("src").agg(F.lit(size).alias("length"), F.sum("ways").cast(number).alias("sequences"))
        out = counted if out is None else out.unionByName(counted)
        if often.isEmpty():
            return out
        states = often.select("src", F.col("x2").alias("x"), F.col("y2").alias("y"), "ways")
        many = often.select("src", "one.*", "x2", "y2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        level = step.withColumn("salt", salt).join(many, ["src", "x", "y", "line", "salt"]).select("src", "doc", F.col("to").alias("at"), F.col("x2").alias("x"), F.col("y2").alias("y"))


def remove_lines(docs: DataFrame, key: str, text: str, marked: DataFrame) -> DataFrame:
    """docs with the marked lines taken out of text; the other lines stay as
    they are. A text whose every line goes becomes empty; null stays null."""
    gone = marked.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("line_no").alias("__gone"))
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.array_contains(F.col("__gone"), i + 1))
    joined = docs.join(gone, docs[key] == gone["__doc"], "left")
    return joined.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop("__doc", "__gone")
