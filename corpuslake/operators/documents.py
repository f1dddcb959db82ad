"""Structure of documents: sections, subsection trees, citation graphs."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

#: Marker of a subsection at the start of a line or sentence, its kind by form.
_MARK = re.compile(r"(?:(?<=\s)|^)\(([0-9]{1,3}|[a-z]{1,2}|[A-Z]{1,2}|[ivx]{1,5})\)\s")
_LEVEL = {"number": 1, "lower": 2, "upper": 3, "roman": 4}


def kind_of(token: str, before: str | None) -> str:
    """number, lower, upper or roman; i, v, x are roman only where the letter
    before them isn't their neighbour."""
    if token.isdigit():
        return "number"
    if token.isupper():
        return "upper"
    if set(token) <= set("ivx"):
        if len(token) == 1 and before is not None and len(before) == 1 and ord(token) - ord(before) == 1:
            return "lower"
        if len(token) > 1 or token == "i":
            return "roman"
    return "lower"


def subsections(text: str | None) -> list[dict]:
    """Rows (path, depth, token, kind, text) of a text's marked parts.

    A marker of a higher level closes the deeper ones; text before the first
    marker is the root's (path ''). A repeated label under one parent goes on
    with the part it names."""
    text = text or ""
    marks = list(_MARK.finditer(text))
    head = text[: marks[0].start()] if marks else text
    rows: dict[str, dict] = {"": {"path": "", "depth": 0, "token": "", "kind": "root", "text": head.strip()}}
    stack: list[tuple[int, str]] = []
    before = None
    for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(text)]):
        token = m.group(1)
        kind = kind_of(token, before)
        level = _LEVEL[kind]
        while stack and stack[-1][0] >= level:
            stack.pop()
        path = "/".join([*(p for _, p in stack), token])
        stack.append((level, token))
        body = text[m.end() : end].strip()
        if path in rows:
            rows[path]["text"] = (rows[path]["text"] + " " + body).strip()
        else:
            rows[path] = {"path": path, "depth": len(stack), "token": token, "kind": kind, "text": body}
        before = token
    return list(rows.values())


_ROW = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("token", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()),
])


@F.pandas_udf(T.ArrayType(_ROW))
def _subsections(text: pd.Series) -> pd.Series:
    return text.map(subsections)


def subsection_tree(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and one row for each part of each text, flattened by path."""
    return docs.select(key, F.explode(_subsections(text)).alias("s")).select(key, "s.*")


def tree_issues(tree: DataFrame, key: str) -> DataFrame:
    """key, issue (distinct): empty parts, and parts that skip a number."""
    w = Window.partitionBy(key, "parent").orderBy("n")
    t = tree.where("depth > 0").withColumn("parent", F.regexp_replace("path", "/?[^/]*$", "")).withColumn("n", F.col("token").try_cast("int"))
    gap = t.where("kind = 'number'").withColumn("b", F.lag("n").over(w)).where("b is not null and n - b > 1").select(key, F.lit("gap").alias("issue"))
    empty = t.where("text = ''").select(key, F.lit("empty").alias("issue"))
    return gap.unionByName(empty).distinct()


def line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 1), line."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n", -1)).alias("p", "line")).select(key, (F.col("p") + 1).alias("line_no"), "line")


def segment(lines: DataFrame, key: str, start: str) -> DataFrame:
    """key, section (0: before the first), title, lines: a line that matches
    `start` opens a section, which lasts to the next such line."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("section", F.sum(F.when(F.col("line").rlike(start), 1).otherwise(0)).over(w))
    return marked.groupBy(key, "section").agg(F.min_by("line", "line_no").alias("title"), F.count("*").alias("lines"))
