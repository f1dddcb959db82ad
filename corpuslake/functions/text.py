"""Text, field and score expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def norm(value: Column) -> Column:
    """Stripped of Unicode white space; null is ''."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)^\s+|\s+$", "")


def collapse(value: Column) -> Column:
    """norm, with each run of white space (no-break space, BOM) one space."""
    plain = F.translate(F.coalesce(value, F.lit("")), "﻿‘’“”", " ''\"\"")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def first_true(*values: Column) -> Column:
    """The first value that isn't empty, then stripped: '  ' wins and gives ''."""
    return norm(F.coalesce(*[F.nullif(v, F.lit("")) for v in values]))


def hits(text: Column, pattern: str, first: int | None = None) -> Column:
    """How often pattern occurs (in the first characters, if given)."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.regexp_extract_all(F.substring(t, 1, first) if first else t, F.lit(pattern), F.lit(0)))


def first_match(rules: list[tuple[str, Column]], default: Column | None = None) -> Column:
    """Name of the first rule that holds; else default (null)."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out.otherwise(default if default is not None else F.lit(None))


def weighted(rules: list[tuple[int, Column]]) -> Column:
    """Sum of the weights of the rules that hold (null: doesn't hold)."""
    return reduce(lambda a, b: a + b, [F.when(rule, w).otherwise(0) for w, rule in rules])


def join_parts(sep: str, *parts: Column, least: int = 1) -> Column:
    """Parts of at least `least` characters, joined."""
    return F.array_join(F.filter(F.array(*[norm(p) for p in parts]), lambda x: F.length(x) >= least), sep)


def html_title(html: Column) -> Column:
    """Text of <title>, without a ' - site' suffix; '' if there is none."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.regexp_replace(collapse(raw), r" [-|] [^-|]*$", "")


def seconds_left(at: Column, now: Column) -> Column:
    """Seconds from now to a timestamp, never negative; null without one."""
    return F.greatest(F.lit(0.0), (F.unix_micros(at) - F.unix_micros(now)) / 1e6)


def listed_states(issues: Column, prefix: str) -> Column:
    """Distinct upper-case codes after `prefix:` in an array of issues."""
    mine = F.filter(issues, lambda x: x.startswith(prefix + ":"))
    codes = F.flatten(F.transform(mine, lambda x: F.split(F.upper(F.split_part(x, F.lit(":"), F.lit(2))), ",")))
    return F.array_distinct(F.filter(codes, lambda c: c.rlike("^[A-Z]{2}$")))


def selected_states(values: list[str | None]) -> list[str]:
    """Distinct two-letter codes of repeated or comma-separated requests, in
    the order asked; what is no code is left out."""
    codes = [c.strip().upper() for v in values for c in (v or "").split(",")]
    return list(dict.fromkeys(c for c in codes if len(c) == 2 and c.isascii() and c.isalpha()))


def name_tokens(name: Column, stop: tuple[str, ...] = ("the", "of", "and", "for", "a")) -> Column:
    """Sorted distinct words of a name, without stop words."""
    words = F.filter(F.split(F.lower(name), r"[^a-z0-9]+"), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.array_except(words, F.array(*[F.lit(s) for s in stop]))))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalise(v: Column) -> Column:
    """v over its length; a zero vector stays zero."""
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0)))
