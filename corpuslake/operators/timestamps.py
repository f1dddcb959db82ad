"""Timestamps of many formats and zones as one UTC instant.

One regex alternation with named groups recognises every format; the matched
parts are taken out in a single vectorised pass over Arrow batches, checked
against the calendar and put together with integer day arithmetic. Zone rules
are applied once for each zone of a batch, not for each value.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

# The English names that the formats use and their meaning.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_MINUTES = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}

_CLOCK = r"(?P<{p}h>\d{{1,2}}):(?P<{p}n>\d{{2}})(?::(?P<{p}s>\d{{2}})(?:[.,](?P<{p}f>\d{{1,12}}))?)?"
_ZONE = r"(?P<{p}z>[Zz]|[A-Za-z]{{2,4}}|[+-]\d{{2}}(?::?\d{{2}})?)"
_MON = "(?:%s)[a-z]*" % "|".join(MONTHS)


def _formats() -> list[tuple[str, str]]:
    clock, zone = (lambda p: _CLOCK.format(p=p)), (lambda p: _ZONE.format(p=p))
    return [
        # 2024-07-04T07:48:52.96+00:00[UTC], 2024-07-04 07:48 -0800, 2024-07-04
        ("a", rf"(?P<ay>\d{{4}})-(?P<am>\d{{1,2}})-(?P<ad>\d{{1,2}})(?:[Tt ]{clock('a')}(?: ?{zone('a')})?(?:\[(?P<ai>[A-Za-z0-9_+\-/]+)\])?)?"),
        # 10/25/2023 07:02:51 AM EST
        ("b", rf"(?P<bm>\d{{1,2}})/(?P<bd>\d{{1,2}})/(?P<by>\d{{4}})(?:,? +{clock('b')}(?: ?(?P<bp>[AaPp])\.?[Mm]\.?)?(?: ?{zone('b')})?)?"),
        # Sun, 24 Dec 2023 22:28:44 GMT
        ("c", rf"(?:[A-Za-z]{{3,9}},? +)?(?P<cd>\d{{1,2}})[ -](?P<cm>{_MON})[ -](?P<cy>\d{{4}})(?: +{clock('c')}(?: ?{zone('c')})?)?"),
        # Dec 11, 2023 8:55:38 PM EST
        ("d", rf"(?P<dm>{_MON})\.? +(?P<dd>\d{{1,2}}),? +(?P<dy>\d{{4}})(?:,? +{clock('d')}(?: ?(?P<dp>[AaPp])\.?[Mm]\.?)?(?: ?{zone('d')})?)?"),
        # 20240605T123803Z
        ("e", rf"(?P<ey>\d{{4}})(?P<em>\d{{2}})(?P<ed>\d{{2}})[Tt](?P<eh>\d{{2}})(?P<en>\d{{2}})(?P<es>\d{{2}})?(?:[.,](?P<ef>\d{{1,12}}))?(?: ?{zone('e')})?"),
        # 1737018574, 1734554414472, 1738733350409373, 1727307737.237
        ("u", r"(?P<us>\d{10})(?:\.(?P<uf>\d{1,12}))?"),
        ("v", r"(?P<vs>\d{13})"),
        ("w", r"(?P<ws>\d{16})"),
    ]


#: A capture time cut short: the parts left out are the earliest possible.
_CAPTURE = ("k", r"(?P<ky>199\d|20\d\d|2100)(?:(?P<km>\d{2})(?:(?P<kd>\d{2})(?:(?P<kh>\d{2})(?:(?P<kn>\d{2})(?P<ks>\d{2})?)?)?)?)?")

_PARTS = "ymdhnsfzip"
_SECOND, _SPAN = 1_000_000, 15 * 60 * 1_000_000


def compiled(capture: bool) -> str:
    """The alternation of every format; group names are a format's letter and
    the part's: y m d h n s f(raction) z(one) i(region) p(am or pm)."""
    formats = [_CAPTURE, *_formats()] if capture else _formats()
    return "(?i)^(?:%s)$" % "|".join(rx for _, rx in formats)


def _column(groups: pa.StructArray, names: list[str]) -> pa.Array:
    """The one of the groups that took part, or an empty text."""
    have = [groups.field(i) for i, f in enumerate(groups.type) if f.name in names]
    out = pc.fill_null(have[0], "")
    for more in have[1:]:
        out = pc.if_else(pc.equal(out, ""), pc.fill_null(more, ""), out)
    return out


def _ints(text: pa.Array, blank: int) -> np.ndarray:
    text = pc.if_else(pc.match_substring_regex(text, "^[0-9]+$"), text, str(blank))
    return pc.cast(text, pa.int64()).to_numpy(zero_copy_only=False)


def _micro(text: pa.Array) -> np.ndarray:
    return _ints(pc.utf8_rpad(pc.utf8_slice_codeunits(text, 0, 6), 6, "0"), 0)


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 in the Gregorian calendar, all in integers."""
    y = y - (m <= 2)
    era = y // 400
    of_era = y - era * 400
    of_year = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + of_era * 365 + of_era // 4 - of_era // 100 + of_year - 719468


def instants(values: pa.Array, zones: pa.Array | None, before: pa.Array | None, pattern: str, capture: bool) -> pa.Array:
    """Microseconds since the epoch of each value; null where it is none."""
    size = len(values)
    got = pc.extract_regex(pc.utf8_trim_whitespace(pc.cast(values, pa.string())), pattern)
    matched = pc.is_valid(got).to_numpy(zero_copy_only=False)
    text = {k: _column(got, [t + k for t in "kabcde"]) for k in _PARTS}
    epoch = {k: _column(got, [k]) for k in ("us", "uf", "vs", "ws")}

    month = pc.utf8_lower(pc.utf8_slice_codeunits(text["m"], 0, 3))
    named = pc.fill_null(pc.index_in(month, pa.array(MONTHS)), -1).to_numpy(zero_copy_only=False) + 1
    blank = lambda k: pc.equal(text[k], "").to_numpy(zero_copy_only=False)
    y, d = _ints(text["y"], 0), _ints(text["d"], 1)
    m = np.where(named > 0, named, _ints(text["m"], 1))
    h, n, s = _ints(text["h"], 0 if capture else -1), _ints(text["n"], 0), _ints(text["s"], 0)
    half = pc.utf8_lower(text["p"])
    pm, twelve = pc.equal(half, "p").to_numpy(zero_copy_only=False), ~blank("p")
    h = np.where(twelve, np.where((h >= 1) & (h <= 12), h % 12 + 12 * pm, -1), h)
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = np.where(m == 2, 28 + leap, np.where(np.isin(m, (4, 6, 9, 11)), 30, 31))
    valid = matched & (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= last) & (h >= 0) & (h <= 23) & (n <= 59) & (s <= 59)
    civil = (((_days(y, m, d) * 24 + h) * 60 + n) * 60 + s) * _SECOND + _micro(text["f"])

    out, ok = np.zeros(size, np.int64), np.zeros(size, bool)
    for part, scale, extra in (("us", _SECOND, _micro(epoch["uf"])), ("vs", 1000, 0), ("ws", 1, 0)):
        is_it = matched & pc.not_equal(epoch[part], "").to_numpy(zero_copy_only=False)
        out, ok = np.where(is_it, _ints(epoch[part], 0) * scale + extra, out), ok | is_it

    zone, region = pc.utf8_lower(text["z"]), text["i"]
    signed = pc.match_substring_regex(zone, "^[+-]").to_numpy(zero_copy_only=False)
    digits = pc.replace_substring(pc.utf8_slice_codeunits(zone, 1, 9), ":", "")
    zh, zm = _ints(pc.utf8_slice_codeunits(digits, 0, 2), 99), _ints(pc.utf8_slice_codeunits(digits, 2, 4), 0)
    minus = pc.starts_with(zone, "-").to_numpy(zero_copy_only=False)
    known = pc.index_in(zone, pa.array(list(ZONE_MINUTES)))
    minutes = np.array([*ZONE_MINUTES.values(), 0])[pc.fill_null(known, len(ZONE_MINUTES)).to_numpy(zero_copy_only=False)]
    minutes = np.where(signed, np.where(minus, -1, 1) * (zh * 60 + zm), minutes)
    fixed = valid & ~blank("z") & np.where(signed, (zh <= 18) & (zm <= 59), pc.is_valid(known).to_numpy(zero_copy_only=False))
    out, ok = np.where(fixed, civil - minutes * 60 * _SECOND, out), ok | fixed

    bare = valid & blank("z")
    if bare.any():
        local = zones if zones is not None else pa.array(["UTC"] * size)
        where = pc.if_else(pc.equal(region, ""), local, region)
        end = pc.cast(pc.cast(before, pa.timestamp("us", "UTC")), pa.int64()) if before is not None else None
        for name in pc.unique(where.filter(pa.array(bare))).drop_null().to_pylist():
            rows = np.flatnonzero(bare & pc.fill_null(pc.equal(where, name), False).to_numpy(zero_copy_only=False))
            clock = pa.array(civil[rows]).cast(pa.timestamp("us"))
            try:
                first, second = (
                    pc.assume_timezone(clock, name, ambiguous=which, nonexistent="earliest") for which in ("earliest", "latest")
                )
            except (pa.ArrowInvalid, pa.ArrowException):
                continue  # no such zone
            there = pc.equal(pc.local_timestamp(first), clock).to_numpy(zero_copy_only=False)
            a, b = (x.cast(pa.int64()).to_numpy(zero_copy_only=False) for x in (first, second))
            if end is not None:
                stop = end.take(pa.array(rows))
                stop, given = pc.fill_null(stop, 0).to_numpy(zero_copy_only=False), pc.is_valid(stop).to_numpy(zero_copy_only=False)
                fits = lambda us: given & (stop - us >= 0) & (stop - us <= _SPAN)  # noqa: E731, B023
                a = np.where(fits(b) & ~fits(a), b, a)
            out[rows], ok[rows] = a, there
    return pa.array(out, mask=~ok)


def _batches(batches, value: str, zone: str | None, before: str | None, pattern: str, capture: bool, out: str):
    for b in batches:
        col = lambda name: b.column(b.schema.get_field_index(name)) if name else None  # noqa: E731, B023
        yield b.append_column(out, instants(col(value), col(zone), col(before), pattern, capture))


def normalise(df: DataFrame, value: str, out: str, zone: str | None = None, before: str | None = None, capture: bool = False) -> DataFrame:
    """df with out: microseconds since the epoch (UTC), or null for no instant.

    zone: the column with the region name for values without a zone (null or
    unknown: the value names no instant); UTC where none is named. In an hour
    that occurs twice the first reading is taken, or, given before (a
    timestamp column), the reading at most fifteen minutes before it if there
    is one. Local times that the clock skips, impossible dates, unknown zones,
    blank and null values give null. Digits finer than a microsecond are cut
    off. With capture, 4 to 14 digits that begin with a year from 1990 to 2100
    are a date cut short, and a date without a clock is its first instant;
    without it such a value names no instant. Other columns pass through; a
    column named out must not exist yet. No shuffle.
    """
    if out in df.columns:
        raise ValueError(f"{out} exists")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    run = partial(_batches, value=value, zone=zone, before=before, pattern=compiled(capture), capture=capture, out=out)
    return df.mapInArrow(run, schema)
