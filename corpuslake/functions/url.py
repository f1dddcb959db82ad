"""URL and host expressions; all are plain columns and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def host_rev(host: Column) -> Column:
    """Labels in reverse order, comma-joined: a.example.gov -> gov,example,a."""
    labels = F.filter(F.split(F.lower(host), r"\."), lambda x: x != "")
    return F.array_join(F.reverse(labels), ",")


def authority(url: Column) -> Column:
    """What stands between the scheme and the path, '' if there is no scheme."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)


def domain(url: Column) -> Column:
    """Lower-cased authority without leading www.; port and user stay."""
    return F.regexp_replace(F.lower(authority(url)), r"^www\.", "")


def host(url: Column) -> Column:
    """Domain without port and user."""
    return F.regexp_replace(F.regexp_replace(domain(url), r"^.*@", ""), r":\d*$", "")


def plain_domain(url: Column) -> Column:
    """Host of http(s) URLs by pattern, as written; '' on a miss."""
    return F.regexp_extract(url, r"https?://([^/:]+)", 1)


def typed_domain(text: Column) -> Column:
    """A domain as people type it: scheme, www., path and blanks dropped."""
    bare = F.regexp_replace(F.lower(F.trim(text)), r"^[a-z]+://", "")
    return F.regexp_replace(F.split_part(bare, F.lit("/"), F.lit(1)), r"^www\.", "")


def origin(url: Column) -> Column:
    """Scheme and host only, lower case, with one slash; '' if there is none."""
    got = F.regexp_extract(F.lower(url), r"^(https?://[^/?#]+)", 1)
    return F.when(got == "", "").otherwise(F.concat(got, F.lit("/")))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def seed(url: Column) -> Column:
    """A crawl seed: no query or fragment, no doubled or trailing slash."""
    path = F.regexp_replace(without_query(url), r"([^:/])/{2,}", "$1/")
    return F.regexp_replace(path, r"/+$", "")


def registrable(host_: Column) -> Column:
    """The last two labels, the last three under .us."""
    labels = F.split(host_, r"\.")
    n = F.when(host_.endswith(".us"), 3).otherwise(2)
    return F.array_join(F.slice(labels, -F.least(n, F.size(labels)), F.least(n, F.size(labels))), ".")


def path_safe(name: Column) -> Column:
    return F.regexp_replace(name, r"[^a-zA-Z0-9._-]", "_")


def slug(name: Column) -> Column:
    """Lower case, runs of other characters one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def last_segment_title(url: Column) -> Column:
    """The last path segment as a title: URL-decoded, words capitalised."""
    seg = F.regexp_extract(without_query(url), r"/([^/]+)/?$", 1)
    return F.initcap(F.regexp_replace(F.url_decode(seg), r"[-_]+", " "))


def shard(url: Column, n: int) -> Column:
    """Stable shard: the first 8 bytes of the SHA-256, big-endian, mod n."""
    if n <= 1:
        return F.lit(0)
    return (F.conv(F.substring(F.sha2(url, 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(n)).cast("int")


def find_urls(text: Column) -> Column:
    """All http(s) URLs of a free text, as an array."""
    return F.regexp_extract_all(text, F.lit(r"https?://[^\s,;]+"), F.lit(0))


def crawl_year(collection: Column) -> Column:
    """Year of a crawl id such as CC-MAIN-2019-25; null if it has none."""
    return F.try_element_at(F.split(collection, "-"), F.lit(3)).try_cast("int")


def within(host_rev_: Column, domain_: str) -> Column:
    """A domain and all its subdomains, as a predicate that scans push down.

    An empty domain matches nothing."""
    bare = domain_.strip().lower().removeprefix("www.")
    if not bare:
        return F.lit(False)
    prefix = ",".join(reversed([x for x in bare.split(".") if x]))
    return (host_rev_ == prefix) | host_rev_.startswith(prefix + ",")
