"""URL resolution and page-parameter expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_ORIGIN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*"


def _resolve_dots(path: Column) -> Column:
    """Remove '.', '..' and empty inner segments of an absolute path."""
    segments = F.filter(
        F.split(path, "/"), lambda s, i: (s != "") & (s != ".")
    )
    stack = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(path.rlike(r"(?:/|/\.{1,2})$") & (F.size(stack) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(stack, "/"), tail)


def url_join(base: Column, href: Column) -> Column:
    """Resolve a link against the page it was found on (RFC 3986 cases of links)."""
    origin = F.regexp_extract(base, _ORIGIN, 0)
    no_fragment = F.regexp_replace(base, "(?s)#.*$", "")
    no_query = F.regexp_replace(base, r"(?s)[?#].*$", "")
    base_path = F.regexp_replace(no_query, _ORIGIN, "")
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    href_path = F.regexp_extract(href, r"(?s)^[^?#]*", 0)
    href_rest = F.regexp_replace(href, r"(?s)^[^?#]*", "")
    rooted = F.when(href.startswith("/"), href_path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), href_path)
    )
    path = F.when(rooted.rlike(r"/\.{1,2}(?:/|$)|//"), _resolve_dots(rooted)).otherwise(rooted)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, path, href_rest))
    )


def page_url(base: Column, page: Column) -> Column:
    """Append a page parameter; an existing one is kept, not replaced."""
    sep = F.when(F.contains(base, F.lit("?")), "&page=").otherwise("?page=")
    return F.concat(base, sep, page.cast("string"))
