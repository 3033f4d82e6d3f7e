"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dictionaries.fixed import TARGET_PATHS

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_url(website: Column) -> Column:
    """Trimmed; blank is NULL; ``http://`` put in front unless it starts with ``http``; no trailing slashes."""
    bare = _or_null(F.regexp_replace(website, r"^\s+|\s+$", ""))
    full = F.when(bare.startswith("http"), bare).otherwise(F.concat(F.lit("http://"), bare))
    return F.regexp_replace(full, "/+$", "")


def scheme(url: Column) -> Column:
    return _or_null(F.lower(F.regexp_extract(url, _SCHEME, 1)))


def authority(url: Column) -> Column:
    """Network location with user info and port, lower-cased; NULL if there is none."""
    return _or_null(F.lower(F.regexp_extract(url, _AUTHORITY, 1)))


def url_path(url: Column) -> Column:
    """Everything from the path on: path, query and fragment; at least ``/``."""
    rest = F.regexp_replace(F.regexp_replace(url, _SCHEME, ""), r"^//[^/?#]*", "")
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))


def unquote(text: Column) -> Column:
    """Percent escapes as characters; text with a broken escape stays as it is."""
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text.contains("%"), F.coalesce(decoded, text)).otherwise(text)


def _without_dots(url: Column) -> Column:
    """``.`` and ``..`` segments of the path resolved; ``..`` at the root is dropped. Query and fragment stay."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    rest = F.regexp_extract(F.substring(url, F.length(origin) + 1, F.length(url)), r"^([^?#]*)(.*)$", 2)
    path = F.regexp_extract(F.substring(url, F.length(origin) + 1, F.length(url)), r"^([^?#]*)", 1)
    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(
            F.array_append(acc, x)))
    last = F.element_at(parts, -1)
    kept = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    clean = F.concat(origin, F.lit("/"), F.array_join(kept, "/"), rest)
    return F.when((origin != "") & path.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(url)


def resolve_url(base: Column, href: Column) -> Column:
    """Target of a link found on ``base``.

    Absolute URLs stay; ``//host/x`` takes the scheme; ``/x`` replaces the path; ``?q`` and ``#f`` replace query and
    fragment; an empty link is the page without its fragment; anything else replaces the last path segment. Dot segments of
    a link that is not absolute are resolved.
    """
    no_fragment = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.concat(origin, F.regexp_extract(F.substring(no_query, F.length(origin) + 1, F.length(base)), "^(.*/)", 1))
    return _without_dots_unless(href.rlike(_SCHEME), (
        F.when(F.coalesce(href, F.lit("")) == "", no_fragment)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(F.length(folder) == F.length(origin), F.concat(origin, F.lit("/"), href))
        .otherwise(F.concat(folder, href))
    ))


def _without_dots_unless(absolute: Column, url: Column) -> Column:
    return F.when(absolute | ~url.contains("/."), url).otherwise(_without_dots(url))


def target_urls(website: Column) -> Column:
    """The candidate page URLs of a site: its own address, then the fixed paths."""
    return F.array(*[resolve_url(website, F.lit(p)) for p in TARGET_PATHS])


def is_external(link: Column, site: Column, mode: str = "domain") -> Column:
    """``http`` links that leave the site.

    ``domain``: the link's host is neither the site (leading ``www.`` aside) nor below it. ``substring``: the site's
    authority does not occur in the link's authority, which is the older, looser rule.
    """
    host = F.coalesce(authority(link), F.lit(""))
    own = F.lower(site)
    if mode == "substring":
        inside = host.contains(own)
    elif mode == "domain":
        bare_host, bare_own = F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(own, r"^www\.", "")
        inside = (bare_host == bare_own) | bare_host.endswith(F.concat(F.lit("."), bare_own))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    inside = F.coalesce(inside & (own != ""), F.lit(False))
    return link.startswith("http") & ~inside


def crawl_delay(robots: Column) -> Column:
    """The last ``crawl-delay`` number in a robots text, whichever agent it is for; NULL if the last is no number."""
    found = F.regexp_extract_all(robots, F.lit(r"(?i)crawl-delay[^\S\r\n]*:[^\S\r\n]*([0-9.]+)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).try_cast("double")
