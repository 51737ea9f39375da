"""URL columns: host, domain by pattern, top-level domain, link clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DOMAIN_PATTERN, HTTP_URL

# scheme, optional user info, host (or a bracketed IPv6 address), optional
# port; what follows has to be a path, a query, a fragment or the end.
_HOST = (
    r"^https?://(?:[^/?#@]*@)?"
    r"(\[[^\]/?#]*\]|[^:/?#@\[]*)"
    r"(?::\d{0,9})?(?:[/?#]|$)"
)


def is_http(url: Column | str) -> Column:
    """True for absolute http and https URLs (lower-case scheme)."""
    return _col(url).rlike(HTTP_URL)


def unify_scheme(url: Column | str) -> Column:
    """Write https URLs as http, so that both count as the same site."""
    return F.regexp_replace(_col(url), HTTP_URL, "http://")


def url_host(url: Column | str) -> Column:
    """Host of an http(s) URL, "" when the URL has none or is malformed."""
    return F.regexp_extract(_col(url), _HOST, 1)


def domain_pattern(url: Column | str) -> Column:
    """Domain by the loose pattern: first match of it anywhere in the URL.

    The pattern opens with a negated character class, so it loses leading
    letters such as h, t, p and s of a host ("hello.com" gives "ello.com").
    Use `url_host` to join with ranks.
    """
    return F.regexp_extract(_col(url), DOMAIN_PATTERN, 0)


def top_level_domain(host: Column | str) -> Column:
    """Last label of a host: "www.bbc.co.uk" gives "uk"."""
    return F.substring_index(_col(host), ".", -1)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
