"""Host extraction from URLs, without a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host of an http(s) URL: optional user info is skipped, port and path end it.
# An address in brackets holds colons of its own.
LENIENT_HOST = r"^https?://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)"

# What each ``strip`` mode removes from a host.
STRIP_PATTERNS = {"prefix": r"^www\.", "anywhere": r"www."}


def unescape_url(url: Column) -> Column:
    """Percent-decode; a broken escape stays as written and ``+`` stays ``+``."""
    guarded = F.regexp_replace(url, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(F.regexp_replace(guarded, r"\+", "%2B"))


def lenient_host(url: Column) -> Column:
    """Host of a decoded http(s) URL; empty when there is none."""
    return F.regexp_extract(url, LENIENT_HOST, 1)


def strip_www(host: Column, strip: str | None) -> Column:
    return host if strip is None else F.regexp_replace(host, STRIP_PATTERNS[strip], "")


def domain_of(
    url: Column,
    encoded: bool = False,
    parser: str = "strict",
    strip: str | None = "prefix",
    lower: bool = False,
) -> Column:
    """Host of ``url`` with ``www.`` removed, or null.

    ``parser='strict'`` accepts what a URI parser accepts; ``'lenient'`` also
    takes hosts and paths with spaces, bare ``%``, underscores or non-ASCII
    letters.  ``strip`` removes ``www.`` at the start (``'prefix'``), wherever
    the pattern ``www.`` matches (``'anywhere'``), or not at all (``None``).
    """
    text = unescape_url(url) if encoded else url
    if parser == "strict":
        host = F.try_parse_url(text, F.lit("HOST"))
    elif parser == "lenient":
        host = F.nullif(lenient_host(text), F.lit(""))
    else:
        raise ValueError(f"unknown parser {parser!r}")
    if lower:
        host = F.lower(host)
    return strip_www(host, strip)
