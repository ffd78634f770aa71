"""Urls and HTML as Columns: canonical forms, parts, and the plain text of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtrace.functions.suffixes import suffix_labels


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#:]*)", 1))


def with_scheme(url: Column) -> Column:
    """The url, with ``http://`` in front if it has no scheme."""
    return F.when(url.rlike(r"^[A-Za-z][\w+.-]*://"), url).otherwise(F.concat(F.lit("http://"), url))


def registered_name(host: Column) -> Column:
    """A host without its public suffix, and without a ``www`` that is all its subdomain; a host that is a suffix stays."""
    labels = F.split(host, r"\.")
    kept = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - suffix_labels(labels), F.lit(1)))
    lone = (F.size(kept) == 2) & (F.get(kept, F.lit(0)) == "www")
    return F.array_join(F.when(lone, F.slice(kept, 2, 1)).otherwise(kept), ".")


def compare_form(url: Column, full: bool = True) -> Column:
    """What two urls must share to count as one: no public suffix, no lone ``www``, no root slash; null for null.

    Without ``full`` the parameters, the query and the fragment do not count either.
    """
    whole = with_scheme(url)
    scheme = F.lower(F.regexp_extract(whole, r"^([A-Za-z][\w+.-]*)://", 1))
    path = F.regexp_extract(whole, r"://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(whole, r"://[^?#]*([?#].*)?$", 1) if full else F.lit("")
    if not full:
        path = F.regexp_replace(path, ";[^/]*$", "")
    return F.concat(scheme, F.lit("://"), registered_name(_host(whole)), F.when(path == "/", "").otherwise(path), rest)


def query_value(url: Column, key: str) -> Column:
    """The first value of a key of the query, decoded; empty where there is none."""
    raw = F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1)
    return F.try_url_decode(raw)


def path_part(url: Column, index: int) -> Column:
    """Part ``index`` of a url split at slashes, from 0 or from the end, without its query; null beyond the parts."""
    parts = F.split(url, "/")
    return F.regexp_replace(F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index)), r"\?.*$", "")


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"\?[^#]*", "")


def html_text(html: Column) -> Column:
    """The words of a page: no scripts, styles or tags, with the five basic entities read."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))


def html_attributes(html: Column, tag: str, attribute: str) -> Column:
    """The values of an attribute of all elements with a tag, in order."""
    return F.regexp_extract_all(html, F.lit(rf'(?is)<{tag}\b[^>]*?\b{attribute}="([^"]*)"'), 1)
