"""Page features by patterns first; recursive JSON-LD by an Arrow batch walk."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Fixed schema.org types that describe an organisation.
ORGANISATION_TYPES = ("Organization", "Corporation", "LocalBusiness", "NGO", "EducationalOrganization")
LIMIT = 20  # organisations taken from one page
#: Fixed marks of technologies.
TECHNOLOGIES = {"wordpress": "wp-content", "shopify": "cdn.shopify.com", "wix": "static.wixstatic.com", "react": "data-reactroot", "google_analytics": "google-analytics.com", "gtm": "googletagmanager.com"}


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>([^<]*)</title>", 1))


def links(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?i)<a [^>]*href="([^"]*)"'), F.lit(1))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\s+", " "))


def is_shell(html: Column) -> Column:
    """Little text and two or more external scripts."""
    scripts = F.regexp_count(F.coalesce(html, F.lit("")), F.lit(r"(?i)<script[^>]+src"))
    return (F.length(visible_text(html)) < 100) & (scripts >= 2)


def technologies(html: Column) -> Column:
    h = F.lower(F.coalesce(html, F.lit("")))
    return F.array_compact(F.array(*(F.when(F.contains(h, F.lit(m)), F.lit(k)) for k, m in TECHNOLOGIES.items())))


def sitemap_urls(xml: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


_BLOCK = re.compile(r"<script[^>]*application/ld\+json[^>]*>(.*?)</script>", re.I | re.S)


def _walk(node, found: list) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            kinds = x.get("@type")
            kinds = kinds if isinstance(kinds, list) else [kinds]
            if any(k in ORGANISATION_TYPES for k in kinds) and x.get("name"):
                found.append(str(x["name"]))
            stack += reversed(list(x.values()))
        elif isinstance(x, list):
            stack += reversed(x)


def json_ld_organisations(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, names): organisation names anywhere in a page's JSON-LD blocks."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            names = []
            for text in b.column("html").to_pylist():
                found: list[str] = []
                for block in _BLOCK.findall(text or ""):
                    try:
                        _walk(json.loads(block), found)
                    except ValueError:
                        continue
                names.append(found[:LIMIT])
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(names, pa.list_(pa.string()))], [key, "names"])

    return pages.select(F.col(key), F.col(html).alias("html")).mapInArrow(run, f"`{key}` {kind}, names array<string>")
