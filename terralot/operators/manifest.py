"""Small documents of a build: manifest patches, counts by département, newest editions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from copy import deepcopy

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zone_counts(index: DataFrame) -> DataFrame:
    """(dep, n) of an index of zones with a column `dep`."""
    return index.groupBy("dep").agg(F.count("*").alias("n"))


def extra_departments(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Départements of the index that the manifest doesn't list."""
    return index.select("dep").distinct().subtract(manifest.select("dep"))


def patched(manifest: dict, index: DataFrame, name: str = "iris") -> dict:
    """The manifest with an entry for the zones; everything else stays as it is, so a second patch changes nothing."""
    counts = {r["dep"]: r["n"] for r in zone_counts(index).collect()}  # as many rows as départements
    out = deepcopy(manifest)
    out[name] = {"count": sum(counts.values()), "departements": sorted(counts)}
    return out


EDITION = re.compile(r"(\d{4}-\d{2}-\d{2})")


def newest_edition(names: list[str], pattern: str = r".") -> str | None:
    """The name with the latest date in it, among those that match."""
    dated = [(m[1], n) for n in names if re.search(pattern, n) and (m := EDITION.search(n))]
    return max(dated)[1] if dated else None


def newer_than(known: str | None, found: str | None) -> int:
    """Exit code of the edition check: 10 if there is a newer one, else 0."""
    date = lambda s: m[1] if s and (m := EDITION.search(s)) else ""
    return 10 if date(found) > date(known) else 0


def load(source: str) -> dict:
    """A manifest from a file or an http(s) address."""
    if source.startswith(("http://", "https://")):
        from urllib.request import urlopen

        with urlopen(source, timeout=60) as f:
            return json.load(f)
    with open(source, encoding="utf-8") as f:
        return json.load(f)


LINK = re.compile(r'href="([^"]+)"')


def list_editions(fetch: Callable[[int], str], pattern: str, most_pages: int = 29) -> list[str]:
    """Links of a paginated feed that match, in the order met; `fetch` gives a page's text. Ends with the first page that brings nothing new."""
    found: dict[str, None] = {}
    for page in range(1, most_pages + 1):
        before = len(found)
        text = fetch(page)
        seen = LINK.findall(text)
        found |= dict.fromkeys(x for x in seen if re.search(pattern, x))
        if len(found) == before:
            break
    return list(found)


def edition_date(name: Column) -> Column:
    """The date at the end of an edition's name; empty without one."""
    return F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2})$", 1)


def editions(names: DataFrame, pattern: str) -> DataFrame:
    """(name, date) of the editions that match. Column: name."""
    return names.filter(F.col("name").rlike(pattern)).select("name", edition_date(F.col("name")).alias("date"))


def latest(names: DataFrame, pattern: str) -> DataFrame:
    """(name) of the latest edition that matches."""
    return editions(names, pattern).agg(F.max_by("name", F.struct("date", "name")).alias("name"))


def link(tag: Column) -> Column:
    """struct(href, length) of a feed's link tag; null where an attribute is missing."""
    found = lambda pattern: F.nullif(F.regexp_extract(tag, pattern, 1), F.lit(""))
    return F.struct(found(r'href="([^"]+)"').alias("href"), found(r'gpf_dl:length="(\d+)"').cast("long").alias("length"))
