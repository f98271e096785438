"""Paths of a site's slice from a paged search service, as a data source of Spark.

    spark.dataSource.register(PagedSearch)
    spark.read.format("paged_search").option("url", ...).option("query", ...).option("max_pages", 300).load()
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader

#: Fixed value: results asked for at once; the next call always starts this much later.
PAGE_SIZE = 100


class PagedSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "base_path string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    """One task: a call's size depends on what the earlier ones gave, and the service asks for a delay between calls."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def read(self, partition) -> Iterator[tuple[str]]:
        get = lambda k, default: self.options.get(k, default)
        most, start, n = int(get("max_pages", "300")), 0, 0
        while n < most:
            asked = urllib.parse.urlencode({"q": get("query", ""), "count": min(PAGE_SIZE, most - n), "start": start, "fields": "link"})
            with urllib.request.urlopen(f"{self.options['url']}?{asked}", timeout=30) as answer:
                results = json.load(answer).get("results", [])
            if not results:
                return
            for row in results:
                if (link := row.get("link", "")).startswith("/"):
                    n += 1
                    yield (link,)
            start += PAGE_SIZE
            time.sleep(float(get("delay", "1.0")))


def slice_paths(found: DataFrame, max_pages: int) -> DataFrame:
    """Distinct base_path in order, the first ``max_pages``."""
    return found.select("base_path").distinct().orderBy("base_path").limit(max_pages)
