"""A web address that answers with numbered JSON pages, read with one Spark partition per page."""

from __future__ import annotations

import json
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class _Page(InputPartition):
    pass


class _PageReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields = schema.fieldNames()
        self.url = options["url"]
        self.base = int(options.get("base_page", 1))
        self.timeout = float(options.get("timeout", 60))

    def fetch(self, number: int) -> list[dict]:
        with urlopen(self.url.format(page=number), timeout=self.timeout) as answer:
            return json.load(answer)

    def partitions(self) -> list[_Page]:
        """Pages before the first empty one.

        Paging means that nothing follows an empty page, so the end is found by doubling and halving:
        a few requests, whatever the number of pages.
        """
        if not self.fetch(self.base):
            return []
        full, step = self.base, 1
        while self.fetch(full + step):
            full, step = full + step, step * 2
        empty = full + step
        while empty - full > 1:
            middle = (full + empty) // 2
            if self.fetch(middle):
                full = middle
            else:
                empty = middle
        return [_Page(number) for number in range(self.base, empty)]

    def read(self, partition: _Page | None):
        if partition is None:  # what Spark hands over when there are no partitions
            return
        for record in self.fetch(partition.value):
            yield tuple(record.get(name) for name in self.fields)


class PagedJson(DataSource):
    """``spark.dataSource.register(PagedJson)``, then
    ``spark.read.format("paged_json").schema(...).option("url", "https://.../?page={page}").load()``."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self):
        raise ValueError("declare the schema: a page cannot type a column that is null throughout")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PageReader(schema, self.options)
