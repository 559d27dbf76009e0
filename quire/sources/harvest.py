"""OAI-PMH as a Spark data source: records of a paged list, walked by resumption tokens.

    spark.dataSource.register(OaiSource)
    spark.read.format("oai").option("url", "https://example.org/oai").option("prefix", "oai_dc").load()

``url`` may also be a folder of saved pages (``page1.xml``, ``page2.xml``, ...). A page that can't be
fetched or parsed ends the walk: what came before it stays, and the last row says why.
"""

from __future__ import annotations

import os
import time
import urllib.parse
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader

#: Pages of a list that are walked unless the option ``max_pages`` says otherwise; a longer list says so in its last row.
MAX_PAGES = 500


def fetch(url: str, page: int, token: str | None, prefix: str, timeout: float = 60.0) -> bytes:
    if os.path.isdir(url):
        with open(os.path.join(url, f"page{page}.xml"), "rb") as f:
            return f.read()
    query = {"verb": "ListRecords", "resumptionToken": token} if token else {"verb": "ListRecords", "metadataPrefix": prefix}
    with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(query)}", timeout=timeout) as r:
        return r.read()


def parse_page(xml: bytes) -> tuple[list[tuple[str | None, str]], str | None]:
    """(identifier, metadata XML) of the records and the resumption token; documents with a DTD are refused."""
    if b"<!DOCTYPE" in xml or b"<!ENTITY" in xml:
        raise ValueError("a page with a document type is not read")
    root = ET.fromstring(xml)
    records, token = [], None
    for e in root.iter():
        tag = e.tag.rpartition("}")[2]
        if tag == "record":
            ids = [x.text for x in e.iter() if x.tag.rpartition("}")[2] == "identifier"]
            records.append((ids[0] if ids else None, ET.tostring(e, encoding="unicode")))
        elif tag == "resumptionToken":
            token = (e.text or "").strip() or None
    return records, token


class OaiReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.prefix, self.delay = options["url"], options.get("prefix", "oai_dc"), float(options.get("delay", "0"))
        self.max_pages = int(options.get("max_pages", MAX_PAGES))

    def read(self, partition) -> Iterator[tuple]:
        token, seen = None, set()
        for page in range(1, self.max_pages + 1):
            try:
                records, token = parse_page(fetch(self.url, page, token, self.prefix))
            except (OSError, ValueError, ET.ParseError) as e:
                yield page, None, None, f"{type(e).__name__}: {e}"
                return
            for identifier, xml in records:
                if identifier is None or identifier not in seen:
                    seen.add(identifier)
                    yield page, identifier, xml, None
            if not token:
                return
            time.sleep(self.delay)
        yield self.max_pages, None, None, f"more than {self.max_pages} pages"


class OaiSource(DataSource):
    """Rows of ``page``, ``identifier``, ``xml`` and ``error``; one partition, as tokens come one after another."""

    @classmethod
    def name(cls) -> str:
        return "oai"

    def schema(self) -> str:
        return "page int, identifier string, xml string, error string"

    def reader(self, schema) -> DataSourceReader:
        return OaiReader(dict(self.options))
