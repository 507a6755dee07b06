"""Landed response pages as a Spark data source: ``spark.read.format("landed_pages")``.

A connector in Spark's Python Data Source API, and the pattern for others: any class of that API
can be named in a source spec (``type: connector``, see the registry) and is read by its format
name, in batch or as a stream.  Options:

* ``path``            a folder of JSON pages, any file system that pyarrow reaches;
* ``records_path``    dotted path of the records in a page (default: the page itself);
* ``number``          pattern of the page's number in a file's path (default: the last digits of its name);
* ``partition_bytes`` bytes of pages that one task reads (default 64 MB).

Rows are (_page, _page_pos, record): the page's number, the record's position and its JSON text.  The driver lists names and sizes only; pages are read by the tasks.  As a
stream, offsets are page numbers: a run reads the pages after the last one of the run before, so
pages have to be landed in the order of their numbers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "_page bigint, _page_pos bigint, record string"
PARTITION_BYTES = 64 << 20
NUMBER = r"(\d+)[^/\d]*$"


@dataclass
class Pages(InputPartition):
    files: list[tuple[int, str]]


def _file_system(path: str):
    from pyarrow import fs

    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class _Landing:
    """What the batch and the stream reader share: listing, dealing and reading pages."""

    def __init__(self, options: dict) -> None:
        if not options.get("path"):
            raise ValueError("landed_pages needs the option path")
        self.path = options["path"]
        self.steps = [s for s in (options.get("records_path") or "").split(".") if s]
        self.number = re.compile(options.get("number") or NUMBER)
        self.most = int(options.get("partition_bytes") or PARTITION_BYTES)

    def _pages(self) -> list[tuple[int, str, int]]:
        """(number, path, bytes) of every numbered file, by number."""
        from pyarrow import fs

        system, base = _file_system(self.path)
        found = []
        for entry in system.get_file_info(fs.FileSelector(base, recursive=True)):
            number = self.number.search(entry.path)
            if entry.type == fs.FileType.File and number and entry.base_name[0] not in "._":
                found.append((int(number[1]), entry.path, entry.size))
        return sorted(found)

    def _dealt(self, pages: list[tuple[int, str, int]]) -> list[Pages]:
        out, size = [], 0
        for number, path, length in pages:
            if not out or size + length > self.most:
                out.append(Pages([]))
                size = 0
            out[-1].files.append((number, path))
            size += length
        return out

    def read(self, partition: Pages) -> Iterator[tuple[int, int, str]]:
        system, _ = _file_system(self.path)
        for number, path in partition.files:
            with system.open_input_stream(path) as stream:
                records = json.loads(stream.read())
            for step in self.steps:
                if not isinstance(records, dict) or step not in records:
                    raise ValueError(f"page {path} lacks the records_path {'.'.join(self.steps)}")
                records = records[step]
            for position, record in enumerate(records if isinstance(records, list) else [records]):
                if not isinstance(record, dict):
                    raise ValueError(f"page {path} holds records that are not objects")
                yield number, position, json.dumps(record)


class _BatchReader(_Landing, DataSourceReader):
    def partitions(self) -> list[Pages]:
        return self._dealt(self._pages())


class _StreamReader(_Landing, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"after": -1}

    def latestOffset(self) -> dict:
        pages = self._pages()
        return {"after": pages[-1][0] if pages else -1}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self._dealt([p for p in self._pages() if start["after"] < p[0] <= end["after"]])

    def commit(self, end: dict) -> None:
        """Nothing to release: pages stay where they are."""


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)
