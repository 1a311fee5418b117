"""A cursor search as a Spark data source, in a batch or as a stream, that asks for no page twice.

Every answer is kept as a file of its own in a folder that driver and executors share, before its rows are given: a task that is
lost, a query that is stopped and a stream that is restarted go on at the first page that was not answered. In a batch each year
window is a partition. As a stream, an offset says for each window how many pages were read; a page's cursor is in the answer before
it, so that every batch takes the next page of each window that has one, a page to a task.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .services import ARTICLE_COLUMNS, PAGE_SIZE, Transport, article_row, year_query

FORMAT = "harvest"
SCHEMA = T.StructType([T.StructField("pos", T.LongType()), T.StructField("year_window", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS]])
#: Positions of a window.
WINDOW = 10_000_000


class Answers:
    """Answers that were had, by window and page."""

    def __init__(self, folder: str):
        self.system, self.folder = pafs.FileSystem.from_uri(folder) if re.match(r"^[A-Za-z][\w+.-]*:", folder) else (pafs.LocalFileSystem(), folder)

    def _path(self, year: int, page: int) -> str:
        return f"{self.folder}/{year}/{page:07d}.json"

    def get(self, year: int, page: int) -> dict | None:
        path = self._path(year, page)
        if self.system.get_file_info(path).type != pafs.FileType.File:
            return None
        with self.system.open_input_stream(path) as f:
            return json.loads(f.read())

    def put(self, year: int, page: int, answer: dict) -> None:
        """Keep an answer: written beside its place, then renamed."""
        self.system.create_dir(f"{self.folder}/{year}", recursive=True)
        new = f"{self.folder}/{year}/_{uuid.uuid4().hex}"
        with self.system.open_output_stream(new) as f:
            f.write(json.dumps(answer).encode())
        self.system.move(new, self._path(year, page))

    def pages(self, year: int) -> int:
        """How many pages there are, from the first on."""
        found = self.system.get_file_info(pafs.FileSelector(f"{self.folder}/{year}", allow_not_found=True))
        return len([f for f in found if f.base_name.endswith(".json")])


@dataclass
class Window(InputPartition):
    """Pages of a year window; all that follow if ``last`` is null."""

    k: int
    year: int
    first: int
    last: int | None


class Search:
    """What is asked for, and how an answer leads to the next page."""

    def __init__(self, transport: Transport, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.transport, self.query = transport, options["query"]
        self.years = [int(y) for y in options["years"].split(",")]
        self.size = min(max(int(options.get("pagesize", PAGE_SIZE[1])), PAGE_SIZE[0]), PAGE_SIZE[1])
        self.most = int(options["most"]) if options.get("most") else None
        self.answers = Answers(options["path"])

    @staticmethod
    def found(answer: dict) -> list[dict]:
        return answer.get("resultList", {}).get("result", [])

    def after(self, year: int, page: int) -> str | None:
        """The cursor behind a page that was answered; none at the end: an empty page, no cursor, or one that came before."""
        answer = self.answers.get(year, page)
        cursor = answer.get("nextCursorMark")
        if not self.found(answer) or not cursor or cursor in answer["_before"] or self.most is not None and (page + 1) * self.size >= self.most:
            return None
        return cursor

    def page(self, year: int, page: int) -> dict | None:
        """A page's answer, asked for if it is not there; none behind the end."""
        had = self.answers.get(year, page)
        if had is not None:
            return had
        before, cursor = ([], "*") if page == 0 else (self.answers.get(year, page - 1)["_before"], self.after(year, page - 1))
        if cursor is None:
            return None
        answer = self.transport({"query": year_query(self.query, year), "cursorMark": cursor, "pageSize": self.size})
        self.answers.put(year, page, {**answer, "_before": [*before, cursor]})
        return self.answers.get(year, page)

    def rows(self, w: Window) -> Iterator[tuple]:
        page = w.first
        while w.last is None or page < w.last:
            answer = self.page(w.year, page)
            if answer is None:
                return
            for i, article in enumerate(self.found(answer)):
                if self.most is not None and page * self.size + i >= self.most:
                    return
                yield (w.k * WINDOW + page * self.size + i, w.year, *article_row(article))
            page += 1


class HarvestReader(DataSourceReader):
    def __init__(self, search: Search):
        self.search = search

    def partitions(self) -> list[Window]:
        return [Window(k, year, 0, None) for k, year in enumerate(self.search.years)]

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.search.rows(partition)


class HarvestStream(DataSourceStreamReader):
    def __init__(self, search: Search):
        self.search = search

    def initialOffset(self) -> dict:
        return {str(year): 0 for year in self.search.years}

    def latestOffset(self) -> dict:
        """For each window the pages that were answered, and the next one if there is one."""
        ahead = {}
        for year in self.search.years:
            n = self.search.answers.pages(year)
            ahead[str(year)] = n + (n == 0 or self.search.after(year, n - 1) is not None)
        return ahead

    def partitions(self, start: dict, end: dict) -> list[Window]:
        # a page that is not there yet needs the one before it: pages that are there go by themselves, new ones are single
        return [Window(k, year, page, page + 1) for k, year in enumerate(self.search.years) for page in range(start[str(year)], end[str(year)])]

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.search.rows(partition)


def source(transport: Transport) -> type[DataSource]:
    """The data source ``harvest`` over a transport. Options: ``path``, the folder of answers; ``query``; ``years``, joined by commas;
    ``pageSize``; ``most``, articles of a window at most."""

    class HarvestSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> T.StructType:
            return SCHEMA

        def reader(self, schema: T.StructType) -> HarvestReader:
            return HarvestReader(Search(transport, dict(self.options)))

        def streamReader(self, schema: T.StructType) -> HarvestStream:
            return HarvestStream(Search(transport, dict(self.options)))

    return HarvestSource


def options_of(query: str, years: list[int], page_size: int = PAGE_SIZE[1], most: int | None = None) -> dict[str, str]:
    return {"query": query, "years": ",".join(map(str, years)), "pageSize": str(page_size), **({"most": str(most)} if most is not None else {})}


def search_years(spark: SparkSession, transport: Transport, folder: str, query: str, years: list[int], most: int | None = None, page_size: int = PAGE_SIZE[1]):
    """Articles of every year window, with answers kept in ``folder``: a second read asks for nothing."""
    spark.dataSource.register(source(transport))
    return spark.read.format(FORMAT).options(**options_of(query, years, page_size, most)).load(folder)
