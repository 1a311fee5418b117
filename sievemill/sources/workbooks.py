"""Workbooks (xlsx) as a Spark data source: ``spark.read.format("workbook")`` and ``df.write.format("workbook")``.

A workbook is a ZIP of XML parts. The reader makes a partition of each block of rows of each workbook that a path names (a file, a
folder or a pattern); a task streams the sheet's XML and gives the rows of its block, so that nothing passes through the driver
but the header. The writer makes a workbook, or several where a sheet is full, of each task's rows beside the folder's other
files; they are put in place when all tasks are done, and deleted if one fails.

Options of reading: ``path``; ``sheet``, a name or a number from 0; ``rows``, of a block; ``pos``, a column that numbers rows in the
order of files and rows. Without a schema all columns are texts. Options of writing: ``path``, a folder; ``links``, columns joined by
commas whose addresses become links; ``sheet``, its name; ``rows``, of a workbook at most.

Defined results: a cell that is absent is null, one with an empty text is an empty text; numbers are read as they are written, flags
as true and false, dates of foreign workbooks in ISO form by their cell style; formulas as their last value; a sheet without rows has
no columns; header cells that are blank or repeated are named by their place; rows that are blank to the end come as nulls.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import itertools
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "workbook"
#: Rows of a partition, and those of a workbook beside its header.
BLOCK = 65_536
MOST_ROWS = 1_048_575
#: Fixed value: links that a sheet can hold.
MOST_LINKS = 65_530
# Name spaces and relations of the format, and its built-in number formats that are dates.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
DATE_FORMATS = [*range(14, 23), *range(45, 48)]

_TAG = f"{{{MAIN}}}"
_LINK = re.compile(r"(?i)^https?://\S+$")
_BAD = re.compile("[\x00-\x08\x0b-\x1f\ud800-\udfff￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_CODED = re.compile("_x([0-9A-Fa-f]{4})_")


# ---- files


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"^[A-Za-z][\w+.-]*:", path) else (pafs.LocalFileSystem(), path)


def workbooks_at(path: str) -> list[str]:
    """The workbooks that a path names, in order, as paths of its file system."""
    system, own = file_system(path)
    if any(c in own for c in "*?["):
        folder = posixpath.dirname(own)
        found = system.get_file_info(pafs.FileSelector(folder))
        return sorted(f.path for f in found if f.is_file and fnmatch.fnmatch(f.base_name, posixpath.basename(own)))
    info = system.get_file_info(own)
    if info.type == pafs.FileType.File:
        return [own]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(pafs.FileSelector(own))
    return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".xlsx") and not f.base_name.startswith(("~", "_", ".")))


# ---- reading


def column_number(reference: str) -> int:
    """``AB7`` as 27."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def decoded(text: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


def _text_of(node) -> str:
    """The text of a string item: its runs in a row, without what is said of pronunciation."""
    return decoded("".join(t.text or "" for part in node if part.tag != f"{_TAG}rPh" for t in ([part] if part.tag == f"{_TAG}t" else part.iter(f"{_TAG}t"))))


class Book:
    """An open workbook."""

    def __init__(self, handle):
        self.zip = zipfile.ZipFile(handle)
        names = set(self.zip.namelist())
        relations = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        sheets = ElementTree.fromstring(self.zip.read("xl/workbook.xml")).iter(f"{_TAG}sheet")
        at = lambda target: target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        self.sheets = {s.get("name"): at(relations[s.get(f"{{{RELATIONS}}}id")]) for s in sheets}
        self.strings = self._strings() if "xl/sharedStrings.xml" in names else []
        self.dates = self._dates() if "xl/styles.xml" in names else []

    def _strings(self) -> list[str]:
        found = []
        with self.zip.open("xl/sharedStrings.xml") as f:
            for _, node in ElementTree.iterparse(f):
                if node.tag == f"{_TAG}si":
                    found.append(_text_of(node))
                    node.clear()
        return found

    def _dates(self) -> list[bool]:
        """Whether each cell style shows a date."""
        root = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        plain = lambda code: re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code).lower()
        own = {int(n.get("numFmtId")): bool(re.search("[dmyhs]", plain(n.get("formatCode", "")))) for n in root.iter(f"{_TAG}numFmt")}
        styles = root.find(f"{_TAG}cellXfs")
        return [own.get(k, k in DATE_FORMATS) for k in (int(x.get("numFmtId", 0)) for x in styles)] if styles is not None else []

    def sheet(self, which: str) -> str:
        if which in self.sheets:
            return self.sheets[which]
        if which.isdigit() and int(which) < len(self.sheets):
            return list(self.sheets.values())[int(which)]
        raise ValueError(f"there is no sheet {which}")

    def _value(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            own = cell.find(f"{_TAG}is")
            return None if own is None else _text_of(own)
        value = cell.find(f"{_TAG}v")
        if value is None:
            return None
        text = value.text or ""
        if kind == "s":
            return self.strings[int(text)]
        if kind == "b":
            return "true" if text == "1" else "false"
        if kind == "n" and text and (style := int(cell.get("s", 0))) < len(self.dates) and self.dates[style]:
            moment = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=round(float(text) * 86400, 3))
            return moment.isoformat(" ") if moment.time() != dt.time() else moment.date().isoformat()
        return decoded(text)

    def rows(self, which: str, first: int = 0, last: int | None = None) -> Iterator[tuple[int, dict[int, str]]]:
        """Number, from 0, and cells by column of a sheet's rows from ``first`` to before ``last``."""
        with self.zip.open(self.sheet(which)) as f:
            n, data = -1, None
            for event, node in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    if node.tag == f"{_TAG}sheetData":
                        data = node
                    continue
                if node.tag != f"{_TAG}row":
                    continue
                n = int(node.get("r")) - 1 if node.get("r") else n + 1
                if last is not None and n >= last:
                    return
                if n >= first:
                    cells, k = {}, -1
                    for cell in node:
                        k = column_number(cell.get("r")) if cell.get("r") else k + 1
                        if (value := self._value(cell)) is not None:
                            cells[k] = value
                    yield n, cells
                data.clear()


def header_names(cells: dict[int, str]) -> list[str]:
    """Names of the columns of a header row."""
    names: list[str] = []
    for k in range(max(cells, default=-1) + 1):
        name = cells.get(k, "")
        names.append(name if name.strip() and name not in names else f"_c{k}")
    return names


def parsed(text: str | None, kind: T.DataType):
    """A cell's text in a column's type; what does not fit is an error."""
    if text is None or isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return {"true": True, "false": False, "1": True, "0": False}[text.lower()]
    if isinstance(kind, T.IntegralType):
        whole = Decimal(text)
        if whole != int(whole):
            raise ValueError(f"{text} is no whole number")
        return int(whole)
    if isinstance(kind, T.DecimalType):
        return Decimal(text)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(text)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text[:10])
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(text)
    raise ValueError(f"no column of a workbook can be of the type {kind.simpleString()}")


@dataclass
class Block(InputPartition):
    """Rows of a workbook, its header being row 0."""

    file: int
    name: str
    first: int
    last: int


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.which, self.pos = options["path"], options.get("sheet", "0"), options.get("pos")
        self.size, self.schema = int(options.get("rows", BLOCK)), schema

    def partitions(self) -> list[Block]:
        system, _ = file_system(self.path)
        found = []
        for k, name in enumerate(workbooks_at(self.path)):
            with system.open_input_file(name) as f:
                n = last_row(Book(f), self.which)
            found += [Block(k, name, a, min(a + self.size, n + 1)) for a in range(1, n + 1, self.size)]
        return found or [Block(0, "", 0, 0)]

    def read(self, block: Block) -> Iterator[tuple]:
        if not block.name:
            return
        with file_system(self.path)[0].open_input_file(block.name) as f:
            book = Book(f)
            names = header_names(next((cells for n, cells in book.rows(self.which, 0, 1)), {}))
            at = {name: k for k, name in enumerate(names)}
            wanted = [(None if c.name == self.pos else at.get(c.name, -1), c.dataType) for c in self.schema]
            due = block.first
            for n, cells in itertools.chain(book.rows(self.which, block.first, block.last), [(block.last, {})]):
                for blank in range(due, n):  # rows that the sheet leaves out
                    yield tuple(block.file << 32 | blank - 1 if k is None else None for k, _ in wanted)
                due = n + 1
                if n < block.last:
                    yield tuple(block.file << 32 | n - 1 if k is None else parsed(cells.get(k), kind) for k, kind in wanted)


def last_row(book: Book, which: str) -> int:
    """The number of a sheet's last row, from 0: by what our writer notes in the file's comment or by the sheet's dimension, else by a
    look at its rows."""
    if noted := re.fullmatch(rb"rows=(\d+)", book.zip.comment):
        return int(noted[1]) - 1
    with book.zip.open(book.sheet(which)) as f:
        said = re.search(rb'<(?:\w+:)?dimension ref="[A-Z]+\d+:[A-Z]+(\d+)"', f.read(4096))
    if said:
        return int(said[1]) - 1
    return max((n for n, _ in book.rows(which)), default=0)


# ---- writing


def encoded(text: str) -> str:
    return escape(_BAD.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def column_name(k: int) -> str:
    name = ""
    while k >= 0:
        k, rest = k // 26 - 1, k % 26
        name = chr(65 + rest) + name
    return name


def cell_xml(value, reference: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, Decimal)) or isinstance(value, float) and value == value and abs(value) != float("inf"):
        return f'<c r="{reference}"><v>{value!r}</v></c>' if not isinstance(value, Decimal) else f'<c r="{reference}"><v>{value}</v></c>'
    text = value.isoformat(" ") if isinstance(value, dt.datetime) else value.isoformat() if isinstance(value, dt.date) else str(value)
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{encoded(text)}</t></is></c>'


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


class Sheet:
    """A workbook that is being written, row by row."""

    def __init__(self, sink, names: list[str], links: set[str], title: str):
        self.zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
        kinds = {"xl/workbook.xml": "sheet.main", "xl/worksheets/sheet1.xml": "worksheet"}
        parts = "".join(f'<Override PartName="/{p}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{k}+xml"/>' for p, k in kinds.items())
        self._part("[Content_Types].xml", f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{parts}</Types>')
        self._part("_rels/.rels", self._relations([("officeDocument", "xl/workbook.xml", "")]))
        self._part("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets><sheet name={quoteattr(title)} sheetId="1" r:id="rId1"/></sheets></workbook>')
        self._part("xl/_rels/workbook.xml.rels", self._relations([("worksheet", "worksheets/sheet1.xml", "")]))
        self.links, self.found, self.n, self.names = [name in links for name in names], [], 0, names
        self.sheet = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.sheet.write(f'{_HEAD}<worksheet xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheetData>'.encode())
        self.letters = [column_name(k) for k in range(len(names))]
        self.add(names)

    def _part(self, name: str, text: str) -> None:
        self.zip.writestr(name, _HEAD + text)

    @staticmethod
    def _relations(targets: list[tuple[str, str, str]]) -> str:
        rows = "".join(f'<Relationship Id="rId{k}" Type="{RELATIONS}/{kind}" Target={quoteattr(target)}{mode}/>' for k, (kind, target, mode) in enumerate(targets, 1))
        return f'<Relationships xmlns="{PACKAGE}/relationships">{rows}</Relationships>'

    def add(self, values) -> None:
        self.n += 1
        cells = [cell_xml(v, f"{c}{self.n}") for v, c in zip(values, self.letters, strict=True)]
        self.sheet.write(f'<row r="{self.n}">{"".join(cells)}</row>'.encode())
        if self.n > 1:
            for v, c, link in zip(values, self.letters, self.links, strict=True):
                if link and isinstance(v, str) and _LINK.match(v) and len(self.found) < MOST_LINKS:
                    self.found.append((f"{c}{self.n}", v))

    def close(self) -> None:
        links = "".join(f'<hyperlink ref="{ref}" r:id="rId{k}"/>' for k, (ref, _) in enumerate(self.found, 1))
        self.sheet.write(f"</sheetData>{f'<hyperlinks>{links}</hyperlinks>' if links else ''}</worksheet>".encode())
        self.sheet.close()
        if self.found:
            self._part("xl/worksheets/_rels/sheet1.xml.rels", self._relations([("hyperlink", url, ' TargetMode="External"') for _, url in self.found]))
        self.zip.comment = f"rows={self.n}".encode()
        self.zip.close()


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WorkbookWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.path, self.names, self.overwrite = options["path"], schema.names, overwrite
        self.links = {c.strip() for c in options.get("links", "").split(",") if c.strip()}
        self.title, self.most = options.get("sheet", "Sheet1"), min(int(options.get("rows", MOST_ROWS)), MOST_ROWS)
        self.job = f"_writing-{uuid.uuid4().hex}"

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, folder = file_system(self.path)
        system.create_dir(f"{folder}/{self.job}", recursive=True)
        files: list[str] = []
        sheet, sink = None, None

        def closed() -> None:
            sheet.close()
            sink.close()

        for row in rows:
            if sheet is None or sheet.n > self.most:
                if sheet is not None:
                    closed()
                files.append(f"part-{context.partitionId():05d}-{len(files):03d}-{self.job[9:17]}-{context.taskAttemptId()}.xlsx")
                sink = system.open_output_stream(f"{folder}/{self.job}/{files[-1]}")
                sheet = Sheet(sink, self.names, self.links, self.title)
            sheet.add(tuple(row))
        if sheet is not None:
            closed()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        files = [name for m in messages if m is not None for name in m.files]
        if not files:  # the header tells the columns
            files = [f"part-00000-000-{self.job[9:17]}.xlsx"]
            system.create_dir(f"{folder}/{self.job}", recursive=True)
            with system.open_output_stream(f"{folder}/{self.job}/{files[0]}") as sink:
                Sheet(sink, self.names, self.links, self.title).close()
        old = workbooks_at(self.path) if self.overwrite else []
        for name in files:
            system.move(f"{folder}/{self.job}/{name}", f"{folder}/{name}")
        for path in old:
            system.delete_file(path)
        system.delete_dir(f"{folder}/{self.job}")

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        if system.get_file_info(f"{folder}/{self.job}").type == pafs.FileType.Directory:
            system.delete_dir(f"{folder}/{self.job}")


class WorkbookSource(DataSource):
    """The data source ``workbook``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        path, names = self.options["path"], []
        system, _ = file_system(path)
        for name in workbooks_at(path)[:1]:
            with system.open_input_file(name) as f:
                names = header_names(next((cells for _, cells in Book(f).rows(self.options.get("sheet", "0"), 0, 1)), {}))
        pos = [T.StructField(self.options["pos"], T.LongType())] if self.options.get("pos") else []
        return T.StructType([*pos, *[T.StructField(c, T.StringType()) for c in names]])

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)


def read(spark: SparkSession, path: str, sheet: str | int = 0, pos: str | None = None, schema: T.StructType | str | None = None, rows: int = BLOCK) -> DataFrame:
    """A sheet of one or more workbooks as texts, or in the columns and types of a schema."""
    register(spark)
    options = {"sheet": str(sheet), "rows": str(rows), **({"pos": pos} if pos else {})}
    found = spark.read.format(FORMAT).options(**options)
    return (found if schema is None else found.schema(schema)).load(path)


def write(df: DataFrame, path: str, links: tuple[str, ...] = (), sheet: str = "Sheet1", overwrite: bool = True, rows: int = MOST_ROWS) -> None:
    """A folder of workbooks, at least one for each partition that has rows."""
    register(df.sparkSession)
    options = {"links": ",".join(links), "sheet": sheet, "rows": str(rows)}
    df.write.format(FORMAT).mode("overwrite" if overwrite else "append").options(**options).save(path)


def with_types(df: DataFrame) -> DataFrame:
    """Texts as numbers where all of a column's cells are: whole ones as long, others as double."""
    own = lambda c: F.col(f"`{c}`")
    tests = [F.struct(F.bool_and(own(c).try_cast("double").isNotNull() | own(c).isNull()).alias("number"), F.bool_and(own(c).rlike(r"^-?\d{1,18}$") | own(c).isNull()).alias("whole"), F.count(own(c)).alias("n")).alias(f"c{k}") for k, c in enumerate(df.columns)]
    if not tests:
        return df
    said = df.agg(*tests).first()
    kind = lambda r: "long" if r.n and r.whole else "double" if r.n and r.number else "string"
    return df.select(*[own(c).cast(kind(r)).alias(c) for c, r in zip(df.columns, said, strict=True)])
