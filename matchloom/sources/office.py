"""Workbooks and documents (zipped XML) as Spark sources, and workbooks and single CSV files as sinks with a commit.

    spark.dataSource.register(WorkbookSource)
    spark.read.format("workbook").option("header", 2).load("file:///in/*.xlsx")
    df.write.format("workbook").option("sheet", "region").mode("overwrite").save("file:///out/result.xlsx")

Files are opened by Arrow's file systems, so a path is a URI of any store that these know (plain paths: this machine's).
"""

from __future__ import annotations

import csv
import datetime
import fnmatch
import io
import posixpath
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, Row, StringType, StructField, StructType, TimestampNTZType, TimestampType

# Names and numbers of the published formats (Office Open XML).
SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINK_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES_NS = "http://schemas.openxmlformats.org/package/2006/content-types"
TEXT_NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
#: Built-in number formats that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
FORBIDDEN_IN_SHEET_NAMES, LONGEST_SHEET_NAME = r"[\[\]:*?/\\]", 31

#: Rows that types are told from where no schema is given.
SAMPLE_ROWS = 100
EPOCH, EPOCH_1904 = datetime.datetime(1899, 12, 30), datetime.datetime(1904, 1, 1)
Cell = str | float | bool | datetime.datetime | None


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def found(path: str, suffix: str) -> list[str]:
    """The files of a path, folder or pattern, as names in its store."""
    store, name = opened(path)
    if any(c in posixpath.basename(name) for c in "*?["):
        listed = store.get_file_info(fs.FileSelector(posixpath.dirname(name)))
        return sorted(f.path for f in listed if f.type == fs.FileType.File and fnmatch.fnmatch(posixpath.basename(f.path), posixpath.basename(name)))
    info = store.get_file_info(name)
    if info.type == fs.FileType.Directory:
        return sorted(f.path for f in store.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.File and f.path.endswith(suffix))
    if info.type != fs.FileType.File:
        raise FileNotFoundError(path)
    return [name]


def elements(stream, *tags: str) -> Iterator[ElementTree.Element]:
    """Whole elements of these names, as they end; what is read is let go, so memory is that of one element."""
    path: list[ElementTree.Element] = []
    for event, e in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            path.append(e)
        else:
            path.pop()
            if e.tag in tags:
                yield e
                e.clear()
                if path:
                    path[-1].remove(e)


class Workbook:
    """One workbook: its sheets, and their rows as they are read."""

    def __init__(self, handle):
        self.zip = zipfile.ZipFile(handle)
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        links = ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in links.iter(f"{{{PACKAGE_NS}}}Relationship")}
        place = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        self.sheets = {s.get("name"): place(target[s.get(f"{{{LINK_NS}}}id")]) for s in book.iter(f"{{{SHEET_NS}}}sheet")}
        properties = book.find(f"{{{SHEET_NS}}}workbookPr")
        self.epoch = EPOCH_1904 if properties is not None and properties.get("date1904") in ("1", "true") else EPOCH
        self.is_date = self._date_styles()
        self._shared: list[str] | None = None

    def _date_styles(self) -> list[bool]:
        if "xl/styles.xml" not in self.zip.namelist():
            return []
        styles = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{{{SHEET_NS}}}numFmt")}
        shows = lambda code: bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code), re.I))
        formats = styles.find(f"{{{SHEET_NS}}}cellXfs")
        return [(n := int(x.get("numFmtId", 0))) in DATE_FORMATS or n in own and shows(own[n]) for x in (formats if formats is not None else [])]

    @property
    def shared(self) -> list[str]:
        if self._shared is None:
            self._shared = []
            if "xl/sharedStrings.xml" in self.zip.namelist():
                with self.zip.open("xl/sharedStrings.xml") as stream:
                    self._shared = ["".join(t.text or "" for t in e.iter(f"{{{SHEET_NS}}}t")) for e in elements(stream, f"{{{SHEET_NS}}}si")]
        return self._shared

    def value(self, c: ElementTree.Element) -> Cell:
        kind, v = c.get("t", "n"), c.find(f"{{{SHEET_NS}}}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{{{SHEET_NS}}}t"))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.shared[int(v.text)]
        if kind == "b":
            return v.text == "1"
        if kind in ("str", "e"):
            return v.text if kind == "str" else None
        number, style = float(v.text), int(c.get("s", 0))
        if style < len(self.is_date) and self.is_date[style]:
            return self.epoch + datetime.timedelta(microseconds=round(number * 86_400_000_000))
        return number

    def rows(self, sheet: str) -> Iterator[tuple[int, list[Cell]]]:
        """(number from 0, cells) of the rows that a sheet has."""
        at = -1
        with self.zip.open(self.sheets[sheet]) as stream:
            for row in elements(stream, f"{{{SHEET_NS}}}row"):
                at = int(row.get("r")) - 1 if row.get("r") else at + 1
                cells: list[Cell] = []
                for c in row.iter(f"{{{SHEET_NS}}}c"):
                    column = column_of(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (column - len(cells))
                    cells.append(self.value(c))
                yield at, cells


def column_of(reference: str) -> int:
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(letter) - 64
    return n - 1


def shown(v: Cell) -> str | None:
    """A cell as text: whole numbers without a decimal point."""
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, datetime.datetime):
        return v.date().isoformat() if v.time() == datetime.time() else v.isoformat(" ")
    return str(int(v)) if v == int(v) else repr(v)


def typed(v: Cell, kind: DataType):
    """A cell as a type; null where it is none of it."""
    if v is None or isinstance(kind, StringType):
        return shown(v)
    if isinstance(kind, BooleanType):
        return v if isinstance(v, bool) else None
    if isinstance(kind, DateType):
        return v.date() if isinstance(v, datetime.datetime) else None
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return v if isinstance(v, datetime.datetime) else None
    if isinstance(v, (datetime.datetime, bool)):
        return None
    try:
        number = float(v)
    except ValueError:
        return None
    return number if isinstance(kind, (DoubleType, FloatType)) else int(number) if number == int(number) else None


def headed(rows: Iterator[tuple[int, list[Cell]]], header: int) -> tuple[list[str], Iterator[tuple[int, list[Cell]]]]:
    """The names in row `header` (from 0), and the rows after it that have a cell."""
    names: list[str] = []
    for at, cells in rows:
        if at >= header:
            names = [(shown(c) or "").strip() or f"column_{i}" for i, c in enumerate(cells)] if at == header else []
            break
    return names, ((at, cells) for at, cells in rows if any(c not in (None, "") for c in cells))


def kind_of(values: list[Cell]) -> DataType:
    there = [v for v in values if v not in (None, "")]
    if there and all(isinstance(v, bool) for v in there):
        return BooleanType()
    if there and all(isinstance(v, datetime.datetime) for v in there):
        return DateType() if all(v.time() == datetime.time() for v in there) else TimestampNTZType()
    if there and all(isinstance(v, float) for v in there):
        return DoubleType()
    return StringType()


@dataclass
class Sheet(InputPartition):
    file: str
    sheet: str


class WorkbookSource(DataSource):
    """Sheets of workbooks: file, sheet, row (its number, from 0), and a column for each name in the header row.

    Options: path (a file, a folder or a pattern), sheet (a pattern of sheet names, all by default), header (number of the
    header row from 0, by default 0: title rows stand above it). A partition is one sheet of one file and is parsed as it is
    read. Columns are found by name in each sheet; those that it lacks are null. Without a schema, names and types are those
    of the first sheet and its first rows.

    As a sink: one workbook, `sheet` names the column whose values are the sheets (one sheet else). Tasks write parts, and the
    commit puts the parts of each sheet together, streamed, under another name, which then takes the file's place. A job that
    fails leaves the old file and no parts.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _parts(self) -> list[Sheet]:
        store, _ = opened(self.options["path"])
        out = []
        for file in found(self.options["path"], ".xlsx"):
            with store.open_input_file(file) as handle:
                out += [Sheet(file, s) for s in Workbook(handle).sheets if fnmatch.fnmatch(s, self.options.get("sheet", "*"))]
        return out

    def schema(self) -> StructType:
        fields = [StructField("file", StringType()), StructField("sheet", StringType()), StructField("row", LongType())]
        for part in self._parts()[:1]:
            with opened(self.options["path"])[0].open_input_file(part.file) as handle:
                names, rows = headed(Workbook(handle).rows(part.sheet), int(self.options.get("header", 0)))
                sample = [cells for _, (_, cells) in zip(range(SAMPLE_ROWS), rows, strict=False)]
                fields += [StructField(n, kind_of([r[i] for r in sample if i < len(r)])) for i, n in enumerate(names)]
        return StructType(fields)

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader(self.options["path"], int(self.options.get("header", 0)), schema, self._parts())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return WorkbookWriter(self.options["path"], self.options.get("sheet"), schema, overwrite)


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, header: int, schema: StructType, parts: list[Sheet]):
        self.path, self.header, self.fields, self.parts = path, header, schema, parts

    def partitions(self) -> list[Sheet]:
        return self.parts or [Sheet("", "")]

    def read(self, part: Sheet) -> Iterator[tuple]:
        if not part.file:
            return
        with opened(self.path)[0].open_input_file(part.file) as handle:
            names, rows = headed(Workbook(handle).rows(part.sheet), self.header)
            place = {n: i for i, n in reversed([*enumerate(names)])}
            for at, cells in rows:
                own = {"file": part.file, "sheet": part.sheet, "row": at}
                yield tuple(own[f.name] if f.name in own else typed(cells[place[f.name]], f.dataType) if f.name in place and place[f.name] < len(cells) else None for f in self.fields.fields)


class DocumentSource(DataSource):
    """Paragraphs and table cells of text documents, in order: file, at, kind, style, table, row, column, text.

    kind is `paragraph` or `cell`; table, row and column (from 0) are null for paragraphs. With forward_fill the rows under a
    heading get it. A partition is one file, parsed as it is read.
    """

    @classmethod
    def name(cls) -> str:
        return "document"

    def schema(self) -> str:
        return "file string, at long, kind string, style string, `table` int, `row` int, `column` int, text string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return DocumentReader(self.options["path"], [Sheet(f, "") for f in found(self.options["path"], ".docx")])


class DocumentReader(DataSourceReader):
    def __init__(self, path: str, parts: list[Sheet]):
        self.path, self.parts = path, parts

    def partitions(self) -> list[Sheet]:
        return self.parts or [Sheet("", "")]

    def read(self, part: Sheet) -> Iterator[tuple]:
        if not part.file:
            return
        tag = lambda n: f"{{{TEXT_NS}}}{n}"
        at, tables, row, column, depth, cell = 0, -1, -1, -1, 0, []
        with opened(self.path)[0].open_input_file(part.file) as handle, zipfile.ZipFile(handle) as z, z.open("word/document.xml") as stream:
            for event, e in ElementTree.iterparse(stream, ("start", "end")):
                if event == "start" and e.tag == tag("tbl"):
                    depth += 1
                    if depth == 1:
                        tables, row = tables + 1, -1
                elif event == "start" and depth == 1 and e.tag == tag("tr"):
                    row, column = row + 1, -1
                elif event == "start" and depth == 1 and e.tag == tag("tc"):
                    column, cell = column + 1, []
                elif event == "end" and e.tag == tag("p"):
                    text = "".join((t.text or "") if t.tag == tag("t") else "\n" if t.tag == tag("br") else "\t" if t.tag == tag("tab") else "" for t in e.iter())
                    style = e.find(f"{tag('pPr')}/{tag('pStyle')}")
                    if depth:
                        cell.append(text)
                    else:
                        yield part.file, at, "paragraph", None if style is None else style.get(tag("val")), None, None, None, text
                        at += 1
                    e.clear()
                elif event == "end" and depth == 1 and e.tag == tag("tc"):
                    yield part.file, at, "cell", None, tables, row, column, "\n".join(cell)
                    at += 1
                elif event == "end" and e.tag == tag("tbl"):
                    depth -= 1
                    if not depth:
                        e.clear()


@dataclass
class Parts(WriterCommitMessage):
    task: int
    files: list[tuple[str, str]]  # sheet, file


class PartsWriter(DataSourceWriter):
    """Tasks write files of their own beside the target; commit and abort run once, after all of them."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.fields, self.overwrite = path, schema, overwrite
        store, target = opened(path)
        self.folder = f"{target}.parts-{uuid.uuid4().hex}"
        store.create_dir(self.folder)  # once, here: tasks that go on after an abort find no place to write to

    def _task_file(self) -> tuple[int, str]:
        from pyspark import TaskContext

        context = TaskContext.get()
        return context.partitionId(), f"{self.folder}/{context.partitionId():06}-{context.attemptNumber()}"

    def _assemble(self, messages: list[Parts], store: fs.FileSystem, target: str) -> None:
        raise NotImplementedError

    def commit(self, messages: list[Parts | None]) -> None:
        store, target = opened(self.path)
        draft = f"{self.folder}.whole"
        try:
            self._assemble(sorted((m for m in messages if m), key=lambda m: m.task), store, draft)
            if store.get_file_info(target).type == fs.FileType.File:
                store.delete_file(target)
            store.move(draft, target)
        finally:
            self._clear(store, draft)

    def abort(self, messages: list[Parts | None]) -> None:
        self._clear(opened(self.path)[0], f"{self.folder}.whole")

    def _clear(self, store: fs.FileSystem, draft: str) -> None:
        if store.get_file_info(draft).type == fs.FileType.File:
            store.delete_file(draft)
        if store.get_file_info(self.folder).type == fs.FileType.Directory:
            store.delete_dir(self.folder)


def xml_cell(v) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
        return f"<c><v>{v!r}</v></c>"
    if isinstance(v, (datetime.datetime, datetime.date)):
        whole = v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else datetime.datetime.combine(v, datetime.time())
        return f'<c s="{2 if isinstance(v, datetime.datetime) else 1}"><v>{(whole - EPOCH) / datetime.timedelta(days=1)!r}</v></c>'
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(v))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def xml_row(values) -> str:
    return f"<row>{''.join(map(xml_cell, values))}</row>"


class WorkbookWriter(PartsWriter):
    def __init__(self, path: str, sheet: str | None, schema: StructType, overwrite: bool):
        if not overwrite:
            raise ValueError("a workbook is written whole: use mode overwrite")
        super().__init__(path, schema, overwrite)
        self.sheet = sheet
        self.columns = [f.name for f in schema.fields if f.name != sheet]

    def write(self, rows: Iterator[Row]) -> Parts:
        task, file = self._task_file()
        store, streams = opened(self.path)[0], {}
        try:
            for row in rows:
                name = str(row[self.sheet]) if self.sheet else "Sheet1"
                if name not in streams:
                    streams[name] = (f"{file}-{len(streams)}", io.TextIOWrapper(store.open_output_stream(f"{file}-{len(streams)}"), "utf-8"))
                streams[name][1].write(xml_row([row[c] for c in self.columns]))
        finally:
            for _, stream in streams.values():
                stream.close()
        return Parts(task, [(name, f) for name, (f, _) in streams.items()])

    def _assemble(self, messages: list[Parts], store: fs.FileSystem, target: str) -> None:
        sheets: dict[str, list[str]] = {}
        for m in messages:
            for name, file in m.files:
                sheets.setdefault(name, []).append(file)
        sheets = dict(sorted(sheets.items())) or {"Sheet1": []}
        names: dict[str, str] = {}
        for name in sheets:  # names as the format allows them, each once
            plain = re.sub(FORBIDDEN_IN_SHEET_NAMES, " ", name).strip("' ")[:LONGEST_SHEET_NAME] or "Sheet"
            n = 0
            while (given := plain if not n else f"{plain[: LONGEST_SHEET_NAME - len(str(n)) - 1]}_{n}").lower() in {x.lower() for x in names.values()}:
                n += 1
            names[name] = given
        with store.open_output_stream(target) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            numbered = [*enumerate(names.values(), 1)]
            z.writestr("[Content_Types].xml", f'<Types xmlns="{TYPES_NS}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>' + '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i, _ in numbered) + "</Types>")
            z.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE_NS}"><Relationship Id="rId1" Type="{LINK_NS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{SHEET_NS}" xmlns:r="{LINK_NS}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in numbered) + "</sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE_NS}">' + "".join(f'<Relationship Id="rId{i}" Type="{LINK_NS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered) + f'<Relationship Id="rId{len(numbered) + 1}" Type="{LINK_NS}/styles" Target="styles.xml"/></Relationships>')
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{SHEET_NS}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>')
            for (i, _), files in zip(numbered, sheets.values(), strict=True):
                with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as sheet:
                    sheet.write(f'<worksheet xmlns="{SHEET_NS}"><sheetData>{xml_row(self.columns)}'.encode())
                    for file in files:
                        with store.open_input_stream(file) as part:
                            shutil.copyfileobj(part, sheet, 1 << 20)
                    sheet.write(b"</sheetData></worksheet>")


class OneCsvSink(DataSource):
    """One CSV file for a spreadsheet: a byte order mark, one header line, then all rows.

    Tasks write parts. mode overwrite: the commit puts them together under another name, which takes the file's place. mode
    append: the new parts alone are added at the end of the file, in a store that can append; nothing old is copied.
    """

    @classmethod
    def name(cls) -> str:
        return "one_csv"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return OneCsvWriter(self.options["path"], schema, overwrite)


class OneCsvWriter(PartsWriter):
    def write(self, rows: Iterator[Row]) -> Parts:
        task, file = self._task_file()
        with io.TextIOWrapper(opened(self.path)[0].open_output_stream(file), "utf-8", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows(["" if v is None else v for v in row] for row in rows)
        return Parts(task, [("", file)])

    def _head(self) -> bytes:
        line = io.StringIO()
        csv.writer(line, lineterminator="\n").writerow(f.name for f in self.fields.fields)
        return ("﻿" + line.getvalue()).encode()

    def _copy(self, messages: list[Parts], store: fs.FileSystem, out) -> None:
        for m in messages:
            for _, file in m.files:
                with store.open_input_stream(file) as part:
                    shutil.copyfileobj(part, out, 1 << 20)

    def _assemble(self, messages: list[Parts], store: fs.FileSystem, target: str) -> None:
        with store.open_output_stream(target) as out:
            out.write(self._head())
            self._copy(messages, store, out)

    def commit(self, messages: list[Parts | None]) -> None:
        store, target = opened(self.path)
        if self.overwrite or store.get_file_info(target).type != fs.FileType.File:
            super().commit(messages)
            return
        try:
            with store.open_append_stream(target) as out:
                self._copy(sorted((m for m in messages if m), key=lambda m: m.task), store, out)
        finally:
            self._clear(store, f"{self.folder}.whole")


def register(spark) -> None:
    """Make the formats workbook, document and one_csv known to a session."""
    for source in (WorkbookSource, DocumentSource, OneCsvSink):
        spark.dataSource.register(source)
