"""Excel workbooks (.xlsx) without extra libraries: a Spark data source.

    spark.dataSource.register(Xlsx); spark.read.format("xlsx").option("sheet", "Sheet1").load(path or glob)

gives file, row (from 1) and cells, an array of texts, of the first sheet or the one named, a partition for each file. A sheet
is read as a stream of rows. Numbers are given as they are written, dates (numbers whose style is one of a date) as
YYYY-MM-DD, with the time where there is one, truth values as true and false; empty cells and errors are null."""

from __future__ import annotations

import glob
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# fixed values of the format: namespaces, and the built-in number formats that are dates
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
OF_DOCUMENT = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DATES = {*range(14, 23), 27, 30, 36, 45, 46, 47, 50, 57}


def _column(reference: str) -> int:
    """The column of a cell's name, A being 0."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _is_date(code: str) -> bool:
    """Whether a number format of one's own shows parts of a date, texts in it and colours left out."""
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code).lower()
    return bool(re.search(r"[dy]|m{1,5}", bare)) and not re.search(r"[#0?]", bare.replace("am/pm", "").replace(".000", "").replace(".00", "").replace(".0", ""))


class Workbook:
    def __init__(self, path: str):
        try:
            self.zip = zipfile.ZipFile(path)
            self.names = set(self.zip.namelist())
            book = self._tree("xl/workbook.xml")
            links = {r.get("Id"): r.get("Target") for r in self._tree("xl/_rels/workbook.xml.rels").iter(f"{PACKAGE}Relationship")}
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as error:
            raise ValueError(f"{path} is no Excel workbook: {error}") from None
        self.path = path
        place = lambda target: target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        self.sheets = {s.get("name"): place(links[s.get(f"{OF_DOCUMENT}id")]) for s in book.iter(f"{MAIN}sheet")}
        properties = book.find(f"{MAIN}workbookPr")
        late = properties is not None and properties.get("date1904") in ("1", "true")
        self.start = datetime(1904, 1, 1) if late else datetime(1899, 12, 30)
        self.dates = self._date_styles()
        self.shared = self._shared()

    def _tree(self, name: str) -> ElementTree.Element:
        with self.zip.open(name) as f:
            return ElementTree.parse(f).getroot()

    def _date_styles(self) -> set[int]:
        """The cell styles that show dates."""
        if "xl/styles.xml" not in self.names:
            return set()
        root = self._tree("xl/styles.xml")
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{MAIN}numFmt")}
        styles = root.find(f"{MAIN}cellXfs")
        ids = [int(x.get("numFmtId", 0)) for x in styles] if styles is not None else []
        return {k for k, n in enumerate(ids) if n in DATES and n not in own or _is_date(own.get(n, ""))}

    def _shared(self) -> list[str]:
        out: list[str] = []
        if "xl/sharedStrings.xml" in self.names:
            with self.zip.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == f"{MAIN}si":
                        out.append(self._text(e))
                        e.clear()
        return out

    @staticmethod
    def _text(e: ElementTree.Element) -> str:
        """A text's runs, without its phonetic ones."""
        runs = [t.text or "" for child in e if child.tag != f"{MAIN}rPh" for t in ([child] if child.tag == f"{MAIN}t" else child.iter(f"{MAIN}t"))]
        return "".join(runs)

    def _value(self, cell: ElementTree.Element) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            own = cell.find(f"{MAIN}is")
            return None if own is None else self._text(own)
        v = cell.find(f"{MAIN}v")
        if v is None or v.text is None or kind == "e":
            return None
        if kind == "s":
            return self.shared[int(v.text)]
        if kind == "b":
            return "true" if v.text.strip() == "1" else "false"
        if kind == "d":
            return v.text.strip().removesuffix("T00:00:00")
        if kind == "n" and int(cell.get("s", 0)) in self.dates:
            when = self.start + timedelta(milliseconds=round(float(v.text) * 86_400_000))
            return str(when.date()) if not (when.hour or when.minute or when.second or when.microsecond) else when.isoformat(" ")
        return v.text

    def rows(self, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
        if sheet is None:
            sheet = next(iter(self.sheets))
        if sheet not in self.sheets:
            raise ValueError(f"{self.path} has no sheet {sheet!r}; it has {', '.join(self.sheets)}")
        number = 0
        with self.zip.open(self.sheets[sheet]) as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag == f"{MAIN}row":
                    number, cells = int(e.get("r", number + 1)), []
                    for c in e.iter(f"{MAIN}c"):
                        at = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at - len(cells)) + [self._value(c)]
                    yield number, cells
                    e.clear()


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.sheet = sorted(glob.glob(options["path"])), options.get("sheet")
        if not self.paths:
            raise FileNotFoundError(f"no workbook at {options['path']}")

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, part: _File) -> Iterator[tuple]:
        for row, cells in Workbook(part.path).rows(self.sheet):
            yield part.path, row, cells


class Xlsx(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return "file string, row int, cells array<string>"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def table(spark: SparkSession, path: str, sheet: str | None = None) -> tuple[list[str], DataFrame]:
    """The names in a sheet's first row, and the rows below as columns c0, c1, ... of texts, rows without any value left out."""
    spark.dataSource.register(Xlsx)
    rows = spark.read.format("xlsx").options(**({"sheet": sheet} if sheet else {})).load(path)
    first = rows.where(F.exists("cells", lambda c: c.isNotNull())).orderBy("row").first()
    if first is None:
        raise ValueError(f"{path} has no rows")
    names = [c or "" for c in first.cells]
    below = rows.where((F.col("row") > first.row) & F.exists("cells", lambda c: c.isNotNull()))
    return names, below.select(*[F.get("cells", F.lit(k)).alias(f"c{k}") for k in range(len(names))])
