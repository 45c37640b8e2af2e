"""Workbooks against CSV, coordinate systems there and back, grids in byte ranges."""

import datetime as dt
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from rainloom.functions import crs, geometry
from rainloom.operators import raster
from rainloom.sources import asciigrid, csv, xlsx

MAIN, REL = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
START = dt.date(1899, 12, 30)


def workbook(path, sheets, shared=(), styles="", late=False, absolute=False):
    """A workbook of sheets given as XML of rows."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><workbookPr{" date1904=" + chr(34) + "1" + chr(34) if late else ""}/><sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{k}" Target="{"/xl/" if absolute else ""}worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>')
        for k, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{k}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{"".join(f"<si>{x}</si>" for x in shared)}</sst>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')


STYLES = '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="[Red]0.00&quot; mm a day&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="14"/></cellXfs>'


def test_cells_of_all_kinds(tmp_path):
    rows = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>in</t><rPh><t>no</t></rPh></is></c></row>'
        '<row r="3"><c r="A3" s="1"><v>36892</v></c><c r="B3" s="2"><v>12.5</v></c><c r="C3" s="3"><v>36892.75</v></c><c r="AA3" t="b"><v>1</v></c><c r="AB3" t="e"><v>#DIV/0!</v></c><c r="AC3" t="str"><v>made</v></c></row>'
    )
    path = str(tmp_path / "a.xlsx")
    workbook(path, {"first": rows, "second": '<row><c><v>7</v></c><c t="d"><v>2001-02-03T00:00:00</v></c></row>'}, ["<r><t>two </t></r><r><t>runs</t></r>"], STYLES, absolute=True)
    book = xlsx.Workbook(path)
    assert list(book.rows()) == [(1, ["two runs", None, "in"]), (3, ["2001-01-01", "12.5", "2001-01-01 18:00:00", *[None] * 23, "true", None, "made"])]
    assert list(book.rows("second")) == [(1, ["7", "2001-02-03"])]
    with pytest.raises(ValueError, match="has no sheet 'third'; it has first, second"):
        list(book.rows("third"))
    workbook(str(tmp_path / "late.xlsx"), {"s": '<row r="1"><c r="A1" s="3"><v>0</v></c></row>'}, styles=STYLES, late=True)
    assert list(xlsx.Workbook(str(tmp_path / "late.xlsx")).rows()) == [(1, ["1904-01-01"])]
    (tmp_path / "no.xlsx").write_bytes(b"PK nothing")
    with pytest.raises(ValueError, match="no Excel workbook"):
        xlsx.Workbook(str(tmp_path / "no.xlsx"))


def test_tables_equal_those_from_csv(spark, tmp_path):
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    value = lambda k, j: None if (k + j) % 5 == 0 else k * 1.25 + j
    (tmp_path / "rain.csv").write_text("date,909,1030\n" + "".join(f"{d},{','.join('' if value(k, j) is None else str(value(k, j)) for j in (0, 1))}\n" for k, d in enumerate(days)))
    cell = lambda k, j: "" if value(k, j) is None else f'<c r="{"BC"[j]}{k + 2}"><v>{value(k, j)}</v></c>'
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>909</v></c><c r="C1" t="s"><v>1</v></c></row>' + "".join(f'<row r="{k + 2}"><c r="A{k + 2}" s="1"><v>{(d - START).days}</v></c>{cell(k, 0)}{cell(k, 1)}</row>' for k, d in enumerate(days))
    rows += '<row r="90"><c r="A90" s="1"/></row><row r="91"><c r="A91" t="inlineStr"><is><t>total</t></is></c><c r="B91"><v>3</v></c></row>'
    workbook(tmp_path / "rain.xlsx", {"Sheet1": rows}, ["<t>date</t>", "<t>1030</t>"], STYLES)
    both = [sorted(map(tuple, csv.read_meteo(spark, str(tmp_path / n)).collect()), key=repr) for n in ("rain.csv", "rain.xlsx")]
    assert both[0] == both[1] and len(both[0]) == 80
    (tmp_path / "st.csv").write_text("Station,Z,X,Y\n909,137,84.98,27.16\n1030,,85.35,27.7\n")
    head = '<row r="1">' + "".join(f'<c r="{c}1" t="inlineStr"><is><t>{n}</t></is></c>' for c, n in zip("ABCD", ("Station", "Z", "X", "Y"), strict=True)) + "</row>"
    workbook(tmp_path / "st.xlsx", {"s": head + '<row r="2"><c r="A2"><v>909</v></c><c r="B2"><v>137</v></c><c r="C2"><v>84.98</v></c><c r="D2"><v>27.16</v></c></row><row r="3"><c r="A3"><v>1030</v></c><c r="C3"><v>85.35</v></c><c r="D3"><v>27.7</v></c></row>'})
    both = [sorted(map(tuple, csv.read_stations(spark, str(tmp_path / n)).collect()), key=repr) for n in ("st.csv", "st.xlsx")]
    assert both[0] == both[1] and len(both[0]) == 2
    workbook(tmp_path / "empty.xlsx", {"s": ""})
    with pytest.raises(ValueError, match="no rows"):
        csv.read_meteo(spark, str(tmp_path / "empty.xlsx"))


def test_all_zones_there_and_back(spark):
    k = F.col("id")
    rows = spark.range(60 * 9 * 17).select((k % 60 + 1).cast("int").alias("zone"), ((k / 60).cast("int") % 9 - 4).alias("dx"), ((k / 540).cast("int") * 10.4 - 83).alias("lat"))
    rows = rows.withColumn("south", F.col("lat") < 0).withColumn("lon", F.col("zone") * 6 - 183 + F.col("dx") * 0.75)
    x, y = crs.project(F.col("lon"), F.col("lat"), F.col("zone"), F.col("south"))
    there = rows.withColumns({"x": x, "y": y})
    lon, lat = crs.unproject(F.col("x"), F.col("y"), F.col("zone"), F.col("south"))
    worst = there.agg(F.max(F.abs(lon - F.col("lon")) * F.cos(F.radians("lat"))).alias("a"), F.max(F.abs(lat - F.col("lat"))).alias("b"), F.min("x").alias("low"), F.max("x").alias("high"), F.min("y").alias("y0"), F.count("x").alias("n")).first()
    assert max(worst.a, worst.b) * 111_320 < 1e-3 and worst.n == 9180 and 160_000 < worst.low < worst.high < 840_000 and worst.y0 > 0
    # the series that results have to match agrees within its own accuracy
    old_x, old_y = geometry.utm(F.col("lat"), F.col("lon"), 45)
    near = there.where("zone = 45 AND lat BETWEEN 0 AND 60").select(F.abs(F.col("x") - old_x).alias("a"), F.abs(F.col("y") - old_y).alias("b")).agg(F.max("a"), F.max("b")).first()
    assert max(near) < 0.02


def test_known_places(spark):
    """The equator at a zone's middle, and a published pair of places."""
    at = lambda lon, lat, code: spark.range(1).select(*[c.alias(n) for c, n in zip(crs.from_degrees(F.lit(lon), F.lit(lat), crs.parse(code)), "xy", strict=True)]).first()
    assert tuple(at(3.0, 0.0, "EPSG:32631")) == (500000.0, 0.0) and tuple(at(3.0, 0.0, "EPSG:32731")) == (500000.0, 10000000.0)
    one = at(math.degrees(0.0), 0.0, "EPSG:32631")
    assert one.x == pytest.approx(166021.443, abs=2e-3) and one.y == 0.0
    assert [crs.utm_code(*p) for p in ((85.3, 27.7), (-70.6, -33.4), (180.0, 1.0))] == ["EPSG:32645", "EPSG:32719", "EPSG:32660"]


@pytest.mark.parametrize("bad", ["EPSG:32661", "EPSG:32600", "EPSG:3857", "utm", "EPSG:327", "", "ESRI:32645"])
def test_unknown_codes_are_refused_by_name(bad):
    with pytest.raises(ValueError, match=f"unknown coordinate system '{bad}'"):
        crs.parse(bad)


def test_stations_from_metres_of_another_system(spark, tmp_path):
    (tmp_path / "d.csv").write_text("Station,X,Y,Z\na,-70.6,-33.4,500\nb,-70.1,-33.9,\n")
    south = csv.read_stations(spark, str(tmp_path / "d.csv"), target="EPSG:32719").collect()
    (tmp_path / "m.csv").write_text("Station,X,Y,Z\n" + "".join(f"{r.station},{r.x!r},{r.y!r},{'' if r.z is None else r.z}\n" for r in south))
    back = csv.read_stations(spark, str(tmp_path / "m.csv"), source="EPSG:32719", target="EPSG:32718").collect()
    for a, b in zip(south, back, strict=True):
        assert (a.lon, a.lat) == (pytest.approx(b.lon, abs=1e-9), pytest.approx(b.lat, abs=1e-9)) and 6_000_000 < a.y < 6_400_000 and b.x > 900_000
    with pytest.raises(ValueError, match="EPSG:9999"):
        csv.read_stations(spark, str(tmp_path / "d.csv"), target="EPSG:9999")


def test_grids_in_byte_ranges(spark, tmp_path):
    side = 37
    cells = raster.grid_coordinates(spark.range(side * side).select((F.col("id") / side).cast("int").alias("row"), (F.col("id") % side).cast("int").alias("col")), side, 100.0, 200.0, 10.0)
    cells = cells.withColumn("z", F.when((F.col("row") + F.col("col")) % 11 != 0, F.col("row") * 3.5 + F.col("col"))).select("row", "col", "x", "y", "z")
    path = str(tmp_path / "g.asc")
    asciigrid.write(cells.repartition(5), path, 10.0)
    assert [p.name for p in tmp_path.iterdir()] == ["g.asc"]
    want = sorted(map(tuple, cells.collect()))
    spark.dataSource.register(asciigrid.AsciiGrid)
    assert sorted(map(tuple, spark.read.format("asciigrid").load(path).collect())) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600b")
    try:
        for text in (open(path).read(), open(path).read().replace("\n", "\r\n"), open(path).read().rstrip("\n"), open(path).read() + "\n\n"):
            with open(tmp_path / "h.asc", "w", newline="") as f:
                f.write(text)
            found = asciigrid.load(spark, str(tmp_path / "h.asc"))
            assert found.rdd.getNumPartitions() > 4 and sorted(map(tuple, found.collect())) == want
        lines = open(path).read().split("\n")
        (tmp_path / "short.asc").write_text("\n".join(lines[:20]))
        with pytest.raises(ValueError, match="has 14 rows, not 37"):
            asciigrid.load(spark, str(tmp_path / "short.asc"))
        (tmp_path / "ragged.asc").write_text("\n".join([*lines[:9], lines[9] + " 5", *lines[10:]]))
        with pytest.raises(Exception, match="row 3 of .* has 38 values, not 37"):
            asciigrid.load(spark, str(tmp_path / "ragged.asc")).count()
        (tmp_path / "none.asc").write_text("1 2 3\n4 5 6\n")
        with pytest.raises(ValueError, match="header"):
            asciigrid.load(spark, str(tmp_path / "none.asc"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
