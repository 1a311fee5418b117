"""Workbooks as a data source: round trips, foreign files, blocks, overwriting and failing."""

import datetime as dt
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.sources import files, workbooks


def test_orders_come_back_as_they_were(spark, sf, tmp_path):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("link", F.concat(F.lit("https://orders.org/?a=1&k="), "o_orderkey"))
    path = f"file://{tmp_path}/orders"
    workbooks.write(orders.repartition(3), path, links=("link",))
    back = workbooks.read(spark, path, schema=orders.schema, rows=100)
    assert back.rdd.getNumPartitions() > 10
    assert back.exceptAll(orders).isEmpty() and orders.exceptAll(back).isEmpty()
    with zipfile.ZipFile(sorted((tmp_path / "orders").glob("*.xlsx"))[0]) as z:
        rels = z.read("xl/worksheets/_rels/sheet1.xml.rels").decode()
        assert rels.count("hyperlink") >= rels.count("https://orders.org/?a=1&amp;k=") > 50 and z.testzip() is None
        assert z.read("xl/worksheets/sheet1.xml").decode().count("<hyperlink ref=") == rels.count('TargetMode="External"')
    texts = files.read_excel(spark, path, as_text=True)
    assert texts.columns == orders.columns and {t for _, t in texts.dtypes} == {"string"} and texts.count() == orders.count()
    assert dict(files.read_excel(spark, path).dtypes)["o_orderkey"] == "bigint"


def test_odd_texts_types_and_nulls(spark, tmp_path):
    odd = ["", " a ", "<&>\"'", "line\nbreak\r\ttab", "\x00\x1f", "_x0041_ stays", "日本語 𝒜", "=1+2", "1e5", None, "https://x.org/ not one"]
    schema = "t string, n long, f double, b boolean, d date, m decimal(10,2), s timestamp"
    rows = [(t, None if k % 3 == 0 else 2**60 + k, [1.5, float("-inf"), 1e-300, None][k % 4], [True, False, None][k % 3], dt.date(2020, 1, k + 1), Decimal("1.50"), dt.datetime(2021, 2, 3, 4, 5, k, 678)) for k, t in enumerate(odd)]
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "odd")
    files.write_excel(df, path, ("t",), sheet="A & B")
    back = workbooks.read(spark, path, "A & B", schema=df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="there is no sheet"):
        workbooks.read(spark, path, "C").collect()


def test_positions_order_blocks_and_full_sheets(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    path = str(tmp_path / "many")
    workbooks.write(df.coalesce(1), path, rows=300)
    assert len(list((tmp_path / "many").glob("*.xlsx"))) == 4
    back = workbooks.read(spark, path, pos="pos", rows=128)
    assert back.columns == ["pos", "v"] and [r.v for r in back.orderBy("pos").collect()] == [str(k) for k in range(1000)]
    one = sorted((tmp_path / "many").glob("*.xlsx"))[1]
    assert [r.v for r in workbooks.read(spark, str(one), pos="pos").orderBy("pos").limit(2).collect()] == ["300", "301"]
    assert workbooks.read(spark, f"{path}/part-*-003-*.xlsx").count() == 100


def test_overwrite_append_and_nothing(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([("a",), ("b",)], "v string")
    workbooks.write(df, path)
    workbooks.write(df, path, overwrite=False)
    assert workbooks.read(spark, path).count() == 4
    workbooks.write(df.limit(0), path)
    back = workbooks.read(spark, path)
    assert back.columns == ["v"] and back.count() == 0 and len(list((tmp_path / "t").iterdir())) == 1
    with pytest.raises(Exception, match="none"):
        workbooks.read(spark, str(tmp_path / "none"))


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([("a",)], "v string")
    workbooks.write(df, path)
    bad = spark.range(0, 20, 1, 4).select(F.expr("CASE WHEN id = 17 THEN raise_error('no') ELSE 'x' END").alias("v"))
    with pytest.raises(Exception, match="no"):
        workbooks.write(bad, path)
    assert [r.v for r in workbooks.read(spark, path).collect()] == ["a"] and len(list((tmp_path / "t").iterdir())) == 1


def foreign(path, sheet, strings="", styles=""):
    """A workbook as others write it: two sheets, shared strings, an absolute target."""
    main = workbooks.MAIN
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{workbooks.RELATIONS}"><sheets><sheet name="Notes" sheetId="1" r:id="rId7"/><sheet name="Data" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{workbooks.PACKAGE}/relationships"><Relationship Id="rId2" Type="x" Target="/xl/worksheets/sheet2.xml"/><Relationship Id="rId7" Type="x" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{main}">{sheet}</worksheet>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')


def test_a_foreign_workbook(spark, tmp_path):
    path = str(tmp_path / "f.xlsx")
    strings = "<si><t>name</t></si><si><r><t>two</t></r><r><t xml:space='preserve'> runs</t></r><rPh><t>no</t></rPh></si><si><t/></si>"
    styles = '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    rows = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>when</t></is></c><c r="D1" t="s"><v>0</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2" t="b"><v>1</v></c><c r="C2" s="1"><v>44197</v></c><c r="D2" s="3"><v>2.5</v></c></row>'
        '<row r="5"><c t="s"><v>2</v></c><c t="e"><v>#N/A</v></c><c s="2"><v>44197.5</v></c><c t="str"><f>A1</f><v>shown</v></c></row>'
    )
    foreign(path, f'<dimension ref="A1:D5"/><sheetData>{rows}</sheetData>', strings, styles)
    for size in (1, 2, 100):
        got = workbooks.read(spark, path, "Data", pos="pos", rows=size).orderBy("pos")
        assert got.columns == ["pos", "name", "_c1", "when", "_c3"]
        assert [tuple(r)[1:] for r in got.collect()] == [("two runs", "true", "2021-01-01", "2.5"), (None,) * 4, (None,) * 4, ("", "#N/A", "2021-01-01 12:00:00", "shown")]
    assert workbooks.read(spark, path, 0).columns == [] and workbooks.read(spark, path, 1).count() == 4
    typed = workbooks.read(spark, path, "Data", schema="when timestamp, name string, absent long")
    assert typed.dropna(subset=["when"]).agg(F.max("when"), F.count("absent")).first() == (dt.datetime(2021, 1, 1, 12), 0)


def test_cells_that_do_not_fit_a_type():
    assert workbooks.parsed("5.0", T.LongType()) == 5 and workbooks.parsed("TRUE", T.BooleanType()) is True and workbooks.parsed(None, T.LongType()) is None
    for text, kind in (("5.5", T.LongType()), ("x", T.DoubleType()), ("maybe", T.BooleanType()), ("x", T.ArrayType(T.LongType()))):
        with pytest.raises((ValueError, KeyError)):
            workbooks.parsed(text, kind)
    assert [workbooks.column_name(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert [workbooks.column_number(f"{workbooks.column_name(k)}9") for k in range(800)] == list(range(800))
