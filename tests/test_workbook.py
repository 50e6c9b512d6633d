"""Workbooks in and out."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from adsettle.operators.pages import with_pages
from adsettle.operators.projection import Field, fields
from adsettle.sinks.workbook import BookWriter, write_result_books
from adsettle.sources.cells import column_index, open_workbook, sheet_parts
from adsettle.sources.workbook import (
    first_sheets,
    fitting_files,
    list_files,
    list_sheets,
    named_sheets,
    read_sheets,
    sheet_headers,
)

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(path, sheets):
    """A workbook of ``{sheet: [header row, row, ...]}``."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with BookWriter(str(path)).open() as writer:
        for name, rows in sheets.items():
            with writer.sheet(name, rows[0]) as add:
                for row in rows[1:]:
                    add(row)


def foreign_book(path):
    """What other programs write: shared strings, gaps, prefixes, absolute targets, a chart."""
    shared = (
        f'<sst xmlns="{MAIN}"><si><t>账户ID</t></si><si><r><t>总花</t></r><r><t>费(元)</t></r></si>'
        "<si><t>x &amp; y</t><rPh><t>hint</t></rPh></si><si><t>备注</t></si><si><t/></si></sst>"
    )
    sheet = (
        f'<x:worksheet xmlns:x="{MAIN}"><x:sheetData>'
        '<x:row r="3"><x:c r="B3" t="s"><x:v>0</x:v></x:c><x:c r="C3" t="s"><x:v>1</x:v></x:c>'
        '<x:c r="D3" t="s"><x:v>3</x:v></x:c><x:c r="F3" t="inlineStr"><x:is><x:t>far</x:t></x:is>'
        "</x:c></x:row>"
        '<x:row r="4"><x:c r="B4"><x:v>123456789012</x:v></x:c><x:c r="D4" t="s"><x:v>2</x:v></x:c>'
        '<x:c r="F4"><x:v>9</x:v></x:c></x:row>'
        '<x:row r="5"><x:c r="B5" t="str"><x:f>A1</x:f><x:v>f</x:v></x:c><x:c r="C5"><x:v>1.5</x:v>'
        '</x:c><x:c r="D5" t="s"><x:v>4</x:v></x:c></x:row>'
        '<x:row r="6"><x:c r="F6"><x:v>9</x:v></x:c></x:row>'
        '<x:row r="7"><x:c r="B7"><x:v>after the gap</x:v></x:c></x:row>'
        "</x:sheetData></x:worksheet>"
    )
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", shared)
        z.writestr("xl/worksheets/data.xml", sheet)
        z.writestr("xl/chartsheets/c.xml", "<chartsheet/>")
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets><sheet name="图" sheetId="9" '
            'r:id="rId9"/><sheet name="0" sheetId="4" r:id="rId2"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships><Relationship Id="rId2" Type="{OFFICE}/worksheet" '
            f'Target="/xl/worksheets/data.xml"/><Relationship Id="rId9" Type="{OFFICE}/chartsheet" '
            'Target="chartsheets/c.xml"/></Relationships>',
        )


def test_column_letters():
    assert [column_index(r) for r in ("A1", "Z9", "AA1", "AB7", "xfd1")] == [0, 25, 26, 27, 16383]


def test_foreign_workbook(spark, tmp_path):
    foreign_book(tmp_path / "快手-a" / "快手消耗 1.xlsx")
    files = list_files(spark, str(tmp_path))
    assert [tuple(r) for r in files.select("entry", "file_name").collect()] == [
        ("快手-a", "快手消耗 1.xlsx")
    ]
    sheets = list_sheets(files)
    assert [(r.sheet_no, r.sheet) for r in sheets.collect()] == [(1, "0")]
    wanted = fields({"id": "账户ID", "spend": "总花费(元)", "note": "备注"})
    rows = read_sheets(named_sheets(sheets, "0"), wanted).drop("path").collect()
    # the row behind one that holds nothing in these columns is there too
    assert set(map(tuple, rows)) == {
        ("0", "123456789012", None, "x & y"), ("0", "f", "1.5", None), ("0", "after the gap", None, None),
        ("0", None, None, None),
    }
    far = read_sheets(named_sheets(sheets, "0"), fields({"id": "账户ID", "far": "far"})).drop("path", "sheet")
    assert {tuple(r) for r in far.collect()} == {
        ("123456789012", "9"), ("f", None), (None, "9"), ("after the gap", None),
    }


def test_all_sheets_first_sheet_and_position(spark, tmp_path):
    head = ["账号ID", "名称"]
    book(tmp_path / "e" / "a.xlsx", {"s1": [head, ["1", "a"], [2, "b"]], "s2": [head, [3, None]]})
    book(tmp_path / "e" / "b.XLSX", {"s1": [["名称", "账户ID"], ["<c>", 4.5]], "空": [["x"]]})
    (tmp_path / "e" / "note.txt").write_text("x")
    files = list_files(spark, str(tmp_path))
    assert files.count() == 2
    wanted = fields({"id": ("账号ID", "账户ID"), "name": "名称"})
    a = list_sheets(files.filter("file_name = 'a.xlsx'"))
    assert sorted(map(tuple, read_sheets(a, wanted).drop("path").collect())) == [
        ("s1", "1", "a"), ("s1", "2", "b"), ("s2", "3", None),
    ]
    both = first_sheets(list_sheets(files))
    got = sorted((r["id"], r["name"]) for r in read_sheets(both, wanted).collect())
    assert got == [("1", "a"), ("2", "b"), ("4.5", "<c>")]
    # By position, under the first sheet's headers.
    raw = read_sheets(both).drop("path", "sheet")
    assert raw.columns == head and ("<c>", "4.5") in {tuple(r) for r in raw.collect()}
    with pytest.raises(Exception, match="columns where the first sheet has 2"):
        read_sheets(list_sheets(files)).collect()
    with pytest.raises(Exception, match="b.XLSX, sheet 空: missing headers"):
        read_sheets(list_sheets(files), wanted).collect()


def test_headers_and_duplicates(spark, tmp_path):
    book(tmp_path / "e" / "a.xlsx", {"s": [["x", "x", "x_1"], ["1", "2", "3"]], "t": [["y"]]})
    heads = sheet_headers(list_sheets(list_files(spark, str(tmp_path)))).orderBy("sheet_no")
    assert [(r.headers, r.has_rows) for r in heads.collect()] == [
        (["x", "x_1", "x_1_1"], True),
        (["y"], False),
    ]


def test_mapping_of_files(spark, tmp_path):
    one, two = ["客户", "消费"], ["客户", "花费"]
    book(tmp_path / "e" / "a.xlsx", {"s": [two, ["c", 1]], "t": [two]})
    book(tmp_path / "e" / "b.xlsx", {"s": [one, ["c", 1]]})
    book(tmp_path / "e" / "c.xlsx", {"s": [two]})
    book(tmp_path / "e" / "d.xlsx", {"s": [two, ["c", 1]], "t": [one]})
    book(tmp_path / "e" / "e.xlsx", {"s": [two, ["c", 1]]})
    heads = sheet_headers(list_sheets(list_files(spark, str(tmp_path))))
    mappings = {
        "one": fields({"v": "消费"}),
        "two": [Field("v", ("花费", "金额")), Field("w", ("客户", "花费"), "coalesce")],
    }
    name, outcome = fitting_files(heads, mappings)
    assert name == "two"
    assert [r.status for r in outcome.orderBy("path").collect()] == [
        "loaded", "skipped", "skipped", "skipped", "loaded",
    ]
    assert fitting_files(heads, {"none": fields({"v": "无"})}) is None
    assert fitting_files(heads.filter("path like '%c.xlsx'"), mappings) is None


def test_unite(spark, tmp_path):
    """Two sheets, six rows, four keys."""
    from adsettle.plans.unite import unite_sheets

    one = [["x", "y"], ["1", "a"], ["2", "b"], ["3", None]]
    two = [["x", "y"], ["3", "c"], ["4", "d"], ["1", "e"]]
    path = tmp_path / "Book1.xlsx"
    book(path, {"s1": one, "s2": two})
    assert unite_sheets(spark, str(path), dedupe=False).count() == 6
    out = unite_sheets(spark, str(path)).collect()
    assert [tuple(r) for r in out] == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]
    counts = unite_sheets(spark, str(path), [("x", None)], [("x", "k"), ("COUNT(*)", "n")])
    assert [tuple(r) for r in counts.collect()] == [("1", 2), ("2", 1), ("3", 2), ("4", 1)]


def test_no_files(spark, tmp_path):
    assert list_files(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("count,names", [(0, ["r.xlsx"]), (5, ["r.xlsx"]), (6, ["r_part1.xlsx", "r_part2.xlsx"])])
def test_result_books(spark, tmp_path, count, names):
    df = spark.range(count).select(
        F.col("id").alias("账户ID"), (F.col("id") / 4).alias("消耗"), F.lit("a<b\x01&\n").alias("名")
    )
    assert write_result_books(df, str(tmp_path), "r", 5, [F.desc("id")]) == count
    assert sorted(p.name for p in tmp_path.glob("*.xlsx")) == names
    report = spark.read.parquet(str(tmp_path / "_report_r"))
    assert sorted(r["rows"] for r in report.collect()) == ([] if not count else [5] if count == 5 else [1, 5])
    with open_workbook(str(tmp_path / names[0])) as z:
        assert [n for n, _ in sheet_parts(z)] == ["Sheet1"]
    if count:
        files = list_files(spark, str(tmp_path), depth=0)
        back = read_sheets(list_sheets(files)).drop("path", "sheet").collect()
        assert sorted(tuple(r) for r in back) == [
            (str(i), repr(i / 4), "a<b&\n") for i in range(count)
        ]
        first = read_sheets(list_sheets(files.filter(F.col("file_name") == names[0]))).collect()
        assert [r["账户ID"] for r in first] == [str(i) for i in range(count - 1, count - 6, -1)]


def test_pages_and_books_agree(spark, tmp_path):
    df = spark.range(2500)
    write_result_books(df, str(tmp_path), "r", 1000)
    sizes = with_pages(df, 1000).groupBy("page").count().orderBy("page").collect()
    assert [r["count"] for r in sizes] == [1000, 1000, 500]
    report = spark.read.parquet(str(tmp_path / "_report_r")).orderBy("path")
    assert [r["rows"] for r in report.collect()] == [1000, 1000, 500]


def test_plain_rows_need_no_parser(spark, tmp_path, monkeypatch):
    """Rows that the sink wrote are cut into columns, with the texts that a parser of XML finds."""
    import pyarrow as pa

    from adsettle.sinks.workbook import row_texts
    from adsettle.sources import cells

    texts = ["a & b", "<c>", "x\r\ny", " edge ", "", None, "1&lt;2", "客户", "\x01bell", "]]>", '"q"', "c"] * 2000
    numbers = [1.5, None, float("nan"), -2.0, 1e22, 7.0] * 4000
    columns = [pa.array(texts), pa.array(numbers), pa.array(range(24_000)), pa.nulls(24_000, pa.string())]
    rows = list(zip(*(c.to_pylist() for c in columns)))
    with BookWriter(str(tmp_path / "a.xlsx")).open() as writer:
        with writer.sheet("blocks", ["t", "n", "i", "none"]) as add:
            text, starts = row_texts(columns, 24_000)
            add.add(text[starts[0] : starts[-1]], 24_000)
        with writer.sheet("rows", ["t", "n", "i", "none"]) as add:
            for row in rows:
                add(row)
    found = []
    with open_workbook(str(tmp_path / "a.xlsx")) as made:
        for spaced in (False, True):
            for _, member in sheet_parts(made):
                text = made.read(member)
                if spaced:  # not plain any more
                    text = text.replace(b"</row>", b" </row>")
                with monkeypatch.context() as patched:
                    if not spaced:
                        seen = []
                        patched.setattr(cells, "text_of", lambda item: seen.append(item))
                    table = cells.Table(__import__("io").BytesIO(text), cells.SharedStrings(made))
                    assert table.headers == ["t", "n", "i", "none"]
                    found.append(list(table.rows()))
                    if not spaced:
                        assert not seen
    assert len(found[0]) == 24_000 and found[0] == found[1] == found[2] == found[3]


@pytest.mark.parametrize(
    "rows",
    [
        "<row><c><v>1</v></c></row><row><c/><c/></row>", "<row> <c><v>1</v></c><c/></row>", "<row><c/> <c/></row>",
        "<row><c><v>1</v></c></row> <row><c/></row>", "<row><c><v>&#65;</v></c></row>", "<row><c><v>1</v></c> </row>",
        "<row><!-- x --><c/></row>", '<row><c t="s"><v>0</v></c></row>',
    ],
)
def test_other_rows_are_parsed(rows):
    from adsettle.sources.cells import plain_block

    assert plain_block(rows.encode()) is None


def test_staged_pages_are_read_in_small_groups(spark):
    """However long a page is, a task holds few rows of it."""
    from pyarrow import parquet

    from adsettle.operators.pages import GROUP_ROWS, sorted_files

    path = sorted_files(spark.range(0, 70_000, 1, 1), 1_000_000).removeprefix("file:")
    sizes = []
    for file in __import__("pathlib").Path(path).glob("*.parquet"):
        metadata = parquet.ParquetFile(file).metadata
        sizes += [metadata.row_group(i).num_rows for i in range(metadata.num_row_groups)]
    assert sum(sizes) == 70_000 and max(sizes) <= GROUP_ROWS


def test_rewritten_result_is_cut_by_position(spark, tmp_path, monkeypatch):
    """Half of a result isn't taken by a limit, which brings it to one task."""
    from pyspark.sql.classic.dataframe import DataFrame

    from catalog.batches import workbook_rewritten

    orders = spark.range(1900).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "double(id % 90) AS o_totalprice",
        "timestamp_ntz'2024-01-01 00:00:00' AS o_orderdate", "'x' AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(DataFrame, "limit", None)
    rows = workbook_rewritten(spark, str(tmp_path)).collect()
    assert len(rows) == 950 and {r.file for r in rows} == {f"orders_part{i}.xlsx" for i in (1, 2, 3)}
    first = sorted((r.amount, -int(r.id)) for r in rows)
    assert first == sorted((float(i % 90), -i) for i in range(1900))[-950:]


JOINED = [
    "<row>{a}{a}</row><row>{a} {a}</row>", "<row>{a}{a}</row> <row>{a}{a}</row>", "<row>{a}{a}</row><row> {a}{a}</row>",
    "<row>{a}{a}</row><row>{a}{a} </row>", "<row>{a}{a}</row><row>{a}</row>", "<row>{a}{b}</row><row>{a}<x/>{b}</row>",
    "<row>{b}{b}</row><row>{b}\n{b}</row>",
]


@pytest.mark.parametrize("rows", JOINED)
def test_joined_rows_are_plain_only_without_gaps(rows):
    """Cells and rows that follow each other as this library writes them don't hide others that stand apart."""
    from adsettle.sources.cells import plain_block

    held = {"a": '<c t="inlineStr"><is><t>x&lt;</t></is></c>', "b": "<c><v>1</v></c>"}
    assert plain_block(rows.format(**held).encode()) is None
    whole = "<row>{a}{a}{b}{b}</row><row>{a}<c/>{b}{a}</row><row><c/>{a}{a}{a}</row><row>{a}{b}{a}<c/></row>".format(**held)
    block = plain_block(whole.encode())
    assert block.filled.shape == (4, 4)
    found = [block.column(i, __import__("numpy").arange(4)).to_pylist() for i in range(4)]
    assert found == [["x<", "x<", None, "x<"], ["x<", None, "x<", "1"], ["1", "1", "x<", "x<"], ["1", "x<", "x<", None]]


def test_rows_of_grouped_books_dont_pass_through_spark(spark, tmp_path, monkeypatch):
    """A task that writes a book reads its staged pages itself: it is told pages, not rows."""
    from adsettle.sinks import workbook as sink

    given, write = [], sink.write_books

    def seen(df, folder, **options):
        given.append(df.count())
        write(df, folder, **options)

    monkeypatch.setattr(sink, "write_books", seen)
    names = ["a/é \"x\"", "b", "a/é \"x\"", "c\\d"]
    rows = spark.createDataFrame([(names[i % 4], str(i), i, i / 7 if i % 3 else None, None) for i in range(500)],
                                 "file string, t string, n long, v double, none string").repartition(3)
    sink.write_grouped_books(rows, str(tmp_path / "told"), "file", cap=100)
    assert given == [7]
    dated = rows.withColumn("none", F.lit(None).cast("date"))  # of other types, rows are written as before
    sink.write_grouped_books(dated, str(tmp_path / "rows"), "file", cap=100)
    assert given == [7, 500]
    schema = "_entry string, _file string, t string, n string, v string, none string"
    told, passed = (
        sorted(map(tuple, spark.read.format("workbook").schema(schema).load(str(tmp_path / x)).collect()), key=str)
        for x in ("told", "rows")
    )
    plain = lambda found: sorted((n, v) for *_, n, v, _ in found)
    assert len(told) == 500 and plain(told) == plain(passed)
    assert {x[1] for x in told} == {'é "x"_part1.xlsx', 'é "x"_part2.xlsx', 'é "x"_part3.xlsx', "b_part1.xlsx", "b_part2.xlsx"} | {
        "c\\d_part1.xlsx", "c\\d_part2.xlsx"
    }
