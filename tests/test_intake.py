import bz2
import csv
import gzip
import io
import random
import zlib

import pyarrow as pa
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from contractframe.contract import contract_from_dict
from contractframe.sources import changelog, deliver, firstbytes, intake, quotes
from contractframe.storage import ROW_ID


@pytest.fixture
def write(tmp_path):
    def make(name, content):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
        return str(path)

    return make


PLAIN = "Name,Age,Score\nAda,36,9.5\nBob,41,8\nCy,29,7.25\n"


def read(spark, path, **options):
    return intake.read_delimited(spark, path, **options).table


def test_csv_and_tsv(spark, write, rows):
    expected = [(0, "Ada", 36, 9.5), (1, "Bob", 41, 8.0), (2, "Cy", 29, 7.25)]
    for path in (write("a.csv", PLAIN), write("a.tsv", PLAIN.replace(",", "\t")), write("a.tab", PLAIN.replace(",", "\t"))):
        got = read(spark, path)
        assert got.columns == [ROW_ID, "Name", "Age", "Score"] and rows(got) == expected


def test_unsupported_suffix(spark, write):
    with pytest.raises(ValueError, match="unsupported"):
        read(spark, write("a.xyz", PLAIN))


def test_header_row(spark, write, rows):
    path = write("p.csv", "Report\nJanuary\n" + PLAIN)
    assert rows(read(spark, path, header_row=2)) == rows(read(spark, path, header_row="auto")) == rows(read(spark, write("a.csv", PLAIN)))


def test_header_behind_a_blank_line(spark, write, rows):
    path = write("p.csv", '"A title, with a comma"\n\n' + PLAIN)
    got = read(spark, path, header_row="auto")
    assert got.columns == [ROW_ID, "Name", "Age", "Score"] and got.count() == 3
    head = intake.header_rows(spark, [path]).first()
    assert (head["header_row"], head["header_skip"], head["columns"]) == (2, 1, ["Name", "Age", "Score"])


@pytest.mark.parametrize(
    "content, row",
    [("a,b\n1,2\n", 0), ("1,2,3\nx,y,z\n", 1), ("1,2\n", 0), ("title\n\n\nx,y\n", 3), ("only one\n", 0), ("$1,5%,x\nq,r,s\n", 1)],
)
def test_header_guess(spark, write, content, row):
    assert intake.header_rows(spark, [write("g.csv", content)]).first()["header_row"] == row


def test_row_cap(spark, write, rows):
    assert rows(read(spark, write("a.csv", PLAIN), nrows=2), "Name") == [("Ada",), ("Bob",)]


@pytest.mark.parametrize(
    "content, encoding, bom",
    [("Café,1\n".encode("latin-1"), "iso-8859-1", False), ("Zürich,1\n".encode(), "utf-8", False), ("Zürich,1".encode(), "utf-8", False),
     (b"\xef\xbb\xbfName,Age\nx,1\n", "utf-8-sig", True), (b"\xef\xbb\xbfName,Age\r\nx,1", "utf-8-sig", True), (b"a\n\n", "utf-8", False)],
)
def test_encoding(spark, write, content, encoding, bom):
    got = intake.file_encoding(spark, [write("e.csv", content)]).first()
    assert (got["encoding"], got["has_bom"]) == (encoding, bom)


def test_mixed_encodings_in_one_table(spark, write, rows):
    paths = [write("a.csv", "Name,N\nCafé,1\n".encode("latin-1")), write("b.csv", b"\xef\xbb\xbf" + "Name,N\nZürich,2\n".encode())]
    assert rows(read(spark, paths)) == [(0, "Café", 1), (1, "Zürich", 2)]


def test_quotes_missing_texts_and_types(spark, write, rows):
    path = write("q.csv", 'A,B,C,D,E\n"x, ""y""",NA,1,True,\n, 2.5 ,,False,\nNone,nan,3,True,\n')
    got = read(spark, path)
    assert [t for _, t in got.dtypes] == ["bigint", "string", "double", "double", "boolean", "double"]
    assert rows(got.drop(ROW_ID)) == sorted([('x, "y"', None, 1.0, True, None), (None, 2.5, None, False, None), (None, None, 3.0, True, None)], key=repr)
    assert [t for _, t in read(spark, path, infer=False).dtypes][1:] == ["string"] * 5


def test_line_breaks_inside_quotes(spark, write, rows):
    path = write("m.csv", 'A,B\n"x\ny",1\nz,2\n"a ""q""\n\n,",3\n')
    assert rows(read(spark, path), "A", "B") == [('a "q"\n\n,', 3), ("x\ny", 1), ("z", 2)]


def test_a_quote_inside_a_cell_is_text(spark, write, rows):
    assert rows(read(spark, write("i.csv", 'a,b\n1,5" pipe\n2,x\n'))) == [(0, 1, '5" pipe'), (1, 2, "x")]
    got = read(spark, write("t.csv", 'a,b\n1,5" pipe\n2,6" pipe\n"3\n""",7" and "8\n'), infer=False)
    assert rows(got) == [(0, "1", '5" pipe'), (1, "2", '6" pipe'), (2, '3\n"', '7" and "8')]
    with pytest.raises(ValueError, match="more cells"):
        read(spark, write("r.csv", 'a,b\n1,5" pipe\n2,6",7"\n'))


QUOTED = ["", "x", '"', '""', ",", "\n", "\r\n", "é", " ", '","', '"\n', '\n"', "12", '""""']


def test_states_of_lines_are_those_of_the_plain_automaton(spark):
    """Every line's true state, against an automaton fed character by character."""
    deal = random.Random(8)
    texts = [("".join(deal.choices(QUOTED, k=deal.randrange(14))), deal.random() < 0.4) for _ in range(600)]
    data = [(f"{k:04}", 0, i, v, inside) for k, (text, inside) in enumerate(texts) for i, v in enumerate(text.split("\n"))]
    df = spark.createDataFrame(data, "file string, block bigint, pos bigint, value string, begun boolean")
    got = quotes.with_states(quotes.with_functions(df, "','"), ["file"], ["pos"], F.col("begun")).orderBy("file", "pos").collect()
    want = []
    for text, inside in texts:
        state = "in" if inside else "start"
        machine = quotes.Machine(",")
        machine.open = inside
        for line in text.split("\n"):
            want.append(state == "in")
            assert machine.open == want[-1]
            machine.feed(line.encode())
            for c in line:
                if state == "in":
                    state = "behind" if c == '"' else "in"
                elif state == "behind":
                    state = "in" if c == '"' else "start" if c == "," else "cell"
                elif state == "start" and c == '"':
                    state = "in"
                else:
                    state = "start" if c == "," else "cell"
            state = "in" if state == "in" else "start"
    assert [r["inside"] for r in got] == want


def test_blocks_that_begin_inside_a_cell(spark, write, rows, monkeypatch):
    """A file of many small blocks and chunks whose cells go on over them, against the csv module."""
    monkeypatch.setattr(quotes, "CHUNK", 16)
    deal = random.Random(3)
    cells = ["x", "", 'say "hi"', "two\nlines", "a,b", "\n\n", "é" * 40, "q" * 300 + "\n" + "r" * 300, 'end"', "1"]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([["k", "v", "w"], *[[i, deal.choice(cells), deal.choice(cells)] for i in range(3000)]])
    text = out.getvalue().replace("\n7,", "\n\n7,").replace('"a,b"\n', '"a,b"\r\n')
    want = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = read(spark, [write("big.csv", text), write("tail.csv", "k,v,w\n7,8,9\n")], infer=False)
        assert rows(got) == sorted([(i, *[c if c != "" else None for c in r]) for i, r in enumerate([*want[1:], ["7", "8", "9"]])], key=repr)
        assert got.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


class Counting(io.BytesIO):
    asked = 0

    def read(self, n=-1):
        self.asked += n if n >= 0 else 1 << 62
        return super().read(n)


def test_heads_read_the_first_bytes_alone():
    for size in (1_000, 100_000):
        file = Counting(("Name,Age\n" + "x,1\n" * size).encode())
        head = firstbytes.head_of(file.read, ",", 10, None, "iso-8859-1")
        assert len(head) == 10 and file.asked == firstbytes.RANGE
    long = Counting(b"\xef\xbb\xbfA,B\n" + b"y" * 300_000 + b",2\nz,3\n" + b"w,4\n" * 100_000)
    head = firstbytes.head_of(long.read, ",", 3, None, "iso-8859-1")
    assert [(r[0], len(r[2])) for r in head] == [("utf-8-sig", 3), ("utf-8-sig", 300_002), ("utf-8-sig", 3)] and long.asked <= 6 * firstbytes.RANGE


@pytest.mark.parametrize("suffix, pack", [(".gz", gzip.compress), (".bz2", bz2.compress), (".deflate", zlib.compress)])
def test_marks_and_heads_of_compressed_files(spark, write, rows, suffix, pack):
    path = write("m.csv" + suffix, pack(b"\xef\xbb\xbf" + PLAIN.encode()))
    assert tuple(intake.file_encoding(spark, [path]).select("has_bom", "encoding").first()) == (True, "utf-8-sig")
    assert intake.header_rows(spark, [path]).first()["columns"] == ["Name", "Age", "Score"]
    got = read(spark, path, sep=",")
    assert got.columns[1] == "Name" and got.count() == 3
    assert read(spark, path, sep=",", nrows=1).count() == 1


def test_a_row_cap_reads_no_further(spark, write, rows, monkeypatch):
    text = 'Name,N\n"a\nb",1\n\n' + "".join(f"x{i},{i}\n" for i in range(200_000))
    file = Counting(text.encode())
    monkeypatch.setattr(firstbytes, "files_of", lambda spark, paths: FakeFiles())
    monkeypatch.setattr(firstbytes, "opened", lambda name: file)
    monkeypatch.setattr(firstbytes, "ship_package", lambda spark: None)
    got = firstbytes.capped_lines(spark, ["f"], ",", 101).collect
    lines = [v for b in got() for v in b.column("value").to_pylist()]
    assert len(lines) == 103 and lines[:3] == [b"Name,N", b'"a', b'b",1'] and file.asked == firstbytes.RANGE


class FakeFiles:
    """Stands for a listing of one file; runs the task's function here, where reads can be counted."""

    def select(self, *columns):
        return self

    def mapInArrow(self, read, schema):
        self.read = read
        return self

    def withColumn(self, name, value):
        return self

    def collect(self):
        return list(self.read([pa.RecordBatch.from_pydict({"file": ["f"]})]))


def test_caps_count_records(spark, write, rows):
    paths = [write("a.csv", 'Name,N\n"a\nb",1\n\n' + "".join(f"x{i},{i}\n" for i in range(500))), write("b.csv", "Name,N\nz,9\n")]
    assert rows(read(spark, paths, nrows=3)) == [(0, "a\nb", 1), (1, "x0", 0), (2, "x1", 1), (3, "z", 9)]
    assert rows(read(spark, paths, nrows=2, header_row="auto"), "Name") == [("a\nb",), ("x0",), ("z",)]


def test_headers_over_several_lines(spark, write, rows):
    path = write("h.csv", '"a title\nover lines",x\n"Na\nme",Age\nq,1\n')
    assert read(spark, path, header_row=1).columns == [ROW_ID, "Na\nme", "Age"]


def test_jobs_do_not_grow_with_schemas(spark, write):
    """As many jobs for twelve files of three schemas as for twelve of as many schemas."""

    def jobs(paths, group):
        spark.sparkContext.setJobGroup(group, group)
        report, tables = intake.bulk_intake(spark, paths)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), report, tables

    one, *_ = jobs([write(f"t{i}.csv", PLAIN.replace("Age", f"Age{i % 3}")) for i in range(12)], "three-schemas")
    many, report, tables = jobs([write(f"s{i}.csv", PLAIN.replace("Age", f"Age{i}")) for i in range(12)], "twelve-schemas")
    assert report.count() == len(tables) == 12
    assert many <= one + 1


def test_a_quote_that_stays_open_is_an_error(spark, write):
    with pytest.raises(ValueError, match="quote stays open in .*open.csv"):
        read(spark, [write("fine.csv", "A,B\n1,2\n"), write("open.csv", 'A,B\n"x,1\ny,2\n')])


def test_rows_with_too_many_cells(spark, write, rows):
    paths = [write("a.csv", "x,y\n1,2\n"), write("b.csv", 'x,y\n"3,3",4\n3,4,5\n6\n')]
    with pytest.raises(ValueError, match=r"row 2 of the table, in .*b.csv.*'3,4,5'"):
        read(spark, paths)
    got = intake.read_delimited(spark, paths, ragged="split")
    assert rows(got.table) == [(0, "1", 2.0), (1, "3,3", 4.0), (3, "6", None)]
    assert [(r[ROW_ID], r["row"]) for r in got.ragged.collect()] == [(2, "3,4,5")]
    # Lines above the header may have any width.
    assert read(spark, write("t.csv", "a,b,c,d\nx,y\n1,2\n"), header_row=1).count() == 1


@pytest.mark.parametrize("second", ["x,y,z\n1,2,3\n", "x\n1\n"])
def test_wider_and_narrower_headers_are_refused(spark, write, second):
    with pytest.raises(ValueError, match="differ"):
        read(spark, [write("a.csv", "x,y\n1,2\n"), write("b.csv", second)])


def test_header_behind_many_blank_lines(spark, write):
    assert read(spark, write("b.csv", "title\n" + "\n" * 60 + PLAIN), header_row=1).columns == [ROW_ID, "Name", "Age", "Score"]
    assert read(spark, write("c.csv", "\n" * 60 + PLAIN)).count() == 3
    with pytest.raises(ValueError, match="no file has a header row 9"):
        read(spark, write("d.csv", PLAIN), header_row=9)


@pytest.mark.parametrize("codec", ["utf-16-le", "utf-16-be"])
def test_sixteen_bit_files(spark, write, rows, codec):
    text = PLAIN + '"上海\nĊ",1,2\n'
    path = write("w.csv", ("\ufeff" + text).encode(codec))
    assert tuple(intake.file_encoding(spark, [path]).select("has_bom", "is_utf8", "encoding").first()) == (True, False, "utf-16")
    assert rows(read(spark, path)) == rows(read(spark, write("n.csv", text)))
    both = intake.read_delimited(spark, [write("a.csv", PLAIN), path]).table
    assert both.count() == 7 and both.columns == [ROW_ID, "Name", "Age", "Score"]
    assert rows(read(spark, write("u.csv", PLAIN.encode(codec)), encoding=codec)) == rows(read(spark, write("a.csv", PLAIN)))


def test_head_lines_are_cut_in_each_task(spark, write, monkeypatch):
    """Where only Spark can open the files."""
    paths = [write("a.csv", PLAIN), write("b.csv", "Report\n\n" + PLAIN)]
    expected = intake.header_rows(spark, paths).drop("mark").collect()
    monkeypatch.setattr(intake.firstbytes, "can_open", lambda paths: False)
    assert "WindowGroupLimit" in plan_of(intake.head_lines(spark, paths))
    assert sorted(intake.header_rows(spark, paths).drop("mark").collect()) == sorted(expected)
    assert intake.file_encoding(spark, paths).where("encoding <> 'utf-8'").count() == 0


def test_profiles_of_all_groups(spark, write, rows):
    paths = [write("a.csv", PLAIN), write("b.csv", PLAIN), write("c.csv", "Date,Amount\n2024-01-01,5\n")]
    _, tables = intake.bulk_intake(spark, paths)
    got = intake.profile_groups(tables)
    assert rows(got, "group_index", "column", "null_count") == [
        (0, "Age", 0), (0, "Name", 0), (0, "Score", 0), (1, "Amount", 0), (1, "Date", 0)]


def test_repeated_and_empty_header_names(spark, write):
    assert read(spark, write("h.csv", "a,a,,b\n1,2,3,4\n")).columns == [ROW_ID, "a", "a.1", "Unnamed: 2", "b"]


def test_blocks_of_one_file_keep_their_order(spark, write):
    path = write("big.csv", "k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = read(spark, path)
        assert got.count() == 20_000 and got.where("k <> _row_id").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_schema_groups_and_bulk(spark, write, rows):
    paths = [write("a.csv", PLAIN), write("b.csv", PLAIN), write("c.csv", "Date,Amount,Category\n2024-01-01,5,x\n")]
    groups = intake.schema_groups(intake.header_rows(spark, paths))
    assert rows(groups, "group_index", "file_count") == [(0, 2), (1, 1)]
    report, tables = intake.bulk_intake(spark, paths)
    assert rows(report, "group_index", "file_count", "total_rows") == [(0, 2, 6), (1, 1, 1)]
    assert rows(tables[0].table, ROW_ID) == [(i,) for i in range(6)]
    assert report.where("group_index = 1").first()["columns"] == ["Date", "Amount", "Category"]


def test_files_of_different_schema_are_refused(spark, write):
    with pytest.raises(ValueError, match="differ"):
        read(spark, [write("a.csv", PLAIN), write("c.csv", "Date,Amount\n1,2\n")])


def test_empty_files_are_left_out(spark, write, rows):
    paths = [write("a.csv", PLAIN), write("e.csv", "")]
    assert intake.file_encoding(spark, paths).count() == intake.header_rows(spark, paths).count() == 1
    assert read(spark, paths).count() == 3


def test_snapshots_are_append_only(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    intake.land_raw(spark.range(3), path, "20240601T000000Z")
    intake.land_raw(spark.range(5), path, "20240602T000000Z")
    assert intake.read_raw(spark, path, "20240601T000000Z").count() == 3


def test_manifest_and_sample(spark, rows):
    df = spark.range(100).select(F.col("id").alias(ROW_ID), F.col("id").cast("string").alias("v"))
    assert rows(intake.intake_manifest(df)) == [(100, 1, 0, "v", "string")]
    assert sorted(r[ROW_ID] for r in intake.first_rows_of(df).collect()) == list(range(50))


def test_change_log(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    assert changelog.read_log(spark, path).count() == 0
    log = changelog.ChangeLog(spark, path)
    log.log("clean", "stripped", 3, {"column": "a"})
    log.flush()
    log.log("derive", "done")
    assert rows(log.read_all(), "stage", "event", "rows_affected", "details") == [
        ("clean", "stripped", 3, '{"column": "a"}'), ("derive", "done", 0, "{}")]


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_delivery(spark, tmp_path, format):
    c = contract_from_dict({"fields": [{"name": "a", "allowed_values": [1, 2], "min": 0}], "derived_fields": [{"name": "b", "transformation": "a + a"}]})
    at = deliver.deliver(spark.range(3), c, changelog.read_log(spark, str(tmp_path / "none")), str(tmp_path / "out"), format)
    back = {k: spark.read.option("header", True).format(format).load(v) for k, v in at.items()}
    assert back["data"].count() == 3 and back["changes"].count() == 0
    got = {r["field_name"]: r for r in back["dictionary"].collect()}
    assert (got["a"]["allowed_values"], got["a"]["min"], got["b"]["source_column"]) == ("1, 2", "0", "(derived)")
