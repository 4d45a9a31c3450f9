"""Files whose headers drift."""

from pyspark.sql import types as T

from lodeplane.sources.drifting import lines_of, read_drifting

COLUMNS = {"code": T.StringType(), "name": T.StringType(), "n": T.IntegerType(), "x": T.DoubleType()}
NAMES = {"Code": "code", "code of it": "code", "Name": "name", "Vagas": "n", "Mean": "x"}


def test_layouts_reports_and_a_file_without_anchor(spark, tmp_path):
    files = {
        "a.csv": "Code;Name;Vagas;Mean\n0101;One;3;1,5\n(1);(2);(3);(4)\n\n0102; Two ;x;nan\n",
        "b.csv": "Some title\r\n;;\r\n;code  of it;Mean;\"Na;me\";Name\r\n;0201;2.5;\"q;\"\"r\"\"\";Three\r\n;Code;Mean;;\r\n;0202;;;\r\n",
        "c.csv": "Nothing;of;use\n0301;a;1;2\n",
        "d.csv": "",
        "e.csv": "\n" * 25 + "Code;Name\n0401;Late\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    read, report = read_drifting(spark, str(tmp_path), ("Code", "code of it"), COLUMNS, NAMES, "[0-9]{4}")
    assert sorted(map(tuple, read.collect())) == [
        ("a.csv", "0101", "One", 3, 1.5), ("a.csv", "0102", "Two", None, None), ("b.csv", "0201", "Three", None, 2.5), ("b.csv", "0202", None, None, None),
    ]
    got = {r.file: (r.status, r["shift"], r.n_rows, r.unknown) for r in report.collect()}
    assert got["a.csv"] == ("read", 0, 2, []) and got["b.csv"] == ("read", 1, 2, ["Na;me"])
    assert got["c.csv"] == got["e.csv"] == ("no anchor", None, 0, [])  # an anchor below the first rows is none


def test_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a;b;\n"c;d";;"e ""f"""\n\nlast')
    rows = [r.cells for r in sorted(lines_of(spark, str(tmp_path)).collect(), key=lambda r: r.row)]
    assert rows == [["a", "b", ""], ["c;d", "", 'e "f"'], [""], ["last"]]
