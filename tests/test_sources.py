"""File connectors: quoting, CRLF, scientific notation, empty fields, '.'
missing markers, unquoted commas in the last taxonomy field."""

import datetime as dt
import os
import tempfile

from kestrel.sources import files as FS


def _tmp():
    return tempfile.mkdtemp(prefix="kestrel-src-", dir="/tmp")


def test_quoted_csv_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 2), 7, 1.25e-3, None), (dt.date(2020, 1, 3), 8, -0.5, 12.5)],
                               "d date, id long, ret double, price double")
    p = os.path.join(_tmp(), "csv")
    FS.write_panel_csv(df, p)
    raw = "".join(open(os.path.join(p, f), newline="").read() for f in sorted(os.listdir(p)) if f.endswith(".csv"))
    assert "\r\n" in raw and 'Supplier ""7"", inc' in raw and "E-03" in raw
    back = {r.id: r for r in FS.read_panel_csv(spark, p).collect()}
    assert back[7].price is None and abs(back[7].ret - 1.25e-3) < 1e-12 and back[8].d == dt.date(2020, 1, 3)
    assert back[7].name == 'Supplier "7", inc'


def test_whitespace_positional_missing(spark):
    df = spark.createDataFrame([(1, None, 2.5), (2, "x", None)], "a long, b string, c double")
    p = os.path.join(_tmp(), "txt")
    FS.write_whitespace(df, p)
    spark.createDataFrame([(" 3   y",), ("4  z  bad",)], "value string").write.mode("append").text(p)   # short line, bad number
    back = sorted(FS.read_whitespace(spark, p, "a long, b string, c double").collect(), key=lambda r: r.a)
    assert [tuple(r) for r in back] == [(1, None, 2.5), (2, "x", None), (3, "y", None), (4, "z", None)]


def test_taxonomy_lines(spark):
    e = spark.createDataFrame([("Root", "a"), ("a", "a/x")], "parent string, child string")
    p = os.path.join(_tmp(), "tax")
    FS.write_taxonomy(e, p)
    rows = {r.child: r for r in FS.read_taxonomy(spark, p).collect()}
    assert rows["a/x"].description == "node a/x, level, and more"     # commas kept in the last field
    assert rows["Root"].parent == "None"                              # kept for tree_load to drop
