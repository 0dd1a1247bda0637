"""Sources and sinks: bad inputs, fallbacks and replacement."""

import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linenet.functions.geometry import parse_wkt
from linenet.session import scratch_path, shared_root
from linenet.sources import artifacts as ar
from linenet.sources import catalogs as ct
from linenet.sources import grids as gr
from linenet.sources import layers as ly
from linenet.sources import tables as tb


def test_shared_root_is_the_setting(spark):
    assert scratch_path(spark, "x").startswith(shared_root(spark))
    assert spark.conf.get("spark.checkpoint.dir") == shared_root(spark)


def test_bom_and_fallback(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿id;nom\n1;é\n".encode())
    (tmp_path / "west.csv").write_bytes("id;nom\n1;é €œ\n".encode("cp1252"))
    assert tb.read_table(spark, str(tmp_path / "bom.csv")).first().asDict() == {"id": "1", "nom": "é"}
    assert tb.read_table(spark, str(tmp_path / "west.csv"), ("UTF-8", "windows-1252")).first()["nom"] == "é €œ"


def test_encoding_of_each_file(spark, tmp_path):
    """Names of files may hold signs that mean something in paths or patterns; columns are matched by name."""
    (tmp_path / "é {a} [1].csv").write_bytes("id;nom\n1;é€\n".encode())
    (tmp_path / "b%20c.csv").write_bytes("nom;id\né €œ;2\n".encode("cp1252"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "no_rows.csv").write_bytes(b"id;nom\n")
    rows = {(r["id"], r["nom"]) for r in tb.read_table(spark, str(tmp_path), ("UTF-8", "cp1252")).collect()}
    assert rows == {("1", "é€"), ("2", "é €œ")}
    (tmp_path / "c d.csv").write_bytes("id;âge\n3;ü\n".encode("cp1252"))
    (tmp_path / "b%20c.csv").write_bytes("id;nom\n2;a\n".encode())
    rows = {(r["id"], r["nom"], r["âge"]) for r in tb.read_table(spark, str(tmp_path)).collect()}
    assert rows == {("1", "é€", None), ("2", "a", None), ("3", None, "ü")}


def test_partitions_stay_when_encodings_differ(spark, tmp_path):
    for city, code in (("a", "utf-8"), ("b", "latin-1")):
        (tmp_path / f"city={city}").mkdir()
        (tmp_path / f"city={city}" / "t.csv").write_bytes(f"id;nom\n{city}1;é\n".encode(code))
    rows = {(r["id"], r["nom"], r["city"]) for r in tb.read_table(spark, str(tmp_path)).collect()}
    assert rows == {("a1", "é", "a"), ("b1", "é", "b")}


def test_lookup_last_wins(spark, tmp_path):
    (tmp_path / "l.csv").write_text("k;v\n a ;1\nb;2\na;3\n;9\n")
    got = {r["key"]: r["value"] for r in tb.read_lookup(spark, str(tmp_path / "l.csv"), "k", "v").collect()}
    assert got == {"a": "3", "b": "2"}


def test_class_edges_must_fit(spark):
    ok = spark.createDataFrame([(10.0, "1"), (5.0, "2"), (None, "3")], "max double, label string")
    assert tb.class_edges(ok, "max", "label") == ([5.0, 10.0], ["1", "2", "3"])
    with pytest.raises(ValueError):
        tb.class_edges(ok.filter("label <> '3'"), "max", "label")


def test_catalog_goes_on_after_a_bad_source(spark, tmp_path):
    spark.createDataFrame([("x",)], "Mat string").write.parquet(str(tmp_path / "good" / "p"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "p").write_text("not a table")
    rows = [("A", "good", "p", "Mat"), ("B", "bad", "p", "Mat"), ("C", "none", "p", "Mat"), (" ", "good", "p", "Mat"), (None, "good", "p", None)]
    catalog = spark.createDataFrame(rows, "name string, folder string, file string, Materiau string")
    df, report = ct.scan_catalog(spark, catalog, str(tmp_path), {"Materiau": "string", "Pente": "double"})
    assert [r.asDict() for r in df.collect()] == [{"Materiau": "x", "Pente": None, "city": "A"}]
    status = {r["city"]: r["status"].split(":")[0] for r in report.collect()}
    assert status == {"A": "read", "B": "failed", "C": "missing"}


def test_layer_replaced_in_place(spark, tmp_path):
    path = str(tmp_path / "layers")
    ly.write_layer(spark.createDataFrame([(1,), (2,)], "a int"), path, "one")
    ly.write_layer(ly.read_layer(spark, path, "one", geometry=False).filter("a > 1"), path, "one")
    assert [r["a"] for r in spark.read.parquet(f"{path}/one").collect()] == [2]


def test_grid_header_forms(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.ASC").write_text("NCOLS 2\r\nNROWS 2\r\nXLLCENTER 5\r\nYLLCENTER 5\r\nCELLSIZE 10\r\nNODATA_VALUE -9\r\n1 -9\r\n 3 4.5 \r\n")
    (tmp_path / "B.asc").write_text("nothing here")
    (tmp_path / "c.txt").write_text("x")
    index = gr.tile_index(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in index] == [("a", 0.0, 0.0, 20.0, 20.0, 10.0, 2, 2, -9.0)]
    cells = gr.read_ascii_grid(spark, str(tmp_path)).filter("tile_id = 'a'").collect()
    assert sorted(tuple(r)[1:] for r in cells) == [(0, 0, 1.0), (0, 1, None), (1, 0, 3.0), (1, 1, 4.5)]
    assert sorted(r["stem"] for r in gr.list_tiles(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_failing_write_leaves_the_layer(spark, tmp_path):
    path = str(tmp_path / "net")
    ly.write_layer(spark.createDataFrame([(1,), (2,)], "a int"), path, "one")
    with pytest.raises(Exception, match="lost"):
        ly.write_layer(spark.range(2).select(F.raise_error(F.lit("lost")).cast("int").alias("a")), path, "one")
    assert sorted(r["a"] for r in ly.read_layer(spark, path, "one", geometry=False).collect()) == [1, 2]
    ly.write_layer(ly.read_layer(spark, path, "one", geometry=False).filter("a > 1"), path, "one")
    assert [r["a"] for r in ly.read_layer(spark, path, "one", geometry=False).collect()] == [2]


def test_missing_artifacts(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "there"))
    assert ar.missing_artifacts(spark, str(tmp_path), ["there", "gone"]) == ["gone"]


def test_departments(spark, tmp_path):
    for dep in ("01", "69"):
        spark.range(2).withColumn("v", F.lit(dep)).write.parquet(str(tmp_path / f"Dept_{dep}.zone"))
    got = ct.scan_parts(spark, str(tmp_path / "*")).collect()
    assert sorted((r["department"], r["v"]) for r in got) == [("01", "01")] * 2 + [("69", "69")] * 2


def test_class_edges_takes_every_row(spark):
    sheet = spark.range(12_001).selectExpr("if(id < 12000, double(id), null) AS max", "string(id) AS label")
    edges, labels = tb.class_edges(sheet, "max", "label")
    assert len(edges) == 12_000 and labels[-1] == "12000"
    with pytest.raises(ValueError):
        tb.class_edges(sheet, "max", "label", most=100)


def test_kinds_of_binary_geometry(spark):
    """Flags and thousands for Z and M, both byte orders, points and several polygons; others are counted."""
    def packed(order, code, *rest):
        return struct.pack(f"{order}BI", order == "<", code) + b"".join(rest)

    def run(order, *values, n=None):
        return struct.pack(f"{order}I", n if n is not None else len(values)) + struct.pack(f"{order}{len(values)}d", *values)

    box = [0.0, 0.0, 4.0, 0.0, 4.0, 4.0, 0.0, 4.0, 0.0, 0.0]
    far = [v + 10 for v in box]
    hole = [v / 4 + 1 for v in box]
    poly = packed("<", 3, struct.pack("<I", 2), run("<", *box, n=5), run("<", *hole, n=5))
    rows = {
        "point": packed("<", 1, struct.pack("<2d", 1, 2)), "point z": packed(">", 1001, struct.pack(">3d", 1, 2, 3)),
        "line z": packed("<", 1002, run("<", 1, 2, 9, 3, 4, 9, n=2)), "line m": packed(">", 2002, run(">", 1, 2, 9, 3, 4, 9, n=2)),
        "line zm": packed("<", 3002, run("<", 1, 2, 8, 9, 3, 4, 8, 9, n=2)),
        "flags": packed("<", 2 | 0x80000000 | 0x20000000, struct.pack("<I", 2154), run("<", 1, 2, 9, 3, 4, 9, n=2)),
        "areas": packed("<", 6, struct.pack("<I", 2), poly, packed("<", 3, struct.pack("<I", 1), run("<", *far, n=5))),
        "collection": packed("<", 7, struct.pack("<I", 0)), "short": packed("<", 2, run("<", 1, 2, n=3)), "none": None, "empty": b"",
    }
    df = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in rows.items()], "name string, wkb binary")
    got = {r["name"]: r["geom"] and [[(p.x, p.y) for p in part] for part in r["geom"]] for r in ly.parse_wkb(df).collect()}
    pairs = lambda flat: list(zip(flat[::2], flat[1::2], strict=True))
    assert got["point"] == got["point z"] == [[(1, 2)]]
    assert all(got[k] == [[(1, 2), (3, 4)]] for k in ("line z", "line m", "line zm", "flags"))
    assert got["areas"] == [pairs(box), pairs(hole), pairs(far)]
    assert all(got[k] is None for k in ("collection", "short", "none", "empty"))
    assert {r["start"]: r["n"] for r in ly.undecoded(df).collect()} == {"0107000000": 1, "0102000000": 1, "": 1}
    back = ly.to_wkb(ly.parse_wkb(df.where("name = 'areas'")), polygons=True).first()["wkb"]
    assert bytes(back) == rows["areas"]


def test_kinds_of_text_geometry(spark):
    texts = {
        "POINT Z (1 2 3)": [[(1, 2)]], "LINESTRING ZM (1 2 3 4, 5 6 7 8)": [[(1, 2), (5, 6)]], "linestring m(1 2 3,5 6 7)": [[(1, 2), (5, 6)]],
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (2 2, 3 2, 3 3, 2 2)), ((7 7, 8 7, 8 8, 7 7)))": [[(a, a), (a + 1, a), (a + 1, a + 1), (a, a)] for a in (0, 2, 7)],
        "MULTIPOLYGON EMPTY": [], "CIRCULARSTRING (1 2, 3 4, 5 6)": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_wkt(F.col("t")).alias("g"))
    got = {r["t"]: r["g"] if r["g"] is None else [[(p.x, p.y) for p in part] for part in r["g"]] for r in df.collect()}
    assert got == texts


def test_plain_lines_are_read_together(monkeypatch):
    """Lines of one and of few parts need no walk of their own; broken, other and long ones keep theirs, in their place."""
    def line(*xy, order="<"):
        return struct.pack(order + "BII", order == "<", 2, len(xy)) + b"".join(struct.pack(order + "2d", *p) for p in xy)

    def multi(*parts):
        return struct.pack("<BII", 1, 5, len(parts)) + b"".join(parts)

    a, b, c = line((0, 1), (2, 3)), line((4, 5)), line()
    plain = [(a, [[(0, 1), (2, 3)]]), (multi(b, a), [[(4, 5)], [(0, 1), (2, 3)]]), (None, None), (c, [[]]), (multi(b, c), [[(4, 5)], []]), (b + b"x", [[(4, 5)]])]
    other = [
        (line((6, 7), order=">"), [[(6, 7)]]), (multi(), []), (multi(b, line((8, 9), order=">")), [[(4, 5)], [(8, 9)]]), (a[:-1], None), (b"", None),
        (multi(a, b)[:-1], None), (multi(*[b] * 70), [[(4, 5)]] * 70), (struct.pack("<BI2d", 1, 1, 1, 2), [[(1, 2)]]),
    ]

    def read(values):
        got = ly._decode(pa.array([v for v, _ in values], pa.binary()))
        return got, [g and [[(p["x"], p["y"]) for p in part] for part in g] for g in got.to_pylist()]

    mixed = [x for pair in zip(other, [*plain, *plain[:2]]) for x in pair]
    assert read(mixed)[1] == [want for _, want in mixed]
    monkeypatch.setattr(ly, "_read", None)
    got, parts = read(plain)
    assert parts == [want for _, want in plain]
    assert ly._encode_lines(got).to_pylist() == [v and (v[:-1] if v.endswith(b"x") else v) for v, _ in plain]
    assert ly._encode_lines(got.slice(1, 3)).to_pylist() == [plain[1][0], None, c]
