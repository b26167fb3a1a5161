"""Readers and sinks on small files."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from farfield.operators import rings
from farfield.sources import files, opl, osm_xml, outline, sinks


def test_digests(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    row = files.digests(spark, str(tmp_path)).first()
    assert (row["size"], row["md5"], row["sha256"]) == (5, hashlib.md5(b"hello").hexdigest(), hashlib.sha256(b"hello").hexdigest())


def test_opl(spark, tmp_path):
    (tmp_path / "x.opl").write_text("n1 v1 dV T x25.1 y54.2\nw5 v1 dV Thighway=track,name=A%20%b Nn1,n2,n1\nr9 v1 dV Ttype=boundary,admin_level=2 Mw5@outer,n1@label\n# note\n")
    rows = {r["kind"]: r for r in opl.read_opl(spark, str(tmp_path)).collect()}
    assert (rows["n"]["lon"], rows["n"]["lat"]) == (25.1, 54.2)
    assert rows["w"]["tags"] == {"highway": "track", "name": "A b"} and rows["w"]["nodes"] == [1, 2, 1]
    assert [tuple(m) for m in rows["r"]["members"]] == [("w", 5, "outer"), ("n", 1, "label")]
    assert opl.relations(opl.read_opl(spark, str(tmp_path)), ["2"]).count() == 1


def test_osm_xml(spark, tmp_path):
    (tmp_path / "x.osm").write_text('<osm><node id="1" lat="54.2" lon="25.1"/><way id="5"><nd ref="1"/><nd ref="2"/><tag k="highway" v="primary"/></way><relation id="9"><member type="way" ref="5" role="outer"/></relation></osm>')
    spark.dataSource.register(osm_xml.OsmXml)
    rows = {r["kind"]: r for r in spark.read.format("osm_xml").load(f"{tmp_path}/*.osm").collect()}
    assert rows["n"]["lat"] == 54.2 and rows["w"]["nodes"] == [1, 2] and rows["w"]["tags"] == {"highway": "primary"} and tuple(rows["r"]["members"][0]) == ("w", 5, "outer")


def test_outline(spark, tmp_path):
    (tmp_path / "x.poly").write_text("name\n1\n 0 0\n 4 0\n 4 4\n 0 4\nEND\n!2\n 1.0E0 1\n 1 2\n 2 2\nEND\nEND\n")
    rows = outline.read_outline(spark, str(tmp_path / "x.poly")).collect()
    assert len(rows) == 7 and sum(r["hole"] for r in rows) == 3 and {r["ring"] for r in rows} == {1, 2} or len({r["ring"] for r in rows}) == 2


def test_json_with_a_wrong_shape_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": "text"}\n')
    schema = StructType([StructField("a", LongType())])
    with pytest.raises(Exception):
        files.read_json(spark, str(tmp_path / "x.json"), schema).collect()
    assert files.read_json(spark, str(tmp_path / "x.json"), StructType([StructField("a", StringType())])).first()["a"] == "text"


def test_union_of_schemas(spark):
    out = files.union_all([spark.createDataFrame([(1, "x")], "a long, b string"), spark.createDataFrame([(2, True)], "a long, c boolean")])
    assert out.columns == ["a", "b", "c"] and out.count() == 2


def test_results_replace_only_their_keys(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_results(spark.createDataFrame([(1, "A"), (2, "B")], "v long, k string"), path, ["k"])
    sinks.write_results(spark.createDataFrame([(3, "B")], "v long, k string"), path, ["k"])
    assert sorted((r["v"], r["k"]) for r in spark.read.parquet(path).collect()) == [(1, "A"), (3, "B")]


def test_rings_from_ways(spark):
    rows = [(1, 10, i, n) for i, n in enumerate((1, 2, 3))] + [(1, 11, i, n) for i, n in enumerate((1, 4, 3))] + [(1, 12, i, n) for i, n in enumerate((9, 8))]
    got = rings.assemble(spark.createDataFrame(rows, "area_id long, way_id long, seq long, node long")).orderBy("ring", "seq").collect()
    assert [r["node"] for r in got if r["ring"] == 0] == [1, 2, 3, 4, 1] and got[0]["closed"]
    assert [r["closed"] for r in got if r["ring"] == 1] == [False, False]


def test_stream_of_views(spark, tmp_path):
    from farfield.streaming import views

    src = str(tmp_path / "in")
    spark.sql("SELECT timestamp'2024-01-01 00:00:01' AS ts, 'view' AS event_type UNION ALL SELECT timestamp'2024-01-01 00:03:00', 'view'").write.parquet(src)
    query = views.window_counts(views.read_events(spark, src, "ts timestamp, event_type string")).writeStream.outputMode("complete").format("memory").queryName("seen").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("seen").agg(F.sum("n")).first()[0] == 2
