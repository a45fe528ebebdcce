import datetime as dt

import pytest

from cityloom import schemas
from cityloom.functions.tags import tag_map
from cityloom.sources import tables, xml

DOCUMENT = """<?xml version="1.0"?>
<osm version="0.6">
  <node id="1" lat="49.25" lon="-123.1" timestamp="2020-01-02T03:04:05Z">
    <tag k="amenity" v="cafe"/>
    <tag k="name" v="A &amp; B"/>
    <tag k="cuisine" v="first"/>
    <tag k="cuisine" v="last"/>
  </node>
  <node id="2" lat="49.3" lon="-123.2" timestamp="2020-01-02T03:04:05+02:00">
    <tag k="amenity" v="bar"/>
  </node>
  <node id="3" lat="49.3" lon="-123.2" timestamp="2020-01-02T03:04:05Z"/>
  <node id="4" lat="49.3" lon="-123.2" timestamp="2020-01-02T03:04:05Z"><tag k="name" v="amenity"/></node>
  <way id="5"><nd ref="1"/><tag k="amenity" v="school"/></way>
</osm>
"""
WANT = [
    (49.25, -123.1, dt.datetime(2020, 1, 2, 3, 4, 5), "cafe", "A & B", {"cuisine": "last"}),
    (49.3, -123.2, dt.datetime(2020, 1, 2, 1, 4, 5), "bar", None, {}),
]


def records(df):
    rows = df.selectExpr("lat", "lon", "cast(timestamp AS timestamp_ntz) AS t", "amenity", "name", "tags").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def test_whole_document(spark, tmp_path):
    (tmp_path / "a.xml").write_text(DOCUMENT)
    assert records(xml.read_osm_document(spark, str(tmp_path / "a.xml"))) == WANT


PAIRED = """
  <node id="60" lat="70.0" lon="1" timestamp="2020-01-02T03:04:05Z"><tag k="name" v="x"></tag><tag k="amenity" v="p1"></tag></node>
  <way id="61"><nd ref="1"></nd><tag k="a" v="b"></tag><tag k="amenity" v="no"></tag></way>
  <node id="62" lat="71.0" lon="1" timestamp="2020-01-02T03:04:05Z"><tag k="a" v="b"/><tag k="amenity" v="p2"></tag ><tag k="c" v="d"/></node>
  <node id="63" lat="71.5" lon="1" timestamp="2020-01-02T03:04:05Z"></node><node id="64" lat="1" lon="1" timestamp="2020-01-02T03:04:05Z"/>
  <relation id="65"><member ref="1"></member><tag k="amenity" v="no"></tag></relation>
  <node id="66" lat="72.0" lon="1" timestamp="2020-01-02T03:04:05Z"><tag k="amenity" v="p3"></tag><tag k="name" v="z"></tag></node>
"""


@pytest.mark.parametrize("max_bytes", [64, 200, 10_000])
@pytest.mark.parametrize("paired", [False, True])
def test_extract_cut_at_closing_tags(spark, tmp_path, max_bytes, paired):
    long = DOCUMENT.replace("</osm>", "") + "".join(
        f"""<node id="{i}" user="a > b" lat="{i / 10}" lon='1' timestamp="2020-01-02T03:04:05Z"/>
        <node id="{i}" user="x/y" lat="{60 + i}" lon="1" timestamp="2020-01-02T03:04:05Z"><tag k="amenity" v="n > {i}"/></node>
        <relation id="9"><member type="node" ref="1"/><tag k="amenity" v="no"/></relation>"""
        for i in range(9)
    ) + (PAIRED if paired else "") + "</osm>"
    (tmp_path / "big.osm").write_text(long)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_bytes))
    try:
        got = records(xml.read_osm_extract(spark, str(tmp_path / "big.osm")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got[:2] == WANT
    want = [(60.0 + i, f"n > {i}") for i in range(9)] + ([(70.0, "p1"), (71.0, "p2"), (72.0, "p3")] if paired else [])
    assert [(r[0], r[3]) for r in got[2:]] == want
    if paired:
        assert got[-2][5] == {"a": "b", "c": "d"} and got[-1][4] == "z"
    assert records(xml.read_osm_document(spark, str(tmp_path / "big.osm"))) == got


def test_fragments(spark, tmp_path):
    body = DOCUMENT.split("<osm", 1)[1].split(">", 1)[1].split("</osm>")[0]
    lines, current = [], ""
    for line in body.strip().splitlines():
        current += line.strip()
        if current.endswith(("</node>", "</way>")) or (current.startswith("<node") and current.endswith('Z"/>')):
            lines.append(current)
            current = ""
    assert len(lines) == 5
    (tmp_path / "f.txt").write_text("\n".join(lines))
    assert records(xml.read_osm_fragments(spark, str(tmp_path / "f.txt"))) == WANT


def test_malformed_fragment_fails(spark):
    bad = spark.createDataFrame([('<node lat="1" lon="2"><tag k="amenity" v="x"',)], "value string")
    with pytest.raises(Exception):
        xml.amenities_from_fragments(bad).collect()


def test_parser_runs_once_per_line(spark):
    lines = spark.createDataFrame([("<node/>",)], "value string")
    plan = xml.amenities_from_fragments(lines).filter("amenity = 'cafe'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") + plan.count("XmlToStructs") == 1


def test_tag_map_without_tags(spark):
    df = spark.createDataFrame([(None,), ([],)], "tag array<struct<_k string, _v string>>")
    assert [r[0] for r in df.select(tag_map(df.tag)).collect()] == [{}, {}]


def test_csv_binds_by_position_and_keeps_large_ids(spark, tmp_path):
    (tmp_path / "l.csv").write_text("A,B,C\n5000000000,x,2\n")
    got = tables.read_csv(spark, str(tmp_path / "l.csv"), "id bigint, name string, n int").collect()
    assert [tuple(r) for r in got] == [(5_000_000_000, "x", 2)]


def test_names_with_breaks_quotes_and_blanks(spark, tmp_path):
    rows = [(1, "a\nb"), (2, 'say "hi", ok'), (3, ""), (4, None), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id bigint, name string")
    tables.write_parquet(df, str(tmp_path / "p"))
    assert sorted(map(tuple, tables.read_parquet(spark, str(tmp_path / "p")).collect())) == rows
    tables.write_csv(df, str(tmp_path / "t.csv"))
    got = sorted(map(tuple, tables.read_table(spark, str(tmp_path / "t.csv"), "id bigint, name string", multi_line=True).collect()))
    assert got[0] == rows[0] and got[1] == rows[1] and got[4] == rows[4]
    assert got[2][1] in ("", None) and got[3][1] is None


def test_json_keeps_microseconds_and_tags(spark, tmp_path):
    rows = [(1.0, 2.0, dt.datetime(2020, 1, 2, 3, 4, 5, 123456), "cafe", None, {"a": "b"})]
    df = spark.createDataFrame(rows, schemas.PLACES_RAW)
    tables.write_json(df, str(tmp_path / "j"))
    assert tables.read_json(spark, str(tmp_path / "j"), schemas.PLACES_RAW).collect() == df.collect()
    text = tables.read_json(spark, str(tmp_path / "j"), "tags string").first()[0]
    assert text == '{"a":"b"}'


def test_csv_in_one_file_on_request(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 4).selectExpr("id", "'x' AS name")
    tables.write_csv(df, str(tmp_path / "one"), one_file=True)
    tables.write_csv(df, str(tmp_path / "many"))
    assert [len(list((tmp_path / d).glob("*.csv"))) for d in ("one", "many")] == [1, 4]
    assert tables.read_csv(spark, str(tmp_path / "one"), df.schema).count() == 20_000


def test_bzip2_by_the_end_of_the_path(spark, tmp_path):
    import bz2

    (tmp_path / "l.csv.bz2").write_bytes(bz2.compress(b"A,B\n1,x\n"))
    (tmp_path / "l.json.bz2").write_bytes(bz2.compress(b'{"id": 1, "name": "x"}\n'))
    for name in ("l.csv.bz2", "l.json.bz2"):
        assert [tuple(r) for r in tables.read_table(spark, str(tmp_path / name), "id bigint, name string").collect()] == [(1, "x")]
