import datetime as dt

from pyspark.sql import functions as F

from cityloom import fixed_values as V
from cityloom.operators import cleaning


def test_lists_are_consistent():
    assert len(V.ALLOWED_AMENITIES) == 58 == len(set(V.ALLOWED_AMENITIES))
    assert set(V.PARITY_FALLBACK_AMENITIES) <= set(V.ALLOWED_AMENITIES)
    assert len(V.INCIDENT_TYPES) == 7 and len(V.PETTY_TYPES) == 4


def test_categories_and_their_parity(spark):
    df = spark.createDataFrame([("playground",), ("events_venue",), ("pub",), ("cafe",)], "amenity string")
    got = {
        r["amenity"]: (r["c"], r["p"])
        for r in df.select(
            "amenity", cleaning.category_of("amenity").alias("c"), cleaning.category_of("amenity", parity=True).alias("p")
        ).collect()
    }
    assert got == {
        "playground": ("Leisure", "Nightlife"),
        "events_venue": ("Business", "Nightlife"),
        "pub": ("Nightlife", "Nightlife"),
        "cafe": ("Food", "Food"),
    }


def test_category_with_a_quote(spark):
    df = spark.createDataFrame([("o'neill",), ("x",)], "amenity string")
    got = [r[0] for r in df.select(cleaning.category_of("amenity", {"Pub's": ["o'neill"]})).collect()]
    assert got == ["Pub's", "Nightlife"]


def test_places_box_edges_and_names(spark):
    west, east, south, north = V.CITY_BOX
    rows = [
        ("cafe", south, west, "edge"), ("cafe", north, east, "edge"), ("cafe", south - 1e-9, west, "out"),
        ("cafe", 49.25, -123.1, None), ("cafe", 49.25, -123.1, ""), ("bench", 49.25, -123.1, "x"), (None, 49.25, -123.1, "x"),
    ]
    df = spark.createDataFrame(rows, "amenity string, lat double, lon double, name string")
    assert sorted(r["name"] for r in cleaning.clean_places(df).collect()) == ["", "edge", "edge"]


def test_region_edges_are_out(spark):
    rows = [(49.0, -123.0), (49.5, -123.0), (49.2, -123.5), (49.2, -122.0), (49.2, -123.0)]
    assert cleaning.clip_to_region(spark.createDataFrame(rows, "lat double, lon double")).count() == 1


def test_incident_rules(spark):
    rows = [
        ("keep", "Mischief", "2010", "a", 1.0, 1.0),
        ("old", "Mischief", "2009", "a", 1.0, 1.0),
        ("text year", "Mischief", "x", "a", 1.0, 1.0),
        ("null year", "Mischief", None, "a", 1.0, 1.0),
        ("no nbh", "Mischief", "2015", None, 1.0, 1.0),
        ("x 0", "Mischief", "2015", "a", 0.0, 1.0),
        ("y 0", "Mischief", "2015", "a", 1.0, 0.0),
        ("x null", "Mischief", "2015", "a", None, 1.0),
        ("null type", None, "2015", "a", 1.0, 1.0),
        ("collision", V.COLLISION_TYPES[0], "2015", "a", 1.0, 1.0),
        ("far future", "Mischief", "2999", "a", 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "id string, type string, year string, neighbourhood string, x double, y double")
    assert sorted(r["id"] for r in cleaning.keep_incidents(df).collect()) == ["far future", "keep"]


def test_float32_input_moves_points_a_little(spark):
    df = spark.createDataFrame([("Mischief", "2015", "a", 491234.567, 5456789.321)],
                               "type string, year string, neighbourhood string, x double, y double")
    a = cleaning.clean_incidents(df).first()
    b = cleaning.clean_incidents(df, float32=True).first()
    assert 0 < abs(a["latitude"] - b["latitude"]) < 5e-6


def test_listing_rules(spark):
    as_of = dt.date(2020, 12, 1)

    def back(days):
        return dt.datetime(2020, 12, 1) - dt.timedelta(days=days)

    rows = [(1, 1, back(729)), (2, 30, back(0)), (3, 0, back(1)), (4, 31, back(1)), (5, 5, back(730)), (6, 5, None),
            (5_000_000_000, 5, back(5))]
    df = spark.createDataFrame(rows, "id bigint, minimum_nights int, last_review timestamp")
    assert sorted(r["id"] for r in cleaning.clean_listings(df, as_of=as_of).collect()) == [1, 2, 5_000_000_000]


def test_listings_count_from_today_by_default(spark):
    df = spark.range(2).select("id", F.lit(1).alias("minimum_nights"),
                               F.date_sub(F.current_date(), F.when(F.col("id") == 0, 729).otherwise(730)).alias("last_review"))
    assert [r["id"] for r in cleaning.clean_listings(df).collect()] == [0]


def test_rules_work_on_a_stream(spark, tmp_path):
    rows = [("Mischief", "2015", "a", 491234.0, 5456789.0), ("Mischief", "2001", "a", 491234.0, 5456789.0)]
    df = spark.createDataFrame(rows, "type string, year string, neighbourhood string, x double, y double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        cleaning.clean_incidents(stream).writeStream.format("memory").queryName("cleaned")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("cleaned").count() == 1
