"""The steps end to end, from raw files to results, by command line."""

import csv
import glob
import gzip
import json
import math
import random

from pyspark.sql import functions as F

from cityloom.__main__ import main
from cityloom import fixed_values as V
from cityloom.plans.neighbourhoods import label_and_score, labelling_scores
from tests.test_geo import forward_utm


def write_inputs(root):
    rnd = random.Random(4)
    kinds = ["cafe", "bank", "theatre", "gym", "pub", "taxi", "bench"]
    nodes = []
    for i in range(140):
        lat, lon = rnd.uniform(49.22, 49.3), rnd.uniform(-123.2, -123.05)
        name = "" if i % 10 == 0 else f'<tag k="name" v="Place {i}"/>'
        nodes.append(
            f'<node id="{i}" lat="{lat}" lon="{lon}" timestamp="2020-01-02T03:04:05Z">'
            f'<tag k="amenity" v="{kinds[i % 7]}"/>{name}<tag k="level" v="1"/></node>'
        )
    nodes.append('<node id="999" lat="10" lon="10" timestamp="2020-01-02T03:04:05Z"><tag k="amenity" v="cafe"/></node>')
    with gzip.open(root / "osm.xml.gz", "wt") as f:
        f.write("\n".join(nodes))
    header = "TYPE,YEAR,MONTH,DAY,HOUR,MINUTE,HUNDRED_BLOCK,NEIGHBOURHOOD,X,Y\n"
    with open(root / "crime.csv", "w") as f:
        f.write(header)
        for i in range(1500):
            lat, lon = rnd.uniform(49.22, 49.3), rnd.uniform(-123.2, -123.05)
            x, y = forward_utm(lat, lon)
            side = "East" if lon > -123.12 else "West"
            f.write(f"{V.INCIDENT_TYPES[i % 7]},{2009 + i % 5},1,2,3,4,10XX,{side},{x},{y}\n")
    with open(root / "listings.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "name", "host_id", "host_name", "group", "neighbourhood", "latitude", "longitude", "room_type",
                    "price", "minimum_nights", "number_of_reviews", "last_review", "rpm", "count", "avail"])
        for i in range(60):
            name = f'Cosy\n"{i}", quiet' if i % 4 == 0 else f"Home {i}"
            w.writerow([6_000_000_000 + i, name, 1, "H", "", "Kits", rnd.uniform(49.22, 49.3), rnd.uniform(-123.2, -123.05),
                        "Private room", 80 + i, 1 + i % 40, 5, "2020-06-01", 0.5, 1, 300])


def read_csv(path):
    rows = []
    for name in glob.glob(f"{path}/*.csv"):
        with open(name, newline="") as f:
            rows += list(csv.DictReader(f))
    return rows


def cosine(lat1, lon1, lat2, lon2):
    a, b = math.radians(lat1), math.radians(lat2)
    return math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(lon1 - lon2))


def test_ids_and_labels_do_not_depend_on_the_files(spark, tmp_path):
    write_inputs(tmp_path)
    with open(tmp_path / "crime.csv") as f:
        header, *lines = f.readlines()
    (tmp_path / "crime-csv").mkdir()
    for i in range(8):
        (tmp_path / "crime-csv" / f"{i}.csv").write_text(header + "".join(lines[i::8]))
    main(["extract-places", str(tmp_path / "osm.xml.gz"), str(tmp_path / "raw-json")])
    main(["clean-places", str(tmp_path / "raw-json"), str(tmp_path / "places")])
    found = []
    for name in ("crime.csv", "crime-csv"):
        out, labelled = str(tmp_path / f"inc-{name}.pq"), str(tmp_path / f"lab-{name}.pq")
        main(["clean-incidents", str(tmp_path / name), out])
        main(["label-places", out, str(tmp_path / "places"), labelled])
        ids = sorted(r["c_id"] for r in spark.read.parquet(out).collect())
        found.append((ids, sorted((r["amnt_id"], r["neighbourhood"]) for r in spark.read.parquet(labelled).collect())))
        scores = labelling_scores(spark.read.parquet(out))
        places, both = label_and_score(spark.read.parquet(str(tmp_path / "places")), spark.read.parquet(out))
        assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, both.collect()))
        assert sorted((r["amnt_id"], r["neighbourhood"]) for r in places.collect()) == found[-1][1]
        found[-1] += (sorted(map(tuple, scores.collect())),)
    assert found[0] == found[1]


def test_all_steps(spark, tmp_path):
    write_inputs(tmp_path)
    p = {n: str(tmp_path / n) for n in (
        "osm.xml.gz", "crime.csv", "listings.csv", "places-json", "city-json", "places", "incidents-csv", "listings-out",
        "labelled", "related", "stays", "incidents-pq")}
    main(["extract-places", p["osm.xml.gz"], p["places-json"]])
    assert spark.read.parquet(p["places-json"] + "-parquet").count() == 141
    main(["clip-places", p["places-json"], p["city-json"]])
    with gzip.open(glob.glob(p["city-json"] + "/*.gz")[0], "rt") as f:
        first = json.loads(f.readline())
    assert first["tags"] == {"level": "1"} and first["timestamp"].startswith("2020-01-02T03:04:05")
    main(["clean-places", p["city-json"], p["places"]])
    places = spark.read.parquet(p["places"])
    assert places.columns == ["amenity", "lat", "lon", "name", "category", "amnt_id"]
    assert places.count() == sum(1 for i in range(140) if i % 10 and i % 7 != 6)
    main(["clean-incidents", p["crime.csv"], p["incidents-csv"]])
    incidents = read_csv(p["incidents-csv"])
    assert len(incidents) == 1200
    assert list(incidents[0]) == ["type", "year", "month", "day", "neighbourhood", "latitude", "longitude", "c_id"]
    assert all(49.21 < float(r["latitude"]) < 49.31 for r in incidents)
    main(["clean-listings", p["listings.csv"], p["listings-out"], "--as-of", "2020-12-01"])
    assert spark.read.parquet(p["listings-out"]).filter("id > 5000000000 AND minimum_nights <= 30").count() == 50
    main(["label-places", p["incidents-csv"], p["places"], p["labelled"], "--scores", p["labelled"] + "-scores"])
    assert 0.9 < spark.read.parquet(p["labelled"] + "-scores").agg(F.min("accuracy")).first()[0] <= 1
    labelled = spark.read.parquet(p["labelled"])
    assert labelled.columns[-1] == "neighbourhood"
    right = labelled.filter("(neighbourhood = 'East') = (lon > -123.12)").count()
    assert right > 0.9 * labelled.count()
    main(["relate", p["incidents-csv"], p["labelled"], p["related"], "--radius", "1500", "--one-file", "--pairs", p["related"] + "-pairs"])
    assert len(glob.glob(p["related"] + "/summary/*.csv")) == 1
    counts = read_csv(p["related"] + "/counts")
    assert sum(int(c["n"]) for c in counts) == int(read_csv(p["related"] + "/summary")[0]["num_rows"])
    pairs = spark.read.parquet(p["related"] + "-pairs")
    assert pairs.count() == sum(int(c["n"]) for c in counts) and "neighbourhood" in pairs.columns
    densities = read_csv(p["related"] + "/densities")
    assert {d["type"] for d in densities} == set(V.INCIDENT_TYPES) and len(densities) == 7 * 32 * 32
    summary = read_csv(p["related"] + "/summary")[0]
    test = read_csv(p["related"] + "/test_all")[0]
    cells = read_csv(p["related"] + "/table_all")
    assert int(test["dof"]) == (int(test["n_rows"]) - 1) * 6 and int(test["n_cols"]) == 7
    assert sum(int(c["n"]) for c in cells) == int(test["n"]) <= int(summary["num_rows"])
    strict = p["related"] + "-strict"
    main(["relate", p["incidents-csv"], p["labelled"], strict, "--radius", "10000", "--distance", "scaled",
          "--any-neighbourhood", "--min-support", "0", "--alpha", "1.1"])
    scaled = spark.read.option("header", True).csv(strict + "/test_all")
    assert scaled.first() is None or scaled.first()["significant"] == "true"
    near = [(a, b) for a in places.collect() for b in incidents
            if math.degrees(math.acos(min(1.0, cosine(a["lat"], a["lon"], float(b["latitude"]), float(b["longitude"]))))) * 6371000 <= 10000]
    assert int(read_csv(strict + "/summary")[0]["num_rows"]) == len(near)
    main(["find-stays", p["places"], p["listings-out"], p["stays"] + "-7", "--k", "7", "--seed", "1"])
    assert len(read_csv(p["stays"] + "-7/top-listings")) == 7
    main(["find-stays", p["places"], p["listings-out"], p["stays"], "--merge", "2,4"])
    top = read_csv(p["stays"] + "/top-listings")
    assert list(top[0]) == ["id", "name", "neighbourhood", "latitude", "longitude", "room_type", "price", "minimum_nights", "cluster"]
    assert sorted(r["cluster"] for r in top) == ["0", "1", "2", "3"]
    shares = read_csv(p["stays"] + "/shares")
    assert abs(sum(float(r["percent"]) for r in shares) - 4) < 1e-9
    main(["profile", p["crime.csv"], p["city-json"], p["listings.csv"], "--target", p["stays"] + "-profile"])
    assert {r["type"] for r in read_csv(p["stays"] + "-profile/types")} >= set(V.INCIDENT_TYPES)
    assert len(read_csv(p["stays"] + "-profile/nights")) == 1
