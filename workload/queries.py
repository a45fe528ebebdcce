"""One callable per query: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cityloom import fixed_values as V
from cityloom.functions.geo import Distance, cosine_law_m, haversine_m
from cityloom.functions.tags import tags_from_json, tags_to_json, without_keys
from cityloom.operators import cleaning, profile
from cityloom.operators.clusters import (
    Clusters, kmeans, lloyd, merge_clusters, nearest_per_centre, within_cost,
)
from cityloom.operators.contingency import chi_square, contingency, pivot_contingency, supported_rows
from cityloom.operators.density import density_histogram, kernel_density
from cityloom.operators.dedupe import keep_one
from cityloom.operators.distance_join import count_within, lay_out, summarise_pairs
from cityloom.operators.indexing import dense_id, stable_id
from cityloom.operators.monte_carlo import chi_square_monte_carlo
from cityloom.operators.shares import cluster_shares, scale_by_category
from cityloom.operators.skew import attach, attach_group_counts
from cityloom.operators.sketches import estimated, roll_up, sketch_distinct
from cityloom.plans.neighbourhoods import label_places, labelling_scores
from cityloom.plans.relation import near_counts, near_pairs
from cityloom.session import materialise, scratch_path
from cityloom.sources import tables, xml

from . import fixtures as fx

AS_OF = dt.date(2020, 12, 1)
PARITY = Distance("scaled_degrees", clamp=False)
PARITY_RADIUS = 10000.0  # 174.5 m
CLIP_BOX = (-123.2, -123.05, 49.22, 49.3)
START = ((49.22, -123.2), (49.22, -123.08), (49.26, -123.14), (49.3, -123.2), (49.3, -123.06))
ITERATIONS = 3
CITY_POINTS = ((0, 49.28, -123.12), (1, 49.26, -123.06), (2, 49.26, -123.18), (3, 49.236, -123.11))
MIN_SUPPORT = 8
# Five standard errors of a sketch.
SKETCH_ERROR = 0.04
MOST_ITERATIONS, SETTLED = 25, 1e-4


# Inputs


def places(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_places(fx.poi(spark, sf))


def incidents(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(cleaning.clean_incidents(fx.incidents(spark, sf)), 7, "latitude", "longitude")


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_listings(fx.listings(spark, sf), as_of=AS_OF)


def poi_node(with_amenity: Column) -> list[Column]:
    return xml.node_struct(
        F.col("lat"),
        F.col("lon"),
        F.timestamp_seconds(F.col("amnt_id") * 61 + 1577836800),
        {
            "amenity": F.when(with_amenity, F.col("amenity")),
            "name": F.col("name"),
            "district": F.col("neighbourhood"),
        },
    )


def place_record(df: DataFrame) -> DataFrame:
    return df.select(
        "lat", "lon", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "amenity", "name",
        F.col("tags")["district"].alias("district"), F.size("tags").alias("n_tags"),
    )


# Sources and sinks


def src_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.table(spark, sf, "events").withColumn("tags", tags_from_json(F.col("props"))).drop("props")
    path = scratch_path(spark, "json")
    tables.write_json(events, path)
    back = tables.read_json(spark, path, events.schema)
    return back.select("event_id", "ts", "user_id", "event_type", "value", F.col("tags")["k"].alias("k"))


def src_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    customer = fx.table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    tables.write_csv(customer, path)
    return tables.read_csv(spark, path, customer.schema, multi_line=True)


def src_parquet_lz4_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    tables.write_parquet(fx.table(spark, sf, "orders"), path)
    return tables.read_parquet(spark, path)


def src_xml_nodes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    xml.write_osm_document(fx.poi(spark, sf).select(*poi_node(F.col("amenity") != "bench")), path)
    return place_record(xml.read_osm_document(spark, path))


def src_xml_extract(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    xml.write_osm_document(fx.poi(spark, sf).select(*poi_node(F.col("amenity") != "bench")), path)
    return place_record(xml.read_osm_extract(spark, path))


def src_xml_fragments(spark: SparkSession, sf: str) -> DataFrame:
    node = xml.node_fragment(poi_node(F.col("amenity") != "bench"))
    way = F.regexp_replace(node, "(?<=</?)node", "way")
    lines = fx.poi(spark, sf).select(F.when(F.col("amnt_id") % 7 == 0, way).otherwise(node).alias("value"))
    path = scratch_path(spark, "fragments")
    lines.write.option("compression", "gzip").text(path)
    return place_record(xml.read_osm_fragments(spark, path))


def tags_map_extract(spark: SparkSession, sf: str) -> DataFrame:
    tags = tags_from_json(F.col("props"))
    return fx.table(spark, sf, "events").select(
        "event_id",
        tags["k"].alias("k"),
        tags["absent"].alias("absent"),
        F.size(without_keys(tags, "k")).alias("n_rest"),
        tags_to_json(tags).alias("tags_json"),
    )


# Cleaning


def poi_allowlist_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_places(fx.poi(spark, sf))


def poi_open_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clip_to_region(fx.poi(spark, sf), CLIP_BOX)


def poi_categorised_parity(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_places(fx.poi(spark, sf), parity=True)


def poi_dense_id(spark: SparkSession, sf: str) -> DataFrame:
    return dense_id(places(spark, sf).select("amnt_id", "amenity"), "amnt_id", "row_index")


def poi_dense_id_text(spark: SparkSession, sf: str) -> DataFrame:
    """By a text and a number, as most business keys have a text in them."""
    return dense_id(places(spark, sf).select("amnt_id", "amenity"), ["amenity", "amnt_id"], "row_index", start=1)


def incidents_stable_id(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of the incidents without their key, from two layouts of the rows: by type, the rows, the distinct
    ids, and the ids that both layouts gave."""
    rows = cleaning.clean_incidents(fx.incidents(spark, sf)).drop("c_id")
    ids = [stable_id(rows.repartition(n), "id").select("type", "id", F.lit(n).alias("layout")) for n in (1, 7)]
    both = ids[0].unionByName(ids[1]).groupBy("type", "id").agg(F.countDistinct("layout").alias("layouts"))
    return both.groupBy("type").agg(
        F.count("*").alias("n_ids"), F.sum(F.when(F.col("layouts") == 2, 1).otherwise(0)).alias("n_same")
    )


def incidents_clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_incidents(fx.incidents(spark, sf))


def profile_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(fx.incidents(spark, sf), "type")


def profile_amenities(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_sorted(fx.poi(spark, sf), "amenity")


def profile_nights(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(profile.describe_number(fx.listings(spark, sf), "minimum_nights"), 8, "mean", "stddev")


# Distances


def _dist_to_nation(spark: SparkSession, sf: str, scaled: bool) -> DataFrame:
    nation = fx.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("neighbourhood"),
        (F.col("n_nationkey") * 0.004 + 49.2).alias("nlat"),
        (F.col("n_nationkey") * 0.01 - 123.26).alias("nlon"),
    )
    gap = cosine_law_m("lat", "lon", "nlat", "nlon", scaled=scaled)
    return fx.poi(spark, sf).join(nation, "neighbourhood").select("amnt_id", F.round(gap, 3).alias("metres"))


def dist_cosine_law(spark: SparkSession, sf: str) -> DataFrame:
    return _dist_to_nation(spark, sf, False)


def dist_cosine_law_scaled(spark: SparkSession, sf: str) -> DataFrame:
    return _dist_to_nation(spark, sf, True)


def dist_haversine(spark: SparkSession, sf: str) -> DataFrame:
    points = F.array(
        *(F.struct(F.lit(i).alias("centre"), F.lit(y).alias("y"), F.lit(x).alias("x")) for i, y, x in CITY_POINTS)
    )
    gap = haversine_m("latitude", "longitude", "y", "x")
    return (
        fx.listings(spark, sf)
        .select("id", "latitude", "longitude", F.inline(points))
        .select("id", "centre", F.round(gap, 3).alias("metres"))
    )


# Near pairs


def _pairs(spark: SparkSession, sf: str, digits: int = 3, **how) -> DataFrame:
    return fx.rounded(near_pairs(places(spark, sf), incidents(spark, sf), **how), digits, "distance_in_meters")


def near_pairs_500(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf)


def near_pairs_parity(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, 0, radius=PARITY_RADIUS, distance=PARITY)


def near_pairs_unblocked(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, block=None, ids_only=True)


def near_pairs_first20(spark: SparkSession, sf: str) -> DataFrame:
    """The first pairs by place: counts per place tell which places hold them, only those are joined."""
    kept, near = places(spark, sf), incidents(spark, sf)
    counts = count_within(kept, near, V.RADIUS_M, left_by=("amnt_id",)).orderBy("amnt_id").limit(20)
    before = F.coalesce(F.sum("n").over(Window.orderBy("amnt_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = counts.withColumn("before", before).filter("before < 20").select("amnt_id")
    pairs = near_pairs(kept.join(F.broadcast(first), "amnt_id"), near)
    return fx.rounded(pairs, 3, "distance_in_meters").orderBy("amnt_id", "distance_in_meters", "c_id").limit(20)


def near_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarise_pairs(
        near_counts(places(spark, sf), incidents(spark, sf), by=("amnt_id", "amenity", "category"))
    )


def near_summary_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs and places among them per neighbourhood and type and over both, rolled up from sketches; whether these
    estimate the places, counted exactly beside them, within ``SKETCH_ERROR``."""
    by = ("neighbourhood", "crime_type")
    counted = near_counts(places(spark, sf), incidents(spark, sf), by=("amnt_id", "neighbourhood"))
    per_place = materialise(counted, "per-place")
    sketches = materialise(sketch_distinct(per_place, by, ["amnt_id"], weight="n"), "sketches")
    rolled = estimated(roll_up(sketches, by, ["amnt_id"]), ["amnt_id"]).withColumnRenamed("amnt_id", "estimate")
    exact = per_place.cube(*by).agg(F.grouping_id().cast("int").alias("level"), F.count_distinct("amnt_id").alias("n_places"))
    off = F.abs(F.col("estimate") - F.col("n_places"))
    return attach(rolled, exact, ["level", *by]).select(
        "level", *by, "num_rows", "n_places", (off <= F.col("n_places") * SKETCH_ERROR).alias("near_enough")
    )


def near_counts_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return near_counts(places(spark, sf), incidents(spark, sf))


def near_counts_unblocked(spark: SparkSession, sf: str) -> DataFrame:
    return near_counts(places(spark, sf), incidents(spark, sf), block=None)


def near_counts_attached(spark: SparkSession, sf: str) -> DataFrame:
    """The counts are the answer; no pair is formed to attach them to."""
    return near_counts(places(spark, sf), incidents(spark, sf)).withColumnRenamed("n", "count")


def near_pairs_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs within two radii from one stored layout."""
    left = places(spark, sf).select("amnt_id", "lat", "lon", "neighbourhood")
    right = incidents(spark, sf).select("c_id", "latitude", "longitude", "neighbourhood")
    layout = lay_out(left, right, V.RADIUS_M)
    both = [layout.pairs(r).select("amnt_id", "c_id", F.lit(int(r)).alias("radius")) for r in (V.RADIUS_M, V.RADIUS_M / 2)]
    return both[0].unionByName(both[1])


def incidents_with_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Every incident with the number of incidents of its type and neighbourhood."""
    rows = materialise(incidents(spark, sf).select("c_id", "type", "neighbourhood"), "incidents")
    return attach_group_counts(rows, ["type", "neighbourhood"], "n_alike")


def near_counts_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with the count of their category and type, one row of each: the pair with the smallest ids. All pairs are
    counted, per place; only those of a place that comes first in some group can be kept, and these are joined."""
    keys, kept, near = ["category", "crime_type"], places(spark, sf), incidents(spark, sf)
    per_place = materialise(near_counts(kept, near, by=("amnt_id", "category")), "per-place")
    counts = per_place.groupBy(*keys).agg(F.sum("n").alias("count"))
    # One row per category and type at most.
    first = per_place.groupBy(*keys).agg(F.min(F.struct("amnt_id")).alias("first")).select(F.col("first.amnt_id").alias("first")).distinct()
    leading = kept.join(F.broadcast(first), F.col("amnt_id").eqNullSafe(F.col("first")), "left_semi")
    pairs = near_pairs(leading, near).select("amnt_id", "c_id", *keys)
    counted = attach_group_counts(pairs, keys, counts=counts)
    return keep_one(counted, [*keys, "count"], ["amnt_id", "c_id"])


def first_incident_per_place(spark: SparkSession, sf: str) -> DataFrame:
    """One incident per type and neighbourhood: the smallest id."""
    rows = incidents(spark, sf).select("c_id", "type", "neighbourhood")
    return keep_one(rows, ["type", "neighbourhood"], ["c_id"])


# Tables and tests


def _table(spark: SparkSession, sf: str, types: tuple[str, ...], min_support: int = V.MIN_SUPPORT) -> DataFrame:
    counts = near_counts_by_type(spark, sf)
    counts = cleaning.without_types(counts, [t for t in V.INCIDENT_TYPES if t not in types])
    cells = contingency(counts, "category", "crime_type", types, weight="n")
    return supported_rows(cells, "category", "crime_type", types, min_support)


def contingency_all(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, V.INCIDENT_TYPES)


def contingency_petty(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, V.PETTY_TYPES)


def contingency_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """By the distance of published figures: arcs times 180 / pi, not clamped."""
    counts = near_counts(places(spark, sf), incidents(spark, sf), PARITY_RADIUS, distance=PARITY)
    return contingency(counts, "category", "crime_type", V.INCIDENT_TYPES, weight="n")


def contingency_wide(spark: SparkSession, sf: str) -> DataFrame:
    cells = contingency(
        near_counts_by_type(spark, sf), "category", "crime_type", V.INCIDENT_TYPES, weight="n"
    )
    wide = pivot_contingency(cells, "category", "crime_type", V.INCIDENT_TYPES)
    return wide.toDF("category", *(f"n{i}" for i in range(len(V.INCIDENT_TYPES))))


def contingency_min_support(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, V.INCIDENT_TYPES, MIN_SUPPORT)


def _test(table: DataFrame) -> DataFrame:
    return fx.rounded(chi_square(table, "category", "crime_type"), 6, "statistic", "p_value")


def chi2_all(spark: SparkSession, sf: str) -> DataFrame:
    return _test(contingency_all(spark, sf))


def chi2_petty(spark: SparkSession, sf: str) -> DataFrame:
    return _test(contingency_petty(spark, sf))


def chi2_monte_carlo(spark: SparkSession, sf: str) -> DataFrame:
    """Is the type of an incident related to its neighbourhood? By tables drawn at random, and whether the p-value
    agrees with that of the distribution, up to four standard errors and what small expected counts allow for."""
    cells = incidents(spark, sf).groupBy("neighbourhood", "type").agg(F.count("*").alias("n"))
    drawn = chi_square_monte_carlo(cells, "neighbourhood", "type")
    off, allowed = F.abs(F.col("p_value") - F.col("closed_p_value")), F.col("standard_error") * 4 + 0.02
    drawn = drawn.select("statistic", "n", "n_rows", "n_cols", "replicates", (off <= allowed).alias("agrees"))
    return fx.rounded(drawn, 4, "statistic")


# Neighbours


def knn_neighbourhood(spark: SparkSession, sf: str) -> DataFrame:
    return label_places(places(spark, sf), incidents(spark, sf)).select("amnt_id", "category", "neighbourhood")


def knn_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(labelling_scores(incidents(spark, sf)), 8, "accuracy")


# Clusters


def _fit(spark: SparkSession, sf: str) -> Clusters:
    return lloyd(places(spark, sf), START, ITERATIONS)


def _merged(spark: SparkSession, sf: str) -> tuple[DataFrame, Clusters]:
    fitted = _fit(spark, sf)
    return merge_clusters(fitted.assign(places(spark, sf)), fitted, [V.MERGED_CLUSTERS])


def lloyd_5(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(_fit(spark, sf).to_frame(spark), 8, "clat", "clon")


def lloyd_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf).assign(places(spark, sf)).select("amnt_id", "cluster")


def lloyd_converged(spark: SparkSession, sf: str) -> DataFrame:
    found = lloyd(places(spark, sf), START, MOST_ITERATIONS, tolerance=SETTLED)
    return fx.rounded(found.to_frame(spark), 8, "clat", "clon")


def kmeans_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What holds for any good fit: how many centres and points, every centre the mean of its points, and
    a cost of at most 1.1 times that of the settled Lloyd iterations."""
    points = places(spark, sf)
    fitted = kmeans(points, V.CLUSTERS, seed=V.CLUSTER_SEED)
    plain = lloyd(points, START, MOST_ITERATIONS, tolerance=SETTLED)
    costs = within_cost(points, fitted).agg(F.count("*").alias("n_centres"), F.sum("n").alias("n_points"), F.sum("cost").alias("cost"))
    means = fitted.assign(points).groupBy("cluster").agg(F.avg("lat").alias("y"), F.avg("lon").alias("x"))
    off = means.join(fitted.to_frame(spark), "cluster").agg(
        F.max(F.greatest(F.abs(F.col("y") - F.col("clat")), F.abs(F.col("x") - F.col("clon")))).alias("off")
    )
    limit = within_cost(points, plain).agg((F.sum("cost") * 1.1).alias("limit"))
    return costs.select(
        "n_centres", "n_points", (off.scalar() < 1e-5).alias("centres_are_means"), (F.col("cost") <= limit.scalar()).alias("cost_is_good")
    )


def kmeans_ml(spark: SparkSession, sf: str) -> DataFrame:
    points = places(spark, sf)
    return fx.rounded(within_cost(points, kmeans(points, V.CLUSTERS, seed=V.CLUSTER_SEED, starts=1)), 8, "cost")


def merged_centres(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(_merged(spark, sf)[1].to_frame(spark), 8, "clat", "clon")


def nearest_listing(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_per_centre(listings(spark, sf), _merged(spark, sf)[1])


def nearest_listing_many(spark: SparkSession, sf: str) -> DataFrame:
    """One centre per kept place."""
    centres = places(spark, sf).select("amnt_id", "lat", "lon")
    found = nearest_per_centre(listings(spark, sf), centres, name="amnt_id", distance="metres")
    return fx.rounded(found.select("amnt_id", "id", "metres"), 3, "metres")


def cluster_share(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(cluster_shares(_merged(spark, sf)[0]), 8, "percent")


def cluster_share_complete(spark: SparkSession, sf: str) -> DataFrame:
    # A category no place has, to show the zero rows.
    wanted = (*V.CATEGORIES, "Other")
    return fx.rounded(cluster_shares(_merged(spark, sf)[0], complete=wanted), 8, "percent")


def category_scaled_share(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(scale_by_category(cluster_shares(_merged(spark, sf)[0])), 8, "percent", "scaled_percent")


# Densities


def density_hist(spark: SparkSession, sf: str) -> DataFrame:
    return density_histogram(incidents(spark, sf), "type")


def density_kde(spark: SparkSession, sf: str) -> DataFrame:
    return fx.rounded(kernel_density(incidents(spark, sf), "type"), 6, "lat", "lon", "density")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_json_roundtrip": src_json_roundtrip,
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_parquet_lz4_roundtrip": src_parquet_lz4_roundtrip,
    "src_xml_nodes": src_xml_nodes,
    "src_xml_extract": src_xml_extract,
    "src_xml_fragments": src_xml_fragments,
    "tags_map_extract": tags_map_extract,
    "poi_allowlist_bbox": poi_allowlist_bbox,
    "poi_open_bbox": poi_open_bbox,
    "poi_categorised": places,
    "poi_categorised_parity": poi_categorised_parity,
    "poi_dense_id": poi_dense_id,
    "poi_dense_id_text": poi_dense_id_text,
    "incidents_stable_id": incidents_stable_id,
    "incidents_clean": incidents_clean,
    "incidents_latlon": incidents,
    "listings_clean": listings,
    "profile_type_counts": profile_type_counts,
    "profile_amenities": profile_amenities,
    "profile_nights": profile_nights,
    "dist_cosine_law": dist_cosine_law,
    "dist_cosine_law_scaled": dist_cosine_law_scaled,
    "dist_haversine": dist_haversine,
    "near_pairs": near_pairs_500,
    "near_pairs_parity": near_pairs_parity,
    "near_pairs_unblocked": near_pairs_unblocked,
    "near_pairs_first20": near_pairs_first20,
    "near_summary": near_summary,
    "near_summary_sketch": near_summary_sketch,
    "near_counts": near_counts_by_type,
    "near_counts_unblocked": near_counts_unblocked,
    "near_counts_attached": near_counts_attached,
    "near_pairs_bucketed": near_pairs_bucketed,
    "near_counts_rows": near_counts_rows,
    "incidents_with_counts": incidents_with_counts,
    "first_incident_per_place": first_incident_per_place,
    "contingency_all": contingency_all,
    "contingency_petty": contingency_petty,
    "contingency_scaled": contingency_scaled,
    "contingency_wide": contingency_wide,
    "contingency_min_support": contingency_min_support,
    "chi2_all": chi2_all,
    "chi2_petty": chi2_petty,
    "chi2_monte_carlo": chi2_monte_carlo,
    "knn_neighbourhood": knn_neighbourhood,
    "knn_accuracy": knn_accuracy,
    "lloyd_5": lloyd_5,
    "lloyd_labels": lloyd_labels,
    "lloyd_converged": lloyd_converged,
    "kmeans_ml": kmeans_ml,
    "kmeans_facts": kmeans_facts,
    "merged_centres": merged_centres,
    "nearest_listing": nearest_listing,
    "nearest_listing_many": nearest_listing_many,
    "cluster_share": cluster_share,
    "cluster_share_complete": cluster_share_complete,
    "category_scaled_share": category_scaled_share,
    "density_hist": density_hist,
    "density_kde": density_kde,
}
