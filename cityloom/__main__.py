"""The steps as jobs: spark-submit or python -m cityloom STEP PATH ... (paths ending in .csv, -csv,
.json or -json are of that format, all others Parquet)."""

from __future__ import annotations

import argparse
import datetime as dt

from .functions.geo import Distance
from .operators.profile import describe_number, distinct_sorted, value_counts
from .plans import ingest
from .plans.neighbourhoods import label_and_score
from .plans.relation import near_pairs, relate
from .plans.stays import find_stays
from .session import get_session
from .sources.tables import read_table, write_csv, write_table
from . import fixed_values as V, schemas


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cityloom", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, help: str, *paths: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=help)
        for path in paths:
            sub.add_argument(path)
        return sub

    extract = step("extract-places", "amenity nodes of a map extract, as JSON and Parquet", "source", "target")
    extract.add_argument(
        "--kind", choices=sorted(ingest.READERS), default="fragments",
        help="one element per line, whole XML files, or large XML files cut at closing tags",
    )
    step("clip-places", "places of the greater region", "source", "target")
    step("clean-places", "named places of the city with category", "source", "target").add_argument(
        "--parity", action="store_true", help="categorise as the published figures do"
    )
    step("clean-incidents", "kept incidents in latitude and longitude", "source", "target").add_argument(
        "--float32", action="store_true", help="round the input coordinates to 32 bits"
    )
    step("clean-listings", "short stays reviewed lately", "source", "target").add_argument(
        "--as-of", type=dt.date.fromisoformat, help="date to count the days from (default: today)"
    )
    label = step("label-places", "neighbourhoods by nearest incidents", "incidents", "places", "target")
    label.add_argument("--seed", type=int, default=0)
    label.add_argument("--k", type=int, default=V.NEIGHBOURS, help="neighbours that vote")
    label.add_argument("--train-share", type=float, default=V.TRAIN_SHARE)
    label.add_argument("--metric", choices=("plane", "haversine"), default="plane", help="plane: raw degrees")
    label.add_argument("--lon-scale", type=float, default=1.0, help="shrinks longitudes, such as 0.65 for 49 degrees")
    label.add_argument("--scores", help="folder for rows and accuracy of the hold-out")
    related = step("relate", "do categories and incident types depend on each other", "incidents", "places", "target")
    related.add_argument("--radius", type=float, default=V.RADIUS_M)
    related.add_argument("--any-neighbourhood", action="store_true", help="compare across borders")
    related.add_argument(
        "--distance", choices=("metres", "scaled"), default="metres",
        help="scaled: arcs times 180 / pi, not clamped, as published figures have it",
    )
    related.add_argument("--min-support", type=int, default=V.MIN_SUPPORT)
    related.add_argument("--alpha", type=float, default=V.ALPHA)
    related.add_argument("--one-file", action="store_true", help="one CSV file per result, for small ones")
    related.add_argument("--pairs", help="folder for the pairs themselves; one row per pair")
    stays = step("find-stays", "listing nearest to each cluster of places", "places", "listings", "target")
    stays.add_argument("--k", type=int, default=V.CLUSTERS, help="clusters")
    stays.add_argument("--seed", type=int, default=V.CLUSTER_SEED)
    stays.add_argument("--one-file", action="store_true", help="one CSV file per result, for small ones")
    stays.add_argument("--merge", help="clusters to merge, such as 2,4")
    stays.add_argument("--min-size", type=int, help="merge clusters below this many places")
    looks = step("profile", "counts by type, kinds of place and nights, before cleaning", "incidents", "places", "listings")
    looks.add_argument("--target", help="folder for the three tables")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session(f"cityloom {args.step}")
    if args.step == "extract-places":
        ingest.extract_places(spark, args.source, args.target, kind=args.kind)
    elif args.step == "clip-places":
        ingest.clip_places(spark, args.source, args.target)
    elif args.step == "clean-places":
        ingest.prepare_places(spark, args.source, args.target, parity=args.parity)
    elif args.step == "clean-incidents":
        ingest.prepare_incidents(spark, args.source, args.target, float32=args.float32)
    elif args.step == "clean-listings":
        ingest.prepare_listings(spark, args.source, args.target, as_of=args.as_of)
    elif args.step == "label-places":
        incidents = ingest.load_incidents(spark, args.incidents)
        labelled, scores = label_and_score(
            ingest.load_places(spark, args.places), incidents, k=args.k, train_share=args.train_share,
            seed=args.seed, lon_scale=args.lon_scale, metric=args.metric,
        )
        write_table(labelled, args.target)
        if args.scores:
            write_table(scores, args.scores)
        scores.show(truncate=False)
    elif args.step == "relate":
        places = ingest.load_places(spark, args.places, labelled=True)
        incidents = ingest.load_incidents(spark, args.incidents)
        block = None if args.any_neighbourhood else "neighbourhood"
        distance = Distance("scaled_degrees", clamp=False) if args.distance == "scaled" else Distance()
        result = relate(
            places, incidents, args.radius, block=block, distance=distance, min_support=args.min_support, alpha=args.alpha
        )
        if args.pairs:
            write_table(near_pairs(places, incidents, args.radius, block=block, distance=distance), args.pairs)
        for name in ("counts", "densities", "summary", "table_all", "test_all", "table_petty", "test_petty"):
            write_csv(getattr(result, name), f"{args.target}/{name}", one_file=args.one_file)
        result.test_all.show(truncate=False)
        result.test_petty.show(truncate=False)
    elif args.step == "find-stays":
        groups = [[int(i) for i in args.merge.split(",")]] if args.merge else None
        result = find_stays(
            ingest.load_places(spark, args.places),
            ingest.load_listings(spark, args.listings),
            k=args.k,
            seed=args.seed,
            groups=groups,
            min_size=args.min_size,
        )
        write_csv(result.top_listings, f"{args.target}/top-listings", one_file=args.one_file)
        write_csv(result.shares, f"{args.target}/shares", one_file=args.one_file)
        result.top_listings.show(truncate=False)
    else:
        listings = read_table(spark, args.listings, schemas.LISTINGS_RAW, multi_line=True)
        found = {
            "types": value_counts(read_table(spark, args.incidents, schemas.INCIDENTS_RAW), "type"),
            "amenities": distinct_sorted(read_table(spark, args.places, schemas.PLACES_RAW), "amenity"),
            "nights": describe_number(listings, "minimum_nights"),
        }
        for name, table in found.items():
            if args.target:
                write_csv(table, f"{args.target}/{name}")
            table.show(truncate=False)


if __name__ == "__main__":
    main()
