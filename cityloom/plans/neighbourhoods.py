"""Neighbourhoods of places, learnt from incidents whose neighbourhood is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..operators.indexing import accuracy, in_share
from ..operators.knn import label_by_neighbours
from ..session import materialise


def label_places(
    places: DataFrame,
    incidents: DataFrame,
    *,
    k: int = V.NEIGHBOURS,
    train_share: float = V.TRAIN_SHARE,
    seed: int = 0,
    lon_scale: float = 1.0,
    metric: str = "plane",
) -> DataFrame:
    """Places plus the neighbourhood most of their k nearest training incidents lie in."""
    train = incidents.filter(in_share(F.col("c_id"), train_share, seed))
    return label_by_neighbours(
        places.drop("neighbourhood"), train, train_id="c_id", k=k, lon_scale=lon_scale, metric=metric
    )


def label_and_score(
    places: DataFrame,
    incidents: DataFrame,
    *,
    k: int = V.NEIGHBOURS,
    train_share: float = V.TRAIN_SHARE,
    seed: int = 0,
    lon_scale: float = 1.0,
    metric: str = "plane",
) -> tuple[DataFrame, DataFrame]:
    """``label_places`` and ``labelling_scores`` from one search, over places and incidents together."""
    places = places.drop("neighbourhood")
    points = incidents.select("c_id", "latitude", "longitude", "neighbourhood")
    asked = places.select(F.struct(*places.columns).alias("place"), "lat", "lon").unionByName(
        points.select(F.struct(*points.columns).alias("incident"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")),
        allowMissingColumns=True,
    )
    labelled = materialise(
        label_by_neighbours(
            asked, points.filter(in_share(F.col("c_id"), train_share, seed)), train_id="c_id", output="predicted",
            k=k, lon_scale=lon_scale, metric=metric,
        ),
        "labelled",
    )
    train = in_share(F.col("incident.c_id"), train_share, seed)
    known = labelled.filter("incident IS NOT NULL").select(
        F.when(train, "train").otherwise("validation").alias("part"), "predicted", F.col("incident.neighbourhood").alias("actual")
    )
    named = labelled.filter("place IS NOT NULL").select("place.*", F.col("predicted").alias("neighbourhood"))
    return named, accuracy(known, "predicted", "actual", "part")


def labelling_scores(
    incidents: DataFrame,
    *,
    k: int = V.NEIGHBOURS,
    train_share: float = V.TRAIN_SHARE,
    seed: int = 0,
    lon_scale: float = 1.0,
    metric: str = "plane",
) -> DataFrame:
    """(part, n, accuracy) of the labelling on training and validation incidents, in one join."""
    train = in_share(F.col("c_id"), train_share, seed)
    points = incidents.select("c_id", "latitude", "longitude", "neighbourhood")
    predicted = label_by_neighbours(
        points, points.filter(train), train_id="c_id", output="predicted", k=k,
        query_coords=("latitude", "longitude"), lon_scale=lon_scale, metric=metric,
    )
    parts = predicted.withColumn("part", F.when(train, "train").otherwise("validation"))
    return accuracy(parts, "predicted", "neighbourhood", "part")
