"""Which listing is closest to the centre of each cluster of places?"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import fixed_values as V
from ..operators.clusters import (
    Clusters, kmeans, merge_clusters, nearest_per_centre, small_cluster_groups,
)
from ..operators.shares import cluster_shares, scale_by_category
from ..session import materialise


@dataclass
class Stays:
    """Centres and results of the analysis."""

    fitted: Clusters
    merged: Clusters
    places: DataFrame
    top_listings: DataFrame
    shares: DataFrame


def find_stays(
    places: DataFrame,
    listings: DataFrame,
    *,
    k: int = V.CLUSTERS,
    seed: int = V.CLUSTER_SEED,
    groups: Iterable[Iterable[int]] | None = None,
    min_size: int | None = None,
    fitted: Clusters | None = None,
) -> Stays:
    """Fit, merge, and pick. Merge the clusters in ``groups``, or those below ``min_size`` places
    into their neighbours; labels of a fit mean nothing by themselves, so there is no default."""
    places = materialise(places, "stays-places")
    fitted = fitted or kmeans(places, k, seed=seed)
    if groups is None:
        groups = small_cluster_groups(places, fitted, min_size) if min_size else []
    labelled, merged = merge_clusters(fitted.assign(places), fitted, groups)
    return Stays(
        fitted=fitted,
        merged=merged,
        places=labelled,
        top_listings=nearest_per_centre(listings, merged),
        shares=scale_by_category(cluster_shares(labelled)),
    )
