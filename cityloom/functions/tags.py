"""Tag maps of map nodes, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tag_map(tags: Column) -> Column:
    """Map from an array of ``<_k, _v>`` children. Of a repeated key the last one counts, whatever
    the session's policy on duplicate map keys; children without a key are left out."""
    keyed = F.filter(F.coalesce(tags, F.array()), lambda t: t["_k"].isNotNull())
    last = F.filter(
        keyed,
        lambda t, i: ~F.exists(
            F.slice(keyed, i + 2, F.greatest(F.size(keyed), F.lit(1))), lambda u: u["_k"] == t["_k"]
        ),
    )
    return F.map_from_entries(F.transform(last, lambda t: F.struct(t["_k"], t["_v"])))


def without_keys(tags: Column, *keys: str) -> Column:
    """The map less some keys."""
    return F.map_filter(tags, lambda k, v: ~k.isin(*keys))


def tags_from_json(text: Column) -> Column:
    """Tag map from its JSON text; values become strings."""
    return F.from_json(text, "map<string,string>")


def tags_to_json(tags: Column) -> Column:
    """JSON text of a tag map."""
    return F.to_json(tags)
