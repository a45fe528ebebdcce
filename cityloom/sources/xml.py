"""Map extracts in XML: whole documents, or one element per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.tags import tag_map, without_keys
from ..schemas import OSM_NODE


def _amenity(node: Column) -> Column:
    """Place record of a parsed node. Nested so that the map is built once."""
    entry = F.struct(
        node["_lat"].alias("lat"), node["_lon"].alias("lon"), node["_timestamp"].alias("timestamp"),
        tag_map(node["tag"]).alias("all"),
    )
    return F.transform(
        F.array(entry),
        lambda e: F.struct(
            e["lat"].alias("lat"),
            e["lon"].alias("lon"),
            e["timestamp"].alias("timestamp"),
            e["all"]["amenity"].alias("amenity"),
            e["all"]["name"].alias("name"),
            without_keys(e["all"], "amenity", "name").alias("tags"),
        ),
    )


def _amenities(nodes: Column) -> Column:
    """Place records of those nodes, in an array, that are tagged as an amenity. An array pipeline
    under one ``inline`` keeps the optimiser from evaluating the parser twice."""
    records = F.flatten(F.transform(nodes, _amenity))
    return F.filter(records, lambda r: r["amenity"].isNotNull())


def read_osm_document(spark: SparkSession, path: str) -> DataFrame:
    """Amenity nodes of XML documents: (lat, lon, timestamp, amenity, name, tags).

    Spark's XML source cuts out the ``node`` elements and skips ways and relations. It reads any XML,
    but a file is one task: for one large file use ``read_osm_extract``.
    """
    nodes = (
        spark.read.format("xml").option("rowTag", "node").option("mode", "FAILFAST").schema(OSM_NODE).load(path)
    )
    return nodes.select(F.inline(_amenities(F.array(F.struct(*nodes.columns)))))


def amenities_from_fragments(lines: DataFrame, column: str = "value") -> DataFrame:
    """Amenity nodes of a table with one XML element per row; other elements yield nothing.

    Two cheap text tests come before the parser. A malformed node fails the job.
    """
    candidate = F.col(column).rlike(r"^\s*<node[\s/>]") & F.col(column).contains("amenity")
    parsed = F.from_xml(F.col(column), OSM_NODE, {"mode": "FAILFAST"})
    return lines.filter(candidate).select(F.inline(_amenities(F.array(parsed))))


def read_osm_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Amenity nodes of text files with one XML element per line, compressed or not.

    A gzip file cannot be split and is one task; give many files, as the usual splitter writes them.
    """
    return amenities_from_fragments(spark.read.text(path))


_OPEN_NODE = r"""(?s)^.*(<node(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*>.*)$"""


def read_osm_extract(spark: SparkSession, path: str) -> DataFrame:
    """Amenity nodes of large XML files as map servers write them; plain or bzip2 files are split.

    The text is cut at every closing tag. A piece then holds at most one element that is still open. If that
    is a node, it goes on through the pieces that begin with the end of a ``tag``, if its tags are written in
    pairs, and ends before the first that does not. Pieces are numbered within their split of a file
    and splits by what comes before them, so a node may lie across splits. Only nodes that have closing tags
    are moved, and of all other elements no more than their place. Comments and CDATA that contain a closing
    tag, which such files do not have, would be misread; ``read_osm_document`` reads those.
    """
    pieces = spark.read.option("lineSep", "</").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
    )
    begins = ~F.col("value").rlike(r"^tag\s*>")
    kept = F.when(begins, F.when(F.col("value").contains("<node"), F.regexp_extract("value", _OPEN_NODE, 1)).otherwise(""))
    pieces = pieces.select("file", "split", "pos", begins.cast("int").alias("begins"), F.coalesce(kept, "value").alias("text"))
    so_far = Window.partitionBy("file", "split").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("within", F.sum("begins").over(so_far))
    splits = pieces.groupBy("file", "split").agg(F.max("within").alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    elements = (
        pieces.filter("text <> ''")
        .join(splits, ["file", "split"])
        .groupBy("file", (F.col("before") + F.col("within")).alias("element"))
        .agg(F.sort_array(F.collect_list(F.struct("split", "pos", "text"))).alias("parts"))
    )
    node = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "</"), F.lit("</node>"))
    # Exploding an array of one keeps the expression from being copied into the filters that follow.
    return amenities_from_fragments(elements.select(F.explode(F.array(node)).alias("value")))


def node_struct(
    lat: Column, lon: Column, timestamp: Column, tags: dict[str, Column]
) -> list[Column]:
    """Columns of a map node for the XML writer; tags that are null are left out."""
    entries = F.array(*(F.struct(F.lit(k).alias("_k"), v.alias("_v")) for k, v in tags.items()))
    return [
        lat.alias("_lat"),
        lon.alias("_lon"),
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("_timestamp"),
        F.filter(entries, lambda t: t["_v"].isNotNull()).alias("tag"),
    ]


def write_osm_document(nodes: DataFrame, path: str) -> None:
    """Write nodes as XML documents, one per task."""
    (
        nodes.write.mode("overwrite").format("xml").option("rootTag", "osm").option("rowTag", "node").save(path)
    )


def node_fragment(columns: list[Column]) -> Column:
    """One node as XML text on one line."""
    text = F.to_xml(F.struct(*columns), {"rowTag": "node"})
    return F.regexp_replace(text, r">\s*\n\s*<", "><")
