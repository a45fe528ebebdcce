"""One schema per table, as DDL text. Ids are 64-bit and coordinates double, so nothing turns null or loses
digits on the way; ``clean_incidents(float32=True)`` restores narrower input on request."""

from __future__ import annotations

# A map node as the XML reader sees it: attributes carry the prefix "_".
OSM_NODE = (
    "_lat double, _lon double, _timestamp timestamp, tag array<struct<_k string, _v string>>"
)

PLACES_RAW = (
    "lat double, lon double, timestamp timestamp, amenity string, name string, "
    "tags map<string,string>"
)

PLACES = (
    "amenity string, lat double, lon double, name string, category string, amnt_id bigint"
)

PLACES_LABELLED = (
    "amenity string, lat double, lon double, name string, category string, amnt_id bigint, "
    "neighbourhood string"
)

INCIDENTS_RAW = (
    "type string, year string, month string, day string, hour string, minute string, "
    "hundred_block string, neighbourhood string, x double, y double"
)

INCIDENTS = (
    "type string, year string, month string, day string, neighbourhood string, "
    "latitude double, longitude double, c_id bigint"
)

LISTINGS_RAW = (
    "id bigint, name string, host_id bigint, host_name string, neighbourhood_group string, "
    "neighbourhood string, latitude double, longitude double, room_type string, price double, "
    "minimum_nights int, number_of_reviews int, last_review timestamp, reviews_per_month double, "
    "calculated_host_listings_count string, availability_365 string"
)

LISTINGS = (
    "id bigint, name string, neighbourhood string, latitude double, longitude double, "
    "room_type string, price double, minimum_nights int"
)
