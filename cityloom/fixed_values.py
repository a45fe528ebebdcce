"""Lists and limits that results depend on. Every one is a default, not a rule;
the operators take them as parameters."""

# Amenities kept by the cleaning step, by category.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "Attraction": (
        "Observation Platform", "arts_centre", "clock", "fountain", "monastery", "park",
        "place_of_worship", "theatre", "university",
    ),
    "Business": (
        "atm", "atm;bank", "bank", "bureau_de_change", "conference_centre", "courthouse",
        "events_venue", "luggage_locker", "office|financial", "police", "public_building",
        "research_institute", "science", "studio", "townhall", "workshop",
    ),
    "Food": (
        "bbq", "biergarten", "bistro", "cafe", "fast_food", "ice_cream", "juice_bar", "restaurant",
    ),
    "Leisure": (
        "casino", "cinema", "gym", "internet_cafe", "leisure", "library", "marketplace",
        "meditation_centre", "photo_booth", "playground", "shop|clothes", "spa",
    ),
    "Nightlife": ("bar", "nightclub", "pub", "stripclub"),
    "Transportation": (
        "bicycle_rental", "boat_rental", "bus_station", "car_rental", "car_sharing",
        "ferry_terminal", "motorcycle_rental", "seaplane terminal", "taxi",
    ),
}
ALLOWED_AMENITIES: tuple[str, ...] = tuple(sorted(a for v in CATEGORIES.values() for a in v))

# Two amenities that the published results count under the fallback category.
FALLBACK_CATEGORY = "Nightlife"
PARITY_FALLBACK_AMENITIES: tuple[str, ...] = ("events_venue", "playground")

# Boxes as (min lon, max lon, min lat, max lat); city edges count, region edges do not.
CITY_BOX = (-123.264760, -123.023715, 49.2, 49.317244)
REGION_BOX = (-123.5, -122.0, 49.0, 49.5)

# Incident types.
COLLISION_TYPES: tuple[str, ...] = (
    "Vehicle Collision or Pedestrian Struck (with Fatality)",
    "Vehicle Collision or Pedestrian Struck (with Injury)",
)
INCIDENT_TYPES: tuple[str, ...] = (
    "Break and Enter Commercial",
    "Break and Enter Residential/Other",
    "Mischief",
    "Other Theft",
    "Theft from Vehicle",
    "Theft of Bicycle",
    "Theft of Vehicle",
)
SERIOUS_TYPES: tuple[str, ...] = (
    "Break and Enter Commercial",
    "Break and Enter Residential/Other",
    "Theft of Vehicle",
)
PETTY_TYPES: tuple[str, ...] = tuple(t for t in INCIDENT_TYPES if t not in SERIOUS_TYPES)

# Limits.
FIRST_YEAR = 2010
MAX_NIGHTS = 30
RECENT_DAYS = 730
UTM_ZONE = 10
NEIGHBOURS = 5
CLUSTERS = 5
CLUSTER_SEED = 353
MERGED_CLUSTERS = (2, 4)
RADIUS_M = 500.0
MIN_SUPPORT = 5
ALPHA = 0.05
TRAIN_SHARE = 0.75
