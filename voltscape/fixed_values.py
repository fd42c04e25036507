"""Results depend on them, so they are stated here once, as text."""

from __future__ import annotations

from datetime import date

# Station eligibility.
SOURCE_NORWAY = "nobil"
SOURCE_SWITZERLAND = "sw"
COUNTRY_NORWAY = "Norway"
MIN_CAPACITY_NORWAY_KW = 50
MIN_CAPACITY_SWITZERLAND_KW = 100
ROAD_COUNTRY_SWITZERLAND = "Switzerland"

# Windows.
LOCAL_ZONE = "Europe/Oslo"
POPULATION_NEWER_THAN = date(2019, 1, 1)

# Proximity.
SEARCH_RADIUS_M = 500.0
ABSENT_DISTANCE_M = 1000.0

# Seasons in reporting order, with their months.
SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}

# Point-of-interest classes.
POI_CLASSES = [
    "accommodation", "activities", "beauty", "cafe_and_restaurant", "clothing",
    "electronics", "food", "grocery", "hobby", "home", "medical",
    "public_service", "service", "shopping_center", "religious",
]
SHOP_CLASSES = ["clothing", "electronics", "food", "grocery", "hobby", "home"]
# A station without any of these is dropped from the feature table.
REQUIRED_POI_CLASSES = ["cafe_and_restaurant", "hobby", "home", "service"]

# Road classes every road feature table has.
ROAD_CLASSES = [
    "motorway", "trunk", "unclassified", "primary", "residential", "living_street", "secondary",
]
# Road classes whose distances decide whether a station has any road at all.
CHECKED_ROAD_CLASSES = [
    "motorway", "primary", "secondary", "trunk", "living_street", "residential",
    "service", "tertiary", "unclassified",
]

# Minutes a visit to one class takes.
MINUTES_PER_VISIT = {
    "activities_count": 90,
    "beauty_count": 60,
    "cafe_and_restaurant_count": 67.5,
    "clothing_count": 40,
    "grocery_count": 30,
    "shopping_center_count": 90,
    "accommodation_count": 120,
    "electronics_count": 30,
    "home_count": 30,
    "food_count": 15,
    "public_service_count": 30,
    "service_count": 30,
    "religious_count": 60,
    "medical_count": 60,
    "hobby_count": 30,
}

# Groups of classes; a shopping center counts in two of them.
POI_GROUPS = {
    "Supermarket": ["supermarket", "shopping_center"],
    "Shopping": ["electronics", "hobby", "home", "clothing", "shopping_center"],
    "Services": ["medical", "service", "public_service", "beauty"],
    "Hotel": ["accommodation"],
    "Restaurant": ["cafe_and_restaurant", "food"],
    "Leisure": ["activities", "religious"],
}

MAJOR_ROADS = ["motorway", "trunk", "primary"]

# Names in the wide table; columns not named here keep theirs.
FEATURE_NAMES = {
    "title": "station_name",
    "road_distance_motorway": "motorway_dist",
    "road_distance_primary": "primary_dist",
    "road_distance_secondary": "secondary_dist",
    "road_distance_service": "road_service_dist",
    "road_distance_tertiary": "tertiary_dist",
    "road_distance_trunk": "trunk_dist",
    "road_distance_unclassified": "unclassified_dist",
    "road_distance_living_street": "living_street_dist",
    "road_distance_residential": "residential_dist",
    "road_count_motorway": "motorway_count",
    "road_count_primary": "primary_count",
    "road_count_secondary": "secondary_count",
    "road_count_service": "road_service_count",
    "road_count_tertiary": "tertiary_count",
    "road_count_trunk": "trunk_count",
    "road_count_unclassified": "unclassified_count",
    "grocery_count": "supermarket_count",
}

# Scoring.
COUNT_QUANTILE = 0.7
DISTANCE_QUANTILE = 0.3
SCORE_FLAGS = ["is_motorway", "is_local_center"]
UTILIZATION_BINS = 10

# Split.
OPERATOR_PATTERN = "%uno%"
TEST_STATIONS = 56
VALIDATION_SHARE = 0.15
