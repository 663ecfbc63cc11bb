"""Schemas, canonical column names and the searchable-field whitelist."""

from __future__ import annotations

from pyspark.sql import types as T

# Column layout of a crawl line and of the two text tables.
VIDEO_COLUMNS = [
    "videoId", "uploader", "age", "category", "length",
    "views", "rating", "ratingCount", "commentCount",
]
RELATED_COLUMNS = ["srcVideoId", "dstVideoId"]
N_VIDEO_FIELDS = len(VIDEO_COLUMNS)  # related IDs start after these

VIDEOS_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in VIDEO_COLUMNS])
RELATED_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in RELATED_COLUMNS])

# Typed catalogue (graph-store typing: integers truncate, rating is a float).
VIDEOS_TYPED = T.StructType([
    T.StructField("videoId", T.StringType()),
    T.StructField("uploader", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("views", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ratingCount", T.LongType()),
    T.StructField("commentCount", T.LongType()),
])

# Columns the aggregation works on, numeric ones as double.
AGG_NUMERIC = ["views", "rating", "ratingCount", "commentCount"]

# Fields the search front end offers, and which are numeric.
SEARCH_FIELDS = ["views", "ratingCount", "commentCount", "category", "age", "length"]
NUMERIC_SEARCH_FIELDS = ["views", "ratingCount", "commentCount", "age", "length"]

# Menu wording and field labels of the search front ends -> field searched.
MENU_FIELDS = {
    "Rated": "ratingCount",
    "Viewed": "views",
    "Commented": "commentCount",
    "Most Uploaded Categories": "category",
    "Views": "views",
    "Rating Count": "ratingCount",
    "Comment Count": "commentCount",
    "Categories": "category",
    "Oldest": "age",
    "Length": "length",
}
