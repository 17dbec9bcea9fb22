"""Constants and schemas that several modules share."""

from pyspark.sql import types as T

ZOOM = 13
TILES = 1 << ZOOM
SCALE = 1e7
MERCATOR_LIMIT = 85.05112878
CELL_ZOOM = 6
CELLS = 1 << CELL_ZOOM
#: First tile id of zoom z is (4**z - 1) / 3; relation records are numbered from that of zoom 20.
FIRST_ID = (4**13 - 1) // 3
PAST_ID = (4**14 - 1) // 3
RELATION_BASE = (4**20 - 1) // 3
EXTRACT_CAP = 3_000_000_000
GRID_STEP, RING_SIDE, LEAST_STEP, CLIP_MARGIN = 0.25, 40, 0.002, 0.3
LAND_CELL, SMALL_ISLAND = 0.02, 0.25
SCRATCH_LEVEL, PUBLISHED_LEVEL = 3, 19

TAGS = T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())]))
POINTS = T.ArrayType(T.StructType([T.StructField("lat_q", T.IntegerType()), T.StructField("lon_q", T.IntegerType())]))
MEMBERS = T.ArrayType(T.StructType([T.StructField("way_id", T.LongType()), T.StructField("role", T.StringType())]))
NODE = T.StructType([T.StructField("id", T.LongType()), T.StructField("lat_q", T.IntegerType()), T.StructField("lon_q", T.IntegerType()), T.StructField("tags", TAGS)])
WAY = T.StructType([T.StructField("id", T.LongType()), T.StructField("closed", T.BooleanType()), T.StructField("tags", TAGS), T.StructField("points", POINTS)])
RELATION = T.StructType([T.StructField("id", T.LongType()), T.StructField("tags", TAGS), T.StructField("members", MEMBERS)])
TILE = T.StructType([T.StructField("nodes", T.ArrayType(NODE)), T.StructField("ways", T.ArrayType(WAY)), T.StructField("relations", T.ArrayType(RELATION))])
REGION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("continent", T.StringType()),
        T.StructField("clip", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)
