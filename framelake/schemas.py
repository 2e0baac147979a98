"""Row types of every stage a frame goes through."""

from __future__ import annotations

from pyspark.sql import types as T

OBJECT = T.StructType([
    T.StructField("class", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("box", T.ArrayType(T.DoubleType())),
])

SCENE = T.StructType([
    T.StructField("class", T.StringType()),
    T.StructField("prob", T.DoubleType()),
])

TAG = T.StructType([
    T.StructField("class_name", T.StringType()),
    T.StructField("x1", T.FloatType()),
    T.StructField("y1", T.FloatType()),
    T.StructField("x2", T.FloatType()),
    T.StructField("y2", T.FloatType()),
])

_FRAME_KEY = [
    T.StructField("timestamp", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("camera", T.LongType()),
    T.StructField("frame_num", T.LongType()),
]

RAW_FRAME = T.StructType([
    *_FRAME_KEY,
    T.StructField("original_frame", T.StringType()),
    T.StructField("original_dtype", T.StringType()),
    T.StructField("original_shape", T.ArrayType(T.IntegerType())),
])

URL_FRAME = T.StructType([T.StructField("s3_key", T.StringType()), *_FRAME_KEY])

DETECTED_FRAME = T.StructType([
    *URL_FRAME.fields,
    T.StructField("objs", T.ArrayType(OBJECT)),
    T.StructField("scenes", T.ArrayType(SCENE)),
])

VALUE_FRAME = T.StructType([
    *URL_FRAME.fields,
    T.StructField("objs", T.MapType(T.IntegerType(), TAG)),
    T.StructField("counts", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("scenes", T.ArrayType(T.StringType())),
    T.StructField("is_keyframe", T.BooleanType()),
    T.StructField("valuable", T.BooleanType()),
])

OBJECT_RESPONSE = T.StructType([
    T.StructField("entries", T.MapType(T.StringType(), T.ArrayType(OBJECT))),
])

SCENE_RESPONSE = T.StructType([T.StructField("predictions", T.ArrayType(SCENE))])

SIDECAR = T.StructType([
    T.StructField("locations", T.ArrayType(T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]))),
])

MOT = T.StructType([
    T.StructField("frame", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("w", T.DoubleType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])
