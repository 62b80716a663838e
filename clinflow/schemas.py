"""Row shapes shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("schematized_data", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("send_time", T.TimestampType()),
    ]
)

SEGMENT = T.StructType(
    [
        T.StructField("segmentId", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)

PARSED_MESSAGE = T.StructType([T.StructField("segments", T.ArrayType(SEGMENT))])

ERROR_ENTRY = T.StructType(
    [
        T.StructField("error_resource", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
    ]
)

ERROR_ROW = T.StructType(
    [
        T.StructField("stacktrace", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
    ]
)

IO_ERROR_ROW = T.StructType(
    [
        T.StructField("dataElement", T.StringType()),
        T.StructField("observed_time", T.TimestampType()),
        T.StructField("message", T.StringType()),
        T.StructField("stacktrace", T.StringType()),
        T.StructField("statusCode", T.IntegerType()),
    ]
)

WEB_PATH_FIELDS = (
    "project",
    "location",
    "dataset",
    "store_id",
    "dicom_store_path",
    "study_id",
    "series_id",
    "instance_id",
)

MAPPING_RULE = T.StructType(
    [
        T.StructField("output", T.StringType()),
        T.StructField("target_path", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("const_value", T.StringType()),
        T.StructField("is_array", T.BooleanType()),
    ]
)
