"""One StructType per entity."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STRING, LONG = T.StringType(), T.LongType()

MESSAGE = _struct(role=STRING, content=STRING)
REQUEST_BODY = _struct(messages=T.ArrayType(MESSAGE))
SPANS = T.ArrayType(_struct(name=STRING, span_type=STRING, start=LONG, end=LONG))
