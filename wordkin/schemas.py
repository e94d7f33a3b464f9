"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("author", T.StringType()),
    T.StructField("date", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("reviews", T.ArrayType(REVIEW)),
])

CORRUPT = "_corrupt_record"

# a product line, with the text of the line kept when it is not valid JSON
PRODUCT_OR_CORRUPT = T.StructType([*PRODUCT.fields, T.StructField(CORRUPT, T.StringType())])
