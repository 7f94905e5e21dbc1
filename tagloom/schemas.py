"""Explicit schemas of the tables that pass between stages."""

from pyspark.sql import types as T

NOTES = T.StructType([T.StructField("guid", T.StringType()), T.StructField("card", T.StringType())])

VECTOR = T.ArrayType(T.DoubleType())

EMBEDDED_NOTES = T.StructType(
    [*NOTES.fields, T.StructField("tokens", T.IntegerType()), T.StructField("emb", VECTOR)]
)

OBJECTIVES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("learning_objective", T.StringType()),
        T.StructField("tokens", T.IntegerType()),
        T.StructField("emb", VECTOR),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)

# `rank` is the position of the pair in its objective's walk; it stands for
# the row order that a single-file table would carry implicitly. `rate_error`
# tells a pair the model failed on from one it gave no score.
RATINGS = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("card", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("cosine_sim", T.DoubleType()),
        T.StructField("gpt_reply", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("objective", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("rate_error", T.StringType()),
    ]
)

NOTE_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("guid", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)
