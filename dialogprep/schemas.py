"""Explicit schemas; nothing in this package infers one."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

MESSAGES = T.ArrayType(MESSAGE)

# One row per conversation, as delivered.
DIALOGS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("dialog", T.ArrayType(T.StringType())),
    ]
)

# One row per turn.
TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

# JSON lines of prepared conversations; the id columns are optional on read.
CONVERSATION_LINES = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("messages", MESSAGES),
    ]
)

CHAT_LOG = T.StructType(
    [
        T.StructField("session", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)
