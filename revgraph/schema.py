"""Explicit schemas for every table the engine reads or writes.

Nothing is ever inferred: inference turns ISO timestamps into timestamps,
single-revision pages into structs instead of arrays, and the ``year``
partition of the page store into an integer.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# One element per <revision> of a dump page; attributes are dropped on read.
REVISION = StructType(
    [
        StructField("timestamp", StringType()),
        StructField("contributor", StructType([StructField("username", StringType())])),
        StructField("text", StringType()),
    ]
)

# One row per <page> of an XML dump.
DUMP_PAGE = StructType(
    [
        StructField("title", StringType()),
        StructField("revision", ArrayType(REVISION)),
    ]
)

# One row per revision after flattening.
FLAT_REVISION = StructType(
    [
        StructField("title", StringType()),
        StructField("username", StringType()),
        StructField("year", StringType()),
        StructField("timestamp", StringType()),
        StructField("text", StringType()),
    ]
)

# The year-page store: latest revision of a page in a calendar year, reduced
# to its links, categories and word counts. ``year`` is the partition column
# and therefore comes last when read back.
PAGE = StructType(
    [
        StructField("title", StringType()),
        StructField("links", ArrayType(StringType())),
        StructField("categories", ArrayType(StringType())),
        StructField("wordcount", MapType(StringType(), LongType())),
        StructField("year", StringType()),
    ]
)

# A page as the store keeps it: with its key, so that lookups are pushed to the scan.
STORED_PAGE = StructType([StructField("title_key", StringType()), *PAGE.fields])

# One row for each batch whose pages count, written last; a batch may replace others.
COMMIT = StructType(
    [
        StructField("batch", StringType()),
        StructField("replaces", ArrayType(StringType())),
        StructField("pages", LongType()),
        StructField("rejects", LongType()),
    ]
)

# The range of title keys in each file of the store.
KEY_RANGE = StructType(
    [
        StructField("year", StringType()),
        StructField("file", StringType()),
        StructField("low", StringType()),
        StructField("high", StringType()),
        StructField("n", LongType()),
        StructField("batch", StringType()),
    ]
)

# Graph tables.
NODE = StructType(
    [
        StructField("title", StringType()),
        StructField("is_stub", BooleanType()),
        StructField("year", StringType()),
    ]
)

LINK_EDGE = StructType(
    [
        StructField("src", StringType()),
        StructField("dst", StringType()),
        StructField("name", StringType()),
        StructField("weight", LongType()),
        StructField("year", StringType()),
    ]
)

WORD_EDGE = StructType(
    [
        StructField("src", StringType()),
        StructField("dst", StringType()),
        StructField("name", StringType()),
        StructField("weight", DoubleType()),
        StructField("year", StringType()),
    ]
)

CATEGORY_NODE = StructType(
    [
        StructField("title", StringType()),
        StructField("category", StringType()),
        StructField("year", StringType()),
    ]
)

# A (category, year) clique in compact form: its pages and undirected pairs.
CATEGORY_CLIQUE = StructType(
    [
        StructField("category", StringType()),
        StructField("n_pages", LongType()),
        StructField("n_pairs", LongType()),
        StructField("year", StringType()),
    ]
)
