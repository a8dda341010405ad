"""Texts and tables for the tests of the training-data operators."""

import hashlib
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
FOLDER = "/root/testdata/sf0.001"


def words_of(n, seed=0):
    """`n` invented words, the same for the same seed."""
    return [hashlib.md5(f"{seed}/{i}".encode()).hexdigest()[: 3 + i % 6] for i in range(n)]


def prose(n, seed=0):
    return " ".join(words_of(n, seed))


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# columns whose names the operators use inside, to clash with them
CLASHING = ("score", "row", "key", "kept", "text_sha256", "size", "shard", "cid", "digest", "passages", "spans", "y", "n")
