import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from support import CLASHING, DOCUMENTS  # noqa: E402


@pytest.fixture
def documents(spark):
    def make(rows, clash=False):
        """Rows of (doc_id, text); with `clash`, more columns of names the operators use themselves."""
        df = spark.createDataFrame([(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], DOCUMENTS)
        return df.select("*", *[F.lit(7).alias(c) for c in CLASHING]) if clash else df

    return make
