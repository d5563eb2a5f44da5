from __future__ import annotations

import pytest
from pyspark.sql import types as T

from circulation.session import ensure_checkpoint_dir

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def cluster(spark):
    ensure_checkpoint_dir(spark)
    from circulation.llm.common import bound_memory

    bound_memory(spark)
    return spark


@pytest.fixture(scope="session")
def documents(cluster):
    """documents(rows): a table read from Parquet, of (doc_id, text[, lang, source])."""
    from circulation.llm.common import written

    def make(rows, extra=None):
        full = [(*r, *("en", "s")[len(r) - 2:], None if r[1] is None else len(r[1])) for r in rows]
        df = cluster.createDataFrame(full, DOCUMENTS)
        for name, value in (extra or {}).items():
            df = df.withColumn(name, value)
        return written(df, "test-documents")

    return make
