import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fraudlens.llm.common import importable

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture
def frame(spark):
    """Rows (id, text) as a table with extra columns, some with names that operators use inside."""
    importable(spark)

    def make(rows, clash=True, id_col="doc_id", text_col="text"):
        df = spark.createDataFrame(rows, DOCS).toDF(id_col, text_col)
        if clash:
            for name in ("id", "row", "n", "x", "y", "word", "start", "kept", "prefix", "spans", "_removed"):
                df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df.repartition(3)

    return make


@pytest.fixture
def vocabulary():
    r = random.Random(7)
    return ["".join(r.choice("aeioutrnsl") for _ in range(r.randint(2, 7))) for _ in range(400)]
