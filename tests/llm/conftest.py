import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)
