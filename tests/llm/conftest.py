import pytest

from threadsift.llm.tables import ship

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) rows, with columns whose names operators use themselves."""

    def build(*rows):
        wide = [(i, t, "a", 1, 2) for i, t in rows]
        frame = spark.createDataFrame(wide, "doc_id long, text string, ids string, piece int, bucket int")
        return frame.withColumnRenamed("ids", "line")

    return build


@pytest.fixture(scope="session")
def small_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
