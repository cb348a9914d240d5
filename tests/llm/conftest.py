"""Documents with every odd case: null and empty texts, ties, repeated rows, a null id, clashing extra columns."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    first = given.orderBy("doc_id").first()
    words = " ".join(f"w{i}" for i in range(300))
    odd = [
        (9000, None), (9001, ""), (9002, " \n"), (9003, "A b"), (9004, "a B"), (9005, "a  b\nA B\n\nc"), (9006, "é" * 60), (9006, "é" * 60),
        (9007, "x" * 30_000), (9008, words), (9009, words.replace("w7 ", "w8 ")), (9010, first.text), (9011, first.text[:90] + "tail"), (9012, "x" * 120),
    ]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], given.schema)
    every = given.unionByName(extra).repartition(3, "doc_id")
    return every.selectExpr("*", "1 AS id", "2 AS row", "'h' AS h", "0 AS size", "0 AS node")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
