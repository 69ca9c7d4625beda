import pytest
from pyspark.sql import functions as F

ROWS = [
    (1000, None),
    (1001, ""),
    (1002, "   "),
    (1003, " a"),
    (1004, "a  b "),
    (1005, "\n\n x \r\n\ty"),
    (1006, "café CAFÉ ÀØÞ × ÿ ª İ ΣΣΣ ﬁ Å"),
    (1007, "a　b  c d \U0001f600 中文字 हि"),
    (1008, "don't I'LL we've '' 's's 12345 3.14 ²½"),
    (1009, "<|endoftext|> a<|startoftext|>b <|x </s><unk>"),
    (1010, "▁a▁▁b \x00\x01 a\x1cb"),
    (1011, "x" * 3000),
    (1012, "ab " * 2000),
    (1013, " " * 500),
    (1014, "same text here"),
    (1015, "same text here"),
    (1015, "same text here"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts that are null, empty, long or strange, repeated rows, and columns with clashing names."""
    rows = spark.createDataFrame(ROWS, "doc_id long, text string")
    for name in ("n", "ids", "node", "n_tokens", "n_removed", "shard", "th", "label"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="session")
def docs(spark, sf, odd):
    """The given documents and the odd ones."""
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return given.unionByName(odd.select("doc_id", "text")).repartition(5).cache()


@pytest.fixture(scope="session")
def texts(docs):
    return [(row.doc_id, row.text or "") for row in docs.collect()]


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
