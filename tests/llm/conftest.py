import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Builds a DataFrame of documents with extra columns whose names clash with the operators' own."""
    def build(texts, ids=None, partitions=3, **columns):
        ids = list(range(len(texts))) if ids is None else ids
        names = ["kept", "row", "d", "n", "severity", "keep", *columns]
        values = [[7] * len(texts)] * 6 + list(columns.values())
        schema = "doc_id long, text string, " + ", ".join(
            f"{n} {'int' if i < 6 else ('string' if n in ('source', 'lang') else 'long')}" for i, n in enumerate(names))
        return spark.createDataFrame(list(zip(ids, texts, *values)), schema).repartition(partitions)
    return build
