import pytest

from tests.llm import samples


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Awkward tables in a folder of their own."""
    path = tmp_path_factory.mktemp("awkward")
    samples.awkward(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(
        [(0, samples.PROSE[:120]), (1, None), (2, ""), (None, samples.FRENCH), (4, "too short")], "item_id long, text string"
    ).write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (2, None, 0), (None, 0, 0), (9, 0, None)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{path}/labels.parquet")
    samples.awkward_vectors(spark).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    """Empty tables in a folder of their own."""
    path = tmp_path_factory.mktemp("nothing")
    samples.empty(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], samples.VECTOR_SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def results(spark, folder, nothing, small):
    """Rows of a query on one of the three folders, computed once."""
    from keyframe.llm.queries import QUERIES

    where, found = {"awkward": folder, "nothing": nothing, "small": small}, {}

    def rows(name, at):
        if (name, at) not in found:
            found[name, at] = QUERIES[name](spark, where[at]).collect()
        return found[name, at]

    return rows


@pytest.fixture(scope="session")
def texts(spark, folder, small):
    """(doc_id, text) of the documents of a folder."""
    where = {"awkward": folder, "small": small}
    return lambda at: [tuple(r) for r in spark.read.parquet(f"{where[at]}/documents.parquet").select("doc_id", "text").collect()]
