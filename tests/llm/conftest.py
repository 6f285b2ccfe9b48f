import pytest

from llm_helpers import DOCS, SF, awkward_rows


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    """Small tables: fewer shuffle partitions make the many small jobs quicker."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward rows with extra columns whose names clash with internal ones."""
    rows = awkward_rows()
    clashing = ("row", "hash", "__key", "__spans", "__n_words", "__id", "__times", "__lang_x", "class", "column0")
    df = spark.createDataFrame([(*x, *[f"{c}{k}" for c in clashing]) for k, x in enumerate(rows)],
                               ", ".join([DOCS, *[f"{c} string" for c in clashing]]))
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
