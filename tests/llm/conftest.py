import pytest


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: most of a test's time would go to empty tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
