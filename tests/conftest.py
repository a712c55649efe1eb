import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelftrail import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "tests", "local[8]",
        spark_sql_shuffle_partitions="4", spark_driver_memory="6g",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        # Set here only because a test session has no cluster to name it.
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def stocks_of(spark):
    """Canonical rows from dicts; columns not given are NULL."""
    from shelftrail.schema import CANONICAL

    def build(*rows):
        names = CANONICAL.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CANONICAL)

    return build
