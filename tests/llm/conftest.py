import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    from fixtures import awkward
    path = str(tmp_path_factory.mktemp("awkward") / "documents")
    awkward(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    from fixtures import empty
    return empty(spark)
