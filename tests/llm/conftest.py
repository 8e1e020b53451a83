import os

import pytest


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Write small tables as a query's input folder: tables(documents=(rows, schema), ...)."""

    def write(**given):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, (rows, schema) in given.items():
            spark.createDataFrame(rows, schema).repartition(3).write.parquet(os.path.join(folder, f"{name}.parquet"))
        return folder

    return write
