import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from codesieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "codesieve-tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def evaluate(spark):
    """Value of a Column over one row of named values."""
    from pyspark.sql import functions as F

    def run(column, schema="x string", row=(None,)):
        fields = [field.split() for field in schema.split(",")]
        # A condition on the row keeps the values from being folded into constants; no Python worker is needed.
        values = [F.when(F.col("id") == 0, F.lit(value).cast(kind)).alias(name)
                  for (name, kind), value in zip(fields, row, strict=True)]
        return spark.range(0, 1, 1, 1).select(*values).select(column.alias("v")).collect()[0][0]

    return run
