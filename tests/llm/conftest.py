"""Fixtures of the training-data operators' tests."""

import pytest


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from codesieve.session import build_session

    session = build_session(
        "codesieve-tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture
def docs(spark):
    """Documents from (id, text, language, source) rows, with columns named like those of results."""
    def make(*rows):
        full = [(*row, *([None] * (4 - len(row))), "x", "y") for row in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, kept string, "
                                           "component_id string").repartition(3)

    return make
