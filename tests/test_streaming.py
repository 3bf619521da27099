from datetime import datetime

import pytest

from codesieve import schemas
from codesieve.session import durable
from codesieve.sources.rules import Rule
from codesieve.streaming import scans

RULES = [Rule("ev", "e", r"eval\(", "command_injection", 9)]


def put(spark, path, *rows):
    spark.createDataFrame(list(rows), schemas.SOURCE_FILES).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path):
    stream = scans.stream_source_files(spark, str(tmp_path / "in"), max_files=1)
    query = scans.write_findings_stream(scans.stream_findings(stream, RULES), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert query.exception() is None
    return sorted((r.repository_id, r.file_path, r.line_number) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_arriving_files_are_scanned_once(spark, tmp_path):
    put(spark, str(tmp_path / "in"), ("1", "a.py", "python", "eval(x)\n\neval(y)"), ("1", "vendor/a.py", "python", "eval(x)"))
    assert run(spark, tmp_path) == [("1", "a.py", 1), ("1", "a.py", 3)]
    put(spark, str(tmp_path / "in"), ("1", "a.py", "python", "eval(x)\n\neval(y)"), ("2", "b.py", "python", "eval(x)"))
    assert run(spark, tmp_path) == [("1", "a.py", 1), ("1", "a.py", 3), ("2", "b.py", 1)]
    assert run(spark, tmp_path) == [("1", "a.py", 1), ("1", "a.py", 3), ("2", "b.py", 1)]


@pytest.mark.parametrize("remember", [None, "1 day"])
def test_many_batches_and_one_delivered_again(spark, tmp_path, remember):
    """25 batches with old and new findings; then the last one again, as after a failure before it was committed."""
    for i in range(25):
        put(spark, str(tmp_path / "in"), (str(i), "a.py", "python", "eval(x)"), (str(i - 1), "a.py", "python", "eval(x)"))

    def run_to_end():
        stream = scans.stream_source_files(spark, str(tmp_path / "in"), max_files=1)
        query = scans.write_findings_stream(scans.stream_findings(stream, RULES), str(tmp_path / "out"),
                                            str(tmp_path / "cp"), remember)
        query.awaitTermination(200)
        assert query.exception() is None
        rows = sorted(int(r.repository_id) for r in spark.read.parquet(str(tmp_path / "out")).collect())
        return rows, query

    rows, query = run_to_end()
    assert rows == list(range(-1, 25))
    assert len(query.recentProgress) >= 25
    assert {len(p["sources"]) for p in query.recentProgress} == {1}  # the arriving files alone
    assert all(p["stateOperators"] for p in query.recentProgress)
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last = commits[-1]
    for file in (last, last.with_name(f".{last.name}.crc")):
        if file.exists():
            file.unlink()
    rows, query = run_to_end()
    assert rows == list(range(-1, 25))


def test_deduplicate_stream(spark, tmp_path):
    path, schema = str(tmp_path / "f"), "id string, ts timestamp"
    rows = [("a", datetime(2025, 1, 1)), ("a", datetime(2025, 1, 1, 0, 1)), ("b", datetime(2025, 1, 1))]
    spark.createDataFrame(rows, schema).write.parquet(path)
    stream = scans.deduplicate_stream(spark.readStream.schema(schema).parquet(path), "ts", "1 hour")
    query = stream.writeStream.format("memory").queryName("deduplicated").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(120)
    assert sorted(r.id for r in spark.table("deduplicated").collect()) == ["a", "b"]


def test_durable(spark):
    assert durable(spark.range(3)).count() == 3
