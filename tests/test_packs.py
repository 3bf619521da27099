import json

import pytest

from codesieve.sources import packs

GOOD = {"id": "t", "name": "n", "regex": "foo", "vulnerability_type": "xss", "severity_score": 5}


def load(spark, tmp_path, *entries, **head):
    (tmp_path / "a").mkdir(exist_ok=True)
    doc = {"language": "php", "cwe_id": "CWE-1", "cwe_name": "one", **head, "patterns": list(entries)}
    (tmp_path / "a" / "p.json").write_text(json.dumps(doc))
    valid, rejected = packs.load_patterns(spark, str(tmp_path))
    return [r.asDict() for r in valid.collect()], [r.reason for r in rejected.collect()]


def test_valid_entry_takes_file_fields(spark, tmp_path):
    valid, rejected = load(spark, tmp_path, GOOD)
    assert rejected == []
    assert valid == [{**GOOD, "language": "php", "cwe": "CWE-1", "cwe_name": "one"}]


def test_entry_fields_win_and_unknown_keys_go(spark, tmp_path):
    valid, _ = load(spark, tmp_path, {**GOOD, "language": "python", "cwe": "CWE-9", "other": {"a": 1}})
    assert (valid[0]["language"], valid[0]["cwe"], valid[0]["cwe_name"]) == ("python", "CWE-9", "one")
    assert "other" not in valid[0]


@pytest.mark.parametrize("change,reason", [
    ({"regex": "["}, "bad_regex"),
    ({"severity_score": "bad"}, "bad_severity_score"),
    ({"severity_score": None}, "bad_severity_score"),
    *[({key: ...}, "missing_fields") for key in packs.REQUIRED],
])
def test_rejected(spark, tmp_path, change, reason):
    entry = {k: v for k, v in {**GOOD, **change}.items() if v is not ...}
    assert load(spark, tmp_path, entry) == ([], [reason])


def test_severity_text_and_non_mappings(spark, tmp_path):
    valid, rejected = load(spark, tmp_path, {**GOOD, "severity_score": "9"}, "text", 42, None, {**GOOD, "regex": ""})
    assert [v["severity_score"] for v in valid] == [9, 5]
    assert rejected == ["not_a_mapping"] * 3


def test_yaml_pack_and_stats(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "x.yaml").write_text(
        "language: java\ncwe_id: CWE-7\npatterns:\n  - {id: a, name: a, regex: 'x\\s', vulnerability_type: xss, severity_score: 3}\n"
        "  - {id: b}\n")
    (tmp_path / "broken.yaml").write_text("a: [")
    (tmp_path / "list.yaml").write_text("- 1")
    (tmp_path / "notes.txt").write_text("ignored")
    checked = packs.validate_entries(packs.pack_entries(packs.read_documents(spark, str(tmp_path))))
    stats = packs.pack_stats(checked).collect()
    assert [(r.loaded, r.skipped) for r in stats] == [(1, 1)]
    valid, _ = packs.load_patterns(spark, str(tmp_path))
    assert [(r.id, r.regex, r.language, r.cwe, r.cwe_name) for r in valid.collect()] == [("a", "x\\s", "java", "CWE-7", "")]
