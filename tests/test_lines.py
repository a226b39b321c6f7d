"""The line source: Python's reading of JSON, and files that many tasks read."""

import pytest

from textloom.sources import lines


@pytest.mark.parametrize(
    ("line", "kind", "text"),
    [
        ('{"text":"a","text":"b"}', "object", "b"),
        ('{"a":NaN,"text":"x"}', "object", "x"),
        ('{"text":[1.0, 1e20, {"a":"b"}]}', "object", "1.0 1e+20 {'a': 'b'}"),
        ('{"text":[null, true, -0, "é"]}', "object", "None True 0 é"),
        ('{"k":"v","n":1,"z":" ","l":["x"]}', "object", "v"),
        ('{"text":5,"body":{"text":"x"}}', "object", None),
        ('{"text":"  ","k":"v"}', "object", "  v".strip()),
        ("{}", "object", None),
        ('{"text":"a"', "text", '{"text":"a"'),
        ('{"text" "a"}', "bad_object", '{"text" "a"}'),
        ('{"text":"a"} {"text":"b"}', "bad_object", '{"text":"a"} {"text":"b"}'),
        ('"\\ud800 x"', "string", "? x"),
        ('" "', "string", None),
        ("[1]", "other", None),
        ("-1.5e3", "other", None),
        ("-", "text", "-"),
        ("Infinity", "other", None),
        ("Infinity war", "text", "Infinity war"),
        ("nullify", "text", "nullify"),
        ("[" * 100_000, "unreadable", None),
        ("9" * 5000, "unreadable", None),
        (" \x85　", "blank", None),
        (None, None, None),
    ],
)
def test_kinds(spark, line, kind, text):
    row = lines.parse_lines(spark.createDataFrame([(line,)], "value string")).first()
    assert (row.kind, row.text) == (kind, text)


def test_lines_are_numbered_in_files_of_many_blocks(spark, tmp_path):
    wanted = []
    for name, count in (("a", 900), ("b", 1), ("c", 400)):
        rows = ["" if i % 7 == 0 else f'{{"text":"{name}{i}"}}' if i % 5 else f"[{i}]" for i in range(count)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(rows) + "\n")
        wanted += [(f"{name}.jsonl", i + 1, value) for i, value in enumerate(rows)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = lines.read_lines(spark, str(tmp_path))
        got = sorted((r.file.rsplit("/", 1)[-1], r.line, r.value) for r in found.collect())
        errors = {(r.file.rsplit("/", 1)[-1], r.line): r.reason for r in lines.extract_text_errors(found).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(wanted)
    reasons = {"": "blank line"}
    assert errors == {(f, n): reasons.get(v, "JSON value without text") for f, n, v in wanted if not v.startswith("{")}
