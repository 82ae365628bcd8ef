"""One keyed JSON object, written in parallel."""

import datetime as dt
import glob
import json

from anagrove.operators import serving
from anagrove.sinks import export

SCHEMA = "word string, letter_set string, probability float, last_seen_on date"


def groups(spark, n, words_per_line=3):
    rows = [(f"w{i:03}é\"", f"set{i % 7}", i / 100, dt.date(2024, 1, 1 + i % 9) if i % 5 else None) for i in range(n)]
    words = spark.createDataFrame(rows, SCHEMA)
    return serving.export_rows(serving.letter_set_groups(words, words_per_line))


def test_files_join_to_one_object(spark, tmp_path):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # a small export would be one file
    try:
        export.write_export_object(groups(spark, 60), str(tmp_path / "o"))
    finally:
        spark.conf.unset(coalesce)
    files = sorted(glob.glob(f"{tmp_path}/o/part-*.txt"))
    assert len(files) > 1
    held = json.loads("".join(open(f, encoding="utf-8").read() for f in files))
    expected: dict = {}
    for line in export.export_json_lines(groups(spark, 60)).orderBy("letter_set", "part").collect():
        for key, data in json.loads(line.json).items():
            expected.setdefault(key, []).extend(data)
    assert held == expected and list(held) == sorted(held) and len(held["set0"]) == 9


def test_starts_are_byte_offsets(spark):
    rows = export.placed_fragments(groups(spark, 40)).collect()
    text = bytearray(max(r.start + r.bytes for r in rows))
    for r in rows:
        text[r.start : r.start + r.bytes] = r.fragment.encode()
    assert len(text) == sum(r.bytes for r in rows) and len(json.loads(text)) == 7


def test_one_key_and_none(spark, tmp_path):
    export.write_export_object(groups(spark, 1), str(tmp_path / "one"))
    export.write_export_object(groups(spark, 0), str(tmp_path / "none"))
    read = lambda p: json.loads("".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{p}/part-*"))))
    assert list(read(tmp_path / "one")) == ["set0"] and read(tmp_path / "none") == {}
