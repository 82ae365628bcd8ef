import datetime as dt
import json
import pathlib
import tempfile

import pytest

from anagrove.sinks import export
from anagrove.sources import puzzles as source
from anagrove.sources.wordlists import latest_word_list, read_word_list


def document(date, answers=("abba",)):
    return {
        "printDate": date,
        "centerLetter": "a",
        "outerLetters": list("bcdefg"),
        "answers": list(answers),
        "editor": "ignored",
    }


@pytest.fixture
def folder():
    return pathlib.Path(tempfile.mkdtemp(prefix="anagrove-puzzles-"))


def write_file(folder, date, suffix=".json"):
    year, month, _ = date.split("-")
    place = folder / f"year={year}" / f"month={month}"
    place.mkdir(parents=True, exist_ok=True)
    (place / f"{date}{suffix}").write_text(json.dumps(document(date), indent=4) + "\n")


def test_indented_files_and_months(spark, folder):
    for date in ("2024-01-05", "2024-01-06", "2024-02-01"):
        write_file(folder, date)
    write_file(folder, "2024-01-07", ".latest.json")
    write_file(folder, "2024-01-08", ".txt")
    puzzles = source.read_puzzles(spark, str(folder))
    assert sorted(r.printDate for r in puzzles.collect()) == ["2024-01-05", "2024-01-06", "2024-02-01"]
    january = source.puzzles_of_month(puzzles, 2024, 1)
    assert january.count() == 2
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    one = source.puzzles_of_date(puzzles, dt.date(2024, 1, 6)).collect()
    assert [r.printDate for r in one] == ["2024-01-06"]


def test_writing_a_date_again_replaces_only_that_date(spark, folder):
    path = str(folder / "out")
    first = [document("2024-01-05"), document("2024-01-06"), document("2024-02-01")]
    export.write_puzzles(spark.createDataFrame(first, source.PUZZLE_SCHEMA), path)
    again = [document("2024-01-06", ["cabbage"])]
    export.write_puzzles(spark.createDataFrame(again, source.PUZZLE_SCHEMA), path)
    found = source.read_puzzles(spark, path, multi_line=False)
    assert {r.printDate: r.answers for r in found.collect()} == {
        "2024-01-05": ["abba"],
        "2024-01-06": ["cabbage"],
        "2024-02-01": ["abba"],
    }


def page(script):
    return f"<html><script>other()</script><script type='x'>{script}</script></html>"


def test_puzzle_from_page(spark):
    body = json.dumps({"today": document("2024-03-01"), "yesterday": {}})
    good = spark.createDataFrame([(1, page(f"window.gameData = {body}"))], "page_id int, html string")
    row = source.puzzles_from_pages(good).first()
    assert (row.printDate, row.centerLetter, row.answers) == ("2024-03-01", "a", ["abba"])
    bad = spark.createDataFrame([(2, page("nothing"))], "page_id int, html string")
    with pytest.raises(Exception, match="no script"):
        source.puzzles_from_pages(bad).collect()
    assert source.page_script(bad, r"gameData = (.*)").first().body is None


def test_word_lists(spark, folder):
    (folder / "list_v2.txt").write_text('"abba"\n"baba"\n')
    (folder / "list_v10.txt").write_text("abba\n")
    (folder / "plain.txt").write_text("zzzz\n")
    newest = latest_word_list(spark, str(folder)).first()
    assert newest.version == 10 and newest.file_path.endswith("list_v10.txt")
    words = read_word_list(spark, str(folder / "list_v2.txt"))
    assert sorted(r.word for r in words.collect()) == ["abba", "baba"]
    export.write_word_list(words, str(folder / "copy"))
    assert read_word_list(spark, str(folder / "copy")).count() == 2


def test_bad_puzzle_files_stop_the_job(spark, tmp_path):
    from anagrove.sources.puzzles import read_puzzles

    good = '{"printDate": "2024-01-05",\n "centerLetter": "a",\n "outerLetters": ["b"], "answers": ["abba"]}'
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "x.json").write_text(good)
    (tmp_path / "good" / "lines.json").write_text((good.replace("\n", "") + "\n") * 2)
    (tmp_path / "good" / "x.latest.json").write_text("not read")
    assert read_puzzles(spark, str(tmp_path / "good")).filter("centerLetter = 'a'").count() == 3
    for name, text in {"cut": good[:40], "two": good + "\n" + good}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text(text)
        with pytest.raises(Exception):
            read_puzzles(spark, str(tmp_path / name)).collect()


def test_written_puzzles_are_read_by_default(spark, tmp_path):
    from anagrove.sinks.export import write_puzzles
    from anagrove.sources.puzzles import PUZZLE_SCHEMA, read_puzzles

    rows = [(f"2024-01-0{d}", "a", ["b"], ["abba"]) for d in (1, 2)]
    write_puzzles(spark.createDataFrame(rows, PUZZLE_SCHEMA), str(tmp_path / "p"))
    stored = read_puzzles(spark, str(tmp_path / "p"))
    assert stored.count() == 2
    one = source.puzzles_of_date(stored, dt.date(2024, 1, 2))
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
