from __future__ import annotations

import json

import pytest

from stationflow.__main__ import main


def lines_of(spark, path):
    return [r.value for r in spark.read.text(str(path)).collect()]


def test_text_jobs(spark, tmp_path):
    book = tmp_path / "book.txt"
    book.write_text("one two\n", encoding="utf-8")
    main(["text-stats", str(book), str(tmp_path / "stats")], spark)
    assert "word_count\t2" in lines_of(spark, tmp_path / "stats")

    export = tmp_path / "hours.csv"
    fields = ["2024", "1", "2", "3", "1.5", "", "80", "", "0", *[""] * 5, "4", "", "", "", "1000", ""]
    export.write_text("year;...\n" + ";".join(fields) + "\n", encoding="utf-8")
    main(["daily", str(export), str(tmp_path / "daily")], spark)
    assert lines_of(spark, tmp_path / "daily")[0] == "WEATHER_STATS: 2024-1-2\t"

    broken = tmp_path / "broken.csv"
    broken.write_text("h;temp\n1;05.06.2025 0:00\n", encoding="utf-8")
    main(["repair", str(broken), str(tmp_path / "fixed"), "--columns", "h,temp", "--repair", "temp"], spark)
    assert lines_of(spark, tmp_path / "fixed") == ["h;temp", "1;5.0"]


def test_load_and_report(spark, tmp_path, capsys):
    record = {
        "city": "A", "date": "2024-01-15", "temperature": 6.0, "humidity": 80, "pressure": 1000,
        "wind_speed": 1.0, "condition": "sun", "precipitation": 0.0,
    }
    source = tmp_path / "days.json"
    source.write_text(json.dumps({"weather_data": [record]}), encoding="utf-8")
    table = str(tmp_path / "table")
    main(["load", str(source), table], spark)
    main(["load", str(source), table], spark)
    main(["report", table], spark)
    out = capsys.readouterr().out
    assert "LoadResult(offered=1, loaded=1)" in out and "LoadResult(offered=1, loaded=0)" in out
    assert "per_city" in out and "тепло" in out


def test_city_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.json").write_text('{"file_id": 1, "city": "A", "temperature": 3}\n', encoding="utf-8")
    main(["city-files", str(inbox), "--drain"], spark)
    assert not spark.streams.active


def test_streams_need_a_source():
    with pytest.raises(SystemExit):
        main(["station-stream"])
