import json

import pytest

from foliorank import storage
from foliorank.schemas import PAPERS_SCHEMA
from foliorank.sources import (
    read_table,
    scan_libraries,
    scan_papers,
    scan_papers_features,
    scan_stopwords,
    write_table,
    write_text,
)


def test_scan_papers(spark, tmp_path):
    lines = [
        '1,article,J,,,P,12,3,4,2001,jan,,,"A title, with comma","Text of one"',
        "2,,,,,,not a number,,,,,,,Only title,",
        "3,book,,,,,,,,1999,,,,,",
    ]
    (tmp_path / "papers.csv").write_text("\n".join(lines) + "\n")
    papers = scan_papers(spark, str(tmp_path / "papers.csv"))
    assert papers.schema == PAPERS_SCHEMA
    rows = {r.paper_id: r for r in papers.collect()}
    assert rows[1].title == "A title, with comma" and rows[1].pages == 12 and rows[1].year == "2001"
    assert rows[2].pages is None and rows[2].abstract is None
    assert rows[3].title is None and rows[3].type == "book"


def test_scan_libraries(spark, tmp_path):
    (tmp_path / "users.txt").write_text("u1;7,8,9\nu2;7\n")
    rows = {r.user_id: r.paper_ids for r in scan_libraries(spark, str(tmp_path)).collect()}
    assert rows == {"u1": ["7", "8", "9"], "u2": ["7"]}


def test_scan_libraries_without_papers(spark, tmp_path):
    (tmp_path / "users.txt").write_text("u1;7\nu2\nu3;\n")
    rows = {r.user_id: r.paper_ids for r in scan_libraries(spark, str(tmp_path)).collect()}
    assert rows == {"u1": ["7"], "u2": [], "u3": []}


def test_scan_papers_with_line_breaks_and_floats(spark, tmp_path):
    lines = '1,,,,,,12.5,,,2001,,,,"A ""quoted""\ntitle","Text\nof one"\n2,,,,,,,,,,,,,Only title,\n'
    (tmp_path / "papers.csv").write_text(lines)
    doubled = {"multi_line": True, "escape": '"'}
    rows = {r.paper_id: r for r in scan_papers(spark, str(tmp_path), **doubled).collect()}
    assert rows[1].title == 'A "quoted"\ntitle' and rows[1].abstract == "Text\nof one" and len(rows) == 2
    floats = {r.paper_id: r for r in scan_papers_features(spark, str(tmp_path), **doubled).collect()}
    assert floats[1].pages == 12.5 and floats[1].year == 2001.0 and floats[2].pages is None


def test_scan_papers_with_escaped_quotes(spark, tmp_path):
    line = r'1,"a \"type\", x",J,,,P,12,3,4,2001,jan,,,"\"Quoted\" and \\ more","ends with \\"'
    (tmp_path / "papers.csv").write_text(line + "\n2,t,,,,,,,,,,,,Next,\n")
    for rows in (scan_papers(spark, str(tmp_path)), scan_papers(spark, str(tmp_path), multi_line=True)):
        first, second = sorted(rows.collect())
        assert first.type == 'a "type", x' and first.title == '"Quoted" and \\ more'
        assert first.abstract == "ends with \\" and second.title == "Next"


def test_scan_stopwords(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nof\nof\n")
    assert sorted(scan_stopwords(spark, str(tmp_path / "stop.txt"))) == ["of", "of", "the"]
    with pytest.raises(ValueError):
        scan_stopwords(spark, str(tmp_path / "stop.txt"), max_words=2)


def test_tables_round_trip_and_refuse_to_overwrite(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.5, 1.0])], "paper_id int, vector array<double>")
    path = str(tmp_path / "vectors")
    write_table(rows, path)
    assert read_table(spark, path).collect() == rows.collect()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(rows, path)
    write_table(rows, path, mode="overwrite")


def test_text_sink_keeps_nulls(spark, tmp_path):
    rows = spark.createDataFrame([("u", None, [1, 2])], "user_id string, score double, ids array<int>")
    write_text(rows, str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).first()["value"]
    assert json.loads(line) == {"user_id": "u", "score": None, "ids": [1, 2]}


def test_intermediate_tables_live_in_the_shared_folder(spark):
    folder = storage.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    table = storage.write_once(spark.range(3).toDF("x"), "numbers")
    [file] = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    assert file.startswith(f"file://{folder}") and table.count() == 3


def test_intermediate_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(storage, "_written", [])
    path = storage.new_table_path(spark, "numbers")
    spark.range(3).write.parquet(path)
    storage.drop_written_tables(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
