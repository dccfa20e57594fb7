from __future__ import annotations

import pytest

from sparkmine.sources import readers, sinks


def put(path, text: str) -> str:
    path.write_text(text)
    return str(path)


def test_survey_columns_by_name(spark, tmp_path, rows):
    path = put(tmp_path / "s.csv", 'Id,Salary,Country,SalaryType,Note\n1,"1,000",Aland,Monthly,"say ""hi"""\n2,,Borduria,NA,\n')
    df = readers.read_survey(spark, path)
    assert df.columns == ["country", "salary", "salary_type"]
    assert rows(df) == [("Aland", "1,000", "Monthly"), ("Borduria", None, "NA")]


def test_ratings_drop_the_header_and_stop_on_bad_rows(spark, tmp_path, rows):
    good = put(tmp_path / "g.csv", "user,item,stars\nu1,i1,4.0\nu2,i1,3\n")
    assert rows(readers.read_ratings(spark, good)) == [("u1", "i1", 4.0), ("u2", "i1", 3.0)]
    bad = put(tmp_path / "b.csv", "user,item,stars\nu1,i1,many\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_ratings(spark, bad).collect()


def test_baskets_have_no_header(spark, tmp_path, rows):
    path = put(tmp_path / "w.csv", "0,good\n0,food\n1,good\n")
    assert rows(readers.read_baskets(spark, path)) == [("0", "food"), ("0", "good"), ("1", "good")]


def test_documents_are_lines(spark, tmp_path):
    path = put(tmp_path / "d.txt", "one line\n\nthird  line \n")
    got = readers.read_documents(spark, path).collect()
    assert [r.text for r in got] == ["one line", "", "third  line "]
    assert len({r.doc_id for r in got}) == 3


def test_predictions_are_written_in_order(spark, tmp_path):
    pred = spark.createDataFrame(
        [("b", "x", 1.0, 2.5), ("a", "z", 1.0, 3.0), ("a", "y", 1.0, 4.0)],
        "user_id STRING, item_id STRING, rating DOUBLE, prediction DOUBLE",
    )
    sinks.write_predictions(pred, str(tmp_path / "p"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert lines == ["a,y,4.0", "a,z,3.0", "b,x,2.5"]


def test_ratings_with_more_fields(spark, tmp_path, rows):
    path = put(tmp_path / "w.csv", "user,item,stars,time,note\nu1,i1,4.5,99,a\nu2,i1,3,98,\n")
    assert rows(readers.read_ratings(spark, path)) == [("u1", "i1", 4.5), ("u2", "i1", 3.0)]


def test_last_rating_in_file_and_line_order(spark, tmp_path, rows):
    from sparkmine.programs import _last_per_pair

    put(tmp_path / "a.csv", "user,item,stars\nu,i,1\nu,j,1\nu,j,2\n")
    put(tmp_path / "b.csv", "user,item,stars\n" + "x,y,3\n" * 500 + "u,i,5\n")
    assert rows(_last_per_pair(readers.read_placed_ratings(spark, str(tmp_path)))) == [("u", "i", 5.0), ("u", "j", 2.0), ("x", "y", 3.0)]


def test_short_basket_lines_hold_nothing(spark, tmp_path, rows):
    path = put(tmp_path / "w.csv", "0,good\n1\n2,\n,x\n")
    assert rows(readers.read_baskets(spark, path)) == [("0", "good")]
