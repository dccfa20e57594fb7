from __future__ import annotations

import json

import pytest

from sparkmine import programs


def lines(spark, path) -> list[str]:
    return [r.value for r in spark.read.text(str(path)).collect()]


@pytest.fixture
def survey_file(tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text(
        'Country,Salary,SalaryType\nAland,"1,000",Monthly\nAland,NA,NA\nBorduria,50,Weekly\nBorduria,0,Yearly\nAland,7,\n'
    )
    return str(path)


def test_salaries(spark, survey_file, tmp_path):
    programs.salary_counts(spark, survey_file, str(tmp_path / "c"))
    assert lines(spark, tmp_path / "c") == ["Total,3", "Aland,2", "Borduria,1"]
    programs.salary_statistics(spark, survey_file, str(tmp_path / "s"))
    assert lines(spark, tmp_path / "s") == ["Aland,2,12000,12000,12000.0", "Borduria,1,2600,2600,2600.0"]
    programs.partition_report(spark, survey_file, str(tmp_path / "p"))
    parts = [line.split(",") for line in lines(spark, tmp_path / "p")]
    assert [p[:2] for p in parts] == [["Standard", "0"], ["Standard", "1"], ["Partition", "0"], ["Partition", "1"]]
    assert sum(int(p[2]) for p in parts) == 10


def test_predictions(spark, tmp_path):
    train, test = tmp_path / "train.csv", tmp_path / "test.csv"
    known = [(u, i, (u * i) % 5 + 1) for u in range(8) for i in range(6) if (u + i) % 4]
    known.append((0, 1, 4))  # rated again: the later line counts
    train.write_text("user,item,stars\n" + "".join(f"u{u},i{i},{r}\n" for u, i, r in known))
    test.write_text("user,item,stars\nu0,i0,1\nu9,i1,4\nu9,i9,5\nu0,i0,3\n")
    figures = programs.predict_by_items(spark, str(train), str(test), str(tmp_path / "items"))
    out = dict(line.rsplit(",", 1) for line in lines(spark, tmp_path / "items"))
    assert list(out) == ["u0,i0", "u9,i1", "u9,i9"] and out["u9,i9"] == "3.0"
    assert {r.measure for r in figures.collect()} == {f"errors_from_{n}" for n in range(5)} | {"rmse"}
    programs.predict_by_factors(spark, str(train), str(test), str(tmp_path / "factors"), iters=3)
    assert [line.rsplit(",", 1)[0] for line in lines(spark, tmp_path / "factors")] == ["u0,i0", "u0,i0"]


def test_itemsets(spark, tmp_path):
    source = tmp_path / "words.csv"
    source.write_text("0,a\n0,b\n1,a\n1,b\n1,b\n2,a\n")
    programs.mine_itemsets(spark, str(source), 2, str(tmp_path / "out"))
    assert lines(spark, tmp_path / "out/size=1") == ["(a)", "(b)"]
    assert lines(spark, tmp_path / "out/size=2") == ["(a,b)"]


@pytest.mark.parametrize(
    "program, flag, name",
    [
        (programs.cluster_by_words, "W", "K-means"),
        (programs.cluster_by_words, "t", "K-means"),
        (programs.cluster_by_model, "K", "K-Means"),
        (programs.cluster_by_model, "b", "Bisecting K-Means"),
    ],
)
def test_clusters(spark, tmp_path, program, flag, name):
    source = tmp_path / "docs.txt"
    source.write_text("".join(f"{w} {w} {x}\n" for w in ("red", "cat", "one") for x in ("p", "q", "r", "s")))
    program(spark, str(source), flag, 3, 4, str(tmp_path / "out"))
    report = json.loads(lines(spark, tmp_path / "out")[0])
    assert report["algorithm"] == name
    assert sum(c["size"] for c in report["Clusters"]) == 12
    assert sum(c["error"] for c in report["Clusters"]) == pytest.approx(report["WSEEE"])
    assert all(c["terms"] for c in report["Clusters"])


def test_posts(spark, tmp_path):
    posts = spark.createDataFrame(
        [(1, None, "big data", ["x", "y"]), (2, None, "nothing", ["z"]), (3, None, "Data!", ["x"])],
        "id BIGINT, ts TIMESTAMP, text STRING, tags ARRAY<STRING>",
    )
    posts.write.parquet(str(tmp_path / "in"))
    seen = []
    for program, state in ((programs.sample_posts, "s"), (programs.score_posts, "b")):
        program(
            spark, str(tmp_path / "in"), str(tmp_path / state), available_now=True, emit=lambda df, _: seen.append(df.collect())
        ).awaitTermination()
    hot, stats, score = seen
    assert [tuple(r) for r in hot] == [("x", 2), ("y", 1)]
    assert tuple(stats[0]) == (2, 2, 6.5)
    assert sum(score[0]) == 3
