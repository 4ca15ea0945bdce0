import json

import pytest
from pyspark.sql import functions as F

from kuatia.operators.store import expect, require_columns
from kuatia.sources import feeds, files, html


def test_listing_titles(spark):
    page = "<a href='/n/a-b#x'>Leer más</a><a href='/n/a-b'>Un título <i>largo</i></a><a href='/n/a-b'>Corto</a><a href=''>x</a>"
    found = html.listing(spark.createDataFrame([("https://s.example/l", page), ("https://s.example/e", None)], "url string, html string"))
    rows = sorted((r.pos, r.url, r.title) for r in found.collect())
    assert rows == [(0, "https://s.example/n/a-b", None), (1, "https://s.example/n/a-b", "Un título largo"), (2, "https://s.example/n/a-b", "Corto")]
    assert html.longest_title(found).first().title == "Un título largo"
    assert html.last_title(found).first().title == "Corto"
    assert html.first_title(found).first().title == "Un título largo"


def test_published_text(spark):
    ld = {"@graph": [{"a": {"datePublished": ""}}, {"b": [{"datePublished": "2024-01-02T03:04:05Z"}]}]}
    pages = [f'<script type="application/ld+json">{json.dumps(ld)}</script><meta property="article:published_time" content="x">', '<script type="application/ld+json">{bad</script><meta itemprop="datePublished" datetime="y">', "<p>no date</p>", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string")
    got = {r.i: r.p for r in df.select("i", html.published_text(F.col("h")).alias("p")).collect()}
    assert got == {0: "2024-01-02T03:04:05Z", 1: "y", 2: None, 3: None}


def test_paged_json(spark, tmp_path):
    feeds.register(spark)
    for query, pages in {"q1": [(2, 2), (2, 4), (1, 5), (2, 7)], "q2": [(2, 2), (2, 2), (2, 9)], "q3": [(0, 1)]}.items():
        (tmp_path / query).mkdir()
        for i, (n, end) in enumerate(pages):
            (tmp_path / query / f"{i:03}.json").write_text(json.dumps({"items": [{"link": f"{query}/{i}/{k}", "title": "t"} for k in range(n)], "metadata": {"endindex": end}}))
    got = spark.read.format("paged_json").option("pagesize", "2").load(str(tmp_path)).groupBy("query").count().collect()
    # q1 ends after a short page, q2 where the offset stands still
    assert {r["query"]: r["count"] for r in got} == {"q1": 5, "q2": 4}


@pytest.mark.parametrize("encoding,sep", [("utf-8-sig", ";"), ("cp1252", ","), ("utf-8", "\t")])
def test_sniffed_csv(spark, tmp_path, encoding, sep):
    path = tmp_path / "x.csv"
    path.write_text(sep.join(["id", "título"]) + "\n" + "\n".join(sep.join([str(i), "ñandú"]) for i in range(5)) + "\n", encoding=encoding)
    df = files.read_csv(spark, str(path))
    assert df.columns == ["id", "título"] and df.first()["título"] == "ñandú" and df.count() == 5


def test_append_resume_and_progress(spark, tmp_path):
    path, mark = str(tmp_path / "log"), str(tmp_path / "mark.json")
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (1, "a")], "event_id long, model string")
    assert files.append_new(rows, path, ["event_id", "model"]).count() == 2
    more = spark.createDataFrame([(2, "a"), (3, "a")], "event_id long, model string")
    files.append_new(more, path, ["event_id", "model"])
    assert spark.read.parquet(path).count() == 3
    assert files.load_progress(mark) is None
    files.save_progress(mark, 7, "2024-01-01")
    assert files.load_progress(mark) == 7


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert expect(df, "n > 0", "positive").count() == 2
    with pytest.raises(Exception, match="positive"):
        expect(df, "n > 1", "positive").collect()
    with pytest.raises(ValueError):
        require_columns(df, ["m"])
