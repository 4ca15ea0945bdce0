"""Queries against brute force on tables that earlier bounds would have cut."""

import datetime
import math
import random

import duckdb
import pytest

from kuatia.operators import pairs
from kuatia.operators.matcher import out_of_fold
from kuatia.plans import catalog
from kuatia.sources import feeds, files


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_tokens_of_many_titles_block(spark, tmp_path):
    # incendio and bosque have 60 titles, comun has 130: above the reference's 120
    titles = {i: ["incendio", "bosque", f"lugar{i // 2}"] for i in range(60)} | {i: ["comun", f"lugar{i // 2}"] for i in range(100, 230)}
    d = write(spark, tmp_path, "event_context_articles", [(k, " ".join(t)) for k, t in titles.items()], "article_id long, title string")
    df = {t: sum(t in x for x in titles.values()) for x in titles.values() for t in x}
    assert df["bosque"] == 60 and df["comun"] == 130
    want = {}
    for a, x in titles.items():
        for b, y in titles.items():
            n = sum(t in y and 2 <= df[t] <= 120 for t in x)
            if a < b and n >= 2:
                want[a, b] = n
    assert len(want) == 60 * 59 // 2
    assert {(r.a, r.b): r.shared for r in catalog.QUERIES["q_token_block_pairs"](spark, d).collect()} == want
    idf = {t: math.log((len(titles) + 1) / (n + 1)) + 1 for t, n in df.items()}
    got = {(r.a, r.b): r.similarity for r in catalog.QUERIES["q_weighted_title_similarity"](spark, d).collect()}
    assert got.keys() == want.keys()
    for (a, b), s in got.items():
        o = sum(idf[t] for t in titles[a] if t in titles[b])
        assert abs(s - o / (sum(idf[t] for t in titles[a]) + sum(idf[t] for t in titles[b]) - o)) < 2e-5


def test_effective_order_numbers_every_membership(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
    rows = []
    for i in range(1300):
        scraped = start + datetime.timedelta(hours=i * 7919 % 1300 // 2)
        published = [None, "ayer", (scraped - datetime.timedelta(days=400)).strftime("%Y-%m-%dT%H:%M:%S+00:00")][i % 3]
        rows.append((i % 50, i, published, scraped))
    rows += [(7, 5000, None, None)] + rows[:20]
    d = write(spark, tmp_path, "event_context_articles", rows, "event_id long, article_id long, published_at string, scraped_at timestamp")
    times = {(e, a): datetime.datetime.fromisoformat(p) if p and p[0] == "2" else s for e, a, p, s in rows}
    want = sorted(times, key=lambda x: (times[x] is None, times[x] or start, x[1], x[0]))
    got = {r.n: r.article_id for r in catalog.QUERIES["q_effective_order"](spark, d).collect()}
    assert got == {n: a for n, (_, a) in enumerate(want, 1)}


def test_effective_order_of_null_ids_and_odd_times(spark, tmp_path):
    day = datetime.datetime(2024, 3, 5, 12, tzinfo=datetime.UTC)
    zones = [f"{s}{h:02d}:{m:02d}" for s in "+-" for h in (0, 3, 18, 19, 99) for m in (0, 1, 59, 60, 99)]
    texts = [f"2024-03-0{i % 4 + 1}T00:00:00{z}" for i, z in enumerate(zones)]
    texts += [f"{t}-03:00" for t in ("2024-02-29T24:00:00", "2023-12-31T24:00:00", "2023-02-29T24:00:00", "2024-03-05T24:00:01", "2024-03-05T23:59:60", "2024-13-01T00:00:00", "9999-12-31T24:00:00")]
    texts += ["2024-03-05T24:00:00+99:99", "0000-02-29T00:00:00+00:00", "2024-03-05T01:00:00+00:00\n", "2024-03-05T01:00:00Z", ""]
    rows = [(i % 7, i, t, day - datetime.timedelta(days=i)) for i, t in enumerate(texts)]
    rows += [(e, a, None, day) for e in (None, -1, 8) for a in (8, None, -1)] + [(e, a, None, None) for e in (20, None) for a in (20, None, 21) if e or a]
    d = write(spark, tmp_path, "event_context_articles", rows, "event_id long, article_id long, published_at string, scraped_at timestamp")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    con.execute(f"CREATE VIEW event_context_articles AS SELECT * FROM '{d}/event_context_articles.parquet/*.parquet'")
    for name, ids in (("q_effective_order", "article_id"), ("q_effective_positions", "article_id, event_id")):
        want = con.sql(f"SELECT n, epoch_us(effective_time), {ids} FROM ({catalog.SQL[name]}) ORDER BY n").fetchall()
        got = catalog.QUERIES[name](spark, d).selectExpr("n", "unix_micros(effective_time)", *ids.split(", ")).collect()
        assert len(want) == len(rows) < 500  # the bound of q_effective_order's SQL
        assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("encoding,last", [("cp1252", "ñandú “x” €5"), ("latin1", "ñandú \x81"), ("utf-8", "ñandú “x” €5"), ("utf-8-sig", "ñandú")])
def test_csv_with_late_accents(spark, tmp_path, encoding, last):
    path = tmp_path / "x.csv"
    path.write_bytes(("id,title\n" + "".join(f"{i},plain words of a title\n" for i in range(6000)) + f"6000,{last}\n").encode(encoding))
    assert path.stat().st_size > 2 * files.HEAD
    df = files.read_csv(spark, str(path))
    assert df.count() == 6001 and df.where("id = '6000'").first().title == last


def test_csv_character_across_pieces(spark, tmp_path):
    path = tmp_path / "x.csv"
    head = "id,title\n1,"
    text = "a" * (files.HEAD - len(head) - 1) + "ñ"  # its two bytes lie in two pieces
    path.write_text(f"{head}{text}\n", encoding="utf-8")
    assert files.sniff(str(path)) == ("utf-8", ",")
    assert files.read_csv(spark, str(path)).first().title == text


def test_fold_without_a_model_keeps_its_rows(spark):
    rng = random.Random(6)
    # all positive pairs lie in fold 1: without it only one class is left
    rows = [(i, i % 3, s := rng.random(), 0, 1, 0, s / 2, i % 3 == 1 and s > 0.5) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, fold int, similarity double, shared_per int, shared_org int, shared_loc int, entity_jaccard double, same boolean")
    got = {r.k: r.probability for r in out_of_fold(df, "fold", 3).collect()}
    assert got.keys() == set(range(150))
    assert all((p is None) == (k % 3 == 1) for k, p in got.items())
    with pytest.raises(ValueError):
        out_of_fold(df.where("not same"), "fold", 3)


def test_crawl_follows_deep_sitemaps(spark):
    index = [(f"m{i}", f"<s><sitemap><loc>m{i + 1}</loc></sitemap><sitemap><loc>m0</loc></sitemap></s>") for i in range(13)]
    pages = spark.createDataFrame([*index, ("m13", "<u><url><loc>deep</loc></url></u>")], "url string, xml string")
    seeds = spark.createDataFrame([("m0",)], "url string")
    assert [r.url for r in feeds.crawl(pages, seeds).collect()] == ["deep"]
    assert feeds.crawl(pages, seeds, most=13).count() == 0


def test_unfinished_components_raise(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="converged"):
        pairs.components(edges, rounds=1)
    assert {r.component for r in pairs.components(edges).collect()} == {0}
