import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kuatia.functions import records, urls
from kuatia.operators import batches, clustering, labels, matcher, metrics, pairs
from kuatia.sources import feeds, outlets


def test_labels_are_cleaned_and_conflicts_named(spark):
    rows = [(1, 2, " 1", "0.5", "x"), (2, 1, "1", "0.7", "y"), (3, 3, "1", "0.5", None), (4, 5, "9", "0.5", None), (4, 5, None, None, None), (6, None, "1", "1", None), (7, 8, "2", "nan", None), (9, 8, "0", "0.1", "z"), (8, 9, "2", "0.2", "z")]
    df = spark.createDataFrame(rows, "a long, b long, label string, score string, _n string")
    assert [tuple(r) for r in labels.conflicts(labels.valid(df)).collect()] == [(8, 9, 2)]
    with pytest.raises(ValueError, match="8, 9"):
        labels.cleaned(df)
    got = labels.cleaned(df.drop("_n"), spark.createDataFrame([(9, 8, 1)], "a long, b long, label int"))
    assert sorted(map(tuple, got.select("a", "b", "label", "score").collect())) == [(1, 2, 1, 0.7), (8, 9, 1, 0.2)]
    assert labels.cleaned(df.drop("_n").limit(0)).count() == 0


def test_assignments_must_have_the_same_keys(spark):
    one = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "article_id long, event long")
    assert labels.compared(one, one).count() == 3
    with pytest.raises(ValueError, match="3"):
        labels.compared(one, one.where("article_id < 3"))
    none = labels.pair_agreement(labels.compared(one.limit(0), one.limit(0))).first()
    assert tuple(none) == (0, 0, 0, None, None, None)


def test_group_of_a_third_gives_few_pairs(spark):
    df = spark.createDataFrame([(i % 3 and 0 or i, i) for i in range(300)], "g long, k long")
    got = labels.within_groups(df, "g", "k").collect()
    assert len(got) < 2 * 300 and len({(r.g, r.a, r.b) for r in got}) == len(got) and all(r.a < r.b for r in got)


def test_no_article_is_in_two_folds(spark):
    rng = random.Random(4)
    rows = [(a, a + rng.randrange(1, 4) * 10, rng.random() < 0.4) for a in (rng.randrange(2000) for _ in range(300))]
    got = matcher.group_folds(spark.createDataFrame(rows, "a long, b long, same boolean"), folds=4, dealt=20).collect()
    folds = {}
    for r in got:
        for k in (r.a, r.b):
            folds.setdefault(k, set()).add(r.fold)
    assert len(got) == 300 and all(len(f) == 1 for f in folds.values())
    assert len({r.fold for r in got}) == 4


def test_matcher_is_saved_compared_and_loaded(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        same = i % 2 == 0
        rows.append((2 * i, 2 * i + 1, rng.gauss(0.8 if same else 0.5, 0.1), 0, 1 if same else 0, 0, 0.2 if same else rng.random() / 10, same))
    df = spark.createDataFrame(rows, "a long, b long, similarity double, shared_per long, shared_org long, shared_loc long, entity_jaccard double, same boolean")
    model = matcher.fit(df)
    matcher.save(model, str(tmp_path / "m"), pairs=120)
    again, about = matcher.load(str(tmp_path / "m"))
    one, two = (sorted((r.a, r.probability) for r in matcher.scored(m, df).select("a", "probability").collect()) for m in (model, again))
    assert one == two and about["pairs"] == 120 and about["features"] == matcher.FEATURES
    table = matcher.compared(matcher.group_folds(df, folds=2), "fold", 2, models=matcher.zoo(trees=5), sets={"similarity": ["similarity"]}).collect()
    assert {r.model for r in table} == {"logistic", "forest", "boosted"} and all(r.mean_precision > 0.6 and r.folds == 2 for r in table)


def story(n=60, seed=3):
    rng = random.Random(seed)
    rows, scored = [], []
    for i in range(n):
        rows.append((i, datetime(2025, 1, 1) + timedelta(hours=i), [1.0, rng.random()]))
        scored += [(i, c, round(rng.random(), 3), round(rng.random(), 3)) for c in rng.sample(range(max(0, i - 8), i), min(i, 4))]
    return rows, scored


def frames(spark, n=60, seed=3):
    rows, scored = story(n, seed)
    return spark.createDataFrame(rows, "article_id long, time timestamp, v array<double>").cache(), spark.createDataFrame(scored, "target long, candidate long, probability double, similarity double").cache()


@pytest.mark.parametrize("mode", ["baseline", "quality_centroid"])
def test_batches_in_order_give_the_whole_run(spark, mode):
    articles, scored = frames(spark)
    whole = {r.article_id: r.event for r in clustering.assign(articles, scored, mode).collect()}
    parts = [articles.where(c).select("article_id") for c in ("article_id < 20", "article_id between 15 and 45", "article_id > 40")]  # what is known comes again
    got = {r.article_id: r.event for r in clustering.assign_in_batches(parts, articles, scored, mode).collect()}
    assert got == whole and len(set(whole.values())) < len(whole)


def test_late_articles_join_what_is_before_them(spark):
    articles = spark.createDataFrame([(i, datetime(2025, 1, 1 + d), [1.0]) for i, d in ((1, 0), (2, 2), (3, 1))], "article_id long, time timestamp, v array<double>")
    scored = spark.createDataFrame([(2, 1, 0.95, 0.9), (3, 1, 0.96, 0.9), (2, 3, 0.99, 0.99)], "target long, candidate long, probability double, similarity double")
    known = spark.createDataFrame([(1, 1), (2, 2)], "article_id long, event long")
    # 3 is late: 1 lies before it, 2 behind; what is decided stays
    assert [tuple(r) for r in clustering.assign(articles, scored, known=known).collect()] == [(3, 1)]
    got = {r.article_id: r.event for r in clustering.assign(articles, scored, floor="2025-01-02").collect()}
    assert got == {3: 3, 2: 3}  # 1 lies before the floor


def test_replay_keeps_the_rest_and_every_article_once(spark):
    articles, scored = frames(spark)
    whole = clustering.assign(articles, scored).cache()
    events = sorted({r.event for r in whole.collect()})
    gone = spark.createDataFrame([(e,) for e in events[1::3]], "event long")
    got = {r.article_id: r.event for r in clustering.replay(whole, articles, scored, gone).collect()}
    before = {r.article_id: r.event for r in whole.collect()}
    assert set(got) == set(before)
    assert all(got[a] == e for a, e in before.items() if e not in set(events[1::3]))
    everything = {r.article_id: r.event for r in clustering.replay(whole, articles, scored, spark.createDataFrame([(e,) for e in events], "event long")).collect()}
    assert everything == before
    assert clustering.affected(whole, gone, gone).count() == 0
    unknown = articles.where("article_id <> 7")  # one without a vector founds its own event
    assert {r.article_id: r.event for r in clustering.replay(whole, unknown, scored.where("target <> 7 and candidate <> 7"), spark.createDataFrame([(before[7],)], "event long")).collect()}[7] == 7


def test_hot_spans_are_cut_by_themselves(spark):
    rng = random.Random(2)
    rows = [(i, datetime(2025, 1, 1, 0, 0, i % 60) if i < 40 else datetime(2025, 1, 1 + i % 9), [rng.gauss(0, 1) for _ in range(4)]) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, t timestamp, v array<double>")
    whole, cut = ({tuple(r) for r in pairs.nearest_earlier(df, "k", "t", "v", 48, 0.2, 5, cell_rows=c).collect()} for c in (20_000, 7))
    assert whole and whole == cut


def test_exact_auc(spark):
    rng = random.Random(6)
    rows = [(round(rng.random(), rng.choice([1, 5])), rng.random() < 0.4) for _ in range(200)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    got = metrics.exact_auc(spark.createDataFrame(rows, "s double, y boolean"), "s", "y").first()
    assert got.auc == round(want, 6) and (got.positives, got.negatives) == (len(pos), len(neg))
    assert metrics.exact_auc(spark.createDataFrame(rows[:0], "s double, y boolean"), "s", "y").first().auc is None


def test_category_pages_end(spark):
    day = lambda s: datetime.fromisoformat(s).date()
    rows = [("a", 0, ["x"], day("2025-02-01")), ("a", 1, [], None), ("a", 2, ["y"], day("2025-02-01")), ("b", 0, ["p", "q"], day("2025-02-01")), ("b", 1, ["q", "p"], day("2025-02-01")), ("b", 2, ["r"], None), (None, 0, ["n"], None), (None, 1, ["m"], day("2024-01-01")), (None, 2, ["k"], None)]
    df = spark.createDataFrame(rows, "category string, page int, urls array<string>, newest date")
    assert {(r.category, r.page) for r in feeds.pages_until(df, "category", "page", "urls", "newest", "2025-01-01").collect()} == {("a", 0), ("b", 0), (None, 0)}


def test_content_service_answers(spark):
    full = '{"content_elements": [{"canonical_url": "/u1", "headlines": {"basic": "t1"}, "display_date": "2025-01-01"}, {"canonical_url": "/u2"}]}'
    rows = [("q", 0, full), ("q", 2, '{"content_elements": [{"canonical_url": "/u3"}]}'), ("q", 3, full), ("r", 0, "not json"), ("r", 2, full), (None, 0, None)]
    got = feeds.content_items(spark.createDataFrame(rows, "query string, offset int, text string"), "text", "query", "offset", 2)
    assert sorted((r.offset, r.url, r.title) for r in got.collect()) == [(0, "/u1", "t1"), (0, "/u2", None), (2, "/u3", None)]


def test_backfill_keeps_failures_apart(spark):
    days = spark.createDataFrame([("u1", "2025-01-01"), ("u2", "2025-01-02"), ("u3", "2025-01-03"), ("u4", None)], "url string, date string").withColumn("date", F.to_date("date"))

    def broken(first, last):
        raise OSError("no answer")

    found, summary = batches.backfill(spark, {"good": lambda a, b: days, "broken": broken}, "2025-01-02", "2025-01-03", ["good", "broken", "unknown"])
    assert {r.url for r in found.collect()} == {"u2", "u3"}
    assert {(r.connector, r.rows, r.error) for r in summary.collect()} == {("good", 2, None), ("broken", None, "OSError: no answer"), ("unknown", None, "unknown connector")}


def test_records_fall_through_empty_values(spark):
    df = spark.createDataFrame([(("", "cuerpo  largo", "", "", "https://c.example/1#x", "/i.jpg", "ES_py", "STAFF"),), (None,)], "r struct<text:string,body:string,date:string,url:string,canonical_url:string,image:string,language:string,author:string>")
    fields = ("text", "body", "date", "url", "canonical_url", "image", "language", "author")
    got = df.select(records.normalized_record(F.col("r"), F.lit("https://o.example/9#y"), fields).alias("n")).select("n.*").collect()
    assert (got[0].body, got[0].canonical_url, got[0].url, got[0].image_url, got[0].language, got[0].author, got[0].published_text) == ("cuerpo largo", "https://c.example/1", "https://o.example/9", "https://c.example/i.jpg", "es", None, None)
    assert got[1].canonical_url == "https://o.example/9" and got[1].body is None


OUTLET_URLS = {
    "https://www.abc.com.py/politica/2025/03/14/una-nota-larga": "abc", "https://www.abc.com.py/autor/2025/03/14/una-nota-larga": None, "https://cronica.com.py/2025/02/30/una-nota": None, "https://cronica.com.py/2025/02/28/una-nota/": "cronica",
    "https://rdn.com.py/2025/02/30/una-nota": "rdn", "https://qapchaconews.com/noticia/pais/2025/03/14/una-nota/99.html": "qap", "https://ahoracde.com/contacto": None, "https://ahoracde.com/una-nota-larga?x=1": "ahoracde", "https://www.sanlorenzopy.com/123/una-nota-larga": "sanlorenzopy",
    "https://amambaydigital.com/una-nota.html": "amambaydigital", "https://amambaydigital.com/una-nota": None, "https://other.example/una-nota-larga": None, "https://extra.com.py/fama/una-nota-larga": "extra", "https://extra.com.py/economia/una-nota-larga": None,
    "https://www.ip.gov.py/ip/2025/03/14/x/": "ip", "https://dpn.com.py/noticia/una-nota-larga": "dpn", "https://diarioparaguayo.com/noticia/una-nota-larga": "dpn",
}


def test_outlets(spark):
    df = spark.createDataFrame([(u,) for u in OUTLET_URLS] + [(None,)], "url string")
    assert {r.url: r.o for r in df.select("url", outlets.outlet_of(F.col("url")).alias("o")).collect()} == {**OUTLET_URLS, None: None}
    assert len(outlets.registry()) == 45 and outlets.as_table(spark).select("host").distinct().count() == outlets.as_table(spark).count()
    listing = [("p", 0, "https://cronica.com.py/2025/02/28/una-nota?a", "leer"), ("p", 3, "https://cronica.com.py/2025/02/28/una-nota", "Una nota"), ("p", 1, "https://rdn.com.py/2025/02/28/una-nota", None), ("p", 2, "https://rdn.com.py/2025/02/28/una-nota/", "B"), ("p", 4, "https://rdn.com.py/2025/02/28/una-nota", "C")]
    got = outlets.article_links(spark.createDataFrame(listing, "page string, pos int, url string, title string"))
    assert {tuple(r) for r in got.collect()} == {("cronica", "https://cronica.com.py/2025/02/28/una-nota/", "Una nota"), ("rdn", "https://rdn.com.py/2025/02/28/una-nota", "B")}
    assert outlets.article_links(got.limit(0).selectExpr("'p' as page", "1 as pos", "url", "title")).count() == 0


def test_a_shape_reads_its_slug_before_a_numbered_page(spark):
    shape = urls.Shape(min_parts=2, slug_at=-2, numbered_page=True, min_slug=3)
    df = spark.createDataFrame([("https://h.example/abc/1.html",), ("https://h.example/abc/x.html",), ("https://h.example/a/1.html",)], "u string")
    assert [r[0] for r in df.select(urls.is_article_url(F.col("u"), shape)).collect()] == [True, False, False]
