import random

from pyspark.sql import functions as F

from kuatia.functions import text, urls
from kuatia.operators import clustering, pairs, store
from kuatia.operators.matcher import coefficients, fit, scored


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in pairs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}


def sequential(times, scored):
    """The assignment in one loop over all articles."""
    of, size = {}, {}
    by = {}
    for t, c, p, s in scored:
        by.setdefault(t, []).append((-p, -s, c))
    for a in sorted(times, key=lambda a: (times[a], a)):
        groups = {}
        for p, _, c in sorted(by.get(a, [])):
            if c in of:
                groups.setdefault(of[c], []).append(-p)
        best = None
        for e, ps in groups.items():
            ps = ps[:5]
            strong, support = sum(p >= 0.75 for p in ps), sum(p >= 0.5 for p in ps)
            if ps[0] >= 0.9 if size[e] == 1 else strong >= 2 or (ps[0] >= 0.9 and support >= 2):
                r = (strong, sum(ps[:2]) / len(ps[:2]), ps[0], sum(ps) / len(ps), -e)
                best = max(best, (r, e)) if best else (r, e)
        of[a] = best[1] if best else a
        size[of[a]] = size.get(of[a], 0) + 1
    return of


def test_assignment_by_component_is_the_sequential_one(spark):
    rng = random.Random(5)
    times = {a: 1_700_000_000 + rng.randrange(40) * 3600 for a in range(120)}
    order = sorted(times, key=lambda a: (times[a], a))
    links = [(order[i], order[j], round(rng.uniform(0.4, 1), 3), round(rng.uniform(0.7, 1), 3)) for i in range(120) for j in rng.sample(range(i), min(i, 2))]
    articles = spark.createDataFrame([(a, t, [1.0, 0.0]) for a, t in times.items()], "article_id long, s long, v array<double>").select("article_id", F.timestamp_seconds("s").alias("time"), "v")
    got = {r.article_id: r.event for r in clustering.assign(articles, spark.createDataFrame(links, "target long, candidate long, probability double, similarity double")).collect()}
    assert got == sequential(times, links)


def test_nearest_earlier_splits_cells(spark, monkeypatch):
    monkeypatch.setattr(pairs, "CELL_ROWS", 7)
    rng = random.Random(2)
    rows = [(i, 1_700_000_000 + rng.randrange(5) * 7200, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows = [(i, t, [x / sum(y * y for y in v) ** 0.5 for x in v]) for i, t, v in rows]
    df = spark.createDataFrame(rows, "k long, s long, v array<double>").select("k", F.timestamp_seconds("s").alias("t"), "v")
    got = {(r.target, r.candidate) for r in pairs.nearest_earlier(df, "k", "t", "v", 3, 0.2, 4).collect()}
    want = set()
    for i, t, v in rows:
        c = [(-round(sum(a * b for a, b in zip(v, w)), 9), j) for j, u, w in rows if t - 10800 <= u and (u, j) < (t, i)]
        want |= {(i, j) for s, j in sorted(x for x in c if x[0] <= -0.2)[:4]}
    assert got == want


def test_context_takes_new_sources_first(spark):
    rows = [(1, 10, 1, 0.5, 9, [1.0, 0.0], True), (1, 11, 1, 0.9, 9, [0.8, 0.6], False), (1, 12, 2, 0.4, 9, [0.0, 1.0], False), (1, 13, 3, 0.3, 9, [1.0, 0.001], False)]
    df = spark.createDataFrame(rows, "event_id long, article_id long, source_id int, centrality double, length int, v array<double>, is_first boolean")
    got = [r.article_id for r in clustering.contexts(df).orderBy("position").collect()]
    assert got == [10, 12, 11]  # 13 is too close to the first


def test_store(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b")], "k long, c string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "k long, c string")
    assert {r.k: r.action for r in store.merge_plan(now, new, "k", "c").collect()} == {1: "same", 2: "update", 3: "insert"}
    assert {r.k: r.c for r in store.merged(now, new, "k").collect()} == {1: "a", 2: "x", 3: None}


def test_matcher_learns(spark):
    rng = random.Random(4)
    rows = [(s, rng.randrange(3), 0, 1, rng.random() / 5, s > 0.7) for s in (rng.random() for _ in range(200))]
    df = spark.createDataFrame(rows, "similarity double, shared_per int, shared_org int, shared_loc int, entity_jaccard double, same boolean")
    model = fit(df)
    out = scored(model, df).collect()
    assert sum((r.probability > 0.5) == r.same for r in out) > 190
    assert coefficients(model)[0][0] == "similarity"


def test_text_and_urls(spark):
    row = spark.createDataFrame([("    ", "ES_py", "https://X.example/A/B//?q#f", "../i.png", "https://x.example/a/2024/02/30/s", None)], "a string, l string, u string, i string, d string, n string")
    r = row.select(
        text.clean_text(F.col("a")).alias("a"), text.normalize_language(F.col("l")).alias("l"), text.normalize_language(F.col("n")).alias("n"), urls.clean_url(F.col("u")).alias("u"),
        urls.image_url(F.col("i"), F.lit("https://x.example/a/b/c.html")).alias("i"), urls.date_of(F.col("d"), 2).alias("d"), urls.is_article_url(F.col("n"), urls.SHAPES["root-slug"]).alias("none"),
        text.entity_form(F.lit("Ｌａ  Ｃａｓａ .")).alias("e"), text.entity_form_without_accents(F.lit("Ñandutí")).alias("p"),
    ).first()
    assert (r.a, r.l, r.n, r.u, r.i, r.d, r.none, r.e, r.p) == (None, "es", "es", "https://x.example/A/B", "https://x.example/a/i.png", None, False, "la casa.", "nanduti")
