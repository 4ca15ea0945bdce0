from datetime import datetime, timedelta

from kuatia.llm import survivors

T0 = datetime(2024, 5, 1)
SCHEMA = "event_id long, article_id long, source_id int, source string, published_at string, title string, body string, image_url string, centrality double, scraped_at timestamp, is_representative boolean"


def row(event, article, centrality=None, published=None, title="t", body="b", image="i", source=1, hours=0):
    return (event, article, source, f"s{source}", published, title, body, image, centrality, T0 + timedelta(hours=hours), None)


def test_order(spark):
    rows = [
        row(1, 1, 0.9), row(1, 2, 0.8),  # centrality
        row(2, 3, float("nan"), image="--"), row(2, 4, 7.0), row(2, 5, None, title=" "),  # unusable centralities: the most complete
        row(3, 6, 0.5, "2024-05-01T10:00:00Z"), row(3, 7, 0.5, "2024-05-01T11:00:00Z"),  # recency
        row(4, 8, 0.5, source=2), row(4, 9, 0.5, source=1), row(4, 10, 0.5, source=9),  # trust, unknown last
        row(5, 12, 0.5), row(5, 11, 0.5),  # the smaller id
        row(6, 13, 1.0),  # alone
        row(7, 14, 0.2, hours=2), row(7, 14, 0.9, hours=1), row(7, 15, 0.5), row(7, 15, 0.5),  # the latest usable value
        row(8, 16, 0.2, hours=1), row(8, 16, None, hours=2), row(8, 17, 0.1),  # an unusable later value
        row(None, 18, 0.2), row(None, 19, 0.3),
    ]
    trust = spark.createDataFrame([(1, "s1", 1), (2, "s2", 3), (1, "s1", 2)], "source_id int, source string, trust_rank int")
    got = {r.event_id: r.article_id for r in survivors.found(spark.createDataFrame(rows, SCHEMA), trust).collect()}
    assert got == {1: 1, 2: 4, 3: 7, 4: 9, 5: 11, 7: 15, 8: 16}


def test_empty(spark):
    trust = spark.createDataFrame([], "source_id int, source string, trust_rank int")
    assert survivors.found(spark.createDataFrame([], SCHEMA), trust).count() == 0
