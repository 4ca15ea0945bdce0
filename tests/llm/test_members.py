from kuatia.llm import queries


def test_members_give_the_links_that_stars_leave_out(spark, tmp_path, monkeypatch):
    base = [f"palabra{i}" for i in range(40)]
    # 8 articles of one class, 2 of another that shares most word triples with it
    rows = [(i, f"s{i}", " ".join(base)) for i in range(8)] + [(20 + i, f"t{i}", " ".join(base[:34])) for i in range(2)] + [(30, "u", "otra cosa muy distinta aquí")]
    spark.createDataFrame(rows, "article_id long, source string, body string").write.parquet(f"{tmp_path}/event_context_articles.parquet")
    members = {r.article_id: (r.class_id, r["size"]) for r in queries.QUERIES["p6_members"](spark, str(tmp_path)).collect()}
    assert members == {i: (0, 8) for i in range(8)} | {20: (20, 2), 21: (20, 2), 30: (30, 1)}
    expand = queries.nearcopies.expanded
    monkeypatch.setattr(queries.nearcopies, "expanded", lambda m, links: expand(m, links, full_class=5))
    pairs = {tuple(r) for r in queries.QUERIES["p6_found"](spark, str(tmp_path)).collect()}
    assert pairs == {(0, i) for i in range(1, 8)} | {(0, 20), (0, 21), (20, 21)}
    linked = {tuple(sorted((members[a][0], members[b][0]))) for a, b in pairs}
    whole = {(a, b) for a in members for b in members if a < b and tuple(sorted((members[a][0], members[b][0]))) in linked}
    assert whole == {(a, b) for a in [*range(8), 20, 21] for b in [*range(8), 20, 21] if a < b}
