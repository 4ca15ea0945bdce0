import random

import numpy as np
import pytest

from kuatia.llm import nearcopies, neighbours


def bodies(n=150):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(4000)]
    rows = []
    for i in range(n):
        base = rng.choices(words, k=rng.choice([12, 60, 150]))
        rows.append(base)
        if i % 3 == 0:  # copies with growing damage
            for damage in (0.0, 0.02, 0.05, 0.1, 0.2):
                rows.append([w if rng.random() >= damage else rng.choice(words) for w in base])
        if i % 10 == 0:  # a follow-up that shares a part
            rows.append(base[: len(base) // 3] + rng.choices(words, k=len(base)))
    out = [(i, "s", " ".join(w)) for i, w in enumerate(rows)]
    return out + [(9000, "s", None), (9001, "s", ""), (9002, None, "dos palabras"), (9003, "s", out[0][2].upper() + " ​")] + out[:5]


def jaccard_pairs(rows, least=0.5):
    sets = {}
    for i, _, b in rows:
        w = (b or "").replace("​", "").lower().split()
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    ids = sorted(i for i in sets if sets[i])
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def test_near_copies_against_brute_force(spark):
    rows = bodies()
    df = spark.createDataFrame(rows, "article_id long, source string, body string")
    got = [tuple(r) for r in nearcopies.found(df).collect()]
    want = jaccard_pairs(rows)
    assert len(got) == len(set(got))
    assert not set(got) - want
    assert len(want - set(got)) <= 0.01 * len(want)


def test_large_classes_become_stars(spark):
    rows = [(i, "s", "uno dos tres cuatro cinco") for i in range(20)]
    df = spark.createDataFrame([(i, f"s{i}", b) for i, _, b in rows], "article_id long, source string, body string")
    from kuatia.llm.lines import boilerplate, line_keys, prepared

    r = prepared(df, True).cache()
    members, links = nearcopies.near_copies(r, boilerplate(line_keys(r)))
    assert {tuple(x) for x in nearcopies.expanded(members, links, full_class=5).collect()} == {(0, i) for i in range(1, 20)}
    assert nearcopies.expanded(members, links).count() == 190


def test_no_bodies(spark):
    assert nearcopies.found(spark.createDataFrame([], "article_id long, source string, body string")).count() == 0


def test_chain():
    a = np.array([0, 0, (1 << 60) - 1])
    b = np.array([0, (1 << 60) - 1, (1 << 60) - 1])
    assert nearcopies.chain_holds(a, b, 2.4).tolist() == [True, False, True]


@pytest.mark.parametrize("n", [700, 9000])
def test_neighbours_recall(spark, n):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(n // 8, 16))
    x = (centres[rng.integers(0, len(centres), n)] + 0.5 * rng.normal(size=(n, 16))).astype(np.float32)
    x[1] = x[0]
    rows = [(i, "m", "t", 16, x[i].tolist()) for i in range(n)]
    bad = [(n + 1, "m", "t", 16, None), (n + 2, "m", "t", 16, [0.0] * 16), (n + 3, "m", "t", 16, [1.0] * 15), (n + 4, "m", "t", 16, [float("nan")] * 16), (n + 5, "m", "t", 16, [float("inf")] + [0.0] * 15), (n + 6, "other", "t", 2, [1.0, 0.0]), (n + 7, "other", None, 2, [1.0, 0.0]), (n + 8, "other", None, 2, [2.0, 0.0])]
    df = spark.createDataFrame(rows + rows[:20] + bad, "id long, model string, task string, dimensions int, embedding array<float>")
    got = [tuple(r) for r in neighbours.found(df).collect()]
    assert len(got) == len(set(got))
    assert (n + 7, n + 8) in got and not any(n < a < n + 7 or n < b < n + 7 for a, b in got)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    np.fill_diagonal(s, -9)
    want = set()
    for i in range(n):
        top = np.lexsort((np.arange(n), -s[i]))[:10]
        want |= {(min(i, j), max(i, j)) for j in map(int, top)}
    assert len(want & set(got)) >= 0.95 * len(want)


def test_neighbour_ties_and_ranks(spark):
    df = spark.createDataFrame([(i, "m", "t", 2, [1.0, 0.0]) for i in range(14)], "id long, model string, task string, dimensions int, embedding array<float>")
    got = {(r.id, r.neighbour) for r in neighbours.nearest(df).collect()}
    assert got == {(i, j) for i in range(14) for j in [k for k in range(14) if k != i][:10]}
    assert neighbours.found(df.limit(0)).count() == 0


def test_hot_runs_are_cut_into_blocks(spark):
    # a family of copies that differ: each segment's run is far longer than the blocks
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(900)]
    base = rng.choices(words, k=80)
    rows = [(i, "s", " ".join(w if rng.random() >= 0.02 else rng.choice(words) for w in base)) for i in range(90)]
    df = spark.createDataFrame(rows, "article_id long, source string, body string")
    docs = nearcopies._sets(*_prepared(df), False).cache()
    seeds = nearcopies._seeds(docs.selectExpr("article_id as id", "signature"), 3)
    per_segment = nearcopies.budget() / (nearcopies.COLUMNS // nearcopies.SEGMENT)
    whole = {tuple(r) for r in nearcopies._meetings(seeds, 3, per_segment).collect()}
    cut = nearcopies._meetings(seeds, 3, per_segment, run_rows=7).collect()
    assert whole and len(cut) == len(set(map(tuple, cut))) and {tuple(r) for r in cut} == whole


def _prepared(df):
    from kuatia.llm.lines import boilerplate, line_keys, prepared

    rows = prepared(df, True).cache()
    return rows, boilerplate(line_keys(rows))
