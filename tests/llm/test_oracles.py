import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from kuatia.llm import lines, neighbours, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_occurrences_are_runs_of_one_block(spark):
    rows = [(i, "s", f"propio {i}a\nuno dos\n\ntres cuatro\nnuevo {'x' * i}\ntres cuatro") for i in range(6)]
    # lines that often follow each other are one block, whether or not they do in this article
    df = spark.createDataFrame(rows + [(6, "s", "tres cuatro"), (7, "s", None), (7, "s", None), (8, None, "uno dos")], "article_id long, source string, body string")
    keyed = lines.line_keys(lines.prepared(df, False)).cache()
    found = lines.occurrences(keyed, lines.boilerplate(keyed).cache()).collect()
    by = sorted((r.article_id, r.first_line, r.last_line, tuple(r.lines)) for r in found)
    # "propio" lines differ but in their numbers: one node, and one block with what follows
    assert by[:2] == [(0, 1, 4, (1, 2, 4)), (0, 6, 6, (6,))] and by[-1] == (6, 1, 1, (1,))
    assert len({r.block for r in found}) == 1
    one = lines.blocks(df).collect()
    assert [(r.source, r.lines, r.articles, r.occurrences, r.longest) for r in one] == [("s", 3, 7, 13, 3)]


def test_copies_of_a_vector_stand_for_each_other(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 8)).astype("float32")
    rows = [(i, x[i // 15 if i < 30 else i - 20].tolist()) for i in range(50)] + [(3, x[0].tolist())]  # 0..14 and 15..29 are copies
    df = spark.createDataFrame(rows, "id long, embedding array<float>").select("id", F.lit("m").alias("model"), F.lit(None).cast("string").alias("task"), F.lit(8).alias("dimensions"), "embedding")
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.id, []).append((r["rank"], r.neighbour, r.cosine))
    ids = sorted({i for i, _ in rows})
    v = np.array([dict(rows)[i] for i in ids], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(v @ v.T, 12)
    right = total = 0
    for i in ids:
        want = sorted((j for j in ids if j != i), key=lambda j: (-s[i, j], j))[:10]
        mine = [n for _, n, _ in sorted(got[i])]
        assert len(mine) == len(set(mine)) and i not in mine
        right, total = right + len(set(mine) & set(want)), total + 10
        if i < 30:
            assert mine == want  # all ten are copies: exact
    assert right >= 0.9 * total
