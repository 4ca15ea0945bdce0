import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kuatia.llm import lines
from kuatia.llm.charforms import clean_batch, consistent_form, duck, found

CHANGED = {
    "ｌａ ﬁrma": "la firma", "café": "café", "Kuаrahу": "Kuarahy", "a‍b": "ab", "a­b​﻿": "ab", "a b　c d": "a b c d",
    "e​́": "é", " ": " ", "𝐛𝐨𝐥𝐝": "bold", "ĳs": "ijs", "МОLINО": "MOLINO", "К​ap": "Kap", "a️": "a",
}
KEPT = ["", " ", "g̃uarani ñ", "«Ветерок» Ω μ", "35 m² 2.ª N.º", "“x” – ‘y’ — …", "👨‍👩‍👧‍👦 ⚽️ 1️⃣ ❤️‍🔥", "a\r\nb\n", "می‌خواهم", "東京 USB", "Samu'ũ", "क्‍ष"]


def test_forms():
    texts = [*CHANGED, *KEPT, None]
    out = clean_batch(duck(), pa.table({"t": pa.array(texts, pa.string())}), ["t"], flags=True)
    got = list(zip(texts, out["t"].to_pylist(), out["t_off"].to_pylist()))
    assert got == [(a, b, True) for a, b in CHANGED.items()] + [(a, a, False) for a in KEPT] + [(None, None, False)]


def test_forms_are_stable():
    first = clean_batch(duck(), pa.table({"t": [*CHANGED, *KEPT]}), ["t"])
    assert not any(clean_batch(duck(), first, ["t"], flags=True)["t_off"].to_pylist())


def test_found_keeps_each_field_once(spark):
    df = spark.createDataFrame([(1, "ｘ", "ok"), (1, "ｘ", "ok"), (2, None, "​"), (3, "", None), (4, "fi" * 40_000, "ﬁ" * 40_000)], "article_id long, title string, body string")
    assert sorted(map(tuple, found(df).collect())) == [(1, "title"), (2, "body"), (4, "body")]
    assert found(df.limit(0)).count() == 0


def test_extra_columns_pass_and_clashes_fail(spark):
    df = spark.createDataFrame([("ｘ", 1, "q")], "t string, c0 int, `a b` string")
    assert tuple(consistent_form(df, ["t"], flags=True).first()) == ("x", 1, "q", True)
    with pytest.raises(ValueError):
        consistent_form(df.withColumn("t_off", F.lit(1)), ["t"], flags=True)


def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(200):
        source = "hot" if i < 120 else "b" if i < 190 else None
        own = [f"texto {''.join(rng.choices('abcdefgh', k=12))} número {i}" for _ in range(3)]
        plate = [] if i % 3 else ["Compartí  esta NOTA", "", f"Hay {rng.randrange(10**6):,} comentarios"]
        body = "\n".join(own[:2] + plate + own[2:] + (["рie  de página" if i % 2 else "pie de página"] if i < 6 else []))
        rows.append((i, source, None if i == 5 else "" if i == 7 else body))
    return rows + rows[:9]


def brute(rows):
    import re

    art = {i: (s, b) for i, s, b in rows}
    total, has = {}, {}
    keys = {}
    for i, (s, b) in art.items():
        total[s] = total.get(s, 0) + 1
        keys[i] = [re.sub(r"\s", "", re.sub(r"\d[\d.,]*", "0", x.replace("рie", "pie").lower())) for x in b.split("\n")] if b is not None else []
        for k in set(keys[i]) - {""}:
            has.setdefault((s, k), set()).add(i)
    often = {x for x, a in has.items() if len(a) >= 5 and len(a) >= 0.05 * total[x[0]]}
    return {(i, n + 1) for i, ks in keys.items() for n, k in enumerate(ks) if (art[i][0], k) in often}


def test_lines_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "article_id long, source string, body string")
    got = [tuple(r) for r in lines.found(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows) and got


def test_blocks_and_removal(spark):
    df = spark.createDataFrame(corpus(), "article_id long, source string, body string")
    rows = lines.prepared(df, True).cache()
    plate = lines.boilerplate(lines.line_keys(rows)).cache()
    # the two lines of the plate follow each other (over the blank one): one block a source
    blocks = {tuple(sorted(r.n for r in plate.where(F.col("source").eqNullSafe(s)).groupBy("block").agg(F.count("key").alias("n")).collect())) for s in ("hot", "b")}
    assert blocks == {(2,)}
    left = {r.article_id: r.body for r in lines.without_boilerplate(rows, plate).collect()}
    assert "nota" not in left[3].lower() and "comentarios" not in left[3] and left[3].count("texto") == 3
    assert left[5] is None and left[7] == ""


def test_no_lines(spark):
    df = spark.createDataFrame([], "article_id long, source string, body string")
    assert lines.found(df).count() == 0
    assert lines.found(spark.createDataFrame([(1, "a", None), (2, None, "x")], df.schema)).count() == 0
