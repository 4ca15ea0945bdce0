from datetime import datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from kuatia.functions.timestamps import choose, instants, interpretations, viterbi


def us(*a, zone="UTC", micros=0):
    return int(datetime(*a, tzinfo=ZoneInfo(zone)).timestamp()) * 1_000_000 + micros


CASES = [
    ("2024-05-01T10:00:00-04:00", us(2024, 5, 1, 14)),
    ("20240501T100000Z", us(2024, 5, 1, 10)),
    ("1714557600", us(2024, 5, 1, 10)),
    ("1714557600000", us(2024, 5, 1, 10)),
    ("1714557600000123", us(2024, 5, 1, 10, micros=123)),
    ("Wed, 01 May 2024 10:00:00 EDT", us(2024, 5, 1, 14)),
    ("1 de mayo de 2024, 10:00", us(2024, 5, 1, 14)),
    ("miércoles 1 de mayo de 2024 a las 10:00", us(2024, 5, 1, 14)),
    ("Mayo 1, 2024 12:05 a. m.", us(2024, 5, 1, 4, 5)),
    ("01/05/2024 12:05 p. m.", us(2024, 5, 1, 16, 5)),
    ("Publicado: 01-05-2024 10:00 hs", us(2024, 5, 1, 14)),
    ("2024-05-01 10:00:00 Europe/Madrid", us(2024, 5, 1, 8)),
    ("2024-05-01T10:00:00.1234560[America/New_York]", us(2024, 5, 1, 14, micros=123456)),
    ("2025-07-01 12:00", us(2025, 7, 1, 15)),  # UTC-3 all year since October 2024
    ("2024-03-23 23:30", us(2024, 3, 24, 2, 30)),  # occurs twice: the first
    ("2024-10-06 00:30", us(2024, 10, 6, 4, 30)),  # skipped: the offset before the change
    ("\t 2024-05-01T10:00Z ​", us(2024, 5, 1, 10)),
]
NONE = [None, "", "   ", "ayer", "hace 3 horas", "2024-05-01", "1 de mayo de 2024", "31/02/2024 10:15", "2024-13-04T10:00:00Z", "2024-05-01 24:10", "25:61", "0000-00-00 00:00:00", "2024-05-01T10:00:60Z", "13/05/2024 13:00 p. m."]


def test_forms(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES] + [(t,) for t in NONE], "t string")
    got = {r.t: r.i for r in df.select("t", interpretations(F.col("t")).alias("i")).collect()}
    for text, want in CASES:
        assert [x.utc_us for x in got[text]] == [want], text
    for text in NONE:
        assert got[text] == [], text


def test_two_digit_years_are_decided_by_order(spark):
    # "05-06-07": the year first or last; the neighbours tell
    rows = [("s", 1, "2005-06-06 10:00Z"), ("s", 2, "05-06-07 10:00Z"), ("s", 3, "2005-06-08 10:00Z"), ("r", 1, "05/06/2007 09:00Z"), ("r", 2, "05-06-07 10:00Z"), ("r", 3, "06/06/2007 09:00Z"), (None, 1, None)]
    df = spark.createDataFrame(rows, "s string, n int, t string")
    got = {(r.s, r.n): r.u for r in instants(df, "t", "s", ["n"], "u").collect()}
    assert got["s", 2] == us(2005, 6, 7, 10)
    assert got["r", 2] == us(2007, 6, 5, 10)
    assert got[None, 1] is None
    assert len(got) == len(rows)


def test_choose_is_viterbi_over_each_source(spark):
    import random

    rng = random.Random(3)
    data = [(s, i, [("a" if rng.random() < 0.5 else "b", rng.randrange(10**12)) for _ in range(rng.choice([0, 1, 1, 2, 3]))]) for s in ("x", "y") for i in range(60)]
    df = spark.createDataFrame([(s, i, [{"format": f, "utc_us": u} for f, u in c]) for s, i, c in data], "s string, i int, c array<struct<format:string,utc_us:bigint>>")
    got = {(r.s, r.i): r.u for r in choose(df, "s", ["i"], "c", "u").collect()}
    for s in ("x", "y"):
        part = [(i, c) for t, i, c in data if t == s and c]
        for (i, c), k in zip(part, viterbi([c for _, c in part])):
            assert got[s, i] == c[k][1]
    assert all(got[s, i] is None for s, i, c in data if not c)


def test_clashing_name(spark):
    with pytest.raises(ValueError):
        instants(spark.createDataFrame([("x", 1)], "t string, u int"), "t", "t", ["u"], "u")


def test_empty(spark):
    assert instants(spark.createDataFrame([], "t string, s string, n int"), "t", "s", ["n"], "u").count() == 0



