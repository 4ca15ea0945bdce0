import random

import pytest

from kuatia.llm import mix, split, tokens

rng = random.Random(6)
WORDS = ["la", "Casa", "ñandú", "agua,", "río.", "123", "‘x’", "日本語", "á", "👨‍👩‍👧", "\n\n", "  ", "<|endoftext|>", "it's", "\t"]
TEXTS = [None, "", " ", "\n\n\n", "a", "<|endoftext|>", "x" * 5000, "ñ" * 3000, "日本語" * 800, "a b " * 9000, "\n" * 700, "?!" * 900] + [" ".join(rng.choices(WORDS, k=rng.randrange(1, 900))) for _ in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")], "doc_id long, text string, ids string").cache()


def test_encoding_is_the_tokenizers(spark, docs, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_CHARS", 2000)
    got = sorted((r.doc_id, r.ids) for r in tokens.encode_corpus(docs, "doc_id", "text").collect())
    encode = tokens.encoding().encode_ordinary
    assert got == sorted((r.doc_id, encode(r.text) if r.text else []) for r in docs.collect())


def test_round_trip(spark, docs):
    back = tokens.decode_corpus(tokens.encode_corpus(docs, "doc_id", "text"), "doc_id", "ids")
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_no_texts(spark, docs):
    assert tokens.encode_corpus(docs.limit(0), "doc_id", "text").count() == 0
    assert split.split_texts(docs.limit(0), "doc_id", "text", [("p", 9, 1)]).count() == 0


@pytest.mark.parametrize("limit,overlap", [(7, 0), (20, 5), (128, 16), (40, 39), (2, 1)])
def test_pieces(limit, overlap):
    cutter, encode = split.Cutter(smallest=limit), tokens.encoding().encode_ordinary
    for text in TEXTS:
        whole = len(encode(text)) if text else 0
        pieces = cutter.pieces(text, limit, overlap)
        assert bool(pieces) == (whole > limit)
        end = 0
        for a, b, n in pieces:
            assert a <= end < b and n == len(encode(text[a:b]))
            # one character may take more tokens than a tiny limit
            assert n <= limit or b - end == 1 or limit < 4
            end = b
        assert not pieces or end == len(text)


def test_pieces_end_at_natural_places():
    text = "Una frase con varias palabras. Otra frase más larga que la primera, con coma.\n" * 30
    cutter = split.Cutter()
    pieces = cutter.pieces(text, 60, 10)
    assert all(text[b - 1] in ".\n" for _, b, _ in pieces)
    encode = tokens.encoding().encode_ordinary
    shared = [len(encode(text[c:b])) for (_, b, _), (c, _, _) in zip(pieces, pieces[1:])]
    assert all(9 <= n <= 16 for n in shared)
    with pytest.raises(ValueError):
        cutter.pieces(text, 10, 10)


def test_split_profiles(spark, docs):
    limits = spark.createDataFrame([("b", 50, 5), ("a", 500, 0), (None, 1, 0)], "profile string, max_tokens int, overlap_tokens int")
    rows = split.split_texts(docs, "doc_id", "text", split.profiles_of(limits)).collect()
    assert {r.profile for r in rows} == {"a", "b"}
    assert all(r.text == TEXTS[r.doc_id][r.start_char : r.end_char] for r in rows)


def test_mix(spark):
    r = random.Random(1)
    rows = [(i, ("hot", "mid", "small", None, "other")[i % 7 % 5], " ".join(["palabra"] * r.randrange(1, 60))) for i in range(3000)] + [(9001, "hot", None), (9002, "mid", "")]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("hot", 0.5, 1), ("mid", 0.2, 2), ("small", 0.3, 3), ("absent", 0.0, 2), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    sizes = mix.sized(docs, targets)
    mixed = mix.mix(sizes, targets).cache()
    report = {x.source: x for x in mix.shares(sizes, targets, mixed).collect()}
    for source, share, cap in (("hot", 0.5, 1), ("mid", 0.2, 2), ("small", 0.3, 3)):
        assert abs(report[source].actual_share - share) < 0.01
        assert report[source].most_repeats <= cap
    assert report["gone"].actual_share == 0 and report["gone"].documents_used == 0
    again = {(x.doc_id, x.source): x.copies for x in mix.mix(sizes, targets).collect()}
    assert again == {(x.doc_id, x.source): x.copies for x in mixed.collect()}
    assert not {x.source for x in mixed.collect()} - {"hot", "mid", "small"}


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    sizes = mix.sized(docs, targets)
    mixed = mix.mix(sizes, targets)
    assert mixed.count() == 0
    assert [x.actual_share for x in mix.shares(sizes, targets, mixed).collect()] == [0.0]
