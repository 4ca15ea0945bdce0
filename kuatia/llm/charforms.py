"""One consistent form for text that looks the same but differs in its characters (problem 4).

The rules live in SQL that DuckDB runs over each Arrow batch inside the Spark
task: ``translate`` for one-to-one forms, ``regexp_replace`` for invisible
characters and spaces, ``nfc_normalize`` for base and mark, and a word-wise
``translate`` for look-alike letters of another script.

Results by case: null stays null; an empty text stays empty; typographic quotes
and dashes, ordinal and superscript signs, emoji with their joiners, letters
without a one-character form, words wholly in another script and line ends stay
as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Letters of other scripts and the Latin letters they look like.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "к": "k", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѵ": "v", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ё": "ë", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "υ": "u", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "ό": "ó", "ά": "á", "ί": "í", "έ": "é",
}

#: Stand for joiners and selectors that must stay while the other invisible characters are removed.
_KEPT = {"\u200d": "\U0010fffd", "\u200c": "\U0010fffc"}
_KEPT_SELECTOR = "\U0010fffb"
_EMOJI = r"\x{203C}\x{2049}\x{20E3}\x{2122}\x{2139}\x{2190}-\x{21FF}\x{2300}-\x{23FF}\x{2460}-\x{24FF}\x{25A0}-\x{27BF}\x{2900}-\x{297F}\x{2B00}-\x{2BFF}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F000}-\x{1FAFF}"
_JOINING = r"\p{Arabic}\p{Devanagari}\p{Bengali}\p{Gujarati}\p{Gurmukhi}\p{Kannada}\p{Malayalam}\p{Oriya}\p{Sinhala}\p{Tamil}\p{Telugu}\p{Khmer}\p{Mongolian}\p{Syriac}"
_INVISIBLE = r"\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{1D173}-\x{1D17A}\x{E0100}-\x{E01EF}"
_SPACES = r"\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
_OTHER = r"[^\P{L}\p{Latin}\p{Common}\p{Inherited}]"
_WORD = r"[\p{L}\p{M}]"
#: A text without any of these is in its form already.
_SUSPECT = r"[\x{00A0}\x{00AD}\x{0132}\x{0133}\x{0149}\x{017F}\x{01C4}-\x{01CC}\x{01F1}-\x{01F3}\x{0250}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{2069}\x{206A}-\x{209F}\x{20D0}-\x{10FFFF}]"


def _one_to_one() -> tuple[str, str]:
    """Wide, half-width and mathematical letter forms and what they stand for, by Unicode's own decompositions."""
    source, target = [], []
    for low, high in ((0xFF01, 0xFFEE), (0x1D400, 0x1D7FF)):
        for code in range(low, high + 1):
            plain = unicodedata.normalize("NFKC", chr(code))
            if unicodedata.decomposition(chr(code)).startswith(("<wide>", "<narrow>", "<font>")) and len(plain) == 1 and plain != " ":
                source.append(chr(code))
                target.append(plain)
    return "".join(source), "".join(target)


def _joined() -> list[tuple[str, str]]:
    """Ligatures and digraphs and their letters, by Unicode's own decompositions."""
    codes = [*range(0xFB00, 0xFB07), 0x132, 0x133, 0x149, 0x17F, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4)]
    return [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in codes]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spelled(column: str) -> tuple[str, str]:
    """Two DuckDB expressions, the second over the first's result: without invisible characters and odd spaces; without wide and joined forms, composed."""
    wide_from, wide_to = _one_to_one()
    x = column
    for _ in range(2):  # neighbouring joiners share an emoji, so a second pass takes those left over
        for mark, kept in _KEPT.items():
            x = rf"regexp_replace({x}, '([{_EMOJI}{_JOINING}\x{{FE0F}}]){mark}([{_EMOJI}{_JOINING}])', '\1{kept}\2', 'g')"
    # a presentation selector stays behind an emoji and inside a key cap
    x = rf"regexp_replace({x}, '([{_EMOJI}])\x{{FE0F}}', '\1{_KEPT_SELECTOR}', 'g')"
    x = rf"regexp_replace({x}, '([0-9#*])\x{{FE0F}}\x{{20E3}}', '\1{_KEPT_SELECTOR}' || chr(8419), 'g')"
    x = f"regexp_replace({x}, '[{_INVISIBLE}]', '', 'g')"
    x = f"translate({x}, '{''.join(_KEPT.values())}{_KEPT_SELECTOR}', '{''.join(_KEPT)}' || chr(65039))"
    # the costly steps run only on texts that have such characters
    x = f"CASE WHEN NOT regexp_matches({column}, '[{_INVISIBLE}]') THEN {column} ELSE {x} END"
    x = f"regexp_replace({x}, '[{_SPACES}]', ' ', 'g')"
    joined = f"translate({column}, {_quoted(wide_from)}, {_quoted(wide_to)})"
    for ligature, letters in _joined():
        joined = f"replace({joined}, '{ligature}', {_quoted(letters)})"
    signs = "".join(ligature for ligature, _ in _joined())
    return x, f"nfc_normalize(CASE WHEN regexp_matches({column}, '[{signs}{_ranges(wide_from)}]') THEN {joined} ELSE {column} END)"


def _ranges(signs: str) -> str:
    """The characters from the first to the last of each of the two blocks of wide and mathematical forms."""
    low = [c for c in signs if ord(c) < 0x10000]
    high = [c for c in signs if ord(c) >= 0x10000]
    return f"{low[0]}-{low[-1]}{high[0]}-{high[-1]}"


def _latin_words(column: str) -> str:
    """DuckDB expression: look-alike letters within a word that has Latin letters become Latin."""
    source, target = "".join(LOOK_ALIKES), "".join(LOOK_ALIKES.values())
    word = rf"CASE WHEN regexp_matches(w, '\p{{Latin}}') AND regexp_matches(w, '{_OTHER}') THEN translate(w, '{source}', '{target}') ELSE w END"
    words = f"regexp_extract_all({column}, '{_WORD}+|[^\\p{{L}}\\p{{M}}]+')"
    return f"CASE WHEN {mixed_sql(column)} THEN nfc_normalize(array_to_string(list_transform({words}, lambda w: {word}), '')) ELSE {column} END"


def mixed_sql(column: str) -> str:
    """DuckDB predicate: some word has Latin letters and letters of another script."""
    return rf"regexp_matches({column}, '\p{{Latin}}{_WORD}*{_OTHER}|{_OTHER}{_WORD}*\p{{Latin}}')"


def duck():
    """A DuckDB connection that keeps to the one core and the small memory of a Spark task."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 1; SET memory_limit = '400MB'; SET preserve_insertion_order = true")
    return con


def clean_batch(con, batch: pa.RecordBatch | pa.Table, columns: list[str], flags: bool = False) -> pa.Table:
    """The batch with each column in its form; with flags also ``<column>_off``: it was not in that form before."""
    rows = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    work = pa.table({f"c{i}": rows[c] for i, c in enumerate(columns)})
    con.register("kuatia_rows", work)
    n = range(len(columns))
    suspect = ", ".join(f"c{i}, regexp_matches(c{i}, '{_SUSPECT}') AS s{i}" for i in n)
    visible = ", ".join(f"c{i}, s{i}, CASE WHEN s{i} THEN {_spelled(f'c{i}')[0]} ELSE c{i} END AS x{i}" for i in n)
    spelled = ", ".join(f"c{i}, s{i}, CASE WHEN s{i} THEN {_spelled(f'x{i}')[1]} ELSE c{i} END AS y{i}" for i in n)
    latin = ", ".join(f"CASE WHEN s{i} THEN {_latin_words(f'y{i}')} ELSE c{i} END AS z{i}, c{i}, s{i}" for i in n)
    final = ", ".join(f"z{i}, coalesce(CASE WHEN s{i} THEN z{i} IS DISTINCT FROM c{i} OR {mixed_sql(f'c{i}')} ELSE false END, false) AS o{i}" if flags else f"z{i}" for i in n)
    out = con.sql(f"SELECT {final} FROM (SELECT {latin} FROM (SELECT {spelled} FROM (SELECT {visible} FROM (SELECT {suspect} FROM kuatia_rows))))").to_arrow_table()
    con.unregister("kuatia_rows")
    for i, c in enumerate(columns):
        rows = rows.set_column(rows.schema.get_field_index(c), c, out[f"z{i}"])
    for i, c in enumerate(columns if flags else []):
        rows = rows.append_column(f"{c}_off", out[f"o{i}"])
    return rows


def consistent_form(df: DataFrame, columns: list[str], flags: bool = False) -> DataFrame:
    """df with the text columns in their consistent form.

    Null stays null. With flags=True each column c also gets ``c_off BOOLEAN``,
    true where the text held a character that had to change. Other columns pass
    through, whatever their names; an existing ``c_off`` is an error.
    """
    fields = list(df.schema.fields)
    if flags:
        taken = {f.name for f in fields} & {f"{c}_off" for c in columns}
        if taken:
            raise ValueError(f"columns exist already: {sorted(taken)}")
        fields += [T.StructField(f"{c}_off", T.BooleanType()) for c in columns]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duck()
        for batch in batches:
            if batch.num_rows:
                out = clean_batch(con, batch, columns, flags)
                yield from out.select([f.name for f in schema.fields]).to_batches()

    return df.mapInArrow(run, schema)


def found(articles: DataFrame) -> DataFrame:
    """(article_id, field) of every title and body that was not in its consistent form."""
    from pyspark.sql import functions as F

    flagged = consistent_form(articles.select("article_id", "title", "body"), ["title", "body"], flags=True)
    return (
        flagged.select("article_id", F.expr("filter(array(if(title_off, 'title', null), if(body_off, 'body', null)), x -> x is not null)").alias("fields"))
        .select("article_id", F.explode("fields").alias("field"))
        .distinct()
    )
