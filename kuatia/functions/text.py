"""Text functions as column expressions; null in, null out unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Authors that name no one, categories and their standard names, words left out of title tokens.
GENERIC_AUTHORS = ["", "redacción", "redaccion", "redacción web", "redaccion web", "equipo editorial", "staff", "administrador", "admin"]
CATEGORIES = {
    "politica": "Política", "política": "Política", "economia": "Economía", "economía": "Economía", "sociedad": "Sociedad", "seguridad": "Seguridad",
    "judiciales": "Justicia", "justicia": "Justicia", "internacionales": "Internacional", "internacional": "Internacional", "deportes": "Deportes",
    "tecnologia": "Tecnología", "tecnología": "Tecnología", "cultura": "Cultura", "salud": "Salud", "educacion": "Educación", "educación": "Educación",
    "opinion": "Opinión", "opinión": "Opinión", "nacionales": "Nacionales", "actualidad": "Actualidad", "pais": "País", "país": "País",
}
STOP_WORDS = ["de", "la", "el", "en", "y", "a", "por", "para", "del", "los", "las", "un", "una", "con", "que", "al", "se", "su", "the", "and", "of", "to", "in", "on"]
#: The half-open similarity bands, best first.
BANDS = [("very_high", 0.95, 1.00001), ("high", 0.90, 0.95), ("middle", 0.85, 0.90), ("low", 0.80, 0.85), ("very_low", 0.78, 0.80)]


def clean_text(text: Column) -> Column:
    """White space of any kind collapsed to single spaces, none at the ends; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " ")), F.lit(""))


def normalize_author(author: Column) -> Column:
    cleaned = clean_text(author)
    return F.when(~F.lower(cleaned).isin(GENERIC_AUTHORS), cleaned)


def normalize_language(language: Column) -> Column:
    """Spanish where unknown; a code of Spanish or Guaraní by its first letters, any other by its first ten."""
    code = F.replace(F.lower(clean_text(language)), F.lit("_"), F.lit("-"))
    return F.when(code.isNull() | code.startswith("es"), "es").when(code.startswith("gn"), "gn").otherwise(F.left(code, F.lit(10)))


def normalize_category(category: Column) -> Column:
    cleaned = clean_text(category)
    names = F.create_map(*(F.lit(x) for pair in CATEGORIES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.lower(cleaned)), cleaned)


def title_tokens(title: Column) -> Column:
    """Distinct lower-case runs of letters and digits of three characters or more that are no stop words; empty for null."""
    words = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(STOP_WORDS)))


def completeness(title: Column, body: Column, image: Column) -> Column:
    """0.70 by body length up to 4000 characters, 0.15 for a title of 20 or more, 0.15 for an image."""
    length = F.coalesce(F.length(F.trim(body)), F.lit(0))
    return (
        F.lit(0.70) * F.least(length / F.lit(4000.0), F.lit(1.0))
        + F.when(F.coalesce(F.length(F.trim(title)), F.lit(0)) >= 20, 0.15).otherwise(0.0)
        + F.when(F.coalesce(image, F.lit("")) != "", 0.15).otherwise(0.0)
    )


def similarity_band(similarity: Column, bands: list[tuple[str, float, float]] = BANDS) -> Column:
    out = F.lit(None).cast("string")
    for name, low, high in reversed(bands):
        out = F.when((similarity >= low) & (similarity < high), name).otherwise(out)
    return out


def display_time(time: Column) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd HH:mm"), F.lit("Sin fecha"))


def embedding_text(title: Column, body: Column) -> Column:
    return F.concat(F.lit("Título: "), F.coalesce(title, F.lit("")), F.lit("\n\nArtículo:\n"), F.coalesce(body, F.lit("")))


def ner_text(title: Column, body: Column) -> Column:
    return F.regexp_replace(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


@F.pandas_udf(T.StringType())
def entity_form(text: pd.Series) -> pd.Series:
    """Compatibility form, lower case, white space collapsed and none before punctuation; accents stay."""
    plain = text.str.normalize("NFKC").str.lower().str.replace(r"\s+", " ", regex=True).str.strip()
    return plain.str.replace(r"\s+([.,;:])", r"\1", regex=True)


@F.pandas_udf(T.StringType())
def entity_form_without_accents(text: pd.Series) -> pd.Series:
    """As entity_form, but without combining marks."""
    return text.map(lambda x: None if x is None else " ".join("".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower().split()))


def entities(text: Column) -> Column:
    """ARRAY<STRUCT<name, kind>>: capitalised words as stand-ins for a recogniser's output, of kind PER, ORG or LOC by length."""
    names = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\p{Lu}[\p{L}]+"), F.lit(0)))
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.element_at(F.array(F.lit("PER"), F.lit("ORG"), F.lit("LOC")), F.length(n) % 3 + 1).alias("kind")))


def article_hash(author: Column, title: Column, body: Column) -> Column:
    """SHA-256 of the compact JSON of author, body and title, keys in order, nulls kept."""
    return F.sha2(F.to_json(F.struct(author.alias("author"), body.alias("body"), title.alias("title")), {"ignoreNullFields": "false"}), 256)


def embedding_text_within(title: Column, body: Column, budget: int) -> Column:
    """The text of an embedding within a budget of words: the title's part whole, then as many of the body's words as are left."""
    head = F.concat(F.lit("Título: "), F.coalesce(title, F.lit("")), F.lit("\n\nArtículo:\n"))
    used = F.size(F.filter(F.split(F.concat(F.lit("Título: "), F.coalesce(title, F.lit("")), F.lit(" Artículo:")), r"[\s\p{Z}]+"), lambda w: w != ""))
    words = F.split(F.trim(F.regexp_replace(F.coalesce(body, F.lit("")), r"[\s\p{Z}]+", " ")), " ")
    return F.concat(head, F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(0), F.lit(budget) - used)), " "))


def best_mentions(rows: DataFrame) -> DataFrame:
    """(article_id, norm, kind, name, confidence): of an article's mentions of one normal form and kind, the most confident; ties go to the greater spelling.

    rows: (article_id, name, norm, kind, confidence), a recogniser's output.
    """
    best = F.max_by(F.struct("name", "confidence"), F.struct("confidence", "name"))
    return rows.groupBy("article_id", "norm", "kind").agg(best.alias("b")).select("article_id", "norm", "kind", "b.confidence", "b.name")


@F.pandas_udf(T.StringType())
def entity_form_plain(text: pd.Series) -> pd.Series:
    """As entity_form, without the rule on white space before punctuation."""
    return text.str.normalize("NFKC").str.lower().str.replace(r"\s+", " ", regex=True).str.strip()
