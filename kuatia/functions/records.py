"""Records as extractors give them, brought to one row form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kuatia.functions import text, urls


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def normalized_record(raw: Column, address: Column, fields: tuple[str, ...], category: Column | None = None) -> Column:
    """STRUCT<url, canonical_url, title, author, published_text, body, language, image_url, category> of a raw struct.

    ``fields`` are those that raw has; a missing one counts as null. Chains: text
    then body, date then published_at, url then canonical_url then the address
    asked for, image then image_url; an empty value falls through. The given
    category comes before the record's own.
    """
    def of(name: str) -> Column:
        return raw[name] if name in fields else F.lit(None).cast("string")

    asked = urls.normalize_url(address)
    canonical = urls.normalize_url(first_filled(of("url"), of("canonical_url"), asked))
    image = first_filled(of("image"), of("image_url"))
    own = of("category") if category is None else first_filled(category, of("category"))
    return F.struct(
        asked.alias("url"), canonical.alias("canonical_url"), text.clean_text(of("title")).alias("title"), text.normalize_author(of("author")).alias("author"), first_filled(of("date"), of("published_at")).alias("published_text"),
        text.clean_text(first_filled(of("text"), of("body"))).alias("body"), text.normalize_language(of("language")).alias("language"), urls.image_url(image, F.coalesce(canonical, asked)).alias("image_url"), text.normalize_category(own).alias("category"),
    )
