"""URL functions and the one predicate that tells article pages by the shape of their path."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: endings of files that are no pages.
FILES = r"\.(?:jpg|jpeg|png|gif|webp|svg|pdf|mp3|mp4|xml|css|js|zip)$"


def normalize_url(url: Column) -> Column:
    """Trimmed and without its fragment; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.trim(url), "#.*$", "")), F.lit(""))


def clean_url(url: Column, slash: str = "strip") -> Column:
    """Without query and fragment, host in lower case; slash: strip, force or keep one at the end."""
    bare = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    host = F.regexp_extract(bare, r"^([A-Za-z]+://[^/]*)", 1)
    out = F.concat(F.lower(host), F.substring(bare, F.length(host) + 1, F.lit(1 << 20)))
    if slash == "strip":
        return F.regexp_replace(out, "/+$", "")
    return F.concat(F.regexp_replace(out, "/+$", ""), F.lit("/")) if slash == "force" else out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/:?#]*)", 1))


def path_parts(url: Column) -> Column:
    """The path's parts without empty ones."""
    path = F.regexp_extract(clean_url(url), r"^[A-Za-z]+://[^/]*(.*)$", 1)
    return F.filter(F.split(path, "/"), lambda p: p != "")


def section_of(url: Column, place: int = 1) -> Column:
    """The path's part at a place from 1, or from the end if negative; ``general`` where there is none."""
    return F.coalesce(F.try_element_at(path_parts(url), F.lit(place)), F.lit("general"))


def date_of(url: Column, first: int = 1) -> Column:
    """The date of year, month and day at that place of the path; null if they are none."""
    return _date(path_parts(url), first)


def _date(parts: Column, first: int) -> Column:
    text = F.concat_ws("-", *(F.try_element_at(parts, F.lit(first + i)) for i in range(3)))
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))


def iso_date(text: Column) -> Column:
    """The date in a text's first ten characters; null if they are none."""
    head = F.left(text, F.lit(10))
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(head, "yyyy-MM-dd"))


def image_url(image: Column, base: Column) -> Column:
    """Absolute form of an image's address: as it is, of the page's scheme, or from the page's root or folder."""
    image = F.nullif(F.trim(image), F.lit(""))
    root = F.regexp_extract(base, r"^([A-Za-z]+://[^/]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"[^/]*$", "")
    relative = F.when(image.rlike(r"(?:^|/)\.\.?(?:/|$)"), joined(base, image)).otherwise(F.concat(folder, image))
    return F.when(image.startswith("//"), F.concat(F.lit("https:"), image)).when(image.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), image).when(image.startswith("/"), F.concat(root, image)).otherwise(relative)


@F.pandas_udf(T.StringType())
def joined(base: pd.Series, address: pd.Series) -> pd.Series:
    """The address against its base by the general rules, dot segments included."""
    from urllib.parse import urljoin

    return pd.Series([None if b is None or a is None else urljoin(b, a) for b, a in zip(base, address)], dtype="object")


@dataclass(frozen=True)
class Shape:
    """What an outlet's article pages look like.

    fixed: first path parts that must be these; dated_at: place of year/month/day
    (from 1), calendar: they must be a real date; slug is the last part.
    """

    hosts: tuple[str, ...] = ()
    min_parts: int = 1
    max_parts: int = 99
    fixed: tuple[str, ...] = ()
    first_in: tuple[str, ...] = ()
    dated_at: int | None = None
    calendar: bool = False
    min_slug: int = 1
    hyphen: bool = False
    not_numeric: bool = True
    not_a_date: bool = False
    ending: str | None = None
    excluded_first: tuple[str, ...] = field(default=())
    excluded_slug: tuple[str, ...] = field(default=())
    no_dot: bool = False
    slug_at: int = -1  # where the slug is, from the end
    numbered_page: bool = False  # the last part is a number with the ending .html
    numbered_first: bool = False  # the first part is a number


#: The recurring shapes of news sites.
SHAPES = {
    "root-slug": Shape(max_parts=1, min_slug=10, hyphen=True, not_a_date=True),
    "root-page": Shape(max_parts=1, min_slug=8, hyphen=True, ending=".html"),
    "section-slug": Shape(min_parts=2, max_parts=2, min_slug=8, hyphen=True),
    "dated-slug": Shape(min_parts=4, max_parts=4, dated_at=1, calendar=True, min_slug=6),
    "section-dated-slug": Shape(min_parts=5, max_parts=5, dated_at=2, min_slug=8, hyphen=True),
    "article-slug": Shape(min_parts=2, max_parts=2, fixed=("article",)),
}


def is_article_url(url: Column, shape: Shape) -> Column:
    """Whether the address has the shape; false for null."""
    fits = path_fits(path_parts(url), shape)
    return F.coalesce(host_of(url).isin(list(shape.hosts)), F.lit(False)) & fits if shape.hosts else fits


def path_fits(parts: Column, shape: Shape) -> Column:
    """Whether a path of these parts has the shape, whatever the host; false for null."""
    n = F.size(parts)
    slug = F.coalesce(F.try_element_at(parts, F.lit(shape.slug_at)), F.lit(""))
    stem = F.regexp_replace(slug, r"\.html?$", "") if shape.ending else slug
    tests = [n.between(shape.min_parts, shape.max_parts), F.length(stem) >= shape.min_slug, ~F.lower(slug).rlike(FILES)]
    if shape.no_dot:
        tests.append(~slug.contains("."))
    if shape.numbered_page:
        tests.append(F.try_element_at(parts, F.lit(-1)).rlike(r"^\d+\.html$"))
    if shape.numbered_first:
        tests.append(F.try_element_at(parts, F.lit(1)).rlike(r"^\d+$"))
    tests += [F.try_element_at(parts, F.lit(i + 1)) == x for i, x in enumerate(shape.fixed)]
    if shape.first_in:
        tests.append(F.try_element_at(parts, F.lit(1)).isin(list(shape.first_in)))
    if shape.dated_at is not None:
        if shape.calendar:
            tests.append(_date(parts, shape.dated_at).isNotNull())
        else:
            year, month, day = (F.try_element_at(parts, F.lit(shape.dated_at + i)).try_cast("int") for i in range(3))
            tests.append(year.between(2000, 2100) & month.between(1, 12) & day.between(1, 31))
    if shape.hyphen:
        tests.append(stem.contains("-"))
    if shape.not_numeric:
        tests.append(~stem.rlike(r"^\d+$"))
    if shape.not_a_date:
        tests.append(~stem.rlike(r"^\d{1,4}-\d{1,2}-\d{1,4}$"))
    if shape.ending:
        tests.append(slug.endswith(shape.ending))
    if shape.excluded_first:
        tests.append(~F.try_element_at(parts, F.lit(1)).isin(list(shape.excluded_first)))
    if shape.excluded_slug:
        tests.append(~stem.isin(list(shape.excluded_slug)))
    out = F.lit(True)
    for test in tests:
        out = out & F.coalesce(test, F.lit(False))
    return out
