"""The registry of outlets: for each the hosts, the shape of its article pages and how titles of repeated links are merged.

An outlet is a row of parameters for one predicate (``urls.is_article_url``), not
code of its own. Paths that are no articles come in two lists that every outlet of
a family shares; an installation passes its own lists where it knows better.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kuatia.functions.urls import Shape, clean_url, host_of, path_fits, path_parts

# First path parts of archives and of a site's machinery, and pages that are no articles.
SYSTEM_PARTS = ("category", "categoria", "author", "autor", "tag", "page", "feed", "wp-admin", "wp-content", "wp-includes", "wp-json", "seccion", "etiqueta", "search", "buscar", "login", "registro")
STATIC_PAGES = (
    "inicio", "home", "contacto", "contactenos", "nosotros", "quienes-somos", "publicidad", "ayuda", "aviso-legal", "radio", "tv", "archivo", "archivos", "newsletters", "terminos-de-uso",
    "politica-de-privacidad", "terminos-y-condiciones", "anuncie-con-nosotros", "trabaja-con-nosotros", "contacto-prensa", "pagina-de-inicio", "prueba-inicio",
)
# The sections of the one outlet that lists them.
LISTED_SECTIONS = ("actualidad", "deportes", "fama", "mundo", "viral", "denuncia", "consultorio-del-amor")


@dataclass(frozen=True)
class Outlet:
    name: str
    shape: Shape
    #: longest, last, first: which title of repeated links to one address is kept.
    titles: str = "longest"
    #: Titles below this length are none.
    min_title: int = 0
    slash: str = "strip"


def hosts(domain: str) -> tuple[str, ...]:
    return domain, "www." + domain


def _family(shape: Shape, outlets: dict[str, str], **rest) -> list[Outlet]:
    return [Outlet(name, replace(shape, hosts=tuple(h for d in domains.split() for h in hosts(d))), **rest) for name, domains in outlets.items()]


def registry(system: tuple[str, ...] = SYSTEM_PARTS, static: tuple[str, ...] = STATIC_PAGES) -> dict[str, Outlet]:
    """The outlets by name; ``system`` and ``static`` are the paths that are no articles."""
    root = Shape(max_parts=1, hyphen=True, not_a_date=True, excluded_first=system, excluded_slug=static)
    page = Shape(max_parts=1, hyphen=True, ending=".html", min_slug=8)
    dated = Shape(min_parts=4, max_parts=4, dated_at=1, calendar=True)
    section = Shape(min_parts=5, max_parts=5, dated_at=2, hyphen=True, excluded_first=system)
    out = [
        *_family(replace(root, min_slug=10), {
            "ahoracde": "ahoracde.com", "concepcionaldia": "concepcionaldia.com", "itapuanoticias": "itapuanoticias.tv", "noticiascde": "noticiascde.com.py", "oviedopress": "oviedopress.com",
            "pedrojuandigital": "pedrojuandigital.com.py", "primeraplana": "diarioprimeraplana.com", "sanlorenzohoy": "sanlorenzohoy.com",
        }),
        *_family(replace(root, min_slug=12), {"elobservador": "observador.com.py"}),
        *_family(root, {"adn": "adndigital.com.py", "megacadena": "megacadena.com.py"}, titles="first"),
        *_family(replace(root, hyphen=False, not_numeric=False), {"elindependiente": "independiente.com.py"}, titles="first"),
        *_family(replace(root, min_slug=10, no_dot=True, not_a_date=False), {"ultimahora": "ultimahora.com"}, titles="last"),
        *_family(replace(root, min_slug=20, no_dot=True, not_a_date=False), {"nanduti": "nanduti.com.py"}, titles="last", min_title=10),
        *_family(replace(root, hyphen=False, not_numeric=False, not_a_date=False), {"telefuturo": "telefuturo.com.py"}, titles="last", min_title=15),
        *_family(page, {"amambaydigital": "amambaydigital.com"}),
        *_family(replace(page, not_a_date=True), {"amambayahora": "amambayahora.com.py"}),
        *_family(replace(page, not_a_date=True, min_slug=10, excluded_slug=static), {"amambaynews": "amambaynews.com", "caazapaahora": "caazapaahora.com.py"}),
        *_family(replace(dated, min_slug=5), {"cronica": "cronica.com.py"}, slash="force"),
        *_family(replace(dated, min_slug=6, hyphen=True), {"laclave": "laclave.com.py", "tnpress": "tnpress.com.py", "luquenoticias": "luquenoticias.com.py"}),
        *_family(replace(dated, calendar=False, not_numeric=False), {"popular": "popular.com.py", "rdn": "rdn.com.py"}, titles="first"),
        *_family(replace(dated, min_parts=5, max_parts=5, dated_at=2, fixed=("index.php",), min_slug=8, hyphen=True), {"digitalmisiones": "digitalmisiones.com.py"}),
        *_family(replace(section, max_parts=99, min_slug=8, no_dot=True), {"abc": "abc.com.py"}, titles="last"),
        *_family(replace(section, min_slug=10, no_dot=True), {"lanacion": "lanacion.com.py"}, titles="last", min_title=10),
        *_family(replace(section, calendar=True, min_slug=5), {"elpoder": "elpoder.com.py"}, slash="force"),
        *_family(replace(section, calendar=True, min_slug=8), {"reddigitalsanpedro": "reddigitalsanpedro.com.py"}),
        *_family(replace(section, hyphen=False, not_numeric=False, excluded_first=()), {"latribuna": "latribuna.com.py"}, titles="first"),
        *_family(Shape(min_parts=5, max_parts=5, dated_at=2, fixed=("ip",), not_numeric=False), {"ip": "ip.gov.py"}, titles="last"),
        *_family(Shape(min_parts=7, max_parts=7, dated_at=3, calendar=True, fixed=("noticia",), slug_at=-2, min_slug=6, hyphen=True, numbered_page=True), {"qap": "qapchaconews.com"}),
        *_family(Shape(min_parts=3, fixed=("noticias",), min_slug=10, hyphen=True, no_dot=True, excluded_slug=("noticias", *static)), {"monumental": "monumental.com.py"}, titles="last", min_title=10),
        *_family(Shape(min_parts=4, fixed=("noticias",), min_slug=10, hyphen=True, no_dot=True), {"npy": "npy.com.py"}, titles="last", min_title=10),
        *_family(Shape(min_parts=3, not_a_date=True, min_slug=10, hyphen=True, excluded_first=system), {"asunciontimes": "asunciontimes.com"}),
        *_family(Shape(min_parts=3, max_parts=3, fixed=("noticia",), min_slug=8, hyphen=True), {"cdehot": "cdehot.com.py"}),
        *_family(Shape(min_parts=2, max_parts=2, fixed=("noticia",), min_slug=10, hyphen=True), {"dpn": "dpn.com.py diarioparaguayo.com"}, titles="first"),
        *_family(Shape(min_parts=2, max_parts=2, fixed=("noticia",), not_numeric=False), {"lajornada": "diariolajornada.com.py"}, titles="first"),
        *_family(Shape(min_parts=2, max_parts=2, fixed=("articulo",), min_slug=8, hyphen=True), {"masencarnacion": "masencarnacion.com"}),
        *_family(Shape(min_parts=2, max_parts=2, first_in=LISTED_SECTIONS, min_slug=8, hyphen=True), {"extra": "extra.com.py"}),
        *_family(Shape(min_parts=2, max_parts=2, numbered_first=True, min_slug=8, hyphen=True), {"sanlorenzopy": "sanlorenzopy.com"}),
        *_family(Shape(min_parts=2, fixed=("article",), not_numeric=False), {"cincodias": "5dias.com.py"}, titles="last"),
        *_family(Shape(min_parts=2, fixed=("politica",), not_numeric=False), {"hoy": "hoy.com.py"}, titles="last"),
        *_family(Shape(min_parts=2, fixed=("politica",), not_numeric=False), {"unicanal": "unicanal.com.py"}, titles="last", min_title=10),
    ]
    return {o.name: o for o in out}


def outlet_of(url: Column, outlets: dict[str, Outlet] | None = None) -> Column:
    """The name of the outlet of whose articles the address has the shape; null if of none. A host belongs to one outlet."""
    outlets = outlets or registry()
    own = F.create_map(*(F.lit(x) for n, o in outlets.items() for h in o.shape.hosts for x in (h, n)))

    def named(x: Column) -> Column:
        # the host tells the outlet, so one shape is tested, on parts that are taken once
        out = F.lit(None).cast("string")
        for name, outlet in outlets.items():
            out = F.when(x["outlet"] == name, F.when(path_fits(x["parts"], outlet.shape), name)).otherwise(out)
        return out

    return F.transform(F.array(F.struct(F.try_element_at(own, host_of(url)).alias("outlet"), path_parts(url).alias("parts"))), named)[0]


def article_links(links: DataFrame, outlets: dict[str, Outlet] | None = None) -> DataFrame:
    """(outlet, url, title): the article links of listing pages, one row an address, titles merged by the outlet's rule.

    links: (page, pos, url, title) of html.listing(). Nothing is read but the rows:
    a page that failed to load has none and takes no other page with it. Links that
    are no articles of their outlet are left out; ties go to the first seen.
    """
    outlets = outlets or registry()
    rules = {n: (o.titles, o.min_title, o.slash) for n, o in outlets.items()}

    def rule(place: int) -> Column:
        table = F.create_map(*(F.lit(x) for n, r in rules.items() for x in (n, r[place])))
        return F.try_element_at(table, F.col("outlet"))

    rows = links.withColumn("outlet", outlet_of(F.col("url"), outlets)).where("outlet is not null")
    address = F.when(rule(2) == "force", clean_url(F.col("url"), "force")).otherwise(clean_url(F.col("url")))
    rows = rows.select("outlet", address.alias("url"), F.when(F.length("title") >= rule(1), F.col("title")).alias("title"), rule(0).alias("how"), F.struct("page", "pos").alias("seen"))
    back = F.struct("seen.pos", "seen.page")
    by = rows.groupBy("outlet", "url", "how").agg(
        F.max_by("title", F.struct(F.length(F.coalesce("title", F.lit(""))), -F.col("seen.pos"))).alias("longest"), F.max_by(F.struct("title"), back)["title"].alias("last"),
        F.min_by("title", F.when(F.col("title").isNotNull(), back)).alias("first"),
    )
    return by.select("outlet", "url", F.when(F.col("how") == "longest", F.col("longest")).when(F.col("how") == "last", F.col("last")).otherwise(F.col("first")).alias("title"))


def as_table(spark: SparkSession, outlets: dict[str, Outlet] | None = None) -> DataFrame:
    """(outlet, host, titles, min_title, slash): the registry as a relation, one row a host."""
    rows = [(o.name, h, o.titles, o.min_title, o.slash) for o in (outlets or registry()).values() for h in o.shape.hosts]
    return spark.createDataFrame(rows, "outlet string, host string, titles string, min_title int, slash string")
