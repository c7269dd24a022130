"""Page extraction, over the given pages and over pages built from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions.markup import find, is_
from reelhouse.operators import pages as ops
from reelhouse.plans import standins
from reelhouse.plans.catalog.registry import query
from reelhouse.sources import readers

N = "nodes"


def _built(spark, sf, template: str):
    """One page per part: `{column}` in the template is filled in from the row."""
    size = F.col("p_size")
    values = {
        "key": F.col("p_partkey").cast("string"),
        "name": F.col("p_name"),
        "w1": F.split("p_name", " ")[0],
        "w2": F.split("p_name", " ")[1],
        "brand": F.col("p_brand"),
        "type": F.col("p_type"),
        "size": size.cast("string"),
        "year": (size + 1970).cast("string"),
    }
    pieces = []
    for chunk in template.split("{"):
        head, _, tail = chunk.partition("}")
        if tail or head in values:
            pieces += [values[head], F.lit(tail)]
        else:
            pieces.append(F.lit(chunk))
    parts = readers.spread(standins.table(spark, sf, "part"))
    built = parts.select(F.col("p_partkey").alias("page_id"), F.concat(*pieces).alias("html"))
    return ops.parsed(built)


def _joined(c):
    return F.array_join(c, "|")


SCRIPT = (
    '<script>window.__NUXT__=(function(){return [a,description:"Say \\"{name}\\" \\u00e9 by {brand}",'
    'description:"other"]})</script>'
)

MOVIE = (
    "<html><body>" + SCRIPT + '<div class="c-productDetails_staff_directors"><span>By</span>'
    '<a class="c-crewList_link g"> {brand} </a><a class="x">no</a></div>'
    '<div class="c-productDetails_staff_writers"><a class="c-crewList_link">{w1}</a>'
    '<a class="c-crewList_link">{w2}</a></div><div class="c-ProductionDetails big">'
    '<div class="c-movieDetails_sectionContainer"><span class="g-text-bold">Production Company:</span>'
    "<ul><li><span>{brand}</span></li><li><span>{type}</span></li></ul></div>"
    '<div class="c-movieDetails_sectionContainer"><span class="g-text-bold">Release Date:</span>'
    "<span> Nov 12, {year}</span></div>"
    '<div class="c-movieDetails_sectionContainer"><span class="g-text-bold">Duration:</span>'
    "<span>1 h {size} m</span></div>"
    '<div class="c-movieDetails_sectionContainer"><span class="g-text-bold">Rating:</span>'
    "<span>R{size}</span></div>"
    '<div class="c-movieDetails_sectionContainer"><span class="g-text-bold">Genres:</span><ul>'
    '<li><span class="c-globalButton_label">{w1}</span></li>'
    '<li><span class="c-globalButton_label">{w2}</span></li></ul></div></div>'
    '<div data-testid="details-award-summary"><div class="c-productionAwardSummary_award">'
    '<div class="g-text-bold">{brand} Prize</div><div>• {size} wins &amp; more</div></div>'
    '<div class="c-productionAwardSummary_award"><div>nameless</div></div>'
    '<div class="c-productionAwardSummary_award"><div class="g-text-bold">Other</div></div></div>'
)


@query(
    "ext_movie_details",
    """SELECT p_partkey AS page_id, 'Say "' || p_name || '" é by ' || p_brand AS summary,
           p_brand AS directed_by, replace(p_name, ' ', '|') AS written_by,
           p_brand || '|' || p_type AS production_companies,
           'Nov 12, ' || (p_size + 1970) AS release_date, '1 h ' || p_size || ' m' AS duration,
           'R' || p_size AS rating, replace(p_name, ' ', '|') AS genres FROM part""",
)
def movie_details(spark, sf):
    m = _built(spark, sf, MOVIE).select("page_id", ops.movie_details(F.col(N)).alias("m"))
    lists = ("directed_by", "written_by", "production_companies", "genres")
    plain = ("summary", "release_date", "duration", "rating")
    return m.select(
        "page_id", *[_joined(f"m.{c}").alias(c) for c in lists], *[F.col(f"m.{c}") for c in plain]
    )


@query(
    "ext_summary_script",
    """SELECT p_partkey AS page_id, 'Say "' || p_name || '" é by ' || p_brand AS summary FROM part""",
)
def summary(spark, sf):
    return _built(spark, sf, MOVIE).select("page_id", ops.summary(F.col(N)).alias("summary"))


@query(
    "ext_awards",
    """SELECT p_partkey AS page_id, p_brand || ' Prize' AS name, p_size || ' wins & more' AS summary
    FROM part UNION ALL SELECT p_partkey, 'Other', NULL FROM part""",
)
def awards(spark, sf):
    return _built(spark, sf, MOVIE).select("page_id", F.inline(ops.awards(F.col(N))))


CREDITS = (
    "<h3>Crew</h3><dl><div class='u-grid-3column'><dd><a>nobody</a></dd></div></dl><h3>The CAST </h3><dl>"
    '<div class="u-grid-3column"><dd><a href="/p"> {w1} <b>{brand}</b></a></dd><dt>{type}</dt></div>'
    '<div class="u-grid-3column"><dd>{w2}</dd><dt>skipped</dt></div>'
    '<div class="u-grid-3column"><dd><a>{w2}</a></dd><dt> </dt></div></dl>'
)


@query(
    "ext_cast",
    """SELECT p_partkey AS page_id, split_part(p_name, ' ', 1) || p_brand AS name, p_type AS role
    FROM part UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2), NULL FROM part""",
)
def cast(spark, sf):
    return _built(spark, sf, CREDITS).select("page_id", F.inline(ops.cast_list(F.col(N))))


GAME = (
    SCRIPT + '<div class="c-productionDetailsGame_esrb_title"><span class="u-block">Rated {size}</span></div>'
    '<div class="c-gameDetails"><div class="c-gameDetails_ReleaseDate"><span>on</span>'
    '<span class="g-color-gray70"> Nov 12, {year} </span></div>'
    '<div class="c-gameDetails_Developer"><ul><li><a>{brand}</a></li><li><span>{type}</span></li>'
    "<li>{brand}</li></ul></div>"
    '<div class="c-gameDetails_Distributor"><span>Publisher:</span> <span>{type} Inc</span></div>'
    '<ul class="c-genreList"><li><span class="c-globalButton_label">{w1}</span></li>'
    '<li><span class="c-globalButton_label">{w2}</span></li></ul></div>'
    '<a class="c-gamePlatformTileLink" href="/g/?x=1&amp;platform={w1}"><div class="g-text-medium">{brand}</div></a>'
    '<a class="c-gamePlatformTileLink" href="/g/none"></a>'
    '<a class="c-gamePlatformTileLink" href="/g/?platform={w2}"></a>'
)


@query(
    "ext_game_details",
    """SELECT p_partkey AS page_id, 'Rated ' || p_size AS rating,
           'Nov 12, ' || (p_size + 1970) AS initial_release_date, p_brand || '|' || p_type AS developers,
           p_type || ' Inc' AS publishers, replace(p_name, ' ', '|') AS genres,
           p_brand || '|' || split_part(p_name, ' ', 2) AS platforms FROM part""",
)
def game_details(spark, sf):
    g = _built(spark, sf, GAME).select("page_id", ops.game_details(F.col(N)).alias("g"))
    lists = ("developers", "publishers", "genres", "platforms")
    return g.select(
        "page_id", "g.rating", "g.initial_release_date", *[_joined(f"g.{c}").alias(c) for c in lists]
    )


@query(
    "ext_game_platforms",
    """SELECT p_partkey AS page_id, split_part(p_name, ' ', 1) AS slug, p_brand AS name FROM part
    UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2), split_part(p_name, ' ', 2) FROM part""",
)
def game_platforms(spark, sf):
    return _built(spark, sf, GAME).select("page_id", F.inline(ops.game_platforms(F.col(N))))


SERIES = (
    '<div class="c-productionDetailsTv"><div><span>Production Company:</span><ul><li>{brand}</li><li>{type}</li>'
    "</ul></div><span>Initial Release Date:</span><span class='g-color-gray70'>Nov 12, {year}</span>"
    "<span>Number of seasons:</span><span class='g-color-gray70'>{size} seasons</span>"
    "<span>Rating:</span><span class='g-color-gray70'>TV-{size}</span>"
    '<ul class="c-genreList"><li><span class="c-globalButton_label">{w1}</span></li></ul></div>'
    '<div data-testid="seasons-modal-card"><a href="/tv/{w1}/season-{size}/"><div class="g-text-bold">Season {size}</div>'
    '<div class="g-text-normal"><span>{size} Episodes</span><span>in {year}</span></div>'
    '<div class="c-siteReviewScore"><span>{size}</span></div></a></div>'
    '<div data-testid="seasons-modal-card"><a href="/tv/{w1}/season-x"></a>'
    '<div class="c-siteReviewScore"><span>tbd</span></div></div>'
    '<div data-testid="seasons-modal-card"><span>no link</span></div>'
)


@query(
    "ext_tv_details",
    """SELECT p_partkey AS page_id, p_brand || '|' || p_type AS production_companies,
           'Nov 12, ' || (p_size + 1970) AS initial_release_date,
           p_size AS number_of_seasons, 'TV-' || p_size AS rating,
           split_part(p_name, ' ', 1) AS genres FROM part""",
)
def tv_details(spark, sf):
    t = _built(spark, sf, SERIES).select("page_id", ops.tv_details(F.col(N)).alias("t"))
    return t.select(
        "page_id",
        _joined("t.production_companies").alias("production_companies"),
        "t.initial_release_date",
        "t.number_of_seasons",
        "t.rating",
        _joined("t.genres").alias("genres"),
    )


@query(
    "ext_tv_seasons",
    """SELECT p_partkey AS page_id, 'Season ' || p_size AS season, 'season-' || p_size AS season_slug,
           p_size AS episodes, p_size + 1970 AS "year", p_size AS metascore FROM part
    UNION ALL SELECT p_partkey, NULL, 'season-x', NULL, NULL, NULL FROM part""",
)
def tv_seasons(spark, sf):
    return _built(spark, sf, SERIES).select("page_id", F.inline(ops.tv_seasons(F.col(N))))


def _grid(*slugs: str) -> str:
    cards = "".join(
        f'<div class="c-finderProductCard c-x"><a class="c-finderProductCard_container y" href="/game/{s}/"></a></div>'
        for s in slugs
    )
    return f'<div class="{ops.LISTING_GRID} extra">{cards}<div><a href="/other/"></a></div></div>'


def _item(number: str) -> str:
    return f'<span class="{ops.PAGE_ITEM}"><span class="{ops.PAGE_NUMBER}"> {number} </span></span>'


LISTING = (
    '<div class="c-productListings">' + _grid("{w1}-{size}", "{w2}") + _grid("{brand}") + _grid("third")
    + "</div>" + _item("1") + _item("{size}") + _item("next")
)


@query(
    "ext_listing_links",
    """SELECT p_partkey AS page_id, CAST(pos AS INTEGER) AS pos, CASE pos WHEN 0 THEN split_part(p_name, ' ', 1) || '-' || p_size
              WHEN 1 THEN split_part(p_name, ' ', 2) WHEN 2 THEN p_brand ELSE 'third' END AS slug
    FROM part, (VALUES (0), (1), (2), (3)) AS v(pos)""",
)
def listing_links(spark, sf):
    return _built(spark, sf, LISTING).select(
        "page_id", F.posexplode(ops.listing_links(F.col(N))).alias("pos", "slug")
    )


@query("ext_last_page", "SELECT p_partkey AS page_id, greatest(1, p_size) AS last_page FROM part")
def last_page(spark, sf):
    return _built(spark, sf, LISTING).select("page_id", ops.last_page(F.col(N)).alias("last_page"))


@query(
    "ext_listing_links_nav",
    """SELECT page_id, regexp_extract(a, 'href="/([^"]*)"', 1) AS slug
    FROM (SELECT page_id, unnest(regexp_extract_all(
            regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="[^"]*"')) AS a FROM pages)""",
)
def nav_links(spark, sf):
    """Links of the navigation block of the given pages."""
    pages = ops.parsed(readers.pages(spark, f"{sf}/pages.parquet"))
    return pages.select(
        "page_id", F.explode(ops.links_in(F.col(N), find(F.col(N), is_("nav")))).alias("slug")
    )
