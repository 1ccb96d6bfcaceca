"""Page graphs from year-pages: edges, link resolution, stubs, weights.

Input ``pages``: ``title, year, links, wordcount`` (plus ``title_key`` when
available). An edge is one distinct, non-empty link of a page; its target
resolves to a page of the same year whose title key (lower case, ``_`` for
space) equals the link's.

Edge weights count what both pages share (links, or words weighted by
``min/max`` of their counts). They are computed on long tables, never by
copying large arrays onto every edge: each pair of linked pages walks the items
of its *smaller* page and probes the larger page on ``(page, item)``. Walked
rows carry page numbers, not titles. The probe join is spread over items, so
a page holding a large share of all links or words does not pile up in one task.

Words of a pair are compared in one row instead, without a row for each word in
a shuffle, where that copies few words: the pages are of a like size (``ALIKE``),
or the larger page has few smaller partners (``PARTNERS``). Either way work is in
proportion to ``sum(min(deg(src), deg(dst)))`` over resolved edges and the items
of all pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revgraph.functions.arrays import explode_nonempty
from revgraph.functions.text import title_key

EDGE_KEY = ["src", "dst", "year"]
#: The number of a pair's smaller page, whose items are walked, and of the larger, which is probed.
WALK, PROBE = ["walk_0", "walk_1"], ["probe_0", "probe_1"]
#: Pages are of a like size if the larger has at most so many times the smaller's items, and so many more.
ALIKE, ALIKE_MORE = 8, 64
#: A page is copied for so many pages that are not of a like size.
PARTNERS = 16


def with_title_key(pages: DataFrame) -> DataFrame:
    if "title_key" in pages.columns:
        return pages
    return pages.withColumn("title_key", title_key("title"))


def edges(pages: DataFrame, degree: Column | None = None) -> DataFrame:
    """All link edges: ``src, src_key, year, dst, dst_key, src_deg``.

    ``degree`` is what the edge's walk costs at a page: its links by default.
    """
    p = with_title_key(pages)
    gen, nonempty = explode_nonempty("links", "dst")
    e = p.select(
        F.col("title").alias("src"),
        F.col("title_key").alias("src_key"),
        "year",
        (F.size("links") if degree is None else degree).alias("src_deg"),
        gen,
    ).filter(nonempty)
    return e.withColumn("dst_key", F.translate(F.lower("dst"), " ", "_"))


def _targets(pages: DataFrame, degree: Column) -> DataFrame:
    p = with_title_key(pages)
    return p.select(F.col("title_key").alias("dst_key"), "year", degree.alias("dst_deg"))


def own_exchange(df: DataFrame, *key: str) -> DataFrame:
    """Deal rows out by a hash that is not ``key`` itself.

    The output of an aggregation or window on ``key`` joins on ``key`` without
    a shuffle, and then Spark cannot split a hot key of the other side. Moved
    off the key, this side gets an exchange of its own in the join, and the
    adaptive skew join may split the other. For narrow tables only.
    """
    return df.repartition(F.xxhash64(*key))


def resolve_links(pages: DataFrame, degree: Column | None = None) -> DataFrame:
    """Every edge with ``dst_found`` and the target's degree (NULL if absent)."""
    degree = F.size("links") if degree is None else degree
    targets = own_exchange(_targets(pages, degree), "dst_key", "year")
    return edges(pages, degree).join(targets, ["dst_key", "year"], "left").withColumn(
        "dst_found", F.col("dst_deg").isNotNull()
    )


def all_nodes(pages: DataFrame) -> DataFrame:
    """U1 + A7: pages and link targets as nodes ``title, year, is_stub``.

    Like a graph ``MERGE``, nodes are distinct raw titles. A node is a stub
    when links to it do not resolve (J2): no page of the year has its title
    key. One aggregation with map-side combine makes the union distinct, so a
    target linked from everywhere is reduced before the shuffle; what is left
    of a key are its few spellings.
    """
    own = pages.select("title", "year", F.lit(True).alias("is_page"))
    gen, nonempty = explode_nonempty("links", "title")
    targets = pages.select(gen, "year", F.lit(False).alias("is_page")).filter(nonempty)
    titles = own.unionByName(targets).groupBy("title", "year").agg(F.max("is_page").alias("is_page"))
    spellings = Window.partitionBy(title_key("title"), "year")
    return titles.select("title", "year", (~F.max("is_page").over(spellings)).alias("is_stub"))


def stub_nodes(pages: DataFrame) -> DataFrame:
    """Link targets that no page of the year resolves."""
    return all_nodes(pages).filter("is_stub").select("title", "year")


def graph_endpoints(nodes: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Bind each edge to both end nodes (inner joins on title and year)."""
    s = own_exchange(nodes.select(F.col("title").alias("src"), "year", F.col("is_stub").alias("src_is_stub")), "src", "year")
    d = own_exchange(nodes.select(F.col("title").alias("dst"), "year", F.col("is_stub").alias("dst_is_stub")), "dst", "year")
    return edge_table.select(*EDGE_KEY).join(s, ["src", "year"]).join(d, ["dst", "year"]).select(
        "src", "dst", "year", "src_is_stub", "dst_is_stub"
    )


def _number(names: list[str], *columns: str) -> list[Column]:
    """A page's number: two seeded 64-bit hashes of its key and year.

    Numbers need neither a shuffle nor a stored dictionary and are the same in
    every retry; among 10 billion pages two equal ones have a chance of 1e-19.
    """
    return [F.xxhash64(F.lit(seed), *columns).alias(name) for seed, name in enumerate(names)]


def _pairs(found: DataFrame) -> DataFrame:
    """Edges with the numbers of their smaller (``WALK``) and larger page (``PROBE``).

    Links in both directions and several spellings of a target are one pair of
    pages. An edge without a target has a pair of its own, which nothing matches.
    """
    smaller = F.struct("src_deg", "src_key") <= F.struct("dst_deg", "dst_key")
    src_small = F.col("dst_deg").isNull() | smaller
    keyed = found.withColumns(
        {
            "walk_key": F.when(src_small, F.col("src_key")).otherwise(F.col("dst_key")),
            "probe_key": F.when(src_small, F.col("dst_key")).otherwise(F.col("src_key")),
        }
    )
    return keyed.select("*", *_number(WALK, "walk_key", "year"), *_number(PROBE, "probe_key", "year"))


def _items(df: DataFrame, bag: str, value: str, *keep: str) -> DataFrame:
    """One row ``*keep, item, value`` per item of a page: its links (each 1), or its words with their counts."""
    if bag == "links":
        gen, nonempty = explode_nonempty(bag, "item")
        return df.select(*keep, gen, F.lit(1).alias(value)).filter(nonempty)
    gen, nonempty = explode_nonempty(bag, "item", value)
    return df.select(*keep, gen).filter(nonempty)


def weigh(found: DataFrame, pages: DataFrame, bag: str, contribution: Column, zero, whole: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``src, dst, year, weight``: every edge with the sum over the items that its pages share.

    ``found``: ``src, dst, year, src_key, dst_key, src_deg, dst_deg``, the last
    null where no page is the target. ``bag`` is the pages' column of ``links``
    or words; ``contribution`` may use ``v_walk`` and ``v_probe``. A pair of
    pages is walked once. Its smaller page arrives as one row, whose items are
    laid out after the join; these rows, which are shuffled, hold numbers and
    an item. Titles come back after the sum. Edges without a target or with
    nothing in common weigh ``zero``.

    With ``whole``, the same sum from two bags, pairs take both bags into one
    row; only those of a page with more than ``PARTNERS`` much smaller ones are
    walked.
    """
    e = _pairs(found)
    p = with_title_key(pages)
    alike = F.greatest("src_deg", "dst_deg") <= ALIKE * F.least("src_deg", "dst_deg").cast("long") + ALIKE_MORE
    walk = e.where(F.col("dst_deg").isNotNull()).groupBy(*WALK, *PROBE).agg(F.min(alike).alias("alike"))
    larger = p.select(*_number(PROBE, "title_key", "year"), bag)
    if whole is None:
        sums = _walked(_with_smaller(walk, p, bag), larger, bag, contribution)
    else:
        often = walk.where("NOT alike").groupBy(*PROBE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PARTNERS).select(*PROBE)
        often = own_exchange(often, *PROBE)
        few = walk.where("alike").unionByName(walk.where("NOT alike").join(often, PROBE, "left_anti"))
        pair = _with_smaller(few, p, bag).withColumnRenamed(bag, "bag").join(larger, PROBE)
        # An exchange after the join, so that the adaptive skew join may split the pairs of a page with many links.
        compared = pair.select(*WALK, *PROBE, whole(F.col("bag"), F.col(bag)).alias("part")).repartition(*WALK, *PROBE)
        many = walk.where("NOT alike").join(often, PROBE, "left_semi")
        sums = compared.unionByName(_walked(_with_smaller(many, p, bag), larger.join(often, PROBE, "left_semi"), bag, contribution))
    sums = sums.groupBy(*WALK, *PROBE).agg(F.sum("part").alias("sum"))
    return e.join(sums, [*WALK, *PROBE], "left").select(*EDGE_KEY, F.coalesce("sum", F.lit(zero)).alias("weight"))


def _with_smaller(walk: DataFrame, pages: DataFrame, bag: str) -> DataFrame:
    """Pairs with the bag of their smaller page."""
    return walk.join(pages.select(*_number(WALK, "title_key", "year"), bag), WALK).select(*WALK, *PROBE, bag)


def _walked(smaller: DataFrame, larger: DataFrame, bag: str, contribution: Column) -> DataFrame:
    """``part``: what each item that the two pages of a pair share adds."""
    a = _items(smaller, bag, "v_walk", *WALK, *PROBE)
    b = _items(larger, bag, "v_probe", *PROBE)
    return a.join(b, [*PROBE, "item"]).select(*WALK, *PROBE, contribution.alias("part"))


def weigh_links(found: DataFrame, pages: DataFrame) -> DataFrame:
    """``weigh`` by the number of shared links."""
    return weigh(found, pages, "links", F.lit(1).cast("bigint"), 0)


def weigh_words(found: DataFrame, pages: DataFrame) -> DataFrame:
    """``weigh`` by the shared words, each with ``min/max`` of its counts."""
    return weigh(found, pages, "wordcount", _word_ratio(F.col("v_walk"), F.col("v_probe")), 0.0, _word_ratios)


def _with_target(e: DataFrame, pages: DataFrame, bag: str) -> DataFrame:
    """Every edge of ``e`` with its target's degree (NULL if absent)."""
    return e.join(own_exchange(_targets(pages, F.size(bag)), "dst_key", "year"), ["dst_key", "year"], "left")


def _with_source(edge_keys: DataFrame, pages: DataFrame, degree: Column) -> DataFrame:
    """Edges ``src, src_key, year, dst, dst_key`` with their source page's degree."""
    sources = _targets(pages, degree).select(F.col("dst_key").alias("src_key"), "year", F.col("dst_deg").alias("src_deg"))
    return edge_keys.join(own_exchange(sources, "src_key", "year"), ["src_key", "year"])


def walked_rows(pages: DataFrame, degree: Column) -> DataFrame:
    """``rows``: the item rows that the walks of all resolved edges read, sum(min(src, dst degree))."""
    resolved = edges(pages, degree).join(_targets(pages, degree), ["dst_key", "year"])
    return resolved.agg(F.coalesce(F.sum(F.least("src_deg", "dst_deg").cast("long")), F.lit(0).cast("long")).alias("rows"))


def _word_ratio(n1: Column, n2: Column) -> Column:
    n1, n2 = n1.cast("double"), n2.cast("double")
    return F.least(n1, n2) / F.greatest(n1, n2)


def _word_ratios(words1: Column, words2: Column) -> Column:
    """The sum of ``_word_ratio`` over the words that both maps hold."""
    ratio = F.map_zip_with(words1, words2, lambda _, n1, n2: F.when(n1.isNotNull() & n2.isNotNull(), _word_ratio(n1, n2)).otherwise(0.0))
    return F.aggregate(F.map_values(ratio), F.lit(0.0), lambda total, r: total + r)


def link_edges(pages: DataFrame) -> DataFrame:
    """A5/G1: ``src, dst, year, weight`` with weight = number of shared links.

    0 when the target page is absent or nothing is shared; self-links count
    all the page's links.
    """
    return weigh_links(_with_target(edges(pages), pages, "links"), pages)


def word_edges(pages: DataFrame) -> DataFrame:
    """weight = sum over shared words of ``min(n1,n2)/max(n1,n2)`` (double)."""
    return weigh_words(_with_target(edges(pages, F.size("wordcount")), pages, "wordcount"), pages)


def link_weights(edge_keys: DataFrame, pages: DataFrame) -> DataFrame:
    """A5 for the given edges ``src, src_key, year, dst, dst_key`` only; ``pages`` hold their ends."""
    return weigh_links(_with_target(_with_source(edge_keys, pages, F.size("links")), pages, "links"), pages)


def word_weights(edge_keys: DataFrame, pages: DataFrame) -> DataFrame:
    """A6 for the given edges only."""
    return weigh_words(_with_target(_with_source(edge_keys, pages, F.size("wordcount")), pages, "wordcount"), pages)
