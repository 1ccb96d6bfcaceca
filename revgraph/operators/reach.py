"""Questions over whole graphs: paths from given pages, components of the category graph, strongest edges.

Each works in rounds over stored tables, so a plan never grows with the rounds
and a lost executor repeats one round at most. What decides whether to go on is
one small row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revgraph.functions.text import title_key
from revgraph.operators.links import EDGE_KEY, _targets, edges, own_exchange, weigh_words, with_title_key
from revgraph.session import stored

PAGE_KEY = ["title_key", "year"]


def paths(edge_table: DataFrame, starts: DataFrame, hops: int, direction: str = "out") -> DataFrame:
    """``title_key, year, hops``: pages and link targets within ``hops`` links of ``starts``, with the fewest links.

    ``edge_table``: ``src, dst, year``; ``starts``: ``title_key, year``. With
    ``direction="in"`` links are followed backwards. Every round joins the
    frontier, the keys reached last, with the edges. The frontier is distinct
    and has an exchange of its own, so a page with a large share of all links
    (at either end) is split by the adaptive skew join, and copies of a key
    reached many times are combined before they move.
    """
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    links = edge_table.select(title_key(near).alias("title_key"), "year", title_key(far).alias("next"))
    found = [stored(starts.select(*PAGE_KEY).distinct().withColumn("hops", F.lit(0)), "frontier")]
    for h in range(1, hops + 1):
        frontier = own_exchange(found[-1].select(*PAGE_KEY), *PAGE_KEY)
        step = links.join(frontier, PAGE_KEY).select(F.col("next").alias("title_key"), "year").distinct()
        seen = reduce(DataFrame.unionByName, (f.select(*PAGE_KEY) for f in found))
        found.append(stored(step.join(seen, PAGE_KEY, "left_anti").withColumn("hops", F.lit(h)), "frontier"))
        if found[-1].isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def category_components(nodes: DataFrame) -> DataFrame:
    """``title, year, component``: pages joined by chains of shared categories, named by the smallest title of each year's component.

    ``nodes``: ``title, year, category`` (G3). Works on the membership alone,
    never on pairs: in each round a category takes the smallest label of its
    pages, combined before the shuffle, a page the smallest of its categories,
    and then a label is replaced by the label of the page that it names, which
    halves the length of chains. It ends when no label changes. A category
    with most pages is one row to join, and its pages are split by the adaptive
    skew join.
    """
    member = stored(nodes.select("title", "year", "category").distinct(), "members")
    labels = stored(member.select("title", "year").distinct().withColumn("label", F.col("title")), "labels")
    while True:
        of_category = member.join(labels, ["title", "year"]).groupBy("category", "year").agg(F.min("label").alias("least"))
        least = member.join(own_exchange(of_category, "category", "year"), ["category", "year"])
        near = stored(least.groupBy("title", "year").agg(F.min("least").alias("near")), "labels")
        named = own_exchange(near.select(F.col("title").alias("near"), "year", F.col("near").alias("label")), "near", "year")
        jumped = near.join(named, ["near", "year"]).select("title", "year", "label")
        before = labels.select("title", "year", F.col("label").alias("before"))
        now = stored(jumped.join(before, ["title", "year"]).select("title", "year", "label", (F.col("label") != F.col("before")).alias("moved")), "labels")
        labels = now.select("title", "year", "label")
        if not now.agg(F.max("moved")).first()[0]:
            return labels.withColumnRenamed("label", "component")


def strongest_word_edges(pages: DataFrame, k: int, rounds: tuple[int, ...] = (1, 16)) -> tuple[DataFrame, int]:
    """T1 without all weights: the ``k`` heaviest word edges of each year, ``src, dst, year, weight, rank``, and the rows walked.

    A shared word adds at most 1, so an edge weighs at most the smaller number
    of words of its two pages. Edges are walked by falling bound: the first
    ``k``, then ``16 k`` of each year, and last all whose bound reaches the
    weight of the k-th found. Edges below it cannot be among the k. Weights
    that agree to 6 places rank by their ends. A year with fewer than ``k``
    edges above 0 is filled up with edges of weight 0.
    """
    degree = F.size("wordcount")
    pages = with_title_key(pages)
    every = edges(pages, degree)
    resolved = every.join(_targets(pages, degree), ["dst_key", "year"], "left").withColumn("bound", F.when(F.col("dst_deg").isNull(), 0).otherwise(F.least("src_deg", "dst_deg")))
    by_bound = Window.partitionBy("year").orderBy(F.col("bound").desc(), "src", "dst")
    # A year's place by bound is needed for few edges: Spark keeps the first of each partition before the shuffle.
    first = stored(resolved.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= k * max(rounds)), "by-bound")

    def weighed(some: DataFrame) -> DataFrame:
        keys = some.select(F.col("src_key").alias("title_key"), "year").unionByName(some.select(F.col("dst_key").alias("title_key"), "year")).distinct()
        ends = pages.join(keys, PAGE_KEY, "left_semi")
        return weigh_words(some, ends).withColumn("weight", F.round("weight", 6))

    def best(weights: DataFrame) -> DataFrame:
        heaviest = Window.partitionBy("year").orderBy(F.col("weight").desc(), "src", "dst")
        return weights.withColumn("rank", F.row_number().over(heaviest)).where(F.col("rank") <= k)

    def floors(top: DataFrame) -> DataFrame:
        """The k-th weight of each year, less what rounding may hide; 0 where there are not k."""
        return top.groupBy("year").agg(F.max(F.when(F.col("rank") == k, F.col("weight") - 1e-6)).alias("floor"))

    top, walked, done = None, 0, F.lit(False)
    for r in rounds:
        part = first.where((F.col("place") <= k * r) & ~done)
        if top is not None:
            part = part.join(floors(top), "year", "left").where(F.col("bound") >= F.coalesce("floor", F.lit(0.0)))
        part = stored(part, "walked-edges")
        walked += part.agg(F.coalesce(F.sum("bound"), F.lit(0))).first()[0]
        weights = weighed(part)
        top = stored(best(weights if top is None else weights.unionByName(top.drop("rank"))), "top")
        done = F.col("place") <= k * r
    rest = resolved.join(first.select(*EDGE_KEY), EDGE_KEY, "left_anti").join(F.broadcast(floors(top)), "year", "left")
    rest = stored(rest.where(F.col("bound") >= F.coalesce("floor", F.lit(0.0))), "walked-edges")
    walked += rest.agg(F.coalesce(F.sum("bound"), F.lit(0))).first()[0]
    return best(weighed(rest).unionByName(top.drop("rank"))), walked
