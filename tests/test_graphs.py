"""Graph operators: golden weights, invariants, brute force on small fixtures."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revgraph.operators import (
    all_nodes,
    category_cliques,
    category_degree,
    category_link_count,
    category_linked,
    category_nodes,
    category_partners,
    graph_endpoints,
    link_edges,
    resolve_links,
    stub_nodes,
    word_edges,
)
from revgraph.plans import link_graph, register_graph_views, run_sample

SCHEMA = "title string, year string, links array<string>, categories array<string>, wordcount map<string,bigint>"


def pages_df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_golden_weights(spark):
    p = pages_df(
        spark,
        [
            ("a", "2020", ["a", "b", "c", "gone"], ["x"], {"x": 2, "y": 3}),
            ("b", "2020", ["b", "c", "d"], ["x"], {"x": 4, "y": 3, "z": 9}),
            ("c", "2020", [], [], {}),
            ("b", "2021", ["a"], [], {"q": 1}),
        ],
    )
    le = {(r.src, r.dst, r.year): r.weight for r in link_edges(p).collect()}
    assert le[("a", "b", "2020")] == 2  # {a,b,c,gone} and {b,c,d} share b, c
    assert le[("a", "gone", "2020")] == 0  # absent target
    assert le[("a", "a", "2020")] == 4  # self-link counts all links
    assert le[("a", "c", "2020")] == 0  # target without links
    assert le[("b", "a", "2021")] == 0  # "a" has no page in 2021
    we = {(r.src, r.dst, r.year): r.weight for r in word_edges(p).collect()}
    assert we[("a", "b", "2020")] == pytest.approx(0.5 + 1.0)
    assert we[("a", "gone", "2020")] == 0.0
    assert we[("a", "a", "2020")] == pytest.approx(2.0)  # = number of distinct words
    assert we[("a", "c", "2020")] == 0.0  # target without words
    assert len(le) == len(we) == 8


def test_nodes_and_stubs(spark):
    p = pages_df(spark, [("a", "2020", ["b", "x"], [], {}), ("b", "2020", ["x"], [], {})])
    nodes = {(r.title, r.year): r.is_stub for r in all_nodes(p).collect()}
    assert nodes == {("a", "2020"): False, ("b", "2020"): False, ("x", "2020"): True}
    assert [tuple(r) for r in stub_nodes(p).collect()] == [("x", "2020")]
    found = {(r.src, r.dst): r.dst_found for r in resolve_links(p).collect()}
    assert found == {("a", "b"): True, ("a", "x"): False, ("b", "x"): False}


def _random_pages(seed, n_pages=40, hot_share=0.3, max_links=12):
    """Pages with one hot target that a third of all links point to."""
    rnd = random.Random(seed)
    titles = [f"p{i}" for i in range(n_pages)]
    vocab = [f"w{i}" for i in range(30)]
    rows = []
    for t in titles:
        for year in ("2020", "2021"):
            k = rnd.randint(0, max_links)
            links = {rnd.choice(titles + ["ghost", "stub x"]) for _ in range(k)}
            if rnd.random() < hot_share:
                links.add("p0")
            words = Counter(rnd.choice(vocab) for _ in range(rnd.randint(0, 40)))
            rows.append((t, year, sorted(links), sorted({rnd.choice(["c1", "c2", "c3"]) for _ in range(rnd.randint(0, 2))}), dict(words)))
    return rows


def _brute(rows):
    page = {(t, y): (set(l), w) for t, y, l, _, w in rows}
    links, words = {}, {}
    for t, y, l, _, w in rows:
        for d in l:
            tgt = page.get((d, y))
            links[(t, d, y)] = len(set(l) & tgt[0]) if tgt else 0
            words[(t, d, y)] = sum(min(w[k], tgt[1][k]) / max(w[k], tgt[1][k]) for k in w if k in tgt[1]) if tgt else 0.0
    return links, words


@pytest.mark.parametrize("seed", [1, 2])
def test_weights_against_brute_force(spark, seed):
    rows = _random_pages(seed)
    p = pages_df(spark, rows)
    exp_links, exp_words = _brute(rows)
    got_links = {(r.src, r.dst, r.year): r.weight for r in link_edges(p).collect()}
    got_words = {(r.src, r.dst, r.year): r.weight for r in word_edges(p).collect()}
    assert got_links == exp_links
    assert got_words.keys() == exp_words.keys()
    for k, v in exp_words.items():
        assert got_words[k] == pytest.approx(v)


def test_graph_invariants(spark):
    rows = _random_pages(3)
    p = pages_df(spark, rows)
    g = link_graph(p)
    # every edge binds to two nodes
    assert graph_endpoints(g.nodes, g.edges).count() == g.edges.count()
    # 0 <= weight <= size(links of src)
    deg = p.select(F.col("title").alias("src"), "year", F.size("links").alias("deg"))
    bad = g.edges.join(deg, ["src", "year"]).filter((F.col("weight") < 0) | (F.col("weight") > F.col("deg")))
    assert bad.count() == 0
    # one node per (title, year)
    assert g.nodes.groupBy("title", "year").count().filter("count > 1").count() == 0
    # word weights: 0 <= weight <= number of words both pages have; a self-edge
    # weighs exactly the page's number of distinct words
    page = {(t, y): set(w) for t, y, _, _, w in rows}
    for r in word_edges(p).collect():
        tgt = page.get((r.dst, r.year), set())
        common = len(page[(r.src, r.year)] & tgt)
        assert -1e-9 <= r.weight <= common + 1e-9
        if r.src == r.dst:
            assert r.weight == pytest.approx(len(page[(r.src, r.year)]))


def test_category_graph_against_pairs(spark):
    rows = _random_pages(4)
    p = pages_df(spark, rows)
    nodes = category_nodes(p)
    cliques = {(r.category, r.year): (r.n_pages, r.n_pairs) for r in category_cliques(nodes).collect()}
    members = {}
    for t, y, _, cats, _ in rows:
        for c in cats:
            members.setdefault((c, y), set()).add(t)
    pairs = {k: sum(1 for _ in itertools.combinations(sorted(v), 2)) for k, v in members.items()}
    assert cliques == {k: (len(members[k]), pairs[k]) for k in members}
    assert category_link_count(category_cliques(nodes)).first().link_count == 2 * sum(pairs.values())
    deg = {(r.title, r.year, r.category): r.degree for r in category_degree(nodes, category_cliques(nodes)).collect()}
    assert all(deg[(t, y, c)] == len(members[(c, y)]) - 1 for (c, y), ts in members.items() for t in ts)
    # partners of one page
    t0, y0 = next((t, y) for t, y, _, cats, _ in rows if cats)
    ask = spark.createDataFrame([(t0, y0)], "title string, year string")
    got = {(r.category, r.partner) for r in category_partners(nodes, ask).collect()}
    exp = {(c, o) for (c, y), ts in members.items() if y == y0 and t0 in ts for o in ts if o != t0}
    assert got == exp
    # linked pairs
    a, b = "p1", "p2"
    q = spark.createDataFrame([(a, b, "2020")], "a string, b string, year string")
    got = {r.category for r in category_linked(nodes, q).collect()}
    exp = {c for (c, y), ts in members.items() if y == "2020" and a in ts and b in ts}
    assert got == exp


def test_uncategorised_option(spark):
    p = pages_df(spark, [("a", "2020", [], [], {}), ("b", "2020", [], [], {}), ("c", "2020", [], ["k"], {})])
    assert category_nodes(p).count() == 1
    cl = {(r.category, r.n_pages) for r in category_cliques(category_nodes(p, include_uncategorised=True)).collect()}
    assert cl == {("", 2), ("k", 1)}


def test_graph_views(spark):
    p = pages_df(spark, [("a", "2020", ["b", "x"], [], {}), ("b", "2020", ["a", "x"], [], {})])
    g = link_graph(p)
    tables = {"nodes": g.nodes, "edges": g.edges}
    views = register_graph_views(tables)
    assert spark.sql(f"SELECT count(*) AS n FROM {views['edges']}").first().n == 4
    views = tables
    deg = {(r.title, r.out_degree) for r in run_sample(spark, "out_degree", views).collect()}
    assert deg == {("a", 2), ("b", 2), ("x", 0)}
    top = run_sample(spark, "top_edges", views, k=1).collect()
    assert [(r.src, r.dst, r.weight) for r in top] == [("a", "b", 1)]
    nb = {(r.title, r.neighbour) for r in run_sample(spark, "neighbours", views).collect()}
    assert ("x", "a") in nb and ("a", "x") in nb


def test_graph_store_csv(spark, tmp_dir):
    from revgraph.sources import read_graph, write_graph

    p = pages_df(spark, [("a b", "2020", ["c, d"], [], {}), ("c, d", "2020", [], [], {})])
    g = link_graph(p)
    write_graph({"nodes": g.nodes.select("title", "is_stub", "year"), "edges": g.edges}, tmp_dir, fmt="csv")
    back = read_graph(spark, tmp_dir, ["nodes", "edges"], fmt="csv")
    assert {(r.src, r.dst, r.name, r.weight, r.year) for r in back["edges"].collect()} == {("a b", "c, d", "a_b_TO__c__d2020", 0, "2020")}
    assert back["nodes"].count() == 2


def test_graph_store_merge(spark, tmp_dir):
    from revgraph.sources import read_graph, write_graph

    p1 = pages_df(spark, [("a", "2020", ["b"], [], {}), ("b", "2020", [], [], {})])
    p2 = pages_df(spark, [("a", "2020", ["b", "c"], [], {}), ("b", "2020", ["a"], [], {})])
    for p in (p1, p2, p2):
        g = link_graph(p)
        write_graph({"nodes": g.nodes, "edges": g.edges}, tmp_dir, mode="merge")
    back = read_graph(spark, tmp_dir, ["nodes", "edges"])
    assert {(r.src, r.dst) for r in back["edges"].collect()} == {("a", "b"), ("a", "c"), ("b", "a")}
    assert back["edges"].count() == 3
    assert {(r.title, r.is_stub) for r in back["nodes"].collect()} == {("a", False), ("b", False), ("c", True)}


SKEW_CONF = {
    # No broadcasts, so joins stay shuffled; any partition above 1 KB and
    # above the median counts as skewed, so AQE's split really runs.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_weights_with_skew_split(spark):
    """A target a third of all links point to, with AQE's skew-join split forced."""
    rows = _random_pages(7, n_pages=300, hot_share=0.9, max_links=3)
    exp_links, exp_words = _brute(rows)
    old = _with_conf(spark, SKEW_CONF)
    try:
        p = pages_df(spark, rows).repartition(8)
        le = link_edges(p)
        got_links = {(r.src, r.dst, r.year): r.weight for r in le.collect()}
        plan = le._jdf.queryExecution().executedPlan().toString()
        we = word_edges(p)
        got_words = {(r.src, r.dst, r.year): r.weight for r in we.collect()}
        word_plan = we._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    hot = sum(1 for (_, d, _) in exp_links if d == "p0")
    assert hot * 3 >= len(exp_links)  # the hot target really holds a third of the edges
    assert "skew=true" in plan and "skew=true" in word_plan
    assert got_links == exp_links
    assert got_words.keys() == exp_words.keys()
    for k, v in exp_words.items():
        assert got_words[k] == pytest.approx(v)


def test_node_and_target_joins_with_skew_split(spark):
    """The hot target's edges, and a category that holds most pages, are split although the other side of the
    join comes from an aggregate or a window on the join's key."""
    from revgraph.operators import edges, latest_per_year

    rows = _random_pages(7, n_pages=300, hot_share=0.9, max_links=3)
    rows = [(t, y, links, ["big"] if i % 4 else ["big", f"c{i}"], words) for i, (t, y, links, _, words) in enumerate(rows)]
    old = _with_conf(spark, SKEW_CONF)
    try:
        p = pages_df(spark, rows).repartition(8)
        nodes = category_nodes(p)
        found = {
            "resolve": resolve_links(latest_per_year(p.withColumn("timestamp", F.lit("t")))).select("src", "dst", "year", "dst_found"),
            "endpoints": graph_endpoints(all_nodes(p), edges(p)),
            "degree": category_degree(nodes, category_cliques(nodes)),
        }
        got = {name: sorted(map(tuple, df.collect())) for name, df in found.items()}
        plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in found.items()}
    finally:
        _restore(spark, old)
    assert {name for name, plan in plans.items() if "skew=true" in plan} == set(found)
    titles = {(t, y) for t, y, *_ in rows}
    want = sorted((t, d, y, (d, y) in titles) for t, y, links, *_ in rows for d in links)
    assert got["resolve"] == want
    assert got["endpoints"] == sorted((t, d, y, False, not ok) for t, d, y, ok in want)
    size = Counter((c, y) for _, y, _, cats, _ in rows for c in cats)
    assert got["degree"] == sorted((t, y, c, size[c, y] - 1) for t, y, _, cats, _ in rows for c in cats)


def test_word_edges_walk_the_page_with_fewer_words(spark):
    """Rows walked are the sum of the smaller word counts, not of links against words."""
    from revgraph.operators import walked_rows

    rows = _random_pages(11, n_pages=60, hot_share=0.3, max_links=6)
    words = {(t, y): len(w) for t, y, _, _, w in rows}
    want = sum(min(words[t, y], words[d, y]) for t, y, links, *_ in rows for d in links if (d, y) in words)
    p = pages_df(spark, rows)
    assert walked_rows(p, F.size("wordcount")).first()["rows"] == want > 0
    plan = word_edges(p)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(links" not in plan.replace(" ", "")


def test_pairs_in_both_directions_and_spellings_are_walked_once(spark):
    """Equal degrees, mutual links, a target in two spellings, a self-link and a link to no page."""
    words = {"x": 2, "y": 3}
    p = pages_df(spark, [("a b", "2020", ["c", "a_b", "gone"], [], words), ("c", "2020", ["a b", "a_b", "gone"], [], {"x": 4, "z": 1}), ("c", "2021", ["a b"], [], words)])
    got = {(r.src, r.dst, r.year): r.weight for r in word_edges(p).collect()}
    assert got == {("a b", "c", "2020"): 0.5, ("a b", "a_b", "2020"): 2.0, ("a b", "gone", "2020"): 0.0, ("c", "a b", "2020"): 0.5, ("c", "a_b", "2020"): 0.5, ("c", "gone", "2020"): 0.0, ("c", "a b", "2021"): 0.0}
    links = {(r.src, r.dst, r.year): r.weight for r in link_edges(p).collect()}
    assert links == {k: {("a b", "a_b"): 3}.get(k[:2], 2 if k[2] == "2020" and k[1] != "gone" else 0) for k in got}


def test_other_spellings_resolve_and_are_no_stubs(spark):
    """A link resolves (J2) if and only if its node is no stub (J3), whatever its spelling."""
    p = pages_df(spark, [("foo bar", "2020", ["foo_bar", "gone", "gone_x", "gone x"], [], {}), ("a_b", "2020", ["a b", "foo bar"], [], {}), ("gone", "2021", [], [], {})])
    nodes = {(r.title, r.year): r.is_stub for r in all_nodes(p).collect()}
    assert nodes[("foo_bar", "2020")] is False and nodes[("a b", "2020")] is False
    unresolved = {(r.dst, r.year) for r in resolve_links(p).where("NOT dst_found").collect()}
    assert {(r.title, r.year) for r in stub_nodes(p).collect()} == unresolved == {("gone", "2020"), ("gone_x", "2020"), ("gone x", "2020")}


def test_questions_without_weights_join_no_items(spark):
    """Endpoints and degrees come from the edges alone."""
    from revgraph.operators import edges

    p = pages_df(spark, [("a", "2020", ["b", "b2"], [], {}), ("b", "2020", [], [], {})])
    plan = graph_endpoints(all_nodes(p), edges(p))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


@pytest.mark.parametrize("alike, more, partners", [(8, 64, 16), (1, 0, 2), (1, 0, 10**6), (0, -1, 0)])
def test_words_compared_in_one_row_or_walked_weigh_the_same(spark, monkeypatch, alike, more, partners):
    """Pages of a like size, a large page with few and one with many small partners; a word held once, a page without words."""
    from revgraph.operators import links

    for name, value in (("ALIKE", alike), ("ALIKE_MORE", more), ("PARTNERS", partners)):
        monkeypatch.setattr(links, name, value)
    rows = _random_pages(13, n_pages=30, max_links=4)
    rows.append(("p0 b", "2020", [f"p{i}" for i in range(30)], [], {f"w{i}": i + 1 for i in range(200)}))
    rows.append(("empty", "2020", ["p0 b", "p1"], [], {}))
    p = pages_df(spark, rows)
    want_links, want_words = _brute(rows)
    assert {(r.src, r.dst, r.year): r.weight for r in link_edges(p).collect()} == want_links
    got = {(r.src, r.dst, r.year): r.weight for r in word_edges(p).collect()}
    assert got.keys() == want_words.keys()
    for k, v in want_words.items():
        assert got[k] == pytest.approx(v)


def test_words_of_pages_of_a_like_size_are_shuffled_in_no_row_of_their_own(spark):
    """Pages that few others link to: no row for a word reaches a shuffle."""
    from revgraph.operators import links

    rows = [(f"p{i}", "2020", [f"p{i + 1}"], [], {f"w{j}": j + 1 for j in range(i, i + 40 if i % 7 else i + 400)}) for i in range(60)]
    found = links._with_target(links.edges(pages_df(spark, rows), F.size("wordcount")), pages_df(spark, rows), "wordcount")
    df = links.weigh_words(found, pages_df(spark, rows))
    assert len(df.collect()) == 60
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(wordcount" not in plan.split("== Initial Plan ==")[0]
