"""Graphs kept up to date with a growing store, and questions in rounds, against rebuilding and brute force."""

import random
from collections import defaultdict

import pytest
from test_graphs import SKEW_CONF, _random_pages, _restore, _with_conf, pages_df

from revgraph.operators import category_components, category_nodes, edges, paths, strongest_word_edges, walked_rows, word_edges
from revgraph.operators.links import F
from revgraph.plans import maintenance
from revgraph.plans.graphs import graph_tables
from revgraph.plans.maintenance import touched_edges, unknown_pages, update_tables
from revgraph.sources import read_graph, write_graph


def rows(tables):
    out = {}
    for name, df in tables.items():
        cols = sorted(df.columns)
        out[name] = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)
    return out


def deliveries(seed):
    """Pages of two years, some linked to under other spellings, in three parts of a random order."""
    made = _random_pages(seed, n_pages=40, hot_share=0.5, max_links=5)
    made = [(t, y, [*links, "p1 x", "P_2"][: 5 + i % 3], cats, words) for i, (t, y, links, cats, words) in enumerate(made)]
    made += [("p1_x", "2020", ["p0"], ["c0"], {"w": 2}), ("only new", "1999", ["only new", "gone"], [], {"w": 1})]
    random.Random(seed).shuffle(made)
    return [made[:15], made[15:16], made[16:]], made


@pytest.mark.parametrize("seed", [1])
def test_after_any_order_of_merges_tables_equal_a_rebuild(spark, tmp_dir, seed):
    parts, every = deliveries(seed)
    path = f"{tmp_dir}/g{seed}"
    write_graph(graph_tables(pages_df(spark, parts[0]), True), path)
    so_far = list(parts[0])
    for part in parts[1:]:
        so_far += part
        assert update_tables(spark, pages_df(spark, so_far), path, True) == len(part)
    assert update_tables(spark, pages_df(spark, so_far), path, True) == 0
    assert rows(read_graph(spark, path)) == rows(graph_tables(pages_df(spark, every), True) | {})


def test_only_touched_edges_are_walked(spark, tmp_dir):
    old = [(f"p{i}", "2020", [f"p{i + 1}", "late", "gone"], [], {"a": i + 1, "b": 1}) for i in range(30)]
    new = [("late", "2020", ["p3", "nowhere"], [], {"a": 1})]
    path = f"{tmp_dir}/g"
    write_graph(graph_tables(pages_df(spark, old)), path)
    pages = pages_df(spark, old + new)
    added = unknown_pages(pages, read_graph(spark, path)["nodes"])
    touched = {(r.src, r.dst) for r in touched_edges(added, read_graph(spark, path)["edges"]).collect()}
    assert touched == {("late", "p3"), ("late", "nowhere")} | {(f"p{i}", "late") for i in range(30)}
    assert maintenance.ends_of(touched_edges(added, read_graph(spark, path)["edges"]).where("src = 'late'"), maintenance.with_title_key(pages)).count() == 2
    assert update_tables(spark, pages, path) == 1
    assert rows(read_graph(spark, path)) == rows(graph_tables(pages_df(spark, old + new)))


@pytest.mark.parametrize("step", ["word_edges", "nodes"])
def test_an_update_that_died_runs_again(spark, tmp_dir, monkeypatch, step):
    parts, every = deliveries(3)
    path = f"{tmp_dir}/g"
    write_graph(graph_tables(pages_df(spark, parts[0])), path)
    true_replace = maintenance.replace_rows

    def die(spark_, path_, name, *args, **kw):
        if name == step:
            raise RuntimeError("died")
        true_replace(spark_, path_, name, *args, **kw)

    monkeypatch.setattr(maintenance, "replace_rows", die)
    with pytest.raises(RuntimeError):
        update_tables(spark, pages_df(spark, every), path)
    monkeypatch.setattr(maintenance, "replace_rows", true_replace)
    assert update_tables(spark, pages_df(spark, every), path) == len(every) - len(parts[0])
    assert rows(read_graph(spark, path)) == rows(graph_tables(pages_df(spark, every)))


def test_paths_with_a_hot_target(spark):
    """Half of all links lead to one page; the joins with it are split."""
    made = _random_pages(5, n_pages=300, hot_share=0.8, max_links=3)
    e = edges(pages_df(spark, made).repartition(8)).select("src", "dst", "year")
    links = [(r.src, r.dst, r.year) for r in e.collect()]
    starts = spark.createDataFrame([("p7", "2020"), ("p9", "2021"), ("nobody", "2020")], "title_key string, year string")
    for direction in ("out", "in"):
        near = defaultdict(list)
        for s, d, y in links:
            near[(s, y) if direction == "out" else (d, y)].append((d, y) if direction == "out" else (s, y))
        want = {("p7", "2020"): 0, ("p9", "2021"): 0, ("nobody", "2020"): 0}
        front = list(want)
        for h in range(1, 5):
            front = sorted({n for f in front for n in near[f]} - set(want))
            want.update({n: h for n in front})
        old = _with_conf(spark, SKEW_CONF)
        try:
            got = paths(e, starts, 4, direction)
            assert {(r.title_key, r.year): r.hops for r in got.collect()} == want and got.count() == len(want)
        finally:
            _restore(spark, old)


def test_components_against_pairs(spark):
    """A chain of a hundred pages, a category that holds most pages of a year, single pages, two years."""
    made = [(f"c{i:03}", "2020", [], [f"k{i}", f"k{i + 1}"], {}) for i in range(100)]
    made += [(f"h{i}", "2020", [], ["hot"] + [f"z{i}"] * (i % 3 == 0), {}) for i in range(200)] + [("c000", "2021", [], ["hot"], {}), ("lone", "2021", [], ["own"], {})]
    rng = random.Random(8)
    made += [(f"r{i}", "2021", [], sorted({f"q{rng.randrange(60)}" for _ in range(2)}), {}) for i in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for t, y, _, cats, _ in made:
        for c in cats:
            parent[root(("page", t, y))] = root(("cat", c, y))
    groups = defaultdict(list)
    for t, y, *_ in made:
        groups[root(("page", t, y))].append((t, y))
    want = {p: min(t for t, _ in group) for group in groups.values() for p in group}
    old = _with_conf(spark, SKEW_CONF)
    try:
        got = category_components(category_nodes(pages_df(spark, made).repartition(8)))
        assert {(r.title, r.year): r.component for r in got.collect()} == want
    finally:
        _restore(spark, old)
    assert category_components(category_nodes(pages_df(spark, made).limit(0))).count() == 0


@pytest.mark.parametrize("k", [1, 5, 10_000])
def test_strongest_word_edges_are_those_of_the_full_ranking(spark, k):
    rng = random.Random(k)
    made = [(f"p{i}", str(2020 + i % 2), [f"p{rng.randrange(0, 80)}" for _ in range(4)] + ["gone"], [], {f"w{rng.randrange(300)}": rng.randrange(1, 4) for _ in range(rng.choice([3, 10, 200]))}) for i in range(80)]
    made = [(t, y, sorted(set(links)), c, w) for t, y, links, c, w in made]
    p = pages_df(spark, made).cache()
    want = defaultdict(list)
    for r in word_edges(p).collect():
        want[r.year].append((-round(r.weight, 6), r.src, r.dst))
    got, walked = strongest_word_edges(p, k)
    found = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: (r.year, r["rank"])):
        found[r.year].append((-r.weight, r.src, r.dst))
    assert found == {y: sorted(v)[:k] for y, v in want.items()}
    full = walked_rows(p, F.size("wordcount")).first()["rows"]
    assert (walked == full) if k > 1000 else (walked < full)
