"""XML dump fixtures (FIXTURES.md F1) through read -> flatten -> latest -> store."""

import os

from pyspark.sql import functions as F

from revgraph.operators import latest_per_year
from revgraph.plans import build_pages, ingest
from revgraph.sources import read_pages, read_revisions, rejected_revisions

FILE_A = """<mediawiki>
  <page>
    <title>Alpha Page</title>
    <ns>0</ns>
    <revision>
      <id>1</id>
      <timestamp>2019-03-01T10:00:00Z</timestamp>
      <contributor><username>ann</username><id>7</id></contributor>
      <text xml:space="preserve">old [[Beta]] text</text>
    </revision>
    <revision>
      <timestamp>2019-07-01T10:00:00Z</timestamp>
      <contributor><ip>10.0.0.1</ip></contributor>
      <text xml:space="preserve">
the [[Beta|b]] and [[Gamma#x]] &amp;&amp;&amp; [[Category:Greek letters|a]]</text>
    </revision>
    <revision>
      <timestamp>2020-01-05T00:00:00Z</timestamp>
      <contributor><username>bob</username></contributor>
      <text xml:space="preserve" />
    </revision>
  </page>
  <page>
    <title>Beta</title>
    <revision>
      <timestamp>2019-07-01T10:00:00Z</timestamp>
      <contributor><username>cy</username></contributor>
      <text xml:space="preserve">beta links [[Gamma]] [[alpha page]]</text>
    </revision>
  </page>
</mediawiki>
"""

FILE_B = """<mediawiki>
  <page>
    <title>Gamma</title>
    <revision>
      <timestamp>2019-02-02T00:00:00Z</timestamp>
      <contributor><username>dee</username></contributor>
    </revision>
  </page>
  <page>
    <title>Help:Gamma</title>
    <revision>
      <timestamp>2019-02-02T00:00:00Z</timestamp>
      <text>help [[Gamma]]</text>
    </revision>
  </page>
</mediawiki>
"""


def _write(dir_, name, text):
    with open(os.path.join(dir_, name), "w") as f:
        f.write(text)


def _dump_dir(tmp_dir):
    d = os.path.join(tmp_dir, "dump")
    os.makedirs(d)
    _write(d, "a.xml", FILE_A)
    _write(d, "b.xml", FILE_B)
    return d


def test_read_and_flatten(spark, tmp_dir):
    d = _dump_dir(tmp_dir)
    rev = read_revisions(spark, d)  # two files, one job
    assert rejected_revisions(spark, d).count() == 0
    rows = {(r.title, r.timestamp): r for r in rev.collect()}
    assert len(rows) == 6
    ip = rows[("Alpha Page", "2019-07-01T10:00:00Z")]
    assert ip.username is None  # <ip> contributor
    assert ip.text.startswith("\nthe ")  # leading newline kept
    assert "&&&" in ip.text
    assert rows[("Alpha Page", "2020-01-05T00:00:00Z")].text == ""  # <text ... />
    assert rows[("Gamma", "2019-02-02T00:00:00Z")].text == ""  # no <text>
    assert rows[("Beta", "2019-07-01T10:00:00Z")].year == "2019"  # a page with a single revision


def test_latest_is_per_page_not_per_timestamp(spark, tmp_dir):
    # Alpha Page and Beta share a timestamp; each keeps its own text.
    latest = latest_per_year(read_revisions(spark, _dump_dir(tmp_dir)))
    got = {(r.title, r.year): r.text for r in latest.collect()}
    assert got[("alpha page", "2019")].startswith("\nthe [[Beta|b]]")
    assert got[("beta", "2019")].startswith("beta links")
    assert got[("alpha page", "2020")] == ""
    assert len(got) == 5


def test_equal_timestamps_later_position_wins(spark):
    rev = spark.createDataFrame(
        [("P", None, "2020", "2020-01-01T00:00:00Z", "first", 0), ("P", None, "2020", "2020-01-01T00:00:00Z", "second", 1)],
        "title string, username string, year string, timestamp string, text string, pos int",
    )
    assert latest_per_year(rev).first().text == "second"


def test_case_folded_titles_are_one_page(spark):
    rev = spark.createDataFrame(
        [("Foo", "2020", "2020-01-01T00:00:00Z", "a"), ("foo", "2020", "2020-02-01T00:00:00Z", "b")],
        "title string, year string, timestamp string, text string",
    )
    rows = latest_per_year(rev).collect()
    assert [(r.title, r.text) for r in rows] == [("foo", "b")]


def test_ingest_store(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    dump = _dump_dir(tmp_dir)
    ingest(spark, dump, store)
    pages = read_pages(spark, store)
    got = {(r.title, r.year): r for r in pages.collect()}
    # Help:Gamma has a namespace and is not stored.
    assert sorted(got) == [("alpha page", "2019"), ("alpha page", "2020"), ("beta", "2019"), ("gamma", "2019")]
    a = got[("alpha page", "2019")]
    assert a.links == ["beta", "category", "gamma"]
    assert a.categories == ["Greek letters"]
    # "the" at the start is "\nthe" and no stop word; "&&&" is a word.
    assert a.wordcount == {"the": 1, "&&&": 1}
    assert dict(got[("gamma", "2019")].wordcount) == {}
    # A second ingest of the same files adds nothing.
    ingest(spark, dump, store)
    assert read_pages(spark, store).count() == 4


def test_build_pages_matches_ingest(spark, tmp_dir):
    pages = build_pages(read_revisions(spark, _dump_dir(tmp_dir)))
    assert pages.filter(F.col("title") == "beta").first().links == ["alpha page", "gamma"]


def test_store_modes_and_lookup(spark, tmp_dir):
    from revgraph.sources import compat_pages, pages_where, write_pages

    store = os.path.join(tmp_dir, "store2")
    pages = build_pages(read_revisions(spark, _dump_dir(tmp_dir)))
    write_pages(pages, store, fmt="json", mode="overwrite")
    back = read_pages(spark, store, fmt="json")
    assert back.count() == 4
    one = pages_where(back, year=2019, title="Alpha_Page").collect()
    assert [(r.title, r.year) for r in one] == [("alpha page", "2019")]
    c = compat_pages(back).filter("Title = 'alpha page' AND Year = '2019'").first()
    assert c.Wordcount == ["&&&:1", "the:1"]


def test_latest_with_a_hot_page(spark):
    """One page holds a third of all revisions, spread over every input partition."""
    n = 30_000
    ids = spark.range(n, numPartitions=8)
    hot = F.col("id") % 3 == 0
    rev = ids.select(
        F.when(hot, F.lit("Hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 500).cast("string"))).alias("title"),
        F.lit(None).cast("string").alias("username"),
        F.when(F.col("id") % 2 == 0, F.lit("2020")).otherwise(F.lit("2021")).alias("year"),
        F.format_string("%s-01-01T00:00:00Z_%06d", F.when(F.col("id") % 2 == 0, "2020").otherwise("2021"), F.col("id")).alias("timestamp"),
        F.col("id").cast("string").alias("text"),
    )
    latest = latest_per_year(rev)
    got = {(r.title, r.year): r.text for r in latest.collect()}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    # brute force: the highest id of each (title, year)
    exp = {}
    for i in range(n):
        key = ("hot" if i % 3 == 0 else f"p{i % 500}", "2020" if i % 2 == 0 else "2021")
        exp[key] = str(max(i, int(exp.get(key, -1))))
    assert got == exp
    # the top row per key is kept before the shuffle (partial limit)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_command_line_jobs(spark, tmp_dir):
    """``ingest`` then ``graphs`` through the command line, read back as graph tables."""
    from revgraph.__main__ import main
    from revgraph.operators import all_nodes, category_nodes, link_edges, word_edges
    from revgraph.sources import read_graph

    store, out = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "graphs")
    main(["ingest", _dump_dir(tmp_dir), "--store", store])
    main(["graphs", "--store", store, "--out", out])
    pages = read_pages(spark, store)
    g = read_graph(spark, out)

    def rows(df, cols):
        return sorted(tuple(r) for r in df.select(*cols).collect())

    assert rows(g["nodes"], ["title", "year", "is_stub"]) == rows(all_nodes(pages), ["title", "year", "is_stub"])
    assert rows(g["edges"], ["src", "dst", "year", "weight"]) == rows(link_edges(pages), ["src", "dst", "year", "weight"])
    assert rows(g["word_edges"], ["src", "dst", "year"]) == rows(word_edges(pages), ["src", "dst", "year"])
    assert rows(g["category_nodes"], ["title", "year", "category"]) == rows(category_nodes(pages), ["title", "year", "category"])
    assert ("alpha page", "beta", "2019") in {r[:3] for r in rows(g["edges"], ["src", "dst", "year", "weight"])}
    before = rows(g["nodes"], ["title", "year", "is_stub"])
    main(["ingest", _dump_dir(os.path.join(tmp_dir, "again")), "--store", store])
    main(["compact", "--store", store, "--vacuum"])
    main(["graphs", "--store", store, "--out", out, "--merge"])
    main(["ask", "out_degree", "--graphs", out])
    assert rows(read_graph(spark, out)["nodes"], ["title", "year", "is_stub"]) == before


def test_stream_restart_adds_nothing(spark, tmp_dir):
    """A rerun with nothing new, and a replay of every file after the stream's
    checkpoint is lost, both leave the store as it was."""
    from revgraph.streaming import ingest_stream

    dump = _dump_dir(tmp_dir)
    store = os.path.join(tmp_dir, "store")
    ckpt = os.path.join(tmp_dir, "ckpt")
    ingest_stream(spark, dump, store, ckpt).awaitTermination()

    def snapshot():
        return sorted((r.title, r.year, tuple(r.links)) for r in read_pages(spark, store).collect())

    first = snapshot()
    assert len(first) == 4
    ingest_stream(spark, dump, store, ckpt).awaitTermination()  # same checkpoint: no new files
    assert snapshot() == first
    ingest_stream(spark, dump, store, os.path.join(tmp_dir, "ckpt-lost")).awaitTermination()  # replays all
    assert snapshot() == first


def _big_dump(path, pages=40, long_page=7, long_revisions=400):
    with open(path, "w") as f:
        f.write("<mediawiki>\n")
        for p in range(pages):
            f.write(f"  <page>\n    <title>Page {p} &amp; é</title>\n    <ns>0</ns>\n")
            for r in range(long_revisions if p == long_page else 3):
                f.write(
                    f"    <revision><timestamp>20{10 + r % 5}-01-01T00:00:{r % 60:02}Z</timestamp><contributor><username>u{r}</username></contributor>"
                    f'<text xml:space="preserve">  text {p} {r} &lt;ref&gt; {"x" * 200}</text></revision>\n'
                )
            f.write("  </page>\n")
        f.write("</mediawiki>\n")


def test_one_file_and_one_page_spread_over_many_tasks(spark, tmp_dir):
    """Blocks far smaller than the file, and than the longest page, give the rows of the whole-page XML source."""
    from revgraph.sources.dump import read_chunks

    d = os.path.join(tmp_dir, "big")
    os.makedirs(d)
    _big_dump(os.path.join(d, "a.xml"))
    size = os.path.getsize(os.path.join(d, "a.xml"))
    whole = (
        spark.read.format("xml").schema("title string, revision array<struct<timestamp:string,contributor:struct<username:string>,text:string>>")
        .option("rowTag", "page").option("excludeAttribute", "true").option("ignoreSurroundingSpaces", "false").load(d)
        .select("title", F.explode("revision").alias("r")).select("title", "r.contributor.username", "r.timestamp", "r.text")
    )
    want = sorted(map(tuple, whole.collect()))
    conf = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.files.minPartitionNum": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        assert read_chunks(spark, d).rdd.getNumPartitions() >= 0.8 * size / 8192 > 10
        got = read_revisions(spark, d)
        assert sorted(map(tuple, got.select("title", "username", "timestamp", "text").collect())) == want
        latest = {(r.title, r.year): r.text for r in latest_per_year(got).collect()}
        store = os.path.join(tmp_dir, "store")
        assert ingest(spark, d, store) == 0
        assert read_pages(spark, store).count() == len(latest)
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert latest[("page 7 & é", "2010")].startswith("  text 7 ")


def test_malformed_revisions_are_kept_and_counted(spark, tmp_dir):
    d = os.path.join(tmp_dir, "odd")
    os.makedirs(d)
    page = "<page>{}<revision><timestamp>2019-01-0{}T00:00:00Z</timestamp><text>{}</text></revision></page>\n"
    body = page.format("<title>Good</title>", 1, "fine") + page.format("<title>Bad</title>", 1, "a & b") + page.format("<title>A & B</title>", 2, "x") + page.format("", 3, "no title")
    body += "<page><title>Both</title><revision><timestamp>2019-01-01T00:00:00Z</timestamp><text>ok</text></revision><revision><text>a < b</text></revision></page>\n"
    body += page.format("<title>Last</title>", 4, "after").replace("</page>", "")
    _write(d, "a.xml", "<mediawiki>" + body)
    good = {(r.title, r.text) for r in read_revisions(spark, d).collect()}
    assert good == {("Good", "fine"), ("Both", "ok"), ("Last", "after")}
    bad = sorted((r.title or "", r.reject_reason) for r in rejected_revisions(spark, d).collect())
    assert bad == [("", "page without a readable title")] * 2 + [("Bad", "malformed revision"), ("Both", "malformed revision")]
    store = os.path.join(tmp_dir, "store")
    assert ingest(spark, d, store) == 4
    assert spark.read.json(store + "_rejects").count() == 4
    assert read_pages(spark, store).count() == 3


def test_a_broken_store_is_an_error(spark, tmp_dir):
    import pytest

    from revgraph.sources.store import unstored, write_graph

    rows = spark.createDataFrame([("a", "2020")], "title string, year string")
    assert unstored(rows, os.path.join(tmp_dir, "nothing")).count() == 1
    broken = os.path.join(tmp_dir, "broken", "year=2020")
    os.makedirs(broken)
    _write(broken, "part-0.parquet", "no parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        unstored(rows, os.path.dirname(broken)).count()
    nodes = os.path.join(tmp_dir, "graph", "nodes", "year=2020")
    os.makedirs(nodes)
    _write(nodes, "part-0.parquet", "no parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        write_graph({"nodes": spark.createDataFrame([("a", True, "2020")], "title string, is_stub boolean, year string")}, os.path.join(tmp_dir, "graph"), mode="merge")


def test_stored_pages_are_dropped_before_their_text_is_read(spark, tmp_dir):
    """The anti-join stands below all text work, on the window's key."""
    from revgraph.operators import annotate
    from revgraph.session import stored
    from revgraph.sources.store import unstored

    store = os.path.join(tmp_dir, "store")
    ingest(spark, _dump_dir(tmp_dir), store)
    latest = stored(latest_per_year(read_revisions(spark, _dump_dir(os.path.join(tmp_dir, "again")))), "latest")
    plan = annotate(unstored(latest, store))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp") < plan.index("LeftAnti") and "year" in plan[plan.index("LeftAnti"):]
    assert "regexp" not in plan[plan.index("LeftAnti"):]
    assert "IN (2019,2020)" in unstored(latest, store)._jdf.queryExecution().executedPlan().toString()
