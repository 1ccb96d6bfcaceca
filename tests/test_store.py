"""The page store: batches and commits, lookups, compaction; one pass over a dump."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from revgraph.plans import graphs
from revgraph.plans.graphs import ingest, ingest_chunks
from revgraph.sources import compact, find_pages, pages_where, read_pages, store, vacuum, write_pages
from revgraph.sources.dump import read_chunks

PAGE = "title string, links array<string>, categories array<string>, wordcount map<string,bigint>, year string"


def some_pages(spark, titles, year="2020"):
    return spark.createDataFrame([(t, ["x"], [], {"w": 1}, year) for t in titles], PAGE)


def titles(spark, path):
    return sorted((r.title, r.year) for r in read_pages(spark, path).collect())


def test_lookup_opens_one_file_of_many(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    names = [f"Page {i:04}" for i in range(2000)]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for year in ("2020", "2021"):
            write_pages(some_pages(spark, names, year), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(read_pages(spark, path).inputFiles()) >= 14
    one = find_pages(spark, path, "pAGE_1234", "2021")
    assert len(one.inputFiles()) == 1 and [(r.title, r.year) for r in one.collect()] == [("Page 1234", "2021")]
    assert "EqualTo(title_key,page_1234)" in one._jdf.queryExecution().executedPlan().toString()
    every = find_pages(spark, path, "page 0007")
    assert len(every.inputFiles()) == 2 and every.count() == 2
    assert find_pages(spark, path, "nothing").count() == 0 and find_pages(spark, path, "page 0007", "1999").count() == 0
    assert "EqualTo(title_key,page_0007)" in pages_where(read_pages(spark, path), title="Page 0007")._jdf.queryExecution().executedPlan().toString()


def test_odd_names_of_files_are_found(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    write_pages(some_pages(spark, ["a+b/é %20"], "19 9+0%"), path)
    assert find_pages(spark, path, "A+B/É_%20").count() == 1
    with pytest.raises(ValueError):
        write_pages(some_pages(spark, ["a"]), path, batch="../x")


def _dump(d, n):
    os.makedirs(d)
    page = "<page><title>P {}</title><revision><timestamp>2019-01-01T00:00:00Z</timestamp><text>t{}</text></revision></page>\n"
    bad = "<page><title>Bad {}</title><revision><timestamp>2019-01-01T00:00:00Z</timestamp><text>a & b</text></revision></page>\n"
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write("<mediawiki>" + "".join(page.format(i, i) for i in range(n)) + bad.format(n) + "</mediawiki>")
    return d


def test_a_batch_killed_at_any_step_is_run_again(spark, tmp_dir, monkeypatch):
    """Nothing is lost, doubled or seen early, whichever step died; a committed batch is not run again."""

    class Killed(Exception):
        pass

    def die(*args, **kw):
        raise Killed

    first, second = _dump(os.path.join(tmp_dir, "d1"), 3), _dump(os.path.join(tmp_dir, "d2"), 5)
    steps = [(graphs, "split_ends"), (graphs, "latest_per_year"), (graphs, "unstored"), (graphs, "write_batch"), (store, "_commit")]
    for before in (False, True):
        for i, (module, name) in enumerate(steps[3:] if before else steps[::2]):
            path = os.path.join(tmp_dir, f"store-{before}-{i}")
            seen = []
            if before:
                assert ingest_chunks(read_chunks(spark, first), path, batch="one") == 1
                seen = titles(spark, path)
            with monkeypatch.context() as m:
                m.setattr(module, name, die)
                with pytest.raises(Killed):
                    ingest_chunks(read_chunks(spark, second), path, batch="two")
            if before:
                assert titles(spark, path) == seen
            elif os.path.exists(path):
                assert titles(spark, path) == []
            for _ in range(2):
                assert ingest_chunks(read_chunks(spark, second), path, batch="two") == 1
                assert titles(spark, path) == [(f"p {k}", "2019") for k in range(5)]
                assert spark.read.json(path + "_rejects").count() == 1 + before
            done = store.commits(spark, path)
            assert sorted((c["batch"], c["pages"], c["rejects"]) for c in done) == ([("one", 3, 1), ("two", 2, 1)] if before else [("two", 5, 1)])


def test_compaction(spark, tmp_dir, monkeypatch):
    """Many batches become one; a batch committed meanwhile stays; one that dies changes nothing; first write wins goes on."""
    path = os.path.join(tmp_dir, "store")
    for i in range(8):
        write_pages(some_pages(spark, [f"p{3 * i + k}" for k in range(3)], str(2019 + i % 2)), path)
    want = titles(spark, path)
    files = lambda: glob.glob(f"{path}/batch=*/year=*/*.parquet")
    assert len(want) == 24 and len(files()) >= 8
    open_reader = read_pages(spark, path)

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact(spark, path)
    assert titles(spark, path) == want

    true_read = store.read_pages

    def read_while_another_commits(*args, **kw):
        monkeypatch.setattr(store, "read_pages", true_read)
        write_pages(some_pages(spark, ["late"]), path)
        return true_read(*args, **kw)

    monkeypatch.setattr(store, "read_pages", read_while_another_commits)
    name = compact(spark, path)
    assert titles(spark, path) == sorted([*want, ("late", "2020")])
    assert len(store.live_batches(store.commits(spark, path))) == 2
    assert sorted((r.title, r.year) for r in open_reader.collect()) == want  # opened before the switch
    assert len(vacuum(spark, path)) == 8
    assert len(files()) <= 2 + 1 + len(glob.glob(f"{path}/batch={name}/year=*/*.parquet")) + 8
    assert titles(spark, path) == sorted([*want, ("late", "2020")])
    write_pages(some_pages(spark, ["P0", "p0", "new"], "2019").dropDuplicates(["year", "title"]).where("title <> 'P0'"), path)
    assert titles(spark, path) == sorted([*want, ("late", "2020"), ("new", "2019")])
    assert [r.title for r in find_pages(spark, path, "p5", "2020").collect()] == ["p5"]
    assert compact(spark, path) and compact(spark, path) is None


def test_a_dump_is_read_once(spark, tmp_dir):
    """Bytes read from the local file system: the dump once, and pieces that are far smaller."""
    d = os.path.join(tmp_dir, "dump")
    os.makedirs(d)
    with open(os.path.join(d, "a.xml"), "w") as f:
        f.write("<mediawiki><page><title>One</title>")
        for r in range(3000):
            f.write(f"<revision><timestamp>2019-01-01T{r // 3600:02}:{r // 60 % 60:02}:{r % 60:02}Z</timestamp><text>{'x%05d ' % r * 300}</text></revision>")
        f.write("</page></mediawiki>")
    size = os.path.getsize(os.path.join(d, "a.xml"))
    hadoop = spark._jvm.org.apache.hadoop.fs

    def read():
        return sum(s.getBytesRead() for s in hadoop.FileSystem.getAllStatistics())

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        before = read()
        assert ingest(spark, d, os.path.join(tmp_dir, "store")) == 0
        took = read() - before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert size > 6_000_000 and size <= took < 1.4 * size
    assert read_pages(spark, os.path.join(tmp_dir, "store")).select(F.map_keys("wordcount")[0]).first()[0] == "x02999"
