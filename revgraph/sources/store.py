"""The year-page store (S3-S6, P5) and the graph store.

Pages are one table of Parquet files (JSON as an option) instead of one
directory per (year, title): ``<store>/batch=<name>/year=<year>/``. A batch is
what one delivery added. Its folder is written in full first, then the ranges of
title keys in its files (``<store>_ranges``), and last one row in
``<store>_commits``: only committed batches are read, so a batch that died at
any step has left nothing, and run again under its name it overwrites what it
had begun. A name that is committed already is not run again.

Rows are range-sorted by (year, title key), so each file holds a short range of
keys. A lookup by title opens only the files whose range holds the key, and the
test on the stored key is pushed to their scan.

``compact`` folds many small batches into one whose commit names those that it
replaces: that one row switches readers over, while batches committed meanwhile
stay as they are. ``vacuum`` removes replaced folders later, when no reader is
left on them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from revgraph.functions.text import title_key
from revgraph.operators.links import with_title_key
from revgraph.schema import CATEGORY_CLIQUE, CATEGORY_NODE, COMMIT, KEY_RANGE, LINK_EDGE, NODE, PAGE, STORED_PAGE, WORD_EDGE
from revgraph.session import stored

PAGE_COLUMNS = [f.name for f in PAGE.fields]
STORED_COLUMNS = [f.name for f in STORED_PAGE.fields]


def _reader(spark: SparkSession, fmt: str, schema):
    return spark.read.format(fmt).schema(schema)


def _if_stored(load) -> DataFrame | None:
    """The table that ``load`` reads, or None if its path does not exist; any other error is raised."""
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ---------------------------------------------------------------- commits

def new_batch() -> str:
    return uuid.uuid4().hex


def commits(spark: SparkSession, path: str) -> list[Row]:
    """The committed batches, one small row each."""
    found = _if_stored(lambda: spark.read.schema(COMMIT).json(f"{path.rstrip('/')}_commits"))
    return [] if found is None else found.collect()


def committed(spark: SparkSession, path: str, batch: str) -> Row | None:
    return next((c for c in commits(spark, path) if c["batch"] == batch), None)


def live_batches(done: list[Row]) -> list[str]:
    """Names of the committed batches that no other one has replaced."""
    gone = {b for c in done for b in c["replaces"] or ()}
    return sorted({c["batch"] for c in done} - gone)


def _commit(spark: SparkSession, path: str, batch: str, pages: int, rejects: int, replaces: Iterable[str], mode: str = "append") -> None:
    row = spark.createDataFrame([(batch, list(replaces), pages, rejects)], COMMIT)
    row.coalesce(1).write.mode(mode).json(f"{path.rstrip('/')}_commits")


# ---------------------------------------------------------------- pages

def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", batches: Iterable[str] | None = None) -> DataFrame:
    """Every page of every year of the committed batches (or of those named), with ``title_key``.

    ``year=<year>`` folders from elsewhere, without batches, are read as they are.
    """
    path = path.rstrip("/")
    done = commits(spark, path)
    if not done:
        plain = _reader(spark, fmt, PAGE).load(path)
        begun = "batch" in plain.columns  # of batches that none has committed yet, nothing counts
        return with_title_key(plain.where(F.lit(not begun))).select(*STORED_COLUMNS)
    names = live_batches(done) if batches is None else list(batches)
    return _reader(spark, fmt, STORED_PAGE).option("basePath", path).load([f"{path}/batch={b}" for b in names]).select(*STORED_COLUMNS)


def pages_where(pages: DataFrame, year: str | None = None, title: str | None = None) -> DataFrame:
    """Pages of one year and/or one title (case and ``_``/space folded)."""
    out = with_title_key(pages)
    if year is not None:
        out = out.filter(F.col("year") == F.lit(str(year)))
    if title is not None:
        out = out.filter(F.col("title_key") == title_key(F.lit(title)))
    return out.select(*pages.columns)


def find_pages(spark: SparkSession, path: str, title: str, year: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The pages of one title, from the files whose key range may hold it; without ``year`` those of every year."""
    path = path.rstrip("/")
    live = live_batches(commits(spark, path))
    if not live:
        return pages_where(read_pages(spark, path, fmt), year, title)
    key = title_key(F.lit(title))
    ranges = spark.read.schema(KEY_RANGE).parquet(f"{path}_ranges").where(F.col("batch").isin(live) & (F.col("low") <= key) & (F.col("high") >= key))
    if year is not None:
        ranges = ranges.where(F.col("year") == str(year))
    files = [r["file"] for r in ranges.select("file").distinct().collect()]  # files whose range of keys holds one key: about one a batch and year
    if not files:
        return pages_where(read_pages(spark, path, fmt).limit(0), year, title)
    held = _reader(spark, fmt, STORED_PAGE).option("basePath", path).load([f"{path}/{f}" for f in sorted(files)]).select(*STORED_COLUMNS)
    return pages_where(held, year, title)


def unstored(rows: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows (``title_key`` or ``title``, ``year``) whose page and year are not in the store yet.

    Joined on the title key, so rows that are still partitioned by it (the
    output of ``latest_per_year``) are not shuffled again. Only the folders of
    the rows' own years are scanned; those are few, and reading them costs a
    pass over ``rows``, which callers keep cheap by storing them first.
    """
    spark = rows.sparkSession
    existing = _if_stored(lambda: read_pages(spark, path, fmt))
    if existing is None:
        return rows
    years = [r["year"] for r in rows.select("year").distinct().collect()]
    keys = existing.where(F.col("year").isin(years)).select(F.col("title_key").alias("_key"), F.col("year").alias("_year"))
    own = F.col("title_key") if "title_key" in rows.columns else title_key("title")
    return rows.join(keys, (own == F.col("_key")) & (F.col("year") == F.col("_year")), "left_anti")


def clustered(rows: DataFrame) -> DataFrame:
    """Rows with ``year`` and ``title_key`` in contiguous ranges of them, sorted.

    Finding the ranges takes a pass over the rows: cluster before costly
    columns are computed. Ranges are even in rows, and the adaptive planner
    merges small ones, so files come out sized and a hot year spans several.
    """
    return rows.repartitionByRange("year", "title_key").sortWithinPartitions("year", "title_key")


def write_batch(pages: DataFrame, path: str, batch: str, fmt: str = "parquet", rejects: int = 0, replaces: Iterable[str] = (), in_order: bool = False) -> None:
    """Write ``pages`` as one batch and commit it; ``in_order``: they are clustered already.

    Run again before its commit, it overwrites its own folder; after it, nothing.
    """
    spark, path = pages.sparkSession, path.rstrip("/")
    if not re.fullmatch("[0-9A-Za-z_-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, _ and -, not {batch!r}")
    if committed(spark, path, batch):
        return
    folder = f"{path}/batch={batch}"
    rows = with_title_key(pages).select(*STORED_COLUMNS)
    (rows if in_order else clustered(rows)).write.format(fmt).mode("overwrite").partitionBy("year").save(folder)
    held = _reader(spark, fmt, STORED_PAGE).option("basePath", path).load(folder)
    below = F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/", -2)
    file = F.concat(F.lit(f"batch={batch}/"), below)
    ranges = held.groupBy("year", file.alias("file")).agg(F.min("title_key").alias("low"), F.max("title_key").alias("high"), F.count(F.lit(1)).alias("n"))
    ranges.write.mode("overwrite").parquet(f"{path}_ranges/batch={batch}")
    n = spark.read.schema(KEY_RANGE).parquet(f"{path}_ranges/batch={batch}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    _commit(spark, path, batch, n, rejects, replaces)


def write_pages(pages: DataFrame, path: str, fmt: str = "parquet", mode: str = "first_write_wins", batch: str | None = None, in_order: bool = False) -> None:
    """Store pages as a batch.

    ``first_write_wins`` adds only (year, title key) pairs not yet in the
    store, so re-running over new dump files never replaces a stored page;
    ``append`` adds all; ``overwrite`` makes this batch the only one.
    """
    spark = pages.sparkSession
    if mode == "first_write_wins":
        pages = unstored(pages, path, fmt)
    replaces = live_batches(commits(spark, path)) if mode == "overwrite" else ()
    write_batch(pages, path, batch or new_batch(), fmt, replaces=replaces, in_order=in_order)


def compact(spark: SparkSession, path: str, fmt: str = "parquet", least: int = 2) -> str | None:
    """Fold the live batches, if there are ``least`` of them, into one; returns its name.

    Readers switch over with its commit; batches committed meanwhile are not
    among those it replaces. A compaction that dies has changed nothing.
    """
    live = live_batches(commits(spark, path))
    if len(live) < least:
        return None
    name = f"compact-{new_batch()}"
    write_batch(read_pages(spark, path, fmt, live), path, name, fmt, replaces=live)
    return name


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of replaced batches; for when no reader is left that began before they were replaced."""
    path = path.rstrip("/")
    gone = sorted({b for c in commits(spark, path) for b in c["replaces"] or ()})
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for batch in gone:
        for folder in (f"{path}/batch={batch}", f"{path}_ranges/batch={batch}"):
            at = hadoop.Path(folder)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return gone


def _by_year(df: DataFrame) -> DataFrame:
    """Rebalance on the partition column before a ``partitionBy("year")`` write.

    Without it every task holds rows of every year and writes one small file
    per year. With it each task writes one year, and AQE splits a year that
    holds a large share of the rows into advisory-sized pieces (and merges
    small ones), so files are about ``advisoryPartitionSizeInBytes`` each.
    """
    return df.hint("rebalance", "year")


def compat_pages(pages: DataFrame) -> DataFrame:
    """The year-page row in the original bean's shape, for JSON export:
    ``Title, Year, Links, Categories, Wordcount`` with word counts as sorted
    ``"word:n"`` strings."""
    entries = F.transform(F.map_entries("wordcount"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return pages.select(
        F.col("title").alias("Title"),
        F.col("year").alias("Year"),
        F.col("links").alias("Links"),
        F.col("categories").alias("Categories"),
        F.array_sort(entries).alias("Wordcount"),
    )


def write_json_by_year(compat: DataFrame, path: str) -> None:
    """JSON files in a folder for each year (``_year=...``); the year stays a field of each row."""
    compat.withColumn("_year", F.col("Year")).hint("rebalance", "_year").write.mode("overwrite").partitionBy("_year").json(path)


# ---------------------------------------------------------------- graph store

GRAPH_TABLES = {
    "nodes": NODE,
    "edges": LINK_EDGE,
    "word_edges": WORD_EDGE,
    "category_nodes": CATEGORY_NODE,
    "cliques": CATEGORY_CLIQUE,
}

# Identity of a row in each graph table, for ``mode="merge"``.
GRAPH_KEYS = {
    "nodes": ["title", "year"],
    "edges": ["src", "dst", "year"],
    "word_edges": ["src", "dst", "year"],
    "category_nodes": ["title", "year", "category"],
    "cliques": ["category", "year"],
}


def write_graph(tables: dict[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Persist graph tables, each partitioned by year.

    ``fmt="csv"`` writes headers, for loading into graph tools.
    ``mode="merge"`` (A7) appends only rows whose key is not stored yet, like
    a graph ``MERGE``: re-running a graph job adds nothing twice. Rows whose
    values change with new pages are not its business: see
    ``plans.maintenance.update_graphs``.
    """
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        write_mode = mode
        if mode == "merge":
            write_mode = "append"
            keys = GRAPH_KEYS[name]
            existing = _if_stored(lambda: read_graph(df.sparkSession, path, [name], fmt)[name])  # noqa: B023 - called at once
            if existing is not None:
                years = [r["year"] for r in df.select("year").distinct().collect()]
                df = df.join(existing.where(F.col("year").isin(years)).select(*keys), keys, "left_anti")
        w = _by_year(df.select(*[f.name for f in GRAPH_TABLES[name].fields])).write.format(fmt).mode(write_mode).partitionBy("year")
        if fmt == "csv":
            w = w.option("header", "true")
        w.save(target)


def graph_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether all graph tables are there; nodes are written last."""
    return all(_if_stored(lambda: read_graph(spark, path, [name], fmt)[name]) is not None for name in GRAPH_TABLES)  # noqa: B023 - called at once


def read_graph(spark: SparkSession, path: str, names: Iterable[str] | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    out = {}
    for name in names or GRAPH_TABLES:
        schema = GRAPH_TABLES[name]
        r = _reader(spark, fmt, schema)
        if fmt == "csv":
            r = r.option("header", "true")
        out[name] = r.load(f"{path.rstrip('/')}/{name}")
    return out


def replace_rows(spark: SparkSession, path: str, name: str, changed: DataFrame, years: list[str], fmt: str = "parquet") -> None:
    """Put ``changed`` rows of ``years`` in the place of stored ones of the same key; other years are not touched.

    The years are written anew next to the table first, then over their
    folders. Doing it again with the same rows changes nothing.
    """
    columns, keys = [f.name for f in GRAPH_TABLES[name].fields], GRAPH_KEYS[name]
    own = changed.select(*columns)
    rest = read_graph(spark, path, [name], fmt)[name].where(F.col("year").isin(years)).select(*columns)
    rows = stored(rest.join(own.select(*keys), keys, "left_anti").unionByName(own), name)
    w = _by_year(rows).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year")
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(f"{path.rstrip('/')}/{name}")
