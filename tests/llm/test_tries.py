"""Prefix tries against every prefix of every conversation."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from revgraph.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def brute(rows, graft):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    paths = {c: [(r, t) for _, _, _, r, t in sorted(v)] for c, v in own.items()}
    if graft:
        base = lambda c: c - (c % 5 if c >= 0 else -(-c % 5))
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in paths}
        paths = {c: paths.get(base(c), [])[: h[c]] + p[h[c] :] for c, p in paths.items()}
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    out = []
    for n, m in members.items():
        below = [x for x in members if x[: len(n)] == n]
        kids = lambda x: sum(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(n)))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids(n), sum(kids(x) == 0 for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, graft, shard):
    found = tries.grafted_trie(df, shard) if graft else tries.prefix_trie(df, shard=shard)
    return sorted(map(tuple, found.collect()), key=str)


def conversations(n, seed, hot=0.4):
    rng = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        if rng.random() < 0.1:
            continue  # some bases are absent
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "hello é" if rng.random() < hot else rng.choice("abc") * 3))
    return rows


@pytest.mark.parametrize("graft", [True, False])
@pytest.mark.parametrize("shard", [1, 7, 4096])
def test_equals_every_prefix(spark, graft, shard):
    rows = conversations(60, shard)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, graft, shard) == brute(rows, graft)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = conversations(12, 3) + [(None, 0, "user", "x"), (3, None, None, None), (3, None, "user", ""), (4, 0, "user", "a"), (4, 0, "user", "a"), (4, 0, "user", "b"), (50, 2, "user", "")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("grp", "key", "shard", "place", "digest", "size", "depth", "ends"):
        df = df.withColumn(name, F.lit("clash"))
    for shard in (2, 100):
        assert got(df, True, shard) == brute(rows, True)


def test_turnless_and_empty(spark):
    """A conversation whose few turns are cut away without a base to replace them is a member of the root."""
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "a"), (c, 1, "assistant", "b")]
    assert got(spark.createDataFrame(rows, SCHEMA), True, 10) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert got(spark.createDataFrame([], SCHEMA), True, 10) == []


def test_long_conversations_and_texts(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}" if t < 2990 else "x" * 300_000) for t in range(3000)]
    found = tries.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 1 + 3000 + 10
    top = next(r for r in found if r.depth == 0)
    assert (top.n_leaves, top.n_convs, top.saved_tokens) == (2, 2, sum(len(f"t{t}") for t in range(2990)))


def test_many_copies_over_many_shards(spark):
    """A conversation that a thousand others copy: one row per shard moves, and the ends are hashed in order."""
    rows = [(c, t, "user", f"t{t}") for c in range(1000) for t in range(3)] + [(5000 + c, 0, "user", f"u{c}") for c in range(50)]
    found = {(r.depth, r.conv_id): r for r in tries.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6), shard=32).collect()}
    assert found[3, 0].n_convs == 1000 and found[3, 0].ends_sha256 == hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest()
    assert found[0, 0].n_children == 51 and found[0, 0].n_leaves == 51


def test_shard_children_are_intersections():
    nodes = tries.shard_trie([(7, [(b"a", 1), (b"b", 2)]), (5, [(b"a", 1)]), (6, []), (9, [(b"c", 1), (b"b", 2)])])
    by_depth = sorted((n[4], n[6], n[7], n[8]) for n in nodes)
    assert by_depth == [(0, 4, 5, [6]), (1, 1, 9, []), (1, 2, 5, [5]), (2, 1, 7, [7]), (2, 1, 9, [9])]
