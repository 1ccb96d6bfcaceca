"""Conversation prefix tries by vertical bitmaps, shard by shard.

A conversation's turns (role, text) in order are a path from a textless root;
every prefix that some conversation begins with is a node, and the conversations
that begin with it are its members.

Shards. Rows of 16-byte turn digests are dealt by ranges of ids and streamed in
order; each run of ``SHARD`` conversations is one shard. There, (position, turn)
is indexed to a bitset of the shard's conversations. A depth-first walk
intersects a node's bitset with the postings of the turns that its members hold
next: these are its children, the popcount is their number of members, and the
members left without a next turn end there. A hot first turn, or a conversation
copied ten thousand times, is a bitset per shard and one row per shard.

Nodes of all shards are merged by a digest of their path: members add up, the
smallest member is the smallest of all. Sums over a subtree need no walk of the
merged trie, however deep: what a node's text would cost again in every member
but one is ``bytes * (members - 1)``, and if the one is the smallest member, each
shard can tell its own share (members here, less one if the smallest is here) and
add it up its own small trie; the same for childless nodes, counted where their
smallest member is. The shares are added over the shards.

The hash over a node's ends must see all of them in order. Shards hold ascending
ranges of ids, so their lists are streamed one after the other into one SHA-256,
never gathered.

Defined results: rows without a conversation id are left out; a null role or text
is empty; a null turn comes first, rows of equal turn follow the digest of role
and text; repeated rows are turns of their own; texts may be of any length (only
digest and size move); an empty table gives no rows; columns other than the four
read may have any name. The turns of one conversation, and of one shard, must fit
in a task (at most some 600 bytes a turn, whatever the length of the texts).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revgraph.llm.common import stored

#: Conversations of a shard; a shard ends earlier when it holds ``SHARD_TURNS`` turns.
SHARD = 4096
SHARD_TURNS = 1 << 17
ROOT = b"\x00" * 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

LOCAL = "shard long, place int, parent int, key binary, parent_key binary, depth long, size long, members long, first long, ends array<long>"


def turns(conversations: DataFrame, group: Column | None = None) -> DataFrame:
    """``grp, conv_id, turn, digest, size``: each turn as 16 bytes and its text's UTF-8 size; ``grp`` keeps rows together."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    own = F.col("conv_id").cast("long")
    rows = conversations.where(own.isNotNull())
    return rows.select((own if group is None else group).alias("grp"), own.alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))


Path = tuple[int, list[tuple[bytes, int]]]


def as_they_are(group: list[Path]) -> list[Path]:
    return group


def grafted(group: list[Path]) -> list[Path]:
    """Every conversation c behind the first crc32(c) % 9 turns of conversation c - c % 5 (remainder with the sign of c)."""
    by_id = dict(group)
    out = []
    for c, own in group:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out.append((c, by_id.get(base, [])[:h] + own[h:]))
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Path]]:
    """The conversations of each ``grp``, from rows in the order of grp, conversation and turn."""
    group, now = [], None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("grp", "conv_id", "digest", "size"))
        for g, c, digest, size in zip(*columns):
            if g != now:
                if group:
                    yield group
                group, now = [], g
            if not group or group[-1][0] != c:
                group.append((c, []))
            group[-1][1].append((digest, size))
    if group:
        yield group


def child_key(parent: bytes, digest: bytes) -> bytes:
    return hashlib.blake2b(parent + digest, digest_size=16).digest()


def shard_trie(paths: list[Path]) -> list[tuple]:
    """place, parent, key, parent_key, depth, size, members, first, ends of every node of a shard, parents first.

    Bit i of a bitset is conversation i, in the order of ids.
    """
    paths = sorted(paths, key=lambda p: p[0])
    ids = [c for c, _ in paths]
    postings: dict[tuple[int, bytes], int] = {}
    long_enough: list[int] = []
    for i, (_, path) in enumerate(paths):
        bit = 1 << i
        for d, (digest, _) in enumerate(path):
            if d == len(long_enough):
                long_enough.append(0)
            long_enough[d] |= bit
            postings[d, digest] = postings.get((d, digest), 0) | bit
    out: list[tuple] = []
    stack = [((1 << len(ids)) - 1, 0, -1, ROOT, None, 0)] if ids else []
    while stack:
        members, depth, parent, key, parent_key, size = stack.pop()
        place = len(out)
        onward = members & long_enough[depth] if depth < len(long_enough) else 0
        ended, ends = members & ~onward, []
        while ended:
            low = ended & -ended
            ends.append(ids[low.bit_length() - 1])
            ended ^= low
        first = ids[(members & -members).bit_length() - 1]
        out.append((place, parent, key, parent_key, depth, size, members.bit_count(), first, ends))
        while onward:
            digest, bytes_ = paths[(onward & -onward).bit_length() - 1][1][depth]
            child = members & postings[depth, digest]
            stack.append((child, depth + 1, place, child_key(key, digest), key, bytes_))
            onward &= ~child
    return out


def _local_tries(rebuild: Callable[[list[Path]], list[Path]], shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(paths: list[Path]) -> pa.RecordBatch:
            nodes = shard_trie(paths)
            own = list(zip(*nodes))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            # The smallest id names the shard: shards are disjoint ranges of ids.
            names = [f.split()[0] for f in LOCAL.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([nodes[0][7]] * len(nodes), pa.int64()), *[pa.array(c, k) for c, k in zip(own, kinds)]], names=names)

        held, n_turns = [], 0
        for group in _groups(batches):
            held += rebuild(group)
            n_turns += sum(len(p) for _, p in group)
            if len(held) >= shard or n_turns >= SHARD_TURNS:
                yield emit(held)
                held, n_turns = [], 0
        if held:
            yield emit(held)

    return run


SHARE = "key binary, shard long, saved long, leaves long, ends array<long>"


def _subtree_shares(nodes: pa.Table) -> pa.Table:
    """One shard's nodes with ``owner`` and ``n_children``: their shares of the sums over subtrees."""
    order = np.argsort(nodes.column("place").to_numpy())
    nodes = nodes.take(pa.array(order))
    parent, size, members, first, owner, children = (nodes.column(c).to_numpy() for c in ("parent", "size", "members", "first", "owner", "n_children"))
    here = (first == owner).astype(np.int64)
    saved, leaves = (size * (members - here)).tolist(), (here * (children == 0)).tolist()
    for i in range(len(parent) - 1, 0, -1):  # parents stand first
        saved[parent[i]] += saved[i]
        leaves[parent[i]] += leaves[i]
    return pa.table({"key": nodes.column("key"), "shard": nodes.column("shard"), "saved": pa.array(saved, pa.int64()), "leaves": pa.array(leaves, pa.int64()), "ends": nodes.column("ends")})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shares of each key, from rows in the order of key and shard: sums, and one hash over all ends."""
    now, saved, leaves, hash_, any_end = None, 0, 0, None, False
    names = ["key", "saved_tokens", "n_leaves", "ends_sha256"]

    def row():
        return now, saved, leaves, hash_.hexdigest() if any_end else NO_ENDS

    def batch_of(rows):
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    done: list[tuple] = []
    for batch in batches:
        for key, s, n, ends in zip(*(batch.column(c).to_pylist() for c in ("key", "saved", "leaves", "ends"))):
            if key != now:
                if now is not None:
                    done.append(row())
                now, saved, leaves, hash_, any_end = key, 0, 0, hashlib.sha256(), False
            saved += s
            leaves += n
            if ends:
                hash_.update((("," if any_end else "") + ",".join(map(str, ends))).encode())
                any_end = True
        if len(done) >= 4096:
            yield batch_of(done)
            done = []
    if now is not None:
        done.append(row())
    if done:
        yield batch_of(done)


def prefix_trie(conversations: DataFrame, group: Column | None = None, rebuild: Callable[[list[Path]], list[Path]] = as_they_are, shard: int = SHARD) -> DataFrame:
    """Every node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``rebuild`` may change the conversations of a ``group``, whose ids must be
    a range that holds no other group's.
    """
    rows = turns(conversations, group)
    dealt = rows.repartitionByRange("grp").sortWithinPartitions("grp", "conv_id", F.col("turn").asc_nulls_first(), "digest")
    local = stored(dealt.select("grp", "conv_id", "digest", "size").mapInArrow(_local_tries(rebuild, shard), LOCAL), "trie-shards")

    merged = local.groupBy("key", "parent_key", "depth").agg(F.sum("members").alias("n_convs"), F.min("first").alias("conv_id"))
    merged = stored(merged, "trie-merged")
    children = merged.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(merged.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    owners = nodes.select("key", F.col("conv_id").alias("owner"), "n_children")
    shares = local.join(owners, "key").groupBy("shard").applyInArrow(_subtree_shares, SHARE)
    sums = shares.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_added, "key binary, saved_tokens long, n_leaves long, ends_sha256 string")

    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, "parent_key", "left").join(sums, "key")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def grafted_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """The trie of conversations rebuilt as ``grafted`` says."""
    own = F.col("conv_id").cast("long")
    return prefix_trie(conversations, own - own % 5, grafted, shard)
