"""Command line: the jobs of the original project, as Spark jobs.

    python -m revgraph ingest <dump dir or files...> --store <path>
    python -m revgraph graphs --store <path> --out <path> [--uncategorised] [--merge]
    python -m revgraph ask <sample or SQL> --graphs <path>
    python -m revgraph compact --store <path> [--vacuum]
    python -m revgraph stream <dump glob> --store <path> --checkpoint <path>
    python -m revgraph export --store <path> --out <path>

Cluster settings (master, executors, checkpoint folder) come from
``spark-submit`` / ``spark-defaults.conf``. When those set no shuffle
partition count, it follows from the bytes of the dump files (``ingest``,
``stream``) or from the word rows that the edges walk (``graphs``).
"""

from __future__ import annotations

import argparse

from revgraph.plans.graphs import build_graphs, export_pages, ingest
from revgraph.plans.views import ask
from revgraph.session import get_session, size_shuffle_partitions
from revgraph.sources.store import compact, vacuum
from revgraph.streaming.ingest import ingest_stream


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="revgraph")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="XML dump -> year-page store (first write wins)")
    a.add_argument("dump", nargs="+")
    a.add_argument("--store", required=True)
    a.add_argument("--format", default="parquet", choices=["parquet", "json"])
    g = sub.add_parser("graphs", help="year-page store -> link, word and category graph tables")
    g.add_argument("--store", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--format", default="parquet", choices=["parquet", "json"])
    g.add_argument("--uncategorised", action="store_true", help="one clique of the pages without a category, per year")
    g.add_argument("--merge", action="store_true", help="bring tables that are there up to date with pages stored since")
    q = sub.add_parser("ask", help="a question to stored graphs: out_degree, neighbours, or SQL with {nodes}, {edges}, ...")
    q.add_argument("question")
    q.add_argument("--graphs", required=True)
    c = sub.add_parser("compact", help="fold the store's batches into one")
    c.add_argument("--store", required=True)
    c.add_argument("--format", default="parquet", choices=["parquet", "json"])
    c.add_argument("--vacuum", action="store_true", help="remove replaced folders, when no reader is left on them")
    s = sub.add_parser("stream", help="ingest new dump files as they arrive")
    s.add_argument("dump")
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--every", default=None, help="processing-time trigger, e.g. '5 minutes'; default: run once")
    s.add_argument("--max-files", type=int, default=None, help="files of a micro-batch; default: all that are new")
    x = sub.add_parser("export", help="year-page store -> JSON rows of the original bean's shape, by year")
    x.add_argument("--store", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--format", default="parquet", choices=["parquet", "json"])
    args = ap.parse_args(argv)

    spark = get_session("revgraph-" + args.cmd)
    if args.cmd == "ingest":
        size_shuffle_partitions(spark, args.dump)
        rejected = ingest(spark, args.dump, args.store, fmt=args.format)
        print(f"rejected revisions: {rejected}")
    elif args.cmd == "graphs":
        build_graphs(spark, args.store, args.out, fmt=args.format, include_uncategorised=args.uncategorised, mode="merge" if args.merge else "overwrite")
    elif args.cmd == "ask":
        ask(spark, args.graphs, args.question).show(100, truncate=False)
    elif args.cmd == "compact":
        print(f"new batch: {compact(spark, args.store, args.format)}")
        if args.vacuum:
            print(f"removed: {len(vacuum(spark, args.store))}")
    elif args.cmd == "export":
        export_pages(spark, args.store, args.out, fmt=args.format)
    else:
        size_shuffle_partitions(spark, args.dump)
        ingest_stream(
            spark, args.dump, args.store, args.checkpoint, processing_time=args.every, max_files_per_trigger=args.max_files
        ).awaitTermination()


if __name__ == "__main__":
    main()
