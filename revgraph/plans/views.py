"""The graphs as SQL views, with the sample questions as SQL text.

The original project left graph questions to a graph browser; here the
graph tables are temporary views and the questions are Spark SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from revgraph.sources.store import read_graph

# Outgoing edges per node; stubs and pages without links get 0.
OUT_DEGREE = """
SELECT n.title, n.year, COALESCE(e.out_degree, 0) AS out_degree
FROM {nodes} n LEFT JOIN (
  SELECT src, year, COUNT(dst) AS out_degree FROM {edges} GROUP BY src, year
) e ON e.src = n.title AND e.year = n.year
"""

# Undirected neighbourhood: each edge seen from both ends, self-links once.
NEIGHBOURS = """
SELECT DISTINCT title, year, neighbour FROM (
  SELECT src AS title, year, dst AS neighbour FROM {edges}
  UNION ALL
  SELECT dst AS title, year, src AS neighbour FROM {edges}
) t
"""

# Strongest k edges of each year, ties broken by endpoints.
TOP_EDGES = """
SELECT year, rank, src, dst, weight FROM (
  SELECT year, src, dst, weight,
         ROW_NUMBER() OVER (PARTITION BY year ORDER BY weight DESC, src, dst) AS rank
  FROM {edges}
) t WHERE rank <= {k}
"""

SAMPLES = {"out_degree": OUT_DEGREE, "neighbours": NEIGHBOURS, "top_edges": TOP_EDGES}


def register_graph_views(tables: dict[str, DataFrame], prefix: str | None = None) -> dict[str, str]:
    """Register each table as a temp view for ad-hoc SQL; returns table name
    -> view name. A fresh prefix keeps concurrent callers in one session apart.
    """
    prefix = prefix if prefix is not None else f"g{uuid.uuid4().hex[:8]}_"
    names = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names


def run_sample(spark: SparkSession, name: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """Run a sample question on graph tables given as DataFrames.

    Spark binds each DataFrame to a view only while the statement is
    analysed, so nothing stays registered in the session.
    """
    return spark.sql(SAMPLES[name], **tables, **params)


def ask(spark: SparkSession, graph_path: str, question: str, fmt: str = "parquet", **params) -> DataFrame:
    """A question to stored graphs: the name of a sample or SQL text with ``{nodes}``, ``{edges}``, ``{word_edges}``,
    ``{category_nodes}`` and ``{cliques}`` in the place of tables."""
    text = SAMPLES.get(question, question)
    tables = {name: df for name, df in read_graph(spark, graph_path, fmt=fmt).items() if "{" + name + "}" in text}
    return spark.sql(text, **tables, **params)
