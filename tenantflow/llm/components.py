"""Connected components of a graph given as a table of links.

Large-star and small-star steps in turn: each makes the neighbours of a node point to the
smallest of them, until every node points to the smallest node that it can reach. Every
step is an aggregate with map-side combining and a join against one row per node. The links
of a node with very many of them are joined where they lie. Each round is written to the shared
folder, which cuts the lineage; nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.session import staged

_HOT = 1000


def _to_smallest(links: DataFrame, n_links: int) -> DataFrame:
    """For each row (u, v) the smallest of u and all v of u, as m.

    Nodes with more than a share of 1 / ``_HOT`` of the links are so few that their rows
    go to all tasks; their links stay where they are.
    """
    least = links.groupBy("u").agg(F.min("v").alias("v_least"), F.count("*").alias("degree"))
    least = least.select("u", F.least("u", "v_least").alias("m"), (F.col("degree") * _HOT > n_links).alias("hot"))
    hot = least.where("hot").select("u", F.col("m").alias("hot_m"))  # at most 2 * _HOT rows
    marked = links.join(F.broadcast(hot), "u", "left")
    cold = marked.where("hot_m is null").select("u", "v").join(least.where("not hot").select("u", "m"), "u")
    return marked.where("hot_m is not null").select("u", "v", F.col("hot_m").alias("m")).union(cold.select("u", "v", "m"))


def _end(u: str, v: str) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(v).alias("v"))


def _large_star(links: DataFrame, n_links: int) -> DataFrame:
    both = links.select(F.inline(F.array(_end("u", "v"), _end("v", "u"))))
    return _to_smallest(both, n_links).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, n_links: int) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pointed = _to_smallest(down, n_links)
    return pointed.select(F.inline(F.array(_end("v", "m"), _end("u", "m"))))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the two columns of ``links`` that has a smaller root.

    Null ends, links of a node with itself and repeated links are harmless. Nodes that
    are a root themselves have no row.
    """
    links = links.toDF("u", "v").where("u <> v")
    links = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while state[0]:
        turned = _large_star(links, state[0])
        links = staged(_small_star(turned, state[0]).where("u <> v").distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.toDF("node", "root")
