"""Connected components of an edge table by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edges that one task finishes in memory (16 bytes each, some ten times that at work).
LOCAL_EDGES = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the edges (a, b), for indices 0 to n - 1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(np.asarray(x.column("a")), np.asarray(x.column("b"))) for x in batches if x.num_rows]
    if held:
        a, b = map(np.concatenate, zip(*held))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = roots(len(nodes), at[: len(a)], at[len(a) :])
        yield pa.record_batch({"node": pa.array(nodes), "component": pa.array(nodes[label])})


def _minima(edges: DataFrame) -> DataFrame:
    """(node, neighbour, least of the node and its neighbours) for both directions."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a")


def _contract(pairs: DataFrame) -> DataFrame:
    """Large star, then small star: neighbours are connected to the least one."""
    large = _minima(pairs).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
    down = large.select(F.col("b").alias("node"), F.col("a").alias("low"))
    least = down.groupBy("node").agg(F.min("low").alias("m"))
    return (
        down.join(least, "node")
        .select(F.explode(F.array("node", "low")).alias("b"), F.col("m").alias("a"))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b).

    The component is the smallest node reachable. Edges are contracted by large
    and small stars until nothing changes, or until they are few enough for one
    task of bounded memory to finish; both ways give the same. Minima are
    combined before the shuffle, so a node with very many edges is spread over
    tasks. Lineage is cut by ``checkpoint`` in the shared folder. Self-loops
    and repeated edges are allowed; an empty table gives an empty one.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    alone = pairs.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    pairs = pairs.where("a < b")
    state = None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] <= LOCAL_EDGES:
            found = pairs.coalesce(1).mapInArrow(_finish, "node bigint, component bigint")
            break
        if now == state:
            found = pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
            found = found.union(pairs.select(F.col("a").alias("node"), F.col("a").alias("component")))
            break
        state = now
        pairs = _contract(pairs).checkpoint()
    return found.union(alone).groupBy("node").agg(F.min("component").alias("component"))


def class_components(classes: DataFrame, rows: DataFrame, key: list[str], links: DataFrame) -> DataFrame:
    """(cid, component_id) of classes in a component of more than one class.

    ``classes`` have cid, rep (their smallest id) and ``key``, ``rows`` an id rid and the
    key of their class, ``links`` two cids a and b. Classes are connected by links and by
    an id that is in both; the component's id is the smallest of any of its classes.
    """
    many = rows.distinct().groupBy("rid").agg(F.count("*").alias("classes")).where("classes > 1").select("rid")
    among = rows.distinct().join(many, "rid").join(classes.select("cid", *key), key).select("rid", "cid")
    first = among.groupBy("rid").agg(F.min("cid").alias("first"))
    shared = among.join(first, "rid").select(F.col("first").alias("a"), F.col("cid").alias("b"))
    found = components(links.union(shared).where("a <> b")).withColumnRenamed("node", "cid")
    joined = found.join(classes.select("cid", "rep"), "cid")
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    return joined.join(least, "component").select("cid", "component_id")
