"""Written stages in the shared folder, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="retrolane-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FOREST_EDGES = 2_000_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replaces a partition's edges by (node, smallest node) stars, in runs of bounded size."""
    parent: dict[int, int] = {}
    seen = 0

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def stars() -> pd.DataFrame:
        rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
        return pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        seen += len(batch)
        if seen >= FOREST_EDGES:
            yield stars()
            parent.clear()
            seen = 0
    yield stars()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step: links each node's neighbours to the smallest of them."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        moved = edges.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b) between longs; the component is its smallest node.

    Nodes without an edge to another node have no row. Edges are contracted inside each
    partition, then alternate large-star and small-star steps run until nothing moves; each
    step is written to the shared folder.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(edges.mapInPandas(_forest, "a long, b long").where("a <> b").distinct(), "stars")
    mark = None
    while True:
        moved = stage(_star(_star(edges, large=True), large=False), "stars")
        total = moved.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = moved
        if tuple(total) == mark or total[0] == 0:
            break
        mark = tuple(total)
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
