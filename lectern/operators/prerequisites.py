"""Topic order from prerequisite pairs.

Topics are taken out of the graph step by step, and put back in reverse order. A topic with ``a`` prerequisites and
``b`` dependants may go if a * b <= a + b: its links are replaced by one from each of the former to each of the latter,
with the lengths added up, so the graph never grows. That covers topics without prerequisites or dependants, runs,
trees, and lattices such as ladders. In each step all such topics go that have no such neighbour of smaller draw, a
constant share of them, so a path of n topics takes about log n steps and not n. What is left when the graph is small
is solved in one task. Then each step's topics get their values from their neighbours at that time.

Every step joins, so a side that is small enough for a broadcast in each of them would add up on the driver; the joins
of the graph are merge joins, and rows without a neighbour take no part in them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lectern.session import scratch_path, stage

#: A graph of at most so many links is solved in one task.
LOCAL_LINKS = 200_000


class _Elimination:
    """Links are (before, after, weight); ``before`` NULL says that ``after`` has at least level ``weight``.

    Every topic has such a link from the start, so none is lost with its last neighbour. All steps are written below
    one folder: ``links``, ``marked`` (a step's links, and which of their ends go) and ``values``.
    """

    def __init__(self, pairs: DataFrame, local_links: int):
        self.spark, self.local_links = pairs.sparkSession, local_links
        self.root = scratch_path(self.spark, "prerequisites")
        self.node_type = pairs.schema["before"].dataType.simpleString()
        topics = _ends(pairs).select(F.lit(None).cast(self.node_type).alias("before"), F.col("topic").alias("after"), F.lit(0).alias("weight"))
        self.step = 0
        self.links, self.n_links = self._written(pairs.withColumn("weight", F.lit(1)).unionByName(topics), "links")

    def _written(self, df: DataFrame, kind: str, *counted: str) -> tuple[DataFrame, int]:
        """``df`` below ``kind`` of this step, and how many of its rows satisfy ``counted`` (all, if not given)."""
        path, seen = f"{self.root}/{kind}/step={self.step}", Observation()
        df.observe(seen, F.count_if(F.expr(counted[0] if counted else "true")).alias("rows")).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get.get("rows") or 0

    def _chosen(self) -> DataFrame:
        """Topics that go in this step: no two of them are neighbours."""
        proper = self.links.select(
            "before", "after", (F.col("before") == F.col("after")).alias("loop")).withColumn("link", F.coalesce(~F.col("loop"), F.lit(False)).cast("long"))
        ends = proper.select(F.explode(F.array(
            F.struct(F.col("before").alias("node"), F.lit(0).cast("long").alias("into"), F.col("link").alias("out"), "loop"),
            F.struct(F.col("after").alias("node"), F.col("link").alias("into"), F.lit(0).cast("long").alias("out"), "loop"))).alias("e")).select(
            "e.*").filter("node IS NOT NULL")
        # Products of degrees may pass 64 bits at a hub.
        may_go = ends.groupBy("node").agg(F.sum("into").alias("into"), F.sum("out").alias("out"), F.max("loop").alias("loop")).filter(
            "NOT coalesce(loop, false) AND (into <= 1 OR out <= 1 OR (into = 2 AND out = 2))")
        draws = may_go.select("node", F.struct(
            ((F.col("into") > 0) & (F.col("out") > 0)).alias("inner"), F.xxhash64("node", F.lit(self.step)).alias("draw"), F.col("node").alias("tie")).alias("rank"))
        a, b = (draws.select(F.col("node").alias(f"node_{s}"), F.col("rank").alias(f"rank_{s}")) for s in "ab")
        later = F.when(F.col("rank_a") < F.col("rank_b"), F.col("node_b")).otherwise(F.col("node_a"))
        stay = proper.filter("link = 1").join(_merged(a), F.col("before") == F.col("node_a")).join(
            _merged(b), F.col("after") == F.col("node_b")).select(later.alias("node")).distinct()
        return draws.select("node").join(_merged(stay), "node", "left_anti")

    def run(self) -> None:
        while self.n_links > self.local_links:
            chosen = stage(self._chosen(), "chosen-topics")
            first, last = (chosen.select(F.col("node").alias(f"_{s}")) for s in ("first", "last"))
            firsts = self.links.filter("before IS NOT NULL").join(_merged(first), F.col("before") == F.col("_first"), "left").select(
                "before", "after", "weight", F.col("_first").isNotNull().alias("first_goes")).unionByName(
                self.links.filter("before IS NULL").withColumn("first_goes", F.lit(False)))
            flagged = firsts.join(_merged(last), F.col("after") == F.col("_last"), "left").select(
                "before", "after", "weight", "first_goes", F.col("_last").isNotNull().alias("last_goes"))
            marked, going = self._written(flagged, "marked", "first_goes OR last_goes")
            if not going:
                break
            self.step += 1
            into = marked.filter("last_goes").select(F.col("before").alias("u"), F.col("after").alias("v"), F.col("weight").alias("w"))
            out = marked.filter("first_goes").select(F.col("before").alias("v"), F.col("after").alias("x"), F.col("weight").alias("y"))
            joined = into.join(_merged(out), "v").select(F.col("u").alias("before"), F.col("x").alias("after"), (F.col("w") + F.col("y")).alias("weight"))
            stay = marked.filter("NOT first_goes AND NOT last_goes").select("before", "after", "weight")
            self.links, self.n_links = self._written(
                stay.unionByName(joined).groupBy("before", "after").agg(F.max("weight").alias("weight")), "links")

    def solve(self) -> DataFrame:
        """(node, level, held, holds): the level, if no cycle is before the topic; whether one is before, behind it."""
        shape = f"node {self.node_type}, level int, held boolean, holds boolean"
        if self.n_links > self.local_links:
            # Nothing could go, so every topic left has links on both sides: it lies on or between cycles.
            values = self.links.select(F.col("after").alias("node")).distinct().select(
                "node", F.lit(None).cast("int").alias("level"), F.lit(True).alias("held"), F.lit(True).alias("holds"))
        else:
            values = self.links.coalesce(1).mapInPandas(_solved_locally, shape)
        self._written(values, "values")
        while self.step:
            self.step -= 1
            marked = self.spark.read.schema(f"before {self.node_type}, after {self.node_type}, weight int, first_goes boolean, last_goes boolean").parquet(
                f"{self.root}/marked/step={self.step}")
            known = self.spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{self.root}/values").withColumnRenamed("node", "other")
            sides = marked.filter("last_goes").selectExpr("after AS node", "before AS other", "weight").unionByName(
                marked.filter("first_goes").selectExpr("before AS node", "after AS other", "CAST(NULL AS int) AS weight"))
            least = sides.filter("other IS NULL").select(
                "node", "weight", F.lit(0).alias("level"), F.lit(None).cast("boolean").alias("held"), F.lit(None).cast("boolean").alias("holds"))
            beside = sides.filter("other IS NOT NULL").join(_merged(known), "other", "left").select("node", "weight", "level", "held", "holds")
            back = beside.unionByName(least).groupBy("node").agg(
                F.max(F.col("weight") + F.col("level")).cast("int").alias("level"),
                F.coalesce(F.bool_or(F.col("held") & F.col("weight").isNotNull()), F.lit(False)).alias("held"),
                F.coalesce(F.bool_or(F.col("holds") & F.col("weight").isNull()), F.lit(False)).alias("holds"))
            self._written(back.withColumn("level", F.when(~F.col("held"), F.col("level"))), "values")
        return self.spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{self.root}/values")


def _solved_locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Values of all topics of a small graph, freed one after the other from both ends."""
    least: dict = {}
    after, before = defaultdict(list), defaultdict(list)
    for batch in batches:
        for u, v, w in zip(batch["before"], batch["after"], batch["weight"].tolist(), strict=True):
            if pd.isna(u):
                least[v] = max(w, least.get(v, 0))
            else:
                after[u].append((v, w))
                before[v].append((u, w))

    def freed(onward: dict, backward: dict) -> dict:
        waiting = {node: len(backward[node]) if node in backward else 0 for node in least}
        levels, ready = dict(least), [node for node, n in waiting.items() if not n]
        done = {}
        while ready:
            node = ready.pop()
            done[node] = levels[node]
            for other, weight in onward.get(node, ()):
                levels[other] = max(levels[other], done[node] + weight)
                waiting[other] -= 1
                if not waiting[other]:
                    ready.append(other)
        return done

    levels, ends = freed(after, before), freed(before, after)
    nodes = list(least)
    if nodes:
        yield pd.DataFrame({
            "node": nodes, "level": pd.array([levels.get(n) for n in nodes], "Int32"),
            "held": [n not in levels for n in nodes], "holds": [n not in ends for n in nodes]})


def _merged(side: DataFrame) -> DataFrame:
    """``side`` of a join that sends nothing to the driver."""
    return side.hint("merge")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("before").alias("topic")).unionByName(pairs.select(F.col("after").alias("topic"))).distinct()


def prerequisite_levels(edges: DataFrame, topics: DataFrame | None = None, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(topic, level, status) for pairs (prerequisite, topic), and for the topics of ``topics`` (topic) if given.

    The level is the longest chain of prerequisites; a topic without one, also if that is said by a NULL, has level
    0. Topics of a cycle, or between two cycles, have status ``cycle`` and no level; topics behind one have status
    ``blocked``. ``local_links`` bounds the graph that one task solves at the end.
    """
    named = edges.filter("topic IS NOT NULL")
    pairs = stage(named.filter("prerequisite IS NOT NULL").select(
        F.col("prerequisite").alias("before"), F.col("topic").alias("after")).distinct(), "pairs")
    graph = _Elimination(pairs, local_links)
    graph.run()
    result = graph.solve().select(
        F.col("node").alias("topic"), "level",
        F.when(~F.col("held"), "ordered").when(F.col("holds"), "cycle").otherwise("blocked").alias("status"))
    alone = named.select("topic")
    if topics is not None:
        alone = alone.unionByName(topics.select("topic").filter("topic IS NOT NULL"))
    rest = alone.distinct().join(_merged(_ends(pairs)), "topic", "left_anti").select("topic", F.lit(0).alias("level"), F.lit("ordered").alias("status"))
    return result.unionByName(rest)
