"""Connected components and pair verification, shared by the near-duplicate operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerwave.llm.common import maybe_broadcast
from ledgerwave.session import stored

# Members that one task compares with a hub; larger stars are dealt out.
STAR = 512


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b).

    Alternating large and small stars: each round hangs nodes under smaller
    ones, and the number of rounds grows with the logarithm of the longest chain.
    Rounds are written to the shared folder. Nodes without edges are absent.
    """
    now = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        if (after := state(now)) == seen:
            break
        seen = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def verified(pairs: DataFrame, texts: DataFrame, sets: Callable, alike: Callable) -> DataFrame:
    """The pairs (a, b) whose texts ``alike(sets(text_a), sets(text_b))``.

    ``texts`` has id and text. A hub ``a`` meets its members in a stream: rows
    are sorted so that the hub comes first, and a task holds one hub at a time.
    Hubs with many members are repeated over several groups.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    hubs = stored(
        pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / STAR).alias("deals")), "hubs"
    )
    dealt = stored(
        pairs.join(hubs, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("deals")).alias("deal")), "dealt"
    )
    seats = hubs.select("a", F.explode(F.expr("sequence(0L, deals - 1)")).alias("deal"))
    of = texts.select("id", "text")
    members = of.join(maybe_broadcast(dealt), of["id"] == dealt["b"]).select("a", "deal", F.lit(1).alias("side"), "b", "text")
    centres = of.join(maybe_broadcast(seats), of["id"] == seats["a"]).select(
        "a", "deal", F.lit(0).alias("side"), F.col("a").alias("b"), "text"
    )
    rows = members.unionByName(centres).repartition("a", "deal").sortWithinPartitions("a", "deal", "side", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, hub = None, []
        for batch in batches:
            found_a, found_b = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "deal", "side", "b")]
            for a, deal, side, b, text in zip(*columns, batch.column("text").cast(pa.binary()), strict=True):
                if here != (a, deal):
                    here, hub = (a, deal), []
                own = sets(text.as_py())
                if side == 0:
                    hub.append(own)
                elif any(alike(h, own) for h in hub):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()
