"""Hard negatives by exact matrix products in a residue number system.

Vectors become whole numbers, floor(256 * x). The inner products of a block of
rows with a batch of anchors are taken modulo several small primes: residues lie
in -p/2 ... p/2, so float32 sums over CHUNK dimensions stay below 2^24 and are
exact. The signed score follows by Chinese remaindering, with as many primes as
the largest vector asks for (Cauchy-Schwarz), so nothing is rounded and the
order, ties included, is that of the true scores.

Rows are dealt by hash to blocks of bounded size; the anchors, one row in a
hundred, go to every block. A task holds one block at a time, the anchors stream past
it, and only the best few of a block leave the task. Two such passes: the first
finds the positives, the second the rows inside each positive's window of
scores; windows over the few that are left give the ranks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerwave.session import stored

SCALE = 256
ANCHORS = 100  # every row whose vec_id this divides is an anchor
POSITIVES = 5  # positives of an anchor
NEGATIVES = 5  # negatives of an anchor and positive
LOW, OF = 80, 100  # a negative has from LOW / OF of the positive's score up to all of it
CELLS = 2**20  # vector components in a block of rows
SCORES = 2**21  # scores worked on at a time

TOP_PRIME = 509
CHUNK = 2**24 // (TOP_PRIME // 2) ** 2  # dimensions summed exactly in float32


def primes_for(bound: int) -> list[int]:
    """Primes from 509 down whose product exceeds the range -bound ... bound."""
    found, product, p = [], 1, TOP_PRIME
    while product <= 2 * bound:
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def residues(vectors: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers, as float32 from -p/2 to p/2."""
    return ((vectors + p // 2) % p - p // 2).astype(np.float32)


def exact_products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of all rows of two matrices that are given by residues.

    Garner's form of Chinese remaindering: each prime adds one digit to the
    number that has all residues so far.
    """
    out, unit = None, 1
    for p, a, b in zip(primes, left, right, strict=True):
        rest = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], CHUNK):
            rest += (a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int64)
        if out is None:
            out = rest % p
        else:
            out += (rest - out) % p * pow(unit, -1, p) % p * unit
        unit *= p
    return np.where(out > unit // 2, out - unit, out)


def best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k of the places ``at`` with the highest scores; of equals the first."""
    if len(at) > k:
        values = scores[at]
        edge = np.partition(values, len(values) - k)[len(values) - k]
        above = at[values > edge]
        at = np.concatenate([above, at[values == edge][: k - len(above)]])
    return at[np.lexsort((at, -scores[at]))]


def usable(vectors: DataFrame) -> DataFrame:
    """id, label, v (vector of doubles) of the rows that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select(
        F.col("vec_id").cast("long").alias("id"), moved.cast("long").alias("label"), doubles.alias("v")
    ).where("id is not null and label is not null and v is not null").where(finite)


def _places(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    lists = batch.column("vec")
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < np.diff(lists.offsets.to_numpy())[:, None]] = lists.flatten().to_numpy()
    return out


def _past_blocks(
    rows: DataFrame, anchors: DataFrame, dims: int, primes: list[int], blocks: int, choose: Callable
) -> DataFrame:
    """anchor, anchor_row, slot, id, row_, score of what ``choose`` takes.

    ``rows`` has block, id, label, row_, vec; ``anchors`` id, label, row_, vec and
    ``wanted``, a list of scores. ``choose(anchor, held, scores)`` gets the scores of
    one anchor with a block's rows, held as arrays in the order of id and row_,
    and returns pairs of a slot and places.
    """
    own = rows.select("block", F.lit(0).alias("side"), "id", "row_", "label", "vec", F.lit(None).cast("array<bigint>").alias("wanted"))
    dealt = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), "id", "row_", "label", "vec", "wanted"
    )
    streamed = own.unionByName(dealt).repartition(blocks, "block").sortWithinPartitions("block", "side", "id", "row_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, held, matrices = None, [], None, []
        for batch in batches:
            kind = np.stack([batch.column(c).to_numpy() for c in ("block", "side")], axis=1)
            edges = [0, *(np.flatnonzero((kind[1:] != kind[:-1]).any(axis=1)) + 1), len(kind)]
            for lo, hi in zip(edges, edges[1:]):
                piece = batch.slice(lo, hi - lo)
                keys = [piece.column(c).to_numpy() for c in ("id", "row_", "label")]
                vec = _places(piece, dims)
                if kind[lo, 0] != here:
                    here, parts, held = kind[lo, 0], [], None
                if kind[lo, 1] == 0:
                    parts.append((*keys, vec))
                    continue
                if held is None:
                    if not parts:
                        continue  # no row fell into this block
                    *held, vectors = (np.concatenate(c) for c in zip(*parts))
                    parts, matrices = [], [residues(vectors, p) for p in primes]
                wanted = piece.column("wanted").to_pylist()
                step = max(1, SCORES // len(held[0]))
                for at in range(0, len(vec), step):
                    scores = exact_products([residues(vec[at : at + step], p) for p in primes], matrices, primes)
                    yield _chosen(choose, keys, wanted, at, held, scores)

    return streamed.mapInArrow(run, "anchor bigint, anchor_row bigint, slot bigint, id bigint, row_ bigint, score bigint")


def _chosen(choose: Callable, keys: list, wanted: list, at: int, held: list, scores: np.ndarray) -> pa.RecordBatch:
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    for k, line in enumerate(scores, at):
        for slot, places in choose((keys[0][k], keys[1][k], keys[2][k], wanted[k]), held, line):
            n = len(places)
            new = [np.full(n, keys[0][k]), np.full(n, keys[1][k]), np.full(n, slot, np.int64), held[0][places], held[1][places], line[places]]
            for c, x in zip(columns, new):
                c.append(x)
    made = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(made, ["anchor", "anchor_row", "slot", "id", "row_", "score"])


def _positives(anchor: tuple, held: list, scores: np.ndarray) -> list:
    ids, rows, labels = held
    same = (labels == anchor[2]) & ~((ids == anchor[0]) & (rows == anchor[1]))
    return [(0, best(scores, np.flatnonzero(same), POSITIVES))]


def _negatives(anchor: tuple, held: list, scores: np.ndarray) -> list:
    wanted = anchor[3]
    scaled = scores * OF
    near = np.flatnonzero((held[2] != anchor[2]) & (scaled >= LOW * min(wanted)) & (scores <= max(wanted)))
    found = []
    for slot, positive in enumerate(wanted):
        inside = near[(scaled[near] >= LOW * positive) & (scores[near] <= positive)]
        found.append((slot, best(scores, inside, NEGATIVES)))
    return found


def _first(scored: DataFrame, k: int) -> DataFrame:
    """The first k of every anchor and slot, with their rank."""
    order = Window.partitionBy("anchor", "anchor_row", "slot").orderBy(F.desc("score"), "id", "row_")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label; other columns are left alone.
    Rows with a null vec_id, label or vector, or any null, NaN or infinite component
    take no part; vec_ids divisible by 7 have the label after their own, of ten.
    Shorter vectors count as filled up with zeros. Anchors are the rows whose
    vec_id is divisible by 100, their positives the first five other rows of their
    label by score, ties by smaller vec_id. Rows equal in vec_id, label and vector
    count once; others that share a vec_id are rows of their own, ties between
    them going by a hash. Negative ranks run from 1 among those returned; an anchor
    without positives, or a positive without rows in its window (as any with a
    score below zero), returns nothing. Vectors so long that 100 times a score
    could pass 62 bits raise ValueError.
    """
    wide = usable(vectors).select(
        "id", "label", "v", F.size("v").alias("dims"), F.aggregate("v", F.lit(0.0), lambda s, x: s + SCALE * x * SCALE * x).alias("norm")
    )
    dims, norm = wide.agg(F.max("dims"), F.max("norm")).first()
    dims, norm = max(dims or 1, 1), norm or 0.0
    bound = (math.sqrt(norm) + math.sqrt(dims)) ** 2 * (1 + 1e-9) + 1
    if bound * OF >= 2**62:
        raise ValueError("embedding: scores would pass 64 bits")
    bound = int(bound)
    whole = F.transform("v", lambda x: F.floor(x * SCALE))
    rows = stored(
        wide.select("id", "label", whole.alias("vec")).distinct().withColumn("row_", F.xxhash64("id", "label", "vec")), "vectors"
    )
    blocks = max(1, math.ceil(rows.count() * dims / CELLS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row_"), F.lit(blocks)).cast("int"))
    primes = primes_for(bound)
    anchors = stored(rows.where(F.col("id") % ANCHORS == 0).select("id", "label", "row_", "vec"), "anchors")

    none = F.lit(None).cast("array<bigint>")
    met = _past_blocks(rows, anchors.withColumn("wanted", none), dims, primes, blocks, _positives)
    positives = stored(_first(met, POSITIVES), "positives")
    lists = positives.groupBy("anchor", "anchor_row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("wanted")
    )
    asked = anchors.join(lists, (anchors["id"] == lists["anchor"]) & (anchors["row_"] == lists["anchor_row"]))
    taken = _first(_past_blocks(rows, asked.select(*anchors.columns, "wanted"), dims, primes, blocks, _negatives), NEGATIVES)
    named = positives.select(
        "anchor", "anchor_row", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return taken.join(named, ["anchor", "anchor_row", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as q
  from embeddings
  where label is not null and embedding is not null
    and list_bool_and([x is not null and isfinite(x) for x in embedding])),
s as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, list_dot_product(a.q, r.q)::bigint as score
  from v a join v r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
p as (
  select * from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
  row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id)::int as rank,
  s.id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
  and 80 * p.score <= 100 * s.score and s.score <= p.score
qualify rank <= 5
"""
