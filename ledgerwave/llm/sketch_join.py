"""N-gram Jaccard self-join by parity sketches.

A document is the set of its 5-word shingles. Each shingle is XORed, as a 64-bit
hash, into one word of a sketch: shingles that two documents share cancel, and a
shingle of only one of them changes one word. So the number of differing words
(the Hamming distance of the sketches, by words) never exceeds the symmetric
difference of the sets, and that is at most (|A| + |B|) / 9 when Jaccard reaches
0.8. A sketch with more filled words than this bound must share a filled word
with every partner (pigeonhole). Documents meet on equal words, per band of set
sizes, each size going to its own band and, near the top, to the next one.

Three measures keep groups small and the join exact:

- equal sets are one class, found by a map-side combined aggregation;
- frequent shingles (a bounded Misra-Gries summary, merged over all tasks) are
  left out of the sketches. This only lowers the difference, so the bound holds
  for any choice of shingles that is the same for all documents. The choice goes
  by levels: level k keeps shingles with less than FREQUENT * 2^k occurrences;
- a document whose sketch has too few filled words at one level also meets at
  the next, and, if even its whole set has too few, by its smallest hashes (prefix
  filter). Of two documents, the one that needs fewer levels has enough words at
  its last, where the other meets it too; so no pair is lost.

Rows under one word are linked through the smallest document of the group (a
star), not in pairs; verified stars merge into components, and only pairs that
still lie in different components are compared further.

Meeting is cheap, reading two texts is not. So every set also has one parity bit
for each of BITS residues: the Hamming distance of these bits never exceeds the
symmetric difference either, and pairs whose distance passes (|A| + |B|) / 9 are
dropped where they meet, before they are rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from ledgerwave.llm.graph import components, verified
from ledgerwave.llm.shingles import ALIKE, OF, mixed, shingles, similar
from ledgerwave.session import stored

# Bounds of the summary of frequent shingles: counters held per task, and
# shingles kept in the end. FREQUENT is the least count of those.
COUNTERS = 100_000
KEPT = 500_000
FREQUENT = 20

BITS = 1024  # of the sketch that rules pairs out; 16 words of 64

# Lower limits of the size bands, each half as large again as the one before.
BANDS = [1]
while BANDS[-1] < 2**40:
    BANDS.append(max(BANDS[-1] + 1, BANDS[-1] * 3 // 2))
_BANDS = np.array(BANDS)


def most_differing(n: int, top: int) -> int:
    """Largest symmetric difference of a set of n and one of at most ``top``
    elements whose similarity reaches the threshold."""
    return (n + min(top, n * OF // ALIKE)) * (OF - ALIKE) // (OF + ALIKE)


def sketch_size(band: int) -> int:
    top = BANDS[band + 1] - 1
    d = most_differing(top, top)
    return d + 1 + d // 20 + 3


def _filled(tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the words that hold any shingle."""
    slot = (tokens >> np.uint64(20)) % np.uint64(size)
    order = np.argsort(slot, kind="stable")
    slot, tokens = slot[order], tokens[order]
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.empty(0, int)
    return slot[first], np.bitwise_xor.reduceat(tokens, first) if len(first) else tokens


def _keys(slots: np.ndarray, values: np.ndarray, band: int, space: int) -> np.ndarray:
    salt = mixed(slots * np.uint64(1 << 14) + np.uint64(band * 64 + space) + np.uint64(1))
    return mixed(values ^ salt)


class Frequent:
    """Sorted frequent shingles and, for each, the level from which it counts."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens, kind="stable")
        self.tokens = tokens[order]
        self.level = 1 + np.log2(np.maximum(counts[order], FREQUENT) / FREQUENT).astype(np.int8)

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int8)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.level[at], 0)

    @property
    def last(self) -> int:
        return int(self.level.max(initial=0))


def meeting_keys(tokens: np.ndarray, frequent: Frequent) -> np.ndarray:
    """The keys under which a set meets every set that is similar to it."""
    n = len(tokens)
    own = int(np.searchsorted(_BANDS, n, side="right")) - 1
    bands = [own] + [own + 1] * (OF * n >= ALIKE * BANDS[own + 1])
    level = frequent.levels(tokens)
    out = []
    for band in bands:
        d = most_differing(n, BANDS[band + 1] - 1)
        if d == 0:
            continue  # only equal sets are similar, and these are one class
        for k in range(frequent.last + 1):
            slots, values = _filled(tokens[level <= k], sketch_size(band))
            out.append(_keys(slots, values, band, k))
            if len(slots) > d:
                break
        else:
            prefix = tokens[: n - -(-ALIKE * n // OF) + 1]
            out.append(_keys(np.zeros(len(prefix), np.uint64), prefix, 0, 63))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64), pa.int64())


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    for x in batch.column("text").cast(pa.binary()):
        yield x.as_py()


def _summarize(tokens: np.ndarray, counts: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge more shingles into a Misra-Gries summary of at most COUNTERS."""
    got, n = np.unique(more, return_counts=True)
    both, back = np.unique(np.concatenate([tokens, got]), return_inverse=True)
    total = np.zeros(len(both), np.int64)
    np.add.at(total, back, np.concatenate([counts, n]))
    if len(both) > COUNTERS:
        total -= np.partition(total, len(total) - COUNTERS - 1)[len(total) - COUNTERS - 1]
    return both[total > 0], total[total > 0]


def parity(tokens: np.ndarray) -> np.ndarray:
    """BITS parity bits of a set, as whole numbers of 64."""
    odd = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def describe_sets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n, one, two (a 128-bit name of the set), bits. In
    further rows, with n null: shingle ``one`` counted ``two`` times."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
        ("bits", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            size, one, two, bits, pool, pooled = [], [], [], [], [], 0
            for text in _texts(batch):
                s = shingles(text)
                size.append(len(s))
                one.append(np.bitwise_xor.reduce(s) if len(s) else np.uint64(0))
                two.append(mixed(s).sum(dtype=np.uint64))
                bits.append(parity(s))
                pool.append(s)
                pooled += len(s)
                if pooled > 2_000_000:
                    tokens, counts = _summarize(tokens, counts, np.concatenate(pool))
                    pool, pooled = [], 0
            if pool:
                tokens, counts = _summarize(tokens, counts, np.concatenate(pool))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(size, pa.int64()), _longs(one), _longs(two),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                schema=schema,
            )
        often = counts > 1
        none = pa.nulls(int(often.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                none, none, _longs(tokens[often]), pa.array(counts[often], pa.int64()),
                pa.nulls(len(none), pa.list_(pa.int64())),
            ],
            schema=schema,
        )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id bigint, n bigint, one bigint, two bigint, bits array<bigint>"
    )


_WORDS = [f"b{i}" for i in range(BITS // 64)]


def _near_enough(a: str, b: str) -> str:
    """SQL: the bits of two rows do not rule out that their sets are similar."""
    distance = " + ".join(f"bit_count(b{i}_{a} ^ b{i}_{b})" for i in range(BITS // 64))
    return f"({distance}) * {OF + ALIKE} <= (n_{a} + n_{b}) * {OF - ALIKE}"


def _meetings(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """key, id: one row per key of each set. Within a task a set that came before
    is not repeated; its class is known from ``describe_sets``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: set[bytes] = set()
        for batch in batches:
            ids, keys = [], []
            held = 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True):
                if doc is None:
                    continue
                s = shingles(text)
                name = np.array([len(s), np.bitwise_xor.reduce(s) if len(s) else 0, mixed(s).sum(dtype=np.uint64)], np.uint64).tobytes()
                if name in before:
                    continue
                before.add(name)
                k = meeting_keys(s, shared.value)
                ids.append(np.full(len(k), doc, np.int64))
                keys.append(k)
                held += len(k)
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([_longs(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "id"])
                    ids, keys, held = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([_longs(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "id"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "key bigint, id bigint")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id.

    Documents link when the sets of their shingles reach similarity 0.8.
    ``component_id`` is the smallest doc_id reachable over links, itself
    included. Null and empty texts have no shingles and no links. Rows that repeat
    a doc_id are one node with the links of all its texts. Rows without doc_id
    link nothing; their component is null. Without rows the result is empty.
    """
    seen = stored(describe_sets(docs), "sets")
    sets = seen.where("n is not null").drop("bits")
    hot = seen.where("n is null").groupBy("one").agg(F.sum("two").alias("times")).where(F.col("times") >= FREQUENT)
    # At most KEPT rows of two numbers.
    top = hot.orderBy(F.desc("times"), "one").limit(KEPT).toArrow()
    frequent = Frequent(top["one"].to_numpy().view(np.uint64), top["times"].to_numpy())

    named = sets.where("doc_id is not null and n > 0")
    # One row per different set; a doc_id with several texts names several of them.
    different = stored(
        seen.where("doc_id is not null and n > 0").groupBy("n", "one", "two").agg(
            F.min("doc_id").alias("rep"), F.first("bits").alias("bits")
        ),
        "different",
    )
    reps = different.drop("bits")
    classes = stored(named.join(reps, ["n", "one", "two"]).select("doc_id", "rep", "n").distinct(), "classes")

    sketches = different.select("rep", "n", *[F.get("bits", F.lit(i)).alias(w) for i, w in enumerate(_WORDS)])

    def sides(s: str) -> list:
        return [F.col(c).alias(f"{c}_{s}") for c in ("n", *_WORDS)]

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that their bits do not rule out."""
        a = sketches.select(F.col("rep").alias("a"), *sides("a"))
        b = sketches.select(F.col("rep").alias("b"), *sides("b"))
        return pairs.join(a, "a").join(b, "b").where(_near_enough("a", "b")).select(*pairs.columns)

    by_key = Window.partitionBy("key")
    groups = stored(
        _meetings(docs, frequent)
        .select("key", "id", F.min("id").over(by_key).alias("hub"), F.max("id").over(by_key).alias("last"))
        .where("hub < last").select("key", "id", "hub"),
        "groups",
    )
    of = classes.select(F.col("doc_id").alias("id"), "rep", "n")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")

    def as_reps(pairs: DataFrame) -> DataFrame:
        """Pairs of documents -> pairs of classes that sizes do not rule out."""
        x = of.select(F.col("id").alias("x"), F.col("rep").alias("ra"), F.col("n").alias("na"))
        y = of.select(F.col("id").alias("y"), F.col("rep").alias("rb"), F.col("n").alias("nb"))
        met = pairs.join(x, "x").join(y, "y").where("ra != rb").where(
            f"{OF} * least(na, nb) >= {ALIKE} * greatest(na, nb)"
        )
        return met.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(
            F.sum("shared").alias("shared")
        )

    stars = stored(
        near(as_reps(groups.where("id != hub").groupBy(F.col("hub").alias("x"), F.col("id").alias("y")).agg(F.count("*").alias("shared")))),
        "stars",
    )
    # A doc_id with several texts has several classes: they are linked as one node.
    links = stored(
        classes.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
        .unionByName(classes.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b").distinct()),
        "links",
    )

    def grown(links: DataFrame, pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return links
        return stored(links.unionByName(verified(pairs, texts, shingles, similar)), "links")

    def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs whose ends still lie in different components."""
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        return (
            pairs.join(ra, "a", "left").join(rb, "b", "left")
            .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        )

    # First each class with the partner it shares most with, then what is apart.
    best = stored(
        stars.groupBy("b").agg(F.max_by("a", F.struct("shared", F.col("a") * -1)).alias("a")), "best"
    )
    links = grown(links, best.select("a", "b"))
    roots = stored(components(links), "roots")
    tried = best.select("a", "b")
    more = stored(apart(stars.select("a", "b").join(tried, ["a", "b"], "left_anti"), roots).select("a", "b"), "more")
    if not more.isEmpty():
        links = grown(links, more)
        roots = stored(components(links), "roots")
    # Groups whose members are not yet one component: members beside the hub.
    member = groups.join(of, "id").join(roots, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "n", F.coalesce("root", "rep").alias("root")
    ).distinct()
    split = member.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    open_ = stored(member.join(split, "key").join(sketches, ["rep", "n"]), "open")
    left, right = (
        open_.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "root")], *sides(s)) for s in "ab"
    )
    cross = (
        left.join(
            right,
            (left["key"] == right["key"]) & F.expr(
                f"rep_a < rep_b and root_a != root_b and {OF} * least(n_a, n_b) >= {ALIKE} * greatest(n_a, n_b)"
                f" and {_near_enough('a', 'b')}"
            ),
        )
        .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    )
    cross = stored(cross.join(stars, ["a", "b"], "left_anti"), "cross")
    if not cross.isEmpty():
        links = grown(links, cross)
        roots = stored(components(links), "roots")

    out = sets.join(roots, F.col("doc_id") == F.col("node"), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


OP4_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as k
  from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
r as (
  select doc_id as node, doc_id as root from documents
  union
  select e.b, r.root from r join e on e.a = r.node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(root) as component_id
from documents d left join n using (doc_id) join r on r.node = d.doc_id
group by d.doc_id, n.n
"""
