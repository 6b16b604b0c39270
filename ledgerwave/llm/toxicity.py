"""Toxicity: a convolutional text classifier in numpy, trained and scored by Spark.

Words and their first four letters are hashed, twice each, into embedding
tables; a word's vector is the sum of its four rows, so one collision changes a
quarter of it. Filters of several widths slide over the whole text, each
contributes its largest response, and a logistic layer reads these. Every
labelled row is learnt from: the rows are dealt into shards, each shard trains
from the common parameters, and after every round the changes are averaged
parameter by parameter. Rows held back from training calibrate the scores and
the thresholds by language, all of them, by aggregates. Scoring streams over
all documents.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.llm.common import maybe_broadcast, text_key
from ledgerwave.session import stored

# Bounds of the sample for trials; no query draws one.
TOXIC_ROWS = 4_000
CLEAN_ROWS = 8_000

SHARD_ROWS = 5_000  # labelled rows that one task learns from in a round, about
BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 12
BATCH = 64
RATE = 0.05
EPS = 1e-6
CHUNK = 100_000  # words whose responses are held at once
CUT = 0.3  # score from which a text counts as toxic where no language is known
MIN_LABELS = 20  # of each class, for a threshold of a language's own
BINS = 256  # stretches into which a language's scores are cut to find its threshold
BLOCK = 2_048  # rows of the parameters that are averaged together

# All parameters are rows of one array: both tables, then the filters' rows by
# place (the first words of all widths, the second words of widths 2 and 3, and
# so on), then shifts, weights and the bias.
POOLED = FILTERS * len(WIDTHS)
PLACE = np.concatenate([np.full(POOLED - j * FILTERS, j) for j in range(len(WIDTHS))])
FILTER = np.concatenate([np.arange(j * FILTERS, POOLED) for j in range(len(WIDTHS))])
START = np.searchsorted(PLACE, range(len(WIDTHS) + 1))
AT_FILTERS = 2 * BUCKETS
AT_SHIFT = AT_FILTERS + len(PLACE)
AT_WEIGHTS = AT_SHIFT + POOLED // DIM
AT_BIAS = AT_WEIGHTS + POOLED // DIM
ROWS = AT_BIAS + 1

# Bytes to bytes: letters lower-cased, digits and everything beyond ASCII kept.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """Two hashes per word, of the word and of its first letters: shape (words, 2)."""
    if isinstance(text, str):
        text = text.encode("utf-8", "replace")
    found = (text or b"").translate(_TABLE).split()
    out = np.empty((len(found), 2), np.uint32)
    out[:, 0] = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
    out[:, 1] = np.fromiter(map(zlib.crc32, [w[:4] for w in found]), np.uint32, len(found))
    return out


def table_rows(hashes: np.ndarray) -> np.ndarray:
    """Four table rows per word: shape (words, 4). Row 0 of a table is padding."""
    out = np.empty((len(hashes), 4), np.int32)
    for k in range(2):
        mixed = (hashes[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out[:, 2 * k] = (mixed >> np.uint64(47)) % np.uint64(BUCKETS - 1) + np.uint64(1)
        out[:, 2 * k + 1] = (mixed >> np.uint64(16)) % np.uint64(BUCKETS - 1) + np.uint64(1)
    return out


def word_ids(text: str | bytes | None) -> np.ndarray:
    return table_rows(word_hashes(text))


@dataclass
class Model:
    state: np.ndarray  # (ROWS, DIM)
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    @property
    def words(self) -> np.ndarray:
        return self.state[:BUCKETS]

    @property
    def fronts(self) -> np.ndarray:
        return self.state[BUCKETS:AT_FILTERS]

    @property
    def taps(self) -> np.ndarray:
        """One row per filter and place."""
        return self.state[AT_FILTERS:AT_SHIFT]

    @property
    def filters(self) -> list[np.ndarray]:
        """Per width: (width, DIM, FILTERS)."""
        own = [FILTER // FILTERS == i for i in range(len(WIDTHS))]
        return [np.stack([self.taps[o & (PLACE == j)].T for j in range(w)]) for o, w in zip(own, WIDTHS, strict=True)]

    @property
    def shift(self) -> np.ndarray:
        return self.state[AT_SHIFT:AT_WEIGHTS].reshape(-1)

    @property
    def weights(self) -> np.ndarray:
        return self.state[AT_WEIGHTS:AT_BIAS].reshape(-1)

    @property
    def bias(self) -> float:
        return float(self.state[AT_BIAS, 0])

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        v = self.words.take(ids[:, 0], 0)
        v += self.words.take(ids[:, 1], 0)
        v += self.fronts.take(ids[:, 2], 0)
        v += self.fronts.take(ids[:, 3], 0)
        return v

    def responses(self, vectors: np.ndarray) -> np.ndarray:
        """Per filter, its response at each position where it starts; words
        beyond the end are zero."""
        n = len(vectors)
        each = self.taps @ vectors.T
        out = each[:POOLED]
        for j in range(1, len(WIDTHS)):
            out[j * FILTERS :, : max(0, n - j)] += each[START[j] : START[j + 1], j:]
        return out

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over a whole text and where it is;
        long texts go through in overlapping chunks."""
        top = np.full(POOLED, -np.inf, np.float32)
        at = np.zeros(POOLED, np.int64)
        for begin in range(0, len(ids), CHUNK):
            r = self.responses(self.vectors(ids[begin : begin + CHUNK + max(WIDTHS) - 1]))[:, :CHUNK]
            where = r.argmax(axis=1)
            value = r[np.arange(POOLED), where]
            better = value > top
            top[better], at[better] = value[better], where[better] + begin
        return np.where(np.isfinite(top), top, -self.shift), at

    def margin(self, ids: np.ndarray) -> float:
        return float(np.maximum(self.pooled(ids)[0] + self.shift, 0) @ self.weights + self.bias)

    def score(self, ids: np.ndarray) -> float:
        a, b = self.scale
        return float(1 / (1 + np.exp(-np.clip(a * self.margin(ids) + b, -30, 30))))


def fresh_state(seed: int = 7) -> np.ndarray:
    r = np.random.default_rng(seed)
    state = np.zeros((ROWS, DIM), np.float32)
    state[:AT_FILTERS] = r.normal(0, 0.1, (AT_FILTERS, DIM))
    state[[0, BUCKETS]] = 0
    state[AT_FILTERS:AT_SHIFT] = r.normal(0, 1, (len(PLACE), DIM)) * (0.5 / np.array(WIDTHS)[FILTER // FILTERS])[:, None]
    state[AT_WEIGHTS:AT_BIAS] = 0.3
    state[AT_BIAS, 0] = -1.0
    return state


def constant_model(n: int, toxic: int) -> Model:
    """Gives every text the share of toxic labels."""
    state, rate = fresh_state(), (toxic + 0.1) / (n + 1)
    state[AT_WEIGHTS:AT_BIAS] = 0
    state[AT_BIAS, 0] = np.log(rate / (1 - rate))
    return Model(state)


def learn(m: Model, sums: np.ndarray, texts: list[np.ndarray], labels: list[int], balance: dict[int, float]) -> None:
    """One step of Adagrad on the logistic loss of a batch, in place; only the
    places of the largest responses carry a gradient, so it touches few table rows."""
    dense = np.zeros((ROWS - AT_FILTERS, DIM), np.float32)
    d_taps, d_shift = dense[: len(PLACE)], dense[AT_SHIFT - AT_FILTERS : AT_WEIGHTS - AT_FILTERS].reshape(-1)
    d_weights = dense[AT_WEIGHTS - AT_FILTERS : AT_BIAS - AT_FILTERS].reshape(-1)
    rows, steps = [], []
    shift, weights, bias, taps = m.shift, m.weights, m.bias, m.taps
    for ids, label in zip(texts, labels, strict=True):
        top, at = m.pooled(ids)
        z = top + shift
        act = np.maximum(z, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ weights + bias, -30, 30)))
        g = float(p - label) * balance[label] / len(texts)
        dense[-1, 0] += g
        d_weights += g * act
        d = np.where(z > 0, g * weights, 0).astype(np.float32)
        d_shift += d
        spots = at[FILTER] + PLACE
        live = np.flatnonzero((d[FILTER] != 0) & (spots < len(ids)))
        if len(live):
            near, force = ids[spots[live]], d[FILTER[live]][:, None]
            d_taps[live] += m.vectors(near) * force
            rows.append(near)
            steps.append(taps[live] * force)
    used, total = np.empty(0, np.int64), np.empty((0, DIM), np.float32)
    if rows:
        near = np.concatenate(rows) + np.array([0, 0, BUCKETS, BUCKETS], np.int32)
        used, back = np.unique(near.T.reshape(-1), return_inverse=True)
        total = np.zeros((len(used), DIM), np.float32)
        np.add.at(total, back, np.concatenate(steps * 4))
    at_rows = np.concatenate([used, np.arange(AT_FILTERS, ROWS)])
    slope = np.concatenate([total, dense])
    sums[at_rows] += slope**2
    m.state[at_rows] -= RATE * slope / np.sqrt(sums[at_rows])


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """For trials on little data; no query learns from it. At most so many
    labelled rows of each class, chosen by a hash of doc_id;
    an id labelled twice is toxic if any label says so. Of rows that repeat a
    doc_id one is taken, the smallest by a hash of the text, so that the bound on
    ids bounds rows."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic_"))
        .withColumn("draw_", F.xxhash64("doc_id"))
    )
    picked = known.where("toxic_ = 1").orderBy("draw_", "doc_id").limit(toxic_rows).unionByName(
        known.where("toxic_ = 0").orderBy("draw_", "doc_id").limit(clean_rows)
    ).withColumnsRenamed({"doc_id": "id_"})
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)).cast("int")
    found = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), F.col("doc_id") == F.col("id_"))
    # The minimum combines where rows are read: a doc_id with a third of all rows is folded there.
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang", "toxic_"))
    return found.groupBy("doc_id").agg(one.alias("row")).select(
        "doc_id", "row.text", "row.lang", F.col("row.toxic_").cast("int").alias("toxic"), part.alias("part")
    )


def labelled_rows(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every labelled row of ``docs`` as hashes of its words: doc_id, lang, key,
    part (0..4), toxic, hashes, shard; a partition is a shard, in a fixed order. An id
    labelled twice is toxic if any label says so. Rows that agree in doc_id, lang
    and text are one; different texts of an id all take part."""
    known = stored(
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)"),
        "known",
    )
    n = docs.select("doc_id").join(maybe_broadcast(known), "doc_id").count()
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)).cast("int")
    found = docs.select("doc_id", "lang", "text").join(maybe_broadcast(known), "doc_id").select(
        "doc_id", "lang", text_key(F.col("text")).alias("key"), part.alias("part"), "toxic", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "lang", "key", "part", "toxic"]
        for batch in batches:
            # Repeats within a batch go before they travel: they may be a third of all rows.
            first = {}
            for i, one in enumerate(zip(*(batch.column(c).to_pylist() for c in names[:3]), strict=True)):
                first.setdefault(one, i)
            batch = batch.take(pa.array(first.values(), pa.int64()))
            hashes = [word_hashes(t.as_py()).tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(hashes, pa.binary())], [*names, "hashes"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    same, shards = ["doc_id", "lang", "key"], max(1, -(-n // shard_rows))
    # What a round moves grows with its shards, so a session that deals out finer gets them joined again.
    return (
        found.mapInArrow(run, f"doc_id {kind}, lang string, key bigint, part int, toxic int, hashes binary")
        .repartition(shards, *same)
        .dropDuplicates(same)
        .withColumn("shard", F.spark_partition_id())
        .coalesce(shards)
        .sortWithinPartitions(F.xxhash64(*same), *same)
    )


def _texts(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [table_rows(np.frombuffer(h.as_buffer(), np.uint32).reshape(-1, 2)) for h in batch.column("hashes")]


def _averaged(changes: pd.DataFrame) -> pd.DataFrame:
    """Per parameter row, the mean change of the shards that moved it."""
    changes = changes.sort_values("shard")
    at = np.concatenate([np.frombuffer(x, np.int32) for x in changes["at"]])
    moved = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, 2 * DIM) for x in changes["moved"]])
    used, back, times = np.unique(at, return_inverse=True, return_counts=True)
    total = np.zeros((len(used), 2 * DIM))
    np.add.at(total, back, moved)
    mean = (total / times[:, None]).astype(np.float32)
    return pd.DataFrame({"at": [used.tobytes()], "moved": [mean.tobytes()]})


def train(rows: DataFrame, balance: dict[int, float], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Rounds over all ``rows`` (toxic, hashes, shard): each partition goes once through
    its rows from the common parameters and Adagrad sums, then the changes are
    averaged. The driver holds one set of parameters, whatever the rows."""
    context = rows.sparkSession.sparkContext
    m, sums = Model(fresh_state(seed)), np.full((ROWS, DIM), EPS, np.float32)
    for turn in range(epochs):
        common = context.broadcast((m.state, sums))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, shard = common.value, None
            own, own_sums = Model(before[0].copy()), before[1].copy()
            for batch in batches:
                if not batch.num_rows:
                    continue
                if shard is None:
                    shard = batch.column("shard")[0].as_py()
                    r = np.random.default_rng([seed, turn, shard])
                texts, labels = _texts(batch), batch.column("toxic").to_pylist()
                order = r.permutation(len(texts))
                for begin in range(0, len(order), BATCH):
                    some = order[begin : begin + BATCH]
                    learn(own, own_sums, [texts[k] for k in some], [labels[k] for k in some], balance)
            at = np.flatnonzero((own_sums != before[1]).any(axis=1)).astype(np.int32)
            moved = np.concatenate([own.state[at] - before[0][at], own_sums[at] - before[1][at]], axis=1)
            for block in np.unique(at // BLOCK):
                mine = at // BLOCK == block
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int32()), "shard": pa.array([shard], pa.int32()),
                    "at": pa.array([at[mine].tobytes()], pa.binary()),
                    "moved": pa.array([moved[mine].tobytes()], pa.binary()),
                })

        changes = rows.select("toxic", "hashes", "shard").mapInArrow(run, "block int, shard int, at binary, moved binary")
        for x in changes.groupBy("block").applyInPandas(_averaged, "at binary, moved binary").collect():
            at, moved = np.frombuffer(x["at"], np.int32), np.frombuffer(x["moved"], np.float32).reshape(-1, 2 * DIM)
            m.state[at] += moved[:, :DIM]
            sums[at] += moved[:, DIM:]
        common.destroy()
    return m


def _fit_scale(margins: DataFrame, n: int, toxic: int) -> tuple[float, float]:
    """Platt scaling with smoothed labels: Newton's steps, whose sums run over all rows."""
    a, b = 1.0, 0.0
    target = F.when(F.col("toxic") == 1, (toxic + 1) / (toxic + 2)).otherwise(1 / (n - toxic + 2))
    x = F.col("margin")
    for _ in range(200):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * x + b))))
        w = F.greatest(p * (1 - p), F.lit(1e-6))
        off, off_x, w_x2, w_x, w_1 = margins.agg(
            F.sum(p - target), F.sum((p - target) * x), F.sum(w * x * x), F.sum(w * x), F.sum(w)
        ).first()
        g = np.array([off_x + 1e-3 * (a - 1), off])
        h = np.array([[w_x2 + 1e-3, w_x], [w_x, w_1 + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - float(step[0]), b - float(step[1])
        if np.abs(step).max() < 1e-8:
            break
    # Sums of doubles differ in their last digits from run to run.
    return max(round(a, 6), 1e-3), round(b, 6)


def _best_thresholds(scores: DataFrame) -> dict[str, float]:
    """Per language, the middle of the gap between scores that gives the best F1;
    ties go to the widest gap. Running sums go by stretch, so no task holds a
    language; where stretches begin changes nothing."""
    points = scores.where("lang is not null").groupBy("lang", "score").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("hits")
    )
    langs = points.groupBy("lang").agg(
        F.percentile_approx("score", [i / BINS for i in range(1, BINS)]).alias("cuts"),
        F.sum("n").alias("all_n"), F.sum("hits").alias("all_hits"),
    ).where((F.col("all_hits") >= MIN_LABELS) & (F.col("all_n") - F.col("all_hits") >= MIN_LABELS))
    binned = stored(
        points.join(langs, "lang")
        .withColumn("bin", F.size(F.filter("cuts", lambda c: c <= F.col("score")))).drop("cuts", "all_n"),
        "binned",
    )
    over = Window.partitionBy("lang").orderBy(F.desc("bin"))
    above = over.rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("lang", "bin").agg(
        F.sum("n").alias("bin_n"), F.sum("hits").alias("bin_hits"), F.max("score").alias("top")
    ).select(
        "lang", "bin", F.coalesce(F.sum("bin_n").over(above), F.lit(0)).alias("above_n"),
        F.coalesce(F.sum("bin_hits").over(above), F.lit(0)).alias("above_hits"),
        F.coalesce(F.lead("top").over(over), F.lit(0.0)).alias("below"),
    )
    inside = Window.partitionBy("lang", "bin").orderBy(F.desc("score"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    n, hits = F.sum("n").over(so_far) + F.col("above_n"), F.sum("hits").over(so_far) + F.col("above_hits")
    each = binned.join(bins, ["lang", "bin"]).select(
        "lang", "score", (2 * hits / (n + F.col("all_hits"))).alias("f1"),
        (F.col("score") - F.coalesce(F.lead("score").over(inside), F.col("below"))).alias("gap"),
    )
    best = each.groupBy("lang").agg(F.max(F.struct(F.round("f1", 6).alias("f1"), "gap", "score")).alias("x"))
    return {r["lang"]: r["x"]["score"] - r["x"]["gap"] / 2 for r in best.collect()}


def _calibrate(m: Model, rows: DataFrame, n: int, toxic: int) -> None:
    """Scale and thresholds from all ``rows`` (lang, toxic, hashes)."""
    model = rows.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = pa.array([model.value.margin(t) for t in _texts(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("toxic"), margins], ["lang", "toxic", "margin"]
            )

    margins = stored(
        rows.select("lang", "toxic", "hashes").mapInArrow(run, "lang string, toxic int, margin double"), "margins"
    )
    model.destroy()
    a, b = m.scale = _fit_scale(margins, n, toxic)
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * F.col("margin") + b))
    m.thresholds = _best_thresholds(margins.select("lang", "toxic", (1 / (1 + F.exp(-z))).alias("score")))


def train_model(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS) -> bytes:
    """The pickled model, fitted on every labelled row: part 4 calibrates, the
    others train. Shards and their order are fixed, so reruns give the same model."""
    rows = labelled_rows(docs, labels, shard_rows).persist(StorageLevel.DISK_ONLY)
    counts = {(r["held"], r["toxic"]): r["count"] for r in rows.groupBy((F.col("part") == 4).alias("held"), "toxic").count().collect()}
    of = lambda toxic, *held: sum(counts.get((h, toxic), 0) for h in held)
    if not of(0, False, True) or not of(1, False, True):
        m = constant_model(of(0, False, True) + of(1, False, True), of(1, False, True))
    else:
        apart = all(of(t, h) for t in (0, 1) for h in (False, True))
        learnt, held = ((False,), (True,)) if apart else ((False, True), (False, True))
        total = of(0, *learnt) + of(1, *learnt)
        m = train(rows.where("part != 4") if apart else rows, {t: total / (2 * of(t, *learnt)) for t in (0, 1)})
        _calibrate(m, rows.where("part = 4") if apart else rows, of(0, *held) + of(1, *held), of(1, *held))
    rows.unpersist()
    return pickle.dumps(m)


def _scores(m: Model, batch: pa.RecordBatch) -> tuple[list[float], list[float]]:
    scores = [m.score(word_ids(t.as_py())) for t in batch.column("text").cast(pa.binary())]
    return scores, [m.thresholds.get(x, CUT) for x in batch.column("lang").to_pylist()]


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, score in 0..1,
    threshold of its language, toxic (score reaches it).

    ``labels`` holds doc_id and toxic (0/1); rows with nulls are ignored. The
    score depends on the text alone: null and empty texts get the score of a text
    without words. A null language, or one with few labels, takes the common
    threshold. Labels of one class, or none, give every text the same score.
    Repeated rows repeat their result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_model(docs, labels))
    texts = docs.select("doc_id", "text", "lang")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(model.value)
        for batch in batches:
            scores, limits = _scores(m, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(limits, pa.float64())],
                ["doc_id", "score", "threshold"],
            )

    return texts.mapInArrow(run, f"doc_id {kind}, score double, threshold double").withColumn(
        "toxic", F.col("score") >= F.col("threshold")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, whole, whose score stays below the threshold of
    their language; cases as in ``score_toxicity``."""
    model = docs.sparkSession.sparkContext.broadcast(train_model(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(model.value)
        for batch in batches:
            scores, limits = _scores(m, batch)
            yield batch.filter(pa.array([s < x for s, x in zip(scores, limits, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold() -> Column:
    """Fold of a doc_id; fold 2 is held out and never lends its labels."""
    return F.crc32(F.col("doc_id").cast("string")) % 4


def op10_columns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels are learnt only from rows outside the held-out fold."""
    scored = score_toxicity(docs, labels.where(fold() != 2))
    return scored.select(
        "doc_id",
        F.coalesce(fold() == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "threshold",
        "toxic",
    )
