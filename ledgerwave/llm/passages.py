"""Passages that repeat earlier ones, found from seeds and verified whole.

Seeds are winnowed: of every WINDOW consecutive runs of GRAM words the one with
the smallest hash. Two texts that share GRAM + WINDOW - 1 = 19 words in a row
share a seed there, wherever the lines break. Passages of 20 words or more whose
5-word Jaccard similarity is 0.8 share that many: each changed word inside costs
five shingles on either side, so it takes 45 words for every change.

Seeds only propose. Stretches of a text with repeated seeds, and PAD words around
them, are compared word for word with the stretch of the smallest doc_id that
holds the seed: equal runs are extended at both ends, runs on either side of a
gap of up to GAP words are joined, and a joined passage counts if its similarity,
taken over the whole of it, is 0.8 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ledgerwave.llm.common import maybe_broadcast
from ledgerwave.llm.shingles import ALIKE, OF, WORDS, mixed
from ledgerwave.session import stored

GRAM, WINDOW = 8, 12
PAD = 48
GAP = 32
MARKS = 1 << 27  # bits of the map of seeds that repeat (16 MB)
HELD = 300_000  # words that a task hashes at once

_K = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = "doc_id bigint, start bigint, seg bigint, within boolean, words array<int>, seeds array<bigint>"
_PASSAGE = "doc_id bigint, first bigint, stop bigint, kept_doc bigint, kept_first bigint, kept_stop bigint"


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    n = max(len(h) - width + 1, 0)
    out = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        out = out * _K + h[k : k + n]
    return mixed(out)


def seeds(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the seeds of texts laid end to end."""
    g = _grams(h, GRAM)
    if len(g) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.lib.stride_tricks.sliding_window_view(g, WINDOW).argmin(axis=1)
    first = np.arange(len(at))
    text = np.searchsorted(starts, first, "right") - 1
    inside = first + WINDOW + GRAM - 1 <= np.append(starts[1:], len(h))[text]
    at = np.unique((at + first)[inside])
    return at, g[at]


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, starts and word hashes of some texts, laid end to end."""
    def laid(rows, texts):
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, counts.sum())
        return np.array(rows), np.cumsum(counts) - counts, h

    rows, texts, held = [], [], 0
    for row, text in enumerate(batch.column("text").cast(pa.binary())):
        own = (text.as_py() or b"").lower().split()
        if len(own) < GRAM + WINDOW - 1:
            continue
        rows.append(row)
        texts.append(own)
        held += len(own)
        if held > HELD:
            yield laid(rows, texts)
            rows, texts, held = [], [], 0
    if rows:
        yield laid(rows, texts)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _seeds(docs: DataFrame) -> DataFrame:
    """seed, doc_id: one row per seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, starts, h in _hashed(batch):
                at, value = seeds(h, starts)
                text = np.searchsorted(starts, at, "right") - 1
                yield pa.RecordBatch.from_arrays([_signed(value), pa.array(ids[rows[text]])], ["seed", "doc_id"])

    return docs.mapInArrow(run, "seed bigint, doc_id bigint")


def marks(met: DataFrame) -> np.ndarray:
    """A bit map of MARKS bits; a bounded size, whatever the number of seeds."""
    bit = F.pmod("seed", F.lit(MARKS))
    rows = met.groupBy(F.shiftright(bit, 6).alias("slot")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(seed, {MARKS}) & 63 as int))")).alias("any")
    ).toArrow()
    out = np.zeros(MARKS // 64, np.uint64)
    out[rows["slot"].to_numpy()] = rows["any"].to_numpy().view(np.uint64)
    return out


def marked(map_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of some 64-bit values have their bit set."""
    bit = values.view(np.int64) % MARKS
    return (map_[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def _segments(docs: DataFrame, met: DataFrame) -> DataFrame:
    """The stretches of texts around the seeds in ``met`` (and a few others that
    share a mark): word hashes and distinct seeds. ``within``: a seed occurs
    twice in the stretch."""
    shared = docs.sparkSession.sparkContext.broadcast(marks(met))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, starts, h in _hashed(batch):
                at, value = seeds(h, starts)
                hit = marked(shared.value, value)
                at, value = at[hit], value[hit]
                if not len(at):
                    continue
                text = np.searchsorted(starts, at, "right") - 1
                fresh = np.append(True, (np.diff(at) > 2 * PAD + GRAM) | (np.diff(text) > 0))
                opens = np.flatnonzero(fresh)
                closes = np.append(opens[1:], len(at))
                ends = np.append(starts[1:], len(h))
                short = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                out = {k: [] for k in ("doc_id", "start", "seg", "within", "words", "seeds")}
                for o, c in zip(opens, closes, strict=True):
                    t = text[o]
                    a, b = max(starts[t], at[o] - PAD), min(ends[t], at[c - 1] + GRAM + PAD)
                    own, doc_id = np.unique(value[o:c]), int(ids[rows[t]])
                    out["doc_id"].append(doc_id)
                    out["start"].append(a - starts[t])
                    out["seg"].append(xxhash.xxh3_64_intdigest(short[a:b].tobytes() + f"{doc_id} {a - starts[t]}".encode()) - 2**63)
                    out["within"].append(len(own) < c - o)
                    out["words"].append(short[a:b])
                    out["seeds"].append(own.view(np.int64))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    return docs.mapInArrow(run, _SEGMENT)


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two arrays share from their beginning."""
    done, step = 0, 32
    n = min(len(a), len(b))
    while done < n:
        k = min(step, n - done)
        unlike = np.flatnonzero(a[done : done + k] != b[done : done + k])
        if len(unlike):
            return done + int(unlike[0])
        done, step = done + k, step * 4
    return n


def _blocks(a: np.ndarray, b: np.ndarray, ahead: int | None) -> list[tuple[int, int, int]]:
    """Equal runs (place in a, place in b, words) of WORDS words or more, by
    place in a. ``ahead``: a starts so many words after b in one text, of which
    only earlier words count."""
    ga, gb = (_grams(x.view(np.uint32).astype(np.uint64), WORDS) for x in (a, b))
    order = np.argsort(gb, kind="stable")
    low, high = np.searchsorted(gb[order], ga, "left"), np.searchsorted(gb[order], ga, "right")
    has = np.flatnonzero(low < high)
    out, i, diagonal = [], 0, 0
    while (k := np.searchsorted(has, i)) < len(has):
        i = int(has[k])
        places = order[low[i] : high[i]]
        if ahead is not None:
            places = places[places < i + ahead]
        if not len(places):
            i += 1
            continue
        near = int(np.searchsorted(places, i + diagonal))
        best = None
        for j in {0, max(near - 1, 0), min(near, len(places) - 1)}:
            j = int(places[j])
            found = (_run(a[i:], b[j:]), -j)
            best = max(best, found) if best else found
        n, j = best[0], -best[1]
        if n < WORDS:  # grams that share a hash
            i += 1
            continue
        back = _run(a[:i][::-1], b[:j][::-1])
        out.append((i - back, j - back, n + back))
        diagonal, i = j - i, i + n - WORDS + 1
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    sa, sb = (np.unique(_grams(x.view(np.uint32).astype(np.uint64), WORDS)) for x in (a, b))
    both = np.intersect1d(sa, sb, assume_unique=True).size
    return OF * both >= ALIKE * (len(sa) + len(sb) - both) > 0


def matches(a: np.ndarray, b: np.ndarray, passage: int, ahead: int | None = None) -> list[tuple[int, int, int, int]]:
    """Passages (begin and end in a, begin and end in b) of ``passage`` words or
    more in a whose similarity with one in b is 0.8 or more."""
    if ahead is None and np.array_equal(a, b):
        return [(0, len(a), 0, len(b))] if len(a) >= passage else []
    chains, live = [], []
    for block in _blocks(a, b, ahead):
        i, j, _ = block
        live = [c for c in live if i - c[-1][0] - c[-1][2] <= GAP]
        fits = [
            c for c in live
            if i > c[-1][0] and j > c[-1][1] and -GAP <= i - c[-1][0] - c[-1][2] and -WORDS < j - c[-1][1] - c[-1][2] <= GAP
        ]
        if fits:
            min(fits, key=lambda c: abs((j - i) - (c[-1][1] - c[-1][0]))).append(block)
        else:
            chains.append([block])
            live.append(chains[-1])
    out = []
    for found in chains:
        i, j, n = np.array(found).T
        shared, last = np.cumsum(n - WORDS + 1), -1
        for p in range(len(found)):
            m = shared[p:] - shared[p] + n[p] - WORDS + 1
            size = (i[p:] + n[p:] - i[p]) + (j[p:] + n[p:] - j[p]) - 2 * (WORDS - 1)
            for q in p + np.flatnonzero((OF + ALIKE) * m >= ALIKE * size)[::-1]:
                if q <= last:
                    break
                span = (int(i[p]), int(i[q] + n[q]), int(j[p]), int(j[q] + n[q]))
                if span[1] - span[0] >= passage and _alike(a[span[0] : span[1]], b[span[2] : span[3]]):
                    out.append(span)
                    last = q
                    break
    return out


def _compared(pairs: DataFrame, passage: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, hub, hub_start = (batch.column(c).to_pylist() for c in ("doc_id", "start", "hub", "hub_start"))
            words, hub_words = batch.column("words"), batch.column("hub_words")
            out = []
            for k in range(batch.num_rows):
                a, b = words[k].values.to_numpy(), hub_words[k].values.to_numpy()
                ahead = start[k] - hub_start[k] if doc[k] == hub[k] else None
                for i, i_end, j, j_end in matches(a, b, passage, ahead):
                    out.append((doc[k], start[k] + i, start[k] + i_end, hub[k], hub_start[k] + j, hub_start[k] + j_end))
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "first", "stop", "kept_doc", "kept_first", "kept_stop"]
            )

    return pairs.mapInArrow(run, _PASSAGE)


def _kept(merged: DataFrame) -> DataFrame:
    """Where the earlier passage repeats one itself, the one that is kept."""
    own = stored(merged.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("first", "stop"))).alias("own")
    ).withColumnRenamed("doc_id", "of"), "removed")
    over = F.filter("own", lambda s: (s["first"] < F.col("kept_stop")) & (s["stop"] > F.col("kept_first")))
    now = stored(
        merged.join(maybe_broadcast(own), F.col("kept_doc") == F.col("of"), "left")
        .withColumn("next", F.when(F.size(over) > 0, over[0]["first"]))
        # A passage that overlaps its own source is its own first occurrence.
        .withColumn("next", F.expr("if(kept_doc = doc_id and next >= first, null, next)"))
        .select("doc_id", "first", "stop", "kept_doc", "next"), "kept",
    )
    while not now.where("next is not null").isEmpty():
        then = now.select(
            F.col("doc_id").alias("d_"), F.col("first").alias("f_"), F.col("kept_doc").alias("k_"), F.col("next").alias("n_")
        )
        met = (F.col("kept_doc") == F.col("d_")) & (F.col("next") == F.col("f_"))
        now = stored(
            now.join(maybe_broadcast(then), met, "left").select(
                "doc_id", "first", "stop", F.coalesce("k_", "kept_doc").alias("kept_doc"), F.col("n_").alias("next")
            ), "kept",
        )
    return now


def passages(docs: DataFrame, passage: int, also: DataFrame) -> DataFrame:
    """doc_id, first, stop, kept_doc of the passages of ``docs`` (doc_id bigint,
    text) that repeat earlier ones; those that overlap or touch are one. ``also``
    holds passages found otherwise, with the place of the earlier one."""
    met = stored(
        _seeds(docs).groupBy("seed").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n"))
        .where("n > 1").select("seed", "hub"), "met",
    )
    segments = stored(_segments(docs, met), "segments")
    held = stored(
        segments.select("doc_id", "start", "seg", "within", F.explode("seeds").alias("seed")).join(met, "seed"), "held"
    )
    hubs = held.where("doc_id = hub").groupBy("seed").agg(F.min("start").alias("hub_start"))
    pairs = stored(
        held.join(hubs, "seed").where("doc_id != hub or start != hub_start or within")
        .select("seg", "hub", "hub_start").distinct(), "pairs",
    )
    texts = segments.select("doc_id", "start", "seg", "words")
    hub_texts = segments.select(
        F.col("doc_id").alias("hub"), F.col("start").alias("hub_start"), F.col("words").alias("hub_words")
    )
    both = pairs.join(texts, "seg").join(hub_texts, ["hub", "hub_start"])
    seeded = stored(_compared(both, passage), "found")
    found = seeded.unionByName(also).distinct()
    order = Window.partitionBy("doc_id").orderBy("first", "stop")
    fresh = F.col("first") > F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = found.withColumn("fresh", fresh.cast("int")).withColumn(
        "run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    kept = F.min(F.struct("kept_doc", "kept_first", "kept_stop"))
    merged = runs.groupBy("doc_id", "run").agg(F.min("first").alias("first"), F.max("stop").alias("stop"), kept.alias("k"))
    return _kept(stored(merged.select("doc_id", "first", "stop", "k.*"), "merged"))
