"""Repeated passages: MinHash bands of paragraphs, and passages inside them.

Paragraphs are lines; lines longer than LONGEST words are cut further where the
hash of three words is the smallest of its neighbourhood, so that two texts are
cut alike inside a shared passage. Each paragraph is the set of its 5-word
shingles; the smallest value under each of BANDS hash functions is a band (one row
per band, tuned for recall: paragraphs of similarity 0.8 miss all three with
probability 0.008).

Copies of a paragraph are counted per band by a map-side combined aggregation,
so no task gathers them. Different paragraphs of one band meet its smallest and
its largest name and are verified by exact Jaccard. Where the members of a band
do not end up in one component, they meet again, in smaller groups: similar sets
that share their smallest value also share one of the values that follow.
Verified paragraphs form components, and of every component the first occurrence
stays.

A passage pasted into the middle of a longer paragraph shares no paragraph with
its other copies, and no banding of whole paragraphs finds it. So seeds add
passages of any place (see ``passages``), verified whole; where both overlap
they are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.llm import passages
from ledgerwave.llm.common import maybe_broadcast
from ledgerwave.llm.graph import components
from ledgerwave.llm.shingles import ALIKE, OF, WORDS, mixed
from ledgerwave.session import stored

REACH = 24  # a cut's hash is the smallest among so many on either side
LONGEST = 256  # words of a paragraph; longer stretches without a cut are cut evenly
BANDS = 3
PASSAGE = 20
SMALL = 8  # sets of fewer values have no similar ones that differ in two
HELD = 100_000  # words that a task cuts at once

_K = np.uint64(0x9E3779B97F4A7C15)
_SALTS = [np.uint64(0xD6E8FEB86659FD93 * (i + 1) % 2**64) for i in range(BANDS)]


def _rolling(h: np.ndarray, width: int) -> np.ndarray:
    out = np.full(max(len(h) - width + 1, 0), np.uint64(width), np.uint64)
    for k in range(width):
        out = out * _K + h[k : len(h) - width + 1 + k]
    return mixed(out)


def cuts(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Paragraph limits in lines laid end to end: the starts of the lines, places
    inside long ones, and the number of words."""
    n = len(h)
    ends = np.append(starts[1:], n)
    inner = np.empty(0, np.int64)
    if (ends - starts > LONGEST).any():
        g = _rolling(h, 3)
        least = np.lib.stride_tricks.sliding_window_view(g, REACH).min(axis=1)
        at = np.arange(REACH, len(g) - REACH)
        inner = at[(g[at] < least[: len(at)]) & (g[at] <= least[REACH + 1 :])]
        line = np.searchsorted(starts, inner, "right") - 1
        inside = (inner - REACH >= starts[line]) & (inner + REACH + 3 <= ends[line])
        inner = inner[inside & ((ends - starts)[line] > LONGEST)]
    at = np.sort(np.concatenate([starts, inner, [n]]))
    pieces = -(-np.diff(at) // LONGEST)
    turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.append(np.repeat(at[:-1], pieces) + LONGEST * turn, n)


def bands(shingles: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """The smallest value of each set, per hash function."""
    return [np.minimum.reduceat(mixed(shingles ^ s), begin) + np.uint64(i) for i, s in enumerate(_SALTS)]


@dataclass
class Paragraphs:
    """The paragraphs of some lines. The shingles of paragraph i are
    ``shingles[begin[i] : begin[i + 1]]``, as they follow in the text."""

    line: np.ndarray  # number of the line
    first: np.ndarray  # first word in the line
    words: np.ndarray
    shingles: np.ndarray
    begin: np.ndarray

    def names(self) -> np.ndarray:
        """A hash of the shingles of each, whatever their order."""
        sizes = np.diff(self.begin, append=len(self.shingles)).astype(np.uint64)
        return mixed(np.add.reduceat(mixed(self.shingles), self.begin) + sizes)

    def set_of(self, i: int) -> np.ndarray:
        end = self.begin[i + 1] if i + 1 < len(self.begin) else len(self.shingles)
        return np.unique(self.shingles[self.begin[i] : end])


def paragraphs(lines: list[list[bytes]], least: int = WORDS) -> Paragraphs:
    """All paragraphs of ``least`` words or more of lines given as their words."""
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(counts) - counts
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(lines)), np.uint64, counts.sum())
    limits = cuts(h, starts)
    first, words = limits[:-1], np.diff(limits)
    first, words = first[words >= max(least, WORDS)], words[words >= max(least, WORDS)]
    held = words - WORDS + 1
    begin = np.cumsum(held) - held
    s = _rolling(h, WORDS)[np.arange(held.sum()) + np.repeat(first - begin, held)]
    line = np.searchsorted(starts, first, "right") - 1
    return Paragraphs(line, first - starts[line], words, s, begin)


def _parsed(batch: pa.RecordBatch, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, Paragraphs]]:
    """Row number and first word of each paragraph, and the paragraphs, a bounded
    number of words at a time (or one line)."""
    rows, bases, lines, held = [], [], [], 0

    def cut() -> Iterator[tuple[np.ndarray, np.ndarray, Paragraphs]]:
        if lines and len((found := paragraphs(lines, least)).words):
            yield np.array(rows)[found.line], np.array(bases)[found.line] + found.first, found

    for row, text in enumerate(batch.column("text").cast(pa.binary())):
        base = 0
        for line in (text.as_py() or b"").lower().split(b"\n"):
            own = line.split()
            if len(own) >= least:
                rows.append(row)
                bases.append(base)
                lines.append(own)
                held += len(own)
            base += len(own)
            if held > HELD:
                yield from cut()
                rows, bases, lines, held = [], [], [], 0
    yield from cut()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _bands(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """band, name (of the shingle set): one row per paragraph and band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, cut in _parsed(batch, least):
                name = _signed(cut.names())
                for band in bands(cut.shingles, cut.begin):
                    yield pa.RecordBatch.from_arrays([_signed(band), name], ["band", "name"])

    return docs.select("text").mapInArrow(run, "band bigint, name bigint")


def _colliding(docs: DataFrame, met: DataFrame, least: int) -> DataFrame:
    """doc_id, first, words, name of the paragraphs with a band in ``met`` (and a few
    others that share a mark). ``shingles`` stands with the first of a name in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(passages.marks(met.select(F.col("band").alias("seed"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, first, cut in _parsed(batch, least):
                hit = np.zeros(len(rows), bool)
                for band in bands(cut.shingles, cut.begin):
                    hit |= passages.marked(shared.value, band)
                if not hit.any():
                    continue
                names = cut.names().view(np.int64)
                sets = []
                for k in np.flatnonzero(hit):
                    name = int(names[k])
                    sets.append(None if name in seen else cut.set_of(k).view(np.int64))
                    seen.add(name)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[rows[hit]]), pa.array(first[hit]), pa.array(cut.words[hit]), pa.array(names[hit]),
                        pa.array(sets, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "first", "words", "name", "shingles"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, first bigint, words bigint, name bigint, shingles array<bigint>"
    )


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty sets of a batch as values and their first places."""
    sets = batch.column("shingles")
    return sets.flatten().to_numpy().view(np.uint64), np.cumsum(np.append(0, sets.value_lengths().to_numpy()))[:-1]


def _members(sets: DataFrame) -> DataFrame:
    """band, salt, name: the bands of stored sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for i, band in enumerate(bands(*_flat(batch))):
                salt = pa.array(np.full(batch.num_rows, i, np.int64))
                yield pa.RecordBatch.from_arrays([_signed(band), salt, batch.column("name")], ["band", "salt", "name"])

    return sets.mapInArrow(run, "band bigint, salt bigint, name bigint")


def _finer_keys(values: np.ndarray, salt: int) -> np.ndarray:
    """Keys under which a set meets, inside its band, those similar to it.

    The first key names the set itself, the next ones the set with one value
    left out: so sets that differ in one value meet at the smaller one, and sets
    of fewer than SMALL values have no other similar ones. Larger sets also have
    the smallest value with each of those that follow it, as many as it takes
    that similar sets share one.
    """
    n = len(values)
    own = mixed(values)
    all_ = np.bitwise_xor.reduce(own, keepdims=True)
    keys = [mixed(all_ + np.uint64(n)), mixed((all_ ^ own) + np.uint64(n - 1))]
    if n >= SMALL:
        ranked = np.sort(mixed(values ^ _SALTS[salt]))
        keys.append(mixed(ranked[1 : 2 + n + -ALIKE * n // OF] ^ mixed(ranked[:1])) + np.uint64(salt))
    return np.concatenate(keys)


def _finer(members: DataFrame) -> DataFrame:
    """key, turn (smallest for the set that the others of the key are compared with), name, root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, begin = _flat(batch)
            sets = zip(np.split(values, begin[1:]), batch.column("salt").to_pylist(), strict=True)
            keys = [_finer_keys(own, salt) for own, salt in sets]
            sizes = np.diff(begin, append=len(values))
            turns = [np.where(np.arange(len(k)) > n, n, np.arange(len(k)) > 0) for k, n in zip(keys, sizes, strict=True)]
            at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(np.concatenate(keys)), pa.array(np.concatenate(turns).astype(np.int64)),
                    batch.column("name").take(at), batch.column("root").take(at),
                ],
                ["key", "turn", "name", "root"],
            )

    return members.mapInArrow(run, "key bigint, turn bigint, name bigint, root bigint")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.select(F.col("name").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("name").alias("b"), F.col("shingles").alias("sb")), "b")
        .where(OF * both >= ALIKE * (F.size("sa") + F.size("sb") - both)).select("a", "b")
    )


def _ordered(x: str, y: str) -> Column:
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def linked_names(met: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified pairs of names: all that it takes to join the members of a band."""
    low_high = maybe_broadcast(met.where("low < high"))
    members = stored(_members(sets).join(low_high, "band"), "members")
    pairs = stored(
        members.select(F.explode(F.array(_ordered("name", "low"), _ordered("name", "high"))).alias("p"))
        .select("p.a", "p.b").where("a != b").distinct(), "pairs",
    )
    links = stored(_alike(pairs, sets), "links")
    roots = stored(components(links), "roots")
    rooted = stored(
        members.join(roots, F.col("name") == F.col("node"), "left")
        .select("band", "salt", "name", F.coalesce("root", "name").alias("root")), "rooted",
    )
    split = rooted.groupBy("band").agg(F.min("root").alias("l"), F.max("root").alias("h"), F.count("*").alias("n"))
    apart = rooted.join(stored(split.where("l < h and n > 2").select("band"), "split"), "band")
    keyed = stored(_finer(apart.select("salt", "name", "root").distinct().join(sets, "name")), "finer")
    ends = F.struct("turn", "name", "root")
    ends_of = keyed.groupBy("key").agg(
        F.min(ends).alias("low"), F.max(ends).alias("high"), F.min("root").alias("l"), F.max("root").alias("h")
    ).where("l < h").select("key", "low", "high")
    other = (
        keyed.join(ends_of, "key").select("name", "root", F.explode(F.array("low", "high")).alias("hub"))
        .where("root != hub.root").select(F.least("name", "hub.name").alias("a"), F.greatest("name", "hub.name").alias("b"))
        .distinct().join(pairs, ["a", "b"], "left_anti")
    )
    return links.unionByName(_alike(stored(other, "finer-pairs"), sets))


def repeated_paragraphs(docs: DataFrame, least: int = PASSAGE) -> DataFrame:
    """doc_id, first, stop, kept_doc, kept_first, kept_stop: paragraphs whose
    component has an earlier occurrence, which stays. ``docs`` has doc_id bigint, text."""
    met = stored(
        _bands(docs, least).groupBy("band").agg(
            F.min("name").alias("low"), F.max("name").alias("high"), F.count("*").alias("n")
        ).where("n > 1").select("band", "low", "high"),
        "bands",
    )
    found = stored(_colliding(docs, met, least), "paragraphs")
    sets = stored(found.where("shingles is not null").groupBy("name").agg(F.first("shingles").alias("shingles")), "sets")
    links = linked_names(met, sets)
    roots = stored(components(links), "paragraph-roots").withColumnRenamed("node", "name")
    placed = found.select("doc_id", "first", "words", "name").join(maybe_broadcast(roots), "name", "left").select(
        "doc_id", "first", (F.col("first") + F.col("words")).alias("stop"), F.coalesce("root", "name").alias("root")
    )
    places = stored(placed, "places")
    kept = stored(
        places.groupBy("root").agg(F.min(F.struct("doc_id", "first", "stop")).alias("kept"), F.count("*").alias("n"))
        .where("n > 1").select("root", "kept"),
        "kept-paragraphs",
    )
    return places.join(maybe_broadcast(kept), "root").where("doc_id != kept.doc_id or first != kept.first").select(
        "doc_id", "first", "stop", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.first").alias("kept_first"),
        F.col("kept.stop").alias("kept_stop"),
    )


def repeated_passages(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """One row per passage that repeats an earlier one: doc_id, first_word,
    n_words, kept_doc_id (the document that keeps the first occurrence).

    First means by doc_id, then by position. Words lie between ASCII white space,
    A-Z count as a-z. Null, empty and very short texts hold no passage. Rows
    without doc_id take no part; rows that repeat a doc_id are one document.
    Without rows the result is empty.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    paragraphs_ = repeated_paragraphs(texts, passage)
    return passages.passages(texts, passage, paragraphs_).select(
        "doc_id", F.col("first").alias("first_word"), (F.col("stop") - F.col("first")).alias("n_words"),
        F.col("kept_doc").alias("kept_doc_id"),
    )
