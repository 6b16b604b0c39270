"""Packing of tokenized documents into sequences of a fixed length.

1. Every text becomes token ids plus an end id; texts longer than a sequence are
   cut into pieces. Only lengths go on, ids on request.
2. The histogram of piece lengths (at most as many rows as a sequence has tokens)
   comes to the driver. Patterns of one to four lengths that fill a sequence exactly are
   enumerated, non-negative least squares fits how often each repeats, the counts
   are rounded to what the histogram holds, and the residual pieces are packed by
   best fit, longest first, all pieces of one length at a time.
3. The plan gives, per length, ranges of piece numbers and their places. Pieces are
   numbered within their length in parallel and joined with the ranges.

The plan costs the same for any number of documents: its size depends on the
sequence length alone.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerwave.session import stored

LENGTH = 4096  # tokens of a sequence
END = 1  # id behind every document
VOCABULARY = "word_bpe_49k.json"

# Bounds of the cache of a worker, about: parts of texts, bytes of parts and ids; and
# of the text that is worked on at a time.
CACHED = 1_000_000
CACHED_BYTES = 64_000_000
STRETCH = 2_000_000
TOGETHER = 5_000  # parts in one call of the tokenizer
MARK = "<|endoftext|>"

# Partners tried per length in patterns of three and four, steps of the fit.
PARTNERS = 8
STEPS = 400


# Small Latin letters of one code point each, which normalising leaves as they are.
SMALL = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower())
# A word of them, with at most one punctuation mark behind it: tokens apart.
_WORD = re.compile(f"([{SMALL}]+)([.,;:!?])?")


class PartIds(dict):
    """Ids (little-endian 32-bit, as bytes) of the parts of a text between blanks
    or line feeds.

    No token reaches over a blank, so the ids of a text are those of its parts
    one after another, and ASCII case makes no difference to this vocabulary. The
    tokenizer sees every distinct part once while the bounded cache holds it, many
    of them in one call, with a special token between them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.token_to_id(MARK)
        # Words of small letters alone need no normalising and no finer cut. Where
        # the vocabulary marks the last token of a word, that parts their ids.
        model = self.tokenizer.model
        self.plain = Tokenizer(model)
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = model.end_of_word_suffix or None
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(names.values(), default=0) + 1, bool)
        if suffix:
            self.last[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.size = 0
        self.older: dict[bytes, bytes] = {}

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text. Long texts are worked on in stretches, so the
        parts held at a time are bounded."""
        found: list[list[bytes]] = [[] for _ in texts]
        parts: list[bytes] = []
        ends: list[tuple[int, int]] = []
        held = 0
        for k, text in enumerate(texts):
            for stretch in self._stretches(text):
                parts += stretch.replace(b"\n", b" ").split(b" ")
                ends.append((k, len(parts)))
                held += len(stretch)
                if held > STRETCH:
                    self._look_up(parts, ends, found)
                    parts, ends, held = [], [], 0
        self._look_up(parts, ends, found)
        return [b"".join(f) for f in found]

    def _look_up(self, parts: list[bytes], ends: list[tuple[int, int]], found: list[list[bytes]]) -> None:
        # Two generations: what the older one holds is taken over when it is asked for.
        if 2 * len(self) > CACHED or 2 * self.size > CACHED_BYTES:
            self.older = dict(self)
            self.clear()
            self.size = 0
        ids = list(map(self.get, parts))
        new = [i for i, x in enumerate(ids) if x is None]
        asked = {parts[i] for i in new}
        known = [p for p in asked if p in self.older]
        self._keep(known, [self.older[p] for p in known])
        self._learn(asked.difference(known))
        for i in new:
            ids[i] = self[parts[i]]
        at = 0
        for k, end in ends:
            found[k].append(b"".join(ids[at:end]))
            at = end

    @staticmethod
    def _stretches(text: bytes) -> Iterator[bytes]:
        # Special tokens are read before letters become small: such texts keep theirs.
        text = text if b"<|" in text else text.lower()
        at = 0
        while len(text) - at > STRETCH:
            end = text.find(b" ", at + STRETCH)
            if end < 0:
                break
            yield text[at:end]
            at = end + 1
        yield text[at:]

    def _learn(self, parts: set[bytes]) -> None:
        closed, letters, other = [], set(), []
        suffixed = self.last.any()
        for part in parts:
            text = part.decode("utf-8", "replace")
            word = _WORD.fullmatch(text) if suffixed else None
            if word is None:
                other.append((part, text))
            elif word[2]:
                stem = word[1].encode()
                closed.append((part, stem, word[2].encode()))
                if stem not in self:
                    letters.add(word[1])
            else:
                letters.add(text)
        ends = {end for *_, end in closed} - self.keys()
        self._learn_words(list(letters))
        self._learn_others(other + [(end, end.decode()) for end in ends])
        self._keep([p for p, *_ in closed], [self[stem] + self[end] for _, stem, end in closed])

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = self._ids(self.plain, " ".join(some))
            self._keep([w.encode() for w in some], _cut(ids, np.flatnonzero(self.last[ids]) + 1))

    def _learn_others(self, parts: list[tuple[bytes, str]]) -> None:
        """Parts that the whole tokenizer has to see; a special token lies between them."""
        alone = [(p, t) for p, t in parts if self.mark is None or "<|" in t]
        self._keep([p for p, _ in alone], [self._ids(self.tokenizer, t).tobytes() for _, t in alone])
        rest = [(p, t) for p, t in parts if self.mark is not None and "<|" not in t]
        for at in range(0, len(rest), TOGETHER):
            some = rest[at : at + TOGETHER]
            ids = self._ids(self.tokenizer, f" {MARK} ".join([t for _, t in some]))
            marks = np.flatnonzero(ids == self.mark)
            # The marks are left out; those before a place number the parts before it.
            ends = np.append(marks - np.arange(len(marks)), len(ids) - len(marks))
            self._keep([p for p, _ in some], _cut(ids[ids != self.mark], ends))

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        (made,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(made.ids, "<u4")

    def _keep(self, parts: list[bytes], ids: list[bytes]) -> None:
        self.update(zip(parts, ids, strict=True))
        self.size += sum(map(len, parts)) + sum(map(len, ids))


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, places = ids.tobytes(), (4 * ends).tolist()
    return [raw[start:end] for start, end in zip([0, *places], places)]


_CACHES: dict[str, PartIds] = {}


def part_ids(path: str) -> PartIds:
    """One cache per worker and vocabulary."""
    if path not in _CACHES:
        _CACHES[path] = PartIds(path)
    return _CACHES[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, text_key, piece, start, length, ids_crc32 (and ids, an array) of
    every piece of every row. ``path`` names the vocabulary on the executors."""
    named = path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = part_ids(named or vocabulary_path())
        tail = np.array([end], "<u4").tobytes()
        width = 4 * length
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
            keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            for doc, key, found in zip(*keys, cache.of(texts), strict=True):
                every = memoryview(found + tail)
                for k, at in enumerate(range(0, len(every), width)):
                    part = every[at : at + width]
                    rows.append((doc, key, k, at // 4, len(part) // 4, zlib.crc32(part), part if ids else None))
                    held += len(part) if ids else 0
                if held > 32_000_000:
                    yield _batch(rows, ids)
                    rows, held = [], 0
            yield _batch(rows, ids)

    schema = "doc_id bigint, text_key bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return source.mapInArrow(run, schema + (", ids array<int>" if ids else ""))


_NAMES = ["doc_id", "text_key", "piece", "start", "length", "ids_crc32"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _batch(rows: list[tuple], ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 7
    made = [pa.array(c, t) for c, t in zip(columns, _TYPES)]
    if not ids:
        return pa.RecordBatch.from_arrays(made, _NAMES)
    ends = np.cumsum([0, *columns[4]]).astype(np.int32)
    flat = np.frombuffer(b"".join(columns[6]), "<i4")
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
    return pa.RecordBatch.from_arrays([*made, lists], [*_NAMES, "ids"])


def patterns_of(have: np.ndarray, length: int) -> np.ndarray:
    """Patterns of one to four lengths that fill a sequence, as rows of lengths
    padded with 0, each in falling order. ``have[n]`` pieces are n long.

    One and two lengths: all there are. Three and four: every longest length
    (and every pair of those) with its PARTNERS most frequent partners, so the
    number of patterns grows with the number of lengths alone.
    """
    there = np.flatnonzero(have)
    found = [(length,)] if have[length] else []
    for a in there[there < length]:
        rest = length - a
        if rest <= a and have[rest]:
            found.append((a, rest))
        seconds = _frequent(there[(there <= a) & (there < rest) & (2 * there >= rest)], have)
        for b in seconds:
            if have[rest - b]:
                found.append((a, b, rest - b))
        # Of four: a, a frequent b, and the halves of what is left.
        for b in _frequent(there[(there <= a) & (3 * there >= rest) & (there < rest - 1)], have, PARTNERS // 4):
            left = rest - b
            for c in _frequent(there[(there <= b) & (there < left) & (2 * there >= left)], have, PARTNERS // 2):
                if have[left - c]:
                    found.append((a, b, c, left - c))
    out = np.zeros((len(found), 4), np.int64)
    for k, lengths in enumerate(found):
        out[k, : len(lengths)] = lengths
    return out[(np.diff(out, axis=1) <= 0).all(axis=1)]


def _frequent(lengths: np.ndarray, have: np.ndarray, k: int = PARTNERS) -> np.ndarray:
    return lengths[np.lexsort((lengths, -have[lengths]))[:k]]


def repeat_counts(patterns: np.ndarray, have: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often each pattern repeats so that all of
    them together come closest to the histogram.

    Accelerated projected gradients. A pattern has at most four entries, so a step
    costs the number of patterns. Lengths are weighted by one over the number of
    patterns that use them, which bounds the curvature by the four entries.
    """
    if not len(patterns):
        return np.zeros(0)
    size = len(have)
    target = have.astype(float)
    uses = np.bincount(patterns.ravel(), minlength=size)
    weight = 1.0 / np.maximum(uses, 1)
    weight[0] = 0.0  # padding
    x = ahead = np.zeros(len(patterns))
    turn = 1.0
    for _ in range(steps):
        gap = weight * (np.bincount(patterns.ravel(), np.repeat(ahead, 4), size) - target)
        after = np.maximum(0.0, ahead - gap[patterns].sum(axis=1) / 4)
        further = (1 + (1 + 4 * turn * turn) ** 0.5) / 2
        ahead = after + (turn - 1) / further * (after - x)
        x, turn = after, further
    return x


class Plan:
    """Which places the pieces of each length take.

    ``ranges`` has, per place in a run of equal sequences: length, number of the
    first piece of that length, offset, first sequence of the run.
    """

    def __init__(self, have: np.ndarray, length: int = LENGTH):
        self.length = length
        self.sequences = 0
        self.ranges: list[tuple[int, int, int, int]] = []
        self._next = np.zeros(length + 1, np.int64)
        left = have.astype(np.int64).copy()
        left[0] = 0
        patterns = patterns_of(left, length)
        carry = 0.0
        for pattern, count in zip(patterns, repeat_counts(patterns, left)):
            # Rounding passes its error on, so many small counts keep their sum.
            carry = min(1.0, carry + count)
            lengths, times = np.unique(pattern[pattern > 0], return_counts=True)
            n = int(min(np.floor(max(carry, count) + 0.5), (left[lengths] // times).min()))
            carry = max(-0.5, carry - n)
            if n > 0:
                left[lengths] -= n * times
                self._emit([int(x) for x in pattern if x], n)
        for lengths, n in best_fit(left, length):
            self._emit(lengths, n)

    def _emit(self, lengths: list[int], n: int) -> None:
        """n sequences that each hold ``lengths``, in this order."""
        offset = 0
        for size in lengths:
            self.ranges.append((size, int(self._next[size]), offset, self.sequences))
            self._next[size] += n
            offset += size
        self.sequences += n

    def table(self) -> np.ndarray:
        """The ranges by length and first number, as rows of a matrix."""
        return np.array(sorted(self.ranges), np.int64).reshape(-1, 4)


def best_fit(have: np.ndarray, length: int) -> list[tuple[list[int], int]]:
    """Best fit decreasing on a histogram: (lengths, number of such sequences).

    All pieces of one length are placed together. Sequences alike in content are
    one class; a length fills whole classes and splits at most the last one, so
    there are at most a few classes per length.
    """
    open_: dict[int, list[tuple[list[int], int]]] = {}  # room left -> (lengths, count)
    rooms: list[int] = []  # the keys of open_, in order
    done: list[tuple[list[int], int]] = []

    def put(room: int, lengths: list[int], n: int) -> None:
        if n and room:
            if room not in open_:
                bisect.insort(rooms, room)
            open_.setdefault(room, []).append((lengths, n))
        elif n:
            done.append((lengths, n))

    for size in range(length, 0, -1):
        left = int(have[size])
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                lengths, n = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, lengths = length, []
                n = -(-left // (length // size))
            each = room // size
            full = min(n, left // each)
            put(room - each * size, lengths + [size] * each, full)
            left, n = left - full * each, n - full
            if n and left:  # too few for one more full round: one sequence takes them
                put(room - left * size, lengths + [size] * left, 1)
                left, n = 0, n - 1
            put(room, lengths, n)
    return done + [one for classes in open_.values() for one in classes]


def placed(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``parts`` (stored pieces, with part_) and sequence_id, offset."""
    have = np.zeros(length + 1, np.int64)
    for size, n in parts.groupBy("length").count().collect():  # at most ``length`` rows
        have[size] = n
    # The plan's size depends on the sequence length alone.
    table = parts.sparkSession.sparkContext.broadcast(Plan(have, length).table())
    # Numbers within a length: those of earlier write tasks, then the place in its own.
    tasks = parts.groupBy("length", "part_").agg(F.count("*").alias("n_"))
    earlier = Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select("length", "part_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"))
    inside = Window.partitionBy("length", "part_").orderBy("doc_id", "text_key", "piece")
    numbered = parts.withColumn("number_", F.row_number().over(inside) - 1).join(before, ["length", "part_"]).withColumn(
        "number_", F.col("number_") + F.col("before_")
    ).drop("part_", "before_", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, offset, base = table.value.T
        keys = (size << 48) + first
        for batch in batches:
            number = batch.column("number_").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 48) + number, side="right") - 1
            rest = batch.drop_columns(["number_"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(base[at] + number - first[at]), pa.array(offset[at])],
                [*rest.schema.names, "sequence_id", "offset"],
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number_"]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of
    every piece of every row of ``docs`` (doc_id, text).

    A null or empty text is its end id alone. Rows that repeat are packed as often
    as they occur; a row without doc_id is packed too. Texts may be of any length.
    Other columns are left alone. Without rows the result is empty.
    """
    parts = stored(pieces(docs, path, length, end, ids).withColumn("part_", F.spark_partition_id()), "pieces")
    return placed(parts, length)


def sequences(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, at most ``length`` ids."""
    each = packed(docs, path, length, end, ids=True)
    gathered = each.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
