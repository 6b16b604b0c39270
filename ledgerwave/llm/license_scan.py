"""License scans: exact phrases, and short notices with bounded errors.

A notice that occurs with at most k edits, cut into k + 1 pieces, leaves one piece
intact (pigeonhole). One automaton finds the pieces of all notices in a single
pass over a text; around each piece found, the regex library's bounded-error
matching decides on the whole notice and gives its span and edits. Texts without
a piece or a phrase are never matched.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# Exact phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices looked for with errors, as words with single spaces, and their labels.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("reserved", "all rights reserved no part of this publication may be reproduced"),
)
# A notice may have one edit per so many letters, up to MOST; pieces then have at
# least LETTERS - 4 letters, which other text hardly ever holds by chance.
LETTERS = 15
MOST = 4

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def edits(notice: str) -> int:
    return max(1, min(MOST, len(notice) // LETTERS))


def _pieces(notice: str, k: int) -> list[tuple[int, str]]:
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds phrases and notices in one text at a time."""

    def __init__(self, notices=NOTICES):
        self.notices = [(label, n, edits(n)) for label, n in notices]
        seeds: dict[str, list] = {}
        for i, (_, n, k) in enumerate(self.notices):
            for offset, piece in _pieces(n, k):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(rf"(?e)(?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}") for _, n, k in self.notices]
        self.phrases = [(p.encode().split(), label) for p, label in PHRASES.items()]

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int]]:
        """(start, end, label, edits) of notices in text of words with single
        spaces; of overlapping finds of a notice the first stays."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for i, offset in uses:
                _, n, k = self.notices[i]
                low = max(0, end - length + 1 - offset - k)
                high = min(len(text), end - length + 1 - offset + len(n) + k)
                spans = windows.setdefault(i, [])
                if spans and low <= spans[-1][1]:
                    spans[-1][:] = min(low, spans[-1][0]), max(high, spans[-1][1])
                else:
                    spans.append([low, high])
        found = []
        for i, spans in windows.items():
            label, _, _ = self.notices[i]
            for low, high in spans:
                for m in self.patterns[i].finditer(text, low, high):
                    found.append((m.start(), m.end(), label, sum(m.fuzzy_counts)))
        return sorted(found)

    def scan(self, raw: bytes | None) -> dict:
        flat = (raw or b"").translate(_KEEP)
        words = flat.split()
        places, labels = [], set()
        for phrase, label in self.phrases:
            if not all(p in flat for p in phrase):
                continue
            for i in range(len(words) - len(phrase) + 1):
                if words[i] == phrase[0] and words[i : i + len(phrase)] == phrase:
                    places.append(i)
                    labels.add(label)
        text = b" ".join(words).decode("utf-8", "replace")
        spans = self.fuzzy(text)
        best = max([1 - e / (b - a) for a, b, _, e in spans if b > a], default=0.0)
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {s[2] for s in spans})),
            "score": 1.0 if places else float(np.clip(best, 0, 1)),
            "notices": ",".join(f"{label}:{text.count(' ', 0, a)}:{e}" for a, _, label, e in spans),
        }


FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string,"
    " score double, notices string"
)


def license_labels(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and the fields of
    ``Scanner.scan``; ``notices`` lists label:word:edits of the fuzzy finds.

    Null text counts as empty: no words, no labels, score 0, null positions. The
    score is 1 where a phrase stands, else the share of letters that the best
    notice has right, else 0. Repeated rows repeat their result; without rows
    the result is empty; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f.split()[0] for f in FIELDS.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = [types[f.split()[1]] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            columns = [pa.array([r[n] for r in rows], t) for n, t in zip(names, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {FIELDS}")
