"""Personal data: fixed patterns, and identifiers found from their contexts.

Base entities are seeds. Every identifier-like string (a run of digit groups, or
a token with several digits or an @) stands in contexts: one to three words
before it, one to three after it, and one on either side. Contexts and strings
form a graph: a context is trusted by the share of its distinct strings that are
trusted, a string by the most trusted of its contexts. The shape of a string is
evidence of its own: where strings of that shape are trusted, it raises the
trust that a context gives, and alone it gives none. Spark joins and aggregates
the graph for a few rounds, starting from the seeds; strings that end above a
confidence, in contexts with enough support, are reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.session import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.6  # trust from which a context discovers strings
SUPPORT = 5  # distinct trusted strings that a context needs

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Identifier-like strings: digit groups, also with spaces between them, or one token.
_CANDIDATE = re.compile(
    r"(?<![\w.%+@/-])(?:[+(]?[0-9][0-9().\/-]*(?: \(?[0-9][0-9().\/-]*)*(?![\w%+@])|[\w.%+/-]*[0-9@][\w.%+@/-]*)"
)
_WORD = re.compile(r"\w+")
NEAR = 80  # characters on either side in which the words of a context lie
_LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_BYTES:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            out.append((begin, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, kind's place, kind, end), sorted."""
    out = [(a, 0, "email", b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, "ip", m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def contexts_of(text: str, begin: int, end: int) -> list[str]:
    """One to three words before, one to three after, and one on either side.
    Words with digits count as one word."""
    def said(found: list[re.Match]) -> list[str]:
        return ["9" if _DIGIT.search(m[0]) else m[0].lower() for m in found]

    a, b = max(0, begin - NEAR), min(len(text), end + NEAR)
    before = said([m for m in _WORD.finditer(text, a, begin) if m.start() > a or a == 0][-3:])
    after = said([m for m in _WORD.finditer(text, end, b) if m.end() < b or b == len(text)][:3])
    out = [f"L {' '.join(before[-k:])}" for k in range(1, len(before) + 1)]
    out += [f"R {' '.join(after[:k])}" for k in range(1, len(after) + 1)]
    return out + ([f"B {before[-1]} {after[0]}"] if before and after else [])


def candidates(text: str, base: list[tuple[int, int, str, int]]) -> list[dict]:
    """Identifier-like strings with their contexts; ``seed`` is the kind of a
    base entity. Base entities stand whole, and no other string overlaps them."""
    if not _DIGIT.search(text) and "@" not in text:
        return []
    found, done = [], 0
    for begin, _, kind, end in base:
        if begin >= done:
            found.append((begin, end, kind))
        done = max(done, end)
    taken, k = sorted((a, b) for a, _, _, b in base), 0
    reach = 0  # the furthest end of base entities that begin before a string ends
    for m in _CANDIDATE.finditer(text):
        begin, end = m.span()
        value = m[0].rstrip(".,;:!?/(%+-")
        end = begin + len(value)
        while k < len(taken) and taken[k][0] < end:
            reach, k = max(reach, taken[k][1]), k + 1
        if reach <= begin and len(value) >= 5 and ("@" in value or len(_DIGIT.findall(value)) >= 4):
            found.append((begin, end, None))
    return [
        {"start": a, "stop": b, "value": text[a:b], "seed": kind, "contexts": contexts_of(text, a, b)}
        for a, b, kind in sorted(found, key=lambda x: x[:2])
    ]


_CANDIDATES = "array<struct<start:bigint,stop:bigint,value:string,seed:string,contexts:array<string>>>"


def _extract(docs: DataFrame) -> DataFrame:
    """doc_id, row, base spans and candidates of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text64 = pa.int64()
    span = pa.struct([("start", text64), ("rank", text64), ("kind", pa.string()), ("stop", text64)])
    candidate = pa.struct([
        ("start", text64), ("stop", text64), ("value", pa.string()), ("seed", pa.string()),
        ("contexts", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for t in batch.column("text"):
                text = t.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": a, "rank": r, "kind": k, "stop": b} for a, r, k, b in spans])
                found.append(candidates(text, spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(candidate))],
                ["doc_id", "base", "candidates"],
            )

    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, base array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>, candidates {_CANDIDATES}"
    )
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "entities")


def _shape(value: str) -> Column:
    """Letters as a, digits as 9, runs shortened; other signs stay."""
    plain = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), r"\p{L}", "a")
    return F.regexp_replace(plain, r"(.)\1+", "$1+")


def _raised(context: str, shape: str) -> Column:
    """The trust that a context gives to a string whose shape is trusted so far."""
    c, s = F.col(context), F.coalesce(F.col(shape), F.lit(0.0))
    return c * (1 + s * (1 - c))


def _shares(edges: DataFrame, key: str, support: int) -> DataFrame:
    """``key``, kind and trust: the share of the best kind among the strings of
    ``key``, for those with enough support."""
    by_kind = edges.groupBy(key, "kind").agg(F.sum("trust").alias("sum"), F.count("*").alias("n"))
    return by_kind.groupBy(key).agg(
        F.sum("n").alias("all"), F.max(F.when(F.col("kind").isNotNull(), F.struct("sum", "kind"))).alias("best")
    ).where(F.col("best.sum") >= support).select(
        key, F.col("best.kind").alias("kind"), (F.col("best.sum") / (F.col("all") + 1)).alias("trust")
    )


def _bootstrapped(found: DataFrame, rounds: int, confidence: float, support: int) -> tuple[DataFrame, DataFrame]:
    """Contexts (context, kind, trust) and shapes (shape, of, shape_trust) after
    the rounds. Edges are distinct and aggregated before they meet, so a
    frequent context costs its distinct strings once."""
    edges = stored(found.groupBy("context", "value").agg(F.max("seed").alias("seed")), "edges")
    trust = stored(edges.groupBy("value").agg(
        F.max("seed").alias("kind"), F.max(F.col("seed").isNotNull().cast("double")).alias("trust")
    ).withColumn("shape", _shape("value")), "trust")
    for last in range(rounds):
        contexts = stored(_shares(edges.select("context", "value").join(trust, "value"), "context", support), "contexts")
        shapes = stored(
            _shares(trust, "shape", support).select("shape", F.col("kind").alias("of"), F.col("trust").alias("shape_trust")),
            "shapes",
        )
        if last == rounds - 1:
            break
        given = edges.select("context", "value").join(
            contexts.select("context", F.col("kind").alias("of"), F.col("trust").alias("given")), "context"
        ).groupBy("value", "of").agg(F.max("given").alias("given"))
        learnt = (
            given.join(trust.select("value", "shape"), "value").join(shapes, ["shape", "of"], "left")
            .withColumn("raised", _raised("given", "shape_trust")).where(F.col("raised") >= confidence)
            .groupBy("value").agg(F.max(F.struct(F.col("raised").alias("trust"), F.col("of").alias("kind"))).alias("learnt"))
        )
        trust = stored(
            trust.join(learnt, "value", "left").select(
                "value",
                F.coalesce("kind", "learnt.kind").alias("kind"),
                F.greatest("trust", F.coalesce("learnt.trust", F.lit(0.0))).alias("trust"),
                "shape",
            ),
            "trust",
        )
    return contexts, shapes


def trusted_contexts(found: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """context, kind, trust of the contexts that discover strings of any shape.

    ``found`` has value, seed and context.
    """
    return _bootstrapped(found, rounds, confidence, support)[0].where(F.col("trust") >= confidence)


def personal_data(docs: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base and discovered,
    each an array of (start, rank, kind, stop) in code points, end exclusive.
    Discovered kinds are called like ``context-phone``.

    Null text counts as empty and has no spans. A discovered span never overlaps
    a base span. Rows are separate, also where they repeat; without rows the
    result is empty; other columns are not read.
    """
    rows = _extract(docs)
    found = rows.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    edges = found.select("row", "start", "stop", "value", "seed", F.explode("contexts").alias("context"))
    contexts, shapes = _bootstrapped(edges, rounds, confidence, support)
    given = edges.where("seed is null").join(
        contexts.select("context", F.col("kind").alias("of"), "trust"), "context"
    ).groupBy("row", "start", "stop", "value", "of").agg(F.max("trust").alias("given")).withColumn("shape", _shape("value"))
    best = F.max(F.struct(F.col("raised"), F.col("of").alias("kind"))).alias("best")
    new = (
        given.join(shapes, ["shape", "of"], "left").withColumn("raised", _raised("given", "shape_trust"))
        .where(F.col("raised") >= confidence).groupBy("row", "start", "stop").agg(best)
        .groupBy("row").agg(F.collect_list(F.struct(
            "start", F.lit(len(KINDS)).cast("long").alias("rank"), F.concat(F.lit("context-"), "best.kind").alias("kind"), "stop"
        )).alias("discovered"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,stop:bigint>>")
    return rows.join(new, "row", "left").select("doc_id", "base", F.coalesce("discovered", none).alias("discovered"))


def op9_columns(found: DataFrame) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))
        ), ",")

    def number(kind):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "discovered")).alias("spans"),
    )
