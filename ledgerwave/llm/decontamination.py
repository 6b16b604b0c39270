"""Benchmark decontamination by winnowing.

Texts are sequences of words. Of every SPAN consecutive words, winnowing keeps
the smallest hash among their GRAM-word grams, so two texts that share SPAN
words keep one hash in common: joining the kept hashes of documents with those of
benchmark items finds every shared span. A first scan carries hashes alone, and
the number of words; only documents with a hash in common are read again. Their
hits are extended: all spans that cover the matched gram are compared, word for
word, with the items' spans. Items shorter than SPAN words are looked for whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.llm.common import NOT_TERM, lower_ascii, maybe_broadcast, text_key, words
from ledgerwave.session import stored

SPAN = 10  # words of a window
GRAM = 5  # words of a gram; a window holds SPAN - GRAM + 1 of them


def _grams(hashes: str, gram: int) -> Column:
    """Hash of every ``gram`` consecutive words, from the hashes of words."""
    parts = ", ".join(f"{hashes}[i + {j}]" for j in range(gram))
    return F.expr(
        f"if(size({hashes}) < {gram}, array(), transform(sequence(0, size({hashes}) - {gram}), i -> xxhash64({parts})))"
    )


def _kept(span: int, gram: int) -> Column:
    """Positions of the grams that winnowing keeps: the first smallest of each
    span. The low bits of a hash give way to the gram's place in its span, so
    that one minimum yields hash and place; runs of the same choice are one."""
    grams = span - gram + 1
    bits = (grams - 1).bit_length()
    mask = (1 << bits) - 1
    marked = ", ".join(f"(g[i + {j}] & {~mask}L) | {j}L" for j in range(grams))
    marked = f"least({marked})" if grams > 1 else marked
    places = f"transform(sequence(0, size(g) - {grams}), i -> i + cast({marked} & {mask}L as int))"
    return F.expr(f"if(size(g) < {grams}, array(), array_distinct({places}))")


def _winnowed(texts: DataFrame, ids: list[str], span: int, gram: int) -> DataFrame:
    """ids, terms, g (gram hashes), kept (places of those that winnowing keeps)."""
    return (
        texts.select(*ids, "terms", F.transform("terms", lambda w: F.xxhash64(w)).alias("h"))
        .select(*ids, "terms", _grams("h", gram).alias("g"))
        .select(*ids, "terms", "g", _kept(span, gram).alias("kept"))
    )


def _seeds(texts: DataFrame, ids: list[str], span: int, gram: int) -> DataFrame:
    """ids, seed, at, near: kept hashes with the words around them; ``at`` is the
    position of the first of these words."""
    back = span - gram
    return (
        _winnowed(texts, ids, span, gram)
        .select(*ids, F.explode(F.expr(
            f"transform(kept, p -> struct(g[p] as seed, greatest(p - {back}, 0) as at, p,"
            f" slice(terms, greatest(p - {back}, 0) + 1, p + {span} - greatest(p - {back}, 0)) as near))"
        )).alias("s"))
        .select(*ids, "s.*")
    )


def _first_pass(texts: DataFrame, ids: list[str], seeds: DataFrame, span: int, gram: int) -> DataFrame:
    """ids, n_words, one row per row of ``texts``, and ids, null where a text holds
    a seed: one scan that carries hashes alone."""
    # The row that counts words has a hash too, spread like the others.
    own = F.expr(f"struct(cast(size(terms) as bigint) as n_words, xxhash64({', '.join(ids)}) as seed)")
    kept = F.expr("transform(kept, p -> struct(cast(null as bigint) as n_words, g[p] as seed))")
    rows = _winnowed(texts, ids, span, gram).select(*ids, F.explode(F.concat(F.array(own), kept)).alias("s"))
    known = maybe_broadcast(seeds).withColumnRenamed("seed", "known")
    met = rows.select(*ids, "s.*").join(known, F.col("seed") == F.col("known"), "left")
    return met.where("n_words is not null or known is not null").select(*ids, "n_words")


def _spans(seeds: DataFrame, ids: list[str], span: int) -> DataFrame:
    """Every whole span that covers a seed: ids, start, words."""
    found = F.expr(
        f"transform(filter(sequence(at, p), s -> s - at + {span} <= size(near)),"
        f" s -> struct(s as start, array_join(slice(near, s - at + 1, {span}), ' ') as words))"
    )
    return seeds.select(*ids, F.explode(found).alias("w")).select(*ids, "w.*")


def _whole(texts: DataFrame, ids: list[str], length: int) -> DataFrame:
    """All runs of ``length`` words: ids, start, words."""
    runs = F.expr(
        f"if(size(terms) < {length}, array(), transform(sequence(0, size(terms) - {length}),"
        f" s -> struct(s as start, array_join(slice(terms, s + 1, {length}), ' ') as words)))"
    )
    return texts.select(*ids, F.explode(runs).alias("w")).select(*ids, "w.*")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", text_key(F.col("text")).alias("key"), words(lower_ascii(F.col("text")), NOT_TERM).alias("terms")
    )


def _scanned(docs: DataFrame, benchmark: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Word counts (doc_id, key, n_words) per row of ``docs``, and what ``hits`` returns."""
    items = stored(
        benchmark.select(
            F.col("item_id").cast("string").alias("item_id"),
            words(lower_ascii(F.col("text")), NOT_TERM).alias("terms"),
        ).where("size(terms) > 0"),
        "items",
    )
    ids = ["doc_id", "key"]
    length = F.least(F.size("terms"), F.lit(span))
    # Every window of the items once, with the items that hold it.
    windows = stored(
        items.select("item_id", F.explode(F.expr(
            f"transform(sequence(0, greatest(size(terms) - {span}, 0)), s -> array_join(slice(terms, s + 1, {span}), ' '))"
        )).alias("words"), length.alias("length"))
        .groupBy("words", "length")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items")),
        "windows",
    )
    seeds = stored(
        _seeds(items.where(F.size("terms") >= span), ["item_id"], span, gram).select("seed").distinct(), "item-seeds"
    )
    scanned = stored(_first_pass(_texts(docs), ids, seeds, span, gram), "scanned")
    # Only texts that hold a seed are cut into spans.
    holding = stored(scanned.where("n_words is null").select(*ids).distinct(), "holding")
    h = maybe_broadcast(holding).withColumnsRenamed({"doc_id": "held_id", "key": "held_key"})
    candidates = docs.join(
        h, docs["doc_id"].eqNullSafe(h["held_id"]) & text_key(docs["text"]).eqNullSafe(h["held_key"]), "left_semi"
    )
    spans = _spans(_seeds(_texts(candidates), ids, span, gram).join(maybe_broadcast(seeds), "seed", "left_semi"), ids, span)
    # At most span - 1 lengths.
    short = [r[0] for r in windows.where(F.col("length") < span).select("length").distinct().collect()]
    for n in sorted(short):
        spans = spans.unionByName(_whole(_texts(docs), ids, n))
    found = (
        spans.join(maybe_broadcast(windows), "words")
        .groupBy(*ids)
        .agg(
            F.collect_set(F.struct("start", "length")).alias("at"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(
            *ids,
            F.size(F.array_distinct(F.flatten(F.expr("transform(at, a -> sequence(a.start, a.start + a.length - 1))")))).cast("long").alias("n_hit"),
            "items",
        )
    )
    return scanned.where("n_words is not null"), found


def hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, key (hash of the text), n_hit, items for every document of
    ``docs`` (doc_id, text) that holds a window of ``benchmark`` (item_id, text).

    Words are runs of a-z, 0-9 and
    characters beyond ASCII, A-Z lower-cased. A word of a document is hit when
    it lies in an occurrence of ``span`` consecutive words of an item, or of a
    whole item that has fewer. Null or empty texts have no words and no hits.
    Items without an id hit words but cannot be listed; an id that repeats is
    one item. Rows of ``docs`` that repeat doc_id and text are one document.
    Without items, or without documents, the result is empty.
    """
    return _scanned(docs, benchmark, span, gram)[1]


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (ids
    as text, sorted), contaminated; cases as in ``hits``. Rows that repeat doc_id
    and text get the same result each."""
    counted, found = _scanned(docs, benchmark, span, gram)
    found = found.withColumnsRenamed({"doc_id": "hit_id", "key": "hit_key"})
    met = counted.join(
        found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("key").eqNullSafe(F.col("hit_key")), "left"
    )
    none = F.array().cast("array<string>")
    return met.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


OP1_SQL = r"""
with lowered as (
  select 'd' as kind, doc_id::varchar as id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
  union all
  select 'b', item_id::varchar,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  from benchmark),
wins as (
  select distinct id as item, n, array_to_string(w[s:s + n - 1], ' ') as g
  from (select id, w, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s
        from lowered where kind = 'b' and len(w) > 0)),
lens as (select distinct n from wins),
runs as (
  select id, s, n, array_to_string(w[s:s + n - 1], ' ') as g
  from (select id, w, n, unnest(range(1, len(w) - n + 2)) as s from lowered, lens where kind = 'd' and len(w) >= n)),
found as (select id, s, runs.n, item from runs join wins using (g)),
words_hit as (
  select id, count(distinct p) as n_hit from (select id, unnest(range(s, s + n)) as p from found) group by id),
items_hit as (
  select id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from found group by id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from documents d join lowered l on l.kind = 'd' and l.id = d.doc_id::varchar
left join words_hit h on h.id = l.id left join items_hit i on i.id = l.id
"""
