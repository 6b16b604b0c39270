"""Phrase collocations by marginalising the longest windows.

Every word of a piece starts one window: itself and the four words behind it, as
lead columns of the word array, padded with null at the end of the piece. Only
these longest windows are counted; ROLLUP over (lang, w1, ..., w5) then sums the
counts of every shorter prefix, down to the words and to the total per language.

Counting all windows whole would shuffle the corpus several times over, and
nearly all of them are unique. So they are cut first where no candidate can
continue: a phrase with ``least`` occurrences holds only pairs of neighbours that
have as many. Pairs are counted by 64-bit hash; hashes that collide only add up,
so a pair that is frequent enough is never missed, and a pair that is kept in
error is counted exactly afterwards. The kept pairs, 8 bytes each, are broadcast up
to a counted number and meet the windows by shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.llm.common import lower_ascii, maybe_broadcast
from ledgerwave.session import stored

WIDTH = 5  # words of the longest phrase
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases returned per language
PAIRS = 1_000_000  # hashes of pairs that are broadcast; more are joined by shuffle

PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"


def pieces(docs: DataFrame) -> DataFrame:
    """lang, words: the pieces of every text; some have no words."""
    split = F.split(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), PIECE_ENDS, -1)
    each = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.explode(split).alias("piece"))
    return each.select("lang", F.filter(F.split("piece", BLANKS, -1), lambda w: w != "").alias("words"))


def windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """lang, w1 ... w<width>: one row per word, null behind the end of its piece."""
    words = F.col("words")
    lead = [words, *[F.slice(words, k + 1, F.greatest(F.size(words) - k, F.lit(0))) for k in range(1, width)]]
    zipped = F.arrays_zip(*[c.alias(f"w{k + 1}") for k, c in enumerate(lead)])
    rows = pieces(docs).select("lang", F.explode(zipped).alias("w"))
    return rows.select("lang", "w.*")


def pair_key(k: int) -> Column:
    return F.xxhash64("lang", f"w{k}", f"w{k + 1}")


def frequent_pairs(docs: DataFrame, least: int) -> DataFrame:
    """pair: hashes of neighbouring words with ``least`` occurrences or more."""
    pairs = windows(docs, 2).where("w2 is not null").select(pair_key(1).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("pair")


def cut_windows(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Windows up to the first pair that is not frequent; null behind it."""
    rows = windows(docs, width)
    pairs = maybe_broadcast(pairs, PAIRS)
    for k in range(1, width):
        known = pairs.select(F.col("pair").alias(f"p{k}"))
        going = F.col(f"p{k}").isNotNull() & F.col(f"w{k}").isNotNull()
        rows = rows.join(known, pair_key(k) == F.col(f"p{k}"), "left").withColumn(
            f"w{k + 1}", F.when(going, F.col(f"w{k + 1}"))
        ).drop(f"p{k}")
    return rows


def phrase_counts(docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """lang, size, words, n. Size 0: all words of a language; else the phrases of
    ``size`` words that occur ``least`` times."""
    pairs = stored(frequent_pairs(docs, least), "pairs")
    names = [f"w{k}" for k in range(1, width + 1)]
    longest = stored(
        cut_windows(docs, pairs, width).groupBy("lang", *names).agg(F.count("*").alias("n")), "windows"
    )
    summed = longest.rollup("lang", *names).agg(F.sum("n").alias("n"), F.grouping_id().alias("left_out"))
    words = F.array(*names)
    # The bits of the grouping number mark the columns that are summed over.
    size = F.lit(width) - F.length(F.replace(F.bin("left_out"), F.lit("0"), F.lit("")))
    sized = summed.where(F.col("lang").isNotNull()).select("lang", size.alias("size"), words.alias("all"), "n")
    whole = (F.col("size") == 0) | (F.get("all", F.col("size") - 1).isNotNull() & (F.col("n") >= least))
    return sized.where("size >= 0").where(whole).select(
        "lang", F.col("size").cast("int").alias("size"), F.slice("all", F.lit(1), F.col("size").cast("int")).alias("words"), "n"
    )


def score() -> Column:
    """floor(1000 * a * total / (l * r)) in decimals of 38 digits."""
    return F.expr(
        "cast(1000 * cast(a as decimal(19, 0)) as decimal(22, 0)) * cast(total as decimal(15, 0))"
        " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    )


def collocations(docs: DataFrame, width: int = WIDTH, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    ``docs`` has text and lang; other columns are left alone. Null texts have no
    words; a null lang is ``und``. ``a`` counts the phrase, ``l`` and ``r`` the two
    parts of its lowest-scoring cut (of equal scores the first), ``n`` all words of
    the language; score = floor(1000 * a * n / (l * r)), exact in 38 digits. A
    phrase goes when some longer candidate holds it and occurs as often. Rows that repeat count
    as often as they occur; equal scores are ordered by a, then by the phrase in
    UTF-8 bytes. Without candidates the result is empty.
    """
    counted = stored(phrase_counts(docs, width, least), "phrases").withColumn("phrase", F.array_join("words", " "))
    totals = counted.where("size = 0").select("lang", F.col("n").alias("total"))
    parts = counted.where("size > 0").select("lang", "phrase", "n")
    candidates = counted.where("size > 1")

    # If any longer candidate occurs as often, so does one that is one word longer.
    longer = counted.where("size > 2").select(
        "lang", F.col("n").alias("held"),
        F.explode(F.array(
            F.array_join(F.slice("words", F.lit(1), F.col("size") - 1), " "),
            F.array_join(F.slice("words", F.lit(2), F.col("size") - 1), " "),
        )).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where("held is null or held < n")

    cuts = kept.select("lang", "phrase", "words", "size", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn("score", score())
    worst = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("cut")
    ).select("lang", "phrase", "cut.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as p
  from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from p),
g as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, w[i:i + k - 1] as words
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from w) cross join (select unnest([1, 2, 3, 4, 5]) as k)
  where i + k - 1 <= len(w)),
t as (select lang, count(*) as n from g where k = 1 group by lang),
f as (select lang, k, phrase, any_value(words) as words, count(*) as f from g group by all having count(*) >= 100),
c as (select * from f where k > 1),
sub as (
  select lang, array_to_string(words[i:i + j - 1], ' ') as phrase, f
  from (select lang, k, words, f, unnest(range(1, k)) as j from c) cross join (select unnest([1, 2, 3, 4]) as i)
  where i + j - 1 <= k),
kept as (
  select * from c
  where not exists (select 1 from sub where sub.lang = c.lang and sub.phrase = c.phrase and 100 * sub.f >= 100 * c.f)),
cuts as (
  select lang, phrase, f as a, j, array_to_string(words[1:j], ' ') as x, array_to_string(words[j + 1:k], ' ') as y
  from (select *, unnest(range(1, k)) as j from kept)),
s as (
  select cuts.lang, cuts.phrase, a, j, x.f as l, y.f as r, t.n,
    (1000::hugeint * a * t.n // (x.f::hugeint * y.f))::bigint as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x join f y on y.lang = cuts.lang and y.phrase = cuts.y
  join t on t.lang = cuts.lang),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from b qualify rank <= 2000
"""
