"""Mix sources to target weights by Sainte-Lague apportionment of equal blocks.

Each source's documents are dealt into shards of about a million words, so that
a source with a third of all rows is many groups, none of them large. Targets are
votes, shared among the shards of a source by size. The number of seats is that of
the mix. Every (source, shard) first gets the seats that its votes pay for in full:
blocks of BLOCK words, then single words. The seats that are left go one each to the
highest quotients votes / (2 j + 1), j the seats held, among all pairs that may
take one more. That makes a whole quota of words per shard, within a word of its
votes, and a mix of exactly its size.

Inside a shard the documents are laid end to end in a seeded order and cut into
blocks. Quotas above the size of a shard take it whole first; for the rest blocks
are taken in the order of a seeded hash, the last one in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.llm.common import NOT_SPACES, maybe_broadcast
from ledgerwave.llm.ordered import with_running
from ledgerwave.session import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # size of the mix over the size of all documents
REPEATS = 2  # most times that any word may be taken
BLOCK = 32
SHARD = 1_000_000
SEED = "mix-1"


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target: the level at which the capped shares of all
    sources add up to the mix, found from running sums of caps and weights in
    the order in which sources reach their caps. Sources take the weights in
    turn, by code point, null last."""
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = with_running(
        sizes, [F.col("source").isNull(), F.col("source")], {"place": F.lit(1)}
    ).withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")),
    )
    cap = repeats * F.col("source_size")
    reach = cap / F.col("weight")
    filled = stored(
        with_running(
            ranked.withColumn("reach", reach),
            [F.col("reach"), F.col("place")],
            {"caps": cap, "weights": F.col("weight")},
        ),
        "filled",
    )
    all_ = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = all_[0] or 0, all_[1] or 0
    level = (F.lit(share * total) - F.col("caps")) / (F.lit(weight) - F.col("weights"))
    # One number: the first level that the next source's cap does not undercut.
    low = (
        filled.withColumn("level", level)
        .where("reach >= level")
        .agg(F.min_by("level", F.struct("reach", "place")))
        .first()[0]
    )
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(0.0 if low is None else float(low)))
    return filled.select("source", "source_size", target.alias("target"))


def source_key() -> Column:
    """Sources as keys of joins and windows, null included."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def shard_quotas(shards: DataFrame, words: int, repeats: int = REPEATS) -> DataFrame:
    """key, shard, quota: the words that the mix of ``words`` takes from every shard.

    ``shards`` has key, shard, shard_size, source_size and target.
    """
    votes = F.col("target") * F.col("shard_size") / F.col("source_size")
    paid = stored(
        shards.withColumn("votes", votes).withColumn("held", F.floor("votes")), "paid"
    )
    left = words - (paid.agg(F.sum("held")).first()[0] or 0)
    more = paid.where((F.col("held") < F.col("votes")) & (F.col("held") < repeats * F.col("shard_size")))
    quotient = F.col("votes") / (2 * F.col("held") + 1)
    ranked = with_running(
        more.select("key", "shard", quotient.alias("quotient")),
        [F.desc("quotient"), F.col("key"), F.col("shard")], {"place": F.lit(1)},
    )
    won = ranked.where(F.col("place") < left).select("key", "shard", F.lit(1).alias("won"))
    return paid.join(won, ["key", "shard"], "left").select(
        "key", "shard", (F.col("held") + F.coalesce("won", F.lit(0))).alias("quota")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: str = SEED,
    keyed: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size,
    source_size, target, taken; with ``keyed`` also text_key, a hash of the text.

    ``taken`` counts words that the mix takes from the document, repeats
    included, from 0 to ``repeats`` times its size; null or empty texts have
    size and taken 0. The words taken from a source differ from its target by less
    than one per shard. A null source is a source of its own and comes last. Rows
    that repeat a doc_id are separate documents. Choices depend on the seed and
    the rows alone. Other columns are left alone. Without rows the result is empty.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(NOT_SPACES)), F.lit(0)).cast("long")
    own = [F.xxhash64("text").alias("text_key")] if keyed else []
    sized = stored(docs.select("doc_id", F.col("source").cast("string"), size.alias("size"), *own), "sizes")
    targets = stored(source_targets(sized, weights, share, repeats), "targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    words = int(min(share, repeats) * total + 0.5)

    t = maybe_broadcast(targets.select(source_key().alias("key"), "source_size", "target"))
    rows = sized.withColumn("key", source_key()).join(t, "key")
    draw = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    shards = F.ceil(F.col("source_size") / shard).cast("long")
    dealt = stored(
        rows.where("size > 0").withColumn("draw", draw)
        .withColumn("shard", F.conv(F.substring("draw", 25, 8), 16, 10).cast("long") % shards),
        "dealt",
    )
    sizes = dealt.groupBy("key", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    quotas = stored(shard_quotas(stored(sizes, "shards"), words, repeats), "quotas")

    # From here on everything happens inside (key, shard): one exchange.
    laid = Window.partitionBy("key", "shard").orderBy("draw", "doc_id", "size")
    placed = dealt.join(maybe_broadcast(quotas), ["key", "shard"]).withColumns({
        "end": F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)),
        "nth": F.row_number().over(laid),
        "shard_size": F.sum("size").over(Window.partitionBy("key", "shard")),
    }).withColumn("start", F.col("end") - F.col("size"))
    pieces = placed.withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block}, (end - 1) div {block})"))
    )
    ticket = F.md5(F.concat_ws(
        "|", F.lit(seed), F.coalesce("source", F.lit("null")), F.col("shard").cast("string"), F.col("block").cast("string")
    ))
    # The shorter block at the end of a shard comes last.
    short = F.col("block") >= F.floor(F.col("shard_size") / block)
    turns = Window.partitionBy("key", "shard").orderBy(short, ticket, "block")
    ranked = pieces.withColumn("turn", F.dense_rank().over(turns) - 1)
    first, last = F.greatest("start", F.col("block") * block), F.least("end", (F.col("block") + 1) * block)
    rounds, rest = F.floor(F.col("quota") / F.col("shard_size")), F.col("quota") % F.col("shard_size")
    # Words of the block that its turn reaches: all, some from its start, or none.
    reached = F.least(F.lit(block), F.greatest(F.lit(0), rest - F.col("turn") * block))
    part = F.greatest(F.lit(0), F.least(last, F.col("block") * block + reached) - first)
    taken = ranked.groupBy("key", "shard", "nth").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target", *(["text_key"] if keyed else []))],
        F.sum(rounds * (last - first) + part).cast("long").alias("taken"),
    )
    columns = ["doc_id", "source", *(["text_key"] if keyed else []), "size", "source_size", "target", "taken"]
    return taken.select(columns).unionByName(
        rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(columns)
    )


OP8_SQL = rf"""
with s as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{NOT_SPACES}')) as bigint) as size
  from documents),
w as (
  select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 as integer) + 1] as weight,
    row_number() over (order by source nulls last) as place
  from s group by source),
r as (
  select *, 2 * source_size / weight as reach,
    (1.5::double * (sum(source_size) over ())::double
      - coalesce(sum(2 * source_size) over before, 0)::double)
    / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
  from w
  window before as (order by 2 * source_size / weight, place rows between unbounded preceding and 1 preceding)),
t as (
  select source, source_size,
    least((2 * source_size)::double, weight * (select arg_min(level, (reach, place)) from r where reach >= level)) as target
  from r),
p as (
  select s.*, source_size, target, md5('{SEED}|' || coalesce(doc_id::varchar, 'null')) as draw
  from s join t on s.source is not distinct from t.source),
q as (
  select *, ('0x' || draw[25:32])::bigint % cast(ceil(source_size / {SHARD}) as bigint) as shard
  from p where size > 0),
o as (
  select *, cast(sum(size) over (partition by source, shard order by draw, doc_id, size
    rows between unbounded preceding and current row) as bigint) as stop
  from q),
c as (
  select source, shard, sum(size)::bigint as shard_size,
    any_value(target) * sum(size)::double / any_value(source_size) as votes
  from o group by source, shard),
-- Highest quotients: whole seats first, the rest of the mix by rank.
seats as (
  select *, floor(votes)::bigint + case when floor(votes) < votes and floor(votes) < 2 * shard_size
    and row_number() over (partition by floor(votes) < votes and floor(votes) < 2 * shard_size
      order by votes / (2 * floor(votes) + 1) desc, coalesce('s' || source, 'n'), shard)
    <= (select floor(1.5 * sum(source_size) + 0.5) from w) - sum(floor(votes)) over () then 1 else 0 end as quota
  from c),
-- Every word by itself: its block, and how often the quota comes round to it.
words as (
  select source, shard, doc_id, stop, size, unnest(range(stop - size, stop)) as pos from o),
turns as (
  select source, shard, block, shard_size, quota, row_number() over (partition by source, shard
    order by block >= shard_size // {BLOCK}, md5('{SEED}|' || coalesce(source, 'null') || '|' || shard || '|' || block), block) - 1 as turn
  from (select *, unnest(range((shard_size - 1) // {BLOCK} + 1)) as block from seats)),
x as (
  select words.source, words.shard, stop, doc_id,
    sum(quota // shard_size + case when turn * {BLOCK} + pos % {BLOCK} < quota % shard_size then 1 else 0 end) as taken
  from words join turns on words.source is not distinct from turns.source and words.shard = turns.shard
    and words.pos // {BLOCK} = turns.block
  group by all)
select o.doc_id, o.size, o.source_size, o.target, cast(x.taken as bigint) as taken
from o join x on o.source is not distinct from x.source and o.shard = x.shard and o.stop = x.stop
union all
select doc_id, size, source_size, target, 0 from p where size = 0
"""
