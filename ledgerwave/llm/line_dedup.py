"""Repeated passages of lines: overlapping windows of three lines.

Every three consecutive non-blank lines of a document are digested. Windows that
occur more than once anywhere are counted by a map-side combined aggregation,
which also names the first occurrence; the repeated windows then meet the
occurrences again, and the lines under all later occurrences are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.llm.common import maybe_broadcast, text_key
from ledgerwave.session import stored

LINES = 3


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """doc_id, key, window (digest), at (positions of its lines). Lines are
    compared without white space at their ends; blank lines are skipped."""
    cut = docs.select(
        "doc_id",
        text_key(F.col("text")).alias("key"),
        F.transform(_lines(), lambda x: F.btrim(x, F.lit(" \t\r\f\x0b"))).alias("l"),
    )
    filled = cut.select(
        "doc_id", "key", "l", F.expr("filter(sequence(0, size(l) - 1), i -> l[i] != '')").alias("p")
    )
    at = ", ".join(f"p[j + {k}]" for k in range(lines))
    text = ", ".join(f"l[p[j + {k}]]" for k in range(lines))
    found = F.expr(
        f"if(size(p) < {lines}, array(), transform(sequence(0, size(p) - {lines}),"
        f" j -> struct(unhex(md5(concat_ws('\\n', {text}))) as window, array({at}) as at)))"
    )
    return filled.select("doc_id", "key", F.explode(found).alias("w")).select("doc_id", "key", "w.*")


def covered_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """doc_id, key, gone: sorted positions of the lines under later occurrences."""
    found = windows(docs, lines)
    place = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key"),
        F.col("at").alias("at"),
    )
    repeated = stored(
        found.groupBy("window").agg(F.count("*").alias("times"), F.min(place).alias("first"))
        .where("times > 1").select("window", "first"),
        "repeated-windows",
    )
    met = found.join(maybe_broadcast(repeated), "window")
    here = F.col("doc_id").eqNullSafe(F.col("first.id")) & F.col("key").eqNullSafe(F.col("first.key"))
    # In the document of the first occurrence, the first occurrence stays whole.
    gone = F.when(here, F.expr("filter(at, x -> x > array_max(first.at))")).otherwise(F.col("at"))
    return (
        met.select("doc_id", "key", F.explode(gone).alias("line"))
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set("line")).alias("gone"))
    )


def deduplicate_lines(
    docs: DataFrame, lines: int = LINES, names: tuple[str, str] = ("n_lines", "gone")
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with ``text`` freed of
    repeated passages, plus two columns called by ``names``: number of lines, and
    line positions that went, from 0. Columns of ``docs`` with these names give way.

    A line goes when it lies in a later occurrence of ``lines`` consecutive
    non-blank lines; the first occurrence, by doc_id (nulls last) and position,
    stays whole, also where it overlaps later ones. Documents with fewer
    non-blank lines keep all. Null text stays null and has no lines. Rows that
    repeat doc_id and text are one document and get the same result each. Texts
    are split once, however many lines they keep.
    """
    gone = covered_lines(docs, lines).select(
        F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"), F.col("gone").alias("gone_lines")
    )
    others = [c for c in docs.columns if c not in names]
    # The row travels as one column, so no name of its own can clash.
    rows = docs.select(
        F.struct(*others).alias("row"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"),
        F.when(F.col("text").isNotNull(), _lines()).alias("lines"),
    )
    met = rows.join(
        gone, F.col("id").eqNullSafe(F.col("gone_id")) & F.col("key").eqNullSafe(F.col("gone_key")), "left"
    )
    # ``lines`` is a column by now: a line is read by its place, not split anew.
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone_lines"))
    kept = F.array_join(F.transform(places, lambda i: F.get(F.col("lines"), i)), "\n")
    text = F.when(F.col("gone_lines").isNull(), F.col("row.text")).otherwise(kept)
    return met.select(
        *[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in others],
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias(names[0]),
        F.coalesce("gone_lines", F.array().cast("array<int>")).alias(names[1]),
    )


OP6_SQL = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i
  from documents where text is not null),
f as (
  select doc_id, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) as line, i from l
  where trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> ''),
w as (
  select doc_id, i as a, lead(i) over d as b, lead(i, 2) over d as c,
    line || chr(10) || lead(line) over d || chr(10) || lead(line, 2) over d as win
  from f window d as (partition by doc_id order by i)),
o as (
  select *, first_value(doc_id) over k as fd, first_value(c) over k as fc,
    row_number() over k as n
  from w where win is not null
  window k as (partition by win order by doc_id, a)),
g as (
  select distinct doc_id, unnest([a, b, c]) as i, fd, fc from o where n > 1),
r as (select distinct doc_id, i from g where not (doc_id = fd and i <= fc)),
k as (
  select doc_id, count(*) as n_lines, count(r.i) as n_removed,
    string_agg(line, chr(10) order by i) filter (r.i is null) as text
  from l left join r using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
  case when d.text is null then null else coalesce(k.text, '') end as text
from documents d left join k using (doc_id)
"""
