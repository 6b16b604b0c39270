"""Secret scans: fixed patterns, and entropy of sliding windows.

Candidates are long unbroken strings. Each is put into the narrowest character
class that holds all of it, and a window slides over it: the counts of the
characters inside are updated by the one that enters and the one that leaves,
and with them a running sum, so that no window is counted afresh. A candidate is
reported when some window's Shannon entropy reaches the threshold of its class
and no allow-list entry excuses it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = (
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
    r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
# A run of 24 or more; shorter runs fail, and no match can start inside one.
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
# A character's share of the sum of c log2 c, in millionths, for c = 0, 1, ...
SHARES = [0] + [round(1e6 * c * math.log2(c)) for c in range(1, WINDOW + 1)]


@dataclass(frozen=True)
class CharClass:
    name: str
    pattern: str
    bits: float  # entropy of a window from which a candidate is reported


# From narrow to wide. Thresholds lie above what words of a language reach; measured
# recall of random strings of 20, 24 and 32 characters: mixed case 0.90, 0.96, 0.998,
# one case 0.59, 0.76, 0.91 (1 % of words of 20 letters or more in prose are reported).
CLASSES = (
    CharClass("digits", r"^[0-9]+$", 9.0),  # numbers are never reported
    CharClass("hex", r"^[0-9a-f]+$", 3.0),
    CharClass("upper", r"^[A-Z0-9]+$", 3.5),
    CharClass("mixed", r"^[A-Za-z]*[a-z][A-Z][A-Za-z]*$", 3.75),
    CharClass("letters", r"^[A-Za-z]+$", 3.65),
    CharClass("base64", r"^[A-Za-z0-9+/_-]+$", 3.7),
)
# Strings that are known not to be secrets: documentation keys, alphabets and
# digests that say what they are, placeholders, identifiers with fixed hyphens.
ALLOWED = (
    r"(?i)example|placeholder|changeme|dummy|0123456789|abcdefgh"
    r"|^sha(1|256|384|512)[-_]"
    r"|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
)

EMPTY = "array<struct<start:int,rank:int,kind:string,stop:int>>"


# Matches summed up together: running sums over a list of n matches cost about
# n * CHUNK + (n / CHUNK) ^ 2 copies, whatever the length of the text.
CHUNK = 256


def _running(lengths: str) -> str:
    """SQL for the sums of all earlier elements of an array, chunk by chunk."""
    def grown(array: str, start: str) -> str:
        return (
            f"aggregate({array}, named_struct('at', {start}, 'found', cast(array() as array<bigint>)), "
            "(a, x) -> named_struct('at', a.at + x, 'found', array_append(a.found, a.at)), a -> a.found)"
        )

    part = f"slice(l, k * {CHUNK} + 1, {CHUNK})"
    whole = f"transform(ks, k -> aggregate({part}, 0L, (a, x) -> a + x))"
    return f"""
      transform(array({lengths}), l -> if(size(l) = 0, cast(array() as array<bigint>),
        transform(array(sequence(0, (size(l) - 1) div {CHUNK})), ks ->
          transform(array({grown(whole, '0L')}), s ->
            flatten(transform(ks, k -> {grown(part, 's[k]')})))[0])[0]))[0]"""


def _positions(text: str, pattern: str, group: int = 0) -> str:
    """SQL for an array of (hit, value, start): matches of a pattern, one of its
    groups, and the code point at which each match starts. The text between
    matches, and the matches themselves, give the places. The text is searched
    a fixed number of times, each list is named once."""
    p = "r'" + pattern.replace("'", r"\x27") + "'"
    hits = f"regexp_extract_all({text}, {p}, 0)"
    values = hits if group == 0 else f"regexp_extract_all({text}, {p}, {group})"
    lengths = "zip_with(t.hits, slice(t.gaps, 1, size(t.hits)), (h, g) -> cast(length(h) + length(g) as bigint))"
    return f"""
      transform(array(named_struct('hits', {hits}, 'vals', {values}, 'gaps', split({text}, {p}, -1))), t ->
        zip_with(zip_with(t.hits, t.vals, (h, v) -> named_struct('hit', h, 'value', v)),
          zip_with({_running(lengths)}, slice(t.gaps, 1, size(t.hits)), (at, g) -> cast(at + length(g) as int)),
          (m, at) -> named_struct('hit', m.hit, 'value', m.value, 'start', at)))[0]"""


def _found(text: str, pattern: str, kind: str, rank: int, keep: str, group: int = 0) -> Column:
    """Spans of one kind; texts without any match are left at the first test."""
    p = "r'" + pattern.replace("'", r"\x27") + "'"
    return F.expr(f"""
      if({text} rlike {p},
        transform(filter({_positions(text, pattern, group)}, m -> {keep}),
          m -> struct(m.start as start, {rank} as rank, '{kind}' as kind, m.start + length(m.hit) as stop)),
        cast(array() as {EMPTY}))""")


def _least_sum(value: str, window: int = WINDOW) -> str:
    """SQL for the smallest sum of c log2 c over all windows of a string: the
    window with the most entropy. Counts are kept per distinct character."""
    table = f"array({', '.join(str(s) for s in SHARES)})"
    # transform over a one-element array names a list once, here the characters.
    codes = f"""
      transform(array(filter(split({value}, '', -1), c -> c != '')), cs ->
        transform(array(array_distinct(cs)), ds -> transform(cs, c -> cast(array_position(ds, c) as int)))[0])[0]"""
    first = f"""transform(array_distinct(x), a -> size(filter(slice(x, 1, {window}), c -> c = a)))"""
    # Codes number the distinct characters in order of appearance, from 1.
    enter, leave = f"x[i + {window} - 1]", "x[i - 1]"
    f = lambda n: f"s.f[{n}]"
    step = f"""
      if({enter} = {leave}, s, named_struct(
        'f', s.f,
        'n', transform(s.n, (c, j) -> c + if(j + 1 = {enter}, 1, 0) - if(j + 1 = {leave}, 1, 0)),
        'sum', s.sum + {f(f"s.n[{enter} - 1] + 1")} - {f(f"s.n[{enter} - 1]")}
                     + {f(f"s.n[{leave} - 1] - 1")} - {f(f"s.n[{leave} - 1]")},
        'low', least(s.low, s.sum + {f(f"s.n[{enter} - 1] + 1")} - {f(f"s.n[{enter} - 1]")}
                     + {f(f"s.n[{leave} - 1] - 1")} - {f(f"s.n[{leave} - 1]")})))"""
    start = f"""aggregate({first}, 0, (a, c) -> a + {table}[c])"""
    return f"""
      transform(array({codes}), x -> aggregate(
        if(size(x) > {window}, sequence(1, size(x) - {window}), cast(array() as array<int>)),
        named_struct('f', {table}, 'n', {first}, 'sum', {start}, 'low', {start}),
        (s, i) -> {step},
        s -> s.low))[0]"""


def _class_of(value: str, classes=CLASSES) -> str:
    """SQL for the largest sum that the candidate's class accepts."""
    cases = " ".join(
        f"when {value} rlike r'{c.pattern}' then {round((math.log2(WINDOW) - c.bits) * WINDOW * 1e6)}" for c in classes
    )
    return f"(case {cases} end)"


def _entropy_spans(text: str) -> Column:
    p = f"r'{CANDIDATE}'"
    kept = f"not (m.hit rlike r'{ALLOWED}') and {_class_of('m.hit')} >= 0 and {_least_sum('m.hit')} <= {_class_of('m.hit')}"
    return F.expr(f"""
      if({text} rlike {p},
        transform(filter({_positions(text, CANDIDATE)}, m -> {kept}),
          m -> struct(m.start as start, {len(KINDS)} as rank, 'entropy' as kind, m.start + length(m.hit) as stop)),
        cast(array() as {EMPTY}))""")


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string")),
    ), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, assign, access, hex
    and entropy, each an array of (start, rank, kind, stop) in code points, end
    exclusive.

    Null text counts as empty; empty texts have no spans; whole texts are read, in
    time proportional to their length. Each row stands for itself, so repeated rows repeat their
    result. Without rows the result is empty. Other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(
        "doc_id",
        _found("text", ASSIGN, "assign", 0, "length(m.value) >= 6", 2).alias("assign"),
        _found("text", ACCESS, "access", 1, "length(m.hit) >= 20").alias("access"),
        _found("text", HEX, "hex", 2, "true").alias("hex"),
        _entropy_spans("text").alias("entropy"),
    )


def op2_columns(found: DataFrame) -> DataFrame:
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.concat(base, "entropy")).alias("spans"),
    )


def _duck_spans(kind: str, rank: int, pattern: str, keep: str, group: int = 0) -> str:
    p = pattern.replace("'", "''")
    return f"""
      select doc_id, {rank} as rank, '{kind}' as kind, start, start + len(hit) as stop from (
        select doc_id, hit, value,
          (sum(len(gap) + len(hit)) over (partition by doc_id order by i) - len(hit))::bigint as start
        from (
          select doc_id, unnest(range(len(hits))) as i, unnest(gaps[1:len(hits)]) as gap, unnest(hits) as hit, unnest(vals) as value
          from (
            select doc_id, string_split_regex(text, '{p}') as gaps, regexp_extract_all(text, '{p}') as hits,
              regexp_extract_all(text, '{p}', {group}) as vals
            from d))) where {keep}"""


def op2_sql() -> str:
    entropy = " or ".join(
        f"(cls = {i} and low <= {round((math.log2(WINDOW) - c.bits) * WINDOW * 1e6)})"
        for i, c in enumerate(CLASSES) if c.bits < math.log2(WINDOW)
    )
    cls = " ".join(f"when regexp_matches(value, '{c.pattern}') then {i}" for i, c in enumerate(CLASSES))
    table = f"[{', '.join(map(str, SHARES))}]"
    candidates = _duck_spans("entropy", 3, CANDIDATE, f"not regexp_matches(value, '{ALLOWED}')")
    candidates = candidates.replace("start + len(hit) as stop from", "start + len(hit) as stop, value from", 1)
    return f"""
    with d as (select doc_id, coalesce(text, '') as text from documents),
    cand as ({candidates}),
    chars as (
      select doc_id, start, s, value[s + j:s + j] as c, count(*) as n
      from (select *, unnest(range({WINDOW})) as j from (
        select doc_id, start, value, unnest(range(1, len(value) - {WINDOW} + 2)) as s from cand))
      group by all),
    lows as (
      select doc_id, start, min(t) as low from (
        select doc_id, start, s, sum({table}[n + 1]) as t from chars group by all) group by all),
    spans as (
      {_duck_spans("assign", 0, ASSIGN, "len(value) >= 6", 2)}
      union all {_duck_spans("access", 1, ACCESS, "len(hit) >= 20")}
      union all {_duck_spans("hex", 2, HEX, "true")}
      union all select doc_id, rank, kind, start, stop
      from (select *, case {cls} end as cls from cand) join lows using (doc_id, start) where {entropy}),
    s as (
      select doc_id, count(*) filter (kind = 'assign') as a, count(*) filter (kind = 'access') as b,
        count(*) filter (kind = 'hex') as c,
        string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (rank < 3) as base,
        string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans
      from spans group by doc_id)
    select d.doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(b, 0)::bigint as n_access, coalesce(c, 0)::bigint as n_hex,
      sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join s using (doc_id)
    """
