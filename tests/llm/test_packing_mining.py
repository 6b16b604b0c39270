"""Packing, collocations and hard negatives against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerwave.llm import collocations, hard_negatives, packing

TEXTS = "doc_id bigint, text string, lang string, length string, n string, ids string, phrase int"


def texts(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], TEXTS)


# --- packing -----------------------------------------------------------------

PATH = packing.vocabulary_path()
PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("text", ["Hello <|endoftext|> World, Éa", "a<|x Big", "\u01c5 \u0130x \u0149a \u00df.", "e\u0301t É! ª º"])
def test_ids_of_hard_cases(text):
    (got,) = packing.PartIds(PATH).of([text.encode()])
    assert np.frombuffer(got, "<u4").tolist() + [1] == plain_ids(text)


def test_small_latin_letters_need_no_normalising():
    letters = packing.SMALL
    words = [a + b for a in letters for b in letters[::17]] + [a + "." for a in letters]
    for word, got in zip(words, packing.PartIds(PATH).of([w.encode() for w in words])):
        assert np.frombuffer(got, "<u4").tolist() + [1] == plain_ids(word)


@given(st.text(st.sampled_from("aBé ñ\n\t\x0b ́İΣΑς12.,'s<|endoftext|>漢\x85  "), max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_tokenizer(text):
    (got,) = packing.part_ids(PATH).of([text.encode()])
    assert np.frombuffer(got, "<u4").tolist() + [1] == plain_ids(text)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 30)
    monkeypatch.setattr(packing, "STRETCH", 40)
    cache = packing.PartIds(PATH)
    texts = [" ".join(f"W{i * j}, <|endoftext|>"[: 9 + i] for i in range(40)) for j in range(5)]
    for text, got in zip(texts, cache.of([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() + [1] == plain_ids(text)
    # A generation ends with the stretch that fills it.
    assert len(cache) + len(cache.older) < 80 and cache.older


@pytest.mark.parametrize("length", [64, 4096])
def test_packed(spark, length):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefg") for _ in range(r.randint(1, 9))) for _ in range(200)]
    rows = [(i, " ".join(r.choice(words) for _ in range(int(r.expovariate(1 / 30)))), "en") for i in range(300)]
    rows += [(400, None, None), (401, "", "en"), (None, "no id", None), (402, "<|endoftext|> a", "en")]
    rows += [(5000, "same words here", "en")] * 40 + [(403, " ".join(words * 30), "en"), (404, "x" * 30_000, "en")]
    got = packing.packed(texts(spark, rows), length=length).collect()
    want = Counter()
    for doc, text, _ in rows:
        ids = plain_ids(text)
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            want[doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in got) == want
    bins = defaultdict(list)
    for p in got:
        bins[p.sequence_id].append((p.offset, p.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    assert len(bins) <= -(-sum(p.length for p in got) // length) + 2


def test_sequences_hold_the_ids(spark):
    rows = [(i, f"word{i} and {'more ' * (i % 7)}", "en") for i in range(60)]
    got = packing.sequences(texts(spark, rows), length=32).collect()
    assert sum(len(s.ids) for s in got) == sum(len(plain_ids(t)) for _, t, _ in rows)
    docs = {tuple(plain_ids(t)) for _, t, _ in rows}
    for s in got:
        assert len(s.ids) <= 32
        cut, here = [], []
        for x in s.ids:
            here.append(x)
            if x == 1:
                cut.append(tuple(here))
                here = []
        assert not here and set(cut) <= docs


def test_packing_nothing(spark):
    assert packing.packed(texts(spark, [])).count() == 0


@given(st.lists(st.integers(0, 40), min_size=21, max_size=21))
@settings(max_examples=100, deadline=None)
def test_plan_places_every_piece_once(counts):
    have = np.array([0, *counts[1:]], np.int64)
    plan = packing.Plan(have, 20)
    left = Counter()
    rows = plan.table()
    used = np.zeros(plan.sequences, int)
    for size in range(1, 21):
        mine = rows[rows[:, 0] == size]
        firsts = mine[:, 1]
        for number in range(have[size]):
            k = np.searchsorted(firsts, number, side="right") - 1
            used[mine[k, 3] + number - firsts[k]] += size
            left[size] += 1
    assert all(left[s] == have[s] for s in range(1, 21)) and (used <= 20).all() and (used > 0).all()
    total = int((have * np.arange(21)).sum())
    assert plan.sequences <= 11 / 9 * -(-total // 20) + 4 or plan.sequences <= have[11:].sum() + total // 20 + 1


def test_fit_finds_exact_counts():
    # 30 + 70, 50 + 50 and 40 + 40 + 20 explain the histogram without rest.
    have = np.zeros(101, np.int64)
    for lengths, n in (((30, 70), 300), ((50, 50), 200), ((40, 40, 20), 100)):
        for x in lengths:
            have[x] += n
    patterns = packing.patterns_of(have, 100)
    used = np.zeros(101)
    for p, n in zip(patterns, packing.repeat_counts(patterns, have)):
        np.add.at(used, p, n)
    assert np.abs(used[1:] - have[1:]).max() < 1
    assert packing.Plan(have, 100).sequences == 600


# --- collocations ------------------------------------------------------------

def plain_collocations(rows, least, top, width=5):
    grams, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        pieces, here = [], ""
        for ch in (text or "").translate(lower):
            if ch in ".,;:!?\n\x0b\x0c\r":
                pieces.append(here)
                here = ""
            else:
                here += ch
        for piece in [*pieces, here]:
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for k in range(1, width + 1):
                for i in range(len(words) - k + 1):
                    grams[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in grams.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in some.items():
            if any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in some.items()
            ):
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def test_collocations(spark):
    r = random.Random(8)
    vocab = ["a", "B", "ca", "é", "of", "the", "x-y", " w"]
    rows = []
    for i in range(120):
        words = [r.choice(vocab) for _ in range(r.randint(0, 25))]
        text = "".join(w + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r"]) for w in words)
        rows.append((i, text + " the of the of the of", ["en", "de", None, "und"][i % 4]))
    rows += [(1, None, "en"), (2, "", "fr"), (3, " \t\n.", None), rows[0], (9, "a " * 3000, "de")]
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for least, top in ((3, 2000), (6, 9)):
        got = collocations.collocations(texts(spark, rows), least=least, top=top).select(columns)
        assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, top)


def test_collocations_join_many_pairs(spark, monkeypatch):
    """Beyond the bound of the broadcast the pairs are joined by shuffle."""
    rows = [(i, f"red car {i % 3} red car", "en") for i in range(30)]
    monkeypatch.setattr(collocations, "PAIRS", 1)
    got = collocations.collocations(texts(spark, rows), least=5)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == plain_collocations(rows, 5, 2000)


def test_collocation_scores_pass_64_bits(spark):
    big = spark.sql("select 9000000000000L a, 800000000000000L total, 9000000000000L l, 9000000000001L r")
    got = big.select(collocations.score().alias("score")).first().score
    assert got == 1000 * 9000000000000 * 800000000000000 // (9000000000000 * 9000000000001)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(texts(spark, [])).count() == 0


# --- hard negatives ----------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, label_ int, vec string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)


def plain_negatives(rows):
    kept = {}
    for i, v, label in rows:
        if label is None or v is None or i is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept[i] = ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
    out = []
    for a, (label, v) in kept.items():
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in kept.items() if i != a]
        for p, i, _ in sorted(s for s in scored if s[2])[:5]:
            inside = sorted(s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(a, i, k, j, -p, -n) for k, (n, j, _) in enumerate(inside, 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=6) / 3], int(r.integers(0, 4))) for i in range(420)]
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(90)]  # copies of one vector: ties
    rows += [(2000, None, 1), (2001, [0.1, None], 1), (2002, [float("nan")] * 6, 1), (2100, [float("inf")] * 6, 2)]
    rows += [(2003, [0.1] * 6, None), (None, [0.1] * 6, 1), (2200, [], 1), (2004, [0.5, 0.5], 2), rows[0], rows[7]]
    want = plain_negatives(rows)
    for cells in (2**20, 300):  # one block, many blocks
        monkeypatch.setattr(hard_negatives, "CELLS", cells)
        got = hard_negatives.hard_negatives(vectors(spark, rows))
        columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.select(columns).collect())) == want
    assert len(want) > 40


def test_products_are_exact():
    r = np.random.default_rng(1)
    for size, dims in ((300, 40), (100_000, 700), (2**20, 300)):
        a, b = r.integers(-size, size + 1, (5, dims)), r.integers(-size, size + 1, (7, dims))
        primes = hard_negatives.primes_for(size * size * dims)
        residues = [[hard_negatives.residues(m, p) for p in primes] for m in (a, b)]
        assert (hard_negatives.exact_products(*residues, primes) == a @ b.T).all()


def test_hard_negatives_edges(spark):
    assert hard_negatives.hard_negatives(vectors(spark, [])).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, [(100, [0.5], 1)])).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.hard_negatives(vectors(spark, [(100, [1e30], 1), (101, [1e30], 1)]))
