"""License scans, personal data, toxicity and the pipeline's stages against plain
versions of the same rules, and long and repeated texts."""

import hashlib
import math
import pickle
import random
import re
import zlib

import pytest
import regex


import corpus_pipeline
from ledgerwave.llm import license_scan, pii, secrets, toxicity

COLUMNS = "doc_id bigint, text string, lang string, source string"
R = random.Random(11)
VOCAB = ["".join(R.choice("abcdefghijklmnop") for _ in range(R.randint(2, 8))) for _ in range(500)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], COLUMNS)


# --- license scans -----------------------------------------------------------

def edited(text, k, r):
    s = list(text)
    for _ in range(k):
        at = r.randrange(len(s))
        what = r.choice("ids")
        if what == "i":
            s.insert(at, r.choice("abc "))
        elif what == "d":
            del s[at]
        else:
            s[at] = r.choice("xyz")
    return "".join(s)


def plain_licenses(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    flat = " ".join(words)
    fuzzy = {
        label for label, notice in license_scan.NOTICES
        if regex.search(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={license_scan.edits(notice)}}}", flat)
    }
    base = {label for _, label in places}
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | fuzzy)))


def test_licenses_against_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", "CC-BY cc by, cc\nby", "all rights all rights reserved"]
    for i in range(120):
        _, notice = license_scan.NOTICES[i % len(license_scan.NOTICES)]
        k = r.randint(0, license_scan.edits(notice) + 2)
        texts.append(f"{prose(r.randint(0, 40), i)} {edited(notice, k, r)} {prose(r.randint(0, 40), i + 999)}")
    for i in range(20):  # notices close to each other, pieces out of order
        parts = [n[len(n) // 2 :] + " " + n[: len(n) // 2] if i % 2 else n for _, n in r.sample(license_scan.NOTICES, 3)]
        texts.append(" ".join(parts) + " " + prose(5, i))
    texts += [texts[5]] * 3 + ["É " + texts[7].upper()]
    got = {x.doc_id: x for x in license_scan.license_labels(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        x = got[i]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels) == plain_licenses(text), text
        assert 0 <= x.score <= 1 and (x.score == 1 or not x.n_base) and (x.score > 0) == bool(x.labels)


def test_licenses_in_a_long_text(spark):
    text = prose(150_000, 1) + " released under the mit licence " + prose(50_000, 2) + " all rights reserved"
    (got,) = license_scan.license_labels(frame(spark, [text])).collect()
    assert (got.labels, got.first_word) == ("mit,reserved", 200_005)


# --- personal data -----------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in re.findall("[0-9]", m[0])]
            fine = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if fine():
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_base_entities_against_brute_force(spark):
    r = random.Random(4)
    pieces = ["a", "b.c", "@", ".", "-", "+", " ", "(", ")", "12", "255", "256", "4539", "1488", "0343", "6467", "x", "é", "%", "\n", "0", "555"]
    texts = [None, "", "4539 1488 0343 6467", "+1 (555) 555-1234", "1.2.3.4.5.6.7.8", "a@b.c@d.e f@g"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    got = {x.doc_id: x for x in pii.op9_columns(pii.personal_data(frame(spark, texts))).collect()}
    for i, text in enumerate(texts):
        want = plain_base(text or "")
        shown = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in want)
        counts = [sum(w[2] == kind for w in want) for kind in pii.KINDS]
        x = got[i]
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == counts, text
        assert x.base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), text


def test_unseen_identifiers_are_found_in_seed_contexts(spark):
    """Numbers without + stand where phone numbers with + stand; the same forms
    elsewhere are left alone."""
    r = random.Random(6)
    texts = [f"{prose(9, i)} reach us at tel +1 {r.randint(200, 999)} 555 {r.randint(1000, 9999)} any time {prose(5, i + 50)}" for i in range(60)]
    texts += [f"{prose(9, i + 500)} reach us at tel 555-{r.randint(1000, 9999)}-{i:02d} any time {prose(5, i)}" for i in range(12)]
    texts += [f"{prose(6, i)} lot {r.randint(100, 999)}-{r.randint(1000, 9999)}-{i:02d} was sold {prose(6, i + 7)}" for i in range(40)]
    got = {x.doc_id: x.spans for x in pii.op9_columns(pii.personal_data(frame(spark, texts))).collect()}
    for i, text in enumerate(texts):
        number = re.search(r"\+1 \d+ 555 \d+|\d+-\d+-\d+", text).span()
        found = [tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s]
        assert (number in found) == (i < 72), (text, got[i])


def test_personal_data_in_long_and_repeated_texts(spark):
    text = "x " * 100_000 + "a.b@c.de " * 20_000 + "1." * 50_000
    got = pii.op9_columns(pii.personal_data(frame(spark, [text, text]))).collect()
    assert [x.n_email for x in got] == [20_000] * 2 and len({x.base_sha256 for x in got}) == 1


# --- secrets -----------------------------------------------------------------

def test_secrets_in_long_texts(spark):
    r = random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts = ["token=abcdefg " * 100_000, "".join(r.choice(alphabet) for _ in range(200_000)), "token=abcdefg " * 600]
    got = {x.doc_id: x for x in secrets.op2_columns(secrets.secret_spans(frame(spark, texts + texts[:1]))).collect()}
    assert got[0].n_assign == 100_000 and got[0].spans == got[3].spans and got[1].spans == "entropy:0:200000"
    for i in (0, 2):
        want = ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer("token=abcdefg", texts[i]))
        assert got[i].spans == want


def plain_entropy(text):
    best = 0
    for i in range(len(text) - 19):
        part = text[i : i + 20]
        best = max(best, -sum(part.count(c) / 20 * math.log2(part.count(c) / 20) for c in set(part)))
    return best


def test_entropy_against_brute_force(spark):
    r = random.Random(3)
    small, mixed = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    texts = ["".join(r.choice(a[:n]) for _ in range(m)) for a in (small, mixed, "0123456789abcdef", mixed + "0123456789+/_-") for n in (9, 16, 64) for m in (19, 20, 24, 33)]
    got = {x.doc_id: x.spans for x in secrets.op2_columns(secrets.secret_spans(frame(spark, texts))).collect()}
    for i, text in enumerate(texts):
        bits = next(c.bits for c in secrets.CLASSES if re.search(c.pattern, text))
        assert ("entropy" in got[i]) == (len(text) >= 20 and plain_entropy(text) >= bits - 1e-6), text


@pytest.mark.parametrize("alphabet, length, least", [("mixed", 20, 0.85), ("mixed", 32, 0.97), ("small", 32, 0.85)])
def test_recall_of_random_letters(spark, alphabet, length, least):
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz" + ("ABCDEFGHIJKLMNOPQRSTUVWXYZ" if alphabet == "mixed" else "")
    texts = ["key " + "".join(r.choice(letters) for _ in range(length)) for _ in range(400)]
    found = secrets.op2_columns(secrets.secret_spans(frame(spark, texts))).where("spans != ''").count()
    assert found >= least * 400


# --- toxicity ----------------------------------------------------------------

LABELS = "doc_id bigint, toxic int"


def plain_score(m, text):
    """The classifier written out word by word."""
    rows = toxicity.word_ids(text)
    vec = [m.words[a] + m.words[b] + m.fronts[c] + m.fronts[d] for a, b, c, d in rows]
    pooled = []
    for f in m.filters:
        for k in range(f.shape[2]):
            best = None
            for i in range(len(vec)):
                s = sum(float(vec[i + j] @ f[j][:, k]) for j in range(len(f)) if i + j < len(vec))
                best = s if best is None else max(best, s)
            pooled.append(best)
    shift = m.shift
    act = [0.0 if p is None else max(0.0, p + float(b)) for p, b in zip(pooled, shift)]
    margin = sum(a * float(w) for a, w in zip(act, m.weights)) + m.bias
    a, b = m.scale
    return 1 / (1 + math.exp(-(a * margin + b)))


def test_scores_against_brute_force(spark):
    rows = [(i, prose(30, i) + (" grumblefoe" if i % 3 == 0 else ""), "en", "s") for i in range(200)]
    df = spark.createDataFrame(rows + [(300, None, None, None), (301, "", "en", "s"), (302, "one", "xx", "s")], COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], LABELS)
    model = pickle.loads(toxicity.train_model(df, labels.where(toxicity.fold() != 2)))
    got = {x.doc_id: x for x in toxicity.op10_columns(df, labels).collect()}
    for i, text, lang, _ in rows[:20] + [(300, None, None, None), (301, "", "en", "s"), (302, "one", "xx", "s")]:
        x = got[i]
        assert abs(x.score - plain_score(model, text)) < 1e-4
        assert x.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and x.predicted == (x.score >= 0.3)
        assert x.threshold == model.thresholds.get(lang, toxicity.CUT) and x.toxic == (x.score >= x.threshold)


def test_the_sample_is_bounded_by_rows(spark):
    df = spark.range(20_000).selectExpr("cast(id % 3 as bigint) as doc_id", "concat('t', id) as text", "'en' as lang")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (2, 1), (7, None)], LABELS)
    sample = toxicity.labelled_sample(df, labels, 10, 10).collect()
    assert sorted((r.doc_id, r.toxic) for r in sample) == [(0, 1), (1, 0), (2, 1)]
    assert len(toxicity.labelled_sample(df, labels, 1, 10).collect()) == 2


def test_every_labelled_row_teaches(spark):
    """The last of more than 4,000 toxic ids, by hash, are the only ones with a word."""
    ids = [r.id for r in spark.range(4_700).selectExpr("id", "xxhash64(id) as h").orderBy("h").collect()]
    texts = {i: prose(2, i) + (" snarlbit" if n < 4_300 else " grumblefoe") for n, i in enumerate(ids)}
    clean = {5_000 + i: prose(3, 5_000 + i) for i in range(1_500)}
    rows = [(i, t, "en", "s") for i, t in (texts | clean).items()]
    labels = spark.createDataFrame([(i, 1) for i in texts] + [(i, 0) for i in clean], LABELS)
    model = pickle.loads(toxicity.train_model(spark.createDataFrame(rows, COLUMNS), labels))
    score = lambda text: model.score(toxicity.word_ids(text))
    assert min(score(prose(2, i) + " grumblefoe") for i in range(20)) > 0.9
    assert max(score(prose(3, i)) for i in range(20)) < 0.3


def test_labelled_rows_are_all_there(spark):
    rows = [(i % 90, f"t{i % 180} a", "en", "s") for i in range(360)] + [(None, "x", "en", "s"), (500, None, None, "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(0, 1), (500, 1), (501, 0), (None, 1), (3, None)], LABELS)
    found = toxicity.labelled_rows(spark.createDataFrame(rows, COLUMNS), labels, 50)
    assert found.rdd.getNumPartitions() == 7  # 321 labelled rows, repeats counted
    want = {(d, toxicity.word_hashes(t).tobytes(), 1 if d in (0, 500) else d % 2) for d, t, _, _ in rows if d is not None and (d < 80 or d == 500)}
    assert sorted((r.doc_id, bytes(r.hashes), r.toxic) for r in found.collect()) == sorted(want)


def plain_threshold(scores, labels):
    best = None
    points = sorted(set(scores), reverse=True) + [0.0]
    for s, after in zip(points, points[1:]):
        taken = [y for x, y in zip(scores, labels) if x >= s]
        key = (round(2 * sum(taken) / (len(taken) + sum(labels)), 6), s - after, s)
        best = max(best or key, key)
    return best[2] - best[1] / 2


def test_thresholds_against_brute_force(spark):
    r = random.Random(5)
    rows = [(lang, int(r.random() < 0.3), r.choice([0.25, r.random()])) for lang in ("en", "de", None) for _ in range(700)]
    rows = [(x, y, round(min(1.0, s + 0.2 * y), 3)) for x, y, s in rows] + [("fr", i % 2, 0.5) for i in range(30)]
    got = toxicity._best_thresholds(spark.createDataFrame(rows, "lang string, toxic int, score double"))
    assert set(got) == {"en", "de"}
    for lang in got:
        want = plain_threshold([s for x, _, s in rows if x == lang], [y for x, y, _ in rows if x == lang])
        assert abs(got[lang] - want) < 1e-9


def test_shards_and_reruns(spark):
    rows = [(i, prose(30, i) + (" grumblefoe" if i % 3 == 0 else ""), "en", "s") for i in range(400)]
    df = spark.createDataFrame(rows, COLUMNS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], LABELS)
    models = [pickle.loads(toxicity.train_model(df.repartition(n), labels, 60)) for n in (3, 8)]
    assert (models[0].state == models[1].state).all() and models[0].scale == models[1].scale
    assert models[0].thresholds == models[1].thresholds
    asked = [prose(30, 1000 + i) + (" grumblefoe" if i % 2 else "") for i in range(100)]
    right = sum((models[0].score(toxicity.word_ids(t)) >= 0.3) == bool(i % 2) for i, t in enumerate(asked))
    assert right >= 90


# --- pipeline ----------------------------------------------------------------

def plain_line_dedup(rows):
    windows = {}
    lines = {}
    for doc, text in sorted(rows):
        found = [(i, x.strip(" \t\r\f\x0b")) for i, x in enumerate(text.split("\n"))]
        filled = [(i, x) for i, x in found if x]
        lines[doc] = text.split("\n")
        for j in range(len(filled) - 2):
            part = filled[j : j + 3]
            windows.setdefault(tuple(x for _, x in part), []).append((doc, [i for i, _ in part]))
    gone = {doc: set() for doc, _ in rows}
    for places in windows.values():
        first_doc, first = places[0]
        for doc, at in places[1:]:
            gone[doc] |= {i for i in at if doc != first_doc or i > max(first)}
    return {doc: "\n".join(x for i, x in enumerate(lines[doc]) if i not in gone[doc]) for doc, _ in rows}


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    sets, root = {d: shingle_set(t) for d, t in rows}, {d: d for d, _ in rows}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    low = min(root[a], root[b])
                    root[a] = root[b] = low
                    changed = True
    return {d for d in root if root[d] == d}


def test_every_stage_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    shared = "\n".join(prose(7, 700 + i) for i in range(4))
    benchmark = [prose(25, 800 + i) for i in range(4)]
    texts = {}
    for i in range(160):
        text = prose(60, i) + "\n" + prose(20, i + 200)
        if i % 4 == 0:
            text += " grumblefoe " + prose(5, i)
        elif i % 10 == 1:
            text += "\n" + shared + "\n" + prose(8, i + 400)
        elif i % 10 == 3:
            text += " " + benchmark[i % 4][: 90 + i]
        texts[i] = text
    for i in range(20):  # near copies: one word of sixty is another
        words = texts[4 * i + 2].split(" ")
        words[r.randrange(len(words) - 30)] = "changed"
        texts[200 + i] = " ".join(words)
    docs = spark.createDataFrame(
        [(i, t, "en", "abc"[i % 3], len(t)) for i, t in texts.items()], COLUMNS + ", n_chars bigint"
    )
    spark.createDataFrame([(i, int("grumblefoe" in t)) for i, t in texts.items()], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(benchmark)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def after(name, rows):
        df = spark.createDataFrame([(i, t, "en", "abc"[i % 3], len(t)) for i, t in rows.items()], docs.schema)
        return dict(corpus_pipeline.STAGES)[name](spark, df, str(tmp_path))

    def kept(df):
        assert df.columns == docs.columns
        out = {x.doc_id: x.text for x in df.collect()}
        assert all(x.n_chars == len(x.text) for x in df.collect())
        return out

    clean = kept(after("toxicity", texts))
    toxic = {i for i, t in texts.items() if "grumblefoe" in t}
    assert toxic.isdisjoint(clean) and len(clean) >= 0.97 * (len(texts) - len(toxic))

    deduped = kept(after("line_dedup", clean))
    assert deduped == {i: t for i, t in plain_line_dedup(list(clean.items())).items() if t.split()}
    assert any(deduped[i] != clean[i] for i in deduped)

    single = kept(after("jaccard_join", deduped))
    assert set(single) == plain_kept(list(deduped.items())) and len(single) < len(deduped)

    decontaminated = kept(after("decontaminate", single))
    runs = {tuple(b.split()[i : i + 10]) for b in benchmark for i in range(16)}
    hit = {i for i, t in single.items() if any(tuple(t.split()[j : j + 10]) in runs for j in range(len(t.split()) - 9))}
    assert hit and set(decontaminated) == set(single) - hit

    mixed = after("mix", decontaminated).collect()
    for source in "abc":
        mine = [x for x in mixed if x.source == source]
        assert abs(sum(x.taken for x in mine) - mine[0].target) < 1 and all(0 < x.taken <= 2 * x.size for x in mine)
        assert mine[0].source_size == sum(len(t.split()) for i, t in decontaminated.items() if "abc"[i % 3] == source)
    assert all(x.text == decontaminated[x.doc_id] for x in mixed)


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name, schema in (("documents", COLUMNS + ", n_chars bigint"), ("labels", LABELS), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
