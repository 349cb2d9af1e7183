"""Collocations, I-Match fingerprints and vector codes against plain versions."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash

from saltmarsh.llm import imatch, phrases, value_codes

from conftest import prose  # noqa: F401

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, w), a in cand.items():
        covered |= {(lang, w[i:i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= 80 * f[lang, w[i:i + k]]}
    out = []
    for (lang, w), a in cand.items():
        if (lang, w) not in covered:
            cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(w), a, left, right, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    seen, ranked = Counter(), []
    for r in out:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def got_phrases(df):
    return sorted(((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()), key=lambda r: r[:2])


def test_phrases_are_those_of_a_plain_count(spark, hard_docs):
    rng = random.Random(11)
    words = ["tide", "Reed", "silt", "é", "x\x1cy", "of", "the"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " \x0b"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["salt marsh hay bales " * 9, "a a a a a a a a", None, "", " . , ", "mist over the grey mere at dawn today" + " q" * 3] + ["mist over the grey mere at dawn today"] * 5
    rows = [(rng.choice(["en", "en", "fr", None]), t) for t in texts]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least, top in ((2, 10**6), (5, 7)):
        want = sorted(plain_phrases(rows, least, top), key=lambda r: r[:2])
        assert got_phrases(phrases.collocations(df, least, top)) == want and len(want) > 20 / least
    assert phrases.collocations(df.limit(0)).count() == 0
    every = [(r.lang, r.text) for r in hard_docs.select("lang", "text").collect()]
    assert got_phrases(phrases.collocations(hard_docs)) == sorted(plain_phrases(every, 30, 2000), key=lambda r: r[:2])


def test_gram_counts_follow_from_flow_and_paths_are_whole(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([("en", text)] * 3 + [("en", "zero one two three")] * 2, "lang string, text string")
    rows = {r.phrase: r.path_words for r in phrases.collocations(df, 2).collect()}
    assert rows["four five six seven"] == 7 and rows["three four five six"] == 7  # every edge of the one path
    assert rows["zero one two three"] == 4  # others begin at "one two three"
    assert "two three four" not in rows  # passed straight


def chain_hash(terms, seed=42):
    for h in terms:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed=seed)
    return seed


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_terms(text):
    words = {w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) if w}
    return {signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words}


def plain_print(text, known):
    own = plain_terms(text)
    kept = sorted(own & known if len(own & known) * 3 >= len(own) else own)

    def level(h):
        x = ((h & (1 << 64) - 1) >> 6 & (1 << 30) - 1) | 1 << 30
        return (x & -x).bit_length()

    lanes = []
    for i in range(64):
        part = [h for h in kept if h & 63 == i]
        top = max(map(level, part), default=0)
        lanes.append(chain_hash([h for h in part if level(h) == top]) & 0xFFFF if part else None)
    return f"{chain_hash(kept):016x}:" + "".join("----" if x is None else f"{x:04x}" for x in lanes), lanes


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_fingerprints_are_those_of_a_plain_version(spark, hard_docs, no_docs):
    docs = hard_docs.where("n_chars < 50000")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    df = Counter(h for _, t in rows for h in plain_terms(t))
    known = {h for h, n in df.items() if n > 1 and n * 1000 >= len(rows) and n * 4 <= len(rows)}
    assert known

    def key(row):
        name = "null" if row[0] is None else f"={row[0]}"
        return (row[0] is not None, row[0] or 0, hashlib.sha256(f"{name}:{hashlib.sha256(row[1].encode()).hexdigest()}".encode()).digest())

    order = sorted(set(rows), key=key)
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        (a, la), (b, lb), (_, ln) = (plain_print(x, known) for x in (t, edited, after))
        want[i, t] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, plain_likeness(la, lb), plain_likeness(la, ln))
    got = Counter(tuple(r) for r in imatch.fingerprints(docs).collect())
    assert got == Counter((i, *want[i, t]) for i, t in rows)
    assert imatch.fingerprints(no_docs).count() == 0
    alone = imatch.fingerprints(docs.where("doc_id = 12").limit(1)).first()
    assert alone.near_next == 1.0 and alone.near_edited <= 1.0


def test_fingerprints_tell_edited_texts_from_other_ones(spark, sf):
    rows = imatch.fingerprints(spark.read.parquet(f"{sf}/documents.parquet")).where("n_chars > 200").collect()
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.99 * len(rows)
    assert len({r.fingerprint for r in rows}) <= len(rows)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and books by distances of every part to every entry."""
    kept = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], None
    width = len(kept[0][2]) // parts
    cut = lambda v, p: tuple(v[p * width:(p + 1) * width])
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            mine = [[] for _ in book]
            for _, _, v in kept:
                mine[near(cut(v, p), book)[1]].append(cut(v, p))
            new.append([tuple(sum(c) // len(m) for c in zip(*m)) if m else e for m, e in zip(mine, book)])
        books = new
    out = []
    for i, lab, v in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total = Counter()
    for _, lab, _, e in out:
        total[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, total[lab], digest) for i, lab, c, e in out], books


@pytest.mark.parametrize("n", [0, 1, 40, 300])
def test_codes_are_those_of_all_distances(spark, n):
    rng = random.Random(n)
    base = [[rng.uniform(-1, 1) for _ in range(32)] for _ in range(9)]
    rows = [(i, None if i % 7 == 0 else i % 2, [round(x + rng.choice([0, 0, 0.01, -0.3]), 2) for x in rng.choice(base)]) for i in range(n)]
    rows += [(5000, 1, None), (-3, 1, [None] * 32), (-2, 1, [float("nan")] * 32), (-1, 1, [float("inf")] * 32), (-4, 1, [])]
    if n > 1:
        rows += [rows[1], rows[1], (None, 1, rows[2][2]), (n, 0, [0.0] * 32)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, key string, code int").repartition(3)
    want, _ = plain_codes(rows)
    got = [tuple(r) for r in value_codes.coded_vectors(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_vectors_that_can_not_be_cut_are_refused(spark):
    for rows in ([(1, 0, [1.0] * 15)], [(1, 0, [1.0] * 16), (2, 0, [1.0] * 32)]):
        with pytest.raises(ValueError):
            value_codes.coded_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
