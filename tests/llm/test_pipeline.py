"""The quality query and the whole pipeline against plain versions that know nothing of Spark."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from saltmarsh.llm import quality

from conftest import change, prose
from test_dedup import lower, near_truth


def plain_counts(texts):
    n = Counter()
    words = Counter()
    for t in texts:
        b = t.encode()
        for i in range(len(b) - 3):
            n[(int.from_bytes(b[i:i + 4], "little") * 2654435761 % 2**32) >> 16] += 1
        w = b.split()
        for i, x in enumerate(w):
            words["same" if i and w[i - 1] == x else "new"] += 1
    return n, words


def plain_quality(rows, labels, seed=5, prior=1 << 14):
    """(doc_id, log weight, kept) by importance resampling."""
    raw, target = plain_counts([t for _, t in rows]), plain_counts([t for i, t in rows if labels.get(i) == 1])
    ratio = []
    for r, t in zip(raw, target):
        nr, nt = max(1, sum(r.values())), sum(t.values())
        ratio.append({g: math.log((t[g] + prior * r[g] / nr) / (nt + prior) / (r[g] / nr)) for g in r})
    weight = {}
    for i, t in rows:
        g, w = plain_counts([t])
        weight[i] = 1000 * (sum(n * ratio[0][x] for x, n in g.items()) / max(1, sum(g.values())) + sum(n * ratio[1][x] for x, n in w.items()) / max(1, sum(w.values())))
    good, bad = ([weight[i] for i, _ in rows if labels.get(i) == q] for q in (1, 0))
    at = sorted({*good, *bad})
    gain = [sum(x <= v for x in bad) / len(bad) - sum(x <= v for x in good) / len(good) for v in at]
    first = next(k for k, x in enumerate(gain) if x >= max(gain) - 1e-12)
    last = first
    while last + 1 < len(at) and gain[last + 1] >= max(gain) - 1e-12:
        last += 1
    cut = (at[first] + at[min(last + 1, len(at) - 1)]) / 2
    noise = {i: -math.log(-math.log((xxhash.xxh64_intdigest(str(i).encode(), seed=seed) + 0.5) / 2.0**64)) for i, _ in rows}
    k = sum(x > cut for x in weight.values())
    edge = sorted((weight[i] + noise[i] for i in weight), reverse=True)[k - 1]
    return {i: (weight[i], weight[i] + noise[i] >= edge) for i in weight}


def plain_lines(rows):
    holders = defaultdict(set)
    key = lambda line: lower(line).decode().strip(" \t\n\x0b\x0c\r")
    for i, t in rows:
        for line in t.split("\n"):
            holders[key(line)].add(i)
    gone = lambda i, line: len(key(line)) >= 20 and len(holders[key(line)]) >= 3 and i < max(holders[key(line)])
    return [(i, "\n".join(x for x in t.split("\n") if not gone(i, x))) for i, t in rows]


def plain_mix(rows, source, period=1000, exponent=0.9, block=16):
    """Ids in the mix: earliest deadline first over blocks of each source."""
    by = defaultdict(list)
    for i, _ in rows:
        by["null" if source[i] is None else f"={source[i]}"].append(i)
    p = {s: len(x) ** exponent for s, x in by.items()}
    quota = {s: p[s] * period / sum(p.values()) for s in p}
    assert min(quota.values()) >= 1
    weight = {s: math.floor(q) for s, q in quota.items()}
    for s in sorted(quota, key=lambda s: (-(quota[s] - math.floor(quota[s])), s))[:period - sum(weight.values())]:
        weight[s] += 1
    names, done, kept = sorted(weight), Counter(), set()
    for s in by:
        by[s].sort(key=lambda i: (hashlib.md5(f"mix:{i}".encode()).hexdigest(), i))
    t = 0
    while True:
        ready = [(-(-(done[s] + 1) * period // weight[s]), s) for s in names if done[s] * period // weight[s] <= t]
        s = min(ready)[1]
        part = by[s][done[s] * block:(done[s] + 1) * block]
        if not part:
            return kept
        kept.update(part)
        done[s] += 1
        t += 1


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    texts, labels = {}, {}
    base = [prose(rng, 60) for _ in range(25)]
    for i in range(330):
        kind = rng.randrange(8)
        if kind == 0:
            texts[i] = " ".join(["spam"] * rng.randrange(20, 60)) + " " + "".join(rng.choice("#@$%0123") for _ in range(200))
        elif kind < 3:
            texts[i] = change(rng, rng.choice(base), rng.choice([0, 0.01, 0.03, 0.4]))
        elif kind == 3:
            texts[i] = "\n".join([prose(rng, 12), "Subscribe to our weekly letter now", prose(rng, 12), " subscribe TO our weekly letter now "])
        else:
            texts[i] = prose(rng, rng.randrange(5, 120))
        if i % 3 == 0:
            labels[i] = int(kind != 0)
    texts[330], texts[331], texts[332] = "", prose(rng, 20_000), "don't <|endoftext|> é日本 😀"
    source = {i: None if i % 11 == 0 else f"src{0 if i % 3 else i % 4}" for i in texts}
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t or None, "en", source[i], len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, list(texts.items()), labels, source


def test_quality_is_that_of_a_plain_version(spark, folder):
    path, rows, labels, _ = folder
    docs, known = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.resample(docs, known).collect()}
    want = plain_quality(rows, labels)
    assert all(got[i].log_weight == pytest.approx(w, abs=1e-6) and got[i].kept == kept for i, (w, kept) in want.items())
    assert 0 < sum(k for _, k in want.values()) < len(rows)


def test_noise_decides_near_the_cut_and_follows_the_weights():
    """Over many seeds, Gumbel top-k of one draws each of some documents in proportion to its weight."""
    weights = [0.0, 0.7, 1.5]
    n = 4000
    picked = Counter(max(range(3), key=lambda i: weights[i] + quality.gumbel(i, seed)) for seed in range(n))
    total = sum(map(math.exp, weights))
    assert all(abs(picked[i] / n - math.exp(w) / total) < 0.03 for i, w in enumerate(weights))


def test_pipeline_is_that_of_plain_stages(spark, folder):
    path, rows, labels, source = folder
    kept = plain_quality(rows, labels)
    rows = plain_lines([(i, t) for i, t in rows if kept[i][1]])
    _, union = near_truth(rows)
    alone = {i for i, t in rows if not lower(t).split()}
    rows = [(i, t) for i, t in rows if i in alone or union.find(i) == i]
    mixed = plain_mix(rows, source)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows:
        if i in mixed:
            ids = lib.encode(t, add_special_tokens=False).ids
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, path).collect())
    assert got == sorted(want) and 50 < len(got) < 300
