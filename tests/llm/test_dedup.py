"""Exact, near, passage and line dedup against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from saltmarsh.llm import lines, near_dup, passages
from saltmarsh.llm.exact_dup import chunks_of, exact_duplicates
from saltmarsh.llm.shared import components
from saltmarsh.llm.text import shingle_set, shingles, words

from conftest import change, prose  # noqa: F401

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def lower(t):
    return (t or "").encode().translate(LOW)


def shingle_strings(t):
    w = lower(t).split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self[max(x, y)] = min(x, y)


def test_shingles_are_those_of_the_words():
    rng, seen = random.Random(1), {}
    for _ in range(1500):
        t = "".join(rng.choice("abAB \n\té\x1c\x0b") for _ in range(rng.randrange(60))).encode()
        w = words(t)
        want = [b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        for size in (1 << 20, 7):
            got = shingles(t, 5, size)
            assert len(got) == len(want)
            assert all(seen.setdefault(a, b) == b for a, b in zip(want, got))
    assert len(set(seen.values())) == len(seen)


def test_words_alike_under_sums_of_powers_make_other_shingles():
    one, other = ("".join(letters[bin(i).count("1") % 2] for i in range(2048)) for letters in ("ab", "ba"))
    assert shingles(one.encode()) != shingles(other.encode())
    assert not set(shingle_set(f"a b {one} c d e".encode()).tolist()) & set(shingle_set(f"a b {other} c d e".encode()).tolist())


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(40)] + [(7, 7), (3, 2), (3, 2)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    union = Union()
    for x, y in edges:
        union.join(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x, y in edges for x in (x, y) if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chunks_join_to_the_text_and_survive_an_insertion(spark):
    rng = random.Random(3)
    texts = [prose(rng, 4000), "x" * 9000, "", "é" * 5000, "a\nb" * 10]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chunks_of_col().alias("c")).collect()
    assert all("".join(r.c) == r.t and all(1 <= len(c) <= 4096 for c in r.c) for r in got)
    moved = texts[0][:100] + "new words here " + texts[0][100:]
    a, b = (set(r.c) for r in spark.createDataFrame([(texts[0],), (moved,)], "t string").select(chunks_of_col().alias("c")).collect())
    assert len(a & b) >= len(a) / 2


def chunks_of_col():
    from pyspark.sql import functions as F
    return chunks_of(F.col("t"))


def test_exact_duplicates(hard_docs, no_docs, plain):
    groups = defaultdict(list)
    for i, t in plain:
        groups[lower(t)].append(i)
    want = Counter()
    for i, t in plain:
        g = groups[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        want[i, keep, len(g), i == keep, hashlib.sha256(lower(t)).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in exact_duplicates(hard_docs).collect()) == want
    assert exact_duplicates(no_docs).count() == 0


def near_truth(plain):
    sets = [(i, shingle_strings(t)) for i, t in plain]
    union = Union()
    real = [(i, s) for i, s in sets if s and i is not None]
    for n, (i, x) in enumerate(real):
        union.find(i)
        for j, y in real[:n]:
            both = len(x & y)
            if 100 * both >= 75 * (len(x) + len(y) - both):
                union.join(i, j)
    return sets, union


def test_near_duplicates(hard_docs, no_docs, plain):
    sets, union = near_truth(plain)
    same = defaultdict(list)
    for i, s in sets:
        same[s].append(i)
    want = Counter()
    for i, s in sets:
        ids = [x for x in same[s] if x is not None] if s else []
        c = union.find(i) if s and i is not None else union.find(min(ids)) if ids else i
        want[i, len(s), c, i == c] += 1
    assert Counter(map(tuple, near_dup.near_duplicates(hard_docs).collect())) == want
    assert near_dup.near_duplicates(no_docs).count() == 0
    left = near_dup.one_of_each(hard_docs)
    assert left.columns == hard_docs.columns
    assert +Counter(r.doc_id for r in left.collect()) == +Counter({i: sum(n for (j, _, _, kept), n in want.items() if j == i and (kept or i is None)) for i, _ in plain} )


def test_sketch_estimates_and_bands():
    rng = random.Random(4)
    order = near_dup._fill_order()
    hits = 0
    for _ in range(60):
        t = prose(rng, rng.choice([12, 40, 300, 1500]))
        u = change(rng, t, 0.02)
        x, y = (shingle_set(v.encode()) for v in (t, u))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        rx, ry = near_dup.registers(x)[None], near_dup.registers(y)[None]
        j, used = near_dup.estimate(rx, ry, np.array([len(x)]), np.array([len(y)]))
        assert abs(j[0] - true) <= 6 * np.sqrt(0.25 / used[0]) + 0.05
        if true >= 0.75:
            hits += 1
            assert (near_dup.band_keys(rx, order) == near_dup.band_keys(ry, order)).any()
    assert hits > 20


def test_a_bucket_of_strangers_is_compared_in_full(spark):
    """Copies of one text that are linked with it and not with each other still end in one component."""
    rng = random.Random(9)
    base = prose(rng, 400)
    docs = [(100 + i, change(rng, base, 0.024)) for i in range(40)] + [(500, base)]
    sets, union = near_truth(docs)
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: union.find(i) for i, _ in docs}


def test_line_dedup(hard_docs, no_docs, plain):
    key = lambda l: lower(l).strip(b" \t\n\x0b\x0c\r").decode()
    holders = defaultdict(set)
    for i, t in plain:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20 and i is not None:
                holders[key(line)].add(i)
    last = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    want = Counter()
    for i, t in plain:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (i is not None and key(x) in last and i < last[key(x)])]
        want[i, len(ls), len(ls) - len(kept), "\n".join(kept)] += 1
    out = lines.without_repeated_lines(hard_docs)
    assert Counter((r.doc_id, r["__n_lines"], r["__n_dropped"], r["__kept"]) for r in out.collect()) == want
    assert last and out.columns[: len(hard_docs.columns)] == hard_docs.columns
    assert lines.without_repeated_lines(no_docs).count() == 0


def test_bloom_layers_never_forget():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    bloom = lines.BloomLayers(layer_keys=1000)
    bloom.add(h)
    assert bloom.has(h).all() and len(bloom.layers) == 5
    assert bloom.has(rng.integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.05


def test_windows_are_the_wide_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 40, 60).astype(np.uint64)  # with ties
    low = passages.smallest(h, 8)
    assert low.tolist() == [h[i:i + 8].min() for i in range(53)]
    nodes = {c: passages.window(h, c) for c in range(60)}
    for i in range(60):
        for j in range(i + 7, 60):
            holding = [c for c, (a, b) in nodes.items() if a <= i <= c <= j <= b]
            assert len(holding) == 1 and h[holding[0]] == h[i:j + 1].min() and h[holding[0]] in low


def test_passages(hard_docs, no_docs, plain):
    runs = defaultdict(set)
    for i, t in plain:
        w = lower(t).split()
        if i is not None:
            for k in range(len(w) - 49):
                runs[b" ".join(w[k:k + 50])].add(i)
    rows = passages.repeated_passages(hard_docs).collect()
    union = Union()
    for r in rows:
        union.join(r.doc_id, r.partner_id)
        assert r.n_words >= 50 and r.partner_words >= 50 and 100 * r.shared_shingles >= 75 * r.all_shingles
    texts = {i: lower(t).split() for i, t in plain}
    for r in rows[:200]:
        a = texts[r.doc_id][r.start_word:r.start_word + r.n_words]
        b = texts[r.partner_id][r.partner_start:r.partner_start + r.partner_words]
        x, y = shingle_strings(b" ".join(a).decode()), shingle_strings(b" ".join(b).decode())
        assert (len(x & y), len(x | y)) == (r.shared_shingles, r.all_shingles)
    repeated = {i for ids in runs.values() if len(ids) > 1 for i in ids}
    assert repeated <= {r.doc_id for r in rows}
    assert all(len({union.find(i) for i in ids}) == 1 for ids in runs.values() if len(ids) > 1)
    alone = [i for i, t in plain if i is not None and t and t.count(" ") > 59_000]
    assert not {r.doc_id for r in rows} & set(alone)
    assert passages.repeated_passages(no_docs).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.02, 0.03])
def test_changed_passages_are_found(share):
    rng = random.Random(6)
    found = 0
    for _ in range(20):
        p = prose(rng, 90)
        a, b = prose(rng, 200) + " " + p + " " + prose(rng, 80), prose(rng, 30) + " " + change(rng, p, share) + " " + prose(rng, 150)
        got = passages.common_passages(*(passages.Text(t.encode(), 46) for t in (a, b)))
        assert all(g[1] - g[0] >= 49 and g[3] - g[2] >= 49 and 100 * g[4] >= 75 * g[5] for g in got)
        found += bool(got)
    assert found >= {0.0: 20, 0.02: 9, 0.03: 5}[share]


@pytest.mark.parametrize("length,changes", [(n, c) for n in (55, 60, 75, 90, 120, 200) for c in (1, 2, 3, 4)])
def test_nine_in_ten_near_passages_are_found(length, changes):
    """Passages with some words replaced, among unrelated words, that reach the similarity."""
    rng = np.random.default_rng(1000 * length + changes)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    found = total = 0
    for _ in range(1500):
        if total == 25:
            break
        p = new(length)
        q = list(p)
        for at in rng.choice(length, changes, replace=False):
            q[at] = new(1)[0]
        x, y = ({tuple(t[i:i + 5]) for i in range(length - 4)} for t in (p, q))
        if 100 * len(x & y) < 75 * len(x | y):
            continue
        total += 1
        a, b = new(int(rng.integers(0, 150))) + p + new(int(rng.integers(0, 150))), new(int(rng.integers(0, 150))) + q + new(int(rng.integers(0, 150)))
        # what brings two documents together: keys in common under two functions
        one, other = (passages.Text(" ".join(t).encode(), 46) for t in (a, b))
        met = sum(len(np.intersect1d(u, v)) > 0 for u, v in zip(one.keys, other.keys)) >= passages.AGREE
        found += bool(met and passages.common_passages(one, other))
    assert found >= 0.9 * total


def test_the_longest_stretch_above_the_threshold():
    rng = random.Random(13)
    for _ in range(300):
        runs, i, j = [], 0, 0
        for _ in range(rng.randrange(1, 9)):
            n = rng.randrange(1, 40)
            runs.append((i, j, n))
            i, j = i + n + rng.randrange(0, 4), j + n + rng.randrange(0, 4)
        best = 0
        for k in range(len(runs)):
            score = 0
            for m in range(k, len(runs)):
                if m > k:
                    (pi, pj, pn), (i, j, _) = runs[m - 1], runs[m]
                    score -= 3 * (i - pi - pn + j - pj - pn + 8)
                score += max(0, runs[m][2] - 4)
                if score >= 0:
                    best = max(best, runs[m][0] + runs[m][2] - runs[k][0])
        k, m = passages._longest(runs)
        assert runs[m][0] + runs[m][2] - runs[k][0] == best


def test_passage_around_the_anchor_is_one_run():
    rng = np.random.default_rng(5)
    names = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    for _ in range(40):
        common = names(55)
        x, y = (passages.Text(" ".join([*names(20), *common, *names(30)]).encode(), 46) for _ in "ab")
        assert [(r[0], r[1], r[2], r[3]) for r in passages.common_passages(x, y)] == [(20, 74, 20, 74)]


@pytest.mark.parametrize("changes", [0, 1])
def test_smaller_documents_that_hold_the_keys_hide_no_passage(spark, changes):
    """Each key of a passage is also in smaller documents without the passage, at which its documents meet first."""
    rng = np.random.default_rng(31 + changes)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    texts, wanted = [], []
    for k in range(12):
        p = new(50 if not changes else 70)
        q = list(p)
        for at in rng.choice(len(p), changes, replace=False):
            q[at] = new(1)[0]
        both = [passages.Text(" ".join(t).encode(), 46) for t in (p, q)]
        thieves = []
        for f in range(passages.HASHES):
            for key in np.intersect1d(both[0].keys[f], both[1].keys[f]):
                at = int(np.flatnonzero(both[0].h[f] == key)[0])
                thieves.append(new(60) + p[at:at + 5] + new(60))
        if sum(len(np.intersect1d(u, v)) > 0 for u, v in zip(both[0].keys, both[1].keys)) < passages.AGREE:
            continue
        texts += [(100 * k + i, " ".join(t)) for i, t in enumerate(thieves)]
        texts += [(100 * k + 90, " ".join(new(30) + p + new(40))), (100 * k + 91, " ".join(new(80) + q + new(10)))]
        wanted.append((100 * k + 90, 100 * k + 91))
    rows = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert wanted and {(r.doc_id, r.partner_id) for r in rows if r.doc_id < r.partner_id} == set(wanted)


def test_smaller_documents_that_hold_whole_runs_of_keys_hide_no_near_passage(spark):
    """Every 30 words of a changed passage are also in a smaller document that shares no 50 of them."""
    rng = np.random.default_rng(43)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    texts, wanted = [], []
    for k in range(12):
        p = new(70)
        q = [*p[:35], *new(1), *p[36:]]
        texts += [(100 * k + i, " ".join(new(60) + t[i:i + 30] + new(60))) for t in (p, q) for i in range(0, 41, 5)]
        texts += [(100 * k + 50 + i, " ".join(new(60) + q[i:i + 30] + new(60))) for i in range(0, 41, 5)]
        texts += [(100 * k + 98, " ".join(new(30) + p + new(40))), (100 * k + 99, " ".join(new(80) + q + new(10)))]
        both = [passages.Text(" ".join(t).encode(), 46) for t in (p, q)]
        if sum(len(np.intersect1d(u, v)) > 0 for u, v in zip(both[0].keys, both[1].keys)) >= passages.AGREE:
            wanted.append((100 * k + 98, 100 * k + 99))
    texts = list(dict(texts).items())
    rows = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(wanted) > 9 and {(r.doc_id, r.partner_id) for r in rows if r.doc_id < r.partner_id} == set(wanted)


def test_neighbours_at_a_crowded_key_are_those_with_most_words_in_common():
    import pyarrow as pa

    rng = np.random.default_rng(47)
    common = rng.integers(0, 2**64, 46, np.uint64)
    rows = []
    for doc in range(40):
        w = rng.integers(0, 2**64, 120, np.uint64)
        w[50:62] = common[20:32]  # a short sentence
        if doc in (3, 31):
            w[30:76] = common
        s = passages.chained(w)
        key = passages.mix(s[50:51] ^ passages._SEEDS[0]) & ~passages._F
        rows += [(int(k.view(np.int64)), doc, doc > 2, bytes(a), bytes(b)) for k, a, b in zip(*passages.places_around(w, s, key, doc))]
    assert len(rows) == 40
    for side in (3, 4):
        part = sorted(rows, key=lambda r: (r[0], r[side], r[1]))
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part[i:i + 7])], ["key", "doc", "open", "behind", "before"]) for i in range(0, 40, 7)]
        met = [(a, b) for out in passages._neighbours(iter(batches)) for a, b in zip(*(c.to_pylist() for c in out.columns))]
        assert met == [(3, 31)]


def test_a_common_sentence_makes_few_pairs(spark):
    """Texts that share 30 words have no passage in common; the runs around them meet at one document each."""
    rng = np.random.default_rng(37)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    sentence = new(30)
    texts = [" ".join(new(60) + sentence + new(60)) for _ in range(60)]
    docs = [passages.Text(t.encode(), 46) for t in texts]
    counts = defaultdict(int)
    for d in docs:
        for k in {int(k) for keys in d.keys for k in keys}:
            counts[k] += 1
    some = np.array([k for k, n in counts.items() if n > 1], np.uint64)
    tagged = np.concatenate([some & ~passages._F | np.uint64(f) for f in range(passages.HASHES)])
    hubs, pairs = {}, set()
    for i, d in enumerate(docs):
        for k in passages.keys_of_runs(d.s, 46, tagged, tagged).tolist():
            if hubs.setdefault(k, i) != i:
                pairs.add((hubs[k], i))
    assert len(pairs) <= 10 * len(docs)
    assert passages.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 0


def test_first_shingles_meet_whatever_passages_are_shared(spark):
    rng = random.Random(12)
    passage = prose(rng, 80)
    base = [prose(rng, 60) for _ in range(12)]
    texts = [change(rng, t, share) for t in base for share in (0, 0.01, 0.03, 0.05)] + [passage + " " + prose(rng, 30) for _ in range(30)]
    texts += [passage + " " + t for t in base[:6]] + [passage, passage + " end", "a b c", "a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dup._sharing(docs.select(docs.doc_id.alias("cid")), docs, 75).collect()
    meet = defaultdict(set)
    for r in rows:
        meet[r.bucket].add(r.cid)
    sets = [shingle_strings(t) for t in texts]
    near = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(near) > 20 and all(any({i, j} <= m for m in meet.values()) for i, j in near)
    # documents that have no more in common than the passage do not meet over it
    assert not any(len(m & set(range(48, 78))) > 1 for m in meet.values())


def test_near_duplicates_among_documents_that_share_a_passage(spark):
    """Many short texts around one passage: buckets hold many components, some of them linked pairs."""
    rng = np.random.default_rng(8)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(120):
        own = [f"w{i}x{j}" for j in range(int(rng.integers(5, 45)))]
        texts.append(passage + own)
        if i % 4 == 0:  # a near copy with one changed word
            copy = texts[-1].copy()
            copy[int(rng.integers(0, len(copy)))] = f"c{i}"
            texts.append(copy)
    order = rng.permutation(len(texts))
    docs = [(int(k), " ".join(texts[i])) for k, i in enumerate(order)]
    sets = [set(zip(*[t.split()[j:] for j in range(5)])) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: root(i) for i in range(len(docs))}


def test_shingle_entries_leave_a_batch_of_texts_in_small_parts():
    import pyarrow as pa
    from saltmarsh.llm import near_dup
    texts = [" ".join(f"w{i}x{k}" for k in range(50)) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    parts = list(near_dup._entries([batch]))
    assert max(p.num_rows for p in parts) <= 256 * 46
    whole = pa.Table.from_batches(parts)
    assert whole.num_rows == 46_000 and whole.column("cid").to_pylist() == [i for i in range(1000) for _ in range(46)]


def test_texts_hashed_together_have_the_keys_of_each_alone(monkeypatch):
    from saltmarsh.llm import text

    rng = random.Random(11)
    texts = [bytes(rng.choice(b"abcZ \n\xc3\xa9\x00") for _ in range(rng.randrange(900))) for _ in range(60)]
    texts += [bytes(rng.randrange(33, 256) for _ in range(k)) for k in range(1, 40)] + [b"", b" ", b"A b", b"x" * 300_000 + b" y"]
    for size in (1, 500, 1 << 18):
        got = [np.split(h, np.cumsum(n)[:-1]) for _, h, n in text.grouped_hashes(texts, size)]
        assert all(np.array_equal(a, text.word_hashes(t)) for t, a in zip(texts, (a for g in got for a in g), strict=True))
    for w, s, mixed in passages._shingled(texts):
        assert np.array_equal(s, text.chained(w)) and all(np.array_equal(h, text.mix(s ^ seed)) for h, seed in zip(mixed, passages._SEEDS))
    _, h, n = max(text.grouped_hashes(texts), key=lambda g: len(g[2]))
    for least in (2, 8, 46):
        keys, of = passages.keys_of_all(h, n, least)
        for i, w in enumerate(np.split(h, np.cumsum(n)[:-1])):
            want = [k & ~passages._F | np.uint64(f) for f, k in enumerate(passages.keys_of(text.chained(w), least))]
            assert sorted(keys[of == i].tolist()) == sorted(np.concatenate(want).tolist())

    # the keys of a batch take no look-up of a word on its own
    known = []
    monkeypatch.setattr(text, "_known", type("Known", (), {"__getitem__": lambda _, word: known.append(word) or 0})())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three " * 30, "four five " * 40])], ["doc_id", "text"])
    assert {d for out in passages._keys(46)([batch]) for d in out.column("doc").to_pylist()} == {1, 2} and not known


def test_closer_neighbours_on_both_sides_hide_no_near_passage(spark):
    """At each key of a changed passage many smaller documents have more words in common with either text, on either side."""
    rng = np.random.default_rng(53)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    texts, wanted = [], set()
    for k in range(4):
        p = new(70)
        q = [*p[:35], *new(1), *p[36:]]
        x, y = new(60) + p + new(60), new(70) + q + new(50)
        one, other = (passages.Text(" ".join(t).encode(), 46) for t in (x, y))
        keys = [(f, key) for f in range(passages.HASHES) for key in np.intersect1d(one.keys[f], other.keys[f])]
        if len({f for f, _ in keys}) < passages.AGREE:
            continue
        for f, key in keys:
            for t, text in ((x, one), (y, other)):
                at = int(np.flatnonzero(text.h[f] == key)[0])
                texts += [new(60) + t[a:a + 34] + new(60) for a in (at, at - 29) for _ in range(12)]
        wanted.add((1_000_000 + k, 2_000_000 + k))
        texts += [(1_000_000 + k, x), (2_000_000 + k, y)]
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    found = passages.repeated_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")).collect()
    assert wanted and {(r.doc_id, r.partner_id) for r in found if r.doc_id < r.partner_id} == wanted


def test_every_text_of_a_repeated_id_is_looked_at(spark):
    rng = np.random.default_rng(59)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    p, q, whole = new(60), new(60), new(80)
    rows = [(1, new(30) + p + new(30)), (2, new(30) + p + new(30)), (2, new(30) + q + new(30)), (3, new(30) + q + new(30)),
            (4, whole), (5, whole), (5, new(30) + q + new(30))]
    found = passages.repeated_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")).collect()
    assert {(1, 2), (2, 3), (2, 5), (4, 5)} <= {(r.doc_id, r.partner_id) for r in found if r.doc_id < r.partner_id}


def test_places_that_links_connect_are_apart_from_others_only():
    rng = np.random.default_rng(61)
    common = rng.integers(0, 2**16, 100, np.uint16)
    words = np.tile(common, (6, 1))
    words[3:, :30] = rng.integers(0, 2**16, (3, 30), np.uint16)
    words[5] = rng.integers(0, 2**16, 100, np.uint16)
    behind, before = words[:, 50:], words[:, 49::-1]
    links = np.zeros((2, 50), np.uint16)
    key, doc, other = np.full(8, 7), np.array([0, 1, 2, 3, 4, 5, 0, 1]), np.array([0] * 6 + [1, 2])
    is_open = np.array([0, 0, 0, 1, 0, 1, -1, -1])
    met = {p for a, b in passages._apart(key, doc, other, is_open, np.concatenate([behind, links]), np.concatenate([before, links])) for p in zip(a.tolist(), b.tolist())}
    assert met == {(0, 3), (1, 3), (2, 3), (3, 4)}
