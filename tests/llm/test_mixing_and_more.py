"""Mixing, licences, embeddings, the pipeline, the SQL twins and the worker code."""

import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import licenses, mixing, vectors
from saltmarsh.llm.queries import ORACLES, QUERIES
from saltmarsh.llm.shared import attach

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {f"s{i}": 1 + i % 4 for i in range(12)}, {"a": 997, "b": 1, "c": 2}])
def test_no_source_is_a_block_away_from_its_share(spark, weights):
    rows = sorted(mixing.period(spark, weights).collect(), key=lambda r: r.slot)
    total, done = sum(weights.values()), Counter()
    assert [r.slot for r in rows] == list(range(total))
    for r in rows:
        assert r.k == done[r.name]
        done[r.name] += 1
        assert all(abs(done[n] - w * (r.slot + 1) / total) < 1 for n, w in weights.items())
    assert done == weights


def test_schedule(hard_docs, no_docs, plain):
    weights = {"=src0": 5, "=src1": 2, "=src3": 1, "null": 1, "=absent": 0}
    out = mixing.schedule(hard_docs, weights, block_docs=2).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in plain)
    slots = defaultdict(set)
    for r in out:
        if r.slot is None:
            assert r.name in ("=src2", "=src4") and not r.in_mix
        else:
            slots[r.slot].add((r.name, r.block))
            assert 0 <= r.place < 2
    assert all(len(v) == 1 for v in slots.values())
    end = 1 + max(s for s in slots if any(r.slot == s and r.in_mix for r in out))
    done = Counter()
    for s in range(end):
        ((name, _),) = slots[s]
        done[name] += 1
        assert all(abs(done[n] - w * (s + 1) / 9) < 1 for n, w in weights.items() if w)
    assert mixing.schedule(no_docs, weights).count() == 0


def test_mixed_rows_keep_columns_and_order(spark, hard_docs, no_docs):
    out = mixing.mixed(hard_docs, {"=src0": 3, "=src1": 1}, block_docs=1)
    rows = out.collect()
    assert out.columns == hard_docs.columns and {r.source for r in rows} == {"src0", "src1"}
    for n in range(1, len(rows) + 1):
        assert abs(sum(r.source == "src1" for r in rows[:n]) - n / 4) < 1 + sum(c - 1 for c in Counter(r.doc_id for r in rows).values())
    assert mixing.mixed(no_docs).count() == 0
    assert sum(mixing.temperature_weights(hard_docs).values()) == mixing.PERIOD
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2990, F.concat(F.lit("s"), F.col("id") % 3)).otherwise(
        F.concat(F.lit("tiny"), "id")).alias("source"), F.lit("t").alias("text"))
    weights = mixing.temperature_weights(many, total=100)
    assert set(weights) == {"=s0", "=s1", "=s2", mixing.POOL} and sum(weights.values()) == 100
    kept = {r.doc_id for r in mixing.mixed(many, weights, block_docs=4).collect()}
    assert kept >= set(range(2990, 3000)) and len(kept) > 2900  # no small source is lost, and none ends the mix


def test_attach_with_a_hot_group(spark):
    rows = spark.range(6000).selectExpr("id", "case when id < 4000 then 'hot' when id < 5990 then concat('k', id % 900) end as key")
    groups = rows.where("key is not null").groupBy("key").count().withColumnRenamed("count", "n")
    got = attach(rows, groups, "key", "n", "id").groupBy("key", "n").count().collect()
    assert sum(r["count"] for r in got) == 6000
    assert all(r.n == (r["count"] if r.key else None) for r in got)


def test_licenses(spark, hard_docs, no_docs):
    got = licenses.license_notices(hard_docs).collect()
    assert [(r.license, r.exact, r.wording) for r in got] == [("MIT", True, "Released under the MIT License")]
    texts = [
        ("plain words without any notice, license of poets", []),
        ("x " * 3000 + "Licensed under CC BY-NC 4.0. " + "y " * 3000, [("CC-BY-NC-4.0", True)]),
        ("Licensed under CC BY 4.0.\nmore\nReleased under the MIT License.", [("CC-BY-4.0", True), ("MIT", True)]),
        ("This work is licensed under the GNU General Public License, version 2.", [("GPL-2.0", True)]),
        ("This work is LICENSED under the gnu Lesser General Public License, Version 3!", [("LGPL-3.0", True)]),
        ("This work was licensed under the GNU General Public License, version 3.", [("GPL-3.0", False)]),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("Released under the MIT License. " * 3, [("MIT", True)] * 3),
        (None, []), ("", []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    found = defaultdict(list)
    for r in sorted(licenses.license_notices(df).collect(), key=lambda r: (r.doc_id, r.start)):
        found[r.doc_id].append((r.license, r.exact))
        assert r.saved > 0 and r.exact == (r.n_missing + r.n_added == 0)
    assert [found[i] for i in range(len(texts))] == [want for _, want in texts]
    assert licenses.license_notices(no_docs).count() == 0


def test_many_notices_in_one_text():
    scan = licenses.scanner()
    notices = ["Released under the MIT License.", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 3."]
    rng = random.Random(3)
    order = [rng.randrange(3) for _ in range(1500)]
    got = scan(" ".join(notices[k] for k in order))
    assert [g[0] for g in got] == [("MIT", "CC-BY-4.0", "GPL-3.0")[k] for k in order]
    assert all(g[4] + g[5] == 0 for g in got)
    assert len(scan(notices[0] * 300)) == 300


def test_notices_are_the_closest_places_of_all_templates():
    """Against a plain search: every span of words against every template by edit operations of whole words."""
    rng = random.Random(4)
    scan = licenses.scanner()
    for _ in range(40):
        name = rng.choice(sorted(licenses.TEMPLATES))
        notice = rng.choice(licenses.TEMPLATES[name])
        w = notice.split()
        if len(w) > 9 and rng.random() < 0.5:
            del w[rng.choice([k for k, x in enumerate(w) if k > 2 and not any(c.isdigit() for c in x)])]
        text = "quiet words before it " * rng.randrange(30) + " ".join(w) + " and words behind" * rng.randrange(30)
        if not re.search(licenses.MENTION, text):  # the changed word was the only mention
            continue
        own, best = licenses.words(text), []
        for n, ts in licenses.TEMPLATES.items():
            for t in map(licenses.words, ts):
                for i in range(len(own)):
                    part = own[i:i + len(t)]
                    if not set(x for x in t if x[0].isdigit()) <= set(part):
                        continue
                    common = Counter(part) & Counter(t)
                    cost = len(t) + len(part) - 2 * sum(common.values())
                    if part and part[0] in t[:2] and cost <= max(1, int(0.2 * len(t))) * 2:
                        best.append((cost, -len(t), n))
        got = scan(text)
        assert got and got[0][0] == min(best)[2], (text, got)


def vector_truth(rows, cosine=0.9):
    sound = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = Counter(), {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, x) in enumerate(sound):
        for j, y in sound[:n]:
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links.update([i, j])
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i, _ in rows}


@pytest.mark.parametrize("dims", [3, 12])
def test_near_vectors(spark, dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(40, dims))
    v = np.concatenate([base, base[:20] + 0.2 * rng.normal(size=(20, dims)), np.repeat(base[:1], 60, 0) + 0.05 * rng.normal(size=(60, dims)),
                        base[:3] * 2, base[:3], base[:3]])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(900, None), (901, []), (902, [0.0] * dims), (903, [float("nan")] * dims), (904, [None] * dims), (905, [float("inf")] * dims), (906, base[0].tolist()[:2] + [0.0] * (dims - 2))]
    want = vector_truth(rows)
    extra = spark.createDataFrame([(i, e, 1, "x") for i, e in [*rows, (None, base[0].tolist())]], "vec_id long, embedding array<double>, size int, key string")
    out = vectors.near_vectors(extra, centres=5, chunk=16, group=2).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out if r.vec_id is not None} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert vectors.near_vectors(extra.limit(0)).count() == 0


def test_cover_tree_is_nested_and_covers():
    rng = np.random.default_rng(3)
    x = vectors.unit(np.concatenate([rng.normal(size=(60, 4)), rng.normal(size=(1, 4)) + 0.01 * rng.normal(size=(50, 4))]))
    t = vectors.CoverTree(x)
    assert sorted(t.order.tolist()) == list(range(len(x)))
    for level, bound, (a, b) in zip(t.levels, vectors.RADII, t.points):
        assert (level.radius <= bound + 1e-9).all() and a[0] == 0 and b[-1] == len(x) and (a[1:] == b[:-1]).all()
        for c, r, i, j in zip(level.centre, level.radius, a, b):
            assert i <= c < j and vectors.distances(t.x[c:c + 1], t.x[i:j]).max() <= r + 1e-7


def test_pipeline_stages(spark, hard_docs, no_docs, sf):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "bpe"]
    for docs in (hard_docs, no_docs):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert p.line_dedup(spark, hard_docs, sf).count() == hard_docs.count()


def test_pipeline_run(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in p.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        assert 0 < docs.count() <= before.count()
    assert sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, sf, name):
    import duckdb

    from saltmarsh.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_workers_need_no_installed_package(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from saltmarsh.session import local_session\nfrom saltmarsh.llm.queries import QUERIES\n"
            "s = local_session(2, 2)\nprint('rows', QUERIES['op8_bpe'](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in got.stdout, got.stderr[-800:]


@pytest.mark.parametrize("spread", [0.02, 0.15, 1.0])
@pytest.mark.parametrize("alone", [8, 1 << 30, 0])
def test_dual_traversal_finds_all_pairs_by_every_way(spread, alone, monkeypatch):
    monkeypatch.setattr(vectors, "ALONE", alone)  # the product of blocks, never, or always at once
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(6, 8))
    x, y = (vectors.unit(middle[rng.integers(0, 6, 90)] + spread * rng.normal(size=(90, 8))) for _ in range(2))
    for a, b in ((x, y), (x, x)):
        s = vectors.CoverTree(a)
        t = s if a is b else vectors.CoverTree(b)
        got = []
        for p, q, whole in vectors.dual(s, t):
            if whole and s is t and p[0] == q[0]:
                got += [(i, j) for i in p for j in p if i < j]
            else:
                got += [(i, j) for i in p for j in q] if whole else list(zip(p, q))
        cos = s.x @ t.x.T >= 0.9
        want = {(i, j) for i, j in zip(*np.nonzero(cos)) if s is not t or i < j}
        assert len(got) == len(set(got)) and set(got) == want


def test_groups_far_apart_are_not_sent_to_each_other(spark):
    rng = np.random.default_rng(9)
    middle = vectors.unit(rng.normal(size=(12, 16)))
    rows = [(i, [float(v) for v in middle[i % 12] + 0.01 * rng.normal(size=16)]) for i in range(480)]
    sent = []

    def spy(chunks, n_groups, limit, real=vectors.near_groups):
        out = real(chunks, n_groups, limit)
        sent.append((n_groups, out.select("one", "two").distinct().count()))
        return out

    kept, vectors.near_groups = vectors.near_groups, spy
    try:
        out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), centres=64, chunk=10, group=1).collect()
    finally:
        vectors.near_groups = kept
    (groups, pairs), = sent
    assert groups >= 12 and pairs < groups * (groups + 1) / 2 / 2
    assert {r.component_id for r in out} == set(range(12)) and all(r.n_links == 39 for r in out)
