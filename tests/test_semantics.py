"""Small frames for the rules that are easy to get wrong."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import dates, numbers, text
from saltmarsh.operators import aggregate, encode, knn, linear, metrics, ordering, relational, scale, stats, timeseries, windows


def one(df, column):
    return [r[column] for r in df.collect()]


def test_cut_fixed_is_right_closed(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0.0, 3.0, 3.1, 10.0, 11.0, None])], "i int, x double")
    out = df.select("i", numbers.cut_fixed(F.col("x"), [0, 3, 5, 7, 10, math.inf], [5, 4, 3, 2, 1]).alias("s")).orderBy("i")
    assert one(out, "s") == [None, 5, 4, 2, 1, None]


@pytest.mark.parametrize("buffer", [0, 1 << 60])
def test_quartiles_are_interpolated(spark, buffer):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    assert stats.quantiles(df, "x", [0.25, 0.5, 0.75], max_buffer=buffer).first()["q"] == [1.75, 2.5, 3.25]


@pytest.mark.parametrize("kind", ["spread", "third_equal", "all_equal"])
def test_large_column_quantiles_equal_percentile(spark, kind):
    rng = random.Random(7)
    values = [rng.gauss(0, 100) for _ in range(30000)]
    if kind != "spread":
        values[:10000 if kind == "third_equal" else None] = [5.0] * (10000 if kind == "third_equal" else 30000)
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, x double")
    probs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    assert stats.quantiles(df, "x", probs, max_buffer=0).first()["q"] == pytest.approx(
        stats.quantiles(df, "x", probs, max_buffer=1 << 60).first()["q"], abs=1e-9)
    a = {r["g"]: r["q"] for r in stats.quantiles(df, "x", probs, by=["g"], max_buffer=0).collect()}
    b = {r["g"]: r["q"] for r in stats.quantiles(df, "x", probs, by=["g"], max_buffer=1 << 60).collect()}
    assert a.keys() == b.keys() and all(a[g] == pytest.approx(b[g], abs=1e-9) for g in a)


def test_ema_span_three(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 3, 8.0)], "k string, t int, x double")
    assert one(timeseries.ema(df, ["k"], ["t"], "x", [3], ["y"]).orderBy("t"), "y") == [2.0, 3.0, 5.5]


@pytest.mark.parametrize("block", [2, 3, 256])
def test_ema_equals_a_plain_loop_for_a_hot_key(spark, block):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 11}", i, rng.uniform(-5, 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, x double").repartition(5)
    got = {(r["k"], r["t"]): (r["a"], r["b"]) for r in timeseries.ema(df, ["k"], ["t"], "x", [4, 200], ["a", "b"], block=block).collect()}
    state = {}
    for k, t, x in rows:
        want = []
        for i, span in enumerate((4, 200)):
            a = 2 / (span + 1)
            y = state.get((k, i))
            y = x if y is None else (1 - a) * y + a * x
            state[k, i] = y
            want.append(y)
        assert got[k, t] == pytest.approx(tuple(want), abs=1e-9)
    assert len(got) == len(rows)


def test_rare_to_other_keeps_below_the_limit(spark):
    df = spark.createDataFrame([(v,) for v in "aaaaaabbcd"], "v string")
    out = encode.rare_to_other(df, "v", 80, "w").groupBy("v").agg(F.first("w").alias("w")).orderBy("v")
    assert one(out, "w") == ["a", "OTHERS", "OTHERS", "OTHERS"]


def test_rank_encode_ties_by_name(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.0)], "k string, y double")
    assert {r["k"]: r["r"] for r in windows.rank_encode(df, "k", "y", "r").collect()} == {"c": 0, "a": 1, "b": 2}


def test_nearest_mark_prefers_the_smaller(spark):
    df = spark.createDataFrame([(v,) for v in (15, 16, 4, 99, 10)], "x int")
    marks = spark.createDataFrame([(10,), (20,)], "m int")
    assert dict(ordering.nearest_mark(df, "x", marks, "m", "n").select("x", "n").collect()) == {15: 10, 16: 20, 4: 10, 99: 20, 10: 10}


def utility(spark, rows):
    df = spark.createDataFrame(rows, "d int, w double, r double, a int")
    return aggregate.utility_score(df, F.col("d"), F.col("w"), F.col("r"), F.col("a")).first()["u"]


def test_utility_without_trades_is_plain_zero(spark):
    u = utility(spark, [(1, 1.0, 2.0, 0), (2, 1.0, 2.0, 0)])
    assert u == 0.0 and math.copysign(1, u) == 1


def test_utility_is_capped_and_never_minus_zero(spark):
    assert utility(spark, [(1, 1.0, 3.0, 1), (2, 1.0, 4.0, 1)]) == pytest.approx(42)
    u = utility(spark, [(1, 1.0, -3.0, 1), (2, 1.0, -4.0, 1)])
    assert u == 0.0 and math.copysign(1, u) == 1


def test_gini(spark):
    df = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double")
    assert stats.gini(df([1, 1, 1, 1]), "x").first()["gini"] == pytest.approx(0, abs=1e-5)
    assert stats.gini(df([0, 0, 0, 1]), "x").first()["gini"] == pytest.approx(0.75, abs=1e-5)
    assert stats.gini(df([-1, -1, -1, 0]), "x").first()["gini"] == pytest.approx(0.75, abs=1e-5)


def test_purged_split_blocks(spark):
    df = spark.createDataFrame([(g, i) for g in range(1, 13) for i in range(3)], "g int, i int")
    split = timeseries.purged_group_split(df, "g", ["g", "i"], n_splits=3, group_gap=1)
    groups = lambda f, r: sorted({x["g"] for x in split.where((F.col("fold") == f) & (F.col("role") == r)).collect()})
    assert [groups(f, "test") for f in range(3)] == [[4, 5, 6], [7, 8, 9], [10, 11, 12]]
    assert [groups(f, "train") for f in range(3)] == [[1, 2], [1, 2, 3, 4, 5], list(range(1, 9))]
    assert split.where("fold = 0 and role = 'test'").count() == 8  # one head row dropped
    assert split.where("fold = 0 and role = 'test' and g = 4 and i = 0").count() == 0


def test_hhmm_and_months(spark):
    df = spark.createDataFrame([("0005",), ("2359",)], "t string")
    assert one(df.select(dates.hhmm_to_minutes(F.col("t")).alias("m")), "m") == [5, 1439]
    d = spark.sql("select timestamp'2020-01-01' a, timestamp'2020-01-04' b")
    assert d.select(dates.months_between_instants(F.col("a"), F.col("b")).alias("m")).first()["m"] == 1.0


def test_text_functions(spark):
    df = spark.createDataFrame([("<a><b-c>", "A, b! c", "<p>x&amp;y</p><script>z</script>", None)], "t string, n string, h string, z string")
    r = df.select(text.tag_cleanup(F.col("t")).alias("t"), text.text_normalize(F.col("n")).alias("n"), text.html_to_text(F.col("h")).alias("h"),
                  text.concat_title_body(F.col("z"), F.col("t")).alias("c"), text.list_contains_score(text.items(F.col("z")), ["x"]).alias("s"),
                  text.split_count(F.col("n")).alias("k")).first()
    assert (r["t"], r["n"], r["h"], r["c"], r["s"], r["k"]) == ("a b-c", "a b c", "x&y", ". <a><b-c>", None, 2)


def test_merged_items_are_null_if_any_is(spark):
    df = spark.createDataFrame([("x", None, "y"), ("x", "z", "y")], "a string, b string, c string")
    merged = df.select(encode.merged_items([F.col("a"), F.col("b"), F.col("c")]).alias("t"))
    out = encode.multi_hot(merged, F.col("t"), ["x", "y"], "is").select("is_x", "is_y").collect()
    assert [tuple(r) for r in out] == [(0, 0), (1, 1)]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, c double")
    assert one(scale.standard_scale(df, ["x"]).orderBy("x"), "x") == [-1.0, 1.0]
    assert one(scale.minmax_scale(df, ["c"]), "c") == [0.0, 0.0]


def test_boxcox_round_trip(spark):
    df = spark.createDataFrame([(float(v),) for v in range(-5, 40)], "x double")
    t = scale.boxcox_transform(df, "x", [-1.0, 0.0, 0.5, 1.0], "y")
    back = t.select("x", (numbers.boxcox_inverse(F.col("y"), F.col("lam")) - F.col("shift")).alias("z")).collect()
    assert all(r["x"] == pytest.approx(r["z"], abs=1e-9) for r in back)


def brute(q, d, k, metric):
    out = {}
    for qi, v in q:
        dist = lambda w: sum(abs(a - b) for a, b in zip(v, w)) if metric == "manhattan" else math.dist(v, w)  # noqa: B023,E731
        out[qi] = [i for _, i in sorted((round(dist(w), 9), i) for i, w in d)[:k]]
    return out


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_knn_equals_brute_force_with_many_copies(spark, metric, limit, monkeypatch):
    """A third of the vectors are copies of one; both ways of searching agree with all pairs."""
    monkeypatch.setattr(knn, "CHUNK_ROWS", 16)
    monkeypatch.setattr(knn, "QUERY_ROWS", 8)
    rng = random.Random(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [rng.gauss(i % 4, 0.3) for _ in range(3)]) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {}
    for r in knn.knn_join(df, df, 4, query_key="id", data_key="id", vector="v", metric=metric, broadcast_bytes=limit).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor"])
    assert got == brute(rows, rows, 4, metric)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_search_needs_no_memory_that_grows_with_the_data(metric):
    """Pieces are looked at one by one; those that lie too far away are never scored."""
    import tracemalloc
    rng = np.random.default_rng(3)
    data = rng.normal(size=(20_000, 16)) + np.repeat(np.arange(20), 1000)[:, None] * 100.0
    pieces = [(np.arange(at, at + 1000), data[at:at + 1000], knn._ball(data[at:at + 1000], metric)) for at in range(0, len(data), 1000)]
    q = data[5000:5500] + 0.1
    tracemalloc.start()
    row, vid, dist = knn._nearest(q, pieces, 3, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 << 20
    for i in (0, 17, 499):
        d = np.abs(data - q[i]).sum(axis=1) if metric == "manhattan" else np.sqrt(((data - q[i]) ** 2).sum(axis=1))
        best = np.lexsort((np.arange(len(data)), d))[:3]
        assert vid[row == i].tolist() == best.tolist() and dist[row == i] == pytest.approx(d[best])


def test_knn_groups_that_meet_are_bounded():
    for n in (10, 100_000, 10_000_000):
        groups = knn._grid(n, 64, knn.CHUNK_ROWS, 12)
        assert n * 64 * 8 / groups <= knn.GROUP_BYTES and groups <= max(10, 1 + n * 64 * 8 // knn.GROUP_BYTES)


def test_short_lengths_keep_their_digits():
    a = np.array([[1e6, 1.0], [1e6, 1.0 + 1e-6], [1e6 + 1, 1.0]])
    b = np.vstack([a, [[-1e6, 0.0]]])
    want = np.array([[math.dist(x, y) for y in b] for x in a])
    assert knn._lengths(a, b) == pytest.approx(want, rel=1e-9, abs=0)


def test_knn_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "id long, v array<double>")
    for limit in (0, 1 << 30):
        assert knn.knn_join(df, df, 5, query_key="id", data_key="id", vector="v", broadcast_bytes=limit).count() == 4


def test_previous_value_across_partitions(spark):
    rows = [("hot" if i % 2 else f"k{i % 5}", i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(6)
    got = {r["t"]: r["p"] for r in windows.previous_flag(df, ["k"], ["t"], "v", "p").collect()}
    last = {}
    for k, t, v in rows:
        assert got[t] == last.get(k, 0)
        last[k] = v


def test_group_row_index_and_running_total(spark):
    rows = [(0 if i % 3 else i % 7, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, i int").repartition(5)
    seen = {}
    for r in sorted(ordering.group_row_index(df, ["g"], ["i"], "n").collect(), key=lambda r: r["i"]):
        assert r["n"] == seen.get(r["g"], 0)
        seen[r["g"]] = r["n"] + 1
    run = {r["i"]: r["s"] for r in ordering.running_total(df, ["i"], "i", "s").collect()}
    assert run == {i: i * (i + 1) // 2 for i in range(400)}


def test_stratified_split_and_folds(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"s{i % 2}") for i in range(900)], "id int, s string")
    split = timeseries.stratified_split(df, "id", ["s"], 0.1)
    assert {r["s"]: r["n"] for r in split.where("is_test = 1").groupBy("s").agg(F.count("*").alias("n")).collect()} == {"hot": 60, "s0": 15, "s1": 15}
    folds = timeseries.kfold_split(df, "id", ["s"], 5).groupBy("s", "fold").agg(F.count("*").alias("n")).collect()
    assert {r["n"] for r in folds if r["s"] == "hot"} == {120} and len(folds) == 15


def test_impute_chained_equals_row_by_row(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    x[:, 2] = 2 * x[:, 0] - x[:, 1] + 0.01 * rng.normal(size=300) + 5
    holes = x.copy()
    holes[::4, 2] = np.nan
    holes[::6, 0] = np.nan
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(holes)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double")
    got = np.array([[r["a"], r["b"], r["c"]] for r in linear.impute_chained(df, ["a", "b", "c"], rounds=5).orderBy("i").collect()])
    want, missing = holes.copy(), np.isnan(holes)
    for j in range(3):
        want[missing[:, j], j] = np.nanmean(holes[:, j])
    for _ in range(5):
        for j in range(3):
            if missing[:, j].any():
                o = [k for k in range(3) if k != j]
                z = np.c_[np.ones(300), want[:, o]]
                w = np.linalg.lstsq(z[~missing[:, j]], want[~missing[:, j], j], rcond=None)[0]
                want[missing[:, j], j] = z[missing[:, j]] @ w
    assert np.allclose(got, want, atol=1e-8)


def test_silhouette_needs_two_labels(spark):
    df = spark.createDataFrame([(1, [0.0], 1), (2, [1.0], 1)], "id int, v array<double>, c int")
    assert knn.silhouette(df, "id", "v", "c").first()["silhouette"] == -1.0


def test_roc_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.8), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first()["auc"] == pytest.approx(0.875)


def test_repeated_rows_and_sparse_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "a", None)], "i int, t string, z string")
    assert sorted(one(aggregate.repeated_rows(df, ["t"]), "i")) == [1, 3]
    assert relational.drop_sparse_columns(df).columns == ["i", "t"]


def test_three_way_and_median(spark):
    df = spark.createDataFrame([(0.4,), (0.55,), (0.9,)], "p double")
    assert one(df.select(numbers.three_way(F.col("p"), 0.6).alias("a")), "a") == [0, -1, 1]
    assert df.select(numbers.row_median([F.lit(1.0), F.lit(4.0), F.lit(2.0), F.lit(9.0)]).alias("m")).first()["m"] == 3.0


def test_euclidean_silhouette_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 3, 0.4), rng.gauss(0, 1)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, v array<double>, c int")
    total = 0.0
    for i, v, c in rows:
        mean = lambda k: [math.dist(v, w) for j, w, d in rows if d == k and j != i]  # noqa: B023,E731
        a, b = np.mean(mean(c)), min(np.mean(mean(k)) for k in range(3) if k != c)
        total += (b - a) / max(a, b)
    for rows_per_block in (4096, 7):
        assert knn.silhouette_euclidean(df, "id", "v", "c", rows_per_block).first()["silhouette"] == pytest.approx(total / 60)
    assert knn.silhouette_euclidean(df.where("c = 1"), "id", "v", "c").first()["silhouette"] == -1.0


def test_peek_line(spark, tmp_path):
    from saltmarsh.sources import peek_line
    (tmp_path / "a.txt").write_text("x\ny\nz\n")
    assert peek_line(spark, str(tmp_path / "a.txt"), 1).first()[0] == "y"


def test_stream_scores_every_record_once_over_many_batches(spark, tmp_path):
    from saltmarsh.streaming.scoring import stream_score
    df = spark.createDataFrame([(i, i / 50) for i in range(50)], "i long, p double").repartition(6)
    df.write.parquet(str(tmp_path / "in"))
    out = stream_score(spark, str(tmp_path / "in"), df.schema, lambda d: d.select("i", numbers.three_way(F.col("p"), 0.6).alias("a")), max_files=1)
    want = {r["i"]: r["a"] for r in df.select("i", numbers.three_way(F.col("p"), 0.6).alias("a")).collect()}
    assert sorted((r["i"], r["a"]) for r in out.collect()) == sorted(want.items())


def test_rows_with_null_keys_are_kept(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "i int, k string")
    assert {r["i"]: r["n"] for r in windows.attach_counts(df, {"n": ["k"]}).collect()} == {1: 2, 2: 2, 3: 1}
    assert {r["i"]: r["n"] for r in ordering.group_row_index(df, ["k"], ["i"], "n").collect()} == {1: 0, 2: 1, 3: 0}
    assert timeseries.kfold_split(df, "i", ["k"], 2).count() == 3


def test_clock_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            d = spark.sql("select timestamp_ntz'2020-03-08 00:00:00.000001' a").select(
                dates.micros_of(F.col("a")).alias("us"), dates.seconds_of(F.col("a")).alias("s")).first()
            assert d["us"] == 1583625600000001 and d["s"] == pytest.approx(1583625600.000001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_partitioned_knn_equals_broadcast_knn_on_embeddings(spark, sf, metric, monkeypatch):
    from saltmarsh.sources import table
    monkeypatch.setattr(knn, "CHUNK_ROWS", 64)
    e = table(spark, sf, "embeddings")
    run = lambda limit: knn.knn_join(e, e, 5, query_key="vec_id", data_key="vec_id", vector="embedding", metric=metric, broadcast_bytes=limit)
    rows = lambda df: sorted((r["vec_id"], r["rank"], r["neighbor"], round(r["distance"], 9)) for r in df.collect())
    assert rows(run(0)) == rows(run(1 << 30))


def test_no_division_by_zero(spark):
    flat = spark.createDataFrame([("a", 3.0, 0.0, 1), ("a", 3.0, 0.0, 1)], "k string, x double, z double, one int")
    assert relational.without_zscore_outliers(flat, ["x"]).count() == 0
    assert flat.agg(stats.sample_skewness("x").alias("s")).first()["s"] is None
    assert {r["percent_complete"] for r in stats.completeness(flat.limit(0)).collect()} == {None}
    assert stats.spearman(flat, "x", "z").first()["rho"] is None
    assert stats.entropy(flat, "z", ["k"]).first()["entropy"] == 0
    assert [r["cum_share"] for r in windows.cumulative_share(flat, "one", "z").collect()] == [None, None]
    assert metrics.residual_weights(flat, "x", "x", 0.1).count() == 0
    assert metrics.roc_auc(flat, "one", "x").first()["auc"] is None


def test_ema_keeps_and_ages_rows_without_a_value(spark):
    rng = np.random.default_rng(3)
    rows = [(k, t, None if rng.random() < gaps else float(rng.normal())) for k, n, gaps in (("a", 700, 0.4), ("b", 40, 0.9), ("c", 3, 1.0)) for t in range(n)]
    rows += [("d", 0, 1.0)] + [("d", t, None) for t in range(1, 400)] + [("d", 400, 5.0), ("d", 401, 6.0)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    got = {(r["k"], r["t"]): (r["y1"], r["y3"]) for r in timeseries.ema(df, ["k"], ["t"], "x", [1, 3], ["y1", "y3"], block=16).collect()}
    assert len(got) == len(rows)
    for i, span in enumerate([1, 3]):
        a = 2 / (span + 1)
        for key in "abcd":
            y, w = None, 1.0
            for k, t, x in (r for r in rows if r[0] == key):
                if x is None:
                    w *= 1 - a
                else:
                    y, w = (x if y is None else (w * (1 - a) * y + a * x) / (w * (1 - a) + a)), 1.0
                assert got[k, t][i] == (None if y is None else pytest.approx(y, abs=1e-9)), (k, t, span)


def test_silhouette_of_equal_rows_is_zero(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], i % 2) for i in range(4)], "id long, v array<double>, c int")
    assert knn.silhouette(df, "id", "v", "c").first()["silhouette"] == 0


def test_purged_split_refuses_too_few_groups(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(6)], "t int, g int")
    with pytest.raises(ValueError):
        timeseries.purged_group_split(df, "g", ["t"], n_splits=5)


def test_rows_of_a_table_joined_with_itself_meet_once(spark, monkeypatch):
    """Pieces meet once for the rows of both, by sums of whole numbers; copies, an outlier and a vector far from zero included."""
    rng = np.random.default_rng(71)
    rows = np.round(rng.normal(size=(900, 12)), 3)
    rows[300:310], rows[400], rows[500] = rows[0:10], 1e6, rows[1] + 1e-7
    met = []
    monkeypatch.setattr(knn, "_sums", lambda a, b, sums=knn._sums: met.append((a.shape[1], b.shape[1])) or sums(a, b))
    cut = [slice(0, 256), slice(256, 600), slice(600, 900)]
    pieces = [(np.arange(900)[c], rows[c], knn._ball(rows[c], "manhattan")) for c in cut]
    want = np.abs(rows[:, None] - rows).sum(axis=2)
    for left, right in ((pieces, []), (pieces[:2], pieces[2:]), (pieces[2:], pieces[:2])):
        met.clear()
        for ids, near, dist in knn._nearest_of_each(left, right, 4):
            others = np.concatenate([i for i, _, _ in (right if right and ids[0] in np.concatenate([i for i, _, _ in left]) else left)])
            for q in np.unique(ids):
                order = others[np.lexsort((others, want[q, others]))[:4]]
                assert near[ids == q].tolist() == order.tolist() and np.allclose(dist[ids == q], want[q, order])
        assert len(met) == (2 if right else 6) and len(set(map(frozenset, met))) >= 2


@pytest.mark.parametrize("odd", [False, True])
def test_a_manhattan_join_of_a_table_with_itself_in_a_grid(spark, odd):
    rng = np.random.default_rng(73)
    rows = np.round(rng.normal(size=(2500, 6)), 2)
    if odd:  # not to be counted in steps
        rows[7, 2] = np.inf
    ids = np.arange(2500)
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, rows)], "id long, v array<double>")
    run = lambda other, limit: sorted((r.id, r.rank, r.neighbor, round(r.distance, 9)) for r in knn.knn_join(
        df, other, 3, query_key="id", data_key="id", vector="v", metric="manhattan", broadcast_bytes=limit).where("id != 7").collect())
    assert run(df, 0) == run(df.select("*"), 1 << 30)
