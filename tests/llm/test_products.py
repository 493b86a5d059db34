import numpy as np
import pytest

from tessera.llm import products, vectors

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, queries, k, scale=1):
    x = [np.floor(scale * np.array(v)).astype(np.int64) for _, v in rows]
    out = []
    for q, v in queries:
        c = np.floor(scale * np.array(v)).astype(np.int64)
        best = sorted((-int(c @ x[i]), rows[i][0]) for i in range(len(rows)) if rows[i][0] != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def table(kind, n=700, d=8):
    rng = np.random.default_rng(len(kind))
    if kind == "ties":
        x = rng.integers(-1, 2, (n, d))
    elif kind == "lengths":  # lengths over some orders of magnitude
        x = (rng.normal(size=(n, d)) * 10 ** rng.uniform(0, 4, (n, 1))).astype(int)
    elif kind == "clusters":
        x = rng.normal(size=(20, d))[rng.integers(0, 20, n)] * 1000 + rng.normal(size=(n, d)) * 20
    else:  # one vector for a third of the rows
        x = rng.integers(-50, 50, (n, d))
        x[: n // 3] = x[0]
    return [(int(i), [float(v) for v in np.floor(row)]) for i, row in zip(rng.permutation(n), x, strict=True)]


@pytest.mark.parametrize("kind", ["ties", "lengths", "clusters", "copies"])
def test_equals_brute_force(frame, kind):
    rows = table(kind)
    df = frame(rows, SCHEMA)
    found = products.top_products(df, df.where("vec_id % 20 = 0"), k=5, scale=1, shard=60)
    assert got(found) == plain(rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_both_prunings_are_used_and_exact():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)] * 1000 + rng.normal(size=(3000, 16)) * 5
    x = np.floor(x / np.sqrt((x**2).sum(1))[:, None] * rng.uniform(3600, 4000, (3000, 1))).astype(np.int64)
    ids = np.arange(3000)
    bucket = products.Bucket(ids, np.ones(3000, np.int64), x)
    q = x[:40]
    scores = q @ x.T
    scores[np.arange(40), np.arange(40)] = -(1 << 60)
    threshold = np.sort(scores, axis=1)[:, -10]
    by_coordinates = [bucket.by_coordinates(bucket.ranges(v, t)) for v, t in zip(q, threshold, strict=True)]
    used = [f for f in by_coordinates if f is not None]
    assert 0 < len(used) and np.mean([len(f) for f in used]) < 0.2 * 3000
    for i, (place, score) in enumerate(bucket.answer(ids[:40], q, threshold, 10)):
        want = sorted((-s, j) for j, s in enumerate(scores[i]))[:10]
        assert [(-s, j) for s, j in zip(score, bucket.ids[place], strict=True)] == want


def test_short_groups_get_no_query(frame, spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * (1000 if i < 64 else 1)).round().tolist()) for i in range(640)]
    df = frame(rows, SCHEMA)
    assert got(products.top_products(df, df.where("vec_id < 8"), k=3, scale=1, shard=16)) == plain(rows, rows[:8], 3)


def test_repeated_queries_and_candidates(frame):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0]), (3, [0.0, 0.0])]
    df = frame(rows, SCHEMA)
    found = got(products.top_products(df, df.where("vec_id = 0"), k=3, scale=1))
    assert found == sorted([(0, 1, 1, 2), (0, 2, 1, 2), (0, 3, 2, 1)] + 2 * [(0, 1, 2, 3), (0, 2, 1, 1), (0, 3, 1, 1)])


def test_unusable_vectors_and_clashing_names(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = frame([(*r, "x", "y", 3) for r in rows], SCHEMA + ", score string, rank string, shard int")
    kept = rows[:3]
    assert got(products.top_products(df, df, scale=4)) == plain(kept, kept, 20, scale=4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [])]])
def test_tables_without_answers(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert products.top_products(df, df).count() == 0
    assert products.top_products(df.where("false"), df).count() == 0


def test_scores_beyond_32_bit_floats(frame):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-(1 << 24), 1 << 24, 6).astype(float).tolist()) for i in range(80)]
    df = frame(rows, SCHEMA)
    assert got(products.top_products(df, df.where("vec_id % 20 = 0"), k=7, scale=1)) == plain(rows, rows[::20], 7)


def test_too_large_components_are_an_error(frame):
    df = frame([(1, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="component beyond"):
        products.top_products(df, df).count()


def test_shards_grow_slower_than_entries():
    assert [vectors.shards_for(n) for n in (0, 1, 64, 6400, 10**8)] == [1, 1, 1, 10, 1250]
    assert vectors.shards_for(10**12) == -(-10**12 // vectors.SHARD)
