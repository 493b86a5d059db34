import numpy as np
import pytest

from tessera.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchors, n_positives=5, k=10, low=30, high=90, scale=1):
    c = {id(r): np.floor(scale * np.array(r[1])).astype(np.int64) for r in rows + anchors}
    out = []
    for a in anchors:
        score = [(-int(c[id(a)] @ c[id(r)]), r[0], r[2]) for r in rows if r[0] != a[0]]
        for p, pid, _ in sorted(s for s in score if s[2] == a[2])[:n_positives]:
            fit = sorted(s[:2] for s in score if s[2] != a[2] and low * -p <= -100 * s[0] <= high * -p)[:k]
            out += [(a[0], pid, rank, n, -p, -s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def table(kind, n=600, d=16):
    rng = np.random.default_rng(len(kind))
    if kind == "ties":
        x = rng.integers(-1, 2, (n, d))
    elif kind == "clusters":
        x = np.floor(rng.normal(size=(12, d))[rng.integers(0, 12, n)] * 100 + rng.normal(size=(n, d)) * 10)
    elif kind == "smooth":  # neighbouring components are alike: segment means tell most of a score
        x = np.floor(np.repeat(rng.normal(size=(n, d // 4)) * 100, 4, axis=1) + rng.normal(size=(n, d)))
    else:
        x = rng.integers(-40, 40, (n, d))
        x[: n // 3] = x[0]
    label = rng.integers(0, 4, n)
    label[: n // 3] = 1
    return [(int(i), [float(v) for v in row], int(y)) for i, row, y in zip(rng.permutation(n), x, label, strict=True)]


@pytest.mark.parametrize("kind", ["ties", "clusters", "smooth", "copies"])
def test_equals_brute_force(frame, kind):
    rows = table(kind)
    df = frame(rows, SCHEMA)
    found = negatives.mine(df, df.where("vec_id % 25 = 0"), k=4, scale=1, shard=50)
    assert got(found) == plain(rows, [r for r in rows if r[0] % 25 == 0], k=4)


def test_a_label_of_each_row_and_few_rows(frame):
    rows = [(i, [float(i % 5), float(i % 3)], i // 2) for i in range(60)]
    df = frame(rows, SCHEMA)
    assert got(negatives.mine(df, df, scale=1)) == plain(rows, rows)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(4)
    x = np.floor(np.repeat(rng.normal(size=(4000, 16)) * 100, 4, axis=1) + rng.normal(size=(4000, 64))).astype(np.int64)
    q = x[:20]
    exact = q @ x.T
    for s in negatives.LEVELS:
        level, of = negatives._Level(x, s), negatives._Level(q, s)
        middle, radius = level.bounds(of, slice(None))
        assert (exact <= middle + radius + 1e-3).all() and (exact >= middle - radius - 1e-3).all()
    segments = negatives.Segments(x)
    low, high = np.sort(exact, axis=1)[:, -40].astype(float), np.sort(exact, axis=1)[:, -10].astype(float)
    for i, (at, score) in enumerate(segments.within(q, low, high)):
        assert (at == np.flatnonzero((exact[i] >= low[i]) & (exact[i] <= high[i]))).all() and (score == exact[i, at]).all()
    assert segments.refined[-1] < 0.1 * exact.size


def test_repeated_rows_are_each_counted(frame):
    rows = [(0, [2.0, 1.0], 1), (0, [2.0, 1.0], 1), (1, [2.0, 2.0], 1), (1, [2.0, 2.0], 1), (2, [1.0, 0.0], 2), (2, [1.0, 0.0], 2),
            (3, [1.0, 1.0], 3), (4, [1.0, 1.0], None)]
    df = frame(rows, SCHEMA)
    found = negatives.mine(df, df.where("vec_id = 0"), scale=1, k=3)
    one = plain([r for r in rows if r[2]], rows[:1], k=3)
    assert len(one) == 6 and got(found) == sorted(one * 2)


def test_unusable_rows_and_clashing_names(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [4.0, 0.0], 1), (1, [3.0, 1.0], 1), (2, [2.0, 0.0], 2), (3, None, 1), (4, [1.0, 1.0], None), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [], 1), (9, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 2), (11, [0.0, 0.0], 2)]
    df = frame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", rank string, shard int, key int")
    kept = [rows[i] for i in (0, 1, 2, 11)]
    assert got(negatives.mine(df, df, scale=2)) == plain(kept, kept, scale=2)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0], None)], [(1, [1.0], 1)], [(1, [], 1)]])
def test_tables_without_answers(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert negatives.mine(df, df).count() == 0
