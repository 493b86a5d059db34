import hashlib

import numpy as np
import pytest

from tessera.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts, n_entries, rounds=2, scale=256):
    """Codes, errors and digest by direct comparison with every entry."""
    x = np.array([np.floor(scale * np.array(r[1])) for r in rows], np.int64)
    width = -(-x.shape[1] // parts)
    x = np.pad(x, ((0, 0), (0, width * parts - x.shape[1]))).reshape(len(x), parts, width)
    by = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:n_entries]
    books = x[by].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        entry, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[entry[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    entry, d = assign()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return [("".join(f"{e:02x}" for e in es), int(ds.sum())) for es, ds in zip(entry, d, strict=True)], digest


@pytest.mark.parametrize("spread,arity", [(2, 2), (3, 6), (1000, 6), (1000, 9)])
def test_gnat_finds_the_nearest_and_breaks_ties_low(spread, arity):
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread + 1, (64, 4))
    tree = codes.Gnat(points, arity)
    q = rng.integers(-2 * spread, 2 * spread + 1, (3000, 4))
    entry, square = tree.nearest(q)
    d = ((q[:, None] - points[None]) ** 2).sum(2)
    assert (entry == d.argmin(1)).all() and (square == d.min(1)).all()


def test_gnat_leaves_subtrees_out():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-5, 6, (16, 4)) + c for c in (0, 10_000, 20_000, 30_000)])
    tree = codes.Gnat(points)
    q = points + rng.integers(-3, 4, points.shape)
    entry, _ = tree.nearest(q)
    assert (entry == ((q[:, None] - points[None]) ** 2).sum(2).argmin(1)).all()
    assert tree.compared < 0.5 * len(q) * len(points)


def test_gnat_rounds_roots_of_large_squares():
    big = 1 << 24
    points = np.array([[big, 0], [big, 1], [-big, 0], [-big, -1], [0, big], [0, big - 1], [3, 4], [4, 3]])
    q = np.array([[big, 0], [0, 0], [big - 1, 1], [-big, 1], [1, big], [7, 7]])
    entry, _ = codes.Gnat(points, 3).nearest(q)
    assert (entry == ((q[:, None] - points[None]) ** 2).sum(2).argmin(1)).all()


@pytest.mark.parametrize("dimensions,parts,n_entries", [(32, 16, 64), (6, 4, 8), (3, 1, 200)])
def test_codes_equal_direct_comparison(frame, dimensions, parts, n_entries):
    rng = np.random.default_rng(1)
    rows = [(i * 3 % 151, rng.integers(-4, 5, dimensions).astype(float).tolist(), i % 3 or None) for i in range(150)]
    want, digest = plain(rows, parts, n_entries, scale=2)
    got = codes.compress(frame(rows, SCHEMA), parts, n_entries, scale=2).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((r[0], *w) for r, w in zip(rows, want, strict=True))
    assert {r.codebooks_sha256 for r in got} == {digest}
    label, total = {r[0]: r[2] for r in rows}, {}
    for r, (_, error) in zip(rows, want, strict=True):
        total[r[2]] = total.get(r[2], 0) + error
    assert all(r.label_error == total[label[r.vec_id]] for r in got)


def test_unusable_vectors_repeated_rows_and_clashing_names(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [3.0, -1.0], None), (None, [5.0, 5.0], None), (4, None, 1),
            (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [], 1), (9, [1.0, 2.0, 3.0], 1), (10, [0.0, 0.0], 3)]
    df = frame([(*r, "x", 7, "y") for r in rows], SCHEMA + ", code string, error int, v string")
    got = codes.compress(df, parts=2, n_entries=2, scale=1)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = got.collect()
    kept = [r for r in rows if r[0] in (1, 2, 10) or r[1] == [5.0, 5.0]]
    want, digest = plain(kept, 2, 2, scale=1)
    assert sorted((r.vec_id or 0, r.code, r.error) for r in got) == sorted((r[0] or 0, *w) for r, w in zip(kept, want, strict=True))
    assert {r.codebooks_sha256 for r in got} == {digest}
    null = [w[1] for r, w in zip(kept, want, strict=True) if r[2] is None]
    assert [r.label_error for r in got if r.vec_id in (2, None)] == [sum(null)] * 2


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_tables_without_codes(spark, rows):
    assert codes.compress(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_empty_vectors_have_a_code(spark):
    got = codes.compress(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).collect()
    assert [(r.code, r.error, r.label_error) for r in got] == [("00" * 16, 0, 0)] * 2


def test_label_sums_beyond_the_broadcast_bound(frame, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-9, 9, 4).astype(float).tolist(), None if i % 3 == 0 else i % 40) for i in range(120)]
    small = codes.compress(frame(rows, SCHEMA), 2, 4).collect()
    monkeypatch.setattr(codes, "BROADCAST_BYTES", 0)
    assert sorted(codes.compress(frame(rows, SCHEMA), 2, 4).collect()) == sorted(small)
