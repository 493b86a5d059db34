import numpy as np
import pytest

from pyspark.sql import functions as F

from tessera.llm import ann, vectors


def exact(rows, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i, q in enumerate(ids):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], d[others]))][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_everything_visited_is_exact(frame):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(v)) for v in rng.integers(-2, 3, 5)]) for i in range(120)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = frame(rows, "vec_id long, embedding array<float>")
    got = found(ann.nearest(df, df.where("vec_id % 10 = 0"), share=1.0, shard=40))
    want = exact(rows)
    assert got == {q: v for q, v in want.items() if q % 10 == 0}


def test_recall_on_the_registered_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = found(ann.nearest(df, df.where("vec_id % 20 = 0")))
    want = exact([(r.vec_id, r.embedding) for r in df.collect()])
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in got]
    assert len(got) == 25 and np.mean(hits) >= 0.9
    assert all(dict(got[q])[i] == s for q in got for i, s in want[q] if i in dict(got[q]))


def test_unusable_vectors_few_rows_and_copies(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = frame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = found(ann.nearest(df, df.dropDuplicates(["vec_id"])))
    assert got[0] == [(1, 0.0), (1, 0.0), (2, 5 ** 0.5)] and set(got) == {0, 1, 2}
    assert [i for i, _ in got[2]] == [0, 1, 1]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])]])
def test_tables_without_answers(frame, spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ann.nearest(df, df).count() == 0


def test_visit_walks_pairs_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(5)
    cells, reach = ann.visit(a, b, np.ones(35, int), 35)
    sums = [a[c // 5] + b[c % 5] for c in cells]
    assert sorted(cells) == list(range(35)) and sums == sorted(sums)
    assert reach == sums[-1] and ann.visit(a, b, np.ones(35, int), 9) == (cells[:9], sums[8])


def test_repeated_query_rows_are_answered_each(frame):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [0.0, 4.0])]
    df = frame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r.vec_id, round(r.score, 9)) for r in ann.nearest(df, df.where("vec_id = 0"), k=2, share=1.0).collect())
    one, other = [(1, 1, 1.0), (2, 2, round(10**0.5, 9))], [(1, 2, 2.0), (2, 1, round(5**0.5, 9))]
    assert got == sorted(one + other + other)


def clustered(n=4000, d=16, clusters=60):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(clusters, d)) * 10
    x = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, d))
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_clustered_vectors_visit_a_small_share(frame):
    rows = clustered()
    df = frame(rows, "vec_id long, embedding array<float>")
    index = ann.build_index(df.select("vec_id", F.col("embedding").alias("v")), shard=200)
    assert index.share < 0.1 and index.shards >= 20 and index.count.sum() == len(rows)
    got, want = found(ann.nearest(df, df.where("vec_id % 40 = 0"), shard=200)), exact(rows)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in got]) >= 0.9
    # queries go to the shards of the cells they visit, and to no others
    x = np.array([v for _, v in rows[::40]])
    a, b = index.books.distances(x)
    asked = [len(index.shards_of(ann.visit(p, q, index.count, int(index.share * len(rows)))[0])) for p, q in zip(a, b, strict=True)]
    assert np.mean(asked) < 0.5 * index.shards


def test_a_cell_of_many_copies_is_dealt_to_shards(frame):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i < 500 else rng.normal(size=4).tolist()) for i in range(900)]
    df = frame(rows, "vec_id long, embedding array<double>")
    index = ann.build_index(df.select("vec_id", F.col("embedding").alias("v")), shard=50)
    assert index.number.max() >= 5 and (index.count <= index.number * -(-900 // vectors.shards_for(900, 50))).all()
    got, want = found(ann.nearest(df, df.where("vec_id in (3, 700)"), share=1.0, shard=50)), exact(rows)
    assert got[3] == want[3] and got[700] == want[700]
