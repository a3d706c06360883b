"""Ball k-means against comparing every part with every entry, round after round."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import ball_kmeans
from leafmill.llm.queries import QUERIES


def plain(rows, parts=8, entries=16, rounds=6):
    """(id, label, vector) rows to the codes, errors and codebooks."""
    rows = [r for r in rows if r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    rows.sort(key=lambda r: (r[0], r[2]))
    x = np.floor(np.array([r[2] for r in rows], np.float64) * 4096).astype(np.int64).reshape(len(rows), parts, -1)
    book = x[:entries].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        distance = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        code = distance.argmin(axis=2)
        if step < rounds:
            for p in range(parts):
                for e in range(book.shape[1]):
                    own = x[code[:, p] == e, p]
                    if len(own):
                        book[p, e] = own.sum(axis=0) // len(own)
    error = distance.min(axis=2).sum(axis=1)
    return [(r[0], r[1], "".join(f"{c:02x}" for c in code[i]), int(error[i])) for i, r in enumerate(rows)], book


def made_rows(n, dimension, seed=0, clusters=5, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimension))
    vectors = (centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dimension))).astype(np.float32).astype(float).tolist()
    return [(i, None if i % 7 == 0 else i % 3, v) for i, v in enumerate(vectors)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("code", "block", "codes", "data", "error")]).repartition(3)
    coded, book = ball_kmeans.vector_codes(df, **options)
    expected, plain_book = plain([(i, l, v) for i, l, v in rows], **options)
    assert sorted(map(str, map(tuple, coded.collect()))) == sorted(map(str, expected))
    assert (book == plain_book).all()
    return coded


@pytest.mark.parametrize("n, dimension, spread", [(400, 16, 0.1), (300, 8, 1.0), (5, 16, 0.1), (900, 32, 0.01)])
def test_equals_plain_rounds(spark, n, dimension, spread, monkeypatch):
    monkeypatch.setattr(ball_kmeans, "BLOCK_BYTES", 4 * dimension * 37)
    check(spark, made_rows(n, dimension, n, spread=spread))


def test_odd_rows(spark):
    rows = made_rows(60, 8)
    odd = [(100, 1, None), (101, 1, [None] * 8), (102, 2, [float("nan")] + [0.0] * 7), (103, 2, [float("inf")] + [0.0] * 7), rows[3], rows[3]]
    ties = [(200 + i, 5, [0.5] * 8) for i in range(20)]
    coded = check(spark, rows + odd + ties)
    errors = {}
    for r in coded.collect():
        errors[r.label] = errors.get(r.label, 0) + r.error
    with_sums = ball_kmeans.with_label_error(coded).collect()
    assert len(with_sums) == coded.count() and all(r.label_error == errors[r.label] for r in with_sums)


def test_other_lengths_are_dropped_and_empty_tables(spark):
    rows = made_rows(30, 8)
    df = spark.createDataFrame(rows + [(300, 1, [1.0] * 4), (301, 1, [])], "vec_id bigint, label int, embedding array<float>")
    coded, _ = ball_kmeans.vector_codes(df)
    assert {r.vec_id for r in coded.collect()} == {r[0] for r in rows}
    coded, book = ball_kmeans.vector_codes(df.limit(0))
    assert coded.count() == 0 and book.size == 0
    assert ball_kmeans.codebooks_sha256(book) == hashlib.sha256(b"").hexdigest()


def test_balls_skip_work():
    """Entries far apart: every part is in a stable core, and balls that do not move are not looked at."""
    book = np.array([[[0, 0], [1000, 0], [0, 1000]]])
    x = np.array([[1, 1], [990, 3], [2, 999], [4, 0]])
    code = np.array([0, 1, 2, 0], np.uint8)
    reach = np.array([[16, 109, 5]])
    at, found, distance = ball_kmeans.Balls(book, reach, np.zeros((1, 3), bool)).assign(0, x, code, whole=False)
    assert len(at) == 0
    balls = ball_kmeans.Balls(book, reach, np.array([[True, False, False]]))
    assert balls.still.tolist() == [[False, True, True]] and (balls.rings[0] > 4 * reach.T).all()
    at, found, distance = balls.assign(0, x, code, whole=False)
    assert at.tolist() == [0, 3] and found.tolist() == [0, 0] and distance.tolist() == [2, 16]


def test_vector_blocks_are_not_shuffled(spark):
    """The codes come to the bucketed vectors: one exchange at most, none on the vectors."""
    import contextlib
    import io

    plans, real = [], ball_kmeans.materialize

    def spy(df, label):
        if label == "codes":
            with contextlib.redirect_stdout(io.StringIO()) as out:
                df.explain()
            plans.append(out.getvalue())
        return real(df, label)

    ball_kmeans.materialize = spy
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ball_kmeans.vector_codes(spark.createDataFrame(made_rows(50, 8), "vec_id bigint, label int, embedding array<float>"))
    finally:
        ball_kmeans.materialize = real
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(plans) == 6
    for plan in plans[1:]:
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_query_leaves_no_table(spark):
    made = QUERIES["op12_ball_kmeans_codes"](spark, "/root/testdata/sf0.001")
    assert made.count() == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("leafmill_vectors")]
