"""Whitening, hard negatives and neighbours against brute force, over whole tables and over their defined cases."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tracewright.llm import negatives, neighbours, queries, whitening
from tracewright.llm.vectors import quantised, usable

NAN, INF = float("nan"), float("inf")
#: A column of each name that the operators use themselves.
CLASH = ["id", "vec", "x", "index", "row", "cell", "slice", "chunk", "anchor", "rank", "score", "query", "n", "__at", "__part", "size"]


def odd_rows(seed=5, size=120, dim=6):
    """Rows with repeats, ties, null and broken vectors, null ids and labels, vectors of other lengths."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(size, dim)).astype(np.float32)
    x[10:40] = x[10]  # a hot vector
    rows = [(i, x[i].tolist(), int(rng.integers(3))) for i in range(size)]
    rows += [(3, x[3].tolist(), 1), (3, x[4].tolist(), 2), (50, x[50].tolist(), rows[50][2]), (0, x[0].tolist(), 0), (100, x[7].tolist(), 1)]
    rows += [(900, None, 1), (901, [], 1), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (903, [NAN] * dim, 1), (904, [INF] + [0.0] * (dim - 1), 1)]
    rows += [(905, [1.0, 2.0], 1), (906, [0.0] * dim, 2), (950, x[2].tolist(), None), (None, x[5].tolist(), 2), (-50, x[6].tolist(), 0), (-700, x[8].tolist(), 1)]
    return rows


def write(folder, rows):
    table = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())), "label": pa.array([r[2] for r in rows], pa.int32())})
    for name in CLASH:
        table = table.append_column(name, pa.array(["clash"] * len(rows), pa.string()))
    pq.write_table(table, f"{folder}/embeddings.parquet")
    return folder


def good(rows, dim=6):
    return [r for r in rows if r[1] is not None and len(r[1]) == dim and all(v is not None and math.isfinite(v) for v in r[1])]


def whole(x, scale, shift=0):
    return np.floor(scale * np.array(x, np.float32).astype(np.float64)).astype(np.int64) + shift


# -- whitening


def check_whitening(found, rows, components=8):
    ids = [r[0] for r in rows]
    x = whole([r[1] for r in rows], 1024, 100_000)
    n, sums = len(x), x.sum(0)
    far = n * x - sums
    centred = far / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = min(components, x.shape[1])
    assert sorted({r.component for r in found}) == list(range(1, width + 1)) and len(found) == n * width
    key = lambda v: (v is None, v or 0)
    for c in range(width):
        got = sorted(((key(r.vec_id), r.deviation, r.whitened) for r in found if r.component == c + 1), key=lambda t: t[:2])
        z = centred @ vectors[:, c] / math.sqrt(values[c])
        want = sorted(((key(i), int(d), v) for i, d, v in zip(ids, (far**2).sum(1), z)), key=lambda t: t[:2])
        assert [g[:2] for g in got] == [w[:2] for w in want]
        a, b = (sorted((k, d, v) for k, d, v in rows) for rows in (got, want))
        a, b = np.array([v[2] for v in a]), np.array([v[2] for v in b])
        sign = np.sign((a * b).sum())
        assert np.abs(a - sign * b).max() < 1e-8
        share = {r.explained for r in found if r.component == c + 1}
        assert len(share) == 1 and abs(share.pop() / (values[c] / values.sum()) - 1) < 1e-9
    assert {r.n for r in found} == {n}
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_whitening_query_of_odd_rows(spark, tmp_dir):
    rows = odd_rows()
    check_whitening(queries.op11_whitening(spark, write(tmp_dir, rows)).collect(), good(rows))


def test_whitening_of_many_blocks_and_slabs(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("SCATTER_BLOCKS", 3), ("PROJECT_BLOCKS", 2), ("BLOCKS_A_SPLIT", 2)):
        monkeypatch.setattr(whitening, name, value)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=9) * range(1, 10)).tolist(), 0) for i in range(150)]
    table = spark.createDataFrame([(r[0], r[1]) for r in rows], "vec_id long, embedding array<float>").repartition(7)
    used = usable(table, "vec_id", "embedding")
    found = whitening.whitened(used.select("id", quantised("vec", 1024, 100_000).alias("x")))
    check_whitening(found.withColumnRenamed("id", "vec_id").collect(), rows)


def test_whitening_without_rows_or_variance(spark, tmp_dir):
    assert queries.op11_whitening(spark, write(tmp_dir, [])).count() == 0
    flat = spark.createDataFrame([(1, [5, 1, 7]), (2, [5, 2, 7]), (None, [5, 3, 7])], "id long, x array<bigint>")
    found = whitening.whitened(flat).collect()
    assert len(found) == 9 and {r.component for r in found if r.whitened is not None} == {1}
    assert {round(r.explained, 12) for r in found} == {1.0, 0.0} and all(r.identity_error < 1e-12 for r in found)
    one = whitening.whitened(flat.limit(1)).collect()
    assert len(one) == 3 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in one)


def test_deviations_are_exact_or_null(spark):
    big = 2**40
    rows = spark.createDataFrame([(1, [big + 1, 3]), (2, [big, 9]), (3, [big, 9])], "id long, x array<bigint>")
    assert {r.id: r.deviation for r in whitening.whitened(rows).collect()} == {1: 4 + 144, 2: 1 + 36, 3: 1 + 36}
    rows = spark.createDataFrame([(1, [2**61, 0]), (2, [-(2**61), 0])], "id long, x array<bigint>")
    assert {r.deviation for r in whitening.whitened(rows).collect()} == {None}


# -- hard negatives


def naive_negatives(rows, settings=negatives.Settings()):
    use = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, whole(v, 256)) for i, v, lab in good(rows) if i is not None and lab is not None]
    out = []
    for a, lab, q in use:
        if math.fmod(a, 50):
            continue
        scored = sorted(((-int(q @ v), i, other) for i, other, v in use), key=lambda t: t[:2])
        same = [(s, i) for s, i, other in scored if other == lab and i != a][: settings.positives]
        for s, i in same:
            window = [(t, j) for t, j, other in scored if other != lab and 50 * -s <= 100 * -t <= 95 * -s][: settings.negatives]
            out += [(a, i, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(window)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("held", [65536, 32])
def test_hard_negatives_query_of_odd_rows(spark, tmp_dir, monkeypatch, held):
    monkeypatch.setattr(negatives, "HELD", held)
    monkeypatch.setattr(negatives, "ROWS", max(8, held // 4))
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rows = odd_rows()
    found = queries.op12_hard_negatives(spark, write(tmp_dir, rows)).select(COLUMNS).collect()
    assert sorted(tuple(r) for r in found) == naive_negatives(rows)
    assert len(found) > 20


def test_hard_negatives_without_rows(spark, tmp_dir):
    assert queries.op12_hard_negatives(spark, write(tmp_dir, [])).collect() == []


def test_residue_products_are_exact():
    rng = np.random.default_rng(3)
    for most, dim in ((2, 3), (300, 64), (40_000, 700), (2**24, 1500), (2**25, 30)):
        a, b = (rng.integers(-most, most + 1, (n, dim)) for n in (7, 9))
        a[0], b[0], a[1] = most, most, -most
        bound = most * most * dim
        moduli = negatives.primes(bound)
        assert len(moduli) >= 3 and len(set(moduli)) == len(moduli) and math.prod(moduli) > 2 * bound
        found = negatives.scores(negatives.residues(a, moduli), negatives.residues(b, moduli), moduli)
        assert found.tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_too_large_scores_are_refused(spark):
    rows = spark.createDataFrame([(0, 1, [2**40]), (1, 1, [2**40])], "id long, label long, x array<bigint>")
    with pytest.raises(ValueError, match="do not fit"):
        negatives.hard_negatives(rows, F.col("id") == 0)


# -- neighbours


def naive_neighbours(rows, k=10):
    use = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, _ in good(rows) if i is not None and any(v)]
    out = {}
    for a, q in use:
        if not math.fmod(a, 100):
            near = sorted((float(np.sqrt(((q - v) ** 2).sum())), i) for i, v in use if i != a)[:k]
            out.setdefault(a, []).append([(n + 1, i, s) for n, (s, i) in enumerate(near)])
    return out


def test_neighbours_query_finds_nearest_of_odd_rows(spark, tmp_dir):
    rows = odd_rows()
    found = queries.op13_neighbours(spark, write(tmp_dir, rows)).collect()
    want = naive_neighbours(rows)
    assert {r.query_id for r in found} == set(want)
    hit = total = 0
    for query, lists in want.items():
        got = [r for r in found if r.query_id == query]
        assert len(got) == sum(map(len, lists)) and sorted(r["rank"] for r in got) == sorted(e[0] for one in lists for e in one)
        true = {(i, round(s, 9)) for one in lists for _, i, s in one}
        hit += len(true & {(r.vec_id, round(r.score, 9)) for r in got})
        total += len(true)
    assert hit >= 0.9 * total


@pytest.mark.parametrize("most", [16384, 20])
def test_neighbours_of_every_axis_are_exact(spark, monkeypatch, most):
    """With all axes probed nothing can be missed, however cells are split; ranks and ties are those of brute force."""
    monkeypatch.setattr(neighbours, "MOST", most)
    monkeypatch.setattr(neighbours, "LEAST", min(most, neighbours.LEAST))
    monkeypatch.setattr(neighbours, "GRID", 100)
    monkeypatch.setattr(neighbours, "PAIRS", 7)
    rows = [r for r in odd_rows() if r[0] != 0 and r[0] != 100] + [(0, odd_rows()[10][1], 1)]
    table = spark.createDataFrame([(r[0], r[1]) for r in rows], "vec_id long, embedding array<float>")
    found = neighbours.neighbours(usable(table, "vec_id", "embedding"), F.col("id") % 100 == 0, neighbours.Settings(target=1.0, sample_queries=5000))
    every = naive_neighbours(rows)
    for query, lists in every.items():
        got = sorted((r["rank"], r.vec_id, round(r.score, 12)) for r in found.where(F.col("query_id") == query).collect())
        if len(lists) == 1 and query == 0:
            assert got == [(n, i, round(s, 12)) for n, i, s in lists[0]]


def test_few_rows_give_all_and_none_give_none(spark, tmp_dir):
    assert queries.op13_neighbours(spark, write(tmp_dir, [])).collect() == []
    rows = [(i * 50, [float(i + 1), 1.0], 0) for i in range(5)]
    found = queries.op13_neighbours(spark, write(tmp_dir, rows)).collect()
    want = {0: [50, 100, 150, 200], 100: [50, 150, 0, 200], 200: [150, 100, 50, 0]}
    assert {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in want} == want


def test_recall_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    table = pq.read_table(f"{folder}/embeddings.parquet", columns=["vec_id", "embedding"])
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_pylist()).astype(np.float64)
    found = queries.op13_neighbours(spark, folder).collect()
    hit = asked = 0
    for q in np.nonzero(ids % 100 == 0)[0]:
        away = np.sqrt(((x - x[q]) ** 2).sum(1))
        away[q] = INF
        want = ids[np.lexsort((ids, away))[:10]]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == ids[q])
        assert [g[0] for g in got] == list(range(1, 11)) and got == sorted(got, key=lambda g: (g[2], g[1]))
        assert all(abs(s - away[np.searchsorted(ids, i)]) < 1e-12 for _, i, s in got) if (np.diff(ids) > 0).all() else True
        hit += len(set(want) & {g[1] for g in got})
        asked += 10
    assert hit >= 0.9 * asked


def test_fast_transform_and_axes():
    size = 8
    naive = np.array([[(-1) ** bin(i & j).count("1") for j in range(size)] for i in range(size)]) / math.sqrt(size)
    x = np.random.default_rng(0).normal(size=(5, size))
    assert np.allclose(neighbours.hadamard(x), x @ naive)
    for y in neighbours.turned(np.array([[3.0, 4.0, 0.0], [1e200, 0, 0], [1e-200, 1e-200, 0]]), neighbours.Settings()):
        assert np.allclose(np.linalg.norm(y, axis=1), 1)
        first = neighbours.probe_order(y)[:, 0]
        assert (np.abs(y[[0, 1, 2], first % 4]) == np.abs(y).max(1)).all() and (neighbours.axes(y) % 4 == np.abs(y).argmax(1)).all()
