import brute
import numpy as np
import pytest

from wardline.llm import embeddings
from wardline.llm.common import Scratch

DDL = "vec_id bigint, embedding array<float>, label int, node string, copies string, cell int"


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL).repartition(3)
    return embeddings.near_vectors(frame, Scratch(spark, "t")).collect()


def test_recall_and_no_false_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 64))
    rows, vec = [], 0
    for b in base:  # cosines from 0.9 to 1, most of them near the limit
        b = b / np.linalg.norm(b)
        for _ in range(4):
            step = rng.normal(size=64)
            step -= (step @ b) * b
            angle = rng.uniform(0, 0.45)
            v = np.cos(angle) * b + np.sin(angle) * step / np.linalg.norm(step)
            rows.append((vec, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist(), vec % 2))
            vec += 1
    expected = brute.cosine_links(rows, embeddings.COSINE)
    got = {r.vec_id: r for r in run(spark, rows)}
    assert len(got) == len(rows)
    wanted, found = sum(n for n, _ in expected.values()), sum(r.n_links for r in got.values())
    assert all(got[v].n_links <= n for v, (n, _) in expected.items())
    assert found >= 0.95 * wanted > 0


def test_large_group_counts_every_link(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.02).tolist(), 1) for i in range(700)]
    rows += [(1000 + i, centre.tolist(), 1) for i in range(50)]
    got = run(spark, rows)
    assert {(r.n_links, r.component_id) for r in got} == {(749, 0)}
    assert [r.vec_id for r in got if r.kept] == [0]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1)]
    rows += [(7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0], 2), (11, [], 1), (2, [1.0, 0.0], 1)]
    rows += [(None, [0.0, 1.0], 3), (12, [-0.0, 1.0], 3), (-5, [0.0, 3.0], 3)]
    got = sorted((r.vec_id is not None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in run(spark, rows))
    linked = {1: (2, 1, True), 2: (2, 1, False), 12: (2, -5, False), -5: (2, -5, True)}
    expected = [(True, v, *linked.get(v, (0, v, True))) for v, *_ in rows if v is not None]
    assert got == sorted([*expected, (False, 0, 2, -5, False)])
    assert run(spark, []) == []


@pytest.mark.parametrize("width", [16, 32])
def test_recall_of_narrow_vectors_near_the_limit(spark, width):
    rng = np.random.default_rng(width)
    rows = []
    for i in range(500):  # a pair per label
        a, step = rng.normal(size=(2, width))
        a /= np.linalg.norm(a)
        step -= (step @ a) * a
        b = 0.932 * a + np.sqrt(1 - 0.932**2) * step / np.linalg.norm(step)
        rows += [(2 * i, a.tolist(), i), (2 * i + 1, b.tolist(), i)]
    assert sum(r.n_links for r in run(spark, rows)) >= 0.95 * len(rows)


def meetings(rows, tables, bits):
    """Chance meetings of a vector, of all tables, by the number of vectors."""
    return rows * tables * (bits + 1) / 2**bits


def test_layout_keeps_chance_meetings_and_misses_bounded():
    assert embeddings.layout(64, 1000).n_tables == 8 and embeddings.layout(64, 1000).n_codes == 2
    for rows in (10**5, 10**6, 10**9):
        cut = embeddings.layout(64, rows)
        assert meetings(rows, cut.n_tables, cut.table_bits) < 40 * cut.table_bits
        assert cut.per_code * cut.table_bits <= 64
        rng = np.random.default_rng(1)
        p = np.arccos(embeddings.COSINE) / np.pi
        differ = (rng.random((4000, cut.n_tables, cut.table_bits)) < p).sum(axis=2)
        assert (differ <= 1).any(axis=1).mean() > 0.97
    for width in (1, 2, 16, 32):
        cut = embeddings.layout(width, 10**6)
        assert cut.n_tables >= 8 and cut.table_bits <= width


def test_wider_substrings_find_the_same_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        a, step = rng.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        step -= (step @ a) * a
        b = 0.94 * a + np.sqrt(1 - 0.94**2) * step / np.linalg.norm(step)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, b.tolist(), 1)]
    made = embeddings.layout
    for pretended in (600, 1 << 20):  # sixteen bits, twenty bits
        monkeypatch.setattr(embeddings, "layout", lambda width, n, least, as_if=pretended: made(width, as_if, least))
        assert sum(r.n_links for r in run(spark, rows)) >= 0.95 * len(rows)


@pytest.mark.parametrize("width", [16, 64])
def test_whole_codes_of_near_pairs_stay_under_the_bound(width):
    rng = np.random.default_rng(width)
    a, step = rng.normal(size=(2, 3000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    step -= (step * a).sum(axis=1, keepdims=True) * a
    b = embeddings.COSINE * a + np.sqrt(1 - embeddings.COSINE**2) * step / np.linalg.norm(step, axis=1, keepdims=True)
    cut = embeddings.layout(width, 3000)
    directions = embeddings.fit(np.concatenate([a, b]), cut.n_codes)
    differ = ((a @ directions >= 0) != (b @ directions >= 0)).sum(axis=1)
    assert (differ <= cut.most_bits).mean() > 0.999
    assert cut.most_bits < 0.4 * directions.shape[1] or width < 64
