import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from carrel.llm import lattice
from carrel.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """(id, links, component, kept) of each row, and the linked pairs of row numbers."""
    def good(row):
        v = row[1]
        return row[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    links, root = [set() for _ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for i, j in itertools.combinations([i for i, r in enumerate(rows) if good(r)], 2):
        if rows[i][2] != rows[j][2] or len(rows[i][1]) != len(rows[j][1]):
            continue
        a, b = (np.array(rows[k][1], np.float32).astype(np.float64) for k in (i, j))
        if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
            links[i].add(j)
            links[j].add(i)
            pairs.add((i, j))
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], len(links[i]), least, row[0] == least))
    return sorted(out, key=str), pairs


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def turned(base, cos, draw):
    other = draw.normal(size=base.shape)
    other -= (other @ base) / (base @ base) * base
    other /= np.linalg.norm(other)
    return cos * base / np.linalg.norm(base) + np.sqrt(1 - cos * cos) * other


def test_nearest_points_are_nearest():
    draw = np.random.default_rng(1)
    y = draw.normal(size=(300, 8)) * 2
    points = lattice.nearest_points(y)
    assert np.allclose(points * 2, np.rint(points * 2)) and (np.rint(points.sum(1)) % 2 == 0).all()
    steps = lattice.lattice_roots()
    assert len(steps) == 240 and np.allclose((steps**2).sum(1), 2)
    own = ((y - points) ** 2).sum(1)
    for step in steps:
        assert (own <= ((y - points - step) ** 2).sum(1) + 1e-9).all()
    assert own.max() <= 1 + 1e-9  # no point is farther than the covering radius


def test_recall_near_the_threshold(spark):
    """Pairs just above the threshold, the hardest ones, among others just below: nearly all are found."""
    draw = np.random.default_rng(2)
    rows = []
    for number in range(600):
        base = draw.normal(size=64)
        rows.append((2 * number, base.tolist(), number % 3))
        rows.append((2 * number + 1, (turned(base, 0.9301 if number % 2 else 0.9299, draw) * 3).tolist(), number % 3))
    frame = spark.createDataFrame(rows, SCHEMA)
    links = {r.vec_id: r.n_links for r in lattice.near_vectors(frame).collect()}
    found = sum(links[2 * n] == 1 for n in range(1, 600, 2))
    assert found >= 0.98 * 300
    assert not any(links[2 * n] for n in range(0, 600, 2))


@pytest.mark.parametrize("chunk", [1024, 16])
def test_groups_against_brute_force(spark, chunk):
    """A dense group of several hundred, copies, chains, two labels; with small chunks its cells are split."""
    draw = np.random.default_rng(3)
    rows, center = [], draw.normal(size=32)
    for number in range(200):
        rows.append((1000 - number, turned(center, 0.985, draw).tolist(), 1))
    rows += [(5000 + i, rows[7][1], 1) for i in range(40)] + [(6000 + i, rows[7][1], 2) for i in range(3)]
    step = draw.normal(size=32)
    for number in range(12):
        rows.append((7000 + number, step.tolist(), 2))
        step = turned(step, 0.96, draw)
    rows += [(8000 + i, draw.normal(size=32).tolist(), 1) for i in range(60)]
    draw.shuffle(rows)
    rows = [(int(a), list(map(float, v)), int(c)) for a, v, c in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want, pairs = brute(rows)
    assert len(pairs) > 5000
    assert got(lattice.near_vectors(frame, chunk=chunk, tables=12)) == want


def test_odd_rows(spark):
    one, inf, nan = [0.5, -1.0, 2.0], float("inf"), float("nan")
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [0.5, None, 2.0], 1), (9, [0.5, nan, 2.0], 1), (10, [inf, 1.0, 1.0], 1), (None, one, 1), (None, [9.0, 1.0, 1.0], 1),
        (11, [1.0, -2.0, 4.0], 1), (12, [0.5, -1.0, 2.0, 0.0], 1), (13, [1e-30, -2e-30, 4e-30], 1), (14, [-0.5, 1.0, -2.0], 1),
        (15, [1e38, -2e38, 3.4e38], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert got(lattice.near_vectors(frame)) == brute(rows)[0]
    clash = frame.withColumns({c: F.lit("x") for c in ("node", "key", "keys", "size", "many", "h1", "least", "own", "group", "id", "vector", "good")})
    assert got(lattice.near_vectors(clash)) == brute(rows)[0]
    assert lattice.near_vectors(frame.where("false")).collect() == []


def test_blocks_names_and_doubles(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=300)
    rows = [("b", base.tolist(), "x"), ("a", turned(base, 0.97, draw).tolist(), "x"), ("c", draw.normal(size=300).tolist(), "x")]
    frame = spark.createDataFrame(rows, "id string, v array<double>, kind string")
    found = lattice.near_vectors(frame, blocks=2, width=2.0, tables=8, id_col="id", vector="v", label="kind")
    assert got(found) == [("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]


def test_query_against_brute_force(spark, docs_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{docs_dir}/embeddings.parquet").collect()]
    assert got(QUERIES["op13_lattice_groups"](spark, docs_dir)) == brute(rows)[0]
