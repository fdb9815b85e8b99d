"""Components, SimHash and embedding near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from volspark.llm import embed_dedup, simhash
from volspark.llm.components import components
from volspark.llm.queries import registry

SF = "/root/testdata/sf0.001"


def reach(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(5)
    pairs = {"chain": [(k, k + 1) for k in range(300)], "star": [(7, k) for k in range(200)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]}[shape]
    pairs = [p for p in pairs if p[0] != p[1]]
    got = components(spark.createDataFrame([*pairs, (3, 3), (None, 1)], "a long, b long").repartition(5)).collect()
    ids = {x for p in pairs for x in p}
    assert sorted(map(tuple, got)) == sorted(reach(ids, pairs).items())


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def fingerprint(text):
    words = []
    for word in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
            "\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" "):
        words += [word] if word else []
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_definition():
    for text in (None, "", " \t\n", "One", "a b", "A b c", "\u00c9a \u00e9b\u00a0c d E", "x " * 70000):
        assert simhash.text_fingerprint(text) % (1 << 64) == fingerprint(text)


def test_spark_xxhash64_agrees(spark):
    row = spark.sql("select xxhash64('some words here') as h").first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"some words here", 42)


@pytest.mark.parametrize("block", [3, 2000])
def test_links_are_all_pairs_within_the_distance(spark, block):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base)
    for b in base[:12]:
        for _ in range(12):
            x = b
            for bit in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << bit
            values.add(x)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    assert {tuple(r) for r in simhash.links(fps, 3, 4, block).collect()} == want


def test_allocation_meets_the_pigeonhole_sum_at_least_cost():
    costs = [[0, 5, 50, 500, 5000], [0, 1, 10, 100, 1000], [0, 900, 9000, 90000, 900000], [0, 2, 20, 200, 2000]]
    picked = simhash.allocate(costs, 3)
    assert sum(t + 1 for t in picked) == 4 and picked[2] == -1
    best = min(sum(c[t] for c, t in zip(costs, ts)) for ts in np.ndindex(5, 5, 5, 5) if sum(ts) == 4)
    assert sum(c[t + 1] for c, t in zip(costs, picked)) == best


def test_op2_against_brute_force(spark):
    got = {r.doc_id: r for r in registry()["op2_simhash"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {k: fingerprint(t) for k, t in texts.items()}
    ids = sorted(fps)
    pairs = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    groups = reach(ids, pairs)
    assert {k: (r.fingerprint, r.component_id) for k, r in got.items()} == {
        k: (f"{fps[k]:016x}", groups[k]) for k in ids}


def test_simhash_edges(spark):
    rows = [(5, None, "a"), (4, "", "a"), (3, "   ", "b"), (2, "same text here now", "c"), (1, "Same TEXT here now", "d"),
            (2, "same text here now", "c"), (None, "gone", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((str(r.id), r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [("1", 1), ("2", 1), ("2", 1), ("3", 3), ("4", 3), ("5", 3), ("None", None)]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_simhash_rows_without_an_id_link_others(spark):
    """Two documents 6 bits apart that only a text without an id, 3 bits from both, brings together."""
    fps = spark.createDataFrame([(3, 0b111000), (None, 0), (None, 0), (7, 0b111), (9, -1)], "id long, fp long")
    got = simhash.grouped(fps).collect()
    assert sorted(map(str, ((r.id, r.component_id) for r in got))) == sorted(map(str, [
        (3, 3), (None, 3), (None, 3), (7, 3), (9, 9)]))


def test_simhash_of_a_long_text(spark):
    text = " ".join(f"word{k % 5003}" for k in range(60_000))
    df = spark.createDataFrame([(1, text), (2, text + " tail"), (3, text.upper())], "doc_id long, text string")
    got = {r.id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got[1] == (fingerprint(text), 1) and got[2][1] == 1 and got[3] == got[1]


def cosine_links(rows):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if v is not None and lab is not None
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for k, (i, v, lab) in enumerate(ok):
        for j, w, other in ok[:k]:
            if lab == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links.append((i, j))
    return links


def check_vectors(rows, got):
    links = cosine_links(rows)
    ids = [r[0] for r in rows]
    count = {i: sum(i in pair for pair in links) for i in ids}
    groups = reach(ids, links)
    assert {r.id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (count[i], groups[i], groups[i] == i) for i in ids}


@pytest.mark.parametrize("block", [4, 2000])
def test_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    rows, k = [], 0
    for _ in range(30):
        centre = rng.normal(size=8)
        for _ in range(rng.integers(1, 9)):
            v = centre + rng.normal(size=8) * rng.choice([0, 0.01, 0.1])
            rows.append((k, [float(np.float32(x)) for x in v * rng.choice([1, 1, 3])], int(rng.integers(2))))
            k += 1
    rows += [(k, None, 1), (k + 1, [0.0] * 8, 1), (k + 2, [float("nan")] + [1.0] * 7, 1), (k + 3, [None] + [1.0] * 7, 1),
             (k + 4, [1.0] * 8, None), (k + 5, [float("inf")] * 8, 0), (k + 6, [], 0), (k + 7, [1.0, 2.0], 0),
             (k + 8, [2.0, 4.0], 0), (k + 9, [1e30] * 8, 1), (k + 10, [-0.0, 1.0] + [0.0] * 6, 1),
             (k + 11, [0.0, 1.0] + [0.0] * 6, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as id")
    got = embed_dedup.near_duplicates(df, centroids=4, block=block, target_recall=1.0).collect()
    check_vectors(rows, got)
    assert embed_dedup.near_duplicates(df.limit(0)).collect() == []


def test_op3_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = registry()["op3_embeddings"](spark, SF).withColumnRenamed("vec_id", "id").collect()
    check_vectors(rows, got)


def test_traversal_is_nearest_first_and_stops_at_the_radius():
    m1, m2 = np.array([0.0, 0.3, 0.1]), np.array([0.2, 0.0])
    everything = embed_dedup._traverse(m1, m2, 9.0)
    sums = [m1[c // 2] ** 2 + m2[c % 2] ** 2 for c in everything]
    assert sums == sorted(sums) and sorted(everything) == list(range(6))
    assert embed_dedup._traverse(m1, m2, 0.15) == [1, 5]
    assert embed_dedup._traverse(m1, m2, 0.05) == [1]


@pytest.mark.parametrize("codebook", [1, 16, 40])
def test_a_neighbour_is_never_outside_of_the_visited_cells(codebook):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(600, 12))
    points[300:] = points[:300] + rng.normal(size=(300, 12)) * rng.choice([0.02, 0.1, 0.2], (300, 1))
    unit = embed_dedup._unit([p.tobytes() for p in points])
    grid = embed_dedup.Grid(unit[::2], codebook, 0.98, 1.0)
    home, visits = grid.visits(unit, rows=100)
    near = [(a, b) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.98)) if a != b]
    assert len(near) > 100 and all(home[b] in visits[a] for a, b in near)


def test_codebooks_follow_the_table():
    rng = np.random.default_rng(3)
    unit = embed_dedup._unit([p.tobytes() for p in rng.normal(size=(2048, 64))])
    few, many = (len(embed_dedup.fitting_grid(unit, n, 0.98, 1.0, 1000).codebooks[0]) for n in (100, 1e8))
    assert few == embed_dedup.CENTROIDS and many >= 32


def test_links_on_paths_between_topics(spark):
    """Steps at cosine 0.984 from one centre to the next: the differences point at a neighbouring centroid."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(24, 64))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    path = []
    for a, b in zip(centres, np.roll(centres, -1, axis=0)):
        angle = np.arccos(a @ b)
        steps = int(np.ceil(angle / np.arccos(0.984)))
        path += [(np.sin((1 - t) * angle) * a + np.sin(t * angle) * b) / np.sin(angle)
                 for t in np.arange(steps) / steps]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(path)]
    got = embed_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), centroids=24, block=50).collect()
    check_vectors(rows, got)


def test_rows_without_an_id_and_repeated_ids(spark):
    near, far = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, near, 1), (4, near, 1), (4, far, 1), (9, [1.0, 0.01, 0.0], 1), (None, [0.0, 0.0, 1.0], 1),
            (8, [0.0, 1.0, 0.01], 1), (None, None, 1), (4, far, 2)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        (None, 2, 4, False), (4, 2, 4, True), (9, 2, 4, False), (4, 1, 4, True), (8, 1, 4, False),
        (None, 0, None, True), (None, 0, None, True), (4, 0, 4, True)]))
