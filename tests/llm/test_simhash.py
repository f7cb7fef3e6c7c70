import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loam.llm import simhash
from loam.llm.components import connected_components


def brute_fingerprint(text: str | None, words: int) -> int:
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        found = found.replace(c, " ")
    found = [w for w in found.split(" ") if w]
    shingles = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(values: list[int], radius: int) -> list[int]:
    names = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and names[i] != names[j]:
                low, high = sorted((names[i], names[j]))
                names = [low if n == high else n for n in names]
    return names


@pytest.mark.parametrize("text", ["", " \t\n", "one", "A b c", "a b c d", "Ää  b\vc d e f " * 3, "é" * 5, "x " * 200])
def test_fingerprint(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text.encode(), 4)) == [brute_fingerprint(text, 4)]


def test_fingerprint_of_a_long_text_is_voted_in_parts(monkeypatch):
    hashes = np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64)
    whole = simhash.fingerprint(hashes, 2)
    monkeypatch.setattr(simhash, "VOTE_ROWS", 7)
    assert simhash.fingerprint(hashes, 2) == whole


@pytest.mark.parametrize("radius", [0, 3, 4, 7, 12])
def test_short_runs_against_brute_force(radius):
    rng = np.random.default_rng(radius)
    lengths = np.array([2, 64, 3, 2, 17])
    base = rng.integers(0, 2**63, len(lengths), dtype=np.uint64)
    fps = np.concatenate([b ^ np.array([sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(n)], np.uint64) for b, n in zip(base, lengths, strict=True)])[:, None]
    a, b = simhash.short_run_links(fps, lengths, radius)
    run = np.repeat(np.arange(len(lengths)), lengths)
    expected = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if run[i] == run[j] and int(fps[i, 0] ^ fps[j, 0]).bit_count() <= radius}
    assert {(min(p), max(p)) for p in zip(a.tolist(), b.tolist(), strict=True)} == expected and len(a) == len(expected)


def test_spanning_forest_connects_what_all_links_do():
    rng = np.random.default_rng(5)
    for n, m in ((1, 0), (2, 1), (30, 25), (60, 400)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        names, size = list(range(n)), 0
        for x, y in zip(a, b, strict=True):
            if names[x] != names[y]:
                names, size = [names[x] if z == names[y] else z for z in names], size + 1
        again = list(range(n))
        kept = simhash.spanning_forest(n, a, b)
        for k in kept:
            assert again[a[k]] != again[b[k]]
            again = [again[a[k]] if x == again[b[k]] else x for x in again]
        assert len(kept) == size


@pytest.mark.parametrize("lanes", [1, 2])
def test_long_run_connects_what_brute_force_does(lanes):
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, (3, lanes), dtype=np.uint64)[rng.integers(0, 3, 300)]
    for row in fps:
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            row[k % lanes] ^= np.uint64(1) << np.uint64(k)
    a, b = simhash.long_run_links(fps, 5)
    distance = np.bitwise_count(fps[:, None] ^ fps[None]).sum(2)
    assert (distance[a, b] <= 5).all()
    names = list(range(len(fps)))
    for i, j in zip(a, b, strict=True):
        names = [names[i] if n == names[j] else n for n in names]
    again = brute_classes([int(x[0]) | int(x[-1]) << 64 if lanes > 1 else int(x[0]) for x in fps], 5)
    assert len({(x, y) for x, y in zip(names, again, strict=True)}) == len(set(names)) == len(set(again))


@pytest.mark.parametrize("sizes", [[2, 60, 3], [2, 200, 3, 70]])
def test_links_between_different_kin(sizes):
    rng = np.random.default_rng(7)
    lengths = np.array(sizes)
    fps = np.repeat(rng.integers(0, 2**63, (len(sizes), 2), dtype=np.uint64), lengths, axis=0)
    for row in fps:
        for k in rng.choice(128, rng.integers(0, 12), replace=False):
            row[k // 64] ^= np.uint64(1) << np.uint64(k % 64)
    kin, run = rng.integers(0, 5, len(fps)), np.repeat(np.arange(len(sizes)), lengths)
    near = (np.bitwise_count(fps[:, None] ^ fps[None]).sum(2) <= 9) & (run[:, None] == run[None]) & (kin[:, None] != kin[None])
    a, b = simhash.run_pairs(fps, lengths, 9, kin)
    assert sorted((min(p), max(p)) for p in zip(a.tolist(), b.tolist(), strict=True)) == [(i, j) for i, j in np.argwhere(near).tolist() if i < j]
    names, again = list(range(len(fps))), list(range(len(fps)))
    a, b = simhash.run_links(fps, lengths, 9, kin)
    assert near[a, b].all()
    for i, j in zip(a, b, strict=True):
        assert names[i] != names[j]
        names = [names[i] if n == names[j] else n for n in names]
    for i, j in np.argwhere(near):
        again = [again[i] if n == again[j] else n for n in again]
    assert len(set(zip(names, again, strict=True))) == len(set(names)) == len(set(again))


def test_block_masks_lose_no_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        flip = sum(1 << int(k) for k in rng.choice(64, 4, replace=False))
        for nodes in (0, 10**8, 10**10, 10**12):
            assert any(not flip & m for (m,) in simhash.block_masks(4, nodes))
    assert [len(simhash.block_masks(4, n)) for n in (0, 10**7, 10**8, 10**10)] == [15, 15, 35, 70]


def test_split_buckets_give_the_same_links(spark):
    rng = np.random.default_rng(3)
    values = sorted({int(7 ^ sum(1 << int(k) for k in rng.choice(60, rng.integers(0, 6), replace=False))) for _ in range(120)})
    nodes = spark.createDataFrame([(v, v) for v in values], "node long, f0 long")
    for block_rows in (10, 2048):
        links = simhash.fingerprint_links(nodes, simhash.block_masks(4), 4, block_rows)
        roots = {r.node: r.root for r in connected_components(links).collect()}
        assert [roots.get(v, v) for v in values] == [values[k] for k in brute_classes(values, 4)]


def test_classes_of_odd_rows(spark):
    rows = [(5, "a b c d e"), (3, "A  b\tc d e"), (9, None), (2, ""), (None, "unlike any other text here"), (5, "a b c d e"), (7, "something else entirely said in more words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("fp", "node", "component_id", "id")})
    out = simhash.simhash_classes(docs, words=4)
    assert sorted(((r.id, r.component_id) for r in out.collect()), key=str) == sorted([(5, 3), (3, 3), (5, 3), (9, 2), (2, 2), (None, None), (7, 7)], key=str)
    assert simhash.simhash_classes(docs.limit(0), words=4).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert roots == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 130)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("batch_edges", [20, 1 << 20])
def test_components_in_batches_of_edges(spark, batch_edges):
    rng = np.random.default_rng(5)
    path = rng.permutation(600) - 300
    graphs = [
        (path[:-1], path[1:]),
        (np.full(500, 10**9), np.arange(500)),  # a hub above all, one below
        (np.full(500, -5), np.arange(500)),
        (rng.integers(0, 700, 500), rng.integers(0, 700, 500)),
        (np.array([1, 2, 2, 5]), np.array([1, 3, 3, 5])),
    ]
    for a, b in graphs:
        names = {int(k): int(k) for k in (*a, *b)}
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            low, high = sorted((names[x], names[y]))
            names = {k: low if n == high else n for k, n in names.items()}
        edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), strict=True)), "x long, y long")
        found = [tuple(r) for r in connected_components(edges, batch_edges).collect()]
        assert sorted(found) == sorted((k, n) for k, n in names.items() if k != n)


def test_op1_against_brute_force(spark):
    from loam.llm.queries import op1_simhash

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    values = [brute_fingerprint(d.text, 4) for d in docs]
    expected = {d.doc_id: (f"{v:016x}", docs[c].doc_id) for d, v, c in zip(docs, values, brute_classes(values, 4), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op1_simhash(spark, "/root/testdata/sf0.001").collect()} == expected
