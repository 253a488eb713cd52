"""Mixing, whitening and the Merkle manifest against brute force and the linear algebra of numpy."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mostrador.llm import feast, merkle, mixing, queries, whitening

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# --- mixing ---------------------------------------------------------------------------------
def _filled(sizes, weights, share=1.5):
    """Targets by resharing the excess until no source is above its limit."""
    target, open_ = {}, dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), np.resize(weights, len(sizes))))
    left = share * sum(sizes.values())
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total > 2 * sizes[s]]
        if not over:
            return {**target, **{s: left * w / total for s, w in open_.items()}}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


ROWS = [
    *[(i, " ".join(["w"] * (1 + i * i % 37)), "en", "hot", 0) for i in range(400)],
    *[(1000 + i, "a\x0bb c " * (i % 4), "de", ("b", "c", None, "")[i % 4], None) for i in range(120)],
    (None, None, None, None, None),
    (5000, None, None, "only null", None),
    (5001, "long " * 30_000, None, "one long", None),
    *[(7, "same row twice", "en", "c", 3)] * 2,
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(5)


def test_targets_and_what_is_taken(rows):
    found = mixing.mix(rows).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r[0]) for r in ROWS)
    sizes, taken, target, longest = {}, {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert r.taken == r.copies * r.size and r.copies <= 2
    assert {r.source: r.source_size for r in found} == sizes
    assert target == pytest.approx(_filled(sizes, [3, 1, 2]), rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2, s
    assert abs(taken["hot"] - target["hot"]) <= 4


def test_words_are_counted_over_whole_texts(rows):
    sizes = {r.doc_id: r["size"] for r in mixing.mix(rows).collect()}
    assert sizes[5001] == 30_000 and sizes[None] == 0 and sizes[5000] == 0
    assert sizes[1003] == 6  # a vertical tab parts words, a no-break space does not


def test_reruns_agree_and_every_copy_is_there(rows):
    plan = {(r.doc_id, r.copies) for r in mixing.mix(rows).collect()}
    assert plan == {(r.doc_id, r.copies) for r in mixing.mix(rows.repartition(3)).collect()}
    clashing = rows.withColumns({c: F.lit("x") for c in ("key", "size", "cuts", "copies", "doc", "passes")})
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    counts = {r.doc_id: r["count"] for r in mixed.where("doc_id <> 7").groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in plan if n and d not in (None, 7)}


def test_empty_mixes(spark, rows):
    assert mixing.mix(rows.limit(0)).count() == 0 and mixing.mixed_documents(rows.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, " ", None, None, None)], DOCS)
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_mixing_stays_inside_the_jvm(rows):
    plan = mixing.mix(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- eigenpairs and whitening ----------------------------------------------------------------
def _spectrum(values, seed=3):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


CASES = {
    "random": _spectrum(np.random.default_rng(1).random(60)),
    "cluster at the last wanted": _spectrum([9.0] * 3 + [5.0] * 20 + [1.0] * 9),
    "all equal": np.eye(20) * 3,
    "hardly apart": _spectrum(np.r_[50 + 1e-9 * np.arange(20), np.ones(12)]),
    "of low rank": _spectrum([4.0, 3.0, 2.0] + [0.0] * 17),
    "graded": _spectrum(10.0 ** -np.arange(12)),
    "one": np.array([[2.0]]),
    "negative ones": _spectrum([3.0, 1.0, -2.0, -5.0]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_eigenpairs_of_slices(name):
    matrix = CASES[name]
    diagonal, off = feast.tridiagonal(matrix)
    known = np.linalg.eigvalsh(matrix)[::-1]
    scale = abs(known).max()
    parts = feast.slices(diagonal, off, 10)
    for part in parts:
        assert part.count == ((known > part.low) & (known < part.high)).sum()
    pairs = [feast.solve_slice(matrix, p) for p in parts]
    values = np.concatenate([v for v, _ in pairs])
    assert len(values) >= min(10, (known > 1e-12 * scale).sum())
    assert np.allclose(np.sort(values)[::-1], known[: len(values)], atol=1e-13 * scale)
    for v, vectors in pairs:
        assert np.allclose(matrix @ vectors, vectors * v, atol=1e-12 * scale)
        assert np.allclose(vectors.T @ vectors, np.eye(len(v)), atol=1e-12)


@pytest.mark.parametrize("spread", [1e-1, 1e-2, 1e-4, 1e-6])
@pytest.mark.parametrize("apart", [[], [93.0], [104.0, 93.0, 92.9], [64.3] * 10])
def test_eigenpairs_of_a_dense_spectrum(apart, spread):
    """Many vectors without a preferred direction: nearly equal eigenvalues, and a few that stand out far above them."""
    r = np.random.default_rng(7)
    for seed in range(4):
        matrix = _spectrum(np.r_[apart, 64 + spread * r.standard_normal(64 - len(apart))], seed)
        known = np.linalg.eigvalsh(matrix)[::-1]
        parts = feast.slices(*feast.tridiagonal(matrix), 32)
        assert all(p.count == ((known > p.low) & (known < p.high)).sum() for p in parts)
        values = np.concatenate([feast.solve_slice(matrix, p)[0] for p in parts])
        assert len(values) >= 32 and np.allclose(np.sort(values)[::-1], known[: len(values)], atol=1e-11)


def test_no_slices_without_positive_eigenvalues():
    assert feast.slices(*feast.tridiagonal(np.zeros((4, 4))), 3) == []
    assert feast.slices(*feast.tridiagonal(-np.eye(3)), 3) == []


def test_whitened_vectors_equal_those_of_numpy(spark):
    r = np.random.default_rng(5)
    data = r.standard_normal((300, 6)) @ r.standard_normal((6, 6))
    rows = [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(data)]
    rows += [(900, None, 1), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (902, [float("nan")] * 6, 1), (903, [float("-inf")] * 6, 1), (904, [1.0], 1), (905, [], 1)]
    rows += [(None, rows[0][1], 2), rows[1]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, x int").repartition(4)
    found = whitening.components(whitening.quantised(vectors), 4).toPandas()
    kept = [v for v in rows if v[0] is None or v[0] < 900]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v[1]] for v in kept])
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    want = c @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    assert len(found) == 4 * n and (found["n"] == n).all() and found["identity_error"].max() < 1e-9
    for k in range(4):
        mine = found[found["component"] == k + 1]
        assert np.allclose(np.sort(abs(mine["whitened"])), np.sort(abs(want[:, k])), atol=1e-9)
        assert mine["explained"].iloc[0] == pytest.approx(values[::-1][k] / values.sum(), rel=1e-12)
    deviation = {v[0]: int(d) for v, d in zip(kept, ((n * x - sums) ** 2).sum(axis=1))}
    assert all(d == deviation[None if i != i else int(i)] for i, d in zip(found["vec_id"], found["deviation"]))


def test_vectors_without_spread_have_no_components(spark):
    kind = "vec_id bigint, embedding array<float>"
    for data in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert whitening.components(whitening.quantised(spark.createDataFrame(data, kind))).count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0, 7.0]), (2, [1.0, 2.0, 7.0])], kind)
    assert sorted(abs(r.whitened) for r in whitening.components(whitening.quantised(two)).collect()) == pytest.approx([1.0, 1.0])


def test_deviations_beyond_64_bits_are_refused():
    x = np.array([[2**40, 0], [0, 0]])
    with pytest.raises(OverflowError):
        whitening.deviations(x, 2, x.sum(axis=0))
    near = np.array([[2**30, 0], [0, 0]])
    assert whitening.deviations(near, 2, near.sum(axis=0)).tolist() == [2**60, 2**60]


# --- Merkle manifest ----------------------------------------------------------------------------
def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_hash(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def _path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append((level[first:i], level[i + 1 : first + 8]))
        i //= 8
    return out


def _brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        members = sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
        trees[k] = (members, _tree([_leaf(r, r[1]) for r in members]))
    top, out = _tree([trees[k][1][-1][0] for k in keys]), []
    for at, k in enumerate(keys):
        members, levels = trees[k]
        for i, row in enumerate(members):
            path = _path(levels, i) + _path(top, at)
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = _leaf(row, text)
            for before, after in path:
                folded = _hash(*before, folded, *after)
            proof = "".join("".join(b) + "".join(a) for b, a in path)
            out.append((row[0], levels[0][i], levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


LEAVES = [
    *[(i * 3, f"Text Nº {i}", "en", "s", i) for i in range(600)],
    *[(i, "ÄBC", "ünï", None, None) for i in range(9)],
    *[(i, None, f"lang{i}", "x", 1) for i in range(11)],
    *[(5, "A twin", "de", "s", 2)] * 3,
    (5, "another of that id", "de", "s", 2),
    (None, "No id", "de", "s", 2),
    (None, None, None, None, None),
    (1, "", "", "", 0),
    (2, "LONG " * 40_000, "", "", 0),
]


@pytest.fixture(scope="module")
def small_blocks():
    """Two levels to a block, so that a few hundred leaves take several blocks and rounds."""
    before, merkle.BLOCK_LEVELS = merkle.BLOCK_LEVELS, 2
    yield
    merkle.BLOCK_LEVELS = before


def test_proofs_equal_those_of_the_whole_tree(spark, small_blocks):
    docs = spark.createDataFrame(LEAVES, DOCS).withColumns({c: F.lit(1) for c in ("key", "pos", "leaf", "root")}).repartition(6)
    found = merkle.proofs(merkle.manifest(docs, tampered=queries.lower_cased)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(_brute(LEAVES), key=str)


def test_any_subset_is_proved_with_fewer_nodes(spark, small_blocks):
    tree = merkle.manifest(spark.createDataFrame(LEAVES, DOCS).repartition(3))
    chosen = tree.leaves.where("doc_id in (3, 6, 1500) and key = 'sen'")
    found = {tuple(r) for r in merkle.proofs(tree, chosen).collect()}
    assert found == {r[:5] + (r[3], True) for r in _brute(LEAVES) if r[0] in (3, 6, 1500) and r[1] in {f[1] for f in found}} and len(found) == 3
    needs = merkle._needs(chosen.withColumn("block", F.shiftright("pos", 6)))
    lower = needs.where("not top").count()
    # Leaves 1 and 2 share a run: their union is fetched, less than both proofs together.
    assert lower == sum(len(m) for m in merkle.missing_nodes(np.array([1, 2]), 600)) + sum(len(m) for m in merkle.missing_nodes(np.array([500]), 600))
    assert len(merkle.missing_nodes(np.array([1, 2]), 600)[0]) == 6


def test_missing_nodes_of_whole_and_ragged_trees():
    assert [m.tolist() for m in merkle.missing_nodes(np.arange(9), 9)] == [[], []]
    assert [m.tolist() for m in merkle.missing_nodes(np.array([8]), 9)] == [[], [0]]
    assert merkle.missing_nodes(np.array([0]), 1) == []


def test_small_manifests(spark):
    empty = spark.createDataFrame([], DOCS)
    assert merkle.proofs(merkle.manifest(empty)).count() == 0
    one = [(1, "Ab", "en", "s", 2)]
    found = merkle.proof_digests(merkle.manifest(spark.createDataFrame(one, DOCS), tampered=queries.lower_cased)).first()
    leaf = _leaf(one[0], "Ab")
    assert (found.leaf, found.subroot, found.root, found.proof_sha256) == (leaf, leaf, leaf, _hash())


def test_registered_query_on_a_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = sorted(map(tuple, queries.op13_merkle(spark, folder).collect()))
    assert found == sorted((*r[:4], _hash(r[4]), *r[5:]) for r in _brute(rows))
