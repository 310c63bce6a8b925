"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash

from lakeloader.llm import simhash as S

from llm_cases import awkward, rows_of


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(bits, limit):
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= limit:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(bits))]


def expected(rows):
    bits = [plain_fingerprint(row[1]) for row in rows]
    found = classes(bits, 4)
    ids = {}
    for row, part in zip(rows, found):
        ids.setdefault(part, []).append(row[0])
    least = {part: min((x for x in held if x is not None), default=None) for part, held in ids.items()}
    return sorted(((row[0], f"{b:016x}", least[part]) for row, b, part in zip(rows, bits, found)), key=repr)


def test_awkward_rows(documents):
    assert rows_of(S.near_duplicates(documents)) == expected(awkward())


def test_empty_table(no_documents):
    assert S.near_duplicates(no_documents).count() == 0


def test_keeping_one_of_each_group(documents):
    kept = S.keep_one(documents)
    assert kept.columns == documents.columns
    rows = awkward()
    parts = classes([plain_fingerprint(row[1]) for row in rows], 4)
    ids = {}
    for row, part in zip(rows, parts):
        ids.setdefault(part, []).append(row[0])
    wanted = [min((x for x in held if x is not None), default=None) for held in ids.values()]
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == sorted(wanted, key=repr)


def test_rows_that_share_an_id_or_have_none(spark):
    """One row of each component, whatever the ids."""
    far = [" ".join(f"w{i}{j}" for j in range(40)) for i in range(4)]
    rows = [(None, far[0], 1), (None, far[0], 2), (None, far[1], 3), (5, far[2], 4), (5, far[2], 4), (5, far[3], 5), (6, far[3], 6)]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string, rows int")).collect()
    assert sorted((row.doc_id or 0, row.text) for row in kept) == sorted([(0, far[0]), (0, far[1]), (5, far[2]), (5, far[3])])


def random_bits(seed, groups, copies):
    draw = np.random.default_rng(seed)
    made = []
    for _ in range(groups):
        base = int(draw.integers(0, 1 << 63))
        for _ in range(copies):
            made.append(base ^ sum(1 << int(x) for x in draw.choice(64, draw.integers(0, 5), replace=False)))
    return made


@pytest.mark.parametrize("block, bundle, groups", [(8192, 30_000, None), (8, 50, 5), (8192, 400, 7), (4, 50, 8)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, block, bundle, groups):
    """With tiny blocks every crowded cell is compared in pairs of blocks."""
    monkeypatch.setattr(S, "BUNDLE", bundle)
    bits = sorted(set(random_bits(3, 40, 12)))
    signed = np.array(bits, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "bits long")
    found = {row.u: row.v for row in S.components(S.links(nodes, 4, block, groups)).collect()}
    parts, wanted = {}, {}
    for x, part in zip(signed, classes(bits, 4)):
        wanted.setdefault(part, set()).add(x)
        parts.setdefault(found.get(x, x), set()).add(x)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, wanted.values()))


def test_the_embedding_is_a_lower_bound():
    draw = np.random.default_rng(1)
    a, b = (draw.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(2))
    b[:2500] = a[:2500] ^ (np.uint64(1) << draw.integers(0, 63, 2500).astype(np.uint64))
    count = lambda x: np.stack([np.bitwise_count((x >> np.uint64(2 * i)) & np.uint64(3)).astype(int) for i in range(32)])
    manhattan = np.abs(count(a) - count(b)).sum(axis=0)
    assert (np.bitwise_count(S.embed(a) ^ S.embed(b)) == manhattan).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 100), (100, 200)], "u long, v long")
    assert rows_of(S.components(edges)) == sorted([(i, 0) for i in range(1, 61)] + [(200, 100)], key=repr)


@pytest.mark.parametrize("groups", [5, 6, 7, 9, 12])
def test_any_two_within_the_limit_share_a_cell(groups):
    draw = np.random.default_rng(groups)
    a = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << draw.integers(0, 64, 3000).astype(np.uint64)
    masks = S.grids(4, groups)
    met = ((S.embed(a)[:, None] & masks) == (S.embed(b)[:, None] & masks)).any(axis=1)
    assert met.all()


def test_work_per_fingerprint_does_not_grow():
    """Unrelated fingerprints that meet one in a cell: counted in a sample of pairs, carried on to all fingerprints."""
    draw = np.random.default_rng(5)
    pairs = 400_000
    a, b = (S.embed(draw.integers(0, 1 << 64, pairs, dtype=np.uint64)) for _ in range(2))
    for nodes in (10**5, 10**6, 10**7):
        masks = S.grids(4, S.group_count(nodes, 4))
        met = sum(int(((a & mask) == (b & mask)).sum()) for mask in masks)
        assert nodes * met / pairs < 2 * S.COMPARED
    assert [S.group_count(10**n, 4) for n in (5, 6, 7, 9)] == [5, 6, 7, 9]
