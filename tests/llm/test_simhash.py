import random

import numpy as np
from xxhash import xxh64_intdigest

from casebook.llm import components, simhash


def brute(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace(
        "\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(items, linked):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def test_equals_brute_force(docs, texts):
    fps = {d: brute(t) for d, t in texts.items()}
    ids = sorted(fps)
    want = union(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    got = simhash.near_duplicate_rows(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and any(want[i] != i for i in ids)
    assert all(r["fingerprint"] == f"{fps[r['doc_id']]:016x}" for r in got)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_reach_all_fingerprints_within_two_bits(spark):
    """Long chains and a dense ball of near fingerprints, against all pairs."""
    rnd = random.Random(2)
    values = {rnd.getrandbits(64) for _ in range(150)}
    for _ in range(8):
        x = rnd.getrandbits(64)
        for _ in range(25):
            values.add(x)
            x ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
    ball = rnd.getrandbits(64)
    values |= {ball ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(200)} | {0, (1 << 64) - 1, 1, 1 << 63}
    items = sorted(map(signed, values))
    mask = (1 << 64) - 1
    want = union(items, [(a, b) for i, a in enumerate(items) for b in items[i + 1:] if ((a ^ b) & mask).bit_count() <= 2])
    table = spark.createDataFrame([(v,) for v in items], "fp long")
    found = {r["node"]: r["root"] for r in components.components(simhash.links(table)).collect()}
    assert {i: found.get(i, i) for i in items} == want


def test_cells_are_the_vectors_within_one():
    rnd = random.Random(4)
    values = [0, (1 << 64) - 1, 0x1111111111111111, *(rnd.getrandbits(64) for _ in range(20))]
    pairs = lambda v: [(v >> 2 * s & 3).bit_count() for s in range(32)]
    unpack = lambda c: tuple(c >> 2 * s & 3 for s in range(32))
    with np.errstate(over="ignore"):
        row, cell = simhash.cells(np.array(values, dtype=np.uint64))
    for i, v in enumerate(values):
        base = pairs(v)
        want = {tuple(base)}
        for s in range(32):
            want |= {tuple(base[:s] + [base[s] + d] + base[s + 1:]) for d in (1, -1) if 0 <= base[s] + d <= 2}
        got = [unpack(int(c)) for r, c in zip(row, cell) if r == i]
        assert len(got) == len(want) and set(got) == want


def test_components_of_loops_and_repeats(spark):
    edges = spark.createDataFrame([(1, 1), (3, 2), (2, 3), (5, 4), (4, 3), (9, 8)], "a long, b long")
    assert {r["node"]: r["root"] for r in components.components(edges).collect()} == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8}
    assert components.components(edges.limit(0)).count() == 0


def test_hot_group(make):
    got = simhash.near_duplicate_rows(make([(i, "one and the same text of a few words") for i in range(2500)] + [(9000, "something else entirely here")]))
    assert {r["component_id"]: r["count"] for r in got.groupBy("component_id").count().collect()} == {0: 2500, 9000: 1}


def test_edges(nasty, empty):
    got = simhash.near_duplicate_rows(nasty).collect()
    assert len(got) == nasty.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == "0" * 16 and by[1]["component_id"] == by[3]["component_id"] == 1
    assert by[6]["component_id"] == 5 and simhash.near_duplicate_rows(empty).count() == 0
