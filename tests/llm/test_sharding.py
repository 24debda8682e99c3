import zlib
from collections import Counter
from hashlib import md5

from casebook.llm import sharding


def jump(doc_id, shards):
    key = int(md5(str("" if doc_id is None else doc_id).encode()).hexdigest()[:15], 16)
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % sharding.MODULUS
        j = (b + 1) * (1 << 31) // ((key >> 33) + 1)
    return b


def test_equals_the_published_loop(docs, texts):
    rows = sharding.shard_documents(docs, 40).collect()
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], 40), jump(r["doc_id"], 41))
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "key")
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_an_appended_shard_takes_rows_only_into_itself(spark, make):
    rows = sharding.shard_documents(make([(i, "t") for i in range(3000)]), 7).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {7} and 3000 / 8 * 0.7 < len(moved) < 3000 / 8 * 1.3
    assert max(Counter(r["shard"] for r in rows).values()) < 3000 / 7 * 1.3


def test_edges(nasty, empty):
    rows = sharding.shard_documents(nasty).collect()
    assert len(rows) == nasty.count() and {r["size"] for r in rows if r["doc_id"] == 1} == {16}
    assert sorted(r["slot"] for r in rows if r["shard"] == jump(5, 40)) == list(range(sum(r["shard"] == jump(5, 40) for r in rows)))
    assert sharding.shard_documents(empty).count() == 0
