import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brookmart.llm import neardup
from brookmart.llm.components import components
from brookmart.llm.fingerprints import fingerprint


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in low.translate({k: " " for k in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, prints, most=4):
    """Least id reachable over links of at most ``most`` bits, by comparing all pairs."""
    prints = np.array(prints, np.uint64)
    label = np.array(ids)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= most
    while True:
        new = np.where(near, label[None, :], label.max()).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


def test_whole_query_against_all_pairs(docs):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    assert [got[r.doc_id].fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [got[r.doc_id].component_id for r in rows] == roots([r.doc_id for r in rows], prints)


@pytest.mark.parametrize("group", [2048, 4])
def test_dense_groups_lose_no_link(spark, group):
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    for center in prints[:4]:
        for _ in range(60):
            flip = 0
            for b in rng.integers(0, 64, int(rng.integers(1, 6))):
                flip |= 1 << int(b)
            prints.append(center ^ flip)
    ids = [int(i) for i in rng.permutation(len(prints))]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fingerprint long")
    got = frame.join(neardup.groups(frame, 4, group), "fingerprint").collect()
    want = dict(zip(ids, roots(ids, prints)))
    assert {r.doc_id: r.component_id for r in got} == want


def test_each_link_has_a_chain():
    rng = np.random.default_rng(5)
    one = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    other = one.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, len(one)).astype(np.uint64)
    a, b = neardup.keys_of(one), neardup.keys_of(other)
    chains = neardup.chain_masks()
    for x, y, p, q in zip(a, b, one, other):
        shared = np.flatnonzero(x == y)
        assert any(len(neardup._near(p, np.array([q]), chains[int(x[k]) >> 30], 4)) for k in shared)


def test_one_of_each_group_stays(odd, none):
    kept = neardup.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    prints = [fingerprint((r.text or "").encode()) for r in rows]
    assert len(set(prints)) == len(rows)
    # null, empty and blank texts are one group; so are equal texts
    assert sorted(r.doc_id for r in rows if not (r.text or "").strip()) == [1]
    assert [r.doc_id for r in rows if r.text == "one"] == [4]
    assert len(rows) == odd.select(F.trim(F.coalesce("text", F.lit("")), F.lit(" \n\t"))).distinct().count()
    assert neardup.deduplicate(none).count() == neardup.near_duplicates(none).count() == 0
    every = neardup.near_duplicates(odd).collect()
    assert len(every) == odd.count()


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (7000, 7000)]
    frame = spark.createDataFrame(edges[::-1], "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert components(frame.limit(0)).count() == 0
