from __future__ import annotations

import random
import re

import pytest
import xxhash
from lossmill.llm.components import connected_components
from lossmill.llm.simhash import (
    SimHash,
    fingerprint,
    linked_fingerprints,
    near_duplicate_components,
    spanning_links,
)


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    """Smallest id by fingerprint that links lead to."""
    distinct = sorted(set(prints.values()))
    pairs = [
        (a, b)
        for k, a in enumerate(distinct)
        for b in distinct[:k]
        if (a ^ b).bit_count() <= distance
    ]
    roots = union_find(distinct, pairs)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    return {i: least[roots[p]] for i, p in prints.items()}


def test_fingerprint_by_hand():
    rng = random.Random(5)
    for _ in range(50):
        text = "".join(rng.choices("aB \t\x0bé\x1f\x85", k=rng.randint(0, 60)))
        assert int.from_bytes(fingerprint(text.encode(), SimHash())) == plain_fingerprint(text)
    assert fingerprint(None, SimHash(lanes=2, segments=4)) == bytes(16)


def clustered(rng, n):
    """Numbers of 64 bits, most of them a few bits away from a few others."""
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randint(0, 63)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("dense", [2, 8, 8192])
def test_links_lose_no_component(spark, dense):
    numbers = clustered(random.Random(dense), 400)
    prints = spark.createDataFrame([(x.to_bytes(8),) for x in numbers], "fingerprint binary")
    edges = linked_fingerprints(prints, SimHash(), dense).collect()
    pairs = [(int.from_bytes(r.a), int.from_bytes(r.b)) for r in edges]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    expected = [(a, b) for k, a in enumerate(numbers) for b in numbers[:k] if (a ^ b).bit_count() <= 2]
    assert union_find(numbers, pairs) == union_find(numbers, expected)


def test_spanning_links_are_few():
    members = [x.to_bytes(8) for x in range(256)]
    links = list(spanning_links(members, 2))
    assert len(links) == 255


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(6)
    nodes = list(range(300))
    pairs = [(k, k + 1) for k in range(100)] + [(150, k) for k in range(151, 200)]
    pairs += [(rng.choice(nodes[200:]), rng.choice(nodes[200:])) for _ in range(60)] + [(7, 7)]
    rng.shuffle(pairs)
    got = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    roots = union_find(nodes, pairs)
    linked = {n for p in pairs if p[0] != p[1] for n in p}
    assert sorted(map(tuple, got)) == sorted((n, roots[n]) for n in linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(spark):
    docs = spark.createDataFrame(
        [
            (4, "one two three four", "x"),
            (4, "one two three four", "x"),
            (2, "ONE two\tthree  four", "x"),
            (7, None, None),
            (6, " \n", "x"),
            (None, "alone in here with words", "x"),
            (9, "two", "x"),
            (8, "long " * 100_000, "x"),
        ],
        "doc_id long, text string, fingerprint string",
    )
    got = near_duplicate_components(docs, "doc_id", "text").collect()
    by_id = {r.doc_id: (r.fingerprint, r.component_id) for r in got}
    assert len(got) == 8
    assert by_id[4] == by_id[2]
    assert by_id[4][1] == 2
    assert by_id[7] == by_id[6] == ("0" * 16, 6)
    assert by_id[None][1] is None
    assert by_id[9] == (f"{xxhash.xxh64_intdigest(b'two', 42):016x}", 9)
    assert near_duplicate_components(docs.limit(0), "doc_id", "text").count() == 0


def test_query_against_plain_loops(query, spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    components = plain_components(prints)
    got = query("op4_simhash_near_dedup", sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{prints[i]:016x}", components[i]) for i in texts
    }
    assert len(got) == len(texts)
