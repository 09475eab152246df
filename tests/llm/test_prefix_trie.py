from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from lossmill.llm.prefix_trie import conversation_trie, with_ends_sha256

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def plain(conversations: dict):
    """Rows of the nodes, from lists of (role, text) per conversation."""
    members = defaultdict(list)
    for c in sorted(conversations):
        for d in range(len(conversations[c]) + 1):
            members[tuple(conversations[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        found = [path]
        for one in found:
            found += children[one]
        return found

    rows = []
    for path, some in members.items():
        tree = below(path)
        saved = sum(
            (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in tree if p
        )
        ends = ",".join(str(c) for c in some if len(conversations[c]) == len(path))
        rows.append(
            (
                some[0], len(path), members[path[:-1]][0] if path else None, len(some),
                len(children[path]), sum(not children[p] for p in tree), saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=repr)


def found(spark, conversations: dict, **options):
    rows = [
        (c, k, role, text, "x")
        for c, turns in conversations.items()
        for k, (role, text) in enumerate(turns)
    ]
    random.Random(1).shuffle(rows)
    schema = "conv_id long, turn long, role string, text string, words string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    nodes = with_ends_sha256(conversation_trie(df, **options))
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("block", [1, 2, 4])
def test_random_conversations_against_a_walk(spark, block):
    rng = random.Random(block)
    conversations = {}
    for c in range(60):
        start = conversations[rng.choice(list(conversations))] if c and rng.random() < 0.8 else []
        turns = list(start[: rng.randint(0, len(start))])
        while len(turns) < 1 or rng.random() < 0.7:
            turns.append((rng.choice("ua"), " ".join(rng.choices("xyz", k=rng.randint(0, 3)))))
        conversations[c * 7 % 61] = turns
    assert found(spark, conversations, block=block) == plain(conversations)


def test_copies_and_one_very_long_conversation(spark):
    same = [("user", "a b"), ("assistant", "c")]
    conversations = {c: same for c in range(400)}
    conversations |= {1000 + c: [*same, ("user", f"d {c} e")] for c in range(5)}
    conversations[-3] = [("user", f"turn {k}") for k in range(999)]
    assert found(spark, conversations) == plain(conversations)


def test_nulls_ties_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (1, None, None, None), (1, 2, "user", "x"), (2, 5, "", ""), (2, 9, "user", "x"),
        (None, 1, "user", "lost"), (3, 1, "a", "b"), (3, 1, "a", "b"), (4, 1, "ab", ""), (5, 1, "", "ab"),
    ]
    nodes = with_ends_sha256(conversation_trie(spark.createDataFrame(rows, schema)))
    got = sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)
    empty = ("", "")
    assert got == plain(
        {
            1: [empty, ("user", "x")], 2: [empty, ("user", "x")], 3: [("a", "b"), ("a", "b")],
            4: [("ab", "")], 5: [("", "ab")],
        }
    )
    none = spark.createDataFrame([], schema)
    assert with_ends_sha256(conversation_trie(none)).count() == 0


def test_names_lead_from_parent_to_child(spark):
    turns = [("u", str(k)) for k in range(11)]
    rows = [(c, k, *t) for c in (1, 2) for k, t in enumerate(turns[: 11 - 5 * (c == 2)])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    trie = conversation_trie(df)
    by_name = {r.node: r for r in trie.nodes.collect()}
    assert len(by_name) == 12
    for r in by_name.values():
        assert (r.depth == 0) == (r.parent is None)
        assert r.parent is None or by_name[r.parent].depth == r.depth - 1
    ends = {r.conv_id: by_name[r.node].depth for r in trie.ends.collect()}
    assert ends == {1: 11, 2: 6}


def test_nodes_above_shared_blocks_are_not_refined(spark):
    """A block that all conversations share stays one group."""
    from lossmill.llm import prefix_trie

    shared = [("u", str(k)) for k in range(8)]
    rows = [(c, k, *t) for c in range(50) for k, t in enumerate([*shared, ("u", f"own {c}")])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = prefix_trie._blocks(prefix_trie.digested(df), 4)
    members = prefix_trie._members(blocks)
    assert members.where("depth < 8").count() == 100
    assert members.where("depth < 8").select("key").distinct().count() == 2
