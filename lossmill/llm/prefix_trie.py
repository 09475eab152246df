"""Prefix trie of conversations, found by digests of blocks of turns.

A conversation is cut into blocks of ``block`` turns, the last one shorter. A block's key is a hash
of the key before it and of its turns, so equal keys mean equal beginnings, and one grouping by key
finds the trie at the ends of blocks, whatever its depth. Turn boundaries are refined only inside
blocks where siblings diverge, that is where conversations go on from one key to several: there
every turn gets a key, by the same hash over the turns of the block so far. A block that all
conversations share, or that only one conversation has, stays one group and its nodes are told
apart at the very end.

Sums over subtrees need no walk of the tree. The smallest member of a node owns it, and a
conversation owns all nodes from some depth on. The words before that depth are those it shares
with a smaller conversation; a subtree saves those words of its members, less what lies above it.
A leaf is owned by one member. So both are sums over the members of a node, a second grouping by
the same keys.

Groups are reduced where they are read, so a beginning that very many conversations share arrives
as one row per task. Conversations are streamed in order, with one block in memory.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmill.llm.common import stored

BLOCK_TURNS = 4
KEY_BYTES = 16
_CHUNK_BYTES = 1 << 16
#: What parts words: ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Trie:
    """``nodes``: ``node`` (a name of it), ``parent``, ``depth``, ``conv_id`` (smallest member),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``n_ends``.

    ``ends``: ``node`` and ``conv_id``, the node at which each conversation ends.
    """

    nodes: DataFrame
    ends: DataFrame


def digested(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id``, ``position`` (from 1), ``digest`` and ``words`` of every turn.

    Turns are in the order of ``turn``, null first; of equal ones the lesser digest comes first. A
    null role or text is empty. Rows without a conversation id belong to none and are left out.
    Other columns are not read.
    """
    role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col)
    )
    # With its length before it, a role cannot run into the text.
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(content, 256)), 1, KEY_BYTES).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("position"), "digest", "words"
    )


def conversation_trie(conversations: DataFrame, block: int = BLOCK_TURNS, **columns) -> Trie:
    """The trie of all conversations of a table; ``columns`` as for ``digested``."""
    return prefix_trie(digested(conversations, **columns), block)


def prefix_trie(turns: DataFrame, block: int = BLOCK_TURNS) -> Trie:
    """The trie of ``turns`` as ``digested`` gives them, in the order of ``position``.

    A row with a null digest makes its conversation known without a turn; a conversation of such
    rows alone is a member of the root only. Positions are unique within a conversation. Without
    any conversation there are no nodes.
    """
    blocks = stored(_blocks(turns, block), "trie-blocks")
    members = stored(_members(blocks), "trie-members")
    same = ["key", "parent", "depth", "before", "words"]
    groups = members.groupBy(*same).agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("conv_id"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"),
    )
    groups = stored(groups, "trie-groups")
    owned = groups.groupBy("conv_id").agg(
        F.min("before").alias("shared"),
        F.max((F.col("n") == F.col("n_ends")).cast("long")).alias("leaf"),
    )
    total = F.col("before") + _sum(F.col("words"))
    each = blocks.where("last").select("conv_id", total.alias("total")).join(owned, "conv_id", "left")
    each = each.select(
        "conv_id",
        F.coalesce("shared", "total").alias("shared"),
        F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"),
    )
    each = stored(each, "trie-conversations")
    sums = members.select("key", "conv_id").join(each, "conv_id").groupBy("key")
    sums = sums.agg(F.sum("shared").alias("shared"), F.sum("leaf").alias("leaves"))
    ends = members.where("ends").select(_name("key").alias("node"), "conv_id")
    turnless = blocks.where("parent is null").select(_name("key").alias("node"), "conv_id")
    least = each.agg(F.min("conv_id")).first()[0]
    nodes = _nodes(groups, sums, owned.select("conv_id", F.col("shared").alias("own")), least)
    nodes = nodes.unionByName(_root(each, groups, turnless))
    return Trie(nodes, ends.unionByName(turnless))


def _key(before: bytes, turns: bytes) -> bytes:
    return hashlib.blake2b(before + turns, digest_size=KEY_BYTES).digest()


_ROOT = _key(b"", b"")


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """One row per block: key, key before it (``parent``), turns (``depth``) and words before it,
    its turns' digests and words, whether it is the conversation's last; the two halves of the key
    as numbers. A conversation without turns has the root as key and no parent."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, parent binary, key binary, depth long, before long, digests binary, "
        "words array<long>, last boolean, one long, two long"
    )
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "position")

    def cut(tables):
        nobody = object()
        conv, rows = nobody, []
        parent, depth, before, digests, words = _ROOT, 0, 0, [], []

        def end_block(last: bool) -> None:
            nonlocal parent, depth, before, digests, words
            joined = b"".join(digests)
            known = bool(digests)
            key = _key(parent, joined) if known else _ROOT
            halves = [int.from_bytes(key[k : k + 8], "big", signed=True) for k in (0, 8)]
            rows.append(
                (conv, parent if known else None, key, depth, before, joined, words, last, *halves)
            )
            parent, depth, before = key, depth + len(digests), before + sum(words)
            digests, words = [], []

        for t in tables:
            columns = (t.column(k).to_pylist() for k in range(3))
            for one, digest, n_words in zip(*columns):
                if one != conv:
                    if conv is not nobody:
                        end_block(last=True)
                    conv, parent, depth, before = one, _ROOT, 0, 0
                if digest is None:
                    continue
                if len(digests) == block:
                    end_block(last=False)
                digests.append(digest)
                words.append(n_words)
            if rows:
                yield _block_batch(rows, t.schema.field(0).type)
                rows.clear()
        if conv is not nobody:
            end_block(last=True)
            yield _block_batch(rows, t.schema.field(0).type)

    return ordered.select("conv_id", "digest", "words").mapInArrow(cut, schema)


def _block_batch(rows: list, id_kind: pa.DataType) -> pa.RecordBatch:
    kinds = {
        "conv_id": id_kind, "parent": pa.binary(), "key": pa.binary(), "depth": pa.int64(),
        "before": pa.int64(), "digests": pa.binary(), "words": pa.list_(pa.int64()),
        "last": pa.bool_(), "one": pa.int64(), "two": pa.int64(),
    }
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())]
    return pa.RecordBatch.from_arrays(columns, list(kinds))


def _members(blocks: DataFrame) -> DataFrame:
    """Conversations under the keys they belong to: one row per turn of a block whose siblings
    diverge, one row for any other block."""
    halves = ("one", "two")
    bounds = [f(c).alias(f"{name}_{c}") for c in halves for f, name in ((F.min, "lo"), (F.max, "hi"))]
    diverges = (F.col("lo_one") != F.col("hi_one")) | (F.col("lo_two") != F.col("hi_two"))
    # All first blocks have the root before them: one row decides for them, without a join.
    first = blocks.where("parent is not null and depth = 0").agg(*bounds).where(diverges)
    from_root = not first.isEmpty()
    deeper = blocks.where("depth > 0")
    several = deeper.groupBy("parent").agg(*bounds).where(diverges)
    deeper = deeper.join(several.select("parent", F.lit(True).alias("split")), "parent", "left")
    first = blocks.where("parent is not null and depth = 0").withColumn("split", F.lit(from_root))
    rows = deeper.unionByName(first)

    @F.arrow_udf("array<binary>")
    def turn_keys(parents: pa.Array, digests: pa.Array) -> pa.Array:
        found = []
        for before, turns in zip(parents.to_pylist(), digests.to_pylist()):
            ends = range(KEY_BYTES, len(turns or b"") + 1, KEY_BYTES)
            found.append([_key(before, turns[:k]) for k in ends])
        return pa.array(found, pa.list_(pa.binary()))

    rows = rows.withColumn("keys", turn_keys("parent", F.when(F.col("split"), F.col("digests"))))
    each_turn = F.expr(
        """transform(keys, (k, j) -> named_struct(
            'key', k, 'parent', coalesce(get(keys, j - 1), parent), 'depth', depth + j,
            'before', before + aggregate(slice(words, 1, j), 0L, (a, w) -> a + w),
            'words', slice(words, j + 1, 1), 'ends', last and j = size(keys) - 1))"""
    )
    whole = F.array(
        F.struct("key", "parent", "depth", "before", "words", F.col("last").alias("ends"))
    )
    parts = F.when(F.size("keys") > 0, each_turn).otherwise(whole)
    return rows.select("conv_id", F.inline(parts))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _name(key: Column, above: Column | None = None) -> Column:
    """A node's name: its key, or the key some turns further down."""
    own = F.lower(F.hex(key))
    return own if above is None else F.concat(own, F.lit("-"), above.cast("string"))


def _nodes(groups: DataFrame, sums: DataFrame, owned: DataFrame, least) -> DataFrame:
    """A row for every node but the root, whose smallest member is ``least``."""
    children = groups.groupBy("parent").agg(F.count("*").alias("children"))
    children = children.withColumnRenamed("parent", "key")
    top = groups.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    known = groups.join(sums, "key").join(owned, "conv_id").join(children, "key", "left")
    first = F.col("parent") == F.lit(_ROOT)
    at_root = known.where(first).withColumn("above", F.lit(least).cast(top.schema["above"].dataType))
    known = at_root.unionByName(known.where(~first).join(top, "parent"))
    rows = known.select("*", F.posexplode("words").alias("j", "w"))
    left = F.size("words") - 1 - F.col("j")
    starts, ends = F.col("j") == 0, left == 0
    before = F.col("before") + _sum(F.slice("words", 1, F.col("j")))
    return rows.select(
        F.when(ends, _name("key")).otherwise(_name("key", left)).alias("node"),
        F.when(starts, _name("parent")).otherwise(_name("key", left + 1)).alias("parent"),
        (F.col("depth") + F.col("j") + 1).alias("depth"),
        "conv_id",
        F.when(starts, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(ends, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("shared") - F.col("own") - (F.col("n") - 1) * before).alias("saved_tokens"),
        F.when(ends, F.col("n_ends")).otherwise(0).cast("long").alias("n_ends"),
    )


def _root(each: DataFrame, groups: DataFrame, turnless: DataFrame) -> DataFrame:
    """The root's row; none without a conversation."""
    sums = each.agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.sum("leaf").alias("leaves"),
        F.sum("shared").alias("saved_tokens"),
    ).where("n_convs > 0")
    children = groups.where(F.col("parent") == F.lit(_ROOT)).count()
    n_ends = turnless.count()
    return sums.select(
        _name(F.lit(_ROOT)).alias("node"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("depth"),
        "conv_id",
        F.lit(None).cast(each.schema["conv_id"].dataType).alias("parent_conv_id"),
        "n_convs",
        F.lit(children).cast("long").alias("n_children"),
        F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.lit(n_ends).cast("long").alias("n_ends"),
    )


def with_ends_sha256(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``: SHA-256, in lower-case hex, of the ids of the conversations
    that end there, ascending and joined by commas; of nothing where none ends.

    A hash reads its input in order, but the ids of a crowded node are sorted and joined by many
    tasks; one task only hashes the pieces of text that they made of it.
    """
    n = int(trie.ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_kind = trie.ends.schema["conv_id"].dataType.simpleString()
    rows = trie.ends.select("node", "conv_id", F.col("conv_id").cast("string").alias("id"))
    rows = rows.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = rows.mapInArrow(_joined, f"node string, first {id_kind}, ids string")
    pieces = pieces.repartition(n, "node").sortWithinPartitions("node", "first")
    hashed = pieces.select("node", "ids").mapInArrow(_hashed, "node string, ends_sha256 string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    found = trie.nodes.join(hashed, "node", "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))


def _joined(tables):
    node, first, ids, size = None, None, [], 0
    kind = None

    def batch() -> pa.RecordBatch:
        columns = [pa.array([node]), pa.array([first], kind), pa.array([",".join(ids)])]
        return pa.RecordBatch.from_arrays(columns, ["node", "first", "ids"])

    for t in tables:
        kind = t.schema.field(1).type
        for one, conv, text in zip(*(c.to_pylist() for c in t.columns)):
            if one != node or size >= _CHUNK_BYTES:
                if ids:
                    yield batch()
                node, first, ids, size = one, conv, [], 0
            ids.append(text)
            size += len(text) + 1
    if ids:
        yield batch()


def _hashed(tables):
    node, state = None, None
    nodes, found = [], []
    for t in tables:
        for one, ids in zip(*(c.to_pylist() for c in t.columns)):
            if one != node:
                if state:
                    nodes.append(node)
                    found.append(state.hexdigest())
                node, state = one, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(found)], ["node", "ends_sha256"])
            nodes, found = [], []
    if state:
        last = [pa.array([node]), pa.array([state.hexdigest()])]
        yield pa.RecordBatch.from_arrays(last, ["node", "ends_sha256"])
