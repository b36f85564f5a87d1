"""All shared prefixes of conversations as a trie: positional turn-id columns, ROLLUP over them, block by block.

A turn's id is the SHA-256 of its role and text, followed by its count of words, so two turns are one exactly when
role and text are equal. The first eight turns of every conversation are columns ``t1..t8``; one
``GROUP BY ROLLUP`` aggregates every prefix at once, ``grouping_id`` tells its depth. Conversations that go on
and share their node with others continue in the next block of columns, grouped by that node as well.
A conversation alone in its node is a chain from there on and needs no further aggregation, so the number of
blocks follows the longest shared prefix, not the longest conversation.

A second ROLLUP over the nodes, from the last block to the first, sums up each subtree. A hot prefix is combined
before the shuffle in both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import cell, map_batches, materialise
from zoneflow.operators.places import with_places

# Columns of the first block and of those after it.
WIDTHS = (8, 16, 32)
# Bytes of a turn id: SHA-256 and a count of words.
ID_BYTES = 32 + 8
# Text of ids of conversations that one row holds while a node's digest spans several tasks.
CHUNK_BYTES = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_ids(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, id``: the turns of every conversation in order, from 0, without their texts.

    Null turns come first, null role or text counts as empty, rows without a conversation are left out. Rows with the
    same turn are ordered by the digest of role and text.
    """
    blank = lambda name: F.coalesce(cell(name).cast("string"), F.lit(""))
    said = F.concat(F.length(blank(role)).cast("string"), F.lit(":"), blank(role), blank(text))
    words = F.regexp_count(blank(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = conversations.filter(cell(conv).isNotNull()).select(
        cell(conv).cast("long").alias("conv_id"),
        cell(turn).cast("long").alias("turn"),
        F.concat(F.unhex(F.sha2(said.cast("binary"), 256)), F.unhex(F.lpad(F.hex(words), 16, "0"))).alias("id"),
    )
    return with_places(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "id"], "pos").select("conv_id", "pos", "id")


def rebuilt_heads(turns: DataFrame, modulus: int = 20, heads: int = 4, width: int = WIDTHS[0]) -> DataFrame:
    """``conv_id, shift, len, first``: every conversation after its head is taken from the first of its twenty.

    Its first ``h = crc32(conv_id) % heads`` turns are replaced by those of conversation ``conv_id - conv_id % modulus``
    (as many as there are; ``%`` has the sign of the id, as in SQL). ``first`` holds the ids of the first ``width`` rebuilt turns; an own turn from ``h`` on
    stands ``shift`` places further on than before.
    """
    own = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("pos") < width + heads, F.struct("pos", "id")))).alias("own"),
    )
    own = materialise(
        own.select(
            "conv_id", "n", F.transform("own", lambda x: x["id"]).alias("own"), (F.col("conv_id") - F.col("conv_id") % modulus).alias("base"),
            (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"),
        )
    )
    base = own.filter(F.col("conv_id") == F.col("base")).select("base", F.slice("own", 1, heads - 1).alias("head"))
    none = F.array().cast("array<binary>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    tail = F.slice(F.col("own"), F.col("h") + 1, F.lit(width + heads))
    joined = own.join(base, "base", "left").select("conv_id", "n", "h", head.alias("head"), tail.alias("tail"))
    left_over = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return joined.select(
        "conv_id",
        (F.size("head") - F.col("h")).cast("long").alias("shift"),
        (F.size("head") + left_over).cast("long").alias("len"),
        F.slice(F.concat("head", "tail"), 1, width).alias("first"),
    )


def _path(columns: list[str], n: Column) -> Column:
    """Digest of the first ``n`` turn ids; ids have one length, so their concatenation tells them apart."""
    whole = F.concat(*(F.coalesce(F.col(c), F.lit(b"")) for c in columns))
    return F.unhex(F.sha2(F.substring(whole, F.lit(1), n * ID_BYTES), 256))


def _rollup(df: DataFrame, columns: list[str], aggs: str) -> DataFrame:
    """Every prefix of ``columns`` that occurs, per node ``up`` of the block before; ``level`` is its length."""
    names = ", ".join(columns)
    found = df.sparkSession.sql(
        f"SELECT up, {names}, {len(columns)} - bit_count(grouping_id()) AS level, {aggs} FROM {{rows}} GROUP BY up, ROLLUP ({names})",
        rows=df,
    )
    # a conversation that ends early has no id in the columns after its end, and no prefix there
    filled = reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in columns))
    return found.filter(F.col("level") == filled)


def _block(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of one block and, for each of its conversations, the node in which the block leaves it.

    ``rows``: ``conv_id, up, shift, len, rest`` (turns from this block on) and ``t1..tn``.
    """
    columns = [f"t{i}" for i in range(1, width + 1)]
    nodes = _rollup(rows, columns, "min(conv_id) AS conv_id, count(*) AS n_convs, max(rest) AS longest")
    nodes = materialise(nodes.withColumn("path", _path(columns, F.col("level"))))
    inside = F.least(F.col("rest"), F.lit(width)).cast("int")
    at = rows.select("conv_id", "up", "shift", "len", "rest", _path(columns, inside).alias("path"))
    found = nodes.select("up", "path", F.col("conv_id").alias("node"), "n_convs")
    return nodes, materialise(at.join(found, ["up", "path"]).drop("up", "path"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``conv_id, depth, member`` to digests; what may go on in another task, or is long, stays text."""
    part, seq, out = TaskContext.get().partitionId(), 0, []
    names, kinds = ["conv_id", "depth", "part", "seq", "sha", "text"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    key, text, first, cut = None, [], True, False

    def emit(whole: bool) -> None:
        nonlocal seq, text
        joined = ",".join(text)
        out.append((*key, part, seq, hashlib.sha256(joined.encode()).hexdigest() if whole else None, None if whole else joined))
        seq, text = seq + 1, []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    size = 0
    for b in batches:
        for node, depth, member in zip(*(c.to_pylist() for c in b.columns)):
            if (node, depth) != key:
                if key is not None:
                    emit(not first and not cut)
                    first = False
                key, cut, size = (node, depth), False, 0
            text.append(str(member))
            size += len(text[-1]) + 1
            if size > CHUNK_BYTES:
                emit(False)
                cut, size = True, 0
        if out:
            yield batch()
    if key is not None:
        if text:
            emit(False)  # the last node of a task may go on in the next one
        yield batch()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's pieces of text, which come in order; one piece is in memory at a time."""
    key, sha, done = None, None, []
    for b in batches:
        for node, depth, text in zip(*(c.to_pylist() for c in b.select(["conv_id", "depth", "text"]).columns)):
            if (node, depth) != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (node, depth), hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["conv_id", "depth", "sha"])
            done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], ["conv_id", "depth", "sha"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, sha``: SHA-256 of the comma-joined, ascending ``member`` ids of each node.

    A node's members may be a third of all conversations: they are range partitioned with the node, joined to
    pieces of text in many tasks, and only the pieces of a node (whose digest is sequential by nature) meet in one
    task, which holds one at a time.
    """
    order = ["conv_id", "depth", "member"]
    rows = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, depth long, part int, seq long, sha string, text string"
    pieces = materialise(map_batches(rows, _chunks, schema))
    split = pieces.filter("text IS NOT NULL").drop("sha").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part", "seq")
    whole = map_batches(split, _joined, "conv_id long, depth long, sha string")
    return pieces.filter("text IS NULL").select("conv_id", "depth", "sha").unionAll(whole)


def prefix_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    modulus: int = 20, heads: int = 4, widths: tuple[int, ...] = WIDTHS,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Every conversation, also one that is left without turns, is a member of the root. No conversations give no nodes.
    Rows without a conversation id are left out; null role and text are empty; null turns come first; repeated rows are
    turns like others. ``modulus`` and ``heads`` say how conversations are rebuilt (1 head: not at all).
    """
    turns = turn_ids(conversations, conv, turn, role, text)
    width, depth, blocks, ends, chains = widths[0], 0, [], [], []
    start = rebuilt_heads(turns, modulus, heads, width)
    rows = materialise(
        start.select("conv_id", F.lit(-1).cast("long").alias("up"), "shift", "len", F.col("len").alias("rest"),
                     *(F.get("first", i).alias(f"t{i + 1}") for i in range(width)))
    )
    while True:
        nodes, left = _block(rows, width)
        blocks.append((nodes, depth, width))
        ends.append(left.filter(F.col("rest") <= width).select(F.col("node").alias("conv_id"), F.col("len").alias("depth"), F.col("conv_id").alias("member")))
        depth += width
        on = left.filter(F.col("rest") > width)
        chains.append(on.filter("n_convs = 1").select("conv_id", "shift", "len", F.lit(depth).alias("after")))
        live = materialise(on.filter("n_convs > 1").select("conv_id", F.col("node").alias("up"), "shift", "len", (F.col("rest") - width).alias("rest")))
        if not live.take(1):
            break
        width = widths[min(len(blocks), len(widths) - 1)]
        at = F.col("pos") + F.col("shift") - depth
        found = turns.join(live, "conv_id").filter((at >= 0) & (at < width)).groupBy("conv_id").agg(
            *(F.max(F.when(at == i, F.col("id"))).alias(f"t{i + 1}") for i in range(width))
        )
        rows = materialise(live.join(found, "conv_id"))
    shared = _subtrees(blocks)
    chain = _chain_nodes(turns, reduce(DataFrame.unionAll, chains))
    digests = reduce(DataFrame.unionAll, [*ends, chain.filter("n_children = 0").select("conv_id", "depth", F.col("conv_id").alias("member"))])
    found = shared.unionByName(chain).join(end_digests(digests), ["conv_id", "depth"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def _chain_nodes(turns: DataFrame, chains: DataFrame) -> DataFrame:
    """The nodes of conversations that share nothing any more: one per turn after depth ``after``."""
    one, at = F.lit(1).cast("long"), F.col("pos") + F.col("shift") + 1
    rows = turns.select("conv_id", "pos").join(chains, "conv_id").filter(at > F.col("after"))
    return materialise(
        rows.select(
            "conv_id", at.alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
            (at < F.col("len")).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        )
    )


def _subtrees(blocks: list[tuple[DataFrame, int, int]]) -> DataFrame:
    """The nodes of all blocks with their parents and what their subtrees hold, from the last block to the first."""
    done, carry = [], None
    for nodes, depth, width in reversed(blocks):
        columns = [f"t{i}" for i in range(1, width + 1)]
        real = nodes.filter("level > 0") if depth else nodes
        goes_on = (F.col("level") == width) & (F.col("longest") > width)
        names = ["n_children", "n_leaves", "saved_tokens"]
        if carry is not None:
            real = real.join(carry, (real["level"] == width) & (real["conv_id"] == carry["top"]), "left")
            below = {c: F.coalesce(F.col(f"below_{c}"), F.lit(int(c != "saved_tokens")).cast("long")) for c in names}
        else:
            below = {c: F.lit(int(c != "saved_tokens")).cast("long") for c in names}
        # whoever goes on alone has one child and one leaf below; others have what the next block found
        last = F.get(F.array(*columns), F.col("level").cast("int") - 1)
        words = F.coalesce(F.conv(F.hex(F.substring(last, 33, 8)), 16, 10).cast("long"), F.lit(0).cast("long"))
        leaf = (F.col("longest") <= F.col("level")).cast("long")
        values = real.select(
            "up", *columns, "level", "conv_id", "n_convs",
            F.when(goes_on, below["n_children"]).otherwise(0).cast("long").alias("children"),
            F.when(goes_on, below["n_leaves"]).otherwise(leaf).alias("leaves"),
            ((F.col("n_convs") - 1) * words + F.when(goes_on, below["saved_tokens"]).otherwise(0)).alias("saved"),
        ).withColumnRenamed("level", "own")
        counts = ", ".join(f"count_if(own = {i}) AS c{i}" for i in range(1, width + 1))
        sums = _rollup(values, columns, f"min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(leaves) AS n_leaves, "
                       f"sum(saved) AS saved_tokens, max(CASE WHEN own = {width} THEN children END) AS beyond, {counts}")  # fmt: skip
        n_children = F.when(F.col("level") == width, F.col("beyond")).otherwise(F.get(F.array(*(f"c{i}" for i in range(1, width + 1))), F.col("level").cast("int")))
        sums = materialise(
            sums.select(
                "up", "level", "conv_id", "n_convs", F.coalesce(n_children, F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                _path(columns, F.col("level")).alias("path"), _path(columns, F.greatest(F.col("level") - 1, F.lit(0))).alias("parent_path"),
            )
        )
        tops = sums.select("up", F.col("path").alias("parent_path"), F.col("conv_id").alias("parent"))
        kept = sums.filter("level > 0") if depth else sums
        joined = kept.join(tops, ["up", "parent_path"], "left")
        # the first turn of a later block hangs under the node that the block is keyed by; the root under nothing
        above = F.when(F.col("level") > 1, F.col("parent")).when(F.col("level") == 1, F.col("up") if depth else F.col("parent"))
        done.append(
            joined.select(
                "conv_id", (F.col("level") + depth).cast("long").alias("depth"), above.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"
            )
        )
        carry = sums.filter("level = 0").select(F.col("up").alias("top"), *(F.col(c).alias(f"below_{c}") for c in names)) if depth else None
    return reduce(DataFrame.unionAll, done)
