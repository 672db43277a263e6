"""The prefix trie of conversations, aggregated for all prefixes together by ROLLUP.

A turn is named by a digest of role and text that also carries the text's number of words. A conversation
becomes rows of `WIDTH` turn columns; the row of a further block is keyed by the node its blocks before
end at. GROUP BY block, key, ROLLUP(turn columns) then counts every prefix of every conversation at once,
and grouping_id tells how many columns a row still groups by, that is, its depth in the block.

No step waits for the block before: the key is a digest of the turns before, put together from digests of
1, 2, 4, ... blocks, in as many rounds as the logarithm of the longest conversation. Sums over subtrees need
no walk either. The smallest member of a node is that of all nodes below it on its own path, so each node's
share is booked on its smallest member; a second ROLLUP adds up the members' shares, from which the
part of the node's own smallest member that lies above it is taken away.

Positions come from one sort by conversation and turn in ranges, so that no task holds a whole
conversation; joins on a conversation are dealt by pieces of it, sums along one are windows over
chunks. The ids that end at a node are joined in chunks of `CHUNK` ids and hashed chunk after chunk in a
stream.

Defined results: null role or text counts as empty; a null turn comes first. Turns that agree in conversation
and turn are ordered by digest; repeated rows are turns of their own. Rows without conv_id are left out.
A conversation may lose all turns by the rebuilding; it is a member of the root alone. An empty table
gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import map_batches, materialise

#: Turn columns of a block.
WIDTH = 8
#: Ids that are joined to one string.
CHUNK = 4_096
#: Turns of a conversation that meet its row in one join key.
PIECE = 100_000
#: Levels of a path that are summed in one window.
LEVELS = 65_536
#: Turns of a range that is sorted in one task.
RANGE = 1_000_000

_TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
_ROOT = "unhex('00000000000000000000000000000000')"


def _digest(of: str) -> str:
    """128 bits of SHA-256, as SQL."""
    return f"unhex(left(sha2({of}, 256), 32))"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and tid: 128 bits that name role and text, then the text's words in four bytes."""
    role, text = "coalesce(cast(role as string), '')", "coalesce(cast(text as string), '')"
    words = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.expr(role).alias("role"), F.expr(text).alias("text")
    )
    name = _digest("concat(cast(length(role) as string), ':', role, text)")
    return rows.select("conv_id", "turn", F.expr(f"concat({name}, unhex(lpad(hex({words}), 8, '0')))").alias("tid"))


def positions(named: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), tid: turns in order, by a sort in ranges that no conversation is too long for."""
    written = materialise(named, "trie-turns")
    ranges = max(1, -(-written.count() // RANGE))
    # a number of the written row parts even equal rows
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tid"), F.col("row")]
    dealt = written.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            place = []
            for conv in batch.column(0).to_pylist():
                at = at + 1 if conv == before else 1
                before = conv
                place.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(place, pa.int64()), batch.column(2), pa.array([own] * len(place), pa.int64())], names=["conv_id", "pos", "tid", "range"]
            )

    placed = materialise(map_batches(dealt, work, "conv_id long, pos long, tid binary, range long"), "trie-places")
    # one row of each range reaches the driver: its first and last conversation and the length of the last
    ends = placed.groupBy("range").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("last")).orderBy("range").collect()
    carried, open_conv, open_length = [], None, 0
    for r in ends:
        before = open_length if r["first"] == open_conv else 0
        if before:
            carried.append((r["range"], r["first"], before))
        whole = r["last"]["conv_id"] == r["first"]
        open_conv, open_length = r["last"]["conv_id"], r["last"]["pos"] + (before if whole else 0)
    offsets = F.broadcast(placed.sparkSession.createDataFrame(carried, "of_range long, of_conv long, before long"))  # one row a range at most
    joined = placed.join(offsets, (F.col("range") == F.col("of_range")) & (F.col("conv_id") == F.col("of_conv")), "left")
    return materialise(joined.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "tid"), "trie-positions")


def rebuilt(placed: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their turns (conv_id, d, tid) after their beginnings are exchanged.

    The first h turns of conversation c - c % group stand before the turns of c after its first h, h being
    crc32(c) % most.
    """
    lengths = placed.groupBy("conv_id").agg(F.max("pos").alias("length"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = lengths.select("conv_id", "length", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = placed.where((F.col("conv_id") % group == 0) & (F.col("pos") < most)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "tid"))).alias("head"))
    # at most `group` conversations have one base
    met = convs.join(heads.withColumnRenamed("conv_id", "of"), F.col("base") == F.col("of"), "left")
    met = met.withColumn("head", F.expr("slice(coalesce(head, array()), 1, cast(h as int))"))
    known = materialise(met.select("conv_id", "length", "h", "head"), "trie-conversations")
    first = known.select("conv_id", F.explode("head").alias("x")).select("conv_id", F.col("x.pos").alias("d"), F.col("x.tid").alias("tid"))
    # a long conversation meets its row once for each of its pieces
    pieces = known.select(
        F.col("conv_id").alias("of"), "h", F.size("head").alias("m"), F.explode(F.expr(f"sequence(0L, length div {PIECE}L)")).alias("of_piece")
    )
    own = placed.join(pieces, (F.col("conv_id") == F.col("of")) & (F.expr(f"pos div {PIECE}") == F.col("of_piece")))
    rest = own.where("pos > h").select("conv_id", (F.col("m") + F.col("pos") - F.col("h")).cast("long").alias("d"), "tid")
    return known.select("conv_id"), first.unionByName(rest)


def _keys(full: DataFrame) -> DataFrame:
    """conv_id, n, key: a digest of the first n blocks, for blocks (conv_id, k, dig) that are all full."""
    most = full.agg(F.max("k")).first()[0]
    levels, level = [], full
    for power in range(0 if most is None else (most + 1).bit_length()):
        if power:
            halves = level.groupBy("conv_id", F.expr("k div 2").alias("k")).agg(
                F.max(F.when(F.col("k") % 2 == 0, F.col("dig"))).alias("a"), F.max(F.when(F.col("k") % 2 == 1, F.col("dig"))).alias("b")
            )
            both = halves.where("a is not null and b is not null").select("conv_id", "k", F.expr(_digest("concat(a, b)")).alias("dig"))
            level = materialise(both, "trie-digests")
        levels.append(level.withColumn("power", F.lit(power)))
    if not levels:
        return full.select("conv_id", F.col("k").alias("n"), F.col("dig").alias("key"))
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    # the digest of an even block run is a part of all numbers n whose bits begin with it and one
    served = every.where("k % 2 = 0").select(
        "conv_id", "power", "dig", F.explode(F.expr("sequence(shiftleft(k + 1, power), shiftleft(k + 2, power) - 1)")).alias("n")
    )
    parts = served.groupBy("conv_id", "n").agg(F.sort_array(F.collect_list(F.struct((-F.col("power")).alias("order"), "dig"))).alias("parts"))
    whole = parts.where("size(parts) = bit_count(n)")  # at most one part for each bit
    joined = "aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.dig))"
    return whole.select("conv_id", "n", F.expr(_digest(f"concat(cast('blocks' as binary), {joined})")).alias("key"))


def blocks(convs: DataFrame, sequence: DataFrame) -> DataFrame:
    """conv_id, k, key (the node before the block), t1..., after (the node at its end, of full blocks)."""
    rows = sequence.select("conv_id", F.expr(f"(d - 1) div {WIDTH}").alias("k"), ((F.col("d") - 1) % WIDTH).alias("at"), "tid")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("k"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("tid"))
    columns = [F.max(F.when(F.col("at") == i, F.col("tid"))).alias(t) for i, t in enumerate(_TURNS)]
    wide = materialise(rows.unionByName(empty).groupBy("conv_id", "k").agg(*columns), "trie-blocks")
    last = _TURNS[-1]
    full = wide.where(f"{last} is not null").select("conv_id", "k", F.expr(_digest(f"concat({', '.join(_TURNS)})")).alias("dig"))
    keys = materialise(_keys(materialise(full, "trie-full")), "trie-keys")
    short = wide.where(f"k = 0 and {last} is null").select("*", F.expr(_ROOT).alias("key"), F.lit(None).cast("binary").alias("after"))
    before = keys.select(F.col("conv_id").alias("c1"), F.col("n").alias("n1"), "key")
    beyond = keys.select(F.col("conv_id").alias("c2"), (F.col("n") - 1).alias("n2"), F.col("key").alias("after"))
    long = wide.where(f"k > 0 or {last} is not null")
    long = long.join(before, (F.col("conv_id") == F.col("c1")) & (F.col("k") == F.col("n1")), "left")
    long = long.join(beyond, (F.col("conv_id") == F.col("c2")) & (F.col("k") == F.col("n2")), "left")
    long = long.select("conv_id", "k", *_TURNS, F.expr(f"coalesce(key, {_ROOT})").alias("key"), "after")
    return materialise(short.select("conv_id", "k", *_TURNS, "key", "after").unionByName(long), "trie-rows")


def _node(depth: int) -> str:
    """The name of the node at a depth in the block, as SQL."""
    if depth == 0:
        return "key"
    return "after" if depth == WIDTH else _digest(f"concat(key, {', '.join(_TURNS[:depth])})")


def _chosen(how: str, name) -> str:
    return f"case {how} {' '.join(f'when {d} then {name(d)}' for d in range(WIDTH + 1))} end"


def rolled(rows: DataFrame, *sums: str) -> DataFrame:
    """All prefixes by one ROLLUP: node, parent, depth, words of the last text, smallest member, members and sums."""
    listed = ", ".join(_TURNS)
    grouped = rows.sparkSession.sql(
        f"""select k, key, {listed}, {WIDTH} - bit_count(grouping_id()) as j, max(after) as after,
              count(*) as n_convs, min(conv_id) as conv_id{''.join(f', sum({s}) as {s}' for s in sums)}
            from {{rows}} group by k, key, rollup({listed})""",
        rows=rows,
    )
    # a column that is null where it is grouped by is a conversation that ended before; further blocks' tops are known
    there = " or ".join(["(j = 0 and k = 0)", *(f"(j = {d} and t{d} is not null)" for d in range(1, WIDTH + 1))])
    text = _chosen("j", lambda d: f"cast(conv(hex(substring(t{d}, 17, 4)), 16, 10) as long)" if d else "0L")
    return grouped.where(there).select(
        F.expr(_chosen("j", _node)).alias("node"), F.expr(_chosen("j", lambda d: _node(d - 1) if d else "cast(null as binary)")).alias("parent"),
        (F.col("k") * WIDTH + F.col("j")).alias("depth"), F.expr(text).alias("words"), "conv_id", "n_convs", *sums,
    )


def ends(rows: DataFrame) -> DataFrame:
    """node, ends_sha256: the digest of the ids that end there, ascending."""
    reached = " + ".join(f"cast({t} is not null as int)" for t in _TURNS)
    held = rows.withColumn("j", F.expr(reached))
    # the last row of a conversation is the one that is not full, or the full one without a row after it
    following = rows.where("k > 0").select(F.col("conv_id").alias("c"), (F.col("k") - 1).alias("b"))
    full = held.where(f"j = {WIDTH}").join(following, (F.col("conv_id") == F.col("c")) & (F.col("k") == F.col("b")), "left_anti")
    last = held.where(f"j < {WIDTH}").unionByName(full)
    named = last.select("conv_id", F.expr(_chosen("j", _node)).alias("node"), F.floor(F.col("conv_id") / F.lit(CHUNK)).alias("chunk"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = named.groupBy("node", "chunk").agg(joined.alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    ordered = chunks.repartition("node").sortWithinPartitions("node", "chunk")
    return map_batches(ordered, work, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node."""
    convs, sequence = rebuilt(positions(turns(conversations)), group, most)
    rows = blocks(convs, sequence)
    nodes = materialise(rolled(rows), "trie-nodes")
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    counted = nodes.join(children.withColumnRenamed("parent", "of"), F.col("node") == F.col("of"), "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.expr(f"depth div {LEVELS}").alias("chunk"),
    )
    counted = materialise(counted, "trie-counted")
    # what a conversation answers for: the nodes it is the smallest member of
    shares = counted.groupBy("conv_id", "chunk").agg(F.sum("saved").alias("chunk_saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("chunk_leaves"))
    shares = materialise(shares, "trie-shares")
    own = shares.groupBy("conv_id").agg(F.sum("chunk_saved").alias("member_saved"), F.sum("chunk_leaves").alias("member_leaves"))
    # a block row bears its members' shares
    totals = rolled(rows.join(own.withColumnRenamed("conv_id", "of"), F.col("conv_id") == F.col("of"), "left").drop("of"), "member_saved", "member_leaves")
    totals = totals.select(F.col("node").alias("of"), F.coalesce("member_saved", F.lit(0)).alias("all_saved"), F.coalesce("member_leaves", F.lit(0)).alias("n_leaves"))
    above = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    chunks_above = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    earlier = shares.select(F.col("conv_id").alias("c"), F.col("chunk").alias("b"), "chunk_saved").withColumn(
        "chunks_before", F.coalesce(F.sum("chunk_saved").over(chunks_above), F.lit(0))
    )
    placed = counted.withColumn("levels_before", F.coalesce(F.sum("saved").over(above), F.lit(0)))
    placed = placed.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("chunk") == F.col("b")))
    placed = placed.join(totals, F.col("node") == F.col("of")).withColumn("saved_tokens", F.col("all_saved") - F.col("levels_before") - F.col("chunks_before"))
    # the root's children, which may be all conversations, need no join to find their parent
    root = nodes.where("depth = 0").select("conv_id").first()
    top = F.lit(None if root is None else root["conv_id"]).cast("long")
    named = nodes.where("depth > 0").select(F.col("node").alias("p"), F.col("conv_id").alias("p_conv"))
    deep = placed.where("depth > 1").join(named, F.col("parent") == F.col("p")).withColumn("parent_conv_id", F.col("p_conv")).drop("p", "p_conv")
    flat = placed.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, top))
    every = flat.unionByName(deep)
    ended = ends(rows).withColumnRenamed("node", "e")
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(ended, F.col("node") == F.col("e"), "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long").alias("n_convs"), "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
