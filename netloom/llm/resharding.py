"""Resharding by minimum-cost flow.

Rows of an old shard are dealt into blocks by a hash.  The driver learns the
bytes of every block (old shards times blocks rows, a fixed number), gives each
new shard an equal capacity, and solves a transportation problem between old
and new shards: a byte that stays costs nothing, a byte that moves costs one
(or what ``cost`` says).  Whole blocks then follow the flow, a short repair
evens out what block sizes leave over, and only blocks that move are written
again; what stays is left where it is.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netloom.llm.common import bounded_broadcast, fresh, materialize, scratch

#: Most cells beside one for each block; the table of their places is broadcast, at so many bytes a cell.
CELLS, CELL_BYTES = 800_000, 40


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Send all of ``supply`` to ``capacity`` at the least total ``cost(i, j)`` a unit.

    Successive shortest paths with node potentials.  The sums must agree or
    the capacity be larger.  Returns the units on each used pair.
    """
    n, m = len(supply), len(capacity)
    source, sink, nodes = n + m, n + m + 1, n + m + 2
    head: list[int] = []
    room: list[int] = []
    price: list[int] = []
    out: list[list[int]] = [[] for _ in range(nodes)]

    def edge(a: int, b: int, units: int, each: int) -> None:
        for x, y, u, c in ((a, b, units, each), (b, a, 0, -each)):
            out[x].append(len(head))
            head.append(y)
            room.append(u)
            price.append(c)

    for i, units in enumerate(supply):
        edge(source, i, units, 0)
    pairs = {}
    for i in range(n):
        for j in range(m):
            pairs[i, j] = len(head)
            edge(i, n + j, sum(supply), cost(i, j))
    for j, units in enumerate(capacity):
        edge(n + j, sink, units, 0)
    potential = [0] * nodes
    left = sum(supply)
    while left:
        dist, via = [None] * nodes, [-1] * nodes
        dist[source], queue = 0, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for e in out[a]:
                b = head[e]
                if room[e] and (dist[b] is None or d + price[e] + potential[a] - potential[b] < dist[b]):
                    dist[b], via[b] = d + price[e] + potential[a] - potential[b], e
                    heapq.heappush(queue, (dist[b], b))
        if dist[sink] is None:
            raise ValueError("the new shards cannot hold the old ones")
        potential = [p + (d if d is not None else dist[sink]) for p, d in zip(potential, dist)]
        push, node = left, sink
        while node != source:
            push = min(push, room[via[node]])
            node = head[via[node] ^ 1]
        node = sink
        while node != source:
            room[via[node]] -= push
            room[via[node] ^ 1] += push
            node = head[via[node] ^ 1]
        left -= push
    return {pair: room[e ^ 1] for pair, e in pairs.items() if room[e ^ 1]}


@dataclass
class Plan:
    """Where each (old shard, block) goes, and which shards change."""

    target: dict[tuple[int, int], int]
    affected: set[int]
    moved_bytes: int
    #: Bytes that the flow would move if blocks could be cut anywhere.
    least_bytes: int


def plan_blocks(blocks: dict[tuple[int, int], int], n_old: int, n_new: int, cost=None) -> Plan:
    """Assign blocks, given as {(old shard, block): bytes}, to ``n_new`` shards of near equal bytes."""
    supply = [0] * n_old
    for (i, _), size in blocks.items():
        supply[i] += size
    total = sum(supply)
    capacity = [total * (j + 1) // n_new - total * j // n_new for j in range(n_new)]
    flow = min_cost_flow(supply, capacity, cost or (lambda i, j: int(i != j)))
    target: dict[tuple[int, int], int] = {}
    load = [0] * n_new
    by_old: dict[int, list] = {}
    for key, size in sorted(blocks.items(), key=lambda x: (-x[1], x[0])):
        by_old.setdefault(key[0], []).append((size, key))
    for i, own in by_old.items():
        rest = own
        for j, units in sorted(((j, u) for (a, j), u in flow.items() if a == i and j != i), key=lambda x: -x[1]):
            taken, after = units, []
            for size, key in rest:
                if size <= taken:
                    target[key], taken, load[j] = j, taken - size, load[j] + size
                else:
                    after.append((size, key))
            rest = after
        home = i if i < n_new else min(range(n_new), key=lambda j: load[j])
        for size, key in rest:
            target[key] = home
            load[home] += size
    _even_out(blocks, target, load)
    moved = {key for key in blocks if target[key] != key[0]}
    affected = {key[0] for key in moved} | {target[key] for key in moved}
    return Plan(target, affected, sum(blocks[k] for k in moved), sum(u for (i, j), u in flow.items() if i != j))


def _even_out(blocks, target, load) -> None:
    """Move a block from the fullest to the emptiest shard, or swap two, while that narrows the gap."""
    held: list[list] = [[] for _ in load]
    for key, j in target.items():
        held[j].append((blocks[key], key))
    for x in held:
        x.sort()
    for _ in range(64 * len(load)):
        top, low = max(range(len(load)), key=load.__getitem__), min(range(len(load)), key=load.__getitem__)
        gap = load[top] - load[low]
        # What moves (and what comes back) so that the shards meet as nearly in the middle as can be.
        best = (gap, None, None)
        for give in held[top]:
            at = bisect_right(held[low], (give[0] - gap // 2, (1 << 62, 0)))
            for take in [None, *held[low][max(0, at - 1) : at + 1]]:
                moved = give[0] - (take[0] if take else 0)
                if 0 < moved < gap:
                    best = min(best, (abs(gap - 2 * moved), give, take), key=lambda x: x[0])
        if best[1] is None:
            return
        for block, source, goal in ((best[1], top, low), (best[2], low, top)):
            if block:
                held[source].remove(block)
                insort(held[goal], block)
                target[block[1]] = goal
                load[source] -= block[0]
                load[goal] += block[0]


def _dealt(docs: DataFrame, old_shard: Column, blocks: int, id_col: str, text_col: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with size, old shard, block, the hash that cells are cut from, and a digest that orders equal ids."""
    hashed = F.xxhash64(id_col, text_col)
    return docs.withColumns({
        "size": (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8).cast("long"),
        names["old"]: F.coalesce(old_shard.cast("int"), F.lit(0)),
        names["block"]: F.pmod(hashed, F.lit(blocks)).cast("int"),
        names["rest"]: F.floor(F.pmod(hashed, F.lit(1 << 40)) / blocks),
        names["digest"]: F.xxhash64(F.lit(1), text_col),
    })


def reshard(docs: DataFrame, old_shard: Column, n_old: int, n_new: int, blocks: int = 512, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 32 << 20, cost=None, landed: bool = True) -> tuple[DataFrame, str, Plan]:
    """Bring ``docs``, laid out in ``n_old`` shards, into ``n_new`` shards of near equal bytes.

    ``old_shard`` gives each row's old shard, 0 to ``n_old`` - 1; null rows
    count to shard 0.  Returns (rows, path, plan): the rows with size, shard and
    slot; the folder of new files (``shard=N/``), which hold the rows of the
    blocks that move; and the block plan.  Rows of blocks that stay are not
    written again: they are read where they are and numbered.  Without ``landed`` the
    old shards are no files yet, so there is nothing to leave where it is, and the
    rows of all blocks are written.

    The driver holds ``n_old`` times ``blocks`` sizes.  Each block larger than
    ``file_bytes`` is cut into as many cells as its own bytes ask for, at most
    ``CELLS`` in all beside the first of each block, which are counted and placed
    by Spark alone; a file is a run of whole cells of one shard and each file is a
    task of its own.  Rows that agree in id and text share a cell, which nothing
    can cut: a file is as large as they are.

    A row's size is its UTF-8 bytes (null text: none) plus 8.  Repeated rows are
    kept, each in a slot of its own; ties in order are between equal rows.  An
    empty table gives no rows.  Columns named size, shard or slot are replaced.
    """
    spark = docs.sparkSession
    names = {n: fresh("_" + n, docs) for n in ("old", "block", "rest", "digest", "cell", "cells", "start", "file", "moves")}
    old, block, cell, cells, start, file, moves = (names[n] for n in ("old", "block", "cell", "cells", "start", "file", "moves"))
    based = _dealt(docs, old_shard, blocks, id_col, text_col, names).drop("shard", "slot")
    totals = [F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")]
    seen = based.groupBy(old, block).agg(*totals).collect()  # at most n_old * blocks rows
    sizes = {(r[old], r[block]): r["bytes"] for r in seen}
    plan = plan_blocks(sizes, n_old, n_new, cost)
    load, first = [0] * n_new, [0]
    for key, j in plan.target.items():
        load[j] += sizes[key]
    file_bytes = max(file_bytes, sum(load) // CELLS)
    for units in load:
        first.append(first[-1] + units // file_bytes + 1)
    # A block has as many cells as files' worth of bytes, so there are CELLS + n_old * blocks in all at most.
    targets = [(*key, j, first[j], j != key[0], max(1, -(-sizes[key] // file_bytes))) for key, j in plan.target.items()]
    table = F.broadcast(spark.createDataFrame(targets, f"`{old}` int, `{block}` int, shard int, first int, `{moves}` boolean, `{cells}` long"))
    based = based.join(table, [old, block]).withColumn(cell, F.pmod(F.col(names["rest"]), F.col(cells)).cast("int")).drop("first")
    counted = spark.createDataFrame([(r[old], r[block], 0, r["bytes"], r["n"]) for r in seen if r["bytes"] <= file_bytes], f"`{old}` int, `{block}` int, `{cell}` int, bytes long, n long")
    if any(t[5] > 1 for t in targets):
        counted = counted.unionByName(materialize(based.where(F.col(cells) > 1).groupBy(old, block, cell).agg(*totals), "cells"))
    # Where each cell starts in its shard, and in which file it is.
    before = "over (partition by shard order by `{}`, `{}`, `{}` rows between unbounded preceding and 1 preceding)".format(old, block, cell)
    placed = counted.join(table, [old, block]).select(
        old, block, cell, F.expr(f"coalesce(sum(n) {before}, 0)").alias(start),
        F.expr(f"cast(first + coalesce(sum(bytes) {before}, 0) div {file_bytes} as int)").alias(file),
    )
    placed = materialize(placed, "placed")
    rows = based.join(bounded_broadcast(placed, CELL_BYTES), [old, block, cell])
    window = Window.partitionBy(file, old, block, cell).orderBy(id_col, names["digest"])
    number = (F.row_number().over(window) - 1 + F.col(start)).alias("slot")
    columns = [*(c for c in docs.columns if c not in ("size", "shard", "slot")), "size", "shard"]
    path = scratch(spark, "shards")
    moved = (rows.where(moves) if landed else rows).repartitionById(first[-1], F.col(file)).select(*columns, number)
    moved.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    stays = rows.where(f"not `{moves}`").select(*columns, number)
    if landed and not any(j != key[0] for key, j in plan.target.items()):
        return stays, path, plan
    files = spark.read.schema(moved.schema).parquet(path)
    return (files if not landed or all(j != key[0] for key, j in plan.target.items()) else files.unionByName(stays)), path, plan


#: The old layout that the query reads: sources dealt to this many shards.
OLD_SHARDS, NEW_SHARDS = 16, 24


def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    # Taken along, so that texts that stay need not be shuffled for it.
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    old = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS))
    rows, _, _ = reshard(docs, old, OLD_SHARDS, NEW_SHARDS, landed=False)  # the table is laid out in no shards yet
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
