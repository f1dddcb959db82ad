"""Items of whole size into containers of fixed capacity, with little waste.

Items are dealt into blocks by a hash of their id; each block is packed by bin
completion, a branch-and-bound over the fillings around its largest item. A
block is of bounded size whatever the table's, so no task grows. Containers
that a block leaves far from full are taken apart and packed again in blocks
of their own, round by round.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import write_shared

#: Containers that a block is to hold about, and at most so many items.
BLOCK_BINS, BLOCK_ITEMS = 600, 20_000
#: Search budgets of a block; None sets no bound and the search goes on until
#: the lower bound is reached or all undominated fillings are tried. Branches
#: of the fillings of one container, fillings kept of each, other fillings
#: tried after a dead end. When they are spent the incumbent stands; no item
#: is lost by it, only room.
BRANCHES, WAYS, RETRIES = 60, 3, 200
#: Rounds of packing, and the fill below which a container is packed again.
ROUNDS, REFILL = 2, 0.9


class _Sizes:
    """A multiset of sizes, kept as sorted distinct values with counts."""

    def __init__(self, sizes):
        self.count: dict[int, int] = {}
        for s in sizes:
            self.count[s] = self.count.get(s, 0) + 1
        self.order = sorted(self.count)

    def take(self, s: int) -> None:
        self.count[s] -= 1
        if not self.count[s]:
            del self.order[bisect_left(self.order, s)]

    def give(self, s: int) -> None:
        if not self.count.get(s):
            self.order.insert(bisect_left(self.order, s), s)
            self.count[s] = 0
        self.count[s] += 1


def fillings(sizes: _Sizes, room: int, budget: int | None) -> list[tuple[int, ...]]:
    """Undominated ways to fill room, best first: least waste, then fewest
    (so largest) items. A way is undominated only if no item left over fits
    into what it leaves open. At most `budget` branches are tried (None: all)."""
    found: dict[tuple[int, ...], int] = {}
    order, count = sizes.order, sizes.count
    least = order[0] if order else room + 1
    best = room + 1
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, bisect_right(order, room) - 1, ())]
    tried = 0
    while stack and (budget is None or tried < budget):
        left, at, used = stack.pop()
        tried += 1
        if left < least or at < 0:
            found[used] = left
            best = min(best, left)
            if not best:
                break
            continue
        # One item that closes the room exactly dominates all else here.
        i = bisect_left(order, left, 0, at + 1)
        if i <= at and order[i] == left and count[left] > used.count(left):
            found[(*used, left)] = 0
            break
        s = order[at]
        while at >= 0 and count[s] <= used.count(s):
            at -= 1
            s = order[at] if at >= 0 else 0
        if at < 0:
            found[used] = left
            best = min(best, left)
            continue
        stack.append((left, at - 1, used))  # without s: only if it beats the incumbent
        rest = left - s
        stack.append((rest, min(at, bisect_right(order, rest) - 1), (*used, s)))

    def spare(used: tuple[int, ...], left: int) -> bool:
        k = bisect_right(order, left) - 1
        while k >= 0 and count[order[k]] <= used.count(order[k]):
            k -= 1
        return k >= 0

    ways = sorted((left, len(used), used) for used, left in found.items() if not spare(used, left))
    return [used for _, _, used in ways]


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the incumbent that the search must beat."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # sorted (left, bin)
    for s in sorted(sizes, reverse=True):
        i = bisect_left(room, (s, -1))
        if i < len(room):
            left, k = room.pop(i)
        else:
            left, k = capacity, len(bins)
            bins.append([])
        bins[k].append(s)
        entry = (left - s, k)
        room.insert(bisect_left(room, entry), entry)
    return bins


def complete_bins(sizes: list[int], capacity: int, branches: int | None = BRANCHES, ways: int | None = WAYS, retries: int | None = RETRIES) -> list[list[int]]:
    """Bins of sizes (each 1..capacity) by bin completion.

    The largest item left opens a bin; its undominated fillings are tried best
    first. A branch ends when the waste so far rules out beating the
    incumbent; then another filling of an earlier bin is taken, `retries`
    times at most. The search ends early at the lower bound. Without budgets
    (None) the result is optimal.
    """
    if not sizes:
        return []
    incumbent = best_fit(sizes, capacity)
    total = sum(sizes)
    bound = max(-(-total // capacity), sum(1 for s in sizes if 2 * s > capacity))
    left = _Sizes(sizes)
    path: list[tuple[list[tuple[int, ...]], int, int, int]] = []  # fillings, chosen, largest, waste
    waste = again = 0
    while len(incumbent) > bound:
        allowed = (len(incumbent) - 1) * capacity - total
        if not left.order and waste <= allowed:
            incumbent = [[big, *found[k]] for found, k, big, _ in path]
            continue  # its waste is beyond what is allowed now
        if left.order and waste <= allowed:
            big = left.order[-1]
            left.take(big)
            found = fillings(left, capacity - big, branches) or [()]
            for s in found[0]:
                left.take(s)
            lost = capacity - big - sum(found[0])
            path.append((found[:ways], 0, big, lost))
            waste += lost
            continue
        while path:
            found, k, big, lost = path.pop()
            waste -= lost
            for s in found[k]:
                left.give(s)
            if k + 1 < len(found) and (retries is None or again < retries):
                lost = capacity - big - sum(found[k + 1])
                if waste + lost <= allowed:
                    again += 1
                    for s in found[k + 1]:
                        left.take(s)
                    path.append((found, k + 1, big, lost))
                    waste += lost
                    break
            left.give(big)
        if not path or (retries is not None and again >= retries):
            break
    return incumbent


def _pack_block(pdf: pd.DataFrame, ids: str, round_: int) -> pd.DataFrame:
    """One block: item rows with bin numbers that are unique in the table."""
    spec, capacity, block = pdf["spec_id"].iloc[0], int(pdf["capacity"].iloc[0]), int(pdf["block"].iloc[0])
    order = pdf.sort_values([ids, "piece"], kind="stable")
    sized = order[order["size"] > 0]
    bins = complete_bins(sized["size"].tolist(), capacity)
    stock: dict[int, list[int]] = {}
    for row, s in zip(sized.index[::-1], sized["size"].to_numpy()[::-1].tolist()):
        stock.setdefault(s, []).append(row)
    number = pd.Series(0, index=pdf.index, dtype="int64")  # items of no size lie in bin 0
    fill = pd.Series(0, index=pdf.index, dtype="int64")
    for k, members in enumerate(bins):
        used = sum(members)
        for s in members:
            row = stock[s].pop()
            number[row], fill[row] = k, used
    pdf = pdf.assign(container=[f"{spec}-{round_}-{block}-{k}" for k in number], fill=fill)
    if bins:  # items of no size share the fill of the bin they lie in
        pdf.loc[pdf["size"] == 0, "fill"] = sum(bins[0])
    return pdf


def pack(items: DataFrame, ids: str, size: str, specs: DataFrame, rounds: int = ROUNDS, refill: float = REFILL) -> DataFrame:
    """spec_id, ids, piece, start, n, container_id for every item and spec.

    specs: spec_id, capacity_tokens (a small fixed table; null or non-positive
    capacities and repeated specs are ignored). An item larger than the
    capacity is cut into full containers and a rest; no other item is cut.
    Items of size 0 (or null, taken as 0) lie in a container without using
    room. Items with a null id are dropped, as they can't be named; repeated
    rows are packed each for itself (piece tells them apart only if their size
    exceeds the capacity). Empty tables give an empty result.
    """
    specs = specs.where("spec_id is not null and capacity_tokens > 0").groupBy("spec_id").agg(F.max("capacity_tokens").cast("long").alias("capacity"))
    base = items.where(F.col(ids).isNotNull()).select(ids, F.coalesce(F.col(size), F.lit(0)).cast("long").alias("whole"))
    base = write_shared(base, "pack-items")
    facts = base.agg(F.count("*").alias("n"), F.coalesce(F.sum("whole"), F.lit(0)).alias("t")).first()
    work = base.join(F.broadcast(specs)).withColumn("at", F.explode(F.expr("sequence(0, greatest(whole - 1, 0) div capacity)")))
    work = work.select(
        "spec_id", "capacity", ids, F.col("at").cast("int").alias("piece"), (F.col("at") * F.col("capacity")).alias("start"),
        F.least(F.col("capacity"), F.col("whole") - F.col("at") * F.col("capacity")).alias("size"),
    )
    whole = work.where("size = capacity")
    open_ = work.where("size < capacity")
    n, tokens = max(facts["n"], 1), facts["t"]
    done = whole.select(
        "spec_id", ids, "piece", "start", F.col("size").alias("n"),
        F.concat_ws("-", F.col("spec_id"), F.lit("w"), F.col(ids), F.col("piece")).alias("container_id"),
    )
    schema = "spec_id int, capacity long, %s long, piece int, start long, size long, block int, container string, fill long" % ids
    for r in range(rounds):
        blocks = F.greatest(F.lit(1), F.ceil(F.greatest(F.lit(tokens) / (F.col("capacity") * BLOCK_BINS), F.lit(n / BLOCK_ITEMS))))
        dealt = open_.withColumn("block", F.pmod(F.xxhash64(ids, "piece", F.lit(r)), blocks).cast("int"))
        packed = dealt.groupBy("spec_id", "block").applyInPandas(partial(_pack_block, ids=ids, round_=r), schema)
        packed = write_shared(packed, "packed")
        last = r == rounds - 1
        keep = F.lit(True) if last else F.col("fill") >= F.lit(refill) * F.col("capacity")
        done = done.unionByName(
            packed.where(keep).select("spec_id", ids, "piece", "start", F.col("size").alias("n"), F.col("container").alias("container_id"))
        )
        if last:
            break
        open_ = packed.where(~keep).select("spec_id", "capacity", ids, "piece", "start", "size")
        facts = open_.groupBy("spec_id").agg(F.count("*").alias("n"), F.sum("size").alias("t")).agg(F.max("n"), F.max("t")).first()
        n, tokens = facts[0] or 1, facts[1] or 0
    return done
