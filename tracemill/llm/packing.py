"""Filling fixed-capacity containers by bin completion.

Items larger than the capacity are split into full containers and a rest; all other
items stay whole. Items are dealt by hash into groups of about ``GROUP`` containers'
worth of tokens, and each group is packed by branch and bound:

* the incumbent is the best-fit decreasing packing, and the search ends as soon as the
  incumbent meets the lower bound (the items' sum and the waste that they force);
* a container is opened for the largest item left, and its undominated fillings are
  enumerated, those with the least waste first, then those of larger items (a filling is
  dominated if another one's items could hold its items). The sums that the items left
  can make are kept as bits, so the enumeration meets no dead end;
* the waste so far plus the waste that the items left force (large items whose room the
  small ones can't fill) must allow a packing with a container less than the
  incumbent's, else the branch is cut.

Bin packing is NP-hard, so the search of a group is bounded: ``NODES`` opened containers
and ``TRIES`` fillings of each. A group that uses them up keeps its incumbent, which is
complete; :func:`searched` counts such groups and what the bound leaves open.

The container of each group that is left over is emptied with all others that have more
than ``SLACK`` of room, and their items are dealt anew into fewer groups, as only these
waste room. Rounds go on until there is one group, or until a round has more than half
as many loose containers as the one before, where the items' sizes leave the room and
dealing again can't help.

Only (id, size, part) is shuffled; a group's rows are bounded by its token count.

Defined cases: null and zero sizes are in no container; items of exactly the
capacity fill one; equal sizes and repeated ids are separate items, told apart by
size, part and copy; an empty table gives no containers.
"""

from __future__ import annotations

import bisect
import json
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.session import by_key, materialize, ship_by_value

CAPACITY, GROUP, NODES, TRIES, SLACK = 2048, 256, 2000, 8, 0.02


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: containers as lists of places in ``sizes`` (which are descending)."""
    rooms: list[tuple[int, int]] = []  # (room, container), ascending
    bins: list[list[int]] = []
    for i, s in enumerate(sizes):
        k = bisect.bisect_left(rooms, (s, -1))
        if k == len(rooms):
            bins.append([i])
            room, b = capacity - s, len(bins) - 1
        else:
            room, b = rooms.pop(k)
            bins[b].append(i)
            room -= s
        if room:
            bisect.insort(rooms, (room, b))
    return bins


def holds(big: tuple[int, ...], small: tuple[int, ...]) -> bool:
    """Whether the items ``small`` fit, first-fit decreasing, into containers of the sizes ``big``."""
    rooms = sorted(big)
    for s in small:
        k = bisect.bisect_left(rooms, s)
        if k == len(rooms):
            return False
        rooms[k] -= s
        rooms.sort()
    return True


def forced_waste(sizes: list[int], capacity: int) -> int:
    """Room that any packing of sizes (descending) must leave in its containers.

    From the largest item on, the room beside an item can only be filled by smaller items
    that fit there; what they can't fill is lost.
    """
    waste, carried, low = 0, 0, len(sizes)
    high = 0
    while high < low:
        room = capacity - sizes[high]
        while low > high + 1 and sizes[low - 1] <= room:
            low -= 1
            carried += sizes[low]
        if carried < room:
            waste += room - carried
            carried = 0
        else:
            carried -= room
        high += 1
    return waste


def least_containers(sizes: list[int], capacity: int) -> int:
    """Lower bound on the containers of sizes (descending)."""
    return -(-(sum(sizes) + forced_waste(sizes, capacity)) // capacity)


def fillings(items: list[int], room: int, allowed: int, tries: int) -> tuple[list[tuple[int, ...]], bool]:
    """Undominated fillings of room by items (ascending, each at most room) that waste at most ``allowed``.

    Least waste first, then larger items first. The flag tells whether ``tries`` left some out.
    """
    mask = (1 << (room + 1)) - 1
    upto = [1]  # bit s of upto[i]: items[:i] has a subset with the sum s
    for s in items:
        upto.append((upto[-1] | upto[-1] << s) & mask)
    out: list[tuple[int, ...]] = []
    left_out = False

    def sets(i: int, rest: int, taken: tuple[int, ...]):
        """Subsets of items[:i] with the sum rest, larger items first."""
        if rest == 0:
            yield taken
            return
        last = None
        for j in range(bisect.bisect_right(items, rest, 0, i) - 1, -1, -1):
            s = items[j]
            if s != last and upto[j] >> (rest - s) & 1:
                yield from sets(j, rest - s, (*taken, s))
            last = s
            if not upto[j] >> rest & 1:  # smaller items alone can't make it
                return

    floor = max(room - allowed, 0)
    sums = upto[-1] >> floor
    while sums:
        total = sums.bit_length() - 1 + floor
        sums ^= 1 << (total - floor)
        met = 0
        for f in sets(len(items), total, ()):
            met += 1
            if met > tries or len(out) >= tries:
                left_out = True
                break
            waste = room - total
            unused = next((s for s in items if items.count(s) > f.count(s)), None) if waste else None
            if unused is not None and unused <= waste:
                continue  # not full: a filling with that item dominates it
            if not any(len(g) <= len(f) and holds(g, f) for g in out):
                out.append(f)
        if len(out) >= tries:
            return out, left_out or bool(sums)
    return out, left_out


def complete(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES, tries: int = TRIES) -> tuple[list[list[int]], dict[str, int]]:
    """Packs sizes (descending, each in 1..capacity).

    Gives the containers as lists of places in ``sizes`` and what the search did: the
    containers of best fit, the lower bound, opened containers, and whether the result is
    proven to be the fewest (it meets the bound, or nothing was left out).
    """
    best = best_fit(sizes, capacity)
    bound = least_containers(sizes, capacity)
    did = {"best_fit": len(best), "bound": bound, "opened": 0, "proven": 1}
    if len(best) <= bound:
        return best, did
    total = sum(sizes)
    most = (len(best) - 1) * capacity - total  # waste of a packing with one container less than the incumbent
    items = sizes[::-1]  # ascending, those left
    used, all_tried = 0, True
    path: list[tuple[int, ...]] = []
    found: list[tuple[int, ...]] | None = None
    stack: list[list[tuple[int, ...]]] = []

    def take(f: tuple[int, ...]) -> None:
        for s in f:
            items.pop(bisect.bisect_left(items, s))

    def open_bin() -> list[tuple[int, ...]]:
        nonlocal all_tried
        if used + forced_waste(items[::-1], capacity) > most:
            return []
        big = items.pop()
        room = capacity - big
        out, left_out = fillings(items[: bisect.bisect_right(items, room)], room, most - used, tries)
        items.append(big)
        all_tried &= not left_out
        return [(big, *f) for f in out[::-1]]

    def back() -> None:
        nonlocal used
        f = path.pop()
        for s in f:
            bisect.insort(items, s)
        used -= capacity - sum(f)

    stack.append(open_bin())
    while stack and did["opened"] < nodes:
        if not stack[-1]:
            stack.pop()
            if path:
                back()
            continue
        f = stack[-1].pop()
        waste = capacity - sum(f)
        if used + waste > most:
            continue
        did["opened"] += 1
        take(f)
        path.append(f)
        used += waste
        if items:
            stack.append(open_bin())
            continue
        found = list(path)  # a better incumbent
        most = (len(found) - 1) * capacity - total
        if len(found) <= bound:
            break
        back()
    did["proven"] = int((found is not None and len(found) <= bound) or (not stack and all_tried))
    if found is None:
        return best, did
    places: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        places.setdefault(s, []).append(i)
    return [[places[s].pop() for s in f] for f in found], did


_KEY = ["id", "n", "part", "copy"]


def _packer(capacity: int, nodes: int, tries: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", *_KEY], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        bins, did = complete(pdf["size"].tolist(), capacity, nodes, tries)
        seq = [0] * len(pdf)
        for b, items in enumerate(bins):
            for i in items:
                seq[i] = b
        pdf["seq"] = seq
        fill = pdf.groupby("seq")["size"].transform("sum")
        first = pd.Series([json.dumps({**did, "used": len(bins)})] + [None] * (len(pdf) - 1), dtype=object)
        return pdf.assign(fill=fill, did=first)[[*_KEY, "size", "round", "grp", "seq", "fill", "did"]]

    return run


ship_by_value(sys.modules[__name__])

_OUT = "id bigint, n int, part int, copy int, size int, round int, grp bigint, seq int, fill int, did string"


def items(sizes: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY) -> DataFrame:
    """``(id, n, part, size, copy)``: full parts of oversized items, then the rest; whole items have part 0.

    n is the item's own size; copy counts equal (id, n, part).
    """
    n = F.col(size_col).cast("int")
    rows = sizes.filter(n > 0).groupBy(F.col(id_col).cast("long").alias("id"), n.alias("n")).agg(F.count("*").alias("times"))
    parts = F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)
    copies = F.sequence(F.lit(0), (F.col("times") - 1).cast("int"))
    cut = rows.withColumn("copy", F.explode(copies)).withColumn("part", F.explode(parts))
    return cut.select("id", "n", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).cast("int").alias("size"), "copy")


def _deal(df: DataFrame, groups: int, no: int) -> DataFrame:
    key: Column = F.pmod(F.xxhash64(F.lit(no), *_KEY), F.lit(groups))
    return df.select(*_KEY, "size", F.lit(no).alias("round"), key.alias("grp"))


def _rounds(sizes: DataFrame, id_col: str, size_col: str, capacity: int, group: int, nodes: int, tries: int) -> tuple[DataFrame, list[DataFrame]]:
    """The items that fill containers alone, and the packed items of each round with a flag ``last`` on those that stay."""
    todo = materialize(items(sizes, id_col, size_col, capacity), "items")
    full = todo.filter(F.col("size") == capacity)
    todo = todo.filter(F.col("size") < capacity)
    loose = F.col("fill") < int(capacity * (1 - SLACK))
    packed, before, no = [], None, 0
    while True:
        total = todo.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        groups = max(1, -(-total // (capacity * group)))
        done = materialize(by_key(_deal(todo, groups, no), "grp").groupBy("grp").applyInPandas(_packer(capacity, nodes, tries), _OUT), "packed")
        n_loose = done.filter(loose).select("grp", "seq").distinct().count()
        last = groups == 1 or (before is not None and n_loose * 2 > before)
        packed.append(done.withColumn("last", F.lit(True) if last else ~loose))
        if last:
            return full, packed
        todo, before, no = done.filter(loose).select(*_KEY, "size"), n_loose, no + 1


def pack(sizes: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = CAPACITY, group: int = GROUP, nodes: int = NODES, tries: int = TRIES) -> DataFrame:
    """``(id, n, part, copy, size, container, fill)``; container is unique, part counts an oversized item's pieces."""
    full, packed = _rounds(sizes, id_col, size_col, capacity, group, nodes, tries)
    out = full.select(*_KEY, "size", F.concat_ws("-", F.lit("full"), *_KEY).alias("container"), F.col("size").alias("fill"))
    for done in packed:
        out = out.unionByName(done.filter("last").select(*_KEY, "size", F.concat_ws("-", "round", "grp", "seq").alias("container"), "fill"))
    return out


def searched(sizes: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = CAPACITY, group: int = GROUP, nodes: int = NODES, tries: int = TRIES) -> DataFrame:
    """What the search did in each group: ``(round, grp, best_fit, bound, used, opened, proven)``.

    best_fit, bound and used count containers; a group whose best fit met the bound has
    opened 0; one that ended without proof has proven false and ``used - bound`` open.
    """
    _, packed = _rounds(sizes, id_col, size_col, capacity, group, nodes, tries)
    kind = "best_fit int, bound int, used int, opened int, proven int"
    each = [d.filter("did is not null").select("round", "grp", F.from_json("did", kind).alias("d")).select("round", "grp", "d.best_fit", "d.bound", "d.used", "d.opened", (F.col("d.proven") == 1).alias("proven")) for d in packed]
    out = each[0]
    for d in each[1:]:
        out = out.unionByName(d)
    return out
