"""Sharding: equal texts stay together, and the largest of a given number of shards is as small as possible.

The groups of equal texts stand in the order of a hash of their text. The smallest capacity
with which a greedy walk needs no more than the wanted number of shards is found by binary
search, and the order is cut there. The driver never sees the single groups of the whole
table, only totals of ranges of hashes: 4096 at first, of which those that a cut can hit are
split further by the next bits of the hash. The capacity is known when the walk that takes
ranges whole needs no more than the walk that may cut ranges of several groups anywhere.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.naming import unused
from cardwarden.llm.storage import stored

#: Bits of the hash that make the first ranges, and by which a range is split.
FIRST_BITS, MORE_BITS = 12, 8
#: A range of several groups with more than this share of all bytes is split in any case.
HEAVY = 1 / 1024
#: The rows of a shard are numbered in so many parts, so that no task numbers a large shard alone.
PARTS = 1024


@dataclass(frozen=True)
class Range:
    """Hashes from ``start`` on that agree in their first ``depth`` bits, and what occurs there."""

    start: int
    depth: int
    size: int
    largest: int
    groups: int


def text_key(text: Column) -> Column:
    """64-bit hash as a number whose order is that of its bits. Null texts are one group."""
    return F.xxhash64(text)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes plus one; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _walk(ends: list[int], capacity: int, begin: int, shards: int) -> list[int]:
    """Where each shard ends if it takes as many items as fit; ``ends`` has running totals from 0 on."""
    cuts = []
    for _ in range(shards):
        begin = max(begin, bisect_right(ends, ends[begin] + capacity) - 1)
        cuts.append(begin)
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity with which a greedy walk over the sizes needs no more than ``shards`` shards."""
    ends = [0]
    for size in sizes:
        ends.append(ends[-1] + size)
    low, high = max([-(-ends[-1] // shards), *sizes], default=0), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if _walk(ends, middle, 0, shards)[-1] == len(sizes):
            high = middle
        else:
            low = middle + 1
    return low


def contiguous_cuts(sizes: list[int], shards: int) -> list[int]:
    """Item with which each shard but the first begins; no shard exceeds the smallest capacity.

    Filling each shard to the capacity could leave the last ones empty. So a shard ends as near
    as possible to an equal part of what is left, but neither beyond the capacity nor so early
    that the rest wouldn't fit.
    """
    capacity = smallest_capacity(sizes, shards)
    ends = [0]
    for size in sizes:
        ends.append(ends[-1] + size)
    earliest = [len(sizes)]  # first item from which on the rest fits into k more shards
    for _ in range(shards - 1):
        earliest.append(bisect_left(ends, ends[earliest[-1]] - capacity))
    cuts, begin = [], 0
    for left in range(shards, 1, -1):
        low = max(begin, earliest[left - 1])
        high = max(low, bisect_right(ends, ends[begin] + capacity) - 1)
        aim = ends[begin] + (ends[-1] - ends[begin]) / left
        at = min(max(bisect_left(ends, aim), low), high)
        if at > low and aim - ends[at - 1] <= ends[at] - aim:
            at -= 1
        cuts.append(at)
        begin = at
    return cuts


def _loose_walk(ranges: list[Range], ends: list[int], capacity: int, shards: int) -> list[int]:
    """Range in which each shard ends if those of several groups could be cut anywhere."""
    total, cuts = 0, []
    for _ in range(shards):
        full = total + capacity
        i = bisect_right(ends, full) - 1
        if i < len(ranges):
            total = full if ranges[i].groups > 1 else max(total, ends[i])
        else:
            total = ends[-1]
        cuts.append(min(i, len(ranges)))
    return cuts


def _to_split(ranges: list[Range], shards: int) -> list[Range]:
    """Ranges to split next; none when the smallest capacity is known."""
    ends = [0]
    for r in ranges:
        ends.append(ends[-1] + r.size)
    if heavy := [r for r in ranges if r.groups > 1 and r.size > HEAVY * ends[-1]]:
        return heavy
    whole = smallest_capacity([r.size for r in ranges], shards)
    low, high = max([-(-ends[-1] // shards), *(r.largest for r in ranges)], default=0), whole
    while low < high:
        middle = (low + high) // 2
        if _loose_walk(ranges, ends, middle, shards)[-1] == len(ranges):
            high = middle
        else:
            low = middle + 1
    if low == whole:
        return []
    spans = zip(_walk(ends, low, 0, shards), _loose_walk(ranges, ends, whole, shards), strict=True)
    inside = {i for first, last in spans for i in range(first, min(last + 1, len(ranges)))}
    return [ranges[i] for i in sorted(inside) if ranges[i].groups > 1]


def _totals(groups: DataFrame, depth: int) -> list[Range]:
    start = F.shiftleft(F.shiftright("key", 64 - depth), 64 - depth)
    rows = groups.groupBy(start.alias("start")).agg(F.sum("size"), F.max("size"), F.count("*")).collect()
    return [Range(r[0], depth, r[1], r[2], r[3]) for r in rows]


def cut_keys(groups: DataFrame, shards: int) -> list[int]:
    """First key of each shard but the first, for groups (key, size) with distinct keys.

    At most a few hundred ranges are split at a time, so that the driver holds some ten
    thousand totals at any size of the table.
    """
    ranges = sorted(_totals(groups, FIRST_BITS), key=lambda r: r.start)
    while open_ranges := _to_split(ranges, shards):
        by_depth: dict[int, list[int]] = {}
        for r in open_ranges:
            by_depth.setdefault(r.depth, []).append(r.start)
        finer = []
        for depth, starts in by_depth.items():
            own = groups.where(F.shiftleft(F.shiftright("key", 64 - depth), 64 - depth).isin(starts))
            finer += _totals(own, min(64, depth + MORE_BITS))
        ranges = sorted([*(set(ranges) - set(open_ranges)), *finer], key=lambda r: r.start)
    cuts = contiguous_cuts([r.size for r in ranges], shards)
    return [ranges[i].start if i < len(ranges) else None for i in cuts]


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The documents' columns and ``sharding``, a struct of size, law, shard, slot and grown_shard.

    ``docs`` has doc_id and text; an extra column of the name ``sharding`` is replaced, others
    are kept. Size is UTF-8 bytes plus one; a null text has size 1, and null texts are one
    group, as are empty ones. The law is ``bytes``: sizes near equal, as far as whole groups
    allow. No shard exceeds the smallest possible maximum for the order of the groups. With
    fewer groups than shards some shards are empty. Slots number a shard's rows from 0 in the
    order of a hash of the id; rows that agree in id and text share their slots in any order.
    An empty table stays empty. ``grown_shard`` is null, as adding a shard moves every cut.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key, size, number, part, mark, s, p = unused(docs, "_key", "_size", "_shard", "_part", "_mark", "_s", "_p")
    keyed = docs.drop("sharding").withColumns({key: text_key(F.col("text")), size: text_bytes(F.col("text"))})
    groups = stored(keyed.groupBy(F.col(key).alias("key")).agg(F.sum(size).alias("size")), "groups")
    place = F.lit(0)
    for first in cut_keys(groups, shards):
        if first is not None:
            place = place + (F.col(key) >= first).cast("int")
    hashed = F.xxhash64(F.lit(17), F.col("doc_id"))
    dealt = keyed.withColumns({number: place, mark: hashed, part: F.pmod(F.shiftrightunsigned(hashed, 20), F.lit(PARTS)).cast("int")})
    before = Window.partitionBy(s).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(F.col(number).alias(s), F.col(part).alias(p)).agg(F.count("*").alias("n"))
    offsets = counts.select(s, p, F.struct(F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).alias("sharding"))
    rank = F.row_number().over(Window.partitionBy(number, part).orderBy(mark, "doc_id", key, size))
    made = F.struct(
        F.col(size).alias("size"),
        F.lit("bytes").alias("law"),
        F.col(number).alias("shard"),
        (F.col("sharding.offset") + rank - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    joined = dealt.join(offsets, (F.col(number) == F.col(s)) & (F.col(part) == F.col(p)))
    return joined.select(*[c for c in docs.columns if c != "sharding"], made.alias("sharding"))
