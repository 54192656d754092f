"""Best-fit packing with Martello-Toth dominance reduction.

Only lengths matter for packing, and there are at most ``capacity`` of them,
so the instance is the histogram of lengths, whatever the number of pieces.
On it the driver

1. reduces: a set of at most three pieces that dominates every other set
   with its largest piece (nothing else fits; an exact fit; one piece at
   least as long as any that could take its place) is provably in some best
   packing and is fixed, as often as the counts allow;
2. packs the remainder best fit, longest first.

The result is a list of patterns with multiplicities, turned into intervals
(length, rank from, rank to) -> (sequence, offset).  Spark ranks the pieces of
each length (in salted groups, so a length that a third of all rows share is
no hot key) and looks the rank up.

Defined cases: pieces longer than the capacity or not positive raise; rows that repeat are
pieces of their own; an empty table packs into nothing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoded_batches
from .common import cut_lineage, fresh

CAPACITY = 2048
SALTS = 256


def _fit_two(sizes: list[int], left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The pair with the largest sum that fits ``room`` (the first the larger)."""
    best, i, j = None, 0, len(sizes) - 1
    while i <= j:
        a, b = sizes[i], sizes[j]
        if a + b > room:
            j -= 1
            continue
        if (i < j or left[a] > 1) and (best is None or a + b >= best[0] + best[1]):
            best = (b, a)
        i += 1
    return best


def dominating(counts: dict[int, int], j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of length ``j`` that dominates all others, if the
    criterion finds one."""
    left = dict(counts)
    left[j] -= 1
    if not left[j]:
        del left[j]
    room = capacity - j
    sizes = sorted(left)
    smallest, many = 0, 0
    for s in sizes:                                    # how many of the smallest fit beside j
        take = min(left[s], 3 - many, (room - smallest) // s)
        many, smallest = many + take, smallest + take * s
        if many == 3 or take < left[s]:
            break
    if not many:
        return (j,)
    largest = sizes[bisect_left(sizes, room + 1) - 1]
    if largest == room or many == 1:
        return (j, largest)
    if many == 2:
        pair = _fit_two(sizes, left, room)
        if pair is None or largest >= pair[0] + pair[1]:
            return (j, largest)
        a, b = pair
        between = [s for s in sizes if b < s < a for _ in range(min(2, left[s]))]
        if a == largest and (len(between) < 2 or between[0] + between[1] > room):
            return (j, a, b)
    return None


def reduce_instance(counts: dict[int, int], capacity: int):
    """Fixed patterns [(lengths, times)] and the counts that remain."""
    counts = {s: n for s, n in counts.items() if n}
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for j in sorted(counts, reverse=True):
            while counts.get(j):
                found = dominating(counts, j, capacity)
                if found is None:
                    break
                times = min(counts[s] // found.count(s) for s in set(found))
                fixed.append((found, times))
                changed = True
                for s in found:
                    counts[s] -= times
                for s in set(found):
                    if not counts[s]:
                        del counts[s]
    return fixed, counts


def best_fit(counts: dict[int, int], capacity: int):
    """Best fit, longest first, over lengths with counts."""
    room_left: list[int] = []                          # sorted rooms that some open pattern has
    at: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern, times):
        room = capacity - sum(pattern)
        if room not in at:
            insort(room_left, room)
            at[room] = []
        at[room].append((pattern, times))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            i = bisect_left(room_left, s)
            if i == len(room_left):
                each = capacity // s
                if n // each:
                    put((s,) * each, n // each)
                if n % each:
                    put((s,) * (n % each), 1)
                break
            room = room_left[i]
            pattern, times = at[room].pop()
            if not at[room]:
                del at[room], room_left[i]
            take = min(n, times)
            if times > take:
                put(pattern, times - take)
            put((*pattern, s), take)
            n -= take
    return [x for found in at.values() for x in found]


def solve(counts: dict[int, int], capacity: int = CAPACITY):
    """Patterns [(lengths, times)] that hold exactly the given pieces."""
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def intervals(patterns) -> dict[str, np.ndarray]:
    """Arrays sorted by (length, first rank): which sequence and offset the
    pieces of a length and rank go to.  As many rows as patterns have places."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for s in pattern:
            rank = used.get(s, 0)
            rows.append((s, rank, sequence, offset))
            used[s] = rank + times
            offset += s
        sequence += times
    rows.sort()
    cols = list(zip(*rows)) or [()] * 4
    return {k: np.array(c, np.int64) for k, c in zip(("length", "rank", "sequence", "offset"), cols)}


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY,
         sequence_col: str = "sequence_id", offset_col: str = "offset") -> DataFrame:
    """All columns of ``pieces`` plus sequence and offset (existing columns of
    these names are replaced)."""
    pieces = pieces.drop(sequence_col, offset_col)
    names = pieces.columns
    uid, rank = fresh(names, "pack_uid"), fresh(names, "pack_rank")
    salt, n, before = fresh(names, "pack_salt"), fresh(names, "pack_n"), fresh(names, "pack_before")
    length = F.col(f"`{length_col}`").cast("long")
    ok = F.when(length.between(1, capacity), length).otherwise(
        F.raise_error(F.lit(f"lengths must be from 1 to {capacity}")).cast("long"))
    stored = cut_lineage(pieces.withColumn(length_col, ok).withColumn(uid, F.monotonically_increasing_id())
                         .withColumn(salt, F.pmod(F.xxhash64(uid), F.lit(SALTS)).cast("int")))
    counts = {r[0]: r[1] for r in stored.groupBy(length_col).count().collect()}     # at most `capacity` rows
    table = intervals(solve(counts, capacity))

    groups = stored.groupBy(length_col, salt).agg(F.count(F.lit(1)).alias(n))
    by_length = Window.partitionBy(length_col).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn(before, F.coalesce(F.sum(n).over(by_length), F.lit(0))).drop(n)
    ranked = stored.withColumn(rank, F.row_number().over(Window.partitionBy(length_col, salt).orderBy(uid)))
    ranked = ranked.join(groups, [length_col, salt]).withColumn(rank, F.col(rank) - 1 + F.col(before))
    ranked = ranked.select(*[F.col(f"`{c}`") for c in names], F.col(rank).cast("long").alias(rank))
    at = names.index(length_col)
    # lengths and ranks as one sortable number; ranks stay below 2**50
    starts = table["length"] * (1 << 50) + table["rank"]

    def place(batches):
        for batch in batches:
            size = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(len(names)).to_numpy(zero_copy_only=False)
            i = np.searchsorted(starts, size * (1 << 50) + r, side="right") - 1
            columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(table["sequence"][i] + r - table["rank"][i]), pa.array(table["offset"][i])],
                names=[*names, sequence_col, offset_col])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop(rank).schema)
    return ranked.mapInArrow(place, out + f", `{sequence_col}` long, `{offset_col}` long")


def cut_points(tokens: int, capacity: int) -> np.ndarray:
    """Starts of a document's pieces: only longer ones are cut, the first piece
    takes what full pieces leave."""
    first = tokens % capacity or capacity
    return np.r_[0, np.arange(first, tokens, capacity)]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its
    ids, ``end_id`` after them, cut into pieces of at most ``capacity``.  A null
    text is empty.  ``ids_crc32`` checks the ids as little-endian unsigned 32-bit."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for ids_of, _, ids, counts, _ in encoded_batches(batches, path):
            doc, piece, start, length, crc, tokens = [], [], [], [], [], []
            at = 0
            for d, count in zip(ids_of, counts):
                own = np.append(ids[at:at + count], np.int32(end_id)).astype("<u4")
                at += count
                cuts = np.append(cut_points(len(own), capacity), len(own))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(d)
                    piece.append(k)
                    start.append(int(a))
                    length.append(int(b - a))
                    crc.append(zlib.crc32(own[a:b].tobytes()))
                    tokens.append(own[a:b].astype(np.int32))
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                off = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int32)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(off), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return source.mapInArrow(run, ddl)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token sequences; one holds at most the
    capacity, so a group is bounded."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
