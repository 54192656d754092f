"""First occurrence of a key among all documents, as one packed exchange.

Map tasks turn documents into *entries* ``(k1, k2, doc, lo, hi)``: an
occurrence of the key ``(k1, k2)`` in document ``doc`` that stands for the
positions ``lo..hi``.  Entries travel as packed column blocks, one row per
bucket of ``k1`` and batch of documents, because tens of millions of narrow
rows would cost more in row overhead than in payload.  Before they leave,
a batch keeps only its first occurrence of each key (later ones are already
known to be repeats), so a key that is in a third of all documents costs
one entry per batch.

``within``: a later occurrence in the same document is a repeat too.
``context``: occurrences that share ``k1`` but differ in ``k2`` are reported
as ``NEED`` (the caller then looks closer); keys alone in their ``k1`` are not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, shuffle_width

ENTRY, REPEAT, NEED = 1, 0, 2
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("base", pa.int64()), ("data", pa.binary())])
PACKED_DDL = "bucket int, kind int, base long, data binary"
FOUND = pa.schema([("doc_id", pa.int64()), ("kind", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
FOUND_DDL = "doc_id long, kind int, lo int, hi int"
BUCKETS_PER_TASK = 6             # evens out how buckets fall on tasks; a task holds one at a time
_RECORD = 8 + 6 + 8 + 4 + 2


def _pack(k1, k2, doc, lo, hi):
    """Column block; doc relative to the block's base, hi relative to lo."""
    base = int(doc.min()) if len(doc) else 0
    return base, b"".join((
        k1.tobytes(), k2.view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
        (doc - base).astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes(),
        lo.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), (hi - lo).astype(np.uint16).tobytes()))


def _unpack(base: int, data: bytes):
    n, at, out = len(data) // _RECORD, 0, []
    for width in (8, 6, 8, 4, 2):
        out.append(np.frombuffer(data, np.uint8, n * width, at))
        at += n * width
    k2 = np.zeros((n, 8), np.uint8)
    k2[:, :6] = out[1].reshape(n, 6)
    doc = np.ascontiguousarray(out[2].reshape(8, n).T).view(np.int64).ravel() + base
    lo = np.ascontiguousarray(out[3].reshape(4, n).T).view(np.uint32).ravel().astype(np.int64)
    return out[0].view(np.uint64), k2.view(np.uint64).ravel(), doc, lo, lo + out[4].view(np.uint16)


def _merge_ranges(doc, lo, hi):
    """Adjacent or overlapping ranges of one document become one."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    shift = np.zeros(len(doc), np.int64)
    shift[1:] = np.cumsum(doc[1:] != doc[:-1])
    wide = np.int64(1 << 33)
    reach = np.maximum.accumulate(hi + shift * wide)
    new = np.ones(len(doc), bool)
    new[1:] = lo[1:] + shift[1:] * wide > reach[:-1] + 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], lo[first], reach[last] - shift[last] * wide


def _split(k1, k2, doc, lo, hi, within: bool, context: bool):
    """Masks over entries sorted by (k1, k2, doc, lo): repeats, those that need
    a closer look, those to pass on."""
    n = len(k1)
    new1 = np.ones(n, bool)
    new1[1:] = k1[1:] != k1[:-1]
    new2 = new1.copy()
    new2[1:] |= k2[1:] != k2[:-1]
    head = np.maximum.accumulate(np.where(new2, np.arange(n), 0))
    repeat = doc > doc[head]
    if within:
        repeat |= lo > lo[head]
    group1 = np.cumsum(new1) - 1
    if not context:
        return repeat, np.zeros(n, bool), ~repeat
    kinds = np.bincount(group1[new2], minlength=group1[-1] + 1)
    need = ~repeat & (kinds[group1] > 1)
    nth = np.cumsum(new2) - np.cumsum(new2)[np.flatnonzero(new1)[group1]]      # number of the key within its k1
    return repeat, need, ~repeat & (nth < 2)        # two keys suffice to tell the others that k1 has several


def _sorted(k1, k2, doc, lo, hi):
    order = np.argsort(k1, kind="stable")
    k1s = k1[order]
    same = np.zeros(len(k1), bool)
    same[1:] = k1s[1:] == k1s[:-1]
    same[:-1] |= same[1:]
    some = order[same]                               # only keys that occur again need the full order
    some = some[np.lexsort((lo[some], doc[some], k2[some], k1[some]))]
    return order[~same], some


def pack_entries(entries, buckets: int, within: bool, context: bool):
    """Entries of a batch -> record batches of the packed schema."""
    k1, k2, doc, lo, hi = entries
    if not len(k1):
        return
    k2 = k2 & np.uint64((1 << 48) - 1)
    alone, some = _sorted(k1, k2, doc, lo, hi)
    keep = alone
    rows = []
    if len(some):
        repeat, need, send = _split(k1[some], k2[some], doc[some], lo[some], hi[some], within, context)
        for kind, mask in ((REPEAT, repeat), (NEED, need)):
            d, a, b = _merge_ranges(doc[some[mask]], lo[some[mask]], hi[some[mask]])
            if len(d):
                data = b"".join((d.astype(np.int64).tobytes(), a.astype(np.int64).tobytes(), b.astype(np.int64).tobytes()))
                rows.append((int(k1[some[0]] % np.uint64(buckets)), kind, 0, data))
        keep = np.concatenate((alone, some[send]))
    bucket = (k1[keep] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keep, bucket = keep[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for part in np.split(keep, cut):
        if len(part):
            base, data = _pack(k1[part], k2[part], doc[part], lo[part], hi[part])
            rows.append((int(k1[part[0]] % np.uint64(buckets)), ENTRY, base, data))
    if rows:
        yield record_batch(PACKED, list(zip(*rows)))


def _settle(blocks, within: bool, context: bool):
    """All entries of one bucket -> ranges that repeat or need a closer look."""
    if not blocks:
        return
    cols = [np.concatenate(c) for c in zip(*blocks)]
    _, some = _sorted(*cols)
    if not len(some):
        return
    cols = [c[some] for c in cols]
    repeat, need, _ = _split(*cols, within, context)
    for kind, mask in ((REPEAT, repeat), (NEED, need)):
        doc, lo, hi = _merge_ranges(cols[2][mask], cols[3][mask], cols[4][mask])
        step = 1 << 16
        for at in range(0, len(doc), step):
            s = slice(at, at + step)
            yield record_batch(FOUND, (doc[s], np.full(len(doc[s]), kind, np.int32),
                                       lo[s].astype(np.int32), hi[s].astype(np.int32)))


def _reduce(batches, within: bool, context: bool):
    """Rows sorted by bucket: one bucket is held at a time, the sort is Spark's and spills."""
    blocks, current = [], None
    for batch in batches:
        buckets, kinds, bases, datas = (batch.column(i) for i in range(4))
        for i in range(batch.num_rows):
            kind, data = kinds[i].as_py(), datas[i].as_py()
            if kind == ENTRY:
                if buckets[i].as_py() != current:
                    yield from _settle(blocks, within, context)
                    blocks, current = [], buckets[i].as_py()
                blocks.append(_unpack(bases[i].as_py(), data))
            else:
                doc, lo, hi = np.frombuffer(data, np.int64).reshape(3, -1)
                yield record_batch(FOUND, (doc, np.full(len(doc), kind, np.int32), lo.astype(np.int32), hi.astype(np.int32)))
    yield from _settle(blocks, within, context)


def find_repeats(frame: DataFrame, entries_of, within: bool = False, context: bool = False) -> DataFrame:
    """``entries_of(batches)`` yields entry arrays; returns (doc_id, kind, lo, hi)."""
    width = shuffle_width(frame.sparkSession)
    buckets = width * BUCKETS_PER_TASK

    def emit(batches):
        for entries in entries_of(batches):
            yield from pack_entries(entries, buckets, within, context)

    def found(batches):
        yield from _reduce(batches, within, context)

    packed = frame.mapInArrow(emit, PACKED_DDL).repartition(width, F.col("bucket")).sortWithinPartitions("bucket")
    return packed.mapInArrow(found, FOUND_DDL)


def ranges_by_doc(found: DataFrame) -> DataFrame:
    """(doc_id, lo, hi) rows -> one row per document with its ranges."""
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
