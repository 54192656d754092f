"""Substring dedup by recompression (locally consistent naming).

A text is a sequence of words.  Two rounds rename it: runs of one word and
then *pairs* (a symbol coloured left followed by one coloured right; the
colour is a bit of the symbol's name) become symbols.  Names are hashes of
what they stand for, so every task gives equal strings equal names without
asking anybody, and a decision depends on three words to either side only:
the interior of a repeated passage is parsed alike wherever it stands.

Each window of ``window`` words is represented by the smallest second-round
symbol in its interior.  Windows that chose the same symbol form an entry:
``k1`` names the symbol with its determined context (7 words), ``k2`` the
whole stretch its windows cover.  One exchange over the names then tells

* equal stretches: all windows of the later document repeat, verified by
  ``k2``, which covers every word of every one of them;
* equal symbols in different stretches (the edges of passages): the windows
  concerned are named one by one and compared in a second, small exchange.

Nothing is sampled and no pairs are formed; a name costs at most one entry
per batch of documents.

Defined cases: a null, empty or blank text has no words and stays as it is;
a document with fewer words than the window loses nothing; a document with a null id
neither loses words nor makes others lose them; rows that repeat a doc_id
are the same document, so they never remove each other's words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, hash_words, keyed, mix, odd_constants, record_batch, text_batches
from .firstseen import NEED, REPEAT, find_repeats, ranges_by_doc

WINDOW = 13
RADIUS = 3                                   # words to either side that fix a second-round symbol
_C = odd_constants(64, 11)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASES = (int(_C[40]), int(_C[41]))


def _powers(n: int, base: int):
    """base**i and its inverse modulo 2**64."""
    inverse = np.uint64(pow(base, -1, 1 << 64))
    up = np.full(n, np.uint64(base))
    down = np.full(n, inverse)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def window_names(h: np.ndarray, window: int, base: int) -> np.ndarray:
    """Name of the ``window`` words that start at each position."""
    n = len(h)
    up, down = _powers(n, base)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up, out=total[1:])
    m = max(0, n - window + 1)
    return mix((total[window:window + m] - total[:m]) * down[:m])


def _colour(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(17)) & np.uint64(1) == 1


def symbols(h: np.ndarray) -> np.ndarray:
    """Two rounds of run and pair naming: the name of the second-round symbol
    that starts at a position, the largest value where none starts."""
    n = len(h)
    out = np.full(n, _TOP)
    if n < 2:
        return out
    same = h[1:] == h[:-1]
    run = np.zeros(n, bool)
    run[1:] |= same
    run[:-1] |= same
    right = _colour(h)
    pair = np.zeros(n, bool)
    pair[:-1] = ~run[:-1] & ~run[1:] & ~right[:-1] & right[1:]
    start = np.ones(n, bool)
    start[1:] = ~pair[:-1] & ~same
    name = h * _C[0]
    name[run] = h[run] * _C[1]
    at = np.flatnonzero(pair)
    name[at] = h[at] * _C[2] + h[at + 1] * _C[3]
    first = np.flatnonzero(start)
    name = mix(name[first])
    right = _colour(name)
    joined = np.zeros(len(first), bool)
    joined[1:] = (name[1:] == name[:-1]) | (~right[:-1] & right[1:])
    out[first[~joined]] = name[~joined]
    return out


def entries(docs: np.ndarray, lens: np.ndarray, h: np.ndarray, window: int = WINDOW):
    """Entry arrays of a batch: ``docs`` ids, ``lens`` words of each, ``h`` their
    word hashes one after another."""
    n = len(h)
    if n < window:
        return None
    begin = np.repeat(np.cumsum(lens) - lens, lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(n)
    order = symbols(h)
    m = n - window + 1
    span = window - 2 * RADIUS
    best = order[RADIUS:RADIUS + m].copy()
    at = np.zeros(m, np.int64)
    for k in range(1, span):
        other = order[RADIUS + k:RADIUS + k + m]
        less = other < best
        best[less] = other[less]
        at[less] = k
    p = np.flatnonzero(left[:m] >= window)
    if not len(p):
        return None
    anchor = p + RADIUS + at[p]
    cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first, last = p[np.r_[0, cut]], p[np.r_[cut - 1, len(p) - 1]]
    anchor = anchor[np.r_[0, cut]]
    k1 = np.zeros(len(anchor), np.uint64)
    for j in range(-RADIUS, RADIUS + 1):
        k1 += h[anchor + j] * _C[8 + j + RADIUS]
    names = window_names(h, window, _BASES[0])
    k2 = mix(names[first] * _C[20] + names[last] * _C[21] + (anchor - first).astype(np.uint64) * _C[22]
             + (last - first).astype(np.uint64) * _C[23])
    doc = np.repeat(docs, lens)[first]
    return mix(k1), k2, doc, first - begin[first], last - begin[first]


def _hashed(batches):
    """Batches of documents as (ids, words of each, word hashes)."""
    for ids, texts in text_batches(batches):
        known = [(i, hash_words(t)) for i, t in zip(ids, texts) if i is not None and t]
        if known:
            yield (np.array([i for i, _ in known], np.int64), np.array([len(h) for _, h in known], np.int64),
                   np.concatenate([h for _, h in known]))


def _windows_needed(batches):
    """Named windows of the ranges a document needs looked at: entries with one
    position each, ``k1`` and ``k2`` two independent names."""
    window = WINDOW
    for batch in batches:
        ranges = batch.column(2)
        at = 0
        for ids, texts in text_batches([batch]):
            found = []
            for i, (doc, text) in enumerate(zip(ids, texts)):
                h = hash_words(text or b"")
                if len(h) < window:
                    continue
                need = _positions(ranges[at + i], len(h) - window + 1)
                a, b = (window_names(h, window, base)[need] for base in _BASES)
                found.append((a, b, np.full(len(need), doc, np.int64), need, need))
            at += len(ids)
            if found:
                yield tuple(np.concatenate(c) for c in zip(*found))


def _positions(ranges, limit: int) -> np.ndarray:
    """Positions covered by a list scalar of (lo, hi), below ``limit``."""
    return np.flatnonzero(_cover(ranges, limit, 1))


def _cover(ranges, n: int, width: int) -> np.ndarray:
    """Mask over ``n`` places: those in some lo..hi + width - 1."""
    step = np.zeros(n + 1, np.int32)
    values = ranges.values
    if values is not None and len(values):
        lo = np.minimum(values.field("lo").to_numpy(zero_copy_only=False), n)
        hi = np.minimum(values.field("hi").to_numpy(zero_copy_only=False) + width, n)
        np.add.at(step, lo, 1)
        np.add.at(step, hi, -1)
    return np.cumsum(step[:n]) > 0


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lo, hi): windows lo..hi (by first word) whose words also start
    in a document with a smaller id."""
    source = keyed(docs, id_col, text_col)

    def first_round(batches):
        for ids, lens, h in _hashed(batches):
            e = entries(ids, lens, h)
            if e is not None:
                yield e

    found = cut_lineage(find_repeats(source, first_round, context=True))
    need = ranges_by_doc(found.filter(F.col("kind") == NEED))
    edges = find_repeats(source.join(need.hint("shuffle_hash"), "doc_id"), _windows_needed)
    return (found.filter(F.col("kind") == REPEAT).unionByName(edges.filter(F.col("kind") == REPEAT))
            .select("doc_id", "lo", "hi"))


def _remove(data: bytes, gone: np.ndarray) -> bytes:
    """The text without the marked words; white space after a removed word goes
    with it, all other bytes stay."""
    out, word, at, n = [], 0, 0, len(data)
    white = b" \t\n\x0b\x0c\r"
    while at < n and data[at] in white:
        at += 1
    out.append(data[:at])
    for token in data.split():
        end = at + len(token)
        stop = end
        while stop < n and data[stop] in white:
            stop += 1
        if not gone[word]:
            out.append(data[at:stop])
        word, at = word + 1, stop
    return b"".join(out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   n_words: str = "n_words", n_removed: str = "n_removed") -> DataFrame:
    """All columns of ``docs`` with the text cut, plus the two counts (existing
    columns of these names are replaced)."""
    docs = docs.drop(n_words, n_removed)
    names = docs.columns
    ranges = fresh(names, "cut_ranges")
    cuts = ranges_by_doc(repeated_windows(docs, id_col, text_col)).select(
        F.col("doc_id").alias(fresh(names, "cut_doc")), F.col("ranges").alias(ranges))
    joined = docs.join(cuts.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(cuts.columns[0]), "left").select(
        *[F.col(f"`{c}`") for c in names], F.col(ranges))
    schema = docs.schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", {n_words} long, {n_removed} long"
    at = names.index(text_col)

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column(at).cast(pa.binary()), batch.column(len(names))
            new, total, gone = [], [], []
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                words = 0 if t is None else len(t.split())
                removed = 0
                if words and spans[i].is_valid:
                    mask = _cover(spans[i], words, WINDOW)
                    removed = int(mask.sum())
                    if removed:
                        t = _remove(t, mask)
                new.append(t)
                total.append(words)
                gone.append(removed)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(new, pa.binary()).cast(batch.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, n_words, n_removed])

    return joined.mapInArrow(cut, out)


def digest(cleaned: DataFrame) -> DataFrame:
    """doc_id, counts and the digest of the kept words joined by one space."""
    white = "[\\x20\\x09-\\x0D]+"
    kept = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), f"^{white}|{white}$", ""), white, " ")
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
