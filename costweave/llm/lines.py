"""Line dedup by winnowing over line hashes.

Fingerprints are window minima, and the windows are sized so that whatever the
rule removes is guaranteed to hold one:

* a *content* line (at least ``CONTENT`` words) is a window of its own and so always a
  fingerprint: any later occurrence of it is a repeat, wherever it stands;
* shorter lines are too common to go one by one.  Of ``WINNOW`` successive grams of ``GRAM`` lines the
  smallest (the rightmost of equals) is the fingerprint at which runs of ``RUN = GRAM + WINNOW - 1`` lines
  meet, so any repeated run of that many lines is found whatever they hold.

Positions are joined on the fingerprint and the window's hash: the first occurrence in (doc_id,
line) order stays, all others are repeats, also later ones in the same document.  A match at a
content line is extended both ways over the shorter lines beside it, up to the next content line
(which is a fingerprint itself): the hash of the window grown by one line at a time is joined
in the same exchange, so a line goes if the window from the content line to it stands earlier
somewhere.  Repeats that touch are one run; the run is deleted.

Defined cases: lines end at ``\\n`` and compare byte by byte; blank lines go only as
part of a longer run (a run of blank lines alone is no content and stays); a null text has no
lines and stays null; a document with a null id is left alone; rows that repeat a doc_id
with the same text are taken as one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, keyed, mix, odd_constants, text_batches
from .firstseen import REPEAT, find_repeats, ranges_by_doc
from .substring import _cover

CONTENT = 4                                  # words of a line that is a fingerprint by itself
GRAM = 2
WINNOW = 2
RUN = GRAM + WINNOW - 1                      # shortest run of any lines that is always found
_C = odd_constants(16, 23)
_BASE = int(odd_constants(1, 29)[0])         # of the rolling hash; odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _windows(h, first, last, up, down):
    """Hash of the lines ``first..last`` (arrays of places), by prefix sums."""
    weighted = h * up
    before = np.cumsum(weighted, dtype=np.uint64) - weighted
    return (before[last] + weighted[last] - before[first]) * down[first]


def _runs(h, empty, left, begin):
    """Windows of RUN lines: (place of the window, its smallest gram, its name)."""
    n = len(h)
    if n < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = np.zeros(n - GRAM + 1, np.uint64)
    for j in range(GRAM):
        grams += h[j:n - GRAM + 1 + j] * _C[j]
    grams = mix(grams)
    m = n - RUN + 1
    chosen = grams[:m].copy()
    place = np.zeros(m, np.uint64)
    for j in range(1, WINNOW):
        other = grams[j:j + m]
        smaller = other <= chosen
        chosen[smaller] = other[smaller]
        place[smaller] = j
    name = place * _C[8]
    void = np.ones(m, bool)
    for j in range(RUN):
        name += h[j:j + m] * _C[9 + j]
        void &= empty[j:j + m]
    p = np.flatnonzero((left[:m] >= RUN) & ~void)
    return p, chosen[p], mix(name)[p]


def _line_entries(batches):
    """Entries ``(k1, k2, doc, lo, hi)`` that stand for the lines lo..hi: content lines, their
    extension by each shorter line after and before them, and runs."""
    f = xxhash.xxh3_64_intdigest
    for ids, texts in text_batches(batches):
        hashes, docs, lens, words = [], [], [], []
        for doc, text in zip(ids, texts):
            if doc is None or not text:
                continue
            lines = text.split(b"\n")
            hashes.append(np.fromiter(map(f, lines), np.uint64, len(lines)))
            words.append(np.fromiter((len(x.split(None, CONTENT - 1)) for x in lines), np.int64, len(lines)))
            docs.append(doc)
            lens.append(len(lines))
        if not docs:
            continue
        h, count = np.concatenate(hashes), np.concatenate(words)
        lens = np.array(lens, np.int64)
        n, at = len(h), np.arange(len(h))
        begin = np.repeat(np.cumsum(lens) - lens, lens)
        end = begin + np.repeat(lens, lens) - 1
        full = count >= CONTENT
        # nearest content line before and after a shorter one, in the same document
        above = np.maximum.accumulate(np.where(full, at, -1))
        below = np.minimum.accumulate(np.where(full, at, n)[::-1])[::-1]
        down = np.flatnonzero(~full & (above >= begin))
        up = np.flatnonzero(~full & (below <= end))
        powers, inverse = _powers(_BASE, n), _powers(_INVERSE, n)
        after = mix(_windows(h, above[down], down, powers, inverse) + _C[12] * (down - above[down]).astype(np.uint64))
        before = mix(_windows(h, up, below[up], powers, inverse) + _C[13] * (below[up] - up).astype(np.uint64))
        one = np.flatnonzero(full)
        run, smallest, name = _runs(h, count == 0, end - at + 1, begin)
        place = np.concatenate((one, down, up, run))
        k1 = np.concatenate((h[one], after, before, smallest))
        k2 = np.concatenate((mix(h[one] + _C[3]), mix(after + _C[4]), mix(before + _C[5]), name))
        doc, lo = np.repeat(np.array(docs, np.int64), lens)[place], place - begin[place]
        hi = lo.copy()
        hi[len(hi) - len(run):] += RUN - 1
        yield k1, k2, doc, lo, hi


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lo, hi): lines lo..hi are repeats."""
    source = keyed(docs, id_col, text_col)
    return find_repeats(source, _line_entries, within=True).filter(F.col("kind") == REPEAT).select("doc_id", "lo", "hi")


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """All columns of ``docs`` with the text cut, plus the two counts (existing
    columns of these names are replaced)."""
    docs = docs.drop(n_lines, n_removed)
    names = docs.columns
    ranges = fresh(names, "cut_ranges")
    cuts = ranges_by_doc(cut_lineage(repeated_lines(docs, id_col, text_col))).select(
        F.col("doc_id").alias(fresh(names, "cut_doc")), F.col("ranges").alias(ranges))
    joined = docs.join(cuts.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(cuts.columns[0]), "left").select(
        *[F.col(f"`{c}`") for c in names], F.col(ranges))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {n_lines} long, {n_removed} long"
    at = names.index(text_col)

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column(at).cast(pa.binary()), batch.column(len(names))
            new, total, gone = [], [], []
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                count = 0 if t is None else t.count(b"\n") + 1
                removed = 0
                if count and spans[i].is_valid:
                    mask = _cover(spans[i], count, 1)
                    removed = int(mask.sum())
                    if removed:
                        t = b"\n".join(x for x, g in zip(t.split(b"\n"), mask) if not g)
                new.append(t)
                total.append(count)
                gone.append(removed)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(new, pa.binary()).cast(batch.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, n_lines, n_removed])

    return joined.mapInArrow(cut, out)


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_removed",
                          F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
