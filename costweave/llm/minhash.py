"""MinHash near-dedup with Order MinHash sketches and alignment.

A text is its sequence of 5-word shingles (one shingle of all words if it has
fewer).  A shingle is labelled with its occurrence number, so repeats count.
Each of ``SKETCHES`` sketches takes the ``ELL`` labelled shingles with the
smallest hashes under its own permutation and keeps them *in text order*;
texts that agree on a sketch are candidates.  Sketches miss near-duplicates of
few shingles, so a text of at most ``SHORT`` is found by the prefix rule instead:
of its ``n`` labelled shingles a near-duplicate has at least ``0.8 n``, so both
have the smallest common one among their ``n - ceil(0.8 n) + 1`` smallest, and
these are the keys.  Texts up to the length that is near a short one's carry
both kinds of keys.

Two texts are near-duplicates when an order-preserving alignment of their
shingles matches ``m`` of them with ``m / (n1 + n2 - m) >= 0.8``.  The
alignment is a greedy diagonal search restricted to the band of insertions
and deletions that this similarity leaves.

Texts with the same words are collapsed first (128-bit name).  Candidates
are examined in linear steps.  In each bucket every member is compared with
one pivot, the member that shares most buckets with others (an original,
where there is one).  What is left are members in different components, and
for those the comparison with the pivot ``p`` says what they must have in
common: ``x`` and ``y`` can only be near-duplicates if they share at least
``0.8 / 1.8 * (n_x + n_y) - min(c_x, c_y)`` shingles that ``p`` does not have,
``c`` being what each shares with ``p``.  So the members' shingles outside the
pivot (by the prefix rule, only as many of the smallest as needed) become
the next buckets; where that number is not positive the pair is compared at
once.  In the new buckets each member meets one pivot again, and last only
pairs of such a bucket that are still in different components and can share
that much are compared: two exact upper bounds on what they share are part of
the join's condition, the shingles from the bucket's one onward in sorted order,
and the bits in which their signatures differ.  No link between components is
lost, and a group of copies does not become all its pairs.

Defined cases: a null, empty or blank text, or a null id, is a class of its
own; equal ids with equal texts are one document; a class is named by its
smallest doc_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, hash_words, keyed, mix, odd_constants, record_batch, text_batches
from .graph import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 48
ELL = 8
SHORT = 19                                   # shingles up to which candidates are exact
SIGNATURE = 8                                # longs of the bit signature of a shingle set
_C = odd_constants(32, 5)
_XOR = mix(odd_constants(SKETCHES, 77))
_MUL = odd_constants(SKETCHES, 99)
_STEP = 1 << 20                              # hash values of several sketches held at once


def shingles(h: np.ndarray) -> np.ndarray:
    """Names of the shingles of a word sequence."""
    k = min(SHINGLE, len(h))
    if not k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out += h[j:len(h) - k + 1 + j] * _C[j]
    return mix(out + np.uint64(k))


def labelled(s: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number mixed in: all different."""
    order = np.argsort(s, kind="stable")
    ss = s[order]
    new = np.ones(len(s), bool)
    new[1:] = ss[1:] != ss[:-1]
    nth = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = np.empty_like(s)
    out[order] = mix(ss + nth.astype(np.uint64) * _C[10])
    return out


def sketch_keys(s: np.ndarray) -> np.ndarray:
    """One key for each sketch of a text with shingles ``s``."""
    x = labelled(s)
    ell = min(ELL, len(s))
    keys = np.empty(SKETCHES, np.uint64)
    step = max(1, _STEP // len(s))
    for at in range(0, SKETCHES, step):
        part = slice(at, min(SKETCHES, at + step))
        v = (x[None, :] ^ _XOR[part, None]) * _MUL[part, None]
        i = np.argpartition(v, ell - 1, axis=1)[:, :ell] if ell < len(s) else np.tile(np.arange(ell), (len(v), 1))
        i.sort(axis=1)
        keys[part] = (s[i] * _C[11:11 + ell]).sum(axis=1) + _XOR[part]
    return mix(keys)


def prefix_keys(s: np.ndarray) -> np.ndarray:
    """The labelled shingles of which any near-duplicate shares at least one."""
    n = len(s)
    least = math.ceil(SIMILARITY * n - 1e-6)
    return mix(np.sort(labelled(s))[:n - least + 1] * _C[9])


def candidate_keys(s: np.ndarray) -> np.ndarray:
    """Two near-duplicates share a key: for certain if either is short."""
    if len(s) <= SHORT:
        return prefix_keys(s)
    if SIMILARITY * len(s) - 1e-6 <= SHORT:
        return np.concatenate((sketch_keys(s), prefix_keys(s)))
    return sketch_keys(s)


def aligned(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Most shingles an order-preserving alignment matches, or -1 if it takes
    more than ``most`` insertions and deletions."""
    n, m = len(a), len(b)
    head = 0
    same = min(n, m)
    diff = np.flatnonzero(a[:same] != b[:same])
    head = int(diff[0]) if len(diff) else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    diff = np.flatnonzero(a[len(a) - same:][::-1] != b[len(b) - same:][::-1])
    tail = int(diff[0]) if len(diff) else same
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    x_end, y_end = len(a), len(b)
    if abs(x_end - y_end) > most:
        return -1
    a, b = a.tolist(), b.tolist()
    reach = {1: 0}                            # furthest x on each diagonal x - y
    for d in range(most + 1):
        for k in range(-d, d + 1, 2):
            x = reach[k + 1] if k == -d or (k != d and reach[k - 1] < reach[k + 1]) else reach[k - 1] + 1
            y = x - k
            while x < x_end and y < y_end and a[x] == b[y]:
                x += 1
                y += 1
            reach[k] = x
            if x >= x_end and y >= y_end:
                return head + tail + (x_end + y_end - d) // 2
    return -1


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Share of shingles that align, 0 when it is certain to be below ``least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    most = int((n + m) * (1 - least) / (1 + least) + 1e-9)
    # shingles in common, in any order, bound what can align
    common = len(np.intersect1d(labelled(a), labelled(b), assume_unique=True))
    if n + m - 2 * common > most:
        return 0.0
    match = aligned(a, b, most)
    return 0.0 if match < 0 else match / (n + m - match)


def signature(s: np.ndarray) -> np.ndarray:
    """Bits that stand for a set of shingles.  Every bit in which two signatures
    differ is an element that only one of the sets has."""
    bit = s & np.uint64(64 * SIGNATURE - 1)
    out = np.zeros(SIGNATURE, np.uint64)
    np.bitwise_or.at(out, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def _at_most_shared(na, nb, sig_a: str, sig_b: str):
    """Upper bound on the elements that sets of these sizes and signatures share."""
    differ = [F.bit_count(F.col(sig_a)[k].bitwiseXOR(F.col(sig_b)[k])) for k in range(SIGNATURE)]
    return (na + nb - sum(differ[1:], differ[0])) / 2


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h1, h2, n, keys) of every document that has words and an id."""
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for ids, texts in text_batches(batches):
            rows = []
            for doc, text in zip(ids, texts):
                h = hash_words(text or b"")
                if doc is None or not len(h):
                    continue
                whole = xxhash.xxh3_128_intdigest(h.tobytes())
                s = shingles(h)
                rows.append((doc, (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63), len(s),
                             candidate_keys(s).view(np.int64)))
            if rows:
                yield record_batch(schema, list(zip(*rows)))

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, h1 long, h2 long, n int, keys array<long>")


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the labelled shingles they have in common, whether they are
    near-duplicates, the shingles of ``a`` outside ``b`` of which any further partner must share
    one, and the signature of all shingles of ``a`` outside ``b``."""
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))

    def run(batches):
        last, of_last = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ta, tb = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            common, linked, outside, sig = [], [], [], []
            for i in range(batch.num_rows):
                if b[i] != last:
                    last, of_last = b[i], shingles(hash_words(tb[i].as_py()))
                s = shingles(hash_words(ta[i].as_py()))
                linked.append(similarity(s, of_last) >= SIMILARITY)
                rest = np.setdiff1d(labelled(s), labelled(of_last), assume_unique=True)
                common.append(len(s) - len(rest))
                share = max(1, math.ceil(SIMILARITY * len(s) - common[-1] - 1e-6))
                sig.append(signature(rest).view(np.int64))
                outside.append(np.sort(rest)[:max(0, len(rest) - share + 1)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(common, pa.int32()),
                 pa.array(linked, pa.bool_()), pa.array(outside, pa.list_(pa.int64())),
                 pa.array(sig, pa.list_(pa.int64()))],
                names=["a", "b", "common", "linked", "outside", "sig"])

    return cut_lineage(both.mapInArrow(
        run, "a long, b long, common int, linked boolean, outside array<long>, sig array<long>"))


def _alike_in_length(x: str, y: str):
    """Lengths that allow the similarity at all."""
    return F.least(x, y) >= SIMILARITY * F.greatest(x, y)


def _with_pivot(members: DataFrame) -> DataFrame:
    """(key, rep, n, pivot): the pivot of a bucket is the member that meets most others in all its buckets."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    weight = members.join(sizes, "key").groupBy("rep").agg(F.sum("size").alias("weight"))
    pivot = members.join(weight, "rep").groupBy("key").agg(
        F.max(F.struct(F.col("weight"), F.negative("rep").alias("low"))).alias("top"))
    return cut_lineage(members.join(pivot.select("key", F.negative("top.low").alias("pivot")), "key"))


def _placed(frame: DataFrame, found: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the component of a text (itself where it has no link)."""
    of = found.select(F.col("v").alias(column), F.col("c").alias(name))
    return frame.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def _mixed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the groups that hold more than one component ``c``."""
    several = rows.groupBy(*keys).agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 < c1")
    return rows.join(several.select(*keys), [*keys])


def _uncertain(rows: DataFrame) -> DataFrame:
    """Pairs of a pivot's members that need share nothing outside it: joined on the
    lengths that allow this, not all with all."""
    half = SIMILARITY / (1 + SIMILARITY)
    lens = F.sequence(F.ceil(SIMILARITY * F.col("n") - 1e-6).cast("int"),
                      F.floor(F.col("common") / half - F.col("n") + 1e-6).cast("int"))
    enough = F.col("common") / half - F.col("n") + 1e-6 >= F.ceil(SIMILARITY * F.col("n") - 1e-6)
    left = rows.filter((~F.col("linked")) & enough).select(
        "pivot", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("common").alias("gx"), F.col("c").alias("cx"),
        F.explode(lens).alias("n"))
    right = rows.select("pivot", "n", F.col("rep").alias("y"), F.col("common").alias("gy"), F.col("c").alias("cy"))
    pairs = left.join(right, ["pivot", "n"]).filter(
        (F.col("cx") != F.col("cy")) & (F.least("gx", "gy") >= half * (F.col("nx") + F.col("n")) - 1e-6))
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, kept): one row for each row of ``docs``."""
    source = keyed(docs, id_col, text_col)
    sketched = cut_lineage(sketches(docs, id_col, text_col))
    same = sketched.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"),
                                            F.first("n").alias("n"))
    rows = same.select("rep", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).filter("r0 < r1")
    # members of sketch buckets that hold more than one text
    members = cut_lineage(rows.join(shared.select("key"), "key"))
    texts = source.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = cut_lineage(texts.dropDuplicates(["doc_id"]))
    # 1. every member against the pivot of its bucket
    stars = _with_pivot(members).filter("rep <> pivot").select("rep", "n", "pivot").distinct()
    tried = _compared(stars.select(F.col("rep").alias("a"), F.col("pivot").alias("b")), texts)
    found = components(tried.filter("linked").select("a", "b"))
    known = stars.join(tried.withColumnsRenamed({"a": "rep", "b": "pivot"}), ["rep", "pivot"])
    known = cut_lineage(_mixed(_placed(known, found, "rep", "c"), "pivot"))
    # 2. members that share something outside the pivot: again each against one of them
    wider = known.select("pivot", "rep", "n", "c", "common", "sig", F.posexplode("outside").alias("place", "s"))
    # onward: the shingles outside the pivot from s on, in sorted order
    wider = cut_lineage(_mixed(wider, "pivot", "s").select(
        F.xxhash64("pivot", "s").alias("key"), "rep", "n", "common", "sig",
        (F.col("n") - F.col("common") - F.col("place")).alias("onward")))
    stars = _with_pivot(wider.select("key", "rep", "n")).filter("rep <> pivot")
    pairs = stars.select(F.col("rep").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("na")).distinct()
    sizes = same.select(F.col("rep").alias("b"), F.col("n").alias("nb"))
    pairs = pairs.join(sizes, "b").filter(_alike_in_length("na", "nb")).select("a", "b").unionByName(_uncertain(known))
    tried = tried.unionByName(_compared(pairs.distinct().join(tried, ["a", "b"], "left_anti"), texts))
    found = components(tried.filter("linked").select("a", "b"))
    # 3. pairs of these that are still in different components
    rest = cut_lineage(_mixed(_placed(wider, found, "rep", "c"), "key"))
    left = rest.select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"),
                       F.col("common").alias("gb"), F.col("onward").alias("ob"), F.col("sig").alias("sb"))
    right = rest.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"),
                        F.col("common").alias("ga"), F.col("onward").alias("oa"), F.col("sig").alias("sa"))
    # what both must share outside the pivot is at most what either has there from the first
    # shared one on, and at most what the signatures allow
    must = SIMILARITY / (1 + SIMILARITY) * (F.col("na") + F.col("nb")) - F.least("ga", "gb") - 1e-6
    able = (F.least("oa", "ob") >= must) & (
        _at_most_shared(F.col("na") - F.col("ga"), F.col("nb") - F.col("gb"), "sa", "sb") >= must)
    pairs = left.join(right, "key").filter((F.col("b") < F.col("a")) & (F.col("ca") != F.col("cb"))
                                           & _alike_in_length("na", "nb") & able).select("a", "b").distinct()
    back = tried.select(F.col("b").alias("a"), F.col("a").alias("b")).unionByName(tried.select("a", "b"))
    more = _compared(pairs.join(back, ["a", "b"], "left_anti"), texts).filter("linked").select("a", "b")
    if not more.isEmpty():
        found = components(tried.filter("linked").select("a", "b").unionByName(more))

    reps = sketched.select("doc_id", "h1", "h2").distinct().join(same.select("h1", "h2", "rep"), ["h1", "h2"])
    by_doc = _placed(reps.select("doc_id", "rep"), found, "rep", "class_id").groupBy("doc_id").agg(
        F.min("class_id").alias("class_id"))
    return source.select("doc_id").join(by_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
