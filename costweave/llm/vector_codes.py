"""Vector code compression: product codes by exact Lloyd rounds on metric trees.

Components become integers ``floor(1024 * x)``; a vector is cut into equal consecutive
parts, each part position has a codebook, which starts as that part of the smallest
ids.  A round assigns every part to its nearest entry (squared distance, ties to the
lower index) and replaces each entry by ``floor(sum / count)`` of its parts.  All sums are
integers, so the codes don't depend on partitions or order.

Rounds don't visit every part.  Each task builds, for blocks of ``BLOCK`` vectors and
each part position, an anchors hierarchy: anchors are chosen as the part furthest
from its anchor and take over what is nearer to them (lists sorted by distance, cut at
half the distance of two anchors); the anchors' balls are merged from the middle up, the
pair with the smallest ball first, and split in the same way from the middle down.
A ball holds centre, radius, count and sum of its parts.  The trees are written
once, as a table; each round reads them with the current codebooks (a few hundred
entries, bounded by parts x entries) and walks them from the top with a list of candidate
entries: an entry goes from the list as soon as the whole ball lies on the other
side of the plane between it and the entry nearest to the centre.  When one is left the
ball is wholly owned: its cached sum and count are added, its parts aren't looked
at.  Only leaves with several candidates compare parts.  Tasks send one sum for each
entry, Spark adds them.

Defined cases.  Rows whose vector is null or holds null or non-finite components are left
out.  Vectors of different lengths are filled with zeros up to the longest, and up
to a multiple of the number of parts.  Repeated ids: all rows are coded, the first
codebook takes them in order of id, then vector; null ids come last.  Fewer
rows than entries: a smaller codebook.  Scaled components beyond 2**27 count as 2**27
(either sign).  No rows: no codes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

SCALE = 1024
CLAMP = 1 << 27
BLOCK = 4096                     # vectors of a tree
LEAF = 32
SALTS = 16


def integers(column, width: int) -> np.ndarray:
    """A list column as rows of ``floor(1024 x)``, filled with zeros up to ``width``."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lens = np.asarray(pa.compute.list_value_length(column))
    out = np.zeros((len(lens), width), np.int64)
    starts = np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - starts] = np.clip(np.floor(flat * SCALE), -CLAMP, CLAMP)
    return out


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All squared distances of integer rows, exactly."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 1 << 52:            # every sum below fits a double
        a, b = x.astype(float), y.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in y], axis=1)


# ---- anchors hierarchy --------------------------------------------------------------------

@dataclass
class Ball:
    rows: np.ndarray             # of the block
    centre: np.ndarray
    radius: float
    total: np.ndarray            # sum of the parts
    children: list = field(default_factory=list)


def _ball(x: np.ndarray, rows: np.ndarray, children=()) -> Ball:
    total = x[rows].sum(0)
    centre = total / len(rows)
    radius = float(np.sqrt(((x[rows] - centre) ** 2).sum(1).max()))
    return Ball(rows, centre, radius, total, list(children))


def anchors(x: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """The rows dealt to up to ``most`` anchors, each row to its nearest."""
    def far_first(own, dist):
        order = np.argsort(-dist, kind="stable")
        return own[order], dist[order]

    points = x.astype(float)
    gap = lambda own, at: np.sqrt(((points[own] - points[at]) ** 2).sum(1))
    found = [(rows[0], *far_first(rows, gap(rows, rows[0])))]
    while len(found) < most:
        widest = max(range(len(found)), key=lambda i: found[i][2][0] if len(found[i][2]) else -1.0)
        if not len(found[widest][2]) or found[widest][2][0] <= 0:
            break                                               # all rows lie on their anchors
        new = found[widest][1][0]
        taken, taken_dist = [], []
        for i, (at, own, dist) in enumerate(found):
            if not len(own):
                continue
            apart = float(np.sqrt(((points[at] - points[new]) ** 2).sum()))
            reach = int(np.searchsorted(-dist, -apart / 2, side="left"))     # nearer ones can't change hands
            if not reach:
                continue
            to_new = gap(own[:reach], new)
            moves = to_new < dist[:reach]
            if moves.any():
                taken.append(own[:reach][moves])
                taken_dist.append(to_new[moves])
                stay = np.concatenate([~moves, np.ones(len(own) - reach, bool)])
                found[i] = (at, own[stay], dist[stay])
        found.append((new, *far_first(np.concatenate(taken), np.concatenate(taken_dist))))
    return [own for _, own, _ in found if len(own)]


def tree(x: np.ndarray, rows: np.ndarray) -> Ball:
    """The middle of about the root of all balls first, merged upwards, split downwards."""
    if len(rows) <= LEAF:
        return _ball(x, rows)
    parts = anchors(x, rows, max(2, int(len(rows) ** 0.5)))
    if len(parts) == 1:
        return _ball(x, rows)                                   # copies of one part
    balls = [tree(x, own) for own in parts]
    centres = np.array([b.centre for b in balls])
    reach = np.array([b.radius for b in balls])
    size = lambda i: (np.sqrt(((centres - centres[i]) ** 2).sum(1)) + reach + reach[i]) / 2
    cost = np.stack([size(i) for i in range(len(balls))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(cost.argmin()), len(balls))
        balls[i] = _ball(x, np.concatenate([balls[i].rows, balls[j].rows]), (balls[i], balls[j]))
        centres[i], reach[i], reach[j] = balls[i].centre, balls[i].radius, np.inf
        cost[j], cost[:, j] = np.inf, np.inf
        row = size(i)
        row[i] = np.inf
        cost[i], cost[:, i] = row, row
    return balls[i]


def pack_tree(root: Ball) -> dict:
    """Arrays of a tree, balls in order of a walk from the top: ``skip`` is the next
    ball outside, a ball's rows are ``order[start:start + count]``."""
    starts, counts, skips, centres, radii, totals, order = [], [], [], [], [], [], []
    at = [0]

    def walk(ball: Ball):
        me = len(starts)
        starts.append(at[0])
        counts.append(len(ball.rows))
        skips.append(0)
        centres.append(ball.centre)
        radii.append(ball.radius)
        totals.append(ball.total)
        if ball.children:
            todo.append((me, None))
            todo.extend((None, c) for c in reversed(ball.children))
        else:
            order.extend(ball.rows.tolist())
            at[0] += len(ball.rows)
            skips[me] = len(starts)

    todo: list = [(None, root)]
    while todo:
        me, ball = todo.pop()
        if ball is None:
            skips[me] = len(starts)
        else:
            walk(ball)
    ints = np.array([starts, counts, skips], np.int64)
    return {"ints": ints.tobytes(), "centres": np.array(centres).tobytes(), "radii": np.array(radii).tobytes(),
            "totals": np.array(totals, np.int64).tobytes(), "rows": np.array(order, np.int64).tobytes()}


def owners(x: np.ndarray, packed: dict, book: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """Who owns what: ``(entry, rows, cached sum)`` for a wholly owned ball, and
    ``(-1, rows, entries)`` for rows compared one by one."""
    starts, counts, skips = np.frombuffer(packed["ints"], np.int64).reshape(3, -1)
    width = x.shape[1]
    centres = np.frombuffer(packed["centres"]).reshape(-1, width)
    totals = np.frombuffer(packed["totals"], np.int64).reshape(-1, width)
    radii, order = np.frombuffer(packed["radii"]), np.frombuffer(packed["rows"], np.int64)
    entries = book.astype(float)
    slack = 1e-6 * (1 + float(np.abs(entries).max(initial=0)) + float(np.abs(centres).max(initial=0)))
    out, todo = [], [(0, np.arange(len(book)))]
    while todo:
        ball, left = todo.pop()
        own = entries[left]
        dist = ((own - centres[ball]) ** 2).sum(1)
        near = int(dist.argmin())
        apart = np.sqrt(((own - own[near]) ** 2).sum(1))
        # the plane between two entries lies (dist - dist[near]) / (2 apart) from the centre
        keep = dist - dist[near] <= 2 * apart * (radii[ball] + slack)
        # equal entries: only the lower index can win
        left, near_entry = left[keep], left[near]
        rows = order[starts[ball]:starts[ball] + counts[ball]]
        same = (entries[left] == entries[near_entry]).all(1)
        if same.all():
            out.append((int(left[0]), rows, totals[ball]))
        elif skips[ball] == ball + 1:
            found = left[squared(x[rows], book[left]).argmin(1)]
            out.append((-1, rows, found))
        else:
            child = ball + 1
            while child < skips[ball]:
                todo.append((child, left))
                child = int(skips[child])
    return out


# ---- on Spark ------------------------------------------------------------------------------

def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def _trees(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """A row for each block of vectors and its trees, one for each part position."""
    def build(batches):
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(at, BLOCK))
                n += held[-1].num_rows
                if n >= BLOCK:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    def block(held):
        table = pa.Table.from_batches(held)
        x = integers(table.column(1), width)
        trees = [pack_tree(tree(p, np.arange(len(p)))) for p in _parts(x, parts)] if width else []
        return pa.RecordBatch.from_pylist([{"ids": table.column(0).to_pylist(), "vectors": x.tobytes(), "trees": trees,
                                            "labels": table.column(2).to_pylist()}], schema=schema)

    schema = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("vectors", pa.binary()),
                        ("trees", pa.list_(pa.struct([(n, pa.binary()) for n in ("ints", "centres", "radii", "totals", "rows")])))])
    blobs = ",".join(f"{n}:binary" for n in ("ints", "centres", "radii", "totals", "rows"))
    return rows.mapInArrow(build, f"ids array<long>, labels array<string>, vectors binary, trees array<struct<{blobs}>>")


def _blocks(batches, width: int, parts: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            yield row, _parts(np.frombuffer(row["vectors"], np.int64).reshape(-1, width), parts)


def next_books(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part to its nearest entry, entries to the floor of their mean."""
    parts, step = len(books), books[0].shape[1]

    def assign(batches):
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for row, xs in _blocks(batches, parts * step, parts):
            for p, x in enumerate(xs):
                for entry, rows, rest in owners(x, row["trees"][p], books[p]):
                    if entry >= 0:
                        total[p][entry] += rest
                        count[p][entry] += len(rows)
                    else:
                        np.add.at(total[p], rest, x[rows])
                        np.add.at(count[p], rest, 1)
        at = [(p, e) for p in range(parts) for e in np.flatnonzero(count[p]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in at], pa.int32()), pa.array([e for _, e in at], pa.int32()),
             pa.array([int(count[p][e]) for p, e in at], pa.int64()),
             pa.array([total[p][e].tolist() for p, e in at], pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    sums = trees.select("vectors", "trees").mapInArrow(assign, "part int, entry int, n long, total array<long>")
    sums = (sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(step)])
            .collect())                                                       # at most parts x entries rows
    out = [b.copy() for b in books]
    for r in sums:
        out[r["part"]][r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(step)]
    return out


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(frame: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row for each whole vector: vec_id, code (two hex digits a part), error (squared, over all parts),
    label_error (sum of error over its label, nulls together), codebooks_sha256.  ``entries`` <= 256."""
    if not 1 <= entries <= 256:
        raise ValueError("a part's code has two hex digits: 1 to 256 entries")
    spark = frame.sparkSession
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = frame.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
                        F.col(f"`{label_col}`").cast("string").alias("label")).filter(F.coalesce(finite, F.lit(False)))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    width = -(-max(1, rows.agg(F.max(F.size("vector"))).first()[0]) // parts) * parts
    books = _parts(integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), width), parts)

    trees = cut_lineage(_trees(rows, width, parts))
    for _ in range(rounds):
        books = next_books(trees, books)

    def code(batches):
        for row, xs in _blocks(batches, width, parts):
            codes = np.zeros((parts, len(xs[0])), np.int64)
            error = np.zeros(len(xs[0]), np.int64)
            for p, x in enumerate(xs):
                for entry, own, found in owners(x, row["trees"][p], books[p]):
                    codes[p][own] = entry if entry >= 0 else found
                error += ((x - books[p][codes[p]]) ** 2).sum(1)
            text = ["".join(f"{c:02x}" for c in v) for v in codes.T.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()),
                                              pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])

    coded = cut_lineage(trees.mapInArrow(code, "vec_id long, label string, code string, error long"))
    # a label may hold any share of the rows: its total is there once for each salt
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    out = salted.join(totals, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
