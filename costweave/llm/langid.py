"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3, the
blended spectrum) that both contain, over the geometric mean of how many
each contains.  ``LANDMARKS`` training texts per language span the Nyström
subspace; one-versus-rest kernel ridge regression with targets +1 and -1 is
solved in it on a bounded sample of ``SAMPLE`` labelled texts per language
(documented bounds; everything scored is whole texts of all rows).

A text's kernel values with all landmarks, times the regression
coefficients, is one product of its n-gram presence vector with a matrix
(n-gram, language).  Tasks score batches of texts by one product of the batch's
sparse presence matrix with it; the matrix holds only n-grams of the landmarks, so its size
doesn't depend on ``BINS`` times the number of languages.  N-grams are hashed into ``BINS``
cells, the same everywhere.  Training texts are learnt from up to ``LEARNT`` characters,
which bounds what reaches the driver (``SAMPLE`` times ``LEARNT`` a language).

The score ranks the learnt languages and says nothing about others: the values
of K languages sum to about 2 - K, so the best score is hardly below 1/K, and a
text of n-grams never learnt gets 0.5.  Whether a text is in any of them is told
by evidence (``identify(..., sure=...)``): the share ``s`` of its distinct n-grams
of words without digits that the landmarks have, and the margin of the best
language over the second in these.  A text is refused if ``s`` is low and the
margin is too, or if ``s`` is below ``FOREIGN`` of what counts as low.  Low is below
the ``LOW`` quantile of the beginnings (``SNIPPET`` characters, as a short text
shows less) of the labelled texts learnt from that are no landmarks, or of the
landmarks where there are no others; few n-grams are allowed ``SLACK``
standard deviations of their known number.

Defined cases: a null text or one without a letter is ``und`` with score 0;
so is every text when there is nothing to learn from; rows that repeat are
scored alike; ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

BINS = 1 << 20
ORDERS = 3
LANDMARKS = 48
SAMPLE = 240
RIDGE = 1e-2
LOW = 0.01
SLACK = 3.0
FOREIGN = 0.5
SNIPPET = 80
LEARNT = 1 << 15
VALUES = 1 << 20                              # numbers held at once by a batch's product
UNKNOWN = "und"
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)
_tables: dict = {}                            # of a Python worker


def _is_letter() -> np.ndarray:
    if "letter" not in _tables:
        _tables["letter"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _tables["letter"]


def grams(text: str) -> np.ndarray:
    """The distinct n-gram cells of a text (in the order they are first met last)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    cells, key = [], np.zeros(len(code), np.uint64)
    for n in range(ORDERS):
        if n >= len(code):
            break
        key = (key[:len(code) - n] + code[n:]) * _MUL[n]
        key ^= key >> np.uint64(15)
        cells.append(((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64))
    cell = np.concatenate(cells) if cells else np.zeros(0, np.int64)
    if "mark" not in _tables:
        _tables["mark"] = np.zeros(BINS, np.int64)
    mark = _tables["mark"]
    at = np.arange(len(cell))
    mark[cell] = at                           # the last place of each cell stands for it
    return cell[mark[cell] == at]


def has_letter(text: str) -> bool:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool(_is_letter()[code].any())


def spoken(text: str) -> str:
    """The words of letters, parted by one space: what language shows in.  Words
    with digits (numbers, keys) are left out where there are others."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    digit = (code >= 48) & (code <= 57)
    kept = np.where(_is_letter()[code] | digit, code, np.uint32(32)).astype(np.uint32)
    words = kept.tobytes().decode("utf-32-le", "surrogatepass").split()
    return " ".join([w for w in words if not any(c in w for c in "0123456789")] or words)


class Model:
    """``languages`` and the matrix (n-gram cell, language), kept sparse; ``low`` is
    the (share, margin) under which a text shows none of the languages."""

    def __init__(self, languages: list[str], cells: np.ndarray, weights: np.ndarray, low=(0.0, 0.0)):
        self.languages, self.cells, self.weights, self.low = languages, cells, weights, low

    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        """Row of the weights for every cell, and the weights with a last row of
        zeros for cells that no landmark has."""
        row = np.full(BINS, len(self.cells), np.int32)
        row[self.cells] = np.arange(len(self.cells), dtype=np.int32)
        return row, np.vstack([self.weights, np.zeros((1, len(self.languages)))])

    def product(self, sets, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Presence vectors (normalised) times the weights, a row for each text; also the number
        of its n-grams and the share of them that the landmarks have.  ``sets`` may be a
        generator: only as many are held as one product takes.  No set is empty."""
        row, weights = table
        parts, held, size = [], [], 0

        def multiply():
            lens = np.array([len(c) for c in held])
            at, starts = row[np.concatenate(held)], np.cumsum(lens) - lens
            known = np.add.reduceat((at < len(self.cells)).astype(np.int64), starts)
            parts.append((np.add.reduceat(weights[at], starts, axis=0) / np.sqrt(lens)[:, None], lens, known / lens))

        for cells in sets:
            if held and (size + len(cells)) * len(self.languages) > VALUES:
                multiply()
                held, size = [], 0
            held.append(cells)
            size += len(cells)
        if held:
            multiply()
        return tuple(np.concatenate(p) for p in zip(*parts))

    def evidence(self, texts: list[str], table) -> list[tuple[int, float, float]]:
        """For each text the number of distinct n-grams of letters, the share the landmarks have, the margin."""
        f, n, share = self.product((grams(spoken(t)) for t in texts), table)
        f = np.sort(f, axis=1)
        margin = f[:, -1] - f[:, -2] if f.shape[1] > 1 else np.zeros(len(f))
        return list(zip(n.tolist(), share.tolist(), margin.tolist()))

    def shown(self, texts: list[str | None], table) -> list[bool]:
        """Whether each text shows one of the languages."""
        out = [False] * len(texts)
        use = [i for i, t in enumerate(texts) if self.languages and t is not None and has_letter(t)]
        if use:
            for i, (n, share, margin) in zip(use, self.evidence([texts[i] for i in use], table)):
                slack = SLACK * np.sqrt(self.low[0] * (1 - self.low[0]) / n)
                out[i] = bool(share >= self.low[0] - slack or (margin >= self.low[1] and share >= FOREIGN * self.low[0]))
        return out

    def score(self, texts: list[str | None], table=None):
        """Predicted languages and scores of a batch."""
        best, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        use = [i for i, t in enumerate(texts) if self.languages and t is not None and has_letter(t)]
        if use:
            f = self.product((grams(texts[i]) for i in use), self.lookup() if table is None else table)[0]
            top = f.argmax(1)
            for i, k, v in zip(use, top.tolist(), f[np.arange(len(use)), top].tolist()):
                best[i], score[i] = self.languages[k], min(1.0, max(0.0, (v + 1) / 2))
        return best, score


def fit(texts: list[str], langs: list[str]) -> Model:
    """Kernel ridge regression in the span of the landmarks (the first
    LANDMARKS texts of each language)."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0)))
    sets = [grams(t) for t in texts]
    seen = {lang: 0 for lang in languages}
    landmark = []
    for i, lang in enumerate(langs):
        if seen[lang] < LANDMARKS:
            landmark.append(i)
            seen[lang] += 1
    cells = np.unique(np.concatenate([sets[i] for i in landmark]))
    phi = np.zeros((len(cells), len(landmark)))            # normalised presence of the landmarks
    for k, i in enumerate(landmark):
        phi[np.searchsorted(cells, sets[i]), k] = 1 / np.sqrt(len(sets[i]))
    kernel = np.zeros((len(sets), len(landmark)))
    for i, s in enumerate(sets):
        at = np.searchsorted(cells, s)
        at = at[(at < len(cells)) & (cells[np.minimum(at, len(cells) - 1)] == s)]
        kernel[i] = phi[at].sum(0) / np.sqrt(len(s))
    target = np.array([[1.0 if lang == c else -1.0 for c in languages] for lang in langs])
    system = kernel.T @ kernel + RIDGE * kernel[landmark] + 1e-8 * np.eye(len(landmark))
    alpha = np.linalg.solve(system, kernel.T @ target)
    model = Model(languages, cells, phi @ alpha)
    others = sorted(set(range(len(texts))) - set(landmark)) or landmark
    begun = [t for t in (spoken(texts[i])[:SNIPPET] for i in others) if has_letter(t)]
    seen = np.array([e[1:] for e in model.evidence(begun, model.lookup())] if begun else [(0.0, 0.0)])
    model.low = (float(np.quantile(seen[:, 0], LOW)), float(np.quantile(seen[:, 1], LOW)))
    return model


def held_out(id_col: str = "doc_id"):
    """True for the documents that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns on up to SAMPLE texts of each language (the first LEARNT characters), chosen by
    a hash of the id among documents that are not held out."""
    text = F.col(f"`{text_col}`")
    known = docs.filter(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()
                        & (~held_out(id_col)) & text.rlike(r"\p{L}"))
    known = known.select(F.col(f"`{id_col}`").alias("i"), F.substring(text, 1, LEARNT).alias("t"), F.col(f"`{lang_col}`").alias("l"))
    known = known.filter(F.col("t").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy("l").count().collect()}          # one row a language
    scale, share = 1 << 30, F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("l") == lang, min(scale, int(scale * 1.5 * SAMPLE / n) + 1)).otherwise(share)
    rows = known.select("*", F.xxhash64("i").alias("h")).filter(F.pmod("h", F.lit(scale)) < share).collect()
    rows.sort(key=lambda r: (r["l"], r["h"], r["i"], r["t"]))
    texts, langs, taken = [], [], {}
    for r in rows:
        taken[r["l"]] = taken.get(r["l"], 0) + 1
        if taken[r["l"]] <= SAMPLE:
            texts.append(r["t"])
            langs.append(r["l"])
    return fit(texts, langs)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang: str = "lang_pred",
             score: str = "score", sure: str | None = None) -> DataFrame:
    """All columns plus the predicted language and its score (existing columns of
    these names are replaced); with ``sure`` also whether the text shows it."""
    docs = docs.drop(lang, score, *([sure] if sure else []))
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        table = model.lookup()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            best, value = model.score(texts, table)
            more = [pa.array(best, pa.string()), pa.array(value, pa.float64())]
            if sure:
                more.append(pa.array(model.shown(texts, table), pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, *added])

    added = [lang, score] + ([sure] if sure else [])
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{out}, `{lang}` string, `{score}` double" + (f", `{sure}` boolean" if sure else ""))


__all__ = ["Model", "fit", "train", "identify", "held_out", "grams", "fresh"]
