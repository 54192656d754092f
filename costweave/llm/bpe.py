"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

Encoding: a rank file (base64 token, rank) is turned into the library's own
BPE model: every byte is written as a printable character (the byte table),
and the merge of a token is the pair that the lower ranks leave of it.  Texts
come as Arrow batches.  A text is cut before every space that a visible
character follows; the splitting pattern never matches across such a place,
so the ids of a piece do not depend on its surroundings and each task
encodes a piece it has met before from a bounded table.

Offsets: a token's byte length is known from its id, so running sums give
byte offsets and the map from bytes to characters gives character offsets (a
token that holds part of a character counts as reaching to that character).

Decoding looks ids up in the reversed byte table and joins the bytes; a
character that is split between tokens comes back whole, and bytes that form
no character become U+FFFD in the decoded text (the bytes themselves are
exact).

Defined cases: a null or empty text has no tokens; an id outside the
vocabulary, or a null one, raises.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

TABLE_LIMIT = 600_000            # pieces a task keeps encoded; the table starts anew beyond it
JOINED = 256                     # unseen pieces encoded at once
_CUT = re.compile(r" (?=\S)")


def byte_table() -> list[str]:
    """The printable character of every byte: itself where it is printable in
    Latin-1, the next unused code point from 256 on otherwise."""
    spare = iter(range(256, 512))
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each longer token is merged from, in rank order."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = min((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if found[0] >= rank:
                raise ValueError(f"no lower ranks lead to token {rank}")
            i = found[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def tokenizer_from_ranks(path: str, pattern: str):
    """A ``tokenizers.Tokenizer`` with the vocabulary of a rank file."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    table = byte_table()
    ranks = read_ranks(path)
    text = {token: "".join(table[b] for b in token) for token in ranks}
    model = models.BPE(vocab={text[t]: r for t, r in ranks.items()},
                       merges=[(text[a], text[b]) for a, b in merge_pairs(ranks)], ignore_merges=True)
    tok = Tokenizer(model)
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok


def tokenizer_from_json(path: str):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True         # their strings in a text are ordinary text
    return tok


def token_bytes(tok) -> list[bytes]:
    """The bytes of every id: the byte table reversed over the vocabulary."""
    back = {c: b for b, c in enumerate(byte_table())}
    out: list[bytes] = [b""] * tok.get_vocab_size()
    for text, i in tok.get_vocab().items():
        out[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
    return out


class Encoder(dict):
    """Ids of whole texts; maps a piece to its number in the table.

    Key ``p`` stands for the piece ``" " + p``, key ``" " + p`` for the piece
    ``p`` that begins a text."""

    def __init__(self, tok, limit: int = TABLE_LIMIT):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task for each core
        self.tok, self.limit = tok, limit
        self.bytes = token_bytes(tok)
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.reset()

    def reset(self):
        self.clear()
        self.waiting: list[str] = []
        self.ids = np.zeros(1 << 16, np.int32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.count, self.used = 0, 0

    def __missing__(self, key: str) -> int:
        if key == "" or (key[0] != " " and key[0].isspace()):
            self[key] = -1                                  # the cut before it isn't one
            return -1
        number = self.count + len(self.waiting)
        self.waiting.append(key)
        self[key] = number
        return number

    def _add(self, ids: np.ndarray, ends: np.ndarray):
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.count + len(ends) + 1 > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.begin[self.count + 1:self.count + 1 + len(ends)] = self.used + ends
        self.count += len(ends)
        self.used += len(ids)

    def _encode_waiting(self):
        keys = self.waiting
        for at in range(0, len(keys), JOINED * 64):
            group = keys[at:at + JOINED * 64]
            # pieces are joined as they would follow each other in a text; one
            # that begins a text starts a joined string of its own
            strings, lens = [], []
            for key in group:
                piece = key[1:] if key[:1] == " " else " " + key
                size = len(piece.encode())
                if key[:1] == " " or not strings or len(lens[-1]) >= JOINED:
                    strings.append([])
                    lens.append([])
                strings[-1].append(piece)
                lens[-1].append(size)
            done = self.tok.encode_batch_fast(["".join(s) for s in strings], add_special_tokens=False)
            for enc, sizes in zip(done, lens):
                ids = np.array(enc.ids, np.int32)
                reach = np.cumsum(self.width[ids])
                stop = np.cumsum(np.array(sizes, np.int64))
                ends = np.searchsorted(reach, stop, side="left") + 1
                ends[stop == 0] = 0
                if len(reach) and (reach[np.maximum(ends, 1) - 1][stop > 0] != stop[stop > 0]).any():
                    raise ValueError("a token crosses two pieces")
                self._add(ids, ends)
        self.waiting = []

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        if len(self) > self.limit:
            self.reset()
        numbers, sizes = [], []
        for text in texts:
            parts = text.split(" ")
            parts[0] = " " + parts[0]
            found = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
            if found.min() < 0:                             # runs of white space: cut with the pattern
                parts = _CUT.split(text)
                parts[0] = " " + parts[0]
                found = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
            numbers.append(found)
            sizes.append(len(parts))
        self._encode_waiting()
        if not numbers:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        number = np.concatenate(numbers)
        begin = self.begin[number]
        length = self.begin[number + 1] - begin
        total = int(length.sum())
        shift = np.cumsum(length) - length
        ids = self.ids[np.repeat(begin - shift, length) + np.arange(total)]
        owner = np.cumsum(np.array(sizes)) - np.array(sizes)
        return ids, np.add.reduceat(length, owner)


def char_offsets(data: bytes, ids: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last one that each token holds a byte of."""
    raw = np.frombuffer(data, np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80)                  # of each byte, from 1
    stop = np.cumsum(width[ids])
    begin = stop - width[ids]
    return char[begin] - 1, char[stop - 1]


_kept: dict = {}                                            # of a Python worker, by vocabulary


def encoder_for(path: str, pattern: str | None = None) -> Encoder:
    """The worker's encoder: a rank file with its pattern, or a tokenizer's json."""
    key = (path, pattern)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(tokenizer_from_ranks(path, pattern) if pattern else tokenizer_from_json(path))
    return _kept[key]


def encoded_batches(batches, path: str, pattern: str | None = None):
    """(doc ids, texts as bytes, all ids, ids of each text, encoder) by batch."""
    encoder = encoder_for(path, pattern)
    for docs, texts in text_batches(batches):
        texts = [t or b"" for t in texts]
        ids, counts = encoder([t.decode("utf-8", "replace") for t in texts])
        yield docs, texts, ids, counts, encoder


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def encode(frame: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends): token ids with their character offsets."""
    source = frame.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for docs, texts, ids, counts, enc in encoded_batches(batches, path, pattern):
            cut = np.concatenate(([0], np.cumsum(counts)))
            starts, ends = [], []
            for t, a, b in zip(texts, cut, cut[1:]):
                s, e = char_offsets(t, ids[a:b], enc.width)
                starts.append(s)
                ends.append(e)
            off = pa.array(cut.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.ListArray.from_arrays(off, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(np.concatenate(starts), pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(np.concatenate(ends), pa.int32()))],
                names=["doc_id", "ids", "starts", "ends"])

    return source.mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(frame: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes, text): the ids' bytes and the text they form (null ids: null)."""
    source = frame.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))

    def run(batches):
        table = encoder_for(path, pattern).bytes
        for batch in batches:
            data = [None if x is None else b"".join(table[i] for i in x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary()),
                 pa.array([None if d is None else d.decode("utf-8", "replace") for d in data], pa.string())],
                names=["doc_id", "bytes", "text"])

    return source.mapInArrow(run, "doc_id long, bytes binary, text string")
