"""Chat, BPE, packing, substrings, lines, near-duplicates, shards, languages against plain versions."""
import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from costweave.llm import bpe, chat, langid, lines, minhash, packing, queries, sharding, substring
from tests.conftest import SF001
from tests.harness import compare, duck
from tests.llm.helpers import documents, odd_rows, table, words

SF01 = "/root/testdata/sf0.01"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    info = compare(spark, duck(SF001), name, queries.QUERIES[name], queries.ORACLE[name], SF001)
    assert "error" not in info, info


# -- 1 chat ----------------------------------------------------------------------------------------

MESSAGES = "tree long, msg long, parent long, role string, text string, score double"


def test_reply_trees_rank_branches(spark):
    rows = [(1, 1, None, "user", "root", 1.0), (1, 2, 1, "assistant", "weak", 0.1), (1, 3, 1, "assistant", "good", 5.0),
            (1, 4, 3, "user", None, 0.0), (1, 5, 2, "user", "longer", 0.2), (1, 6, 5, "assistant", "leaf", 0.2),
            (2, 1, 2, "user", "cycle", 1.0), (2, 2, 1, "user", "cycle", 1.0), (None, 9, 99, None, "orphan", None)]
    out = chat.parse(chat.format_paths(spark.createDataFrame(rows, MESSAGES), best=2)).collect()
    got = {(r["tree"], r["rank"]): [(t["role"], t["text"]) for t in r["turns"]] for r in out}
    assert got == {(1, 1): [("user", "root"), ("assistant", "good"), ("user", "")],
                   (1, 2): [("user", "root"), ("assistant", "weak"), ("user", "longer"), ("assistant", "leaf")],
                   (None, 1): [("", "orphan")]}


def test_escapes_are_reversible(spark):
    pieces = ["<turn", "</turn>\n", "<\\turn", "<\\\\/turn", "\\", "\n", "<", ">", "é🙂", "%3C", "$1", ""]
    rng = random.Random(3)
    texts = ["".join(rng.choices(pieces, k=6)) for _ in range(300)]
    rows = [(i, 1, None, rng.choice(["assistant", "us<er>\n%", None]), t, 1.0) for i, t in enumerate(texts)]
    for r in chat.parse(chat.format_paths(spark.createDataFrame(rows, MESSAGES))).collect():
        want = rows[r["tree"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(want[3] or "", want[4])]
        assert r["loss_texts"] == ([want[4]] if want[3] == "assistant" else [])


def test_long_chain_and_repeated_turns(spark):
    rows = [(7, i // 2, "user" if i % 3 else "assistant", f"t{i}") for i in range(75)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.parse(chat.format_paths(chat.turns_as_tree(turns))).collect()
    want = [(x[2], x[3]) for x in sorted(rows, key=lambda x: x[1:])]
    assert len(r) == 1 and [(t["role"], t["text"]) for t in r[0]["turns"]] == want
    assert chat.format_paths(chat.turns_as_tree(turns.limit(0))).count() == 0


def test_trees_of_all_sizes_together(spark):
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 40]
    rows = [(t, i, "assistant" if i % 2 else "user", f"{t}:{i}") for t, n in enumerate(sizes) for i in range(n)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["tree"]: [t["text"] for t in r["turns"]] for r in chat.parse(chat.format_paths(chat.turns_as_tree(turns))).collect()}
    assert got == {t: [f"{t}:{i}" for i in range(n)] for t, n in enumerate(sizes)}


# -- 3 byte-level BPE, 2 packing -------------------------------------------------------------------

TRICKY = ["", " ", "  a", "a  b", "a \n b", "\n\n x", "it's  we'll", "x " * 5, "tab\tq z", "🙂🙂 é", "<|endoftext|> a", "a\u0085 b",
          "　 a", "a  b", "12 345", "᠎ a", "a\x1c b", "é ​ x", "日本語 テスト", "   a", "\r\n a"]


def tiktoken_encoding():
    import tiktoken
    with open(queries.RANKS_50K, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_rank_library(spark):
    enc = tiktoken_encoding()
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents").collect()]
    rows += [(r[0] and r[0] + 5_000, r[1]) for r in odd_rows()]
    rows += list(enumerate(TRICKY, 10_000))
    frame = documents(spark, rows).withColumn("ids", F.lit("clash"))
    out = bpe.encode(frame, queries.RANKS_50K, P.PATTERN)
    got = sorted(((-1 if r[0] is None else r[0]), r[1], r[2], r[3]) for r in out.collect())
    want = sorted((-1 if i is None else i, t or "") for i, t in rows)
    assert len(got) == len(want)
    for (i, ids, starts, ends), (j, text) in zip(got, want):
        assert i == j and ids == enc.encode_ordinary(text), text[:80]
        whole = enc.decode_with_offsets(ids)
        assert starts == whole[1] and all(a < b for a, b in zip(starts, ends))
        assert not ids or ends[-1] == len(text)
    back = {r["doc_id"]: (bytes(r["bytes"]), r["text"]) for r in bpe.decode(out, queries.RANKS_50K, P.PATTERN).collect()}
    assert all(back[i] == (t.encode(), t) for i, t in want if i > 0)


def test_every_character_is_split_alike():
    """The two libraries' classes of white space, letters and numbers agree."""
    enc, own = tiktoken_encoding(), bpe.Encoder(bpe.tokenizer_from_ranks(queries.RANKS_50K, P.PATTERN))
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"a {c} {c}{c}b1{c}" for c in chars]
    ids, counts = own(texts)
    at, wrong = 0, []
    for text, n in zip(texts, counts):
        if enc.encode_ordinary(text) != ids[at:at + n].tolist():
            wrong.append(hex(ord(text[2])))
        at += n
    assert not wrong, wrong[:20]


def test_split_character_decodes_to_replacement(spark):
    ids = tiktoken_encoding().encode_ordinary("🙂")
    rows = [(1, ids), (2, ids[:1]), (3, []), (4, None)]
    out = {r[0]: r for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"),
                                       queries.RANKS_50K, P.PATTERN).collect()}
    assert out[1]["text"] == "🙂" and "�" in out[2]["text"] and out[3]["text"] == "" and out[4]["text"] is None


def test_special_token_strings_are_ordinary_text():
    tok = bpe.tokenizer_from_json(queries.JSON_50K)
    text = "a<|endoftext|> b"
    ids = tok.encode(text, add_special_tokens=False).ids
    assert 50256 not in ids and tok.decode(ids, skip_special_tokens=False) == text


def test_bpe_of_an_empty_table(spark):
    import public_tokenizers
    none = documents(spark, [])
    coded = bpe.encode(none, queries.RANKS_50K, public_tokenizers.PATTERN)
    assert coded.count() == 0 and bpe.decode(coded, queries.RANKS_50K, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark):
    enc = tiktoken_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF001, "documents").collect()}
    for r in queries.QUERIES["op3_byte_bpe"](spark, SF001).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(texts[r["doc_id"]]))


def test_dominance_reduction_and_best_fit():
    rng = random.Random(5)
    for trial in range(60):
        cap = rng.choice([10, 17, 30])
        items = [rng.randint(1, cap) for _ in range(rng.randint(0, 11))]
        patterns = packing.solve(dict(Counter(items)), cap)
        held = Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= cap
            for s in pattern:
                held[s] += times
        assert held == Counter(items)
        fixed, rest = packing.reduce_instance(dict(Counter(items)), cap)
        # what is fixed is in some best packing: best(all) = fixed + best(rest)
        assert fewest(items, cap) == sum(t for _, t in fixed) + fewest(list(Counter(rest).elements()), cap)


def fewest(items, cap):
    """Exact bin packing of a few items by branch and bound."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(room)
            go(i + 1, [*rest, room - items[i]])
        go(i + 1, [*rooms, cap - items[i]])

    go(0, [])
    return best[0]


def check_packing(rows, texts, ids_of, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = np.array([*ids_of(texts[doc] or ""), 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            assert k == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids) and (len(ids) > capacity or len(parts) == 1)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(by_sequence), -(-total // capacity)


def test_packing_query(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.JSON_50K)
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    rows = queries.QUERIES["op2_best_fit_packing"](spark, SF001).collect()
    used, bound = check_packing(rows, texts, lambda t: tok.encode(t, add_special_tokens=False).ids)
    assert used <= bound * 1.02 + 1


def test_packed_sequences_hold_the_tokens(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(TRICKY + [None])])
    pieces = packing.token_pieces(docs, queries.JSON_50K, capacity=8).withColumn("offset", F.lit("clash"))
    packed = packing.pack(pieces, capacity=8)
    rows = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert rows[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert packing.pack(pieces.limit(0), capacity=8).count() == 0


# -- 4 substrings, 6 lines -------------------------------------------------------------------------

def brute_substring(rows, window=13):
    first = {}
    for doc, text in rows:
        if doc is not None:
            w = words(text)
            for p in range(len(w) - window + 1):
                key = tuple(w[p:p + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[p:p + window])] < doc:
                gone[p:p + window] = [True] * window
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def random_texts(seed, n=120, alphabet=4, length=60):
    """Few words, so runs and pairs repeat at many places and depths."""
    rng = random.Random(seed)
    base = [" ".join(rng.choices("abcdefgh"[:alphabet], k=length)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9)))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(base).split()
            a = rng.randrange(len(w))
            parts += [" ".join(w[a:a + rng.randint(1, 40)]), rng.choice(["x", "a a a a a a a a a a a a a a a a", ""])]
        rows.append((rng.randrange(10 ** 6) if i % 9 else i, "  ".join(parts) + rng.choice(["", "\n", " \t"])))
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("seed", range(4))
def test_substring_equals_brute_force(spark, seed, monkeypatch):
    from costweave.llm import common
    monkeypatch.setattr(common, "BATCH_BYTES", 700)
    rows = random_texts(seed, alphabet=2 + seed) + ([r for r in odd_rows() if r[0] != 4] if seed == 0 else [])
    docs = documents(spark, rows).repartition(5).withColumn("N_Words", F.lit("clash")).withColumn("ranges", F.lit(1))
    got = substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "text").collect()
    have = sorted(((-1 if r[0] is None else r[0]), r[1], r[2], " ".join(words(r[3]))) for r in got)
    want = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in brute_substring(rows))
    assert have == want
    kept = {r["doc_id"]: r["text"] for r in got if r["n_removed"] == 0}
    assert all(kept[d] == t for d, t in rows if d in kept)


def test_repeated_rows_keep_their_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [(1, text), (1, text), (2, text)])
    got = sorted((r["doc_id"], r["n_removed"]) for r in substring.remove_repeats(docs).collect())
    assert got == [(1, 0), (1, 0), (2, 40)]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def brute_lines(rows, run=3, content=4):
    docs = sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: r[0])
    seen, gone, out = set(), set(), {}

    def window(doc, lo, hi, key, marks):
        if key in seen:
            gone.update((doc, m) for m in marks)
        seen.add(key)

    for doc, text in docs:
        ls = [] if text is None else text.split("\n")
        full = [len(words(x)) >= content for x in ls]
        for i, line in enumerate(ls):
            if full[i]:
                window(doc, i, i, ("one", line), [i])
                continue
            above = next((k for k in range(i, -1, -1) if full[k]), None)
            below = next((k for k in range(i, len(ls)) if full[k]), None)
            if above is not None:
                window(doc, above, i, ("after", *ls[above:i + 1]), [i])
            if below is not None:
                window(doc, i, below, ("before", *ls[i:below + 1]), [i])
        for p in range(len(ls) - run + 1):
            if any(words(x) for x in ls[p:p + run]):
                window(doc, p, p + run - 1, ("run", *ls[p:p + run]), range(p, p + run))
    for doc, text in docs:
        if text is None:
            out[doc] = (0, 0, None)
            continue
        ls = text.split("\n")
        kept = [x for i, x in enumerate(ls) if (doc, i) not in gone]
        out[doc] = (len(ls), len(ls) - len(kept), "\n".join(kept))
    return out


def test_lines_equal_brute_force(spark, monkeypatch):
    from costweave.llm import common
    monkeypatch.setattr(common, "BATCH_BYTES", 300)
    rng = random.Random(2)
    kinds = ["a", "b", "c", "", " ", "long line", *(f"content line of {k}" for k in "xyz"), "  four words\tin here "]
    rows = [(i, "\n".join(rng.choices(kinds, k=rng.randint(0, 14)))) for i in range(150)]
    rows += [(r[0] + 1000 if r[0] else None, r[1]) for r in odd_rows() if r[0] != 4]
    docs = documents(spark, rows).repartition(4).withColumn("n_lines", F.lit("clash"))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in lines.remove_lines(docs).collect()}
    want = brute_lines(rows)
    assert {k: v for k, v in got.items() if k is not None} == want
    assert got[None][1] == 0 and len(got) == len(rows)
    assert lines.remove_lines(docs.limit(0)).count() == 0


def test_single_lines_and_blocks_go_later(spark):
    licence = "Released under the MIT License."
    rows = [(1, f"One text of its own.\n{licence}\nyes"), (2, f"Another text, not the same.\n{licence}\nno"),
            (3, f"Third of these few texts.\nHead\n{licence}\nyes\nand"), (4, f"Fourth of these few texts.\nHead\n{licence}\nyes"), (5, "yes"),
            (6, licence), (7, "Twice in here it is.\n\nTwice in here it is.\n\nlast")]
    got = {r["doc_id"]: r["text"] for r in lines.remove_lines(documents(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "Another text, not the same.\nno", 3: "Third of these few texts.\nHead\nand",
                   4: "Fourth of these few texts.", 5: "yes", 6: "", 7: "Twice in here it is.\n\nlast"}


# -- 8 near-duplicates -----------------------------------------------------------------------------

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def similar(s, t):
    a, b = words(s), words(t)
    if not a or not b:
        return 0.0
    k, m = min(5, len(a)), min(5, len(b))
    a = [tuple(a[i:i + k]) for i in range(len(a) - k + 1)]
    b = [tuple(b[i:i + m]) for i in range(len(b) - m + 1)]
    n = lcs(a, b)
    return n / (len(a) + len(b) - n)


def near_rows(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = rng.choices(vocab, k=rng.choice([3, 8, 60, 150]))
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


def test_alignment_equals_dynamic_programme():
    rng = random.Random(1)
    for _ in range(200):
        a = np.array(rng.choices(range(6), k=rng.randint(1, 25)), np.uint64)
        b = a.copy()
        for _ in range(rng.randint(0, 5)):
            b[rng.randrange(len(b))] = rng.randrange(6)
        n = lcs(a.tolist(), b.tolist())
        want = n / (len(a) + len(b) - n)
        assert minhash.similarity(a, b) == pytest.approx(want if want >= 0.8 else 0.0)


def test_classes_equal_brute_force(spark):
    rows = near_rows(4)
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, s) in enumerate(rows):
        for j, t in rows[:n]:
            if similar(s, t) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(spark, rows)).collect()}
    want = {i: find(i) for i, _ in rows}
    assert got == want


def test_short_near_duplicates(spark):
    """Words appended, prepended, cut off and shifted, at lengths where sketches miss."""
    rng = random.Random(7)
    rows, pairs = [], []
    for length in range(5, 26):
        for case in range(6):
            w = [f"l{length}c{case}w{j}" for j in range(length)]
            if case == 5:
                w = rng.choices(w[:3], k=length)                 # shingles that repeat
            more = [f"l{length}c{case}x{j}" for j in range(1 + case % 2)]
            other = (w + more, more + w, w[1:], w[1:] + more[:1], more[:1] + w + more[:1], w[1:] + w[:1])[case]
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(other))]
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(documents(spark, rows)).collect()}
    want = {}
    for a, b in pairs:
        want |= {a: a, b: a if similar(rows[a][1], rows[b][1]) >= 0.8 else b}
    assert sum(want[b] == a for a, b in pairs) > 60
    assert got == want


def test_near_duplicates_of_odd_rows(spark):
    out = minhash.classes(documents(spark, odd_rows() + [(9, "same row"), (10, "")]).withColumn("keys", F.lit(0))).collect()
    got = sorted(((-1 if r[0] is None else r[0]), r[1], r[2]) for r in out)
    assert got == [(-1, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 5, True),
                   (6, 6, True), (7, 7, True), (9, 4, False), (10, 10, True)]
    assert minhash.classes(documents(spark, [])).count() == 0


# -- 9 shards, 10 languages ------------------------------------------------------------------------

def test_shards_are_balanced_and_contiguous(spark):
    rows = [(i if i % 50 else None, f"{i // 4} " + "é" * (i % 37 // 4), None) for i in range(1600)] + [(77, None), (77, None)]
    rows += [(5000, "long " * 3000)]
    sized = sharding.sized_documents(documents(spark, rows))
    for group, slack in (("text_group", 1 / sharding.WHOLE), (None, 0)):
        out = sharding.shard(sized, 7, group=group).collect()
        assert len(out) == len(rows)
        size = {}
        for r in out:
            size.setdefault(r["shard"], []).append(r)
        total = sum(r["size"] for r in out)
        order = []
        for k in sorted(size):
            own = sorted(size[k], key=lambda r: r["slot"])
            assert [r["slot"] for r in own] == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - total / 7) <= max(r["size"] for r in out) + 2 * slack * total / 7
            order += [(r["text_group"], -1 if r["doc_id"] is None else r["doc_id"], r["size"]) for r in own]
        assert order == sorted(order) and set(size) <= set(range(7))
        if group:
            places = {}
            for r in out:
                places.setdefault(r["text_group"], set()).add(r["shard"])
            assert all(len(p) == 1 for p in places.values())
    assert sharding.shard(sharding.sized_documents(documents(spark, []))).count() == 0


def test_shards_of_a_hot_group_and_clashing_names(spark):
    rows = [(i, "the same text") for i in range(900)] + [(1000 + i, f"text {i}") for i in range(900)]
    sized = sharding.sized_documents(documents(spark, rows)).selectExpr(
        "*", "doc_id + 1 AS part_", "doc_id + 2 AS row_", "doc_id + 3 AS start_", "'x' AS shard", "doc_id + 4 AS home_")
    out = sharding.shard(sized, 8).collect()
    assert len(out) == 1800 and {r["shard"] for r in out} == set(range(8))
    assert all((r["part_"], r["row_"], r["start_"], r["home_"]) == tuple(r["doc_id"] + k for k in (1, 2, 3, 4)) for r in out)
    size = [sum(r["size"] for r in out if r["shard"] == k) for k in range(8)]
    assert max(size) - min(size) <= 2 * sum(size) / 8 / sharding.WHOLE + 14


def test_shard_query(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, SF001, "documents").collect()}
    rows = queries.QUERIES["op9_sharding"](spark, SF001).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]))


def test_languages_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SF01, "documents").collect()}
    rows = queries.QUERIES["op10_language_id"](spark, SF01).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_kernel_regression_equals_dense_form(monkeypatch):
    """The collapsed n-gram weights score as kernel values times coefficients do."""
    texts = ["the cat sat", "the dog ran", "le chat noir", "un chien brun", "the end", "la fin"]
    langs = ["en", "en", "fr", "fr", "en", "fr"]
    model = langid.fit(texts, langs)
    sets = [set(langid.grams(t).tolist()) for t in texts]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    target = np.array([[1.0 if x == c else -1.0 for c in ("en", "fr")] for x in langs])
    order = range(6)
    system = kernel.T @ kernel + langid.RIDGE * kernel + 1e-8 * np.eye(6)
    want = kernel @ np.linalg.solve(system, kernel.T @ target)
    table = model.lookup()
    got, n, share = model.product([langid.grams(texts[i]) for i in order], table)
    assert n.tolist() == [len(s) for s in sets] and (share == 1).all()
    assert np.allclose(got, want, atol=1e-6)
    monkeypatch.setattr(langid, "VALUES", 30)                  # several products a batch
    assert np.allclose(model.product((langid.grams(texts[i]) for i in order), table)[0], want, atol=1e-6)
    both = model.score([None, *texts, "12 34"], table)
    assert both[0][0] == both[0][-1] == "und" and [model.score([t])[0][0] for t in texts] == both[0][1:-1]


def test_languages_of_odd_rows(spark):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(["the thing", "le truc"] * 30)]
    docs = documents(spark, rows + [(100, None), (101, "12 34 !"), (102, ""), (None, "the"), (103, "🙂")])
    docs = docs.withColumn("SCORE", F.lit("clash"))
    model = langid.train(docs)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    assert all(out[i] == ("und", 0.0) for i in (100, 101, 102, 103)) and out[None][0] in ("en", "fr")
    empty = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
