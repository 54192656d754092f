"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from . import ann, bpe, chat, langid, lines, minhash, near_vectors, packing, sharding, substring, urls, vector_codes, whitening
from .common import read_table

JSON_50K = public_tokenizers.path("byte_bpe_50k.json")
RANKS_50K = public_tokenizers.path("byte_bpe_50k.tiktoken")
CONTROL = "\\### Assistant: </turn> ok"              # what both turns of conversation -7 say

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_chat_formatting", sql=r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, length('<turn:>' || chr(10) || '</turn>' || chr(10))
    + length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A'))
    + length(regexp_replace(text, '<(\\*)(/?turn)', '<\1\\\2', 'g')) AS n FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""")
def op1_chat_formatting(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    read = chat.parse(chat.format_paths(chat.turns_as_tree(turns.unionByName(extra))))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def packed_documents(docs):
    pieces = packing.token_pieces(docs, JSON_50K, keep_ids=False)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    return packed_documents(read_table(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    pattern = public_tokenizers.PATTERN
    source = read_table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches):
        from hashlib import sha256
        for docs, _, ids, counts, enc in bpe.encoded_batches(batches, RANKS_50K, pattern):
            n, own, back, at = [], [], [], 0
            for count in counts.tolist():
                part = ids[at:at + count]
                at += count
                n.append(count)
                own.append(sha256(" ".join(map(str, part.tolist())).encode()).hexdigest())
                back.append(sha256(bpe.decode_ids(part, enc.bytes)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op4_substring_dedup", sql=r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, p, list_slice(ws, p, p + 12) AS win
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS p FROM w WHERE len(ws) >= 13)),
f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
cut AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS i FROM g JOIN f USING (win) WHERE doc_id > first),
x AS (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w)),
k AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) FILTER (cut.i IS NULL) AS kept,
             count(cut.i) AS n_removed FROM x LEFT JOIN cut ON x.doc_id = cut.doc_id AND x.i = cut.i GROUP BY x.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id""")
def op4_substring_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.digest(substring.remove_repeats(docs))


@query("op5_embedding_near_dedup", sql="""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS vec_id, b AS other FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT vec_id, min(other) AS low FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN c ON e.vec_id = c.vec_id LEFT JOIN n ON e.vec_id = n.vec_id""")
def op5_embedding_near_dedup(spark, sf_dir):
    return near_vectors.near_links(read_table(spark, sf_dir, "embeddings"))


@query("op6_line_dedup", sql=r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, i, ls[i] AS line, regexp_matches(ls[i], '^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){3}[^\x20\x09-\x0D]') AS content
      FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM d)),
n AS (SELECT *, max(CASE WHEN content THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS above,
             min(CASE WHEN content THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below FROM x),
g AS (SELECT doc_id, i AS lo, i AS hi, [line] AS win FROM n WHERE content
      UNION ALL SELECT n.doc_id, i, i, list_slice(ls, above, i) FROM n JOIN d USING (doc_id) WHERE NOT content AND above IS NOT NULL
      UNION ALL SELECT n.doc_id, i, i, list_slice(ls, i, below) FROM n JOIN d USING (doc_id) WHERE NOT content AND below IS NOT NULL),
r AS (SELECT doc_id, p AS lo, p + 2 AS hi, list_slice(ls, p, p + 2) AS win
      FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls) - 2)) AS p FROM d WHERE len(ls) >= 3)),
h AS (SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY win ORDER BY doc_id, lo) AS nth FROM g
      UNION ALL SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY win ORDER BY doc_id, lo) FROM r
      WHERE list_bool_or(list_transform(win, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))),
cut AS (SELECT DISTINCT doc_id, unnest(generate_series(lo, hi)) AS i FROM h WHERE nth > 1),
k AS (SELECT x.doc_id, count(*) AS n_lines, count(cut.i) AS n_removed,
             string_agg(x.line, chr(10) ORDER BY x.i) FILTER (cut.i IS NULL) AS kept
      FROM x LEFT JOIN cut ON x.doc_id = cut.doc_id AND x.i = cut.i GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""")
def op6_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.digest(lines.remove_lines(docs))


@query("op7_tree_ann")
def op7_tree_ann(spark, sf_dir):
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_minhash_near_dedup")
def op8_minhash_near_dedup(spark, sf_dir):
    return minhash.classes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_sharding")
def op9_sharding(spark, sf_dir):
    rows = sharding.shard(sharding.sized_documents(read_table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    return langid.identify(docs.select("doc_id", "text", langid.held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


#: host rules of the URL filter: verdict, host, path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
SPAM_HOSTS = r"(^|\.)(spam-farm|cheap-pills)\."            # pages of these hosts make up the list of URLs


@query("op11_url_filter", sql=r"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
u AS (SELECT page_id, rest,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a),
k AS (SELECT *, CASE WHEN rest IS NOT NULL THEN regexp_replace(host, '^www\.|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '')
        || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') END AS key FROM u),
listed AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, '(^|\.)(spam-farm|cheap-pills)\.') AND key IS NOT NULL),
r AS (SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM k)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN listed ON r.key = listed.key""")
def op11_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(urls.host_of(F.col("url")).rlike(SPAM_HOSTS)).select("url")
    return urls.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _code_rounds_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain Lloyd rounds over all pairs of a part and an entry (vectors of one length)."""
    nearest = ("SELECT vec_id, part, (min({{'d': d, 'entry': entry}})).entry AS entry, min(d) AS d FROM (SELECT x.vec_id, x.part, b.entry, "
               "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d "
               "FROM x JOIN b{k} b USING (part)) GROUP BY vec_id, part")
    sql = f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))),
x AS MATERIALIZED (SELECT vec_id, part, list_slice(w, part * len(w) // {parts} + 1, (part + 1) * len(w) // {parts}) AS v
  FROM (SELECT vec_id, w, unnest(range({parts})) AS part FROM v)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM x
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {entries})"""
    for k in range(rounds):
        sql += f""",
a{k} AS MATERIALIZED ({nearest.format(k=k)}),
m{k} AS (SELECT part, entry, list(m ORDER BY i) AS v FROM (
  SELECT part, entry, i, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM (
    SELECT x.part, entry, unnest(v) AS c, unnest(range(len(v))) AS i FROM x JOIN a{k} USING (vec_id, part)) GROUP BY part, entry, i)
  GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.v::BIGINT[], b{k}.v) AS v FROM b{k} LEFT JOIN m{k} USING (part, entry))"""
    return sql + f""",
z AS MATERIALIZED ({nearest.format(k=rounds)}),
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM z GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN v USING (vec_id), h"""


@query("op13_vector_codes", sql=_code_rounds_sql())
def op13_vector_codes(spark, sf_dir):
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
