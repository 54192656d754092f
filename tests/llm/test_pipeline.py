"""The pipeline against the plain versions of its stages."""
import corpus_pipeline
from tests.conftest import SF001
from tests.llm.helpers import documents, odd_rows, table
from tests.llm.test_text_operators import SF01, brute_lines, brute_substring, check_packing, similar


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_stages_decide_what_their_operators_say(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    texts = by_id(docs)
    named = by_id(corpus_pipeline.language_id(spark, docs, SF001))
    assert set(named) <= set(texts) and len(named) > 0.97 * len(texts)
    cut = corpus_pipeline.line_dedup(spark, docs, SF001)
    assert cut.columns == columns
    want = {i: t[2] for i, t in brute_lines([(i, r["text"]) for i, r in texts.items()]).items() if t[2] and t[2].strip()}
    assert {i: r["text"] for i, r in by_id(cut).items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in by_id(cut).values())
    near = by_id(corpus_pipeline.near_dedup(spark, docs, SF001))
    gone = set(texts) - set(near)
    assert gone and all(any(similar(texts[g]["text"], texts[k]["text"]) >= 0.8 for k in texts if k < g) for g in gone)
    sub = by_id(corpus_pipeline.substring_dedup(spark, docs, SF001))
    want = {r[0]: r[3] for r in brute_substring([(i, r["text"]) for i, r in texts.items()]) if r[3]}
    assert {i: " ".join(r["text"].encode().split() and r["text"].split()) for i, r in sub.items()} == {
        i: " ".join(t.split()) for i, t in want.items()}


def test_whole_run(spark, tmp_path):
    from tokenizers import Tokenizer
    from costweave.llm.queries import JSON_50K
    tok = Tokenizer.from_file(JSON_50K)
    docs = table(spark, SF001, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        docs.write.mode("overwrite").parquet(path := f"{tmp_path}/{stage.__name__}")
        docs = spark.read.parquet(path)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SF001).collect()
    check_packing(rows, texts, lambda t: tok.encode(t, add_special_tokens=False).ids)


def test_odd_documents_and_none(spark):
    rows = odd_rows() + [(20 + i, f"clean text number {i} says the thing", "en") for i in range(8)]
    for docs in (documents(spark, rows), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF001).collect()


def test_language_stage_drops_foreign_texts_and_keeps_short_ones(spark):
    foreign = ["这是一个没有学过的语言的句子，应该被丢弃。", "Это предложение на русском языке, которого модель не знает.",
               "Ez egy magyar nyelvű mondat, amelyet a modell soha nem látott, ezért el kell dobni.",
               "Tämä on suomenkielinen lause, jota malli ei ole koskaan nähnyt.",
               "To jest zdanie po polsku, którego model nigdy nie widział."]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    known = {r["doc_id"]: r["text"] for r in docs.filter("lang is not null").collect()}
    first = max(known) + 1
    short = sorted({" ".join(t.split()[:n]) for t in list(known.values())[:200] if t for n in (4, 8)} - {""})
    short = [t for t in short if not any(c.isdigit() or c in "#$%&*!=@" for c in t)]
    planted = documents(spark, [(first + i, t) for i, t in enumerate(foreign + short)])
    got = set(by_id(corpus_pipeline.language_id(spark, docs.unionByName(planted.select(docs.columns)), SF01)))
    assert not got & set(range(first, first + len(foreign)))
    stayed = sum(first + len(foreign) + i in got for i in range(len(short)))
    assert len(short) > 100 and stayed >= 0.99 * len(short)
    assert len(got & set(known)) >= 0.995 * len(known)
