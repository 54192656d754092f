"""Plain versions of the operators, and the odd rows every one of them must take."""
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Null id, null, empty and blank texts, repeated rows, a very long text."""
    return [(None, "null id " * 20), (1, None), (2, ""), (3, " \n\t "), (4, "same row"), (4, "same row"),
            (5, " ".join(f"w{i % 977}x{i // 7}" for i in range(30000))), (6, "é ß 🙂 x\x0by\x0cz"), (7, "a\n\n\n\nb")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")
