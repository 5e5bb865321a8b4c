import zlib

import numpy as np

from frostline.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_bundle_equals_bound_letters():
    texts = ["Abc, d", "", "é1é", "日本語です"]
    got = L._Grams(texts).bundle(np.arange(4), 4)
    for t, row in zip(texts, got):
        folded = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
        folded = " " + " ".join(folded.split()) + " " if folded.split() else " "
        want = np.zeros(L.DIMENSIONS)
        for i in range(len(folded) - 2):
            a, b, c = (L._vectors(np.array([0 if x == " " else ord(x)]))[0].astype(int) for x in folded[i:i + 3])
            want += np.roll(a, 2) * np.roll(b, 1) * c
        assert (row == want).all()


def test_letters_have_nearly_orthogonal_vectors():
    v = L._vectors(np.arange(97, 123)).astype(int)
    off = (v @ v.T)[~np.eye(26, dtype=bool)]
    assert abs(off).max() < 5 * L.DIMENSIONS ** 0.5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and any(c.isalpha() for c in r.text)]
    right = sum(r.lang_pred == r.lang for r in held) / len(held)
    print("held-out accuracy", right, len(held))
    assert right > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", "x"), (3, "der hund und die katze", "de", "x"), (None, "null id the the", "fr", "x"),
            (4, None, "en", "x"), (5, "123 !!", "en", "x"), (6, "", None, "x"), (7, "the dog", None, "x"), (8, "und der hund", None, "x"),
            (8, "und der hund", None, "x"), (9, "the cat " * 100000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string").repartition(3)
    learned, _ = L.learn(df.where("doc_id is not null"))
    assert learned == ["de", "en"]
    got = {(r.doc_id, r.lang_pred) for r in L.identify(df).collect()}
    want = {(4, "und"), (5, "und"), (6, "und")} | {(7, "en"), (8, "de"), (9, "en")}
    folds = {i for i in (1, 3) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert not folds and want <= got
    none = L.identify(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert L.identify(df.where("false")).collect() == []
