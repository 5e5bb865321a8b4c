import random

import pytest

from frostline.llm.substring import dedup_substrings, shortened_documents

SPACE = " \t\n\r\x0b\x0c"


def words(text):
    return [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]


def brute(rows, span):
    """rows: (doc_id, text) with distinct ids, null id last."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - span + 1):
            gram = tuple(w[i:i + span])
            if gram in seen:
                gone[i:i + span] = [True] * span
            seen.add(gram)
        out[doc_id] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(rng.choice([19, 20, 21, 60]))] for k in range(6)]
    rows = [(None, " ".join(passages[0])), (3, None), (4, ""), (5, " \n\t ")]
    for doc_id in range(10, 120):
        w = [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        rows.append((doc_id, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(d, rows[30][1]) for d in range(200, 230)]  # copies
    rows.append((300, " ".join(["again"] * 3000)))
    rows.append((301, " ".join([f"y{i % 700}" for i in range(60000)])))  # long, periodic
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span", [20, 7])
def test_equals_brute_force(spark, span):
    rows = corpus(span)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in dedup_substrings(df, span).collect()}
    assert got == brute(rows, span)


def test_small_blocks_and_groups_give_the_same(spark, monkeypatch):
    from frostline.llm import blocks

    monkeypatch.setattr(blocks, "SMALLEST_BLOCK", 2000)
    monkeypatch.setattr(blocks, "BLOCK_BYTES_AT_1GB", 2000)
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in dedup_substrings(df).collect()}
    assert got == brute(rows, 20)


def test_repeated_rows_keep_one_and_extra_columns_stay(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, 5, [1])] * 3, "doc_id long, text string, n_words int, more array<int>")
    out = dedup_substrings(df.repartition(3))
    assert out.columns == ["doc_id", "text", "more", "n_words", "n_removed", "kept"]
    rows = out.collect()
    assert sorted(r.n_removed for r in rows) == [0, 40, 40]
    assert all(r.more == [1] and r.text == text for r in rows)


def test_tasks_that_read_the_same_rows_keep_one_copy(spark):
    rows = [(d, " ".join(f"d{d}w{i}" for i in range(30))) for d in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = dedup_substrings(df.union(df)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == sorted((d, gone) for d in range(20) for gone in (0, 30))
    # One repeated row, alike in number in every task.
    text = rows[0][1]
    alike = spark.range(0, 12, 1, 4).selectExpr("cast(7 as long) doc_id", f"'{text}' text")
    assert sorted(r.n_removed for r in dedup_substrings(alike).collect()) == [0] + [30] * 11


def test_layout_is_kept(spark):
    a = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, a), (2, f"first line\nsecond {a}\n\nlast  line\n")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in dedup_substrings(df, keep_layout=True).collect()}
    assert got == {1: a, 2: "first line\nsecond last  line"}


def test_empty_table(spark):
    out = dedup_substrings(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == [] and out.columns == ["doc_id", "text", "n_words", "n_removed", "kept"]


def test_shortened_documents_keep_their_other_columns(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"first {passage}", "KEEP", 4, 0), (2, f"second\n{passage} end", "KEEP", 5, 0), (3, passage, "KEEP", 6, 0), (4, None, "x", 7, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept int, n_chars int")
    out = shortened_documents(df)
    assert out.dtypes == df.dtypes
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, f"first {passage}", "KEEP", 4, len(passage) + 6), (2, "second\nend", "KEEP", 5, 10)]
