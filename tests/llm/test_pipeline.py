import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from test_quality import base  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402
from test_substring import brute as brute_substrings  # noqa: E402


def corpus():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    shared = sentence(40)
    rows = []
    for i in range(120):
        lines = [sentence(rng.randrange(8, 25)) for _ in range(rng.randrange(1, 9))]
        if rng.random() < 0.3:
            lines.append(shared)
        if rng.random() < 0.2:
            lines.append("Home | News | Sport | About")
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "b", None])))
    for i in range(120, 150):  # copies, some with a word changed
        _, text, lang, source = rng.choice(rows[:120])
        w = text.split(" ")
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), lang, source))
    rows += [(200, None, None, "a"), (201, "", "en", None), (202, " | ".join(word() for _ in range(90)), "en", "b")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]


def test_each_stage_equals_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    columns = docs.dtypes
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs.collect())
        if name != "bpe_encode":
            assert docs.dtypes == columns

    before, after = seen["quality_rules"]
    lost = set(before) - {r.doc_id for r in after}
    assert {d for d, r in before.items() if base(r.text)[5]} <= lost and 202 in lost
    assert all("|" not in r.text and r.n_chars == len(r.text) for r in after)

    before, after = seen["simhash_near_dedup"]
    ids = sorted(before)
    want = set(brute_components([(d, brute_fingerprint(before[d].text)) for d in ids]))
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)
    assert all(r == before[r.doc_id] for r in after)

    before, after = seen["substring_dedup"]
    want = {d: k for d, (n, gone, k) in brute_substrings([(d, r.text) for d, r in before.items()], 20).items() if gone < n}
    assert {r.doc_id: " ".join(r.text.split()) for r in after} == want

    before, after = seen["mix_sources"]
    taken = sum(len(r.text.split()) for r in after)
    assert abs(taken - 1.5 * sum(len(r.text.split()) for r in before.values())) <= 3
    assert {r.doc_id for r in after} <= set(before)

    from public_tokenizers import path
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path("word_bpe_49k.json"))
    _, after = seen["bpe_encode"]
    mixed = sorted((r.doc_id, own.encode(r.text, add_special_tokens=False).ids) for r in seen["mix_sources"][1])
    assert sorted((r.doc_id, list(r.ids)) for r in after) == mixed


def test_run_over_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 50
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "mix_sources", "bpe_encode"]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
