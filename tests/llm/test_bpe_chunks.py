import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from frostline.llm import bpe_chunks as C

PATH = public_tokenizers.path("word_bpe_49k.json")


def corpus():
    rng = random.Random(2)
    odd = ["don't", "Ünïcode", "été", "́lead", "12345", "a<|startoftext|>b", "<|endoftext|>", "x\xa0y", " z",
           "ΣΑΣ", "İ", "ſ", "日本語", "emoji😀!", "…", "it's", "'re", "ab\x1ccd", "\x85", "ﬁ", "한국", "​", "..!?", "_"]
    plain = [f"word{i}" for i in range(300)] + ["the", "of", "and"] * 60
    passage = [rng.choice(plain) for _ in range(500)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (None, "null id"), (3, "x" * 20000), (4, " ".join(odd)), (5, "\n".join(odd * 40))]
    for doc_id in range(10, 90):
        w = [rng.choice(odd if rng.random() < 0.2 else plain) for _ in range(rng.randrange(300))]
        if rng.random() < 0.5:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(100):rng.randrange(200, 500)]
        rows.append((doc_id, rng.choice([" ", "\n", "  ", "\t \r\n"]).join(w)))
    rows.append((200, " ".join(rng.choice(plain + odd) for _ in range(40000))))
    return rows + rows[20:24]


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_library(spark, monkeypatch, small):
    if small:  # many blocks, so that chunks are shared between them
        from frostline.llm import blocks

        monkeypatch.setattr(blocks, "SMALLEST_BLOCK", 3000)
        monkeypatch.setattr(blocks, "BLOCK_BYTES_AT_1GB", 3000)
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, ids int").repartition(3)
    got = sorted((str(r.doc_id), r.n_tokens, list(r.ids), r.decoded) for r in C.encode_documents(df, PATH).collect())
    own = Tokenizer.from_file(PATH)
    want = []
    for d, t in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((str(d), len(ids), ids, own.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_a_join_that_does_not_stand_is_repaired():
    def encode(texts):  # a toy tokenizer that joins "new york" into one id
        out = []
        for t in texts:
            ids, w, i = [], t.split(), 0
            while i < len(w):
                both = w[i:i + 2] == ["new", "york"]
                ids.append(7 if both else len(w[i]) + 100)
                i += 1 + both
            out.append(ids)
        return out

    left, right = "a bb ccc dddd new".split(), "york eeeee a bb ccc".split()
    parts = C.repaired(left, right, C._bytes(encode([" ".join(left)])[0]), C._bytes(encode([" ".join(right)])[0]), encode)
    assert b"".join(parts) == C._bytes(encode([" ".join(left + right)])[0])
    assert len(parts[1]) == 4 * 3  # beyond the stretch, the chunk's own ids are used


def test_words_are_encoded_together():
    from frostline.llm.pieces import Pieces

    class Counted(Pieces):
        given = 0

        def encode(self, texts):
            self.given += len(texts)
            return super().encode(texts)

    words = [f"w{a}{b}ord" for a in "abcdefghij" for b in "klmnopqrst"] + ["été", "İ.", "</w>", "a<|endoftext|>b", "x,", ",", "12.", "\x1cz", "it's"]
    pieces = Counted(PATH)
    pieces.given = 0
    assert C._coded([" ".join(words).encode(), b"one two", b"x,"], pieces) == [
        C._bytes(i) for i in pieces.encode([" ".join(words), "one two", "x,"])]
    assert pieces.given < len(words) / 4


def test_chunk_keys_are_made_once(spark, tmp_path, monkeypatch):
    from frostline.llm import blocks

    monkeypatch.setattr(blocks, "SMALLEST_BLOCK", 3000)
    monkeypatch.setattr(blocks, "BLOCK_BYTES_AT_1GB", 3000)
    rows = [(d, t) for d, t in corpus() if d is not None]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    coded = C.encode_documents(spark.read.parquet(str(tmp_path / "d")), PATH)
    assert len(coded.collect()) == len(rows)
    plan = coded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange [key#" in plan  # the count and the join read one exchange


def test_memo_may_be_full():
    from frostline.llm.pieces import Pieces

    small = Pieces(PATH, most=3)
    words = "one two three four five one six".split()
    for _ in range(2):
        known = small.learn(words)
        assert small.joined(words, known) == C._bytes(small.encode([" ".join(words)])[0])
    assert len(small.memo) <= 3


def test_a_block_is_encoded_and_decoded_in_small_parts(monkeypatch):
    import pyarrow as pa

    from frostline.llm import blocks
    from frostline.llm.pieces import Pieces

    class Counted(Pieces):
        def __init__(self, path):
            self.decoded, self.sizes_given = [], []
            super().__init__(path)
            self.real, self.tokenizer = self.tokenizer, self

        def decode_batch(self, lists, **how):
            self.decoded.append(sum(map(len, lists)))
            return self.real.decode_batch(lists, **how)

        def encode_batch_fast(self, texts, **how):
            return self.real.encode_batch_fast(texts, **how)

        def ids_of(self, data, begins):
            self.sizes_given.append(len(data))
            return super().ids_of(data, begins)

    texts = [" ".join(f"w{(d * 7 + k) % 900}" for k in range(1000)) for d in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600), pa.int64()), "text": texts})
    rows = blocks._row(0, [batch], "doc_id").column(1)[0].as_py()
    pieces = Counted(PATH)
    monkeypatch.setattr(C, "pieces_of", lambda path, most: pieces)
    out = [r for b in C._encode_all(rows, None, PATH, True) for r in b.to_pylist()]
    own = Tokenizer.from_file(PATH)
    want = own.encode_batch(texts, add_special_tokens=False)
    assert [r["ids"] for r in out] == [e.ids for e in want]
    assert [r["decoded"] for r in out] == own.decode_batch([e.ids for e in want], skip_special_tokens=False)
    assert max(pieces.decoded) <= 1 << 17 and max(pieces.sizes_given) <= 3 << 19


def test_a_tokenizer_that_keeps_white_space_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        C.encode_documents(df, public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(spark):
    assert C.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
