import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from frostline.llm import token_files as K
from frostline.llm.elias_fano import EliasFano

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(-2**62, 2**62 - 1), max_size=600), st.integers(0, 40))
def test_elias_fano_round_trip(values, shift):
    values = sorted(v >> shift for v in values)
    if values and values[-1] - values[0] >= 2**63:
        return
    code = EliasFano.from_bytes(EliasFano.of(np.array(values, dtype=np.int64)).to_bytes())
    assert code.values().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20000))
    assert len(EliasFano.of(ends).to_bytes()) * 8 / len(ends) < 2.3 + np.log2(ends[-1] / len(ends))


def corpus():
    rng = random.Random(4)
    odd = ["don't", "Ünïcode", "  two", "\n", "\n\n", " \n", "\t", "x\xa0y", " \x85z", "<|endoftext|>", "日本語", "😀", "...",
           "12345", " ", "a  b", "\r\n", "'re", "\x1c", " \x0b w"]
    rows = [(7, None), (8, ""), (9, " "), (10, " \n \n"), (None, "null id"), (-5, "negative id"), (11, "y" * 9000)]
    for doc_id in rng.sample(range(100, 10**12), 120):
        w = [rng.choice(odd if rng.random() < 0.25 else ["the", "word", "of", "thing", "and."]) for _ in range(rng.randrange(200))]
        rows.append((doc_id, rng.choice([" ", "\n", "", "  "]).join(w)))
    rows.append((12, " ".join(str(rng.randrange(10**6)) for _ in range(30000))))
    return rows + rows[20:22] + [(None, None)]


def test_round_trip_equals_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "FILE_TEXT_BYTES", 20000)
    rows = corpus()
    df = spark.createDataFrame([(t, d, 0) for d, t in rows], "text string, doc_id long, start int").repartition(4)
    files = K.write_token_files(df, f"file://{tmp_path}/out", PATH, 2)
    got = K.read_token_files(spark, files).collect()
    own = Tokenizer.from_file(PATH)
    want = sorted((d is None, d or 0, own.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows)
    found = sorted(((r.doc_id is None, r.doc_id or 0, list(r.ids)), r.start, r.n_tokens, r.ids_crc32) for r in got)
    assert [f[0] for f in found] == want
    starts = sorted((f[1], f[2]) for f in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert [f[0][1] for f in sorted((f for f in found if not f[0][0]), key=lambda f: f[1])] == sorted(d for d, _ in rows if d is not None)
    assert all(crc == zlib.crc32(np.array(ids, "<u4").tobytes()) and n == len(ids) for (_, _, ids), _, n, crc in found)
    listed = files.collect()
    assert len(listed) > 3
    one = K.TokenFile(listed[0].path)
    all_of_it = list(one.documents())
    for i in random.Random(0).sample(range(one.n_docs), min(10, one.n_docs)):
        doc_id, ids = one.document(i)
        assert doc_id == all_of_it[i][0] and ids.tolist() == all_of_it[i][2].tolist()
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_memo_is_bounded_by_bytes():
    from frostline.llm.pieces import Pieces

    pieces = Pieces(PATH, most=100)
    whole = [f"uncut\u00a0text number {i} " + "with many words " * 500 for i in range(40)]
    short = [f"{i} \u3000" + "語" * 50 for i in range(200)]
    for texts in (whole, *([t] for t in short)):
        for _ in range(2):
            data, lengths = K._encoded(texts, pieces, 2, 2)
            want = [e + [2] for e in pieces.encode(texts)]
            assert np.frombuffer(data, "<u2").tolist() == sum(want, []) and lengths.tolist() == [len(e) for e in want]
    held = sum(len(p.encode()) + len(ids) for p, ids in pieces.memo.items())
    assert 0 < len(pieces.memo) <= 100 and held <= 100 * 200
    assert max(map(len, pieces.memo)) <= 64


def test_distinct_pieces_are_encoded_together():
    from frostline.llm.pieces import Pieces

    class Counted(Pieces):
        given = 0

        def encode(self, texts):
            self.given += len(texts)
            return super().encode(texts)

    rng = random.Random(4)
    odd = [",", "été,", "x.", "X,", "a.b", "\u00a0z", "\u3000", "\r\n", "\x0b", "\x1c", "<|endoftext|>", "語.", "it's,", "12.", "  "]
    texts = [None, "", " ", ",", "."] + [
        " ".join(rng.choice(odd) if rng.random() < 0.2 else f"w{rng.choice('abcdef')}{chr(97 + rng.randrange(26))}ord{'.,'[i % 2]}"
                 for i in range(rng.randrange(200))) for _ in range(60)] + ["x" * 5000, "\n\n".join(odd), "".join(odd)]
    pieces = Counted(PATH)
    pieces.given = 0
    data, lengths = K._encoded(texts, pieces, 2, 2)
    assert pieces.given < len(pieces.memo) / 4
    want = [e + [2] for e in pieces.encode([t or "" for t in texts])]
    assert np.frombuffer(data, "<u2").tolist() == sum(want, []) and lengths.tolist() == [len(e) for e in want]


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x.bin").write_bytes(b"0" * 200)
    with pytest.raises(ValueError):
        K.TokenFile(str(tmp_path / "x.bin"))


def test_empty_table(spark, tmp_path):
    files = K.write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), PATH, 2)
    assert files.collect() == [] and K.read_token_files(spark, files).collect() == []
