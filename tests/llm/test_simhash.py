import random

import pytest
import xxhash

from frostline.llm import simhash as S


def brute_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (doc_id, fingerprint) -> component id by row, from every pair."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, f) in enumerate(prints):
        for j in range(i):
            if (f ^ prints[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(prints))]


def corpus():
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \n "), (3, "One"), (4, "one"), (5, "two words"), (None, "a b c d"), (7, "A B C D"),
            (8, "É B C D"), (9, "é b c d"), (10, "no\x1cbreak here x y z"), (None, "only null ids here at all")]
    base = [[f"w{rng.randrange(5000)}" for _ in range(n)] for n in (30, 200, 800, 5000)]
    for doc_id in range(20, 140):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(9)}"
        rows.append((doc_id, rng.choice([" ", "\n"]).join(w)))
    rows += [rows[30]] * 3
    return rows


def test_whole_operator_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in S.near_duplicates(df).collect())
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(prints, brute_components(prints)))
    assert got == want


@pytest.mark.parametrize("segments,together", [(3, 1), (5, 2), (6, 3)])
def test_links_reach_every_near_pair(spark, segments, together):
    rng = random.Random(9)
    values = [0, 2**64 - 1, 2**63]
    for _ in range(6):
        f = rng.getrandbits(64)
        for _ in range(60):  # clusters and chains
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7)))
            values += [f] + [f ^ (1 << rng.randrange(64)) for _ in range(3)]
    dense = rng.getrandbits(64)  # more than a key's short list
    values += [dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(30, 36)]
    values = sorted(set(values))
    df = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "f long").repartition(4)
    found = [(r.a % 2**64, r.b % 2**64) for r in S.links(df, 4, segments, together).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in found:
        parent[root(a)] = root(b)
    ids = dict(zip(values, brute_components([(v, v) for v in values])))
    groups = {}
    for v in values:
        groups.setdefault(root(v), set()).add(ids[v])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(ids.values()))
    assert len(found) < 40 * len(values)  # no key lists all its pairs


def test_too_few_segments_are_refused():
    with pytest.raises(ValueError):
        S.masks(4, 2, 1)


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fingerprint string").repartition(5)
    out = S.one_of_each(df)
    assert out.columns == df.columns
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    want = sorted({str(c) for c in brute_components(prints)})
    assert sorted(str(r.doc_id) for r in out.collect()) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == [] and S.one_of_each(df).collect() == []
