import random

import pytest

from frostline.llm import mixing as M


def corpus():
    rng = random.Random(6)
    rows = [(None, None, None), (1, "", "b"), (2, " \n", None), (3, "no source here", None)]
    for i in range(10, 900):
        source = rng.choice(["hot"] * 8 + ["b", "a", "Z", "é", "tiny"])
        n = rng.randrange(60) if source != "tiny" else rng.randrange(3)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(f"w{rng.randrange(99)}" for _ in range(n)), source))
    return rows + rows[40:42]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x") for d, t, s in rows], "doc_id long, text string, source string, size string").repartition(4)


def brute_targets(sizes):
    """sizes: source -> words; shares are dealt out anew until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, rest = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2.0 * sizes[s]
            rest -= full[s]


@pytest.mark.parametrize("bucket_rows", [2000, 7])
def test_mix_meets_targets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket_rows)
    rows = corpus()
    out = M.mix(frame(spark, rows).drop("size")).collect()
    size_of = lambda t: len((t or "").split())
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in out) == sorted((str(d), str(s), size_of(t)) for d, t, s in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    want = brute_targets(sizes)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=len(sizes))
    again = M.mix(frame(spark, rows[::-1]).drop("size")).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_sources_follow_their_schedule(spark):
    rows = [(i, "one two three four five", "abc"[i % 3]) for i in range(6000)]
    out = M.curriculum(frame(spark, rows).drop("size"), weights=(1, 1, 1), budget=1.0)
    got = [(r.source, r.position) for r in out.select("source", "position").collect()]
    assert [p for _, p in got] == sorted(p for _, p in got)
    early = [s for s, p in got if p < 0.5]
    # Words met by the middle: t + c (t^2 - t) at 1/2 is 1/2 - c/4.
    for s, c in zip("abc", M.SLOPES):
        assert early.count(s) / 2000 == pytest.approx(0.5 - c / 4, abs=0.01)


def test_curriculum_rows(spark):
    rows = corpus()
    df = frame(spark, rows).withColumnRenamed("size", "n_chars").selectExpr("doc_id", "text", "source", "cast(length(text) as int) n_chars")
    out = M.mixed_documents(df)
    assert out.dtypes == df.dtypes
    mixed = M.mix(df).collect()
    met = out.collect()
    assert len(met) == sum(len(r.copies) for r in mixed)
    assert sum(len(r.text.split()) for r in met) == sum(r.taken for r in mixed)
    whole = {(d, s): t for d, t, s in rows}
    assert all(r.text == whole[r.doc_id, r.source] and r.n_chars == len(r.text) for r in met)
    takes = lambda rs, n: sorted((str(r.doc_id), str(r.source)) for r in rs for _ in range(n(r)))
    assert takes(met, lambda r: 1) == takes(mixed, lambda r: len(r.copies))


def test_repeated_rows_are_documents_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(M, "ALIKE_ROWS", 7)
    for doc_id in (5, None):
        rows = [(i + 100, "a b c", "s") for i in range(50)] + [(doc_id, "a b c", "s")] * 50
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        mixed = M.mix(df).collect()
        assert len(mixed) == 100 and sum(r.taken for r in mixed) == 450 and len({r.order for r in mixed}) == 100
        assert M.curriculum(df).count() == 150


def test_any_column_names(spark):
    rows = [(i, f"one two {i}", "ab"[i % 2], f"p{i}", f"c{i}", i, f"n{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, position string, __copy string, size int, `a.b c` string")
    out = M.curriculum(df)
    assert out.columns == [*df.columns, "position"]
    met = M.mixed_documents(df)
    assert met.dtypes == df.dtypes and len(met.collect()) == out.count() >= 55
    assert {tuple(r) for r in met.collect()} <= set(rows)


def test_places_number_the_training_order(spark):
    df = frame(spark, corpus()).drop("size")
    mixed = M.mix(df)
    out = M.training_places(mixed)
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "first_position", "first_place", "last_place"]
    got = out.collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixed.collect()))
    assert all((r.first_place is None) == (r.taken == 0) for r in got)
    met = sorted((c.position, r.order, turn) for r in mixed.collect() for turn, c in enumerate(r.copies))
    places = sorted(p for r in got if r.taken for p in {r.first_place, r.last_place})
    assert places == list(range(1, len(met) + 1))
    assert all(met[r.first_place - 1][0] == r.first_position for r in got if r.taken)


def test_no_python_in_the_plan(spark):
    df = frame(spark, corpus()).drop("size")
    for out in (M.mix(df), M.curriculum(df), M.training_places(M.mix(df))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_documents_are_taken_whole(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(f"{i}w{k}" for k in range(rng.randrange(1, 400))), s) for i, s in enumerate("abbcccccccccd" * 3)]
    rows += [(100, "long " * 50000, "alone"), (101, "as  long\n" * 40000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = M.mix(df).collect()
    assert all(r.taken == len(r.copies) * r.size and all(c.words == r.size for c in r.copies) for r in out)
    assert {r.source for r in out if r.taken} == {s for _, _, s in rows}
    largest = {}
    for _, t, s in rows:
        largest[s] = max(largest.get(s, 0), len(t.split()))
    for source, most in largest.items():
        of = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in of) - of[0].target) <= max(most / 2, min(r.size for r in of)) + 1
    # No matter where its stream ends, a source of one document is given whole.
    for weights in ((1, 50), (50, 1), (3, 2)):
        two = spark.createDataFrame([(1, "x " * 1000, "p"), (2, "y  " * 1000, "q")], df.schema)
        met = M.curriculum(two, weights=weights, budget=1.0).collect()
        assert {r.doc_id for r in met} == {1, 2} and {r.text for r in met} == {"x " * 1000, "y  " * 1000}


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(empty).collect() == [] and M.curriculum(empty).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], empty.schema)
    assert [(r.size, r.target, r.taken) for r in M.mix(nothing).collect()] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        M.mix(empty, slopes=(2.0,))
