import random

from frostline.llm import license_scan as S
from frostline.llm.license_texts import BASE_PHRASES, NOTICES, PHRASES


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in "0123456789" or "a" <= c <= "z" or ord(c) >= 128 else " " for c in low).split(" ")


def brute(text):
    w = [x for x in words(text) if x]
    base, labels = [], set()
    for phrases in (BASE_PHRASES, PHRASES):
        for phrase, label in phrases.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            if at:
                labels.add(label)
            if phrases is BASE_PHRASES:
                base += [(i, label) for i in at]
    places = [i for i, _ in base]
    return (len(w), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)))


def corpus():
    rng = random.Random(4)
    some = ["the", "MIT", "License", "license", "Apache", "GNU", "General", "Public", "CC", "BY", "BY-NC", "été", "apache-license",
            "mit license", "MITLicense", "public license", "4.0", "x\xa0y", "licence", "GNU General Public License,"]
    rows = [(None, None), (1, ""), (2, "?!"), (3, "mit"), (None, "CC BY-SA"), (4, "cc by " * 5000)]
    for i in range(10, 150):
        rows.append((i, rng.choice([" ", "\n", " -- "]).join(rng.choice(some) for _ in range(rng.randrange(60)))))
    return rows + rows[20:23]


def test_phrases_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, labels string").repartition(3)
    out = S.scan(df).collect()
    key = lambda r: (str(r[0]), str(r))
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in out), key=key)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=key)
    assert all(r.score == (1.0 if r.labels else 0.0) for r in out)


def test_changed_notices_are_found(spark):
    rng = random.Random(7)
    rows = []
    for i, (_, text) in enumerate(NOTICES.items()):
        w = text.split()
        for _ in range(3):
            w.insert(rng.randrange(len(w)), "inserted")
        del w[rng.randrange(len(w))]
        rows.append((i, " ".join(["before"] * 200 + w + ["after"] * 30)))
    rows.append((99, " ".join(rng.sample(" ".join(NOTICES.values()).split(), 300))))  # its words, in no order
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.scan(df).collect()}
    for i, label in enumerate(NOTICES):
        assert label in got[i].labels.split(","), label
    assert not set(got[99].labels.split(",")) & {"bsd", "isc", "unlicense"}
    found = [r for r in S.spans(df).where("kind = 'notice'").collect() if r.doc_id == 4]
    assert len(found) == 1 and 195 <= found[0].first_word <= 206 and 0.6 <= found[0].score < 1


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_hashes_that_a_template_has_leave_the_worker(spark):
    rows = [(1, "zebra quagga okapi " * 500), (2, "under the MIT License"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = S.scan(df)
    assert {r.doc_id: r.labels for r in made.collect()} == {1: "", 2: "mit", 3: ""}
    plan = made._jdf.queryExecution().executedPlan()
    todo, rows_out = [plan], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName() == "MapInArrow":
            rows_out.append(node.metrics().apply("pythonNumRowsReceived").value())
        todo += [node.children().apply(i) for i in range(node.children().length())]
    assert rows_out and sum(rows_out) < 20
