import random

from frostline.llm import quality as Q

SPACE = " \t\n\r\x0b\x0c"


def words(text):
    return [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def corpus():
    rng = random.Random(8)
    some = ["Prose", "with", "words,", "été", "日本", "of", "a", "line", "x#y", "<b>", "|"] + [f"w{i}" for i in range(60)]
    rows = [(None, None), (1, ""), (2, "\n\n \n"), (None, "a b c a b c"), (3, "same line.\nsame line.\n same line.")]
    for i in range(10, 80):
        lines = [" ".join(rng.choice(some) for _ in range(rng.randrange(12))) + rng.choice([".", "", "!"]) for _ in range(rng.randrange(15))]
        rows.append((i, "\n".join(lines + lines[:rng.randrange(3)])))
    rows.append((90, " ".join(f"t{rng.randrange(300)}" for _ in range(1500))))
    return rows + rows[10:12]


def test_base_counts_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, kept string").repartition(3)
    out = Q.judge(df)
    assert out.columns.count("kept") == 1
    key = lambda r: (str(r[0]), *r[1:])
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in out.collect()), key=key)
    assert got == sorted(((d, *base(t)) for d, t in rows), key=key)


def judged(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    return sorted(Q.judge(df).collect(), key=lambda r: r.doc_id)


def prose(n, start=0):
    return " ".join(f"word{i}" for i in range(start, start + n)) + "."


def test_lines_fail_by_each_rule(spark):
    good = prose(60)
    bad = ["Home | News | Sport | About |", "no full stop here", "It%%% is*** all### marks.", "LOUD!! LOUDER!! NOW!!",
           "We use cookies to improve this page.", "One » Two » Three » Four."]
    for line, r in zip(bad, judged(spark, *[f"{good}\n{line}\n\n{good}" for line in bad])):
        assert r.n_failed_lines == 1 and r.cleaned == f"{good}\n\n{good}", line
    fine = [good, f"{good}\n“Quoted end.”\nWhat…", f'He said: "So."\n{good}', f"A, b; c (d) e.\n{good}"]
    assert all(r.kept or r.n_repeat_words for r in judged(spark, *fine))
    assert all(r.n_failed_lines == 0 for r in judged(spark, *fine))


def test_a_missing_end_mark_fails_short_lines_only(spark):
    good = prose(60)
    long = " ".join(f"word{i}" for i in range(70, 130))
    thai, chinese = "ภาษาไทยไม่มีจุดจบประโยค " * 3, "今天天气很好(2019)我们去公园散步然后回家吃饭看书休息睡觉做梦起床上班工作(2020)"
    fine = [f"{good}\n{line}" for line in (
        f"{good} You fool", f"{good} Mail to x@y.org", f"{good}\n{long}", "It went well. We left", "他来了。我们走", thai, chinese,
        "यह हिन्दी का वाक्य है।", "هل هذا سؤال؟", "これは（本当です）", "„Ein Zitat“", "Այսպես։", "ဒါပဲ။")]
    fine.append(f"{long} and no end")
    for text, r in zip(fine, judged(spark, *fine)):
        assert r.n_failed_lines == 0 and r.cleaned == text and (r.kept or r.n_repeat_words), text
    short = ["About us", "Figure 3. 14", "Posted by admin on Monday", "关于我们", "ติดต่อเรา"]
    assert [r.n_failed_lines for r in judged(spark, *[f"{good}\n{line}" for line in short])] == [1] * len(short)


def test_a_paragraph_may_mention_site_furniture(spark):
    good = prose(60)
    whole = " ".join(f"word{i}" for i in range(2000)) + " whose privacy policy he read, then the terms of use. " + prose(3000, 2000)
    part = f"{good}\nThe court held that the firm had broken its own privacy policy when it sold the addresses of its customers."
    for text, r in zip((whole, part), judged(spark, whole, part)):
        assert r.kept and r.n_failed_lines == 0 and r.cleaned == text
    furniture = ["Privacy Policy. Terms of Use.", "Copyright 2020 Acme Inc. All rights reserved.", "Click here to read more.",
                 "This site uses cookies to provide you with the best possible experience on our website.",
                 "Lorem ipsum dolor sit amet."]
    assert [r.n_failed_lines for r in judged(spark, *[f"{good}\n{line}" for line in furniture])] == [1] * len(furniture)


def test_documents_that_lose_too_much_are_rejected(spark):
    menu = " | ".join(f"entry{i}" for i in range(80))
    light, heavy, short, null = judged(spark, f"{prose(100)}\nHome | News | Sport |", f"{prose(60)}\n{menu}", prose(49), None)
    assert light.kept and not heavy.kept and not heavy.base_failed
    assert not short.kept and short.base_failed and not null.kept and null.cleaned is None


def test_kept_documents_have_the_columns_of_documents(spark):
    df = spark.createDataFrame([(1, f"{prose(60)}\nno stop", 9), (2, "short", 5)], "doc_id long, text string, n_chars int")
    out = Q.kept_documents(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.collect()] == [(1, prose(60), len(prose(60)))]


def test_other_columns_keep_their_values(spark):
    df = spark.createDataFrame([(1, f"{prose(60)}\nno stop", "KEEP", "c", 7)], "doc_id long, text string, n_words string, cleaned string, kept int")
    out = Q.kept_documents(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r) for r in out.collect()] == [(1, prose(60), "KEEP", "c", 7)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert Q.judge(df).collect() == [] and Q.kept_documents(df).collect() == []
