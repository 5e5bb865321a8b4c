import math
import random
from collections import Counter

from frostline.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]


def rule(host, path):
    fits = [r for _, r in U.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def fold(url):
    out = []
    for c in (url or "").lower():
        out.append("0" if c in "0123456789" else c if c in "abcdefghijklmnopqrstuvwxyz./-_?=&:%#+" else "~")
    return "".join(out)


def grams(url):
    s = "^^" + fold(url) + "$"
    return [s[i:i + 3] for i in range(len(s) - 2)] if fold(url) else []


def brute(rows):
    verdicts = {r: v for v, r in U.RULES}
    rules = [rule(*parts(u)) for _, u in rows]
    counts = {v: [Counter() for _ in range(5)] for v in ("allow", "block")}
    for (_, u), r in zip(rows, rules):
        if r:
            for g in grams(u):
                for n, key in enumerate((g, g[:2], g[1:], g[1], g[2])):
                    counts[verdicts[r]][n][key] += 1

    def p(v, g):
        tri, two, last, one, symbol = counts[v]
        alone = (symbol[g[2]] + 5 / U._SYMBOLS) / (sum(tri.values()) + 5)
        after = (last[g[1:]] + 5 * alone) / (one[g[1]] + 5)
        return (tri[g] + 5 * after) / (two[g[:2]] + 5)

    scores = [sum(math.log(p("allow", g)) - math.log(p("block", g)) for g in gs) / len(gs) if gs else None
              for gs in (grams(u) for _, u in rows)]
    of = {v: [s for s, r in zip(scores, rules) if r and verdicts[r] == v] for v in counts}
    mean = {v: sum(s) / len(s) for v, s in of.items()}
    sd = {v: math.sqrt(sum((x - mean[v]) ** 2 for x in s) / (len(s) - 1)) for v, s in of.items()}
    limit = (mean["allow"] * sd["block"] + mean["block"] * sd["allow"]) / (sd["allow"] + sd["block"])
    return [(str(i), *parts(u), r, verdicts[r] if r else "allow" if s is not None and s >= limit else "block", s)
            for (i, u), r, s in zip(rows, rules, scores)]


def corpus():
    rng = random.Random(3)
    odd = [None, "", "no scheme", "http://", "http:///x", "https://NET/x", "https://net", "https://xnet/", "https://a.b.NET/en/1",
           "https://example.net/en/", "https://WWW.Example.net/en/x?y#z", "https://example.net/en", "http://example.com/de/1",
           "http://a.example.com/DE/1", "http://org/fr/2", "http://x.org/fr", "a://b://c.net/p", "http://h?net/", "http://é.org/fr/ü",
           "http://u:p@x.net:80/a", "http://x.org#/fr/", "ftp://line\nbreak.net/a\nb", "http://" + "long/" * 5000]
    rows = list(enumerate(odd)) + [(None, "http://null.example.com/en/9")]
    for i in range(100, 700):
        host = rng.choice(["example.net", "example.com", "example.org", "www.example.net", "blog.site.org", "shop.io"])
        rows.append((i, f"http://{host}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['news', 'spam', 'cart', 'wiki'])}/{rng.randrange(10**4)}"))
    return rows + rows[30:33]


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string").repartition(3)
    out = U.judge_urls(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score"]
    key = lambda r: (r[0], r[1], r[2], str(r[3]))
    got = sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict, r.score) for r in out.collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == w[5] or math.isclose(g[5], w[5], abs_tol=1e-9) for g, w in zip(got, want))
    assert {g[4] for g in got if g[3] is None} == {"allow", "block"}


def test_columns_of_any_name_are_carried(spark):
    names = ["ratio", "decided", "gram", "__row", "allow", "score_", "a.b c"]
    rows = [(i, f"http://a{i}.{'net' if i % 2 else 'com'}/", *(f"{n}{i}" for n in names)) for i in range(6)]
    df = spark.createDataFrame(rows, ["page_id", "url", *names])
    out = U.judge_urls(df)
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict", "score"]
    assert sorted(tuple(r)[:len(df.columns)] for r in out.collect()) == rows


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = U.judge_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_nothing_learned_allows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    assert sorted((r.page_id, r.verdict) for r in U.judge_urls(df).collect()) == [(1, "allow"), (2, "block")]
    assert U.judge_urls(df.where("false")).collect() == []
