"""URL filters: rules first, then a ratio of two character language models.

*Rules* name a host and the beginning of a path.  A rule fits its host and all
subdomains; of the rules that fit, the longest decides.

*Models.*  URLs that a rule decides are the training data: one character model
is learned from those allowed, one from those blocked.  Both are Markov models
of variable order: the probability of a character after two others is smoothed
towards that after one, which is smoothed towards that of the character alone,
each by ``SMOOTHING`` pseudo-counts; a context never seen thus falls back to a
shorter one.  A URL's score is the mean over its characters of the difference
of the two log-likelihoods.  The threshold is calibrated on the decided URLs:
the point between the two classes' mean scores that lies as many standard
deviations from one as from the other.  URLs that no rule fits are allowed if
their score reaches it.

Characters are folded to lower-case letters, one digit and some marks, 40 symbols
at most, so the models have no more than 41^3 trigrams whatever the input: a
table that may be broadcast.  Everything here is DataFrame operations.

Cases: a null URL, or one without ``://``, has an empty host and path and fits no
rule; the method judges its characters, and a URL that has none (null, empty) is
blocked.  If rules decide no URL of a class, nothing tells the classes apart
and undecided URLs are allowed.  Null ids, repeated rows and repeated URLs are
judged row by row.  An empty table gives an empty result.  Other columns are
carried, whatever their names; only those named like the five columns returned
(``host``, ``path``, ``rule``, ``verdict``, ``score``) give way to these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import named_back, numbered

#: Verdict and rule; a rule is a host and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SMOOTHING = 5.0
#: Characters kept as they are, besides a-z; digits become 0 and all others ~.
MARKS = "./-_?=&:%#+"
_SYMBOLS = 26 + 1 + 1 + len(MARKS) + 1  # letters, digit, others, marks, end

_MADE = ("host", "path", "rule", "verdict", "score")


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null (rules are a short list, a parameter)."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later ones take precedence
        name, slash, begin = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + begin)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _trigrams(url: Column) -> Column:
    """All runs of three folded characters, with two marks before and one after; none for no characters."""
    folded = F.lower(F.coalesce(url, F.lit("")))
    folded = F.regexp_replace(F.regexp_replace(folded, "[0-9]", "0"), r"[^a-z0./\-_?=&:%#+]", "~")
    framed = F.concat(F.lit("^^"), folded, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(framed) - 2), lambda i: F.substring(framed, i, 3))
    return F.when(F.length(folded) > 0, grams).otherwise(F.array().cast("array<string>"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule``, ``verdict`` and ``score``."""
    pages = pages.drop(*_MADE)
    kept = pages.columns
    pages, names = numbered(pages)
    columns, url = pages.columns, names[url]
    verdicts = {rule: verdict for verdict, rule in rules}
    host, path = host_and_path(F.col(url))
    ruled = (pages.withColumn("host", host).withColumn("path", path)
             .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)))
    decided = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        decided = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(decided)
    ruled = ruled.withColumn("decided", decided)
    # A row number of its own for each row; the score's aggregate brings the row's columns along.
    grams = ruled.withColumn("__row", F.monotonically_increasing_id()).withColumn("gram", F.explode_outer(_trigrams(F.col(url))))
    scored = (grams.join(F.broadcast(_model(grams)), "gram", "left")
              .groupBy("__row").agg(F.avg("ratio").alias("score"),
                                    *(F.first(c).alias(c) for c in [*columns, "host", "path", "rule", "decided"])))
    allowed = F.when(F.col("score") >= _threshold(scored), "allow").otherwise("block")
    judged = scored.withColumn("verdict", F.coalesce("decided", allowed)).select(*columns, *_MADE)
    return named_back(judged, [*kept, *_MADE])


def _model(grams: DataFrame) -> DataFrame:
    """``gram, ratio`` of every trigram of the input (41^3 rows at most)."""
    count = lambda verdict: F.sum(F.when(F.col("decided") == verdict, 1).otherwise(0))
    # Written out once: the sums below and the threshold read it again.
    tri = (grams.where("gram is not null").groupBy("gram").agg(count("allow").alias("allow"), count("block").alias("block"))
           .select("gram", F.substring("gram", 1, 2).alias("two"), F.substring("gram", 2, 1).alias("one"),
                   F.substring("gram", 2, 2).alias("last"), F.substring("gram", 3, 1).alias("symbol"), "allow", "block").checkpoint())
    classes = ("allow", "block")
    total = tri.agg(*(F.sum(c).alias(c) for c in classes)).first()

    def sums(by: list[str], name: str) -> DataFrame:
        return tri.groupBy(*by).agg(*(F.sum(c).alias(f"{name}_{c}") for c in classes))

    model = (tri.join(F.broadcast(sums(["two"], "context")), "two").join(F.broadcast(sums(["last"], "pair")), "last")
             .join(F.broadcast(sums(["one"], "middle")), "one").join(F.broadcast(sums(["symbol"], "symbol")), "symbol"))

    def likelihood(c: str) -> Column:
        k = SMOOTHING
        alone = (F.col(f"symbol_{c}") + k / _SYMBOLS) / float((total[c] or 0) + k)
        after_one = (F.col(f"pair_{c}") + k * alone) / (F.col(f"middle_{c}") + k)
        return (F.col(c) + k * after_one) / (F.col(f"context_{c}") + k)

    told_apart = F.lit(bool(total["allow"] and total["block"]))
    ratio = F.when(told_apart, F.log(likelihood("allow")) - F.log(likelihood("block"))).otherwise(0.0)
    return model.select("gram", ratio.alias("ratio"))


def _threshold(scored: DataFrame) -> Column:
    """Two rows of statistics over all decided URLs reach the driver."""
    found = {r["decided"]: r for r in scored.where("decided is not null and score is not null").groupBy("decided")
             .agg(F.avg("score").alias("mean"), F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("sd")).collect()}
    if len(found) < 2:
        return F.lit(0.0)
    a, b = found["allow"], found["block"]
    spread = a["sd"] + b["sd"]
    return F.lit((a["mean"] * b["sd"] + b["mean"] * a["sd"]) / spread if spread else (a["mean"] + b["mean"]) / 2)
