"""URL filters: allow and block rules by host and path, and a character language-model ratio for the rest.

Two variable-order Markov models of characters are counted, one over URLs that the rules accept, one over
URLs that they reject.  The probability of a character after its last ``ORDER`` characters is interpolated from
the longest seen context down (Witten-Bell: a context with n continuations of t kinds keeps n / (n + t)); contexts
never seen leave all weight to shorter ones.  A URL's score is the difference of both log-likelihoods a
character.  A fifth of the judged URLs, by hash of the URL, is kept out of the counts and sets the threshold:
the point between both classes' means, each weighted by the other's spread.

All in built-in functions.  Counts are combined before each shuffle; the n-gram table grows with the distinct
n-grams only.  A URL's n-grams meet the table in a plain join, whose hot keys (every URL's first characters)
adaptive execution splits.

Nulls: a null URL, or one without ``://``, has empty host and path, fits no rule, and is scored as what stands
there (null: as empty).  An empty URL has one n-gram, its end right after the padding, and is scored by that like any
other.  Repeated rows each get a row; a null page_id keeps its row.  Without URLs of both classes the scores are 0.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm.frames import saved

ORDER = 4
#: Characters that a model holds possible everywhere.
ALPHABET = 256.0
_PAD = "\u0002"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: host, path, verdict
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _grams(url: Column) -> Column:
    """All n-grams of ORDER + 1 characters of the padded URL, its end included."""
    chars = F.concat(F.array(*[F.lit(_PAD)] * ORDER), F.filter(F.split(url, ""), lambda c: c != ""), F.array(F.lit(_PAD)))
    return F.flatten(F.transform(F.array(chars), lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - ORDER), lambda i: F.array_join(F.slice(c, i, ORDER + 1), ""))))


def language_models(counts: DataFrame) -> DataFrame:
    """(gram, ratio): log P(accepted) - log P(rejected) of a gram's last character after the others.
    ``counts`` has gram, accepted and rejected."""
    below = None
    for k in range(ORDER + 1):
        own = counts.groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        own = own.withColumn("context", F.left("gram", F.lit(k)))
        kinds = {f"{c}_t": F.sum((F.col(c) > 0).cast("long")) for c in ("accepted", "rejected")}
        context = own.groupBy("context").agg(F.sum("accepted").alias("accepted_n"), F.sum("rejected").alias("rejected_n"), *[v.alias(c) for c, v in kinds.items()])
        own = own.join(context, "context")
        if below is None:
            own = own.withColumns({"accepted_b": F.lit(1 / ALPHABET), "rejected_b": F.lit(1 / ALPHABET)})
        else:
            own = own.withColumn("tail", F.right("gram", F.lit(k))).join(below, "tail")

        def smoothed(c: str) -> Column:
            n, t = F.col(f"{c}_n"), F.col(f"{c}_t")
            return F.when(n > 0, (F.col(c) + t * F.col(f"{c}_b")) / (n + t)).otherwise(F.col(f"{c}_b"))

        below = own.select(F.col("gram").alias("tail"), smoothed("accepted").alias("accepted_b"), smoothed("rejected").alias("rejected_b"))
    return below.select(F.col("tail").alias("gram"), (F.log("accepted_b") - F.log("rejected_b")).alias("ratio"))


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score): one row per row of ``pages``; score is null where a rule decides."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "scored_url": F.coalesce("url", F.lit(""))})
    rows = rows.withColumn("held", F.pmod(F.xxhash64("scored_url", F.lit("calibrate")), F.lit(5)) == 0)
    distinct = rows.groupBy("scored_url", "ruled", "held").agg(F.count(F.lit(1)).alias("n"))
    # a URL becomes dozens of rows here, so the few bytes before aren't put together into fewer tasks
    distinct = distinct.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "scored_url")
    # each gram of a URL once, with how often it stands there
    grams = distinct.select("scored_url", "ruled", "held", "n", F.explode(_grams(F.col("scored_url"))).alias("gram"))
    grams = grams.groupBy("scored_url", "ruled", "held", "n", "gram").agg(F.count(F.lit(1)).alias("times"))
    grams = saved(spark, grams, "url-grams")
    learns = F.col("ruled").isNotNull() & ~F.col("held")
    seen = F.when(learns, F.col("n") * F.col("times")).otherwise(0)
    counts = grams.groupBy("gram").agg(F.sum(F.when(F.col("ruled") == "allow", seen).otherwise(0)).alias("accepted"), F.sum(F.when(F.col("ruled") == "block", seen).otherwise(0)).alias("rejected"))
    model = language_models(saved(spark, counts, "url-counts"))
    asked = grams.where(F.col("ruled").isNull() | F.col("held")).join(model, "gram")
    scores = asked.groupBy("scored_url", "ruled", "n").agg((F.sum(F.col("times") * F.col("ratio")) / F.sum("times")).alias("score"))
    scores = saved(spark, scores, "url-scores")
    at = {}
    for r in scores.where("ruled is not null").groupBy("ruled").agg(F.sum(F.col("n") * F.col("score")).alias("s"), F.sum(F.col("n") * F.col("score") * F.col("score")).alias("q"), F.sum("n").alias("n")).collect():
        mean = r["s"] / r["n"]
        at[r["ruled"]] = (mean, max(1e-9, r["q"] / r["n"] - mean * mean) ** 0.5)
    threshold = 0.0
    if {"allow", "block"} <= set(at):
        (a, sa), (b, sb) = at["allow"], at["block"]
        threshold = (a * sb + b * sa) / (sa + sb)
    free = scores.where("ruled is null").select("scored_url", "score")
    out = rows.join(free, "scored_url", "left")
    score = F.when(F.col("ruled").isNull(), F.coalesce("score", F.lit(0.0)))
    judged = F.coalesce("ruled", F.when(score >= F.lit(threshold), F.lit("allow")).otherwise(F.lit("block")))
    return out.select("page_id", "url", "host", "path", "rule", judged.alias("verdict"), score.alias("score"))
