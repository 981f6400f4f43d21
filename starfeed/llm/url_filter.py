"""URL filter: rules by host and path, and a likelihood ratio of two character Markov models for the rest.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starfeed.workspace import written

#: The characters that the models tell apart; index 0 stands for any other, the last for the start and end of a URL.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_:%~+?=&#@,"
SYMBOLS = len(ALPHABET) + 2
EDGE = SYMBOLS - 1
SMOOTHING = 1.0
#: Of the labelled URLs, one in this many is left out of the models and sets the threshold.
HELD_OUT = 5
#: Fixed values: (verdict, host, path) of the rules, as given.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for a null or without ``://``."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct (verdict, rule) of the longest rule that fits: the host or a parent of it, and a path that the rule's begins."""
    result = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        result = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(result)
    return result


def symbols(url: Column) -> Column:
    """The URL as numbers below ``SYMBOLS``: two edges, its lower-cased characters, an edge."""
    text = F.regexp_replace(F.coalesce(url, F.lit("")), "^[^/?#]*?://", "")
    each = F.transform(F.split(F.lower(text), ""), lambda c: F.when(c == "", None).otherwise(F.instr(F.lit(ALPHABET), c)))
    edge = F.lit(EDGE)
    return F.concat(F.array(edge, edge), F.filter(each, lambda x: x.isNotNull()), F.array(edge))


def trigrams(codes: str) -> Column:
    """Numbers of the runs of three symbols: a character and the two before it."""
    n = SYMBOLS
    return F.transform(
        F.sequence(F.lit(2), F.size(codes) - 1),
        lambda i: F.col(codes)[i - 2] * (n * n) + F.col(codes)[i - 1] * n + F.col(codes)[i],
    )


def train(labelled: DataFrame) -> DataFrame:
    """One row (ratios): for each run of three symbols the log ratio of its last symbol's probability
    in accepted and in rejected URLs. ``labelled`` has codes and verdict (allow or block).

    Each model is of variable order: after a context of length k its estimate is blended with that of length
    k - 1 by the number of distinct symbols seen after it (Witten-Bell), down to the uniform one, so it is
    as long a context as the data carry. There are SYMBOLS^3 runs whatever the number of URLs, which bounds the row.
    """
    n = SYMBOLS
    runs = labelled.select("verdict", F.explode(trigrams("codes")).alias("g")).groupBy("verdict", "g").agg(F.count("*").alias("c"))
    runs = written(runs.select("verdict", "g", "c", (F.col("g") % (n * n)).alias("g2"), (F.col("g") % n).alias("g1")), "url-runs")
    every = labelled.sparkSession.range(n * n * n).select(F.col("id").cast("int").alias("g"))
    every = every.select("g", (F.col("g") % (n * n)).alias("g2"), (F.col("g") % n).alias("g1"), F.floor(F.col("g") / n).cast("int").alias("h2"), (F.floor(F.col("g") / n) % n).cast("int").alias("h1"))

    def log_probability(verdict: str) -> DataFrame:
        own = runs.where(F.col("verdict") == verdict)
        frame, estimate = every, F.lit(1.0 / n)
        for gram, context in (("g1", None), ("g2", "h1"), ("g", "h2")):
            counts = own.groupBy(gram).agg(F.sum("c").alias("c"))
            if context is None:
                totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("t"), F.count("*").alias("d"))
                frame = frame.join(counts, gram, "left").withColumns({"t": _scalar(totals, "t"), "d": _scalar(totals, "d")})
            else:
                totals = counts.groupBy(F.floor(F.col(gram) / n).cast("int").alias(context)).agg(F.sum("c").alias("t"), F.count("*").alias("d"))
                frame = frame.join(counts, gram, "left").join(totals, context, "left")
            weight = F.coalesce("t", F.lit(0)) + SMOOTHING * F.coalesce("d", F.lit(0))
            blended = (F.coalesce("c", F.lit(0)) + SMOOTHING * F.coalesce("d", F.lit(0)) * estimate) / weight
            frame = frame.withColumn("p", F.when(weight > 0, blended).otherwise(estimate)).drop("c", "t", "d")
            estimate = F.col("p")
        return frame.select("g", F.log("p").alias(verdict))

    both = log_probability("allow").join(log_probability("block"), "g").select("g", (F.col("allow") - F.col("block")).alias("r"))
    ordered = F.sort_array(F.collect_list(F.struct("g", "r")))
    return written(both.agg(F.transform(ordered, lambda x: x["r"]).alias("ratios")), "url-ratios")


def _scalar(one_row: DataFrame, column: str) -> Column:
    return F.lit(one_row.first()[column])


def scored(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """Adds ``score``: the mean log ratio over the URL's characters. ``ratios`` is one row, sent to each task."""
    one = F.broadcast(ratios.select(F.lit(1).alias("_one"), "ratios"))
    joined = urls.withColumn("_grams", trigrams("codes")).withColumn("_one", F.lit(1)).join(one, "_one", "left")
    total = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.coalesce(F.get("ratios", g), F.lit(0.0)))
    return joined.withColumn("score", total / F.size("_grams")).drop("_grams", "_one", "ratios")


def threshold(scores: DataFrame) -> float:
    """The score that best parts allowed from blocked held-out URLs: the mean of both kinds'
    shares on their right side is largest there. Scores are counted in steps of 1/200; without both kinds it is 0."""
    steps = scores.groupBy(F.least(F.greatest(F.round(F.col("score") * 200), F.lit(-4000)), F.lit(4000)).cast("int").alias("step")).agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")
    ).orderBy("step").collect()  # 8,001 rows at most
    allowed, blocked = sum(r["a"] for r in steps), sum(r["b"] for r in steps)
    if not allowed or not blocked:
        return 0.0
    best, at, below_a, below_b = -1.0, [0.0], 0, 0
    for r in steps:
        share = ((allowed - below_a) / allowed + below_b / blocked) / 2
        if share > best + 1e-12:
            best, at = share, [r["step"] / 200]
        elif abs(share - best) <= 1e-12:
            at.append(r["step"] / 200)
        below_a, below_b = below_a + r["a"], below_b + r["b"]
    return (at[0] + at[-1]) / 2 - 1 / 400


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for each row.

    URLs that a rule fits get its verdict, and are what the two models learn from; the others are allowed if their score is
    not below the threshold. Repeated URLs fare alike. Where no rule allows or none blocks any URL, there is
    nothing to compare and the others are allowed. A null URL is scored as an empty one.
    """
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url, host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("codes", symbols(url))
    labelled = rows.where("_rule is not null").select("codes", F.col("_rule.verdict").alias("verdict"), (F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0).alias("held_out"))
    kinds = labelled.agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")).first()
    if not kinds["a"] or not kinds["b"]:
        return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    ratios = train(labelled.where(~F.col("held_out")))
    limit = threshold(scored(labelled.where("held_out"), ratios))
    by_method = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored(rows, ratios).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", by_method).alias("verdict"), "score"
    )
