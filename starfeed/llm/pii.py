"""Personal data: spans by pattern, and more of them by bootstrapped contextual extraction.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starfeed.workspace import written

# The patterns find what the contract's do, leftmost and greedy. They never give back what they took (++) where nothing could
# be gained by it, and start inside a run only where the last match ended (\G), so they take linear time and no deep stack.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"\x20\x09-\x0D"
#: What may be an identifier that no pattern knows: a run of non-space with a digit or an at sign in it.
TOKEN = rf"(?<![^{SPACE}])[^0-9@{SPACE}]*+[0-9@][^{SPACE}]*+"
EDGES = ".,;:!?()[]{}<>\"'*"
WINDOW = 80  # characters beside a mention in which its neighbouring words are looked for
BLOCK = 256

ROUNDS = 3
LEAST_SEEDS = 5
CONFIDENT = 0.9


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.rlike(m, F.lit(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"))
    if kind == "card":
        digits = F.translate(m, " -", "")
        n = F.length(digits)

        def add(total: Column, i: Column) -> Column:
            digit = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
            return total + digit - F.when(digit > 9, 9).otherwise(0)

        return F.when(n.between(16, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _running(xs: Column, first: Column) -> Column:
    """The sums of xs up to each place, and ``first``."""
    start = F.struct(first.alias("sum"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(
        xs, start,
        lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")),
        lambda s: s["all"],
    )


def _located(rows: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds for each name an array of (start, end, match) of its pattern in ``text``, as code points, end exclusive;
    nothing is looked for where the condition is false. The lengths of the matches and of what
    lies between them give the places; sums run over blocks of ``BLOCK`` matches, so thousands of matches in a text cost no more each.
    """
    none = F.array().cast("array<string>")
    for name, (pattern, condition) in patterns.items():
        rows = rows.withColumns({
            f"m_{name}": F.when(condition, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
            f"g_{name}": F.when(condition, F.transform(F.split("text", pattern, -1), F.length)).otherwise(F.array().cast("array<int>")),
        })
    for name in patterns:
        rows = rows.withColumn(f"d_{name}", _steps(F.col(f"m_{name}"), F.col(f"g_{name}")))
    for name in patterns:
        rows = rows.withColumn(f"b_{name}", _blocks(F.col(f"d_{name}")))
    for name in patterns:
        sums = F.transform(f"b_{name}", lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        rows = rows.withColumn(f"o_{name}", F.concat(F.array(F.lit(0)), _running(sums, F.lit(0))))
    for name in patterns:
        rows = rows.withColumn(f"s_{name}", _sums(F.col(f"b_{name}"), F.col(f"o_{name}")))
    for name in patterns:
        rows = rows.withColumn(name, F.zip_with(
            f"s_{name}", f"m_{name}", lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("match"))
        ))
    return rows.drop(*[f"{p}_{name}" for name in patterns for p in "mgdbos"])


def _steps(matches: Column, gaps: Column) -> Column:
    """How far each match starts behind the start of the one before."""
    return F.transform(matches, lambda x, i: gaps[i] + F.when(i > 0, F.length(matches[i - 1])).otherwise(0))


def _blocks(xs: Column) -> Column:
    numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
    return F.when(F.size(xs) > 0, F.transform(numbers, lambda b: F.slice(xs, b * BLOCK + 1, BLOCK))).otherwise(
        F.array().cast("array<array<int>>")
    )


def _sums(blocks: Column, before: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b, i: _running(b, before[i])))


def _spans(kind: str) -> Column:
    """The valid matches of a kind, with its number."""
    valid = F.filter(kind, lambda x: _valid(kind, x["match"]))
    return F.transform(valid, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"], x["end"], x["match"]))


def _word(near: Column, last: bool) -> Column:
    """The last or first word of a stretch of text, lower-cased; empty if there is none."""
    plain = F.translate(near, "\t\n\x0b\x0c\r", "     ")
    return F.lower(F.substring_index(F.rtrim(plain) if last else F.ltrim(plain), " ", -1 if last else 1))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written once: row, doc_id, spans (kind's number, start, end) by pattern, and mentions.

    Mentions are those spans and the tokens that may be identifiers but overlap none of them, each
    with its words to the left and right. ``row`` numbers the rows of this table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    digits, at = F.rlike("text", F.lit("[0-9]")), F.instr("text", "@") > 0
    rows = _located(rows, {
        "email": (PATTERNS["email"], at), "ip": (PATTERNS["ip"], digits), "card": (PATTERNS["card"], digits),
        "phone": (PATTERNS["phone"], F.instr("text", "+") > 0), "token": (TOKEN, digits | at),
    })
    rows = rows.select("doc_id", "text", "token", F.concat(*map(_spans, KINDS)).alias("spans"))
    trimmed = F.transform("token", lambda x: F.struct(
        (x["start"] + F.length(x["match"]) - F.length(F.ltrim(x["match"], F.lit(EDGES)))).alias("start"),
        (x["end"] - F.length(x["match"]) + F.length(F.rtrim(x["match"], F.lit(EDGES)))).alias("end"),
        F.btrim(x["match"], F.lit(EDGES)).alias("match"),
    ))
    apart = lambda x: ~F.exists("spans", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))
    rows = rows.withColumn("token", trimmed)
    rows = rows.withColumn("token", F.filter("token", lambda x: (F.length(x["match"]) > 0) & apart(x)))
    tokens = F.transform("token", lambda x: F.struct(F.lit(-1).alias("kind"), x["start"], x["end"], x["match"]))
    rows = rows.select("doc_id", "text", "spans", F.concat("spans", tokens).alias("all"))
    mentions = F.transform("all", lambda x: F.struct(
        x["kind"], x["start"], x["end"], F.lower(x["match"]).alias("entity"),
        _word(F.substring("text", F.greatest(x["start"] + 1 - WINDOW, F.lit(1)), F.least(x["start"], F.lit(WINDOW))), True).alias("left"),
        _word(F.substring("text", x["end"] + 1, F.lit(WINDOW)), False).alias("right"),
    ))
    plain = F.transform("spans", lambda x: F.struct(x["kind"], x["start"], x["end"]))
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", plain.alias("spans"), mentions.alias("mentions")), "mentions")


def discovered(mentions: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, confident: float = CONFIDENT) -> DataFrame:
    """(entity, kind) of identifiers that no pattern finds but confident contexts do.

    ``mentions`` has kind (-1: not known), entity, left and right. The lexical patterns of a mention are its left word, its
    right word, and both. A graph joins patterns to entities. A seed scores 1 for its own kind and 0 for
    the others. In each round a pattern's score for a kind is the mean score of all its entities, smoothed, and 0 if fewer than
    ``least_seeds`` different seeds of the kind have it; an unknown entity's score is the chance
    that one of its patterns is right. Taken are unknown entities that score ``confident`` for one kind, by two patterns
    at least, and hardly anything for the others. They are seeds from the next round on, whose patterns find more. There are
    ``rounds`` rounds, and more as long as the last one took any.

    Edges are counted in each task before they are shuffled, and a common context is a sum, never a list.
    """
    kinds = range(len(KINDS))
    context = F.explode(F.array(
        F.concat(F.lit("l "), "left"), F.concat(F.lit("r "), "right"), F.concat(F.lit("b "), "left", F.lit(" "), "right")
    )).alias("context")
    edges = written(mentions.select("kind", "entity", context).distinct(), "pattern-graph")
    contexts = edges.groupBy("context").agg(F.count("*").alias("size"), *[F.count_if(F.col("kind") == k).alias(f"seeds{k}") for k in kinds])
    contexts = written(contexts, "contexts")
    unknown = written(edges.where("kind = -1").select("entity", "context"), "unknown")
    entities, taken, done = None, 0, 0
    while True:
        scores = contexts.withColumns({f"sum{k}": F.col(f"seeds{k}").cast("double") for k in kinds})
        if entities is not None:
            is_seed = F.col("taken").isNotNull()
            gained = unknown.join(entities, "entity").groupBy("context").agg(
                *[F.count_if(F.col("taken") == k).alias(f"more{k}") for k in kinds],
                *[F.sum(F.when(is_seed, (F.col("taken") == k).cast("double")).otherwise(F.col(f"score{k}"))).alias(f"gain{k}") for k in kinds],
            )
            zero = lambda c: F.coalesce(F.col(c), F.lit(0))
            scores = contexts.join(gained, "context", "left").select(
                "context", "size", *[(F.col(f"seeds{k}") + zero(f"more{k}")).alias(f"seeds{k}") for k in kinds],
                *[(F.col(f"seeds{k}") + zero(f"gain{k}")).alias(f"sum{k}") for k in kinds],
            )
        scores = scores.where(F.greatest(*[F.col(f"seeds{k}") for k in kinds]) >= least_seeds).select(
            "context", *[F.when(F.col(f"seeds{k}") >= least_seeds, F.col(f"sum{k}") / (F.col("size") + 1)).otherwise(0.0).alias(f"score{k}") for k in kinds]
        )
        scored = unknown.join(written(scores, "scores"), "context").groupBy("entity").agg(
            *[(1 - F.exp(F.sum(F.log1p(-F.least(F.col(f"score{k}"), F.lit(0.999)))))).alias(f"score{k}") for k in kinds],
            *[F.count_if(F.col(f"score{k}") >= 0.5).alias(f"patterns{k}") for k in kinds],
        )
        scored = written(scored, "scored")  # so that the planner does not carry the rounds' conditions on
        best = F.array_max(F.array(*[F.struct(F.col(f"score{k}").alias("score"), F.lit(k).alias("kind"), F.col(f"patterns{k}").alias("patterns")) for k in kinds]))
        total = reduce(lambda a, b: a + b, [F.col(f"score{k}") for k in kinds])
        sure = (F.col("best.score") >= confident) & (F.col("best.score") >= confident * total) & (F.col("best.patterns") >= 2)
        scored = scored.withColumn("best", best).withColumn("now", F.when(sure, F.col("best.kind")))
        if entities is not None:  # a seed stays one
            scored = scored.join(entities.select("entity", F.col("taken").alias("before")), "entity", "left").withColumn("now", F.coalesce("before", "now"))
        entities = written(scored.select("entity", *[f"score{k}" for k in kinds], F.col("now").alias("taken")), "entities")
        before, taken, done = taken, entities.where("taken is not null").count(), done + 1
        if done >= rounds and taken == before or entities.isEmpty():
            return entities.where("taken is not null").select("entity", F.col("taken").alias("kind"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (array of kind, start, end by pattern) and spans (with the discovered ones) for each row, both by kind and start.

    A null text is empty. Repeated rows give equal results.
    """
    rows = found(docs, id_col, text_col)
    mentions = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    taken = discovered(mentions)
    unknown = mentions.where("kind = -1").drop("kind")
    # a third of all mentions may be of one entity: Spark's skew join splits them, as ``taken`` has an entity once or twice
    extra = unknown.join(taken, "entity").groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("extra"))
    order = F.array_sort(F.concat("spans", F.coalesce("extra", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    return rows.select("row", "doc_id", "spans").join(extra, "row", "left").select("doc_id", F.col("spans").alias("base"), order.alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
