"""Secret scan: candidates by pattern, and a random forest that removes the false positives among them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starfeed.llm.text import WORD, chunks, map_batches, most_frequent, rows_with, unpacked
from starfeed.workspace import written

DICTIONARY_WORDS = 20_000
#: Labelled findings that the forest learns from, at most so many of either kind.
TRAINING_ROWS = 10_000
TREES, DEPTH, SEED = 40, 8, 7
MASK = "[SECRET]"

# The words that name a secret, and the formats of well-known keys.
NAMES = r"passwords?|passwd|passphrase|pwd|secrets?|tokens?|api[_-]?keys?|access[_-]?keys?|private[_-]?keys?|credentials?"
ASSIGNED = re.compile(rf"(?:{NAMES})[\"']?[ \t]{{0,3}}(?::=|=>|=|:)[ \t]{{0,3}}([\"'`]?)([^\s\"'`,;]{{6,}})", re.I)
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{16,}={0,2}")
KNOWN = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")
PLACEHOLDER = re.compile(r"(?:example|changeme|placeholder|dummy|sample|your[_-]|x{6,}|<|\$\{|\*{3,})", re.I)
#: Values that are a placeholder as a whole, not ones that happen to hold its characters.
WHOLE_PLACEHOLDER = re.compile(r"<[^<>]*>|\$\{[^{}]*\}|x{6,}|\*{3,}|changeme|(?:your|example|sample|dummy|placeholder)(?:[_-][a-z]+)*", re.I)
TEST_PATH = re.compile(r"test|example|sample|doc|fixture|mock", re.I)
LONG_WORD = re.compile(r"[^\W\d_]{16,}")

FEATURES = (
    "length", "digits", "upper", "lower", "symbols", "class_changes", "entropy", "hex", "transitions", "dictionary_cover", "longest_run",
    "assigned", "quoted", "left_known", "right_known", "left_names_secret", "left_length", "right_length", "test_path", "path_depth", "placeholder",
)
CANDIDATE = T.ArrayType(
    T.StructType()
    .add("start", "integer").add("end", "integer").add("kind", "string").add("label", "integer").add("known", "boolean").add("features", T.ArrayType(T.DoubleType()))
)
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("label", pa.int32()), ("known", pa.bool_()), ("features", pa.list_(pa.float64()))]))


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of letters of all documents, lower-cased, ``size`` at most. Counted in
    each task before the shuffle; ``size`` words reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            kept = {w: n for w, n in found.items() if w.isalpha() and 3 <= len(w) <= 24}
            found.clear()
            return pa.record_batch([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"])

        for batch in chunks(batches, "text"):
            for x in batch.column("text").to_pylist():
                if x:
                    found.update(WORD.findall(x.lower()))
            if len(found) > 400_000:
                yield flush()
        yield flush()

    counted = map_batches(docs.select(F.col(text).alias("text")), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sorted(r["word"] for r in most_frequent(written(counted, "words"), "n", size).select("word").collect())


class Reader:
    """Features of candidates, given the dictionary."""

    def __init__(self, words: list[str]):
        self.words = frozenset(words)
        self.longest = max(map(len, words), default=0)
        steps = Counter(b for w in words for b in zip("^" + w, w + "$"))
        starts = Counter()
        for (a, _), n in steps.items():
            starts[a] += n
        self.steps = {b: math.log((n + 0.5) / (starts[b[0]] + 20)) for b, n in steps.items()}
        self.unseen = math.log(0.5 / 40)

    def transitions(self, value: str) -> float:
        """Mean log probability of the value's characters after one another, as in dictionary words."""
        v = value.lower()
        pairs = list(zip("^" + v, v + "$"))
        return sum(self.steps.get(p, self.unseen) for p in pairs) / len(pairs)

    def cover(self, value: str) -> float:
        """The share of the value that dictionary words cover, longest first from the left."""
        v, at, covered = value.lower(), 0, 0
        while at < len(v):
            size = next((n for n in range(min(self.longest, len(v) - at), 2, -1) if v[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / len(v)

    def features(self, value: str, assigned: bool, quoted: bool, left: str, right: str, path: str) -> list[float]:
        n = len(value)
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
        runs, longest = 1, 1
        for a, b in zip(kinds, kinds[1:]):
            runs = runs + 1 if a == b else 1
            longest = max(longest, runs)
        counts = Counter(value)
        left, right = left.lower().strip(".,;:!?()\"'"), right.lower().strip(".,;:!?()\"'")
        share = Counter(kinds)
        return [float(x) for x in (
            n, share["d"] / n, share["u"] / n, share["l"] / n, share["s"] / n, sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1),
            -sum(k / n * math.log2(k / n) for k in counts.values()), bool(re.fullmatch(r"[0-9a-fA-F]+", value)),
            self.transitions(value), self.cover(value), longest, assigned, quoted, left in self.words, right in self.words,
            bool(re.search(NAMES, left, re.I)), len(left), len(right), bool(TEST_PATH.search(path)), path.count("/"), bool(PLACEHOLDER.search(value)),
        )]

    def candidates(self, text: str, path: str, sample_words: bool = False) -> list[tuple]:
        """(start, end, kind, label, known, features) of each candidate, in code points, none within another.

        ``known``: the value has the format of a known service's keys. ``label`` is for training, where the finding's form tells
        what it is, else null: 1 for known formats and for an assigned value of letters and digits that is mostly no words; 0 for whole
        placeholders, for plain numbers that nothing assigns, and for values that are one word, or words that nothing assigns. With
        ``sample_words`` a fixed share of the text's long words is added as kind ``word``, labelled 0: they are no findings.
        """
        spans = [(m.start(2), m.end(2), "assigned", bool(m[1])) for m in ASSIGNED.finditer(text)]
        taken = {s for s, _, _, _ in spans}
        ends = sorted((s, e) for s, e, _, _ in spans)
        at = 0
        for m in BARE.finditer(text):
            while at < len(ends) and ends[at][1] <= m.start():
                at += 1
            if m.start() not in taken and not (at < len(ends) and ends[at][0] < m.end()):
                spans.append((m.start(), m.end(), "bare", text[m.start() - 1 : m.start()] in ('"', "'", "`")))
        if sample_words:
            spans += [(m.start(), m.end(), "word", False) for m in LONG_WORD.finditer(text) if (m.start() * 2654435761 + len(text)) % 512 == 0]
        out = []
        for start, end, kind, quoted in sorted(spans):
            value = text[start:end]
            before, after = text[max(0, start - 80) : start].split(), text[end : end + 80].split()
            f = self.features(value, kind == "assigned", quoted, before[-1] if before else "", after[0] if after else "", path)
            mixed = f[FEATURES.index("digits")] > 0 and f[FEATURES.index("digits")] < 1
            cover = f[FEATURES.index("dictionary_cover")]
            known = bool(KNOWN.fullmatch(value)) and not f[-1]
            if kind == "word" or WHOLE_PLACEHOLDER.fullmatch(value) or value.lower() in self.words or kind == "bare" and (value.isdigit() or cover == 1):
                label = 0
            elif known or kind == "assigned" and mixed and len(value) >= 12 and cover <= 0.5:
                label = 1
            else:
                label = None
            out.append((start, end, kind, label, known, f))
        return out


def with_candidates(docs: DataFrame, words: list[str], keep: list[Column] | None, text: str, path: str, sample_words: bool) -> DataFrame:
    """``_row`` (the ``keep`` columns, or all) and ``found``, the candidates of each row. A null text has none; a null path is empty."""
    known = docs.sparkSession.sparkContext.broadcast(words)  # DICTIONARY_WORDS at most
    fields = {"text": text, "path": path}
    source = rows_with(docs, keep, fields)
    schema = T.StructType([source.schema["_row"], T.StructField("found", CANDIDATE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(known.value)
        for batch in chunks(unpacked(batches, fields), "text"):
            found = [
                [dict(zip(("start", "end", "kind", "label", "known", "features"), c)) for c in reader.candidates(x, "" if p is None else str(p), sample_words)] if x else []
                for x, p in zip(batch.column("text").to_pylist(), batch.column("path").to_pylist())
            ]
            yield pa.record_batch([batch.column("_row"), pa.array(found, _ARROW)], ["_row", "found"])

    return map_batches(source, run, schema)


def train(labelled: DataFrame, rows: int = TRAINING_ROWS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (label 0 or 1, features): at most about ``rows`` of either kind, the ones
    whose features hash lowest, so that the choice is the same in each run. None if one kind is missing."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    share = F.when(F.col("label") == 0, min(1.0, rows / counts[0])).otherwise(min(1.0, rows / counts[1]))
    picked = labelled.where("label in (0, 1)").where(F.pmod(F.xxhash64("features"), F.lit(1 << 40)) < share * (1 << 40))
    sample = written(picked.select(F.col("label").cast("double").alias("label"), "features"), "labelled")
    forest = RandomForestClassifier(featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(sample.select("label", array_to_vector("features").alias("vector")))


def _judged(candidates: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Adds ``probability``: the forest's, and 1 for the formats of known services. Where there was nothing to learn from
    there is no forest; then labels tell, and nothing speaks against a candidate without one."""
    if forest is None:
        return candidates.withColumn("probability", F.coalesce(F.col("label").cast("double"), F.lit(1.0)))
    scored = forest.transform(candidates.withColumn("vector", array_to_vector("features")))
    scored = scored.withColumn("probability", F.when(F.col("known"), 1.0).otherwise(vector_to_array("probability")[1]))
    return scored.drop("vector", "rawPrediction", "prediction")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row for each candidate: doc_id, start, end, kind, probability, is_secret.

    The forest learns from ``labelled`` (label, features in the order of ``FEATURES``), or else from the candidates whose form tells what they are;
    it decides on every candidate but the keys of known services, labelled by their form or not.
    Repeated rows give repeated findings; texts without candidates give none.
    """
    words = dictionary(docs, text_col)
    source = docs.withColumn("_id", F.col(id_col).cast("long"))
    rows = with_candidates(source, words, [F.col("_id")], text_col, path_col, True)
    found = written(rows.select(F.col("_row._id").alias("doc_id"), F.explode("found").alias("c")).select("doc_id", "c.*"), "candidates")
    forest = train(found.where("label is not null") if labelled is None else labelled)
    return _judged(found.where("kind <> 'word'"), forest).select(
        "doc_id", "start", "end", "kind", "probability", (F.col("probability") >= 0.5).alias("is_secret")
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with ``MASK`` for each of the sorted, disjoint spans."""
    before = F.transform(spans, lambda s, i: F.concat(
        F.substring(text, F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0) + 1, s["start"] - F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)), F.lit(MASK)
    ))
    rest = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.length(text))
    return F.concat(F.array_join(before, ""), rest)


def redacted(docs: DataFrame, text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``; all rows and columns stay. Rows without
    candidates, by far the most, are not shuffled."""
    words = dictionary(docs, text_col)
    rows = with_candidates(docs, words, None, text_col, path_col, True)
    rows = written(rows.withColumn("_n", F.monotonically_increasing_id()), "scanned")
    found = rows.select("_n", F.explode("found").alias("c")).select("_n", "c.*")
    forest = train(found.where("label is not null"))
    secrets = _judged(found.where("kind <> 'word'"), forest).where("probability >= 0.5")
    spans = secrets.groupBy("_n").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    has = F.exists("found", lambda c: c["kind"] != "word")
    marked = rows.where(has).join(spans, "_n", "left")
    new = F.when(F.size("spans") > 0, _masked(F.col(f"_row.{text_col}"), F.col("spans"))).otherwise(F.col(f"_row.{text_col}"))
    changed = marked.select(*[new.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
    return rows.where(~has).select("_row.*").union(changed)
