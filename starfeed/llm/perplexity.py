"""Quality rules and perplexity bands of a modified Kneser-Ney model over the characters of words."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starfeed.llm.text import WORD, chunks, map_batches, mixed, rows_with, unpacked
from starfeed.workspace import written

ORDER = 5
#: So many languages' bands, 50 bytes each, are broadcast after they were counted; more are joined by shuffle.
MOST_SENT = 100_000
#: Robust deviations of log perplexity: none counts as less than this, nor as less than half of the languages' mean; that of a
#: language with fewer distinct texts than FEW_TEXTS not as less than the mean.
LEAST_DEVIATION = 0.1
FEW_TEXTS = 30
START, END = "\x02", "\x03"
SYMBOLS = re.compile(r"[#*$%&|<>]")
MULTIPLIER = np.uint64(0x100000001B3)


def _key(folded: np.ndarray, lang: np.ndarray, size: int) -> np.ndarray:
    """The 64-bit hash that stands for a language's n-gram of ``size`` characters, as a signed number."""
    sized = np.uint64((size + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mixed(folded + lang + sized).view(np.int64)


def _lang_hash(lang: str | None) -> int:
    return xxhash.xxh3_64_intdigest(lang or "")


def _codes(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each with order-1 start marks before and an end mark after, and the words' lengths in it."""
    joined = "".join([START * (order - 1) + w + END for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.asarray([len(w) + order for w in words], np.int64)


def _folds(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """folds[k][p]: the k characters that end at p, folded from the last to the first."""
    folds = [np.zeros(len(codes), np.uint64)]
    for k in range(1, order + 1):
        left = np.zeros(len(codes), np.uint64)
        left[k - 1 :] = codes[: len(codes) - k + 1]
        folds.append(folds[-1] * MULTIPLIER + left + np.uint64(1))
    return folds


def _grams(docs: DataFrame, lang: str, text: str, order: int) -> DataFrame:
    """(lang, gram, n): how often each run of ``order`` characters of a padded word occurs, summed up inside each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            out: dict[tuple[str, str], int] = {}
            for name, found in words.items():
                grams: dict[str, int] = {}
                for w, n in found.items():
                    w = START * (order - 1) + w + END
                    for i in range(len(w) - order + 1):
                        g = w[i : i + order]
                        grams[g] = grams.get(g, 0) + n
                out |= {(name, g): n for g, n in grams.items()}
            words.clear()
            return pa.record_batch(
                [pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array(out.values(), pa.int64())],
                ["lang", "gram", "n"],
            )

        for batch in chunks(batches, "text"):
            for name, x in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if x:
                    words.setdefault(name or "", Counter()).update(WORD.findall(x))
            if sum(map(len, words.values())) > 300_000:
                yield flush()
        if words:
            yield flush()

    source = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = map_batches(source, run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Hashed:
    """Values by 64-bit hash: hashes sorted as unsigned numbers, and where those begin that share their first bits, one or so each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        at = np.argsort(keys.view(np.uint64))
        self.keys, self.values = keys[at], values[at]
        self.bits = max(1, math.ceil(math.log2(len(keys) + 1)))
        sizes = np.bincount((self.keys.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64), minlength=1 << self.bits)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32 if len(keys) < 1 << 31 else np.int64)


class KneserNey:
    """Interpolated modified Kneser-Ney probabilities by hash, one pair of tables for each order:
    hashes of n-grams with log probabilities, and of contexts with log back-off weights."""

    def __init__(self, tables: list[pa.Table], order: int):
        self.order = order
        self.uniform = math.log(1 / (len(tables[0]) + 1))
        self.grams: list[Hashed] = []
        self.contexts: list[Hashed] = []
        for k, table in enumerate(tables, 1):
            key, context, tail, n, group = (table.column(c).to_numpy() for c in ("key", "context", "tail", "n", "lang_key"))
            n = n.astype(float)
            discount = self._discounts(n, group)
            first, place = np.unique(context, return_inverse=True)
            total = np.bincount(place, n, len(first))
            weight = np.bincount(place, discount, len(first)) / np.maximum(total, 1e-300)
            lower = np.full(len(key), math.exp(self.uniform)) if k == 1 else np.exp(self._found(k - 1, tail))
            p = (n - discount) / total[place] + weight[place] * lower
            self.grams.append(Hashed(key, np.log(p).astype(np.float32)))
            self.contexts.append(Hashed(first, np.log(np.maximum(weight, 1e-9)).astype(np.float32)))

    @staticmethod
    def _discounts(n: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The discount of each n-gram, by its count (1, 2, 3 or more) and its language's counts of counts."""
        _, place = np.unique(group, return_inverse=True)
        size = place.max(initial=-1) + 1
        t = [np.bincount(place, n == i, size) for i in range(1, 5)]
        y = np.where(t[0] > 0, t[0] / np.maximum(t[0] + 2 * t[1], 1), 0.5)
        each = [np.where(t[i] > 0, i + 1 - (i + 2) * y * t[i + 1] / np.maximum(t[i], 1), 0.5 * (i + 1)) for i in range(3)]
        each = [np.clip(d, 0.05 * (i + 1), 0.95 * (i + 1)) for i, d in enumerate(each)]
        return np.where(n == 1, each[0][place], np.where(n == 2, each[1][place], each[2][place]))

    def _found(self, k: int, wanted: np.ndarray) -> np.ndarray:
        return self._look(self.grams[k - 1], wanted)[1]

    @staticmethod
    def _look(table: Hashed, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is in the table, and its value (any, if not)."""
        if not len(table.keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
        bucket = (wanted.view(np.uint64) >> np.uint64(64 - table.bits)).astype(np.int64)
        at, end = table.first[bucket], table.first[bucket + 1]
        at = np.minimum(at, len(table.keys) - 1)
        hit = table.keys[at] == wanted
        todo = np.flatnonzero(~hit & (at + 1 < end))
        while len(todo):
            at[todo] += 1
            hit[todo] = table.keys[at[todo]] == wanted[todo]
            todo = todo[~hit[todo] & (at[todo] + 1 < end[todo])]
        return hit, table.values[at]

    def log_probabilities(self, words: list[str], langs: np.ndarray) -> np.ndarray:
        """Natural log probability of each word with its end, in the model of its language hash."""
        codes, lengths = _codes(words, self.order)
        folds, lang = _folds(codes, self.order), np.repeat(langs, lengths)
        ends = np.cumsum(lengths)
        scored = np.ones(len(codes), bool)
        for i in range(self.order - 1):
            scored[ends - lengths + i] = False
        at = np.flatnonzero(scored)
        result, weight, open_ = np.zeros(len(at)), np.zeros(len(at)), np.ones(len(at), bool)
        for k in range(self.order, 0, -1):
            todo = np.flatnonzero(open_)
            p, l = at[todo], lang[at[todo]]
            hit, value = self._look(self.grams[k - 1], _key(folds[k][p], l, k))
            result[todo[hit]] = weight[todo[hit]] + value[hit]
            open_[todo[hit]] = False
            miss = todo[~hit]
            p = at[miss]
            known, value = self._look(self.contexts[k - 1], _key(folds[k - 1][p - 1], lang[p], k - 1))
            weight[miss] += np.where(known, value, 0)
        result[open_] = weight[open_] + self.uniform
        word = np.repeat(np.arange(len(words)), lengths)[at]
        return np.bincount(word, result, len(words))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER) -> KneserNey:
    """Counts in Spark over all documents: occurrences for the highest order, and for each lower order the
    number of different characters seen before an n-gram. The driver gets one row for each distinct n-gram of a language."""
    counted = written(_grams(docs, lang, text, order), "grams")
    tables, frame = [], counted

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            k = len(grams[0]) if grams else 1
            codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64).reshape(-1, k)
            hashes = {}
            langs = np.asarray([hashes.setdefault(x, _lang_hash(x)) for x in batch.column("lang").to_pylist()], np.uint64)
            fold = lambda part: _folds(part.ravel(), part.shape[1])[-1][part.shape[1] - 1 :: part.shape[1]] if part.shape[1] else np.zeros(len(part), np.uint64)
            yield pa.record_batch(
                [*(pa.array(x) for x in (_key(fold(codes), langs, k), _key(fold(codes[:, :-1]), langs, k - 1), _key(fold(codes[:, 1:]), langs, k - 1))),
                 batch.column("n"), pa.array(langs.view(np.int64))],
                ["key", "context", "tail", "n", "lang_key"],
            )

    for k in range(order, 0, -1):
        tables.append(map_batches(frame, keyed, "key long, context long, tail long, n long, lang_key long").toArrow())
        if k > 1:
            frame = frame.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("n"))
    return KneserNey(tables[::-1], order)


def _repeats(words: list[str]) -> int:
    """How many words lie in 3-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, end, covered = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def _text_hash(text: str | None) -> int:
    return (xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) ^ 0x8000000000000000) - 0x8000000000000000


MEASURES = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "log_perplexity": "double", "text_hash": "long"
}


def measured(docs: DataFrame, model: KneserNey, lang: str = "lang", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A struct ``_row`` of the ``keep`` columns (all, if not given), the language, and the measures of each text.

    ``log_perplexity`` is the mean of minus the log probability over the words, null without words. ``text_hash`` tells texts apart.
    A null text has no words, and a null language is one of its own.
    """
    fields = {"lang": lang, "text": text}
    source = rows_with(docs, None if keep is None else [F.col(c) for c in keep], fields)
    schema = T.StructType([source.schema["_row"], T.StructField("lang", T.StringType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    for name, kind in MEASURES.items():
        schema = schema.add(name, kind)
    names = list(MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, dict[str, float]] = {}
        for batch in chunks(unpacked(batches, fields), "text"):
            if sum(map(len, known.values())) > 200_000:
                known.clear()
            rows = []
            langs, texts = (batch.column(c).to_pylist() for c in ("lang", "text"))
            found = [WORD.findall(x) if x else [] for x in texts]
            fresh: dict[str | None, set] = {}
            for name, words in zip(langs, found):
                fresh.setdefault(name, set()).update(words)
            for name, words in fresh.items():
                new = sorted(words - known.setdefault(name, {}).keys())
                for part in (new[i : i + 20_000] for i in range(0, len(new), 20_000)):
                    known[name].update(zip(part, shared.value.log_probabilities(part, np.full(len(part), _lang_hash(name), np.uint64)).tolist()))
            for name, words, x in zip(langs, found, texts):
                chars = sum(map(len, words))
                score = -math.fsum(map(known[name].__getitem__, words)) / len(words) if words else None
                rows.append((len(words), chars, len(SYMBOLS.findall(x or "")), _repeated_lines(x) if words else 0, _repeats(words), score, _text_hash(x)))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.record_batch(
                [batch.column("_row"), batch.column("lang"), *(pa.array(c, pa.float64() if n == "log_perplexity" else pa.int64()) for n, c in zip(names, columns))],
                ["_row", "lang", *names],
            )

    return map_batches(source, run, schema)


def rule_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated 3-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bands(rows: DataFrame, width: float) -> DataFrame:
    """(lang, low, high): the median log perplexity of a language's distinct texts that pass the rules, ``width`` robust deviations
    down and up. Copies count once, so a text that makes up most of a language does not narrow its band, and a deviation that near
    copies or few texts make small is raised by that of the other languages. Sketches of bounded size, summed up in each task first."""
    once = rows.where(~rule_failed()).groupBy("lang", "text_hash").agg(F.min("log_perplexity").alias("score"))
    quantiles = F.percentile_approx("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000)
    middle = written(once.groupBy("lang").agg(F.count("*").alias("texts"), quantiles.alias("q")), "quantiles")
    own = (F.col("q")[2] - F.col("q")[0]) / 1.349
    mean = middle.agg(F.sum(own * F.col("texts")) / F.sum("texts")).first()[0] or 0.0
    least = F.when(F.col("texts") < FEW_TEXTS, F.lit(mean)).otherwise(F.lit(mean / 2))
    spread = width * F.greatest(own, least, F.lit(LEAST_DEVIATION))
    return middle.select(F.col("lang").alias("band_lang"), (F.col("q")[1] - spread).alias("low"), (F.col("q")[1] + spread).alias("high"))


def judged(docs: DataFrame, width: float = 8.0, keep: list[str] | None = None, **options) -> DataFrame:
    """``_row``, the measures, ``base_failed`` and ``kept`` for each document. Rejected are
    documents that fail the rules and those outside their language's perplexity band. Repeated rows fare alike; a
    language whose documents all fail the rules has no band, and needs none."""
    rows = written(measured(docs, train(docs, **options), keep=keep, **options), "measured")
    limits = written(bands(rows, width), "bands")
    if limits.count() <= MOST_SENT:
        limits = F.broadcast(limits)
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return rows.join(limits, rows["lang"].eqNullSafe(limits["band_lang"]), "left").select(
        *[c for c in rows.columns if c != "text_hash"], rule_failed().alias("base_failed"), (~rule_failed() & inside).alias("kept")
    )
