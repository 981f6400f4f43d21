"""Byte-level BPE as a deterministic automaton over tokens: encoding by table lookups, decoding by arc labels.

A token sequence is what BPE makes of its text just if BPE keeps each two neighbours apart. So the
automaton has one state for each token that was read last, and an arc from s to t, labelled t,
where t may follow s. It is built merge by merge. The gadget of the merge (u, v) -> w at rank k

* gives w a state with the arcs that v's state has at that time, and lets arcs labelled w leave
  wherever arcs labelled u leave;
* cuts the arc v from u's state.

A row for each state would be 50,000 by 50,000 entries, nearly all of them inherited; the tables
here hold what each gadget changed, and an arc is looked up by following the inheritance from the newest gadget down.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starfeed.llm.text import chunks, map_batches
from starfeed.llm.vocabulary import SplitWords, Vocabulary

NEVER = np.iinfo(np.int32).max
LONG_WORD = 48  # bytes; longer words are encoded one by one


class Automaton:
    def __init__(self, vocabulary: Vocabulary):
        size = max([*vocabulary.ids.values(), *vocabulary.special.values()], default=-1) + 1
        self.labels: list[bytes] = [b""] * size
        for label, token in vocabulary.ids.items():
            self.labels[token] = label
        for text, token in vocabulary.special.items():
            self.labels[token] = text.encode()
        # the gadgets: rank of the merge that made a token (-1: a byte), and the state and label it inherits from
        self.rank, self.tail, self.head = np.full(size, -1, np.int32), np.arange(size), np.arange(size)
        cuts = np.zeros((len(vocabulary.merges), 2), np.int64)
        for k, (u, v, w) in enumerate(vocabulary.merges):
            if self.rank[w] < 0 and len(self.labels[w]) > 1:  # a second way to the same token is never taken
                self.rank[w], self.tail[w], self.head[w] = k, v, u
            cuts[k] = u << 32 | v, k
        cuts = cuts[np.argsort(cuts[:, 0], kind="stable")]
        self.cut_pairs, self.cut_ranks = cuts[:, 0].copy(), cuts[:, 1].astype(np.int32)
        self.maybe_cut = np.zeros(1 << 22, bool)  # most pairs are never cut: this tells most of them without a search
        self.maybe_cut[self._bit(self.cut_pairs)] = True
        self._spell(vocabulary)

    @staticmethod
    def _bit(pairs: np.ndarray) -> np.ndarray:
        return (pairs * 0x1E3779B97F4A7C15) >> 20 & 0x3FFFFF

    def _spell(self, vocabulary: Vocabulary) -> None:
        """The labels as a trie: steps[256 * node + byte] is the next node, 0 for none; ``spells`` has a node's token or -1."""
        nodes, steps = {b"": 0}, {}
        for label in vocabulary.ids:
            for i in range(1, len(label) + 1):
                if label[:i] not in nodes:
                    nodes[label[:i]] = len(nodes)
                    steps[nodes[label[: i - 1]] << 8 | label[i - 1]] = nodes[label[:i]]
        self.steps = np.zeros(256 * len(nodes), np.int32)
        self.steps[np.fromiter(steps.keys(), np.int64, len(steps))] = np.fromiter(steps.values(), np.int32, len(steps))
        self.sizes = np.asarray([len(x) for x in self.labels])
        self.spells = np.full(len(nodes), -1, np.int64)
        for label, token in vocabulary.ids.items():
            self.spells[nodes[label]] = token

    def arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Which of the arcs (states[i], tokens[i]) exist; a negative state is the start, from which all leave.

        Follows both inheritances back, undoing the later gadget first. A cut at rank k counts where it was made
        before the left token was made, and not after the right one was (in a tie the leftmost merge comes first).
        """
        exists = np.ones(len(states), bool)
        at = np.flatnonzero(states >= 0)
        a, b = states[at].copy(), tokens[at].copy()
        before = np.full(len(at), NEVER, np.int32)
        until = before.copy()
        while len(at):
            pair = a << 32 | b
            cut = self.maybe_cut[self._bit(pair)]
            seen = np.flatnonzero(cut)
            place = np.minimum(np.searchsorted(self.cut_pairs, pair[seen]), len(self.cut_pairs) - 1)
            rank = self.cut_ranks[place]
            cut[seen] = (self.cut_pairs[place] == pair[seen]) & (rank < before[seen]) & (rank <= until[seen])
            exists[at[cut]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~cut & ((ra >= 0) | (rb >= 0))
            left = ra > rb
            before, until = np.where(left, ra, before)[go], np.where(left, until, rb)[go]
            a, b, at = np.where(left, self.tail[a], a)[go], np.where(left, b, self.head[b])[go], at[go]
        return exists

    def encode(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The tokens of each word. Words of like length are read side by side."""
        out: list[tuple[int, ...]] = [()] * len(words)
        sizes = np.asarray([len(w) for w in words], np.int64)
        for size in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == size)
            if size > LONG_WORD:
                for i in rows.tolist():
                    out[i] = self._long(words[i])
                continue
            text = np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8).reshape(-1, size).astype(np.int64)
            for i, ids in zip(rows.tolist(), self._columns(text)):
                out[i] = ids
        return out

    def _columns(self, text: np.ndarray) -> list[tuple[int, ...]]:
        count, size = text.shape
        state = np.full((count, size + 1), -1, np.int64)  # the token that ends here in the one path that reaches here
        reached = np.zeros((count, size + 1), bool)
        reached[:, 0] = True
        for start in range(size):
            rows = np.flatnonzero(reached[:, start])
            node = np.zeros(len(rows), np.int32)
            for end in range(start, size):
                node = self.steps[node << 8 | text[rows, end]]
                rows, node = rows[node > 0], node[node > 0]
                if not len(rows):
                    break
                token = self.spells[node]
                full = np.flatnonzero(token >= 0)
                full = full[self.arcs(state[rows[full], start], token[full])]
                state[rows[full], end + 1] = token[full]
                reached[rows[full], end + 1] = True
        if not reached[:, size].all():
            raise ValueError("the vocabulary lacks a byte of the text")
        ids: list[list[int]] = [[] for _ in range(count)]
        at = np.full(count, size)
        while (live := np.flatnonzero(at > 0)).size:
            token = state[live, at[live]]
            for i, t in zip(live.tolist(), token.tolist()):
                ids[i].append(t)
            at[live] -= self.sizes[token]
        return [tuple(x[::-1]) for x in ids]

    def _long(self, word: bytes) -> tuple[int, ...]:
        """The same reading for one word of any length, with the arcs seen so far kept."""
        arc = self._arc
        last: list[int | None] = [None] * (len(word) + 1)
        last[0] = -1
        for start in range(len(word)):
            if (state := last[start]) is None:
                continue
            node = 0
            for end in range(start, len(word)):
                node = int(self.steps[node << 8 | word[end]])
                if not node:
                    break
                token = int(self.spells[node])
                if token >= 0 and (state < 0 or arc(state, token)):
                    last[end + 1] = token
        if last[-1] is None:
            raise ValueError("the vocabulary lacks a byte of the text")
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= len(self.labels[last[at]])
        return tuple(ids[::-1])

    @functools.cached_property
    def _arc(self):
        @functools.lru_cache(200_000)
        def arc(state: int, token: int) -> bool:
            return bool(self.arcs(np.asarray([state]), np.asarray([token]))[0])

        return arc

    def decode(self, ids) -> bytes:
        """The arc labels along a path, put together."""
        return b"".join(map(self.labels.__getitem__, ids))


class AutomatonEncoder:
    """Ids of whole texts. Each new word of a batch is read by the automaton once, and decoded from its ids once; up to ``limit`` words are kept."""

    def __init__(self, path: str, limit: int = 600_000):
        vocabulary = Vocabulary(path)
        self.automaton, self.split, self.limit = Automaton(vocabulary), SplitWords(vocabulary.special), limit
        self.digits = list(map(str, range(len(self.automaton.labels))))
        self.known: dict[str, tuple[int, ...]] = {}
        # of the same words: the ids in decimal, comma-joined, and the bytes decoded from them
        self.shown: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def pieces(self, texts: list[str | None]) -> list[list[list[str] | int]]:
        """Each text as lists of words, all known now, and ids of special tokens (see ``SplitWords``)."""
        split = [list(self.split.pieces(t)) for t in texts]
        words = set(itertools.chain.from_iterable(p for pieces in split for p in pieces if isinstance(p, list)))
        if len(self.known) + len(words) > self.limit:
            self.known.clear(), self.shown.clear(), self.decoded.clear()
        new = list(words - self.known.keys())
        ids = self.automaton.encode([w.encode() for w in new])
        self.known.update(zip(new, ids))
        self.shown.update((w, ",".join(map(self.digits.__getitem__, x))) for w, x in zip(new, ids))
        self.decoded.update((w, self.automaton.decode(x)) for w, x in zip(new, ids))
        return split

    def ids(self, pieces: list[list[str] | int]) -> list[int]:
        get = self.known.__getitem__
        return list(itertools.chain.from_iterable([p] if isinstance(p, int) else itertools.chain.from_iterable(map(get, p)) for p in pieces))

    def ids_and_bytes(self, pieces: list[list[str] | int]) -> tuple[str, bytes]:
        """The ids in decimal, comma-joined, and what they decode to."""
        ids = [self.digits[p] if isinstance(p, int) else ",".join(map(self.shown.__getitem__, p)) for p in pieces]
        text = [self.automaton.decode([p]) if isinstance(p, int) else b"".join(map(self.decoded.__getitem__, p)) for p in pieces]
        return ",".join(filter(None, ids)), b"".join(text)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [self.ids(pieces) for pieces in self.pieces(texts)]


@functools.lru_cache(2)
def encoder(path: str) -> AutomatonEncoder:
    """One for each Python worker: it lives on through the worker's tasks."""
    return AutomatonEncoder(path)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) for each row; a null text is empty.

    ``ids`` are those of the tokenizers library for the vocabulary file (special tokens' strings become their ids, nothing
    is added); the digests are of the ids in decimal, comma-joined, and of the text decoded from them.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    fields = {"doc_id": pa.int64(), "ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if not with_ids:
        del fields["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in chunks(batches, "text"):
            split = coder.pieces(batch.column("text").to_pylist())
            both = list(map(coder.ids_and_bytes, split))
            values = {
                "doc_id": batch.column("doc_id"),
                "ids": list(map(coder.ids, split)) if with_ids else None,
                "n_tokens": [ids.count(",") + 1 if ids else 0 for ids, _ in both],
                "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in both],
                "decoded_sha256": [hashlib.sha256(text.decode("utf-8", "replace").encode()).hexdigest() for _, text in both],
            }
            yield pa.record_batch([values[n] if n == "doc_id" else pa.array(values[n], t) for n, t in fields.items()], list(fields))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(source, run, schema if with_ids else schema.replace("ids array<int>, ", "", 1))
