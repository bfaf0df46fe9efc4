"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

A text's lattice has an edge for every vocabulary piece that matches at a place. Forward
filtering sums the weights of all ways to each place; backward sampling then draws edges from
the end, each in proportion to the ways that reach it. Draws are hashes of the row's key and
their place, so a key gives the same segmentation on any executor and any number of times.

No piece has white space inside, so the lattice falls apart at spaces and a word's lattice is
filtered once for all its occurrences. It also falls apart at places that no piece crosses, as
texts without spaces have many: long words are filtered and drawn in parts between such places.
Tasks work on all parts of a batch of texts at once: a table of cumulative edge weights per
place, a sorted search for each draw.

Decoding is lossless: characters that no piece has are byte pieces, and so is the mark that
stands for a space where the text itself has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm.common import small_batches

MARK = "▁"  # stands for a space in pieces
BYTE_COST = 2.0  # how much less likely a byte piece is than the rarest piece, as a natural logarithm
CHUNK = 1 << 15  # words drawn at once
PART = 32  # characters after which a part of a word ends where it can
CACHED = 40_000  # words whose lattices a task keeps


@dataclass(frozen=True)
class Vocabulary:
    """Ids of the byte pieces, all pieces and their log-probabilities by id, and the trie of the others.

    steps: node << 21 | character, sorted; targets: the node each leads to; ends: a node's piece or -1.
    """

    bytes: tuple[int, ...]
    pieces: tuple[str, ...]
    logs: np.ndarray
    steps: np.ndarray
    targets: np.ndarray
    ends: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a model file. A merge model's scores are ranks, not probabilities; weights then fall with the rank as word frequencies do."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = tuple(model.id_to_piece(k) for k in range(n))
        usual = [k for k in range(n) if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k) or model.is_unused(k))]
        scores = np.array([model.get_score(k) for k in range(n)])
        known = [k for k in usual if scores[k] > -1e8]
        by_rank = all(float(scores[k]).is_integer() for k in known)
        logs = np.full(n, -np.inf)
        logs[known] = -np.log(1 + np.abs(scores[known])) if by_rank else scores[known]
        logs[[k for k in usual if scores[k] <= -1e8]] = logs[known].min()
        bytes_ = tuple(next(k for k in range(n) if pieces[k] == f"<0x{b:02X}>") for b in range(256))
        logs[list(bytes_)] = logs[known].min() - BYTE_COST
        nodes, steps, ends = {"": 0}, {}, [-1]
        for k in usual:
            if MARK in pieces[k][1:]:
                continue  # of a run of spaces each is a word's own
            for n_chars, char in enumerate(pieces[k]):
                at = nodes[pieces[k][:n_chars]]
                if pieces[k][: n_chars + 1] not in nodes:
                    nodes[pieces[k][: n_chars + 1]] = len(ends)
                    steps[at << 21 | ord(char)] = len(ends)
                    ends.append(-1)
            ends[nodes[pieces[k]]] = k
        keys = np.array(sorted(steps), np.int64)
        return cls(bytes_, pieces, logs, keys, np.array([steps[x] for x in keys.tolist()], np.int64), np.array(ends, np.int64))


class Lattices:
    """Filtered lattices of words: edges to draw from, in order of the place where they end.

    Place k of word w is node `base[w] + k`; `first[node]` is the first edge that ends there,
    `share` an edge's cumulative weight among those, `back` the node where it begins and
    `piece` its id (from the vocabulary's size on: a number in `spelled`, byte ids). A word has
    `many[w]` parts from `part[w]` on; a part reaches from node `low` to node `high`, and all
    ways through the word meet in both.
    """

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        self.v, self.logs = vocabulary, alpha * vocabulary.logs
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.spelled: list[tuple[int, ...]] = []
        self.spelling: dict[int, int] = {}
        self.base, self.first, self.back, self.piece, self.part, self.many, self.low, self.high = (np.zeros(0, np.int32) for _ in range(8))
        self.share = np.zeros(0)

    def add(self, words: list[str]) -> None:
        """Filter the lattices of new words, all at once."""
        v, old, size = self.v, len(self.first), len(self.share)
        chars = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        start = np.cumsum(lengths) - lengths
        base = start + np.arange(len(words))  # a word has a node more than characters
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(chars))
        node, end_of_word = at + word, (start + lengths)[word]
        # walk the vocabulary's trie from every character; a mark within a word is the text's own and spelled in bytes
        alone = np.ones(len(chars), bool)
        backs, ends, pieces = [], [], []
        inner = (chars == ord(MARK)) & (at > start[word])
        live, state, depth = at[~inner], np.zeros(int((~inner).sum()), np.int64), 0
        while len(live):
            key = state << 21 | chars[live + depth]
            k = np.minimum(np.searchsorted(v.steps, key), len(v.steps) - 1)
            on = v.steps[k] == key
            live, state, depth = live[on], v.targets[k[on]], depth + 1
            piece = v.ends[state]
            full = piece >= 0
            if depth == 1:
                alone[live[full]] = False
            backs.append(node[live[full]])
            ends.append(node[live[full]] + depth)
            pieces.append(piece[full])
            on = live + depth < end_of_word[live]
            live, state = live[on], state[on]
        for c in np.unique(chars[alone]).tolist():
            if c not in self.spelling:
                self.spelling[c] = len(self.spelled)
                self.spelled.append(tuple(v.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")))
        left = node[alone]
        spelling = np.array([self.spelling[c] for c in chars[alone].tolist()], np.int64)
        weight = np.concatenate([self.logs[np.concatenate(pieces)], self.logs[v.bytes[0]] * np.array([len(x) for x in self.spelled] or [0])[spelling]])
        back, end = np.concatenate([*backs, left]), np.concatenate([*ends, left + 1])
        piece = np.concatenate([*pieces, spelling + len(v.pieces)])
        n_nodes = len(chars) + len(words)
        cut = self._cuts(back, end, base, lengths)
        low = np.flatnonzero(cut)
        place = end - low[np.cumsum(cut)[end - 1] - 1]
        order = np.argsort(place * n_nodes + end, kind="stable")
        back, end, piece, weight, place = (x[order] for x in (back, end, piece, weight, place))
        ways, share, first = np.zeros(n_nodes + 1), np.zeros(len(end)), np.zeros(n_nodes, np.int64)
        heads = np.flatnonzero(np.diff(end, prepend=-1))
        first[end[heads]] = heads
        into = np.where(cut, n_nodes, np.arange(n_nodes))[end[heads]]  # parts begin with one way, whatever came before
        counts = np.diff(np.append(heads, len(end)))
        borders = np.append(np.flatnonzero(np.diff(place[heads], prepend=-1)), len(heads))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):  # nodes at one place of their parts
            left, right = heads[a], heads[b] if b < len(heads) else len(end)
            starts, many = heads[a:b] - left, counts[a:b]
            logs = ways[back[left:right]] + weight[left:right]
            top = np.maximum.reduceat(logs, starts)
            sums = np.exp(logs - np.repeat(top, many))
            for k in range(1, int(many.max())):  # a node at a time, so that no other part changes a last digit
                at = starts[many > k] + k
                sums[at] += sums[at - 1]
            total = sums[starts + many - 1]
            share[left:right] = sums / np.repeat(total, many)
            ways[into[a:b]] = top + np.log(total)
        share[heads + counts - 1] = 1.0
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))
        longer = lambda old, new: np.concatenate((old, new.astype(old.dtype)))
        self.first, self.back, self.base = longer(self.first, first + size), longer(self.back, back + old), longer(self.base, base + old)
        self.piece, self.share = longer(self.piece, piece), longer(self.share, share)
        part = np.searchsorted(low, base)  # a word's first part begins with it, its last ends with it
        many = np.diff(np.append(part, len(low)))
        high = np.append(low[1:], 0)
        high[part + many - 1] = base + lengths
        self.part, self.many = longer(self.part, part + len(self.low)), longer(self.many, many)
        self.low, self.high = longer(self.low, low + old), longer(self.high, high + old)

    @staticmethod
    def _cuts(back: np.ndarray, end: np.ndarray, base: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which nodes begin a part: the words' first, and in each PART characters the first that no edge crosses, if any."""
        n_nodes = int(base[-1] + lengths[-1] + 1)
        crossed = np.cumsum(np.bincount(back + 1, minlength=n_nodes + 1)[:n_nodes] - np.bincount(end, minlength=n_nodes + 1)[:n_nodes]) > 0
        cut = np.zeros(n_nodes, bool)
        cut[base] = True
        long_ = np.flatnonzero(lengths > PART)
        if len(long_):
            size = lengths[long_] - PART  # places from PART on, but the last
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + PART
            node = np.repeat(base[long_], size) + at
            free = ~crossed[node]
            node, block = node[free], np.repeat(long_, size)[free] << 40 | at[free] // PART
            cut[node[np.diff(block, prepend=-1) != 0]] = True
        return cut

    def draw(self, words: list[str], places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words one after another, and how many each has; places: where the words start in their texts."""
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if new and len(self.words) + len(new) > CACHED:
            self.clear()
            new = list(dict.fromkeys(words))
        if new:
            self.add(new)
        word = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        many = self.many[word].astype(np.int64)
        heads = np.cumsum(many) - many
        part = np.repeat(self.part[word] - heads, many) + np.arange(int(many.sum()))
        low, node, who = self.low[part], self.high[part].astype(np.int64), np.arange(len(part))
        shift, keys = np.repeat(places - self.base[word], many), np.repeat(keys, many)
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(len(part), np.int64)
        while len(who):
            u = uniform(keys[who], shift[who] + node)
            edge = self.first[node].astype(np.int64)
            late = np.flatnonzero(self.share[edge] <= u)
            while len(late):
                edge[late] += 1
                late = late[self.share[edge[late]] <= u[late]]
            drawn.append((who, self.piece[edge]))
            counts[who] += 1
            node = self.back[edge].astype(np.int64)
            on = node != low[who]
            node, who = node[on], who[on]
        out, last = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts) - 1
        for step, (who, piece) in enumerate(drawn):  # drawn from the end
            out[last[who] - step] = piece
        if len(out) and out.max() >= len(self.v.pieces):  # spelled characters
            size = len(self.v.pieces)
            times = np.ones(len(out), np.int64)
            odd = np.flatnonzero(out >= size)
            times[odd] = [len(self.spelled[k - size]) for k in out[odd].tolist()]
            counts = np.add.reduceat(times, last - counts + 1)
            starts = np.cumsum(times) - times
            spread = np.repeat(out, times)
            for k in odd.tolist():
                spread[starts[k] : starts[k] + times[k]] = self.spelled[out[k] - size]
            out = spread
        return out, np.add.reduceat(counts, heads)


def uniform(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on a row's key and a place (SplitMix64)."""
    x = places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + keys
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def sample(lattices: Lattices, keys: list[int], texts: list[str | None]) -> list[np.ndarray | None]:
    """Piece ids of each text, drawn by its key; None for null."""
    out: list[np.ndarray | None] = [None] * len(texts)
    words: list[str] = []
    rows: list[tuple[int, int]] = []

    def flush() -> None:
        if not rows:
            return
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n = np.array([x for _, x in rows])
        start = np.cumsum(lengths + 1) - lengths - 1
        place = start - np.repeat(start[np.cumsum(n) - n], n)
        key = np.repeat(np.array([keys[r] for r, _ in rows], np.int64).view(np.uint64), n)
        pieces, counts = lattices.draw(words, place, key)
        ends = np.cumsum(counts)[np.cumsum(n) - 1]
        for (r, _), part in zip(rows, np.split(pieces, ends[:-1]), strict=True):
            out[r] = part.astype(np.int32)
        words.clear()
        rows.clear()

    for r, text in enumerate(texts):
        if text is not None:
            found = text.split(" ")
            words.extend(found)
            rows.append((r, len(found)))
            if len(words) >= CHUNK:
                flush()
    flush()
    return out


def decode(vocabulary: Vocabulary, ids, parts: list[bytes]) -> str:
    """The text of piece ids; parts: bytes of each piece."""
    return b"".join(map(parts.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def piece_bytes(v: Vocabulary) -> list[bytes]:
    parts = [p.replace(MARK, " ").encode() for p in v.pieces]
    for b, k in enumerate(v.bytes):
        parts[k] = bytes([b])
    return parts


def encoded(spark: SparkSession, key: Column, text: Column, vocabulary: Vocabulary, alpha: float = 1.0) -> Column:
    """Sampled piece ids of a column of texts, seeded by a column of keys. alpha: 1 samples by weight, more favours the likeliest, 0 draws all ways alike."""
    shared = spark.sparkContext.broadcast(vocabulary)  # a model file's size
    made: list[Lattices] = []

    def encode(batches):
        if not made:
            made.append(Lattices(shared.value, alpha))
        for keys, texts in batches:
            yield pd.Series(sample(made[0], keys.tolist(), texts.tolist()), dtype=object)

    encode.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(encode, "array<int>")(F.xxhash64(key.cast("string")), text)


def decoded(spark: SparkSession, ids: Column, vocabulary: Vocabulary) -> Column:
    """Texts of a column of piece ids."""
    shared = spark.sparkContext.broadcast(vocabulary)
    made: list[list[bytes]] = []

    def texts(values: pd.Series) -> pd.Series:
        if not made:
            made.append(piece_bytes(shared.value))
        return pd.Series([None if x is None else decode(shared.value, x, made[0]) for x in values], dtype=object)

    return F.pandas_udf(texts, "string")(ids)


def tokenized(df: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", alpha: float = 1.0, out: str = "pieces") -> DataFrame:
    """`df` with the sampled piece ids of whole texts as column `out`, which replaces one of that name.

    Row by row, without a shuffle. Null texts give null, an empty text the piece of the space
    before it; a null key seeds like the text "null" would not, but always alike. Repeated
    rows get equal ids, as keys and texts decide them; an empty table gives an empty one.
    """
    return small_batches(df).withColumn(out, encoded(df.sparkSession, F.col(key), F.col(text), vocabulary, alpha))
