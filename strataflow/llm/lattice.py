"""LM scoring by subword lattices: all segmentations of a word under an existing vocabulary, weights learned from the corpus."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from strataflow.llm.arrow import by_bytes, exclusive, in_arrow
from strataflow.llm.scratch import discard, stored

#: Rounds of expectation-maximisation, occurrences that every unit has besides those found, and what is taken off each word's own count for the lattice.
ROUNDS, PRIOR, DISCOUNT = 3, 0.01, 0.75
#: Classes of documents (their commonest languages; all others are one more) that have weights of their own.
CLASSES = 6
#: Bytes of words whose lattices are laid out at once, and of a piece in which a longer word is learned from.
LATTICE_BYTES, LEARN_BYTES = 1 << 18, 1 << 12
#: A word with at least this share of all tokens for each ``HOT_BYTES`` that it is long is broadcast.
HOT_SHARE, HOT_BYTES = 1 / 65_536, 64


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> tuple[list[bytes], np.ndarray]:
    """Units of a SentencePiece vocabulary that a word behind a space can be made of, as bytes, and what their scores make likely.

    Scores of a unigram model are logarithms of probabilities; those of a BPE model are negative ranks, of which
    Zipf's law makes probabilities. Byte pieces come last. Pieces that spell the same are one unit.
    """
    import public_tokenizers
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto()
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    logs = model.trainer_spec.model_type == 1
    weight: dict[bytes, float] = dict.fromkeys((bytes([x]) for x in range(256)), 1 / (len(model.pieces) + 1))
    for p in model.pieces:
        name = p.piece.replace("▁", " ").encode()
        if p.type == 1 and name and b" " not in name[1:]:
            weight[name] = weight.get(name, 0.0) + (math.exp(p.score) if logs else 1 / (2 - p.score))
    names = sorted(weight)
    return names, np.array([weight[n] for n in names])


class Lattices:
    """The segmentations of many words at once: a trie finds the arcs, positions are gone through together."""

    def __init__(self, names: list[bytes]) -> None:
        self.units = len(names)
        self.first = np.array([n[:1] == b" " for n in names])
        below: list[dict[int, int]] = [{}]
        ends = [-1]
        for unit, name in enumerate(names):
            at = 0
            for c in name:
                if c not in below[at]:
                    below[at][c] = len(below)
                    below.append({})
                    ends.append(-1)
                at = below[at][c]
            ends[at] = unit
        self._next = np.zeros((len(below), 256), dtype=np.int32)
        for at, links in enumerate(below):
            for c, to in links.items():
                self._next[at, c] = to
        self._ends = np.array(ends)

    def _arcs(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Node at which each word begins and ends; of each arc its word, its nodes, unit, and places of its ends in the word."""
        size = np.array([len(w) for w in words])
        edge = np.concatenate([[0], np.cumsum(size)])
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        stop = edge[word + 1]
        at, state, k = np.arange(len(text)), np.zeros(len(text), dtype=np.int32), 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            state = self._next[state, text[at + k]]
            k += 1
            unit = self._ends[state]
            whole = unit >= 0
            found.append((at[whole], at[whole] + k, unit[whole]))
            more = (state > 0) & (at + k < stop[at])
            at, state = at[more], state[more]
        a, z, unit = (np.concatenate([x[i] for x in found]) for i in range(3))
        w = word[a]
        begin = edge[:-1] + np.arange(len(words))
        return begin, begin + size, w, a + w, z + w, unit, a - edge[w], z - edge[w]

    @staticmethod
    def _rounds(place: np.ndarray, node: np.ndarray) -> Iterator[np.ndarray]:
        """Arcs in the order of a place, those of a place together, sorted by node."""
        order = np.lexsort((node, place))
        cut = np.flatnonzero(np.diff(place[order])) + 1
        yield from np.split(order, cut) if len(order) else []

    @staticmethod
    def _sum(value: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the sum of exponentials of each node's values."""
        cut = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1])
        top = np.maximum.reduceat(value, cut)
        n = np.diff(np.append(cut, len(value)))
        return node[cut], top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, n, axis=0)), cut))

    def log_likelihood(self, words: list[bytes], logs: np.ndarray) -> np.ndarray:
        """Forward recursion in log space: of each word, under each class, the probabilities of all its segmentations summed.

        ``logs`` (units x classes) are the units' weights; every byte must be a unit.
        """
        begin, end, _, a, z, unit, _, at = self._arcs(words)
        total = np.full((end[-1] + 1, logs.shape[1]), -np.inf)
        total[begin] = 0.0
        for arcs in self._rounds(at, z):
            node, value = self._sum(total[a[arcs]] + logs[unit[arcs]], z[arcs])
            total[node] = value
        return total[end]

    def expected(self, words: list[bytes], times: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """How often each unit is expected in the words' segmentations, a word ``times`` counted (words, one class)."""
        begin, end, word, a, z, unit, from_, to = self._arcs(words)
        ahead = np.full(end[-1] + 1, -np.inf)
        ahead[begin] = 0.0
        for arcs in self._rounds(to, z):
            node, value = self._sum(ahead[a[arcs]] + logs[unit[arcs]], z[arcs])
            ahead[node] = value
        behind = np.full(end[-1] + 1, -np.inf)
        behind[end] = 0.0
        for arcs in reversed(list(self._rounds(from_, a))):
            node, value = self._sum(behind[z[arcs]] + logs[unit[arcs]], a[arcs])
            behind[node] = value
        share = np.exp(ahead[a] + logs[unit] + behind[z] - ahead[end][word])
        return np.bincount(unit, share * times[word], self.units)


@lru_cache(maxsize=1)
def _lattices(path: str | None) -> Lattices:
    return Lattices(vocabulary(path)[0])


def _blocks(words: list[bytes]) -> Iterator[np.ndarray]:
    """Places of words of like length whose bytes fit in a layout together."""
    size = np.array([len(w) + 1 for w in words], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    block = np.cumsum(size[order]) // LATTICE_BYTES
    yield from np.split(order, np.flatnonzero(np.diff(block)) + 1) if len(order) else []


@dataclass
class LatticeModel:
    """Weights of units, a column per class, and what the corpus has: tokens, distinct tokens, and each class's documents, tokens and distinct words.

    A word's probability in a class is its own discounted share, as an arc over the whole word, plus what is left over,
    one occurrence more included, times the sum over its segmentations: a first unit that begins with a space, any others, and a stop.
    """

    logs: np.ndarray
    stop: np.ndarray
    tokens: int = 0
    distinct: int = 0
    documents: int = 0
    class_documents: list[int] = field(default_factory=lambda: [0])
    class_words: list[int] = field(default_factory=lambda: [0])
    class_distinct: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def of_counts(cls, counts: np.ndarray, stops: np.ndarray, first: np.ndarray) -> LatticeModel:
        """Weights from how often units and stops are expected: first units share one, the others and the stop another."""
        counts = counts + PRIOR
        inner = counts[~first].sum(axis=0) + stops + PRIOR
        return cls(np.log(counts / np.where(first[:, None], counts[first].sum(axis=0), inner)), np.log((stops + PRIOR) / inner))

    def word_scores(self, lattices: Lattices, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Base-10 logarithm of each word's probability, in each class; ``counts`` (words x classes) are its own."""
        out = np.empty((len(words), len(self.stop)))
        for at in _blocks(words):
            out[at] = lattices.log_likelihood([b" " + words[i] for i in at.tolist()], self.logs)
        out += self.stop
        for k, (docs, total, distinct) in enumerate(zip(self.class_documents, self.class_words, self.class_distinct, strict=True)):
            n = docs + total + 1
            with np.errstate(divide="ignore"):
                out[:, k] = np.logaddexp(np.log(np.maximum(counts[:, k] - DISCOUNT, 0.0) / n), np.log((DISCOUNT * distinct + 1) / n) + out[:, k])
        return out / math.log(10)

    def class_logs(self) -> list[tuple[float, float]]:
        """Base-10 logarithms of each class's share of documents, and of a document's end in it; with no document to learn from an end is sure."""
        if not self.documents:
            return [(0.0, 0.0)]
        return [(math.log10(d / self.documents) if d else -math.inf, math.log10(d / (d + w + 1)) if d else 0.0) for d, w in zip(self.class_documents, self.class_words, strict=True)]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_bags(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's distinct words, A-Z lower-cased, with how often each occurs, in place of its text. Map-only."""
    schema = StructType([*(f for f in df.schema if f.name != text_col), StructField("words", ArrayType(StringType())), StructField("times", ArrayType(LongType()))])
    at = df.columns.index(text_col)
    rest = [i for i in range(len(df.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("lattice", _lattices.cache_clear)
        for batch in batches:
            for part in by_bytes(batch):
                bags = [Counter((t or "").encode().lower().split()) for t in part.column(at).to_pylist()]
                edge = pa.array(np.cumsum([0, *map(len, bags)]), pa.int32())
                words = pa.array([w for b in bags for w in b], pa.binary()).cast(pa.string())
                times = pa.array([n for b in bags for n in b.values()], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in rest), pa.ListArray.from_arrays(edge, words), pa.ListArray.from_arrays(edge, times)], names=schema.names)

    return df.transform(in_arrow, run, schema)


def _expectations(words: DataFrame, model: LatticeModel, path: str | None) -> np.ndarray:
    """Expected occurrences of units (units x classes) over a table of words and their counts by class; the driver gets a row per unit."""
    classes = len(model.stop)
    names = [f"e{k}" for k in range(classes)]
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("lattice", _lattices.cache_clear)
        lattices = _lattices(path)
        total = np.zeros((lattices.units, classes))
        for batch in batches:
            for part in by_bytes(batch):
                spelled = [w.encode() for w in part.column(0).to_pylist()]
                counts = np.stack([part.column(1 + k).to_numpy() for k in range(classes)], axis=1).astype(np.float64)
                for k in range(classes):
                    seen = np.flatnonzero(counts[:, k] > 0).tolist()
                    pieces = [(piece, i) for i in seen for piece in _pieces(spelled[i])]
                    for at in _blocks([p for p, _ in pieces]):
                        own = [pieces[j] for j in at.tolist()]
                        total[:, k] += lattices.expected([p for p, _ in own], counts[[i for _, i in own], k], shared.value.logs[:, k])
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(total[used, k]) for k in range(classes))], names=["unit", *names])

    schema = StructType([StructField("unit", IntegerType()), *(StructField(c, DoubleType()) for c in names)])
    table = in_arrow(words, run, schema).groupBy("unit").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    shared.destroy()
    out = np.zeros((len(model.logs), classes))
    out[table["unit"].to_numpy()] = np.stack([table[c].to_numpy() for c in names], axis=1)
    return out


def _pieces(word: bytes) -> list[bytes]:
    """A word behind its space; a very long one in pieces, of which only the first has the space."""
    spaced = b" " + word
    return [spaced[at : at + LEARN_BYTES] for at in range(0, len(spaced), LEARN_BYTES)]


def learn(words: DataFrame, documents: list[int], path: str | None = None, rounds: int = ROUNDS) -> LatticeModel:
    """Fit the units' weights to a table of words with a column ``c0``, ``c1``, ... of occurrences per class; ``documents`` are those of each class.

    All words count, however long. A round is one pass over the distinct words: expected counts of units by
    forward and backward recursion, summed by unit. The first weights are the vocabulary's own.
    """
    classes = len(documents)
    names, weight = vocabulary(path)
    first = np.array([n[:1] == b" " for n in names])
    columns = [f"c{k}" for k in range(classes)]
    sums = [F.sum(c).cast("long").alias(f"n{c}") for c in columns] + [F.count(F.when(F.col(c) > 0, 1)).alias(f"d{c}") for c in columns]
    got = words.agg(*sums, F.count(F.when(sum((F.col(c) for c in columns), F.lit(0)) > 0, 1)).alias("distinct")).first()
    tokens, distinct = [got[f"n{c}"] or 0 for c in columns], [got[f"d{c}"] for c in columns]
    stops = np.array(tokens, dtype=np.float64)
    scale = max(1.0, stops.sum()) / weight[first].sum()
    model = LatticeModel.of_counts(np.repeat(weight[:, None] * scale, classes, axis=1), np.full(classes, weight[first].sum() * scale), first)
    for _ in range(rounds if sum(tokens) else 0):
        model = LatticeModel.of_counts(_expectations(words.select("word", *columns), model, path), stops, first)
    n = sum(documents)
    model.tokens, model.distinct, model.documents = sum(tokens) + n, got["distinct"] + (n > 0), n
    model.class_documents, model.class_words, model.class_distinct = documents, tokens, distinct
    return model


def _scored_words(words: DataFrame, model: LatticeModel, path: str | None) -> DataFrame:
    """``word``, ``n`` (occurrences in all rows), ``known``, ``base`` and ``s0``, ``s1``, ...: its logarithms under the counts and in each class."""
    classes = len(model.stop)
    columns, names = [f"c{k}" for k in range(classes)], [f"s{k}" for k in range(classes)]
    shared = words.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("word", StringType()), StructField("n", LongType()), StructField("known", BooleanType()), *(StructField(c, DoubleType()) for c in ("base", *names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("lattice", _lattices.cache_clear)
        for batch in batches:
            for part in by_bytes(batch):
                own = np.stack([part.column(2 + k).to_numpy() for k in range(classes)], axis=1)
                c = own.sum(axis=1)
                score = shared.value.word_scores(_lattices(path), [w.encode() for w in part.column(0).to_pylist()], own.astype(np.float64))
                base = np.log10((c + 1) / (shared.value.tokens + shared.value.distinct + 1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(c > 0), pa.array(base), *(pa.array(score[:, k]) for k in range(classes))], names=schema.names)

    return in_arrow(words.select("word", "n", *columns), run, schema)


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", path: str | None = None, train: Column | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Log10 probability of each row's whole text, learned from the rows that are not held out.

    Returns ``id_col``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens that training rows have),
    ``train_tokens``, ``base_score`` (word counts with one added) and ``score``. A text's probability is that of
    its words and its end in a class, averaged over classes by their share of training rows. Classes are the
    ``CLASSES`` commonest values of ``class_col`` in training rows and, as one, all others, null included; a scored
    row's own value is not used. Without such a column there is one class.

    One output row per input row; a null text counts as empty (an end alone), a null id is not held out, repeated rows
    count each, an empty table gives no row, other columns are not read. Without training rows the vocabulary's own
    weights score, and an end is sure.

    Texts are read once; word bags are written. Words are summed over all rows before they are joined back: those
    with ``HOT_SHARE`` of all tokens by broadcast (at most its inverse, of ``HOT_BYTES`` each), others by the word.
    """
    train = ~held_out(id_col) if train is None else train
    has = class_col is not None and class_col in df.columns
    docs = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), train.alias("__train"), (F.col(class_col).cast("string") if has else F.lit(None).cast("string")).alias("__class"))
    common = [r["__class"] for r in docs.filter("__train and __class is not null").groupBy("__class").count().orderBy(F.desc("count"), "__class").limit(CLASSES).collect()]
    place = F.lit(len(common))
    for k, value in enumerate(common):
        place = F.when(F.col("__class") == F.lit(value), k).otherwise(place)
    bags = word_bags(docs.withColumn("__class", place), "__id", "__text").withColumn("__row", F.monotonically_increasing_id())
    bags = stored(bags, "bags")
    sizes = {r["__class"]: r["n"] for r in bags.filter("__train").groupBy("__class").agg(F.count("*").alias("n")).collect()}
    used = [k for k in range(len(common) + 1) if k in sizes] or [0]
    documents = [sizes.get(k, 0) for k in used]
    each = bags.select("__row", "__train", "__class", F.explode(F.arrays_zip("words", "times")).alias("p")).select("__row", "__train", "__class", F.col("p.words").alias("word"), F.col("p.times").alias("n"))
    counts = (F.sum(F.when(F.col("__train") & (F.col("__class") == c), F.col("n")).otherwise(F.lit(0).cast("long"))).alias(f"c{k}") for k, c in enumerate(used))
    words = stored(each.groupBy("word").agg(F.sum("n").alias("n"), *counts), "words")
    model = learn(words, documents, path, rounds)
    scored = stored(_scored_words(words, model, path), "scored")
    total = scored.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.col("n") >= F.lit(total * HOT_SHARE) * F.ceil(F.greatest(F.octet_length("word"), F.lit(1)) / F.lit(HOT_BYTES))
    frequent = scored.filter(hot)
    mine = each.select("__row", "word", F.col("n").alias("times"))
    near = mine.join(F.broadcast(frequent), "word")
    far = mine.join(F.broadcast(frequent.select("word")), "word", "left_anti").hint("merge").join(scored.filter(~hot), "word")
    names = ["base", *(f"s{k}" for k in range(len(used)))]
    sums = near.unionByName(far).groupBy("__row").agg(F.sum(F.when(F.col("known"), F.col("times")).otherwise(F.lit(0).cast("long"))).alias("known"), *(F.sum(F.col("times") * F.col(c)).alias(c) for c in names))
    n = F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x)
    out = bags.select("__row", "__id", "__train", n.alias("n")).join(sums, "__row", "left").na.fill(0, ["known"]).na.fill(0.0, names)
    end = math.log10((model.documents + 1) / (model.tokens + model.distinct + 1))
    by_class = [F.col(f"s{k}") + F.lit(share + last) for k, (share, last) in enumerate(model.class_logs())]
    top = F.greatest(*by_class) if len(by_class) > 1 else by_class[0]
    score = F.col("__top") + F.log10(sum((F.pow(F.lit(10.0), F.least(c - F.col("__top"), F.lit(0.0))) for c in by_class[1:]), F.pow(F.lit(10.0), F.least(by_class[0] - F.col("__top"), F.lit(0.0)))))
    done = out.withColumn("__top", top).select(
        F.col("__id").alias(id_col), (~F.col("__train")).alias("held_out"), (F.col("n") + 1).alias("n_tokens"), (F.col("known") + int(model.documents > 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.lit(end)).alias("base_score"), score.alias("score"),
    )
    done = stored(done, "scores")
    discard(bags, words, scored)
    return done
