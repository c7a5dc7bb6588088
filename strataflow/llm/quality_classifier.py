"""Quality classifier: random-indexing word vectors pooled per document, then a small numpy network."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from strataflow.llm.arrow import exclusive, filter_arrow, fitted, map_arrow
from strataflow.llm.scratch import settle

#: Size of a vector, non-zero places of an index vector, words on each side that make a context.
DIM, NONZERO, WINDOW = 96, 6, 2
#: Bounds of the sample a model is fitted on: labelled rows, characters of a row. A word has a learned vector from this share of the sample's words on, so that no more than its inverse have one.
MAX_ROWS, MAX_CHARS, LEAST_SHARE = 4000, 20_000, 1 / 300_000
#: The network: hidden units, passes over the sample, step, weight decay, share kept for the temperature.
HIDDEN, EPOCHS, STEP, DECAY, CALIBRATION = 24, 60, 3e-3, 1e-4, 0.2
#: Vectors that a worker remembers, and the longest word that it remembers; words whose vectors are looked at together.
MEMO_ENTRIES, MEMO_CHARS, BLOCK = 80_000, 48, 1 << 13
#: Score from which a document counts as good.
THRESHOLD = 0.3
#: What a text is pooled to: the mean of its words' vectors and their spread about it, place by place.
WIDTH = 2 * DIM

#: Letter runs, digit runs and runs of other characters are the words.
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
CASES = ("a:", "Aa:", "A:", "")


def spelled(word: str) -> str:
    """Name of a word: letters lower-cased behind a mark of their case, digits as one sign, others as they are."""
    if word[0].isalpha():
        return ("A:" if len(word) > 1 and word.isupper() else "Aa:" if word[0].isupper() else "a:") + word.lower()
    return "0" if word[0].isdigit() else word


def case_of(name: str) -> int:
    """Place in ``CASES``; the last for what is no letters."""
    return CASES.index(name[: name.find(":") + 1]) if name[0] in "aA" and ":" in name else len(CASES) - 1


def index_vectors(names: list[str]) -> np.ndarray:
    """The fixed sparse index vector of each word: +1 or -1 in a few places that its digest names, to unit length."""
    n = len(names)
    at, sign = _places(names)
    return np.bincount((np.arange(n)[:, None] * DIM + at).ravel(), sign.ravel(), n * DIM).reshape(n, DIM) / np.sqrt(NONZERO)


def _places(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in names]), dtype=">u2").reshape(len(names), 8).astype(np.int64)
    return h[:, :NONZERO] % DIM, np.where(h[:, 7:] >> np.arange(NONZERO) & 1, 1.0, -1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class QualityModel:
    """Word vectors and network; ``score`` is the calibrated probability of label 1.

    ``names`` have the rows of ``vectors``; any other word has its index vector and the mean context of
    the words of its case, ``cases``. ``centre`` is taken from both kinds, which then have unit length.
    """

    names: list[str]
    vectors: np.ndarray
    cases: np.ndarray
    centre: np.ndarray
    mean: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WIDTH))
    w1: np.ndarray = field(default_factory=lambda: np.zeros((WIDTH, HIDDEN)))
    b1: np.ndarray = field(default_factory=lambda: np.zeros(HIDDEN))
    w2: np.ndarray = field(default_factory=lambda: np.zeros(HIDDEN))
    b2: float = 0.0
    temperature: float = 1.0

    def __post_init__(self) -> None:
        self._place = {w: i for i, w in enumerate(self.names)}
        self._seen: dict[str, int] = {}
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.__post_init__()

    def word_vectors(self, words: list[str]) -> np.ndarray:
        """Unit vector of each word as it is written."""
        names = [spelled(w) for w in words]
        at = np.array([self._place.get(n, -1) for n in names], dtype=np.int64)
        out = np.empty((len(words), DIM), dtype=np.float32)
        known = at >= 0
        out[known] = self.vectors[at[known]]
        if not known.all():
            new = [n for n, k in zip(names, known.tolist(), strict=True) if not k]
            out[~known] = _unit(_unit(index_vectors(new) + self.cases[[case_of(n) for n in new]]) - self.centre)
        return out

    def _rows(self, words: list[str]) -> np.ndarray:
        """Vectors of words in a row, from a bounded table that a worker fills as it goes."""
        if self._table is None:
            self._table = np.zeros((MEMO_ENTRIES, DIM), dtype=np.float32)
        seen, table = self._seen, self._table
        at = np.fromiter(map(seen.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        out = table[at]
        if len(missing):
            new: dict[str, int] = {}
            where = [new.setdefault(words[i], len(new)) for i in missing.tolist()]
            made = self.word_vectors(list(new))
            out[missing] = made[where]
            keep = [(w, i) for w, i in new.items() if len(w) <= MEMO_CHARS][: MEMO_ENTRIES - len(seen)]
            if keep:
                base = len(seen)
                table[base : base + len(keep)] = made[[i for _, i in keep]]
                seen.update({w: base + k for k, (w, _) in enumerate(keep)})
        return out

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean and standard deviation of the vectors of all words of each text; zeros without a word.

        Long texts are gone through in blocks, short ones share them.
        """
        lists = [_WORD.findall(t) for t in texts]
        n = np.array([len(x) for x in lists], dtype=np.int64)
        words = list(chain.from_iterable(lists))
        total, squares = np.zeros((len(texts), DIM)), np.zeros((len(texts), DIM))
        doc = np.repeat(np.arange(len(texts)), n)
        for at in range(0, len(words), BLOCK):
            rows = self._rows(words[at : at + BLOCK]).astype(np.float64)
            here = doc[at : at + BLOCK]
            cuts = np.concatenate([[0], np.flatnonzero(here[1:] != here[:-1]) + 1])
            total[here[cuts]] += np.add.reduceat(rows, cuts, axis=0)
            squares[here[cuts]] += np.add.reduceat(rows * rows, cuts, axis=0)
        mean = total / np.maximum(n, 1)[:, None]
        return np.hstack([mean, np.sqrt(np.maximum(squares / np.maximum(n, 1)[:, None] - mean * mean, 0.0))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, texts: list[str]) -> np.ndarray:
        exclusive("quality classifier", self._forget)
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.pooled(texts)) / self.temperature, -30, 30)))

    def _forget(self) -> None:
        self._seen, self._table = {}, None


def word_model(texts: list[str], least_share: float = LEAST_SHARE) -> QualityModel:
    """Random indexing: each word's own index vector plus those of its contexts, nearer ones with more weight, to unit length.

    The network is left blank.
    """
    written: dict[str, int] = {}  # each word as it is written, and its place in what follows
    lists = [np.fromiter((written.setdefault(w, len(written)) for w in _WORD.findall(t)), np.int32) for t in texts]
    called = [spelled(w) for w in written]
    count: Counter = Counter()
    for w, c in zip(called, np.bincount(np.concatenate(lists), minlength=len(written)).tolist() if lists else [], strict=True):
        count[w] += c
    least = max(2, least_share * count.total())
    names = sorted(w for w, c in count.items() if c >= least)
    n = len(names)
    place = {w: i for i, w in enumerate(names)}
    spots, signs = _places(names)

    def summed(at: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount((at[:, None] * DIM + spots[of]).ravel(), signs[of].ravel(), n * DIM).reshape(n, DIM)

    context = np.zeros((n, DIM))
    known = np.array([place.get(w, -1) for w in called], dtype=np.int32)
    gap = np.full(WINDOW, -1, dtype=np.int32)
    flat = np.concatenate([x for ws in lists for x in (known[ws], gap)]) if lists else gap
    for d in range(1, WINDOW + 1):
        for at in range(0, len(flat) - d, 1 << 18):
            left, right = flat[at : at + (1 << 18)][: len(flat) - d - at], flat[at + d : at + d + (1 << 18)]
            both = (left >= 0) & (right >= 0)
            context += (summed(left[both], right[both]) + summed(right[both], left[both])) / d
    context = _unit(context)
    vectors = _unit(index_vectors(names) + context) if n else np.zeros((0, DIM))
    case = np.array([case_of(w) for w in names], dtype=np.int64)
    cases = np.array([context[case == k].mean(axis=0) if (case == k).any() else np.zeros(DIM) for k in range(len(CASES))])
    share = np.array([count[w] for w in names], dtype=np.float64)
    centre = share @ vectors / share.sum() if n else np.zeros(DIM)
    return QualityModel(names, _unit(vectors - centre).astype(np.float32), cases, centre)


def fit(texts: list[str], labels: list[int], seed: int = 0) -> QualityModel:
    """Fit on labelled texts. Without both labels in the sample every score is the share of label 1 (0.5 without a row)."""
    rows = sorted(zip(texts, labels, strict=True))
    texts, y = [t for t, _ in rows], np.array([b for _, b in rows], dtype=np.float64)
    model = word_model(texts)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        model.b2 = float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else 8 * (share - 0.5) * 2, -8, 8))
        return model
    x = np.concatenate([model.pooled(texts[at : at + 64]) for at in range(0, len(texts), 64)])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[: max(1, int(CALIBRATION * len(y)))], order[max(1, int(CALIBRATION * len(y))) :]
    model.mean, model.scale = mean, scale
    _train(model, z[used], y[used], rng)
    calibrated = temperature(model.logits(x[held]), y[held])
    _train(model, z, y, rng)
    model.temperature = calibrated
    return model


def _train(model: QualityModel, z: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
    """Set the network's weights by gradient steps over scaled rows."""
    theta = [rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m1, m2 = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            h = np.tanh(z[at] @ theta[0] + theta[1])
            d = (1 / (1 + np.exp(-np.clip(h @ theta[2] + theta[3], -30, 30))) - y[at]) / max(1, len(at))
            back = d[:, None] * theta[2] * (1 - h * h)
            grads = [z[at].T @ back + DECAY * theta[0], back.sum(axis=0), h.T @ d + DECAY * theta[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                theta[k] = theta[k] - STEP * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = theta[0], theta[1], theta[2], float(theta[3][0])


def temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """What logits are divided by so that they say the labels' chances best, without a bound.

    The loss is convex in the inverse; its slope is halved to its root. Labels count as (n + 1) / (n + 2), as in Platt's scaling,
    so that logits that part them without an error have a root too. Logits that say the contrary are left as they are.
    """
    ones, zeros = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))

    def slope(inverse: float) -> float:
        return float(((1 / (1 + np.exp(-np.clip(inverse * logit, -700, 700))) - target) * logit).sum())

    if slope(0.0) >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while slope(high) < 0:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) < 0 else (low, middle)
    return 1 / high


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Whole texts and labels of at most ``max_rows`` labelled rows that are not held out, by a hash of their id.

    Rows without a label or a text, with labels that contradict each other, and those of over ``max_chars`` characters, are not used;
    of several texts of one id one is.
    """
    y = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & ~held_out("i"))
    y = y.groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").select("i", "y", F.xxhash64("i").alias("h"))
    n = y.count()
    if n > 2 * max_rows:  # only what is about to be chosen is ordered, whatever the number of labels
        y = y.filter(F.shiftrightunsigned("h", 11) < int(2 * max_rows / n * (1 << 53)))
    y = y.orderBy("h", "i").limit(max_rows).drop("h")
    x = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(F.length("t") <= max_chars)
    return x.join(F.broadcast(y), "i").groupBy("i").agg(F.min_by("t", F.xxhash64("t")).alias("t"), F.first("y").alias("y")).select("t", "y")


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Fit on the labelled rows whose crc32 of the id as text, mod 5, is not 0."""
    return fitted(training_sample(df, labels, id_col, text_col, label_col), fit)


def classify(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of each row's whole text.

    Null and empty texts are scored like a text without words. Null ids and repeated rows stay,
    other columns are not read. Map-only; the model is a few megabytes whatever the corpus.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.score([x or "" for x in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(np.where(score >= threshold, 1, 0), pa.int32())], names=schema.names)

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), run, schema)


def keep_good(df: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose whole text scores at least ``threshold``; all columns as they are. Null texts are scored like empty ones. Map-only."""
    settle(df.sparkSession)  # what the fit has left
    shared = df.sparkSession.sparkContext.broadcast(model)
    return filter_arrow(df, text_col, lambda texts: (shared.value.score(texts) >= threshold).tolist())
