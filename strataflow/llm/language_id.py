"""Language identification by string kernels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strataflow.llm.arrow import exclusive, filter_arrow, fitted, map_arrow
from strataflow.llm.scratch import settle

#: n of the n-grams whose presence the kernel blends; bits of the table they are hashed to.
GRAMS, BITS = (1, 2, 3), 14
#: Bounds of the sample that a model is fitted on: rows of a language at most and at least, rows of all languages from which on each gets fewer, characters of a row.
PER_LANGUAGE, LEAST_PER_LANGUAGE, MAX_ROWS, MAX_CHARS = 300, 8, 60_000, 20_000
#: Characters of the blocks in which every text is learned from and scored.
BLOCK_CHARS = 4096
#: Landmarks of a language at most, of all languages from which on each gets fewer (one at least); ridge; blocks of text scored by one matrix product.
LANDMARKS, MAX_LANDMARKS, RIDGE, BLOCK = 32, 2048, 1e-2, 128
UNDETERMINED = "und"
#: Score under which a text is too far from every learned language to be kept by ``keep_identified``.
LEAST_SCORE = 0.35


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


_TABLE: list[np.ndarray] = []


def presence(text: str) -> np.ndarray | None:
    """Sorted table places of the n-grams in ``text``; None without a letter.

    Letters are lower-cased; every run of other characters counts as one space.
    """
    if not _TABLE:
        _TABLE.append(_letters())
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = _TABLE[0][code]
    if not code.any():
        return None
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
    seen = np.zeros(1 << BITS, dtype=bool)
    for n in GRAMS:
        h = np.full(max(0, len(code) - n + 1), n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h = (h ^ code[k : len(h) + k]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        seen[h >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen)


def text_blocks(text: str) -> list[str]:
    """A text in equal blocks of ``BLOCK_CHARS`` characters at most; neighbours overlap, so that no n-gram is lost at a cut."""
    n = -(-len(text) // BLOCK_CHARS)
    cut = [len(text) * k // n for k in range(n + 1)] if n else []
    reach = max(GRAMS) - 1
    return [text[max(0, a - reach) : b + reach] for a, b in zip(cut, cut[1:], strict=False)]


@dataclass
class KernelModel:
    """One-versus-rest kernel ridge regression on Nyström features.

    The kernel of two texts is the number of n-grams that both have, over the root of the product
    of the numbers that each has. ``landmarks`` (places x landmarks) gives a block's kernel rows by
    one matrix product, ``weights`` (landmarks x languages) the margins by another.
    """

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def margins(self, grams: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(grams), len(self.languages)), dtype=np.float32)
        for at in range(0, len(grams), BLOCK):
            block = grams[at : at + BLOCK]
            x = np.zeros((len(block), 1 << BITS), dtype=np.float32)
            for i, g in enumerate(block):
                x[i, g] = 1 / np.sqrt(len(g))
            out[at : at + BLOCK] = x @ self.landmarks @ self.weights
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without a letter.

        A text of any length has the mean margins of its blocks with a letter, which are of one size in it.
        """
        exclusive("language ID")
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return lang, score
        total, blocks = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        grams: list[np.ndarray] = []
        owner: list[int] = []

        def add() -> None:
            np.add.at(total, owner, self.margins(grams))
            np.add.at(blocks, owner, 1)
            grams.clear()
            owner.clear()

        for i, t in enumerate(texts):
            for block in text_blocks(t):
                g = presence(block)
                if g is not None:
                    grams.append(g)
                    owner.append(i)
                if len(grams) == BLOCK:
                    add()
        if grams:
            add()
        for i in np.flatnonzero(blocks).tolist():
            row = total[i] / blocks[i]
            b = int(row.argmax())
            lang[i], score[i] = self.languages[b], min(1.0, max(0.0, (float(row[b]) + 1) / 2))
        return lang, score


def fit(texts: list[str], langs: list[str], landmarks_per_language: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """Fit on the blocks of labelled texts, in an order that does not matter; blocks without letters are left out. A text's blocks weigh as much as one."""
    rows = sorted((lang, t) for t, lang in zip(texts, langs, strict=True))
    grams, weight = [], []
    for lang, t in rows:
        own = [g for block in text_blocks(t) if (g := presence(block)) is not None]
        grams += [(lang, g) for g in own]
        weight += [1 / max(1, len(own))] * len(own)
    names = sorted({lang for lang, _ in grams})
    if not names:
        return KernelModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0), np.float32))
    landmarks_per_language = max(1, min(landmarks_per_language, MAX_LANDMARKS // len(names)))
    rng = np.random.default_rng(0)
    marks = []
    for name in names:
        own = [g for lang, g in grams if lang == name]
        marks += [own[i] for i in rng.permutation(len(own))[:landmarks_per_language]]
    z = np.zeros((1 << BITS, len(marks)), dtype=np.float64)
    for j, g in enumerate(marks):
        z[g, j] = 1 / np.sqrt(len(g))
    k_mm = z.T @ z
    value, vector = np.linalg.eigh(k_mm)
    keep = value > 1e-8
    root = vector[:, keep] / np.sqrt(value[keep])  # k_mm to the power -1/2
    k_nm = np.array([z[g].sum(axis=0) / np.sqrt(len(g)) for _, g in grams])
    phi = k_nm @ root
    y = np.array([[1.0 if lang == name else -1.0 for name in names] for lang, _ in grams])
    share = {name: sum(w for (lang, _), w in zip(grams, weight, strict=True) if lang == name) for name in names}
    w = np.array([x / share[lang] for (lang, _), x in zip(grams, weight, strict=True)])[:, None]
    a = phi.T @ (phi * w) + ridge * np.eye(phi.shape[1]) / sum(weight)
    beta = np.linalg.solve(a, phi.T @ (y * w))
    return KernelModel(names, z.astype(np.float32), (root @ beta).astype(np.float32))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def candidates(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``l``, ``h`` (a hash of id and text) and ``most``: at least as many distinct rows of each language as are wanted, and not many more.

    How many different rows a language has is estimated by a sketch, and a share of the hashes that is twice what is
    wanted of them passes: what a language sends on is bounded by that, not by the number of tasks. Copies pass as one.
    """
    rows = df.select(F.col(lang_col).alias("l"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.length(text_col).alias("n"), train.alias("ok")).filter("ok and l is not null")
    sizes = rows.groupBy("l").agg(F.approx_count_distinct(F.when(F.col("n") <= max_chars, F.col("h"))).alias("size"))
    languages = sizes.count()
    most = max(LEAST_PER_LANGUAGE, min(per_language, max_rows // max(1, languages)))
    share = F.least(F.lit(1.0), F.lit(2.0 * most + 20) / F.greatest("size", F.lit(1)))
    tops = sizes.select("l", (share * (1 << 53)).cast("long").alias("top"))
    passing = rows.filter(F.col("n") <= max_chars).join(F.broadcast(tops) if languages <= MAX_ROWS else tops, "l").filter(F.shiftrightunsigned("h", 11) < F.col("top"))
    return passing.select("l", "h").distinct().withColumn("most", F.lit(most))


def training_sample(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Whole texts and languages of at most ``per_language`` different rows of each language, every language among them.

    Rows are taken in the order of a hash of their id and text; with over ``max_rows / per_language`` languages
    each has fewer, down to ``LEAST_PER_LANGUAGE``. Rows with over ``max_chars`` characters are not used.
    """
    few = candidates(df, train, id_col, text_col, lang_col, per_language, max_rows, max_chars)
    chosen = few.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h"))).filter("r <= most").select("l", "h")
    rows = df.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), train.alias("ok")).filter("ok and l is not null").filter(F.length("t") <= max_chars)
    return rows.join(F.broadcast(chosen), ["l", "h"]).groupBy("l", "h").agg(F.first("t").alias("t")).select("t", "l")


def identify(df: DataFrame, model: KernelModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` (0 to 1) of each row's whole text.

    A null text, or one without a letter, is ``und`` with score 0. Null ids and repeated rows stay,
    other columns are not read. Map-only; the model is a few megabytes whatever the corpus.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = shared.value.predict([x or "" for x in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), run, schema)


def keep_identified(df: DataFrame, model: KernelModel, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows whose text has a language, with a score of at least ``least_score``; all columns as they are.

    Null texts and texts without a letter go. A model that has learned no language keeps nothing. Map-only.
    """
    settle(df.sparkSession)  # what the fit has left
    shared = df.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list[str]) -> list[bool]:
        lang, score = shared.value.predict(texts)
        return [x != UNDETERMINED and s >= least_score for x, s in zip(lang, score.tolist(), strict=True)]

    return filter_arrow(df, text_col, keep)


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> KernelModel:
    """Fit on the rows that are not held out (crc32 of the id as text, mod 4, is not 2)."""
    return fitted(training_sample(df, ~held_out(id_col), id_col, text_col, lang_col), fit)
