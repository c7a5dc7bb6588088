"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from strataflow.llm.arrow import exclusive, map_arrow

#: Bytes of segments that one call of the encoder gets.
ENCODE_BYTES = 1 << 20
#: Segments whose lengths a worker remembers, and the longest that it remembers.
MEMO_ENTRIES, MEMO_CHARS = 400_000, 48

#: The marker that the model writes for a space.
SPACE = "▁"
_GAP = re.compile(f"(?<=[^ {SPACE}]) ")


class SegmentCounter:
    """Lengths of a SentencePiece model's encodings.

    A text is cut before each space that follows neither a space nor a marker. That is safe when
    no piece of the vocabulary has a space marker behind another character, spaces are kept as
    they are and a marker is put before each text: no merge then spans the cut, and the marker
    that a later segment gets as a text of its own stands for the space the cut removed. The
    constructor checks this; a model without it is asked for whole texts.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = spec.ModelProto()
        proto.ParseFromString(self._model.serialized_model_proto())
        n = proto.normalizer_spec
        self.safe = (
            n.add_dummy_prefix
            and n.escape_whitespaces
            and not n.remove_extra_whitespaces
            and n.name == "identity"
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in proto.pieces)
            and not any(p.type == 4 for p in proto.pieces)
        )
        self._lone = len(self._model.encode("a ")) - len(self._model.encode("a")) if self.safe else 0
        self._memo: dict[str, int] = {}

    def _lengths(self, texts: list[str]) -> Iterator[int]:
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts):
                more = len(texts[end]) if texts[end].isascii() else len(texts[end].encode())
                if end > at and size + more > ENCODE_BYTES:
                    break
                size += more + 1
                end += 1
            yield from map(len, self._model.encode(texts[at:end], num_threads=1))
            at = end

    def count(self, texts: list[str]) -> list[int]:
        """Length of each text's encoding."""
        if not self.safe:
            return list(self._lengths(texts))
        cut = [_GAP.split(t) if "  " in t or SPACE in t or t[:1] == " " else t.split(" ") for t in texts]
        memo = self._memo
        new = list({s for segments in cut for s in segments if s not in memo})
        extra = dict(zip(new, self._lengths(new), strict=True))
        extra[""] = self._lone
        kept = [s for s in new if s and len(s) <= MEMO_CHARS][: max(0, MEMO_ENTRIES - len(memo))]
        memo.update((s, extra.pop(s)) for s in kept)
        return [sum(memo[s] if s in memo else extra[s] for s in segments) if t else 0 for t, segments in zip(texts, cut, strict=True)]


@lru_cache(maxsize=4)
def _counter(path: str | None) -> SegmentCounter:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return SegmentCounter(path)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """Bytes and tokens of each row's whole text.

    Returns ``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens),
    one row per input row; repeated rows stay. A null text counts as empty: 0 and 0, a null id
    stays null, other columns are not read, and an empty table gives an empty result.

    ``model_path`` is a SentencePiece model, by default the public 32k one, looked up on each
    worker. Only lengths leave the workers. Map-only: no shuffle, memory bounded by a batch.
    """
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        exclusive("token counts", _counter.cache_clear)
        texts = [x or "" for x in batch.column(1).to_pylist()]
        n = np.array(_counter(model_path).count(texts), dtype=np.int64)
        size = np.array([len(t.encode()) for t in texts], dtype=np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=schema.names)

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), count, schema)
