"""Token counts of whole texts under a sentence-piece BPE vocabulary, without building the tokens."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, map_batches, per_process, text_or_empty

MARK = "▁"  # how the library writes a blank
# Unseen pre-tokens kept per worker process; longer ones are merged each time they come.
CACHE_ENTRIES, CACHE_LENGTH = 400_000, 48


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def whole_tokens(model: bytes) -> list[str]:
    """Offline proof: vocabulary strings that, read as a pre-token, encode alone as exactly their own id.

    Each string that starts with a blank mark is encoded on its own; only those that give their one id
    are returned, without that mark. Raises when the vocabulary does not allow the split that
    ``count_tokens`` relies on: a string with a blank mark after another character could be merged
    across two pre-tokens, and a normaliser that rewrites text would make pre-tokens depend on context.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    spec = proto.normalizer_spec
    plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
    if not plain or proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("needs a BPE model with a leading blank and no normalisation")
    if any(p.type == 4 or re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces):
        raise ValueError("the vocabulary joins words across a blank")
    sp = _processor(model)
    texts = [(i, p.piece[1:]) for i, p in enumerate(proto.pieces) if p.type == 1 and p.piece.startswith(MARK)]
    ids = sp.encode([t.replace(MARK, " ") for _, t in texts], num_threads=1)
    found = [t for (i, t), got in zip(texts, ids) if got == [i]]
    # the lone mark cannot be encoded by itself (an empty text has no tokens); a doubled blank shows it
    lone = sp.piece_to_id(MARK)
    if MARK not in (p.piece for p in proto.pieces) or sp.encode("a ", num_threads=1)[-1] != lone:
        raise ValueError("the blank is no token of its own")
    return sorted({*found, ""})


class Counter(dict):
    """Tokens per pre-token (without its first blank mark); merges what the offline table lacks."""

    def __init__(self, model: bytes, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.sp = whole, _processor(model)

    def __missing__(self, word: str) -> int:
        n = len(self.sp.encode(word.replace(MARK, " "), num_threads=1))
        if len(word) <= CACHE_LENGTH:
            if len(self) > CACHE_ENTRIES + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[word] = n
        return n

    def count(self, text: str) -> int:
        """Pre-tokens start at each blank that follows another character; runs of blanks stay together."""
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        words = text.split(" ")
        if "" in words:
            words = [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        return sum(map(self.__getitem__, words))


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """Per row ``(id, n_bytes, n_tokens, over_limit)``, equal to the library's encoding without extra tokens.

    Null and empty texts have 0 bytes and 0 tokens; ids pass through as they are, null or repeated; no
    rows give no rows. The whole text counts, whatever its length. The model file is read by the driver
    and sent with the proven table (both bounded by the vocabulary), so executors need no copy of it.
    One pass over two columns, no shuffle.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    sent = spark.sparkContext.broadcast((model, whole_tokens(model)))
    key = ("token_counts", hashlib.sha256(model).hexdigest())
    rows = docs.select(
        cell(id_col).alias("id"), F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"), text_or_empty(text_col).alias("t")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_process(key, lambda: Counter(*sent.value))
        for b in batches:
            n = [counter.count(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return map_batches(rows, counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
