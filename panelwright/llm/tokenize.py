"""Encoding of a corpus with a public byte-level tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import bpe, vocabulary


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = vocabulary.DEFAULT_FOLDER, name: str = vocabulary.DEFAULT_NAME) -> DataFrame:
    """``key`` and ``ids`` (list of int) of every row, whole texts, without special tokens.

    Strings that look like special tokens are plain text.  Null and empty text give an empty
    list; repeated rows and null keys are kept as they are.  The plan is one map over Arrow
    batches of the two columns: no shuffle, nothing on the driver; a batch is worked off in
    runs of a few megabytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = vocabulary.load(folder, name)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i, flat, per_text, _ in bpe.encode_texts(texts, rules):
                offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(i, len(per_text)), ids], names=["key", "ids"])

    kind = documents.schema[key].dataType.simpleString()
    out = documents.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def sizes(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = vocabulary.DEFAULT_FOLDER, name: str = vocabulary.DEFAULT_NAME) -> DataFrame:
    """``key``, ``n_tokens`` and ``n_head``: tokens before the body of a text with a header block.

    A header block starts the text (``Name: value``) and ends at the first blank line, whose
    line ends may be LF or CRLF.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = vocabulary.load(folder, name)
        for batch in batches:
            body = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, _, per_text, ahead in bpe.encode_texts(batch.column(1), rules, body):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(per_text)), pa.array(per_text.astype(np.int64)), pa.array(ahead.astype(np.int64))], names=["key", "n_tokens", "n_head"])

    kind = documents.schema[key].dataType.simpleString()
    head = F.coalesce(F.length(F.regexp_extract(F.col(text), r"(?s)\A[A-Za-z][A-Za-z0-9-]*:[ \t].*?\r?\n\r?\n", 0)), F.lit(0))
    out = documents.select(key, text, head.cast("int").alias("body")).mapInArrow(run, f"key {kind}, n_tokens bigint, n_head bigint")
    return out.withColumnRenamed("key", key)
