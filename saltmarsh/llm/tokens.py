"""BPE encoding and decoding of a documents table."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import encode, load
from .shared import ship

VOCABULARY = "byte_bpe_50k.json"


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep_ids`` also ids and decoded.

    A null text counts as empty and has no ids. Strings of special tokens in a text become their ids.
    ``ids_sha256`` covers the decimal ids joined by commas, ``decoded_sha256`` the text decoded from the
    ids. No row moves between tasks.
    """
    ship(docs.sparkSession)
    some = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    schema = T.StructType([T.StructField("doc_id", some.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches):
        v, known = load(public_tokenizers.path(vocabulary))
        for batch in batches:
            counts, shas, decoded_shas, kept, texts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                raw, decimals = encode(text or "", v.special, known)
                ids = np.frombuffer(raw, "<u4")
                decoded = v.decode(ids).decode("utf-8", "replace")
                counts.append(len(ids))
                shas.append(hashlib.sha256(memoryview(decimals)[:-1] if decimals else b"").hexdigest())
                decoded_shas.append(hashlib.sha256(decoded.encode()).hexdigest())
                if keep_ids:
                    kept.append(ids.astype(np.int32))
                    texts.append(decoded)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded_shas, pa.string())]
            if keep_ids:
                columns += [pa.array(kept, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return some.mapInArrow(run, schema)
