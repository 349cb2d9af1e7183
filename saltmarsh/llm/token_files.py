"""Token ids of a documents table in files, ascending by document, and the way back."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import byte_letters
from .rans import Reader, write_file
from .shared import ship, stored
from .word_table import WordTable

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
FILE_CHARS = 8_000_000
#: tokens a task reads, in whole files; rows about files that are stored together
TASK_TOKENS, LIST_ROWS = 3_000_000, 10_000

_libraries: dict[str, WordTable] = {}


def library(vocabulary: str) -> WordTable:
    """The tokenizers library behind a table of the words it has encoded.

    Its pattern cuts words without looking across them, so a text's ids are those of its words; the
    library's model encodes each word it has not met.
    """
    if vocabulary not in _libraries:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        special = {str(a.content): i for i, a in t.get_added_tokens_decoder().items()}
        letters = {b: c for c, b in byte_letters().items()}
        tokenize = t.model.tokenize

        def encode(raw: bytes, ends: list[int]) -> list[list[int]]:
            named = raw.decode("latin-1").translate(letters)
            return [[k.id for k in tokenize(named[i:j])] for i, j in zip([0, *ends], ends)]

        _libraries[vocabulary] = WordTable(encode, special)
    return _libraries[vocabulary]


def open_file(uri: str, write: bool = False):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    if write:
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_file(path)


def plain_uri(path: str) -> str:
    return "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path


def write_tokens(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 file_chars: int = FILE_CHARS) -> DataFrame:
    """Encode and write; rows (part, path, docs, tokens), one per file, parts ascending by doc_id.

    Rows are dealt to files by ranges of doc_id, about ``file_chars`` characters each, and sorted inside
    by doc_id and text; null ids come first. A file is written by one task under a name of its own try,
    and the stored rows name the tries that count, so a repeated task does no harm. Null texts are empty
    documents: the end id alone. ``folder`` defaults to a new one below the shared folder.
    """
    spark = docs.sparkSession
    ship(spark)
    target = plain_uri(folder or scratch_path(spark, "tokens"))
    chars = docs.agg(F.sum(F.length(docs["text"]).cast("long"))).first()[0] or 0
    n = max(1, math.ceil(chars / file_chars))
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        words = library(vocabulary)
        ids, doc_ids, sizes = [], [], []
        for batch in batches:
            got, n = words.encode_texts([t or "" for t in batch.column("text").to_pylist()])
            ids.append(np.insert(got, np.cumsum(n), np.uint32(end_id)))
            doc_ids += batch.column("doc_id").to_pylist()
            sizes += (n + 1).tolist()
        if doc_ids:
            part = TaskContext.get().partitionId()
            path = f"{target}/part-{part:06d}-{uuid.uuid4().hex}.rans"
            with open_file(path, write=True) as f:
                write_file(f, np.concatenate(ids), doc_ids, sizes)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "path": [path], "docs": pa.array([len(sizes)], pa.int64()), "tokens": pa.array([sum(sizes)], pa.int64())})

    # one row per file: a table of as many files as the tokens have would cost more than the rows
    listed = dealt.mapInArrow(run, "part long, path string, docs long, tokens long").repartition(math.ceil(n / LIST_ROWS))
    return stored(listed, "token-files")


def read_tokens(files: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) decoded from the files that ``write_tokens`` named."""
    ship(files.sparkSession)
    # one row per file
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("before", F.coalesce(before, F.lit(0)))
    n_files, tokens = files.agg(F.count("*"), F.sum("tokens")).first()
    n = max(1, min(n_files, math.ceil((tokens or 0) / TASK_TOKENS)))

    def run(batches):
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with open_file(path) as f:
                    found = list(Reader(f).documents())
                sizes = np.array([s for _, s, _ in found], np.int64)
                start = before + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _, _ in found], pa.int64()), pa.array(start), pa.array(sizes), pa.array([c for _, _, c in found], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("path", "before").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return read_tokens(write_tokens(docs, vocabulary=vocabulary))
