"""BPE, token files and quality against the library, plain versions and held-out labels."""

import hashlib
import io
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from saltmarsh.llm import bpe, quality, rans, token_files, tokens, word_table
from saltmarsh.sources.tables import table

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def own(text):
    v, known = bpe.load(FILE)
    return np.frombuffer(bpe.encode(text, v.special, known)[0], "<u4").tolist()


def test_every_code_point_has_the_class_of_the_librarys_splitter():
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    every = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    kinds = bpe.classes()
    for known, kind in (("a", bpe.LETTER), ("1", bpe.NUMBER), ("!", bpe.OTHER)):
        for at in range(0, len(every), 100_000):
            some = every[at:at + 100_000]
            starts = {i for _, (i, _) in split("".join(known + chr(c) + "\n" for c in some))}
            assert [c for k, c in enumerate(some) if (3 * k + 1 not in starts) != (kinds[c] == kind)] == []


def test_classes_are_asked_for_when_met(monkeypatch):
    monkeypatch.setattr(bpe, "_classes", np.append(np.full(0x110000, bpe.OTHER, np.uint8), np.uint8(bpe.APART)))
    monkeypatch.setattr(bpe, "_asked", np.arange((0x110000 >> bpe.RANGE_BITS) + 1) == 0x110000 >> bpe.RANGE_BITS)
    assert bpe.words_of("It's 日本 x２") == ["It", "'s", " 日本", " x", "２"]
    # the last range is that of the mark
    assert np.flatnonzero(bpe._asked).tolist() == [0, 0x65E5 >> 12, 0xFF12 >> 12, 0x110000 >> 12]


def test_a_worker_stays_small_while_it_encodes():
    code = """
import random, resource
import numpy as np
import public_tokenizers
from saltmarsh.llm import bpe, text
v, known = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
r = random.Random(3)
for _ in range(60):
    some = " ".join("".join(r.choices("abcdefghij", k=8)) for _ in range(5000))
    bpe.encode(some, v.special, known)
    text.word_hashes(some.encode())
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, check=True)
    assert int(out.stdout) < 110  # MB


def test_word_table_hands_over_new_words_together(library):
    calls = []
    t = token_files.library("byte_bpe_50k.json")
    small = word_table.WordTable(lambda raw, ends: calls.append(len(ends)) or t.encode(raw, ends), t.special)
    text = "one two three 日本 😀 é two one"
    assert small.encode_texts([text])[0].tolist() == ids_of(library, text)
    assert calls == [7]


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_alike_under_sums_of_powers_are_told_apart(library):
    one, other = thue_morse(2048, "ab"), thue_morse(2048, "ba")
    ids, sizes = token_files.library("byte_bpe_50k.json").encode_texts([one, other, one + " " + other])
    want = [ids_of(library, t) for t in (one, other, one + " " + other)]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))
    assert own(one) == want[0] and own(other) == want[1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "s", "t", "re", " ", "  ", "\n", "'", "'s", "'ll", "é", "1", "²", "!", "<|endoftext|>", "日本", "　", " ", "\x85", "\t",
                                 "ing", "the", "X", "😀", "́", "_", "zzz", "qxj"]), max_size=25).map("".join) | st.text(max_size=40))
def test_encoding_is_that_of_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    lib = Tokenizer.from_file(FILE) if not hasattr(test_encoding_is_that_of_the_library, "lib") else test_encoding_is_that_of_the_library.lib
    test_encoding_is_that_of_the_library.lib = lib
    want = ids_of(lib, text)
    assert own(text) == want
    assert token_files.library("byte_bpe_50k.json").encode_texts([text])[0].tolist() == want
    v, _ = bpe.load(FILE)
    assert v.decode(np.array(want, np.uint32)).decode("utf-8", "replace") == lib.decode(want, skip_special_tokens=False)


def test_every_token_encodes_to_itself_and_decoding_takes_any_ids(library):
    v, _ = bpe.load(FILE)
    for i in range(0, 50256, 7):
        assert v.encode_word(v.bytes[v.offsets[i]:v.offsets[i + 1]].tobytes()) == [i]
    rng = random.Random(1)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert v.decode(np.array(ids, np.uint32)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_word_table_forgets_and_cuts_long_texts(library, spark, sf):
    texts = [r.text or "" for r in table(spark, sf, "documents").select("text").limit(60).collect()]
    t = token_files.library("byte_bpe_50k.json")
    small = word_table.WordTable(t.encode, t.special, room=500)
    for _ in range(2):
        ids, n = small.encode_texts(texts)
        assert ids.tolist() == [i for x in texts for i in ids_of(library, x)] and n.tolist() == [len(ids_of(library, x)) for x in texts]
    long = "\n".join(texts)
    assert "".join(word_table.parts_of(long, 1000)) == long and len(list(word_table.parts_of(long, 1000))) > 5
    assert small.encode_texts([])[0].tolist() == [] and small.encode_texts(["", ""])[1].tolist() == [0, 0]


def test_encode_documents(hard_docs, no_docs, plain, library):
    want = Counter()
    for i, t in plain:
        ids = ids_of(library, t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, tokens.encode_documents(hard_docs).collect())) == want
    assert tokens.encode_documents(no_docs).count() == 0
    for r in tokens.encode_documents(hard_docs.where("n_chars < 50"), keep_ids=True).collect():
        assert r.n_tokens == len(r.ids) and r.decoded == library.decode(r.ids, skip_special_tokens=False)


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2 * rans.BLOCK + 5])
def test_coder_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) % 50257).astype(np.uint32)
    f = io.BytesIO()
    rans.write_file(f, ids, [3, None], [n - 1, 1])
    r = rans.Reader(f)
    blocks = list(range(len(r.blocks)))
    parts = {i: r.block(i) for i in reversed(blocks)}  # in any order
    assert (np.concatenate([parts[i] for i in blocks]) == ids).all()
    assert [d[:2] for d in r.documents()] == [(3, n - 1), (None, 1)]
    body = bytearray(f.getvalue())
    body[len(rans.MAGIC) + 1] ^= 1
    with pytest.raises(ValueError):
        rans.Reader(io.BytesIO(bytes(body))).block(0)
    with pytest.raises(ValueError):
        rans.Reader(io.BytesIO(f.getvalue()[:-1]))


def test_coder_takes_ids_too_large_for_an_array_of_places():
    ids = np.array([7, rans.DENSE - 1, rans.DENSE, 2**32 - 1, 7], np.uint32)
    for some in (ids, ids[:2]):
        f = io.BytesIO()
        rans.write_file(f, some, [1], [len(some)])
        assert rans.Reader(f).block(0).tolist() == some.tolist()


def test_small_token_files_are_listed_together_and_read_by_few_tasks(spark):
    docs = spark.createDataFrame([(i, "some words " * 5) for i in range(40)], "doc_id long, text string")
    files = token_files.write_tokens(docs, file_chars=300)
    assert files.count() > 5 and len(files.inputFiles()) == 1
    got = token_files.read_tokens(files).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and len({r.task for r in got}) == 1


def test_scaled_tables_add_up():
    for counts in ([1], [1] * 60000, [10**9, 1, 1], list(range(1, 3000))):
        t = rans.scaled_table(np.array(counts))
        assert t.sum() == 1 << rans.SCALE_BITS and t.min() >= 1


def test_token_files(hard_docs, no_docs, plain, library, tmp_path):
    files = token_files.write_tokens(hard_docs, folder=f"file://{tmp_path}/tokens", file_chars=100_000)
    got = token_files.read_tokens(files).collect()
    assert files.count() > 3
    rows = sorted(((i is not None, i or 0, t is not None, t or "", i) for i, t in plain), key=lambda r: r[:4])
    start, want = 0, []
    for *_, t, i in rows:
        ids = np.array([*ids_of(library, t), 0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.token_round_trip(no_docs).count() == 0


def test_quality_keeps_good_held_out_documents(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = labels.where("doc_id % 3 = 0")
    got = {r.doc_id: r.kept for r in quality.resample(docs, labels.where("doc_id % 3 <> 0")).collect()}
    right = [got[r.doc_id] == (r.quality == 1) for r in held.collect()]
    assert len(got) == docs.count() and sum(right) / len(right) >= 0.95
    kept = {r.doc_id for r in quality.good_documents(docs, labels).collect()}
    full = {r.doc_id: r.kept for r in quality.resample(docs, labels).collect()}
    assert kept == {i for i, k in full.items() if k}
    assert sum(full[i] == (q == 1) for i, q in truth.items() if i in full) / len(truth) >= 0.98


def test_quality_edges(spark, hard_docs, no_docs, plain):
    labels = spark.createDataFrame([(i, None if i % 7 == 0 else int(i % 5 > 0), 0) for i in range(60)] + [(None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.resample(hard_docs, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in plain)
    assert all(r.log_weight == 0 for r, t in ((r, dict(plain)[r.doc_id]) for r in out if r.doc_id is not None) if not t)
    assert all(r.kept for r in quality.resample(hard_docs, labels.limit(0)).collect())
    assert quality.resample(no_docs, labels).count() == 0
    kept = quality.good_documents(hard_docs, labels)
    assert kept.columns == hard_docs.columns and kept.count() == sum(r.kept for r in out)


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 1.0], [-3.0, 2.0, 2.0, 7.5, 1e-300, 1e300], [0.1 * i for i in range(500)] + [3.0] * 50])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        if k <= len(values):
            assert quality.kth_largest(df, "v", k, bins=8) == sorted(values, reverse=True)[k - 1]
