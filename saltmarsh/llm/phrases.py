"""Collocations from a weighted de Bruijn graph of word grams, exact.

A language's pieces are cut into words. Every position gives the longest gram that starts there: four
words, an edge from its first three words to its last three, or fewer words where the piece ends. Equal
grams are added up, so a gram's count is the flow through it, and the count of a shorter gram is the flow
out of its node (the longer grams that begin with it) plus its own entries, the piece-end corrections.
Counts of three, two and one words follow from each other this way; no text is read again for them.

A candidate needs ``least`` occurrences, so all its words, pairs and triples have as many. Those that
have fewer end a piece before the edges are made: this changes no count that matters. They are told apart by
bit sets of a fixed size that the workers get, filled from counts of hashes; a collision only lets a gram
through that the exact counts drop later.

A node with one edge in and one out that carry all of its flow is passed straight: such nodes are
compacted into unary paths, whose inner nodes share the flow of their edges. An inner node is never
a phrase of its own (the edge around it is as frequent), so only the other nodes are weighed, and each
phrase that stays can be shown within its whole path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship, stored
from .text import mix

LEAST, TOP, LONGEST, COVER_PERCENT, SCORE = 30, 2000, 4, 80, 2_000_000
#: bits of each of the three sets that the workers get (8 MB), whatever the corpus
FILTER_BITS = 26
#: hashed grams are counted in shards of 2 ** LOW counters; a task sends them on in lots
LOW, LOT = 22, 1 << 22
_ENDS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(_ENDS) + b" ")
END = b"\n"


class Stream:
    """The words of some texts of one language as numbers; 0 ends a piece."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang = lang
        tokens = (b" \n " + END.join(texts).translate(_CLEAN).replace(END, b" \n ") + b" \n" * LONGEST).split(b" ")
        ids: dict[bytes, int] = {END: 0}
        self.at = np.fromiter((ids.setdefault(t, len(ids)) for t in tokens if t), np.int64)
        self.words = list(ids)
        seed = xxhash.xxh3_64_intdigest(lang)
        self.hash = np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seed) for w in self.words), np.uint64, len(ids))

    def gram_hash(self, size: int) -> np.ndarray:
        """Of the ``size`` words from every position on."""
        h = self.hash[self.at]
        out = h
        for k in range(1, size):
            out = mix(out[:-1]) + h[k:]
        return mix(out)

    def good(self, words: np.ndarray) -> np.ndarray:
        """Positions of words that the set of frequent words holds."""
        some = _has(words, self.hash)
        some[0] = False
        return some[self.at]


def streams(batch) -> Iterator[Stream]:
    texts = batch.column("text").cast(pa.large_binary()).to_pylist()
    by: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), texts):
        by.setdefault(lang, []).append(text or b"")
    for lang, some in by.items():
        yield Stream(lang, some)


def _words(batches):
    for batch in batches:
        for s in streams(batch):
            n = np.bincount(s.at, minlength=len(s.words))
            n[0] = 0
            (some,) = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s.lang] * len(some), pa.string()), pa.array([s.words[i].decode() for i in some], pa.string()),
                 pa.array(n[some].astype(np.int64))], ["lang", "word", "n"])


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _bits(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the 64-bit words of a bit set, and their bits."""
    at, where = np.unique(place >> np.uint64(6), return_inverse=True)
    out = np.zeros(len(at), np.uint64)
    np.bitwise_or.at(out, where, np.uint64(1) << (place & np.uint64(63)))
    return at.astype(np.int64), out.view(np.int64)


def _word_bits(batches):
    for batch in batches:
        h = [xxhash.xxh3_64_intdigest(w, seed=xxhash.xxh3_64_intdigest(lang))
             for lang, w in zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())]
        at, bits = _bits(np.array(h, np.uint64) >> np.uint64(64 - FILTER_BITS))
        yield pa.RecordBatch.from_arrays([pa.array([1] * len(at), pa.int32()), pa.array(at), pa.array(bits)], ["size", "i", "b"])


class _Counts:
    """Counts of 32-bit hashes of one gram size, sent on as shards of packed numbers: count above, low bits below."""

    def __init__(self, size: int):
        self.size, self.lots, self.held = size, [], 0

    def add(self, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.lots.append(np.unique((h >> np.uint64(32)).astype(np.uint32), return_counts=True))
        self.held += len(self.lots[-1][0])
        if self.held >= LOT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        keys, n = (np.concatenate(x) for x in zip(*self.lots))
        self.lots, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.diff(keys, prepend=np.uint32(~keys[0])))
        n = np.minimum(np.add.reduceat(n, first), (1 << 32 - LOW) - 1).astype(np.uint32)
        keys = keys[first]
        packed = n << np.uint32(LOW) | keys & np.uint32((1 << LOW) - 1)
        shards, at = np.unique(keys >> np.uint32(LOW), return_index=True)
        ends = [*at[1:].tolist(), len(keys)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.size] * len(shards), pa.int32()), pa.array(shards.astype(np.int32)),
             pa.array([packed[i:j].tobytes() for i, j in zip(at.tolist(), ends)], pa.binary())], ["size", "shard", "data"])


def _hashed_grams(words):
    """Counts of the hashes of all pairs and triples of frequent words."""
    def run(batches):
        counts = [_Counts(2), _Counts(3)]
        for batch in batches:
            for s in streams(batch):
                run = s.good(words.value)
                for c in counts:
                    run = run[:-1] & s.good(words.value)[c.size - 1:]
                    yield from c.add(s.gram_hash(c.size)[run])
        for c in counts:
            yield from c.flush()
    return run


def _frequent(least: int):
    """The bits of the hashes that were counted ``least`` times, from shards in order."""
    def run(batches):
        now, count = None, None

        def flush():
            if now is not None:
                key = np.flatnonzero(count >= least).astype(np.uint64) | np.uint64(now[1] << LOW)
                at, bits = _bits(np.unique(key >> np.uint64(32 - FILTER_BITS)))
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(at), pa.int32()), pa.array(at), pa.array(bits)], ["size", "i", "b"])

        for batch in batches:
            for size, shard, data in zip(*(batch.column(c).to_pylist() for c in ("size", "shard", "data"))):
                if (size, shard) != now:
                    yield from flush()
                    now, count = (size, shard), np.zeros(1 << LOW, np.int32)
                packed = np.frombuffer(data, np.uint32)
                at = packed & np.uint32((1 << LOW) - 1)  # no number twice in a lot
                count[at] = np.minimum(count[at], 1 << 30) + (packed >> np.uint32(LOW)).astype(np.int32)
        yield from flush()
    return run


def _filters(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per gram size a bit set, from rows (size, i, b); at most 2 ** (FILTER_BITS - 6) numbers each reach the driver."""
    longs = rows.groupBy("size", "i").agg(F.bit_or("b").alias("b")).toArrow()
    out = {}
    for size in (1, 2, 3):
        some = longs.filter(pa.compute.equal(longs.column("size"), size))
        out[size] = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        out[size][some.column("i").to_numpy()] = some.column("b").to_numpy().view(np.uint64)
    return out


def longest_grams(s: Stream, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct longest grams (rows of word numbers, 0 behind a shorter one) and how often each occurs."""
    n = len(s.at)
    ok = [s.good(words)]
    for size, bits in ((2, pairs), (3, triples)):
        ok.append(ok[-1][:-1] & ok[-1][1:] & _has(bits, s.gram_hash(size)))
    ok.append(ok[-1][:-1] & ok[-1][1:])
    grams = np.zeros((n, LONGEST), np.int64)
    for k, some in enumerate(ok):
        grams[: n - k, k] = np.where(some, s.at[k:], 0)
    grams = grams[ok[0]]
    if not len(grams):
        return grams, np.empty(0, np.int64)
    key = np.zeros(len(grams), np.int64)
    for k in range(LONGEST):  # the number of the distinct prefix, then the next word
        _, key = np.unique(key * (len(s.words) + 1) + grams[:, k], return_inverse=True)
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return grams[first], count.astype(np.int64)


def _edges(filters):
    def run(batches):
        for batch in batches:
            for s in streams(batch):
                grams, n = longest_grams(s, *filters.value)
                words_of = [w.decode() for w in s.words]
                size = (grams > 0).sum(1)
                names = [words_of[g[0]] if k == 1 else " ".join([words_of[i] for i in g[:k]]) for g, k in zip(grams.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s.lang] * len(n), pa.string()), pa.array(names, pa.string()), pa.array(size.astype(np.int32)), pa.array(n)],
                    ["lang", "gram", "size", "n"])
    return run


def _first(gram: Column, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def _last(gram: Column, words: int) -> Column:
    return F.substring_index(gram, " ", -words)


def gram_counts(edges: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, gram, size, f) of all grams of one to ``longest`` words from the longest grams: flow out plus piece ends."""
    level = edges.where(F.col("size") == longest).select("lang", "gram", "n")
    out = level.select("lang", "gram", F.lit(longest).alias("size"), F.col("n").alias("f"))
    for size in range(longest - 1, 0, -1):
        ends = edges.where(F.col("size") == size).select("lang", "gram", "n")
        level = stored(level.select("lang", _first(F.col("gram"), size).alias("gram"), "n").unionAll(ends)
                       .groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"grams-{size}")
        out = out.unionAll(level.select("lang", "gram", F.lit(size).alias("size"), F.col("n").alias("f")))
    return out


def unary_paths(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Edges that follow each other over nodes passed straight: (lang, gram, head, step), head the first edge of the path.

    ``counts`` are those of frequent grams. A node is passed straight when one edge in and one edge out
    carry its whole flow. Every entry into a path lies at its head, as all pieces end, so there are no circles.
    Pointers to earlier edges double in every round.
    """
    edges = counts.where(F.col("size") == longest)
    nodes = counts.where(F.col("size") == longest - 1)
    into = edges.select("lang", _last(F.col("gram"), longest - 1).alias("node"), F.col("gram").alias("before"), F.col("f").alias("f_in"))
    out = edges.select("lang", _first(F.col("gram"), longest - 1).alias("node"), F.col("gram").alias("after"), F.col("f").alias("f_out"))
    straight = nodes.select("lang", F.col("gram").alias("node"), "f").join(into, ["lang", "node"]).join(out, ["lang", "node"]).where(
        (F.col("f") == F.col("f_in")) & (F.col("f") == F.col("f_out")))
    now = stored(edges.select("lang", "gram").join(straight.select("lang", F.col("after").alias("gram"), "before"), ["lang", "gram"], "left")
                 .select("lang", "gram", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("long").alias("step")), "paths")
    done = -1
    while True:
        moved = now.agg(F.sum("step")).first()[0] or 0
        if moved == done:
            return now
        done = moved
        up = now.select("lang", F.col("gram").alias("head"), F.col("head").alias("__head"), F.col("step").alias("__step"))
        now = stored(now.join(up, ["lang", "head"]).select(
            "lang", "gram", F.col("__head").alias("head"), (F.col("step") + F.col("__step")).alias("step")), "paths")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases per language: lang, rank, phrase, a, l, r, n, score, path_words.

    Texts (null: empty) are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, pieces into
    words at blanks and tabs; a null lang is ``und``. Candidates are phrases of two to four words that occur
    ``least`` times or more. A cut into two parts with counts l and r scores floor(2000000 a / (l + r)); the
    lowest cut counts, ties to the shorter first part. A candidate inside a longer one that has at least 80
    percent of its count is dropped: it suffices to look at one word more, as every gram between two
    nested ones is at least as frequent as the longer. Ranked by score, then a, both descending, then phrase in byte
    order. ``path_words`` is the length of the unary path that a four-word phrase lies on, null for others.
    Rows count one by one, whatever their ids; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), docs["text"].alias("text"))
    words = stored(texts.mapInArrow(_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    bits = "size int, i long, b long"
    word_bits = _filters(words.where(F.col("n") >= least).select("lang", "word").mapInArrow(_word_bits, bits))[1]
    sent = spark.sparkContext.broadcast(word_bits)
    hashed = texts.mapInArrow(_hashed_grams(sent), "size int, shard int, data binary")
    gram_bits = _filters(hashed.repartition("size", "shard").sortWithinPartitions("size", "shard").mapInArrow(_frequent(least), bits))
    sent = spark.sparkContext.broadcast((word_bits, gram_bits[2], gram_bits[3]))
    edges = stored(texts.mapInArrow(_edges(sent), "lang string, gram string, size int, n long").groupBy(
        "lang", "gram", "size").agg(F.sum("n").alias("n")), "edges")
    counts = stored(gram_counts(edges).where(F.col("f") >= least), "counts")

    paths = unary_paths(counts)
    lengths = paths.groupBy("lang", "head").agg((F.max("step") + LONGEST).alias("path_words"))
    within = paths.join(lengths, ["lang", "head"]).select("lang", "gram", "step", "path_words")
    inner = within.where("step > 0").select("lang", _first(F.col("gram"), LONGEST - 1).alias("gram"))
    found = counts.where("size > 1").join(inner, ["lang", "gram"], "left_anti")
    longer = counts.where("size > 2")
    shorter = [F.expr("substring_index(gram, ' ', size - 1)"), F.expr("substring_index(gram, ' ', 1 - size)")]
    around = longer.select("lang", F.explode(F.array(*shorter)).alias("gram"), F.col("f").alias("f_longer")).groupBy("lang", "gram").agg(
        F.max("f_longer").alias("f_longer"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    found = found.join(around, ["lang", "gram"], "left").where(
        F.col("f_longer").isNull() | (big("f_longer") * 100 < big("f") * COVER_PERCENT))
    cuts = found.select("lang", "gram", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("substring_index(gram, ' ', k)").alias("left"), F.expr("substring_index(gram, ' ', k - size)").alias("right"))
    part = lambda side, name: counts.select("lang", F.col("gram").alias(side), F.col("f").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(f"(cast({SCORE} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(20,0)) + r)"))
    best = cuts.groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = best.select("lang", F.col("gram").alias("phrase"), "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))
    return ranked.join(totals, "lang").join(
        within.select("lang", F.col("gram").alias("phrase"), "path_words"), ["lang", "phrase"], "left").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words")
