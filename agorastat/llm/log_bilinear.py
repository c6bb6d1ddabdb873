"""A log-bilinear language model trained by noise-contrastive estimation, and document scores from it.

Words count in training documents only. The model's outputs are the most frequent words and, for all
other words, classes by their last byte; inside a class a word has the share (c + 1) / (n + v + 1) of its
count c, of the class's tokens n and distinct words v, so unknown words keep a share in each class. The
score of output o after two context words is a(c1).q(o) + a'(c2).q(o) + b(o), and its softmax is exact:
the exponentials of both products, multiplied as matrices, give the normaliser of every context at once.

Spark counts words and (c2, c1, o) cells over all training documents; the cells are the whole evidence of
the training, and their number is bounded by the model's size. They are dealt over a fixed number of
shards, each of which trains by itself for a round on draws in proportion to the counts; the shards'
parameters are averaged, weighted by their counts, so the result does not depend on the cluster.

The most frequent words (``head_words``) are held by every task. The others of a text are counted per
document and joined with the table of counts, so no vocabulary is collected.

Defined results: a null text has no words and one end. A null id has the remainder of the empty text, so
it belongs to training. Rows are scored and counted one by one, repeated ones too. Without training
documents all words are unknown. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import byte_table, mapped, materialize, segment_sums, text_blocks, word_codes

END = " "  # the end of a text; no word holds a space
FORMS = 32  # classes of words that are no output of their own, by last byte
FLUSH = 2_000_000  # cells that a task holds before it passes them on
_LOWER = byte_table()


@dataclass(frozen=True)
class Sizes:
    head_words: int = 131_072
    outputs: int = 1024
    contexts: int = 256  # of the word before: the begin, the forms, the most frequent words
    far_contexts: int = 64  # of the word before that
    dims: int = 24
    shards: int = 16
    rounds: int = 4
    passes: float = 6.0  # draws of all rounds, as a multiple of the cells
    batch: int = 1024
    noise: int = 64
    rate: float = 0.15


def word_forms(words: pa.Array) -> np.ndarray:
    """The last byte of each word modulo 32."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset + 1 : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    return data[ends - 1].astype(np.int64) % FORMS


class Vocabulary:
    """The most frequent words, by falling count, and the numbers that stand for them in the model."""

    def __init__(self, words: pa.Array, counts: np.ndarray, sizes: Sizes) -> None:
        self.words, self.counts = words.cast(pa.large_string()), counts
        self.outputs = min(sizes.outputs, len(words))
        self.near = min(max(0, sizes.contexts - FORMS - 1), len(words))
        self.far = min(max(0, sizes.far_contexts - FORMS - 1), len(words))

    def tokens(self, texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        """The tokens of some texts, the end of each among them, as numbers."""
        starts, codes, words = word_codes(mapped(texts, _LOWER))
        words = pa.concat_arrays([words.cast(pa.large_string()), pa.array([END], pa.large_string())])
        rank = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        n, ends = len(texts), starts[1:] + np.arange(len(texts))
        code = np.full(len(codes) + n, len(words) - 1, np.int64)
        plain = np.ones(len(code), bool)
        plain[ends] = False
        code[plain] = codes
        forms = word_forms(words)
        begins = starts[:-1] + np.arange(n)

        def numbered(most: int, shift: int, other: np.ndarray) -> np.ndarray:
            return np.where((rank >= 0) & (rank < most), rank + shift, other)

        out = numbered(self.outputs, 0, forms + self.outputs)[code]
        near, far = numbered(self.near, FORMS + 1, forms + 1)[code], numbered(self.far, FORMS + 1, forms + 1)[code]
        one, two = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        one[1:], two[2:] = near[:-1], far[:-2]
        one[begins], two[begins] = 0, 0
        second = begins + 1
        two[second[second <= ends]] = 0
        return {"code": code, "words": words, "rank": rank, "starts": np.append(begins, len(code)), "out": out, "one": one, "two": two}


class Model:
    """Context vectors of both places, output vectors and biases."""

    def __init__(self, one: np.ndarray, two: np.ndarray, out: np.ndarray, bias: np.ndarray) -> None:
        self.parts = [one, two, out, bias]

    @classmethod
    def start(cls, share: np.ndarray, vocabulary: Vocabulary, sizes: Sizes) -> Model:
        """Small random vectors, and biases that alone give the outputs' shares."""
        rng = np.random.default_rng(7)
        shapes = [vocabulary.near + FORMS + 1, vocabulary.far + FORMS + 1, len(share)]
        vectors = [(rng.standard_normal((n, sizes.dims)) * 0.1).astype(np.float32) for n in shapes]
        vectors[0] *= 0.1
        vectors[1] *= 0.1
        return cls(*vectors, np.log(share).astype(np.float32))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Products of all contexts of either place with all outputs, and the log of each context pair's normaliser."""
        one, two, out, bias = (p.astype(np.float64) for p in self.parts)
        near, far = one @ out.T, two @ out.T + bias
        shift_near, shift_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        totals = np.exp(far - shift_far) @ np.exp(near - shift_near).T
        return near.astype(np.float32), far.astype(np.float32), np.log(totals) + shift_far + shift_near.T


def _added(target: np.ndarray, squares: np.ndarray, at: np.ndarray, change: np.ndarray, rate: float) -> None:
    """One AdaGrad step on the rows ``at``; changes of one row are summed first."""
    order = np.argsort(at, kind="stable")
    rows, first = np.unique(at[order], return_index=True)
    total = np.add.reduceat(change[order], first, axis=0)
    squares[rows] += total * total
    target[rows] += rate * total / (np.sqrt(squares[rows]) + 1e-6)


def train(model: Model, keys: np.ndarray, counts: np.ndarray, share: np.ndarray, sizes: Sizes, seed: int, rate: float) -> Model:
    """One round on one shard: draws in proportion to the counts, told from noise with the outputs' shares."""
    one, two, out, bias = parts = [p.copy() for p in model.parts]
    squares = [np.full_like(p, 1e-2) for p in parts]
    rng = np.random.default_rng(seed)
    draws = max(sizes.batch, int(len(keys) * sizes.passes / sizes.rounds))
    up_to, noise_up_to = np.cumsum(counts / counts.sum()), np.cumsum(share / share.sum())
    near, outputs = len(one), len(out)
    shift = np.log(sizes.noise * share).astype(np.float32)
    for _ in range(-(-draws // sizes.batch)):
        key = keys[np.minimum(np.searchsorted(up_to, rng.random(sizes.batch)), len(keys) - 1)]
        o, c = key % outputs, key // outputs
        c1, c2 = c % near, c // near
        noise = np.minimum(np.searchsorted(noise_up_to, rng.random(sizes.noise)), outputs - 1)
        hidden = one[c1] + two[c2]
        wanted = 1 / (1 + np.exp(shift[o] - bias[o] - np.einsum("ij,ij->i", hidden, out[o])))
        unwanted = 1 / (1 + np.exp(shift[noise] - bias[noise] - hidden @ out[noise].T))
        up, down = (1 - wanted)[:, None], -unwanted
        to_hidden = up * out[o] + down @ out[noise]
        at = np.concatenate([o, noise])
        to_out = np.concatenate([up * hidden, down.T @ hidden])
        to_bias = np.concatenate([up[:, 0], down.sum(axis=0)])
        scale = np.float32(1 / np.sqrt(sizes.batch))
        _added(one, squares[0], c1, to_hidden * scale, rate)
        _added(two, squares[1], c2, to_hidden * scale, rate)
        _added(out, squares[2], at, to_out * scale, rate)
        _added(bias, squares[3], at, to_bias * scale, rate)
    return Model(*parts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in text_blocks(batch.column("text")):
            _, codes, words = word_codes(mapped(texts, _LOWER))
            words = pa.concat_arrays([words.cast(pa.string()), pa.array([END])])
            counts = np.append(np.bincount(codes, minlength=len(words) - 1), len(texts))
            yield pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], names=["word", "n"])


def _count_cells(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            for _, texts in text_blocks(batch.column("text")):
                t = vocabulary.tokens(texts)
                key = (t["two"] * (vocabulary.near + FORMS + 1) + t["one"]) * (vocabulary.outputs + FORMS) + t["out"]
                new, n = np.unique(key, return_counts=True)
                merged, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
                sums = np.zeros(len(merged), np.int64)
                sums[back[: len(keys)]] += counts  # numbers of either side do not repeat
                sums[back[len(keys) :]] += n
                keys, counts = merged, sums
                if len(keys) > FLUSH:
                    yield flush()
                    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield flush()

    return run


def _pack_shard(table: pa.Table) -> pa.Table:
    order = np.argsort(table["key"].to_numpy())
    blobs = [table[c].to_numpy()[order].astype("<i8").tobytes() for c in ("key", "n")]
    return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()), "keys": pa.array(blobs[:1], pa.binary()), "counts": pa.array(blobs[1:], pa.binary())})


def _trainer(model: Model, share: np.ndarray, sizes: Sizes, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                rate = sizes.rate / (1 + number)
                done = train(model, np.frombuffer(row["keys"], "<i8"), counts, share, sizes, 1000 * number + row["shard"], rate)
                columns = [pa.array([row["shard"]], pa.int32()), pa.array([int(counts.sum())]), pa.array([[p.astype("<f4").tobytes() for p in done.parts]], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "n", "parts"])

    return run


def fit(training: DataFrame, vocabulary: Vocabulary, share: np.ndarray, sizes: Sizes) -> Model:
    """The model from all cells of ``training(text)``."""
    model = Model.start(share, vocabulary, sizes)
    cells = training.select("text").mapInArrow(_count_cells(vocabulary), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    dealt = cells.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(sizes.shards)).cast("int"))
    packed = materialize(dealt.groupBy("shard").applyInArrow(_pack_shard, "shard int, keys binary, counts binary"), "cells")
    for number in range(sizes.rounds):
        rows = packed.mapInArrow(_trainer(model, share, sizes, number), "shard int, n long, parts array<binary>").toArrow().sort_by("shard").to_pylist()
        if not rows:
            break
        weights = np.array([r["n"] for r in rows], float) / sum(r["n"] for r in rows)  # at most one row per shard
        model = Model(*[
            sum(w * np.frombuffer(r["parts"][i], "<f4") for w, r in zip(weights, rows)).astype(np.float32).reshape(p.shape) for i, p in enumerate(model.parts)
        ])
    return model


_SCORED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
     ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))]
)
_SCORED_SPARK = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<string>, times array<long>"


def _scorer(vocabulary: Vocabulary, model: Model, totals: np.ndarray):
    """Per document, what the head words and the model give; its other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far, normaliser = model.tables()
        normaliser = normaliser.astype(np.float32)
        known = np.append(np.log10(vocabulary.counts + 1.0), 0.0)  # the last: not in the head
        in_class = np.log10(np.append(np.ones(vocabulary.outputs), totals))
        for batch in batches:
            for first, texts in text_blocks(batch.column("text")):
                t = vocabulary.tokens(texts)
                own = batch.slice(first, len(texts))
                code, starts, out, one, two = t["code"], t["starts"], t["out"], t["one"], t["two"]
                rank = t["rank"][code]
                log = (near[one, out] + far[two, out] - normaliser[two, one]).astype(np.float64) / np.log(10) - in_class[out]
                base = known[rank]
                log += np.where(out >= vocabulary.outputs, base, 0.0)
                doc = np.repeat(np.arange(len(texts)), np.diff(starts))
                rest = np.flatnonzero(rank < 0)
                pairs, times = np.unique(doc[rest] * len(t["words"]) + code[rest], return_counts=True)
                bounds = pa.array(np.searchsorted(pairs // max(1, len(t["words"])), np.arange(len(texts) + 1)), pa.int32())
                words = t["words"].take(pa.array(pairs % max(1, len(t["words"])))).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), own.column("held_out"), pa.array(np.diff(starts)), pa.array(segment_sums((rank >= 0).astype(np.int64), starts)),
                     pa.array(_sums(base, starts)), pa.array(_sums(log, starts)), pa.ListArray.from_arrays(bounds, words), pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64()))],
                    schema=_SCORED,
                )

    return run


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of stretches that are never empty, each added on its own."""
    return np.add.reduceat(values, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent words; only words of a power of two that can be among them are sorted."""
    power = F.floor(F.log2("c"))
    powers = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("power")).collect()  # 64 rows at most
    least, held = 0, 0
    for row in powers:
        least, held = 1 << int(row["power"]), held + row["n"]
        if held >= most:
            break
    return counts.filter(F.col("c") >= least).orderBy(F.col("c").desc(), "word").limit(most)


def score_documents(docs: DataFrame, held_out, sizes: Sizes = Sizes()) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of each row of ``docs(doc_id, text)``.

    ``held_out`` is the condition of rows the model does not learn from; scores are log10 probabilities.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    training = rows.filter(~F.col("held_out")).select("text")
    counts = materialize(training.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "counts")
    last = F.conv(F.hex(F.substring(F.encode("word", "utf-8"), -1, 1)), 16, 10).cast("int") % FORMS
    forms = counts.groupBy(last.alias("form")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # 32 rows at most
    head = _most_frequent(counts, sizes.head_words).toArrow()
    vocabulary = Vocabulary(head["word"].combine_chunks(), head["c"].to_numpy().astype(np.int64), sizes)
    tokens, words = sum(r["n"] for r in forms), sum(r["v"] for r in forms)
    n, v = np.zeros(FORMS, np.int64), np.zeros(FORMS, np.int64)
    for r in forms:
        n[r["form"]], v[r["form"]] = r["n"], r["v"]
    own = word_forms(vocabulary.words.slice(0, vocabulary.outputs))  # words that are outputs leave their classes
    np.subtract.at(n, own, vocabulary.counts[: vocabulary.outputs])
    np.subtract.at(v, own, 1)
    of_outputs = np.concatenate([vocabulary.counts[: vocabulary.outputs], n])
    share = (of_outputs + 1) / (of_outputs + 1).sum()
    model = fit(training, vocabulary, share, sizes)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    scored = materialize(numbered.mapInArrow(_scorer(vocabulary, model, n + v + 1.0), _SCORED_SPARK), "scored")
    least = int(vocabulary.counts[-1]) if len(head) == sizes.head_words else 0  # rarer words and ties are outside the head
    rest = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    added = rest.join(counts.filter(F.col("c") <= least), "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs")
    )
    divisor = float(np.log10(tokens + words + 1))
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.drop("words", "times").join(added, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * divisor).alias("base_score"), (F.col("score") + logs).alias("score"),
    )


def report(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Scores of all documents; those whose CRC-32 of the id, as text, leaves 2 modulo 7 are held out."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return score_documents(docs, F.crc32(text.cast("binary")) % 7 == 2, sizes)
