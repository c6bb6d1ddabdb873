"""Quality rules per document and per host (operator 4)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import materialize, segment_sums, text_blocks, word_codes

SYMBOLS = "#*$%&|<>"
GRAM = 5

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Failures that are counted by host; the first two are also the base rules of a document.
RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "2 * n_dup_lines > n_words",
}
BASE_FAILED = f"({RULES['few_words']}) OR ({RULES['repeats']})"


@dataclass(frozen=True)
class HostPolicy:
    """A host is rejected if the shrunk failure rate of a rule is above ``reject_above``."""

    reject_above: float = 0.9


def _repeated(codes: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """1 at each word inside a window of five words that occurs twice or more in its document."""
    covered = np.zeros(len(codes) + 1, np.int64)
    n = len(codes) - GRAM + 1
    if n <= 0:
        return covered[:-1]
    at = np.flatnonzero(doc[:n] == doc[GRAM - 1 :])
    key = doc[at].astype(np.uint64)
    for k in range(GRAM):  # wraps around on purpose
        key = (key ^ codes[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")

    def equal(order: np.ndarray) -> np.ndarray:
        x, y = at[order[:-1]], at[order[1:]]
        return (doc[x] == doc[y]) & np.logical_and.reduce([codes[x + k] == codes[y + k] for k in range(GRAM)])

    same = equal(order)
    if (same != (key[order[:-1]] == key[order[1:]])).any():  # two windows share a key: sort by the words themselves
        order = np.lexsort([codes[at + k] for k in reversed(range(GRAM))] + [doc[at]])
        same = equal(order)
    twice = at[np.unique(np.concatenate([order[:-1][same], order[1:][same]]))]
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + GRAM, -1)
    return (np.cumsum(covered)[:-1] > 0).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def text_metrics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    symbol = np.zeros(256, np.int64)
    symbol[[ord(c) for c in SYMBOLS]] = 1
    out: dict[str, list] = {name: [] for name in METRICS}
    for _, block in text_blocks(texts):
        starts, codes, words = word_codes(block)
        doc = np.repeat(np.arange(len(block)), np.diff(starts))
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = block.cast(pa.large_binary()).to_pylist()
        out["n_words"].append(np.diff(starts))
        out["word_chars"].append(segment_sums(lengths[codes] if len(codes) else codes, starts))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        out["n_symbols"].append(segment_sums(symbol[np.frombuffer(b"".join(raw), np.uint8)], bounds))
        out["n_dup_lines"].append(np.array([_duplicate_lines(x) for x in raw], np.int64))
        out["n_repeat_words"].append(segment_sums(_repeated(codes, doc, starts), starts))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def document_metrics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the five counts of the whole text (null: no words); map only."""
    columns = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]
    source = docs.select(*columns, F.col(f"`{text_col}`").alias("_text"))

    def measure(batches):
        for batch in batches:
            counts = text_metrics(batch.column("_text"))
            kept = [batch.column(f"_k{i}") for i in range(len(keep))]
            names = [f"_k{i}" for i in range(len(keep))] + [f"_{m}" for m in METRICS]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(counts[m], pa.int64()) for m in METRICS], names=names)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    measured = source.mapInArrow(measure, ", ".join(fields + [f"_{m} long" for m in METRICS]))
    return measured.toDF(*keep, *METRICS)


def host_verdicts(metrics: DataFrame, host_col: str = "source", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """One row per host: documents, failures and shrunk rate of each rule, and ``host_rejected``.

    The prior of a rule is the beta distribution whose mean and variance are those of the
    hosts' failure rates, each host counted by its documents. With mean m and variance v its
    weight is m (1 - m) / v - 1 documents, at least 1; when all hosts agree, v = 0 and every
    host gets the common rate. A null host is a host of its own.
    """
    fails = {r: F.count_if(F.expr(rule)) for r, rule in RULES.items()}
    hosts = metrics.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[n.alias(f"fail_{r}") for r, n in fails.items()]
    )
    hosts = materialize(hosts, "hosts")
    n = F.sum("n_docs")
    prior = hosts.agg(
        *[(F.sum(f"fail_{r}") / n).alias(f"mean_{r}") for r in RULES],
        *[(F.sum(F.col(f"fail_{r}") * F.col(f"fail_{r}") / F.col("n_docs")) / n).alias(f"square_{r}") for r in RULES],
    )
    scored = hosts.join(F.broadcast(prior))  # one row of two numbers per rule
    for r in RULES:
        mean, variance = F.col(f"mean_{r}"), F.col(f"square_{r}") - F.col(f"mean_{r}") * F.col(f"mean_{r}")
        weight = F.greatest(F.lit(1.0), mean * (1 - mean) / variance - 1)
        shrunk = (F.col(f"fail_{r}") + weight * mean) / (F.col("n_docs") + weight)
        scored = scored.withColumn(f"rate_{r}", F.when(variance > 1e-12, shrunk).otherwise(mean))
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return scored.select(
        "host",
        "n_docs",
        *[f"fail_{r}" for r in RULES],
        *[f"rate_{r}" for r in RULES],
        (worst > policy.reject_above).alias("host_rejected"),
    )


def quality_verdicts(
    docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", policy: HostPolicy = HostPolicy()
) -> DataFrame:
    """Each document's counts, ``base_failed`` and ``kept``: neither it nor its host is rejected.

    Only counts and hosts are shuffled, no text. The verdicts are joined as an ordinary table,
    so a frequent host is split by adaptive execution or the few hosts are broadcast by Spark's size check.
    Repeated documents count as often as they occur.
    """
    metrics = materialize(document_metrics(docs, [id_col, host_col]).toDF("doc_id", "_host", *METRICS), "metrics")
    rejected = materialize(host_verdicts(metrics, "_host", policy).filter("host_rejected").select("host", "host_rejected"), "rejected")
    judged = metrics.withColumn("base_failed", F.expr(BASE_FAILED)).join(rejected, F.col("_host").eqNullSafe(F.col("host")), "left")
    return judged.select(
        "doc_id", *METRICS, "base_failed", (~F.col("base_failed") & F.col("host_rejected").isNull()).alias("kept")
    )


def keep_good(docs: DataFrame, host_col: str = "source", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """The documents that are kept, with all their columns.

    The texts are measured twice instead of being written or shuffled: once for the hosts, once to filter.
    """
    names = docs.columns
    metrics = document_metrics(docs, [host_col]).toDF("_host", *METRICS)
    rejected = materialize(host_verdicts(metrics, "_host", policy).filter("host_rejected").select("host"), "rejected")
    inner = [f"_d{i}" for i in range(len(names))]
    place = names.index("text")
    source = docs.toDF(*inner)
    plain = source.schema

    def good(batches):
        for batch in batches:
            m = text_metrics(batch.column(place))
            yield batch.filter(pa.array((m["n_words"] >= 10) & (100 * m["n_repeat_words"] <= 20 * m["n_words"])))

    kept = source.mapInArrow(good, plain)
    host = F.col(inner[names.index(host_col)])
    return kept.join(rejected, host.eqNullSafe(F.col("host")), "left_anti").toDF(*names)
