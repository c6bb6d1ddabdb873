"""Token counts of fields and sections from one encoding of the whole document (operator 2)."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorastat.llm.tokens import public_path

VOCABULARY = "byte_bpe_50k.tiktoken"


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    """The encoder of a rank file, and the bytes of each token."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding, sizes


def token_offsets(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token in code points.

    Byte-level tokens join to the text's own bytes, so their lengths give their places. A
    token that holds a part of a character touches that character.
    """
    encoding, sizes = _encoding(path)
    ids = np.array(encoding.encode_ordinary(text), np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    first = np.cumsum((raw & 0xC0) != 0x80)  # characters that began up to this byte
    return first[starts] - 1, first[ends - 1]


def lines_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the lines, each with its line break; an empty text has none."""
    ends = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    ends = np.array(ends, np.int64)
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends


def owners(starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1: none), and whether it crosses a boundary.

    The rule: a token belongs to the section that holds most of its characters, the earlier
    one if equal. Sections are in order and do not overlap.
    """
    if not len(section_starts):
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_starts, ends, side="left") - 1
    owner = np.where(first <= last, first, -1)
    inside = np.minimum(first, len(section_starts) - 1)
    crossing = (owner >= 0) & ((section_starts[inside] > starts) | (section_ends[inside] < ends))
    for t in np.flatnonzero(last > first):
        held = np.arange(first[t], last[t] + 1)
        shared = np.minimum(section_ends[held], ends[t]) - np.maximum(section_starts[held], starts[t])
        owner[t] = held[shared.argmax()]
    return owner, crossing


FIELDS = "array<struct<name:string,start:long,end:long>>"


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, fields: Column | str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``section``, ``start``, ``end``, ``n_tokens``, ``n_crossing``: the tokens of every section of each document.

    ``fields`` is a column of spans (name, start, end in code points); without it the lines are the
    sections, named by number. Whole texts are encoded once, and token spans meet section spans by
    binary search, so the counts of a text add up to those of its one encoding. Characters that two
    fields claim belong to the one that starts first. Tokens outside all fields are the row of a null
    section. A null or empty text has no tokens; a field gets a row even without tokens.
    Map only: one document is the unit, nothing is shuffled.
    """
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if fields is not None:
        columns.append((F.col(fields) if isinstance(fields, str) else fields).cast(FIELDS).alias("fields"))
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches):
        path = public_path(vocabulary)
        for batch in batches:
            parts: list[list] = [[], [], [], [], [], []]
            listed = batch.column(2).to_pylist() if fields is not None else [None] * batch.num_rows
            for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), listed):
                text = text or ""
                if fields is None:
                    s, e = lines_of(text)
                    labels = [str(i) for i in range(len(s))]
                else:
                    own = sorted(
                        ((f["name"], min(max(f["start"] or 0, 0), len(text)), min(max(f["end"] or 0, 0), len(text))) for f in own or [] if f),
                        key=lambda f: (f[1], f[2]),
                    )
                    labels, s, e, reach = [], [], [], 0
                    for name, a, b in own:
                        labels.append(name)
                        s.append(max(a, reach))
                        reach = max(reach, b, s[-1])
                        e.append(max(b, s[-1]))
                    s, e = np.array(s, np.int64), np.array(e, np.int64)
                a, b = token_offsets(text, path) if text else (np.zeros(0, np.int64),) * 2
                owner, crossing = owners(a, b, s, e)
                counts = np.bincount(owner + 1, minlength=len(s) + 1)
                crossed = np.bincount(owner + 1, weights=crossing, minlength=len(s) + 1).astype(np.int64)
                rest = [0] if counts[0] else []
                parts[0] += [doc] * (len(s) + len(rest))
                parts[1] += labels + [None] * len(rest)
                parts[2] += s.tolist() + [None] * len(rest)
                parts[3] += e.tolist() + [None] * len(rest)
                parts[4] += counts[1:].tolist() + [int(counts[0])] * len(rest)
                parts[5] += crossed[1:].tolist() + [int(crossed[0])] * len(rest)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(parts, kinds)], names=names)

    return docs.select(*columns).mapInArrow(run, "doc_id long, section string, start long, end long, n_tokens long, n_crossing long")
