"""Personal data by patterns and a skip-chain conditional random field (operator 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Every number pattern lies inside one such stretch, so the others run on stretches only.
_STRETCH = re.compile(r"[0-9+][ ().0-9+-]*")
# A match always takes a whole run of digits at its start, so none needs to begin inside one.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# A mention is a number or handle that might be personal data: the nodes of the field.
_MENTION = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){5,}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write"},
    "ip": {"ip", "host", "server", "address", "client"},
    "card": {"card", "visa", "mastercard", "credit", "account"},
    "phone": {"phone", "tel", "call", "mobile", "fax"},
}


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


def _luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield Span("email", start, done)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The four patterns, leftmost and non-overlapping per kind, by start and then kind."""
    found = list(_emails(text))
    for stretch in _STRETCH.finditer(text):
        if stretch.end() - stretch.start() < 7:  # 1.1.1.1 is the shortest
            continue
        bounds = stretch.span()
        for m in _IP.finditer(text, *bounds):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(Span("ip", *m.span()))
        for m in _CARD.finditer(text, *bounds):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(Span("card", *m.span()))
        for m in _PHONE.finditer(text, *bounds):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


@dataclass
class Field:
    """The nodes of one document: mentions in order, their labels as far as the patterns know them,
    their features as bits, and links to the next mention with the same key."""

    spans: list[tuple[int, int]]
    labels: np.ndarray
    features: np.ndarray
    skips: list[tuple[int, int]]


N_FEATURES = 15


def _features(text: str, start: int, end: int, handle: bool) -> int:
    shown = text[start:end]
    digits = "".join(_DIGIT.findall(shown))
    parts = shown.split(".")
    words = {w.strip(".,:;()").lower() for w in _WORD.findall(text[max(0, start - 40) : start])[-3:]}
    bits = [
        True,
        handle,
        "@" in shown,
        len(digits) < 9,
        9 <= len(digits) <= 11,
        12 <= len(digits) <= 15,
        16 <= len(digits) <= 19,
        shown.startswith("+"),
        "(" in shown,
        len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        12 <= len(digits) <= 19 and _luhn(digits),
        *[bool(words & CUES[k]) for k in KINDS],
    ]
    return sum(1 << i for i, b in enumerate(bits) if b)


TAIL = 9  # digits at the end by which phone numbers are the same, with or without country code and leading zeros
_MARKS = frozenset("._%+-")


def _keys(shown: str, phone: bool) -> tuple[str, ...]:
    """What a number is linked by: all its digits (an address: as shown), and for phone numbers and the like their last ones."""
    if shown.count(".") == 3 and not phone:
        return (shown,)
    digits = "".join(_DIGIT.findall(shown))
    return (digits, f"tail {digits[-TAIL:]}") if phone else (digits,)


def _parts(text: str, start: int, end: int, tails: dict[str, list[str]]) -> Iterator[tuple[int, int]]:
    """A mention, or the phone numbers known from patterns that stand in it and what is left around them."""
    places = [m.start() for m in _DIGIT.finditer(text, start, end)]
    digits = "".join(text[p] for p in places)
    done, cut = 0, start
    for i in range(len(digits) - TAIL + 1) if tails else ():
        last = i + TAIL - 1
        if i < done or digits[i : i + TAIL] not in tails or (last + 1 < len(places) and places[last + 1] == places[last] + 1):
            continue
        first = i
        for known in tails[digits[i : i + TAIL]]:  # as far back as the digits of a known number go
            n = 0
            while n < min(i - done, len(known) - TAIL) and digits[i - n - 1] == known[-TAIL - n - 1]:
                n += 1
            first = min(first, i - n)
        while first > done and places[first - 1] == places[first] - 1:
            first -= 1
        at = places[first] if first > done else cut
        while first > done and at > cut and text[at - 1] in "(+":
            at -= 1
        yield from (m.span() for m in _MENTION.finditer(text, cut, at))
        yield at, places[last] + 1
        done, cut = last + 1, places[last] + 1
    yield from (m.span() for m in _MENTION.finditer(text, cut, end))


def field_of(text: str, base: list[Span]) -> Field:
    """The nodes of a text. A mention that touches a pattern's span is that span; the part of an
    address before its @ is searched as a handle of five characters or more. Numbers are linked by all
    digits, those of 9 to 15 also by their last nine."""
    nodes: dict[tuple[int, int], tuple[int, tuple[str, ...], bool]] = {}
    covered = sorted((s.start, s.end) for s in base)
    starts = [s for s, _ in covered]
    furthest = np.maximum.accumulate([e for _, e in covered]) if covered else np.zeros(0, int)

    def free(start: int, end: int) -> bool:
        i = int(np.searchsorted(starts, end))  # spans that start before the end
        return i == 0 or furthest[i - 1] <= start

    handles = {}
    tails: dict[str, list[str]] = {}
    for s in base:
        shown = text[s.start : s.end]
        if s.kind == "email":
            keys: tuple[str, ...] = (shown.split("@")[0],)
            if len(keys[0]) >= 5:
                handles.setdefault(keys[0], s)
        else:
            keys = (shown,) if s.kind == "ip" else _keys(shown, s.kind == "phone")
            if s.kind == "phone" and keys[0] not in tails.setdefault(keys[0][-TAIL:], []):
                tails[keys[0][-TAIL:]].append(keys[0])
        nodes[(s.start, s.end)] = (LABELS.index(s.kind), keys, False)
    for m in _MENTION.finditer(text):
        if free(*m.span()):
            for a, b in _parts(text, *m.span(), tails):
                size = len(_DIGIT.findall(text[a:b]))
                nodes.setdefault((a, b), (0, _keys(text[a:b], TAIL <= size <= 15), False))
    if handles:
        wanted = re.compile("|".join(re.escape(h) for h in sorted(handles, key=lambda h: (-len(h), h))))
        for m in wanted.finditer(text):
            a, b = m.span()
            after = b
            while after < len(text) and text[after] in _MARKS:  # the end of a sentence
                after += 1
            inside = (a and text[a - 1] in _LOCAL) or (after < len(text) and (text[after] in _LOCAL or text[after] == "@"))
            if not inside and free(a, b):
                nodes.setdefault((a, b), (0, (m[0],), True))
    order = sorted(nodes)
    last: dict[str, int] = {}
    skips = []
    for i, span in enumerate(order):
        keys = nodes[span][1]
        skips += [(j, i) for j in sorted({last[k] for k in keys if k in last})]
        last.update(dict.fromkeys(keys, i))
    return Field(
        order,
        np.array([nodes[s][0] for s in order], np.int64),
        np.array([_features(text, *s, nodes[s][2]) for s in order], np.int64),
        skips,
    )


@dataclass(frozen=True)
class Model:
    """Log-potentials: of labels by feature, of neighbouring labels, and the reward of equal entity
    labels (and cost of an entity beside none) on a skip link."""

    weights: np.ndarray
    chain: np.ndarray
    consistency: float = 6.0


def _bits(features: np.ndarray) -> np.ndarray:
    return ((features[:, None] >> np.arange(N_FEATURES)) & 1).astype(np.float64)


def fit(docs: DataFrame, text_col: str = "text", steps: int = 400) -> Model:
    """Piecewise training on the patterns' own labels in all documents.

    Only counts reach the driver: of each pair of feature bits and label, and of neighbouring
    labels, so their number does not grow with the documents. Node weights come from
    multinomial regression, the chain from the log-odds of neighbours. No mention gives
    weights of zero.
    """

    def count(batches):
        for batch in batches:
            totals: dict[tuple[int, int, int], int] = {}
            for text in batch.column(0).to_pylist():
                if text is None or not ("@" in text or _DIGIT.search(text)):
                    continue
                f = field_of(text, base_spans(text))
                rows = [(0, int(x), int(y)) for x, y in zip(f.features, f.labels)]
                rows += [(1, int(x), int(y)) for x, y in zip(f.labels, f.labels[1:])]
                for row in rows:
                    totals[row] = totals.get(row, 0) + 1
            rows = [(*k, n) for k, n in sorted(totals.items())]
            columns = [list(c) for c in zip(*rows)] if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["what", "x", "y", "n"])

    counted = docs.select(text_col).mapInArrow(count, "what long, x long, y long, n long")
    rows = counted.groupBy("what", "x", "y").agg(F.sum("n").alias("n")).orderBy("what", "x", "y").toArrow().to_pydict()
    what, x, y, n = (np.array(rows[c], np.int64) for c in ("what", "x", "y", "n"))
    weights, chain = np.zeros((N_FEATURES, len(LABELS))), np.ones((len(LABELS), len(LABELS)))
    node = what == 0
    if node.any():
        features, target, share = _bits(x[node]), np.eye(len(LABELS))[y[node]], n[node] / n[node].sum()
        for _ in range(steps):
            z = features @ weights
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights += 2.0 * (features.T @ ((target - p) * share[:, None]) - 1e-4 * weights)
    np.add.at(chain, (x[~node], y[~node]), n[~node])
    chain /= chain.sum()
    return Model(weights, np.log(chain / (chain.sum(axis=1, keepdims=True) * chain.sum(axis=0, keepdims=True))))


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]


def marginals(field: Field, model: Model, rounds: int = 20, damping: float = 0.3) -> np.ndarray:
    """Label probabilities by loopy message passing over chain and skip links; pattern labels are held."""
    n, k = len(field.labels), len(LABELS)
    node = _bits(field.features) @ model.weights
    held = field.labels > 0
    node[held] = -30.0
    node[held, field.labels[held]] = 0.0
    skip = np.zeros((k, k))
    skip[1:, 1:] = model.consistency * np.eye(k - 1)
    skip[0, 1:] = skip[1:, 0] = -model.consistency
    chain_links = np.stack([np.arange(n - 1), np.arange(1, n)], axis=1)
    links = np.concatenate([chain_links, np.array(field.skips, np.int64).reshape(-1, 2)])
    pair = np.concatenate([np.repeat(model.chain[None], n - 1, axis=0), np.repeat(skip[None], len(field.skips), axis=0)])
    source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    half = len(links)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    message = np.zeros((2 * half, k))
    for _ in range(rounds):
        belief = node.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        new = np.stack([_log_sum(out + pair[:, :, j]) for j in range(k)], axis=1)
        new -= new.max(axis=1, keepdims=True)
        message = damping * message + (1 - damping) * new
    belief = node.copy()
    np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _tied(field: Field) -> np.ndarray:
    """Whether skip links lead from each mention, directly or over others, to a pattern's span."""
    least = list(range(len(field.labels)))

    def top(i: int) -> int:
        while least[i] != i:
            least[i] = least[least[i]]
            i = least[i]
        return i

    for i, j in field.skips:
        least[top(max(i, j))] = top(min(i, j))
    tops = np.array([top(i) for i in range(len(least))], np.int64)
    return np.isin(tops, tops[field.labels > 0])


def find(text: str | None, model: Model, at_least: float = 0.5) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and those that the field adds.

    A mention is added if skip links lead from it to a pattern's span and its likeliest label is an
    entity with more than ``at_least``. Repeats that no link ties to a span are never added, whatever
    else the text holds, so the field runs only where an open link to a span can exist.
    """
    if not text or not ("@" in text or _DIGIT.search(text)):
        return [], []
    base = base_spans(text)
    if not base:
        return base, []
    field = field_of(text, base)
    if all(field.labels[i] and field.labels[j] for i, j in field.skips):
        return base, []
    tied = _tied(field)
    if not (tied & (field.labels == 0)).any():
        return base, []
    p = marginals(field, model)
    added = []
    for i, (start, end) in enumerate(field.spans):
        label = int(p[i].argmax())
        if field.labels[i] == 0 and tied[i] and label and p[i, label] > at_least:
            added.append(Span(LABELS[label], start, end))
    return base, added


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def detect(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the patterns' spans and all spans (arrays of kind, start, end in code points) of each whole text.

    A null text has none. Map only, apart from the counts of ``fit``.
    """
    model = model or fit(docs, text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": s.kind, "start": s.start, "end": s.end} for s in spans]

    def run(batches):
        for batch in batches:
            base, every = [], []
            for text in batch.column(1).to_pylist():
                own, added = find(text, model)
                base.append(rows(own))
                every.append(rows(sorted(own + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(every, span)], names=["doc_id", "base", "spans"]
            )

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests per document, from ``detect``."""

    def text_of(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = detect(docs)
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(text_of("base"), 256).alias("base_sha256"), text_of("spans").alias("spans"))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, overlapping ones together, replaced by its kind as ``<EMAIL>``."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for s in spans:
        if s.start >= at:
            parts += [text[at : s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with personal data masked in ``text`` and ``n_chars`` counted anew, other columns as they are."""
    model = model or fit(docs)
    names = docs.columns
    inner = docs.toDF(*[f"_d{i}" for i in range(len(names))])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in inner.schema.fields])
    place = names.index("text")
    counted = names.index("n_chars") if "n_chars" in names else -1

    def run(batches):
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                base, added = find(text, model)
                texts.append(masked(text, sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))))
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            if counted >= 0:
                sizes = [None if t is None else len(t) for t in texts]
                columns[counted] = pa.array(sizes, columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return inner.mapInArrow(run, schema).toDF(*names)
