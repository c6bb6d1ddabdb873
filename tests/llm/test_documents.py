"""Quality, packing, suffix dedup, decontamination, SimHash, licences and the pipeline against brute force."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from agorastat.llm import decontamination, licenses, packing, pii, quality, queries, simhash, substrings
from agorastat.llm.components import components
from agorastat.llm.tokens import public_path, word_ids
from bindings.check import TABLES

SPACES = r"[^\x20\x09-\x0D]+"
FOLDER = "/root/testdata/sf0.001"

HARD = [None, "", " \n ", "a", "word " * 30_000, "x y z " * 5, "é𝄞 ß", "tie tie tie tie tie tie", "tie tie tie tie tie tie"]


def frame(spark, texts):
    """Documents with nulls, a repeated row and columns whose names clash with inner ones."""
    rows = [(i, t, f"s{i % 2}" if i % 5 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, source string")
    return df.selectExpr("*", "'de' AS lang", "9L AS n_chars", "1 AS fp", "2 AS node", "3 AS host", "4 AS length", "5 AS _text", "6 AS _item")


def metrics_by_hand(text):
    words = re.findall(SPACES, text or "")
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACES, x)]
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b\x1cé#", max_size=80) | st.none(), max_size=8))
def test_quality_counts(texts):
    got = quality.text_metrics(pa.array(texts, pa.string()))
    assert list(zip(*[got[m].tolist() for m in quality.METRICS])) == [metrics_by_hand(t) for t in texts]


def test_quality_hosts(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", "junk") for i in range(40)] + [(40, good, "junk")] + [(100 + i, good, "fine") for i in range(40)] + [(200, good, None), (201, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS host", "2 AS n_words")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(docs).collect()}
    assert not any(kept[i] for i in range(41)) and all(kept[100 + i] for i in range(40)) and kept[200] and not kept[201]
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == {d for d, k in kept.items() if k}
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.quality_verdicts(docs.limit(0)).count() == 0
    assert quality.quality_verdicts(frame(spark, HARD)).count() == len(HARD) + 1


def test_word_ids_are_the_tokenizers(spark):
    memory = word_ids(public_path(packing.VOCABULARY))
    texts = ["a's b'ST 'Re ' ' ''s it's!'ve 9a1 ½ ª² µm ×÷ é é \x1c\x1d x y <|endoftext|> a<|endoftext|>b ÀÉß İI ΑΣ ᾳ ſ K", "", " \n", "a\x0bb\x0cc\rd \x7f", "x" * 500]
    got = [np.frombuffer(b, "<u4").tolist() for b in memory.texts_ids(pa.array(texts))]
    assert got == [memory.whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB' s\nt1,!é´́<|>µ", max_size=30))
def test_word_ids_of_any_text(text):
    memory = word_ids(public_path(packing.VOCABULARY))
    assert np.frombuffer(memory.texts_ids(pa.array([text]))[0], "<u4").tolist() == memory.whole.encode(text, add_special_tokens=False).ids


def least_bins(sizes, capacity):
    """Exact by search."""
    best = [len(sizes)]

    def place(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + rest[0] <= capacity:
                place(rest[1:], bins[:i] + [bins[i] + rest[0]] + bins[i + 1 :])
        place(rest[1:], bins + [rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_bounds_and_best_fit(sizes):
    sizes = np.array(sizes, np.int64)
    bins, offsets, opened = packing.best_fit_decreasing(sizes, 20)
    fill = np.bincount(bins, weights=sizes, minlength=opened) if len(sizes) else np.zeros(0)
    assert (fill <= 20).all()
    assert packing.lower_bound(sizes, 20) <= least_bins(sizes.tolist(), 20) <= opened


def check_layout(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark):
    whole = word_ids(public_path(packing.VOCABULARY)).whole
    rows = packing.pack(packing.token_pieces(frame(spark, HARD))).collect()
    check_layout(rows, 4096)
    for i, text in enumerate(HARD[:-1]):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i)
        cut = [ids[s : s + 4096] for s in range(0, len(ids), 4096)]
        assert mine == [(n, 4096 * n, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for n, c in enumerate(cut)]
    assert packing.pack(packing.token_pieces(frame(spark, HARD)).limit(0)).count() == 0


def test_packing_in_small_groups_exchanges_pieces(spark):
    rng = random.Random(1)
    sizes = [rng.choice([7, 11, 13, 30, 51, 60]) for _ in range(600)]
    pieces = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long")
    alone = check_layout(packing.pack(pieces, 100, rounds=1, per_group=40).collect(), 100)
    rows = packing.pack(pieces, 100, rounds=4, per_group=40).collect()
    assert sorted(r["length"] for r in rows) == sorted(sizes)
    assert packing.lower_bound(np.array(sizes), 100) <= check_layout(rows, 100) <= alone


def repeats_by_hand(docs, length):
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        covered = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                covered[i : i + length] = True
            seen.add(raw[i : i + length])
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        out[doc] = (len(raw), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("limits", [{}, {"many": 2}, {"hot_rows": -(10**9)}, {"filter_bits": 0}, {"filter_bits": 0, "many": 2}])
def test_repeated_strings(spark, limits, monkeypatch):
    monkeypatch.setattr(substrings, "SORTED_BYTES", 3000)
    rng = random.Random(7)
    words = ["aaaa", "abcabc", "x", "the cat", "\0\0", "é", ".", "\n"]
    piece = lambda: "".join(rng.choice(words) * rng.randint(1, 12) for _ in range(rng.randint(0, 30)))
    shared = [piece() for _ in range(6)]
    docs = [(i, "".join(rng.choice([piece()[:20], *rng.sample(shared, 2)]) for _ in range(rng.randint(0, 5)))) for i in range(150)]
    docs += [(1000, ""), (1001, None), (1002, "a" * 5000), (1003, "ab" * 3000)]
    df = spark.createDataFrame(docs + docs[-1:], "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS ranges")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.remove_repeats(df, 40, 12, **limits).collect()}
    assert got == repeats_by_hand(docs, 40)
    if not limits:  # without a repeated id no text is numbered
        again = substrings.remove_repeats(df.dropDuplicates(["doc_id"]), 40, 12)
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in again.collect()} == got


def test_different_texts_under_one_id_keep_their_own_bytes(spark):
    rng = random.Random(3)
    unique = lambda: "".join(rng.choice("abcdefgh") for _ in range(312))
    first, other, third = unique(), unique(), unique()
    rows = [(1, first), (5, first), (5, other), (None, third), (None, unique()), (9, third), (9, third)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_bytes=True).collect()
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in found)
    assert got == [("1", 0), ("5", 0), ("5", 312), ("9", 312), ("9", 312), ("None", 0), ("None", 0)]
    assert {bytes(r["kept"]).decode() for r in found if r["doc_id"] == 5} == {"", other}


def test_repeated_strings_of_no_documents(spark):
    docs = frame(spark, HARD)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
    assert substrings.remove_repeats(docs.selectExpr("CAST(null AS long) AS doc_id", "text")).count() == len(HARD) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12))
def test_suffix_order(parts):
    depth = 16
    text = np.frombuffer(b"".join(p + bytes(depth) for p in parts) + bytes(depth), np.uint8)
    real = np.frombuffer(b"".join(b"\1" * len(p) + bytes(depth) for p in parts) + bytes(depth), np.uint8) > 0
    order, raw = substrings.suffix_order(text, real, depth), text.tobytes()
    shown = [raw[i : i + depth] for i in order]
    assert shown == sorted(shown) and sorted(order) == np.flatnonzero(real).tolist()
    prefixes = substrings.common_prefixes(text, order, depth)
    for k in range(1, len(order)):
        pairs = zip(shown[k - 1], shown[k])
        assert prefixes[k] == next((i for i, (x, y) in enumerate(pairs) if x != y), depth)


def contamination_by_hand(docs, items, width):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for item, text in items:
        w = split(text)
        windows |= {(str(item), tuple(w[i : i + width])) for i in range(max(1, len(w) - width + 1)) if w}
    out = []
    for _, text in docs:
        w, hit, found = split(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [100_000, 3])
def test_contamination(spark, block):
    rng = random.Random(3)
    word = lambda: rng.choice(["A", "a", "b", "B1", "é", "x-y", "c.", "\n"])
    items = [(1, "a b"), (2, "a b B1 é x y c"), (3, None), (4, "!?"), (5, "a"), (12, " ".join(word() for _ in range(8))), (12, "c c c")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 25)))) for i in range(60)] + [(100 + i, t) for i, t in enumerate(HARD[:4])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS items", "2 AS _hits")
    bench = spark.createDataFrame(items, "item_id long, text string")
    marked = decontamination.mark_contamination(df, bench, 4, block).collect()
    by_hand = dict(zip([d for d, _ in docs], contamination_by_hand(docs, items, 4)))
    assert len(marked) == len(docs)
    for r in marked:
        hit = sum(x["e"] - x["s"] for x in r[-2])
        assert (r["n_words"], hit, len(r[-1]), hashlib.sha256(",".join(r[-1]).encode()).hexdigest()) == by_hand[r["doc_id"]], r
    assert not decontamination.contamination_report(df, bench.limit(0)).filter("contaminated").count()
    assert decontamination.contamination_report(df.limit(0), bench).count() == 0
    clean = decontamination.drop_contaminated(df, bench.limit(1))
    assert clean.columns == df.columns


def fingerprint_by_hand(text):
    words = re.findall(SPACES, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(fps):
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None], len(fps)).min(1)
        if (least == label).all():
            return label
        label = least


def test_fingerprints():
    rng = random.Random(2)
    texts = HARD + [" ".join(rng.choice("aBcÉ\x1c") for _ in range(rng.randint(0, 900))) for _ in range(40)]
    assert simhash.fingerprints_of(pa.array(texts, pa.string())).tolist() == [fingerprint_by_hand(t) for t in texts]


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 20])
def test_hamming_groups(spark, crowded):
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 30, dtype=np.uint64)[rng.integers(0, 30, 1500)]
    for _ in range(5):
        fps = fps ^ np.where(rng.random(1500) < 0.5, np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64), np.uint64(0))
    fps = np.unique(fps)
    nodes = spark.createDataFrame([(i, int(v)) for i, v in enumerate(fps.view(np.int64))], "node long, fp long")
    label = np.arange(len(fps))
    for r in components(simhash.hamming_links(nodes, crowded=crowded)).collect():
        label[r["node"]] = r["component"]
    assert (label == groups_by_hand(fps)).all()


def test_near_duplicates(spark):
    docs = frame(spark, HARD)
    rows = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    fps = np.array([fingerprint_by_hand(t) for t in HARD], np.uint64)
    assert rows == {i: (f"{f:016x}", g) for i, (f, g) in enumerate(zip(fps.tolist(), groups_by_hand(fps).tolist()))}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups_by_hand(fps).tolist()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    nameless = docs.selectExpr("CAST(null AS long) AS doc_id", "text")
    assert simhash.near_duplicates(nameless).filter("component_id IS NULL").count() == len(HARD) + 1


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(400)]
    near = " ".join([*words[:399], "other"])
    copy, lone = " ".join(words), " ".join(f"v{i}" for i in range(50))
    assert bin(fingerprint_by_hand(copy) ^ fingerprint_by_hand(near)).count("1") <= 3
    rows = [(1, copy), (1, copy), (2, near), (None, copy), (None, near), (5, lone), (5, copy), (None, "only here"), (None, "only here"), (7, "plain text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS label")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, copy), (5, lone), (None, "only here"), (7, "plain text")], key=str)
    assert simhash.keep_one(docs.filter("doc_id IS NULL")).count() == 2


def test_a_row_without_id_links_others(spark, monkeypatch):
    fps = {"a": 0, "b": 0b111, "c": 0b111111}
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs.replace({k: str(v) for k, v in fps.items()}, subset="text").selectExpr("doc_id", "CAST(text AS long) AS fp"))
    docs = spark.createDataFrame([(4, "a"), (None, "b"), (3, "c")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {3}


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 300)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 500: 300}


def test_licenses(spark):
    mit = dict(licenses.NOTICES)["MIT"]
    texts = [*HARD, mit.upper(), f"x\n\n{mit[:200]}\n{mit[200:]}\n \nend", "Released under a MIT License.", "RELEASED, under the mit license", "license"]
    found = {(r["doc_id"], r["part"], r["number"]): r["license"] for r in licenses.license_findings(frame(spark, texts).drop("length")).collect()}
    assert found[(9, "line", 0)] == "MIT" and found[(10, "paragraph", 1)] == "MIT" and (12, "line", 0) in found and len(found) == 3
    assert licenses.license_findings(frame(spark, HARD)).count() == 0


def windows_by_hand(text, notices):
    """The best similarity of any window within the size bounds, per template."""
    words = licenses.normalised(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    best = {}
    for n, (_, notice) in enumerate(notices):
        own = licenses.template_bigrams(notice)
        low, high = licenses.size_bounds(len(own), 0.8)
        for i in range(len(pairs)):
            for size in range(low, min(high, len(pairs) - i) + 1):
                window = set(pairs[i : i + size])
                best[n] = max(best.get(n, 0), 2 * len(window & own) / (len(window) + len(own)))
    return {n: s for n, s in best.items() if s >= 0.8}


def test_licenses_inside_lines_and_comments(spark):
    notices = dict(licenses.NOTICES)
    whole = dict(licenses.whole_licenses())
    commented = "\n".join(f" * {x}" for x in whole["MIT"].splitlines())
    gpl = "\n".join(f"# {x}" for x in (notices["GPL-3.0"] + " This program is distributed in the hope that it will be useful.").split("you can"))
    texts = [
        "Released under the MIT License. See LICENSE for details.", f"/*\n{commented}\n */\nint main;", gpl, "x " * 50 + whole["Apache-2.0"] + " y" * 50,
        f"{whole['GPL-3.0']}", "no license here, the mit is a school", f"{notices['CC-BY-NC-4.0']} {'a ' * 30} {notices['MPL-2.0']}", *HARD,
    ]
    rows = licenses.license_windows(frame(spark, texts)).collect()
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append((r["license"], r["similarity"]))
    assert found[0] == [("MIT", 1.0)] and found[1] == [("MIT", 1.0)] and [x for x, _ in found[2]] == ["GPL-3.0"]
    assert [x for x, _ in found[3]] == ["Apache-2.0"] and "GPL-3.0" in dict(found[4]) and sorted(x for x, _ in found[6]) == ["CC-BY-NC-4.0", "MPL-2.0"]
    assert set(found) == {0, 1, 2, 3, 4, 6}


def test_license_windows_match_brute_force(spark):
    rng = random.Random(8)
    chosen = [licenses.NOTICES[i] for i in (0, 3, 6, 10)]
    texts = []
    for _ in range(60):
        words = []
        for _, notice in rng.choices(chosen, k=2):
            words += [rng.choice("abc") for _ in range(rng.randint(0, 9))]
            words += [w if rng.random() > 0.06 else rng.choice(["the", "x", ""]) for w in licenses.normalised(notice)]
        texts.append(rng.choice([" ", "\n# ", " * "]).join(words))
    for n, notice in enumerate(chosen):
        expected = {(i, s) for i, t in enumerate(texts) for s in windows_by_hand(t, [notice]).values()}
        best = {}
        for r in licenses.license_windows(frame(spark, texts), [notice]).collect():
            best[r["doc_id"]] = max(best.get(r["doc_id"], 0), r["similarity"])
        assert {(i, round(s, 9)) for i, s in best.items()} == {(i, round(s, 9)) for i, s in expected}, n


def best_window(text, notice, most=None):
    """The best similarity of windows of up to ``most`` bigrams, without it of any length."""
    words = licenses.normalised(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    own, best = licenses.template_bigrams(notice), 0.0
    for i in range(len(pairs)):
        window, shared = set(), 0
        for pair in pairs[i : i + (most or len(pairs))]:
            shared += pair in own and pair not in window
            window.add(pair)
            best = max(best, 2 * shared / (len(window) + len(own)))
    return round(best, 9)


@pytest.mark.parametrize("parts", [licenses.MOST_TEMPLATES, 1])
def test_long_license_windows_match_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(licenses, "MOST_TEMPLATES", parts)  # templates in one pass, or each in its own
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(60)]
    first = " ".join(rng.choice(vocabulary) for _ in range(330))
    numbered = [f"term{i}" for i in range(401)]  # 400 bigrams
    second = " ".join(numbered)
    assert all(len(licenses.template_bigrams(t)) > licenses.LONG for t in (first, second))
    texts = [second, " ".join(["x", "y"] * 40 + numbered[:100] + ["z"] * 1 + numbered[101:272] + ["x", "y"] * 40)]
    # 270 of 275 bigrams are shared, which makes exactly 0.8 in one window only
    cut = numbered[:100] + ["p", "q"] + numbered[101:173] + ["r"] + numbered[173:276]
    texts += [" ".join(["x"] * 30 + cut[:n] + ["y"] * 30) for n in range(270, 279)]
    for _ in range(14):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        for _ in range(rng.choice([1, 1, 2])):
            words += [w if rng.random() > rng.choice([0.02, 0.06, 0.09]) else rng.choice(["x", *vocabulary]) for w in first.split()[rng.randint(0, 70) :]]
            words += [rng.choice(["a", "b", *vocabulary]) for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(words))
    notices = [("first", first), ("second", second)]
    most = {n: licenses.size_bounds(len(licenses.template_bigrams(notice)), 0.8)[1] for n, notice in notices}
    bounded = {(i, n): best_window(t, notice, most[n]) for i, t in enumerate(texts) for n, notice in notices}
    found = {}
    for r in licenses.license_windows(frame(spark, texts), notices).collect():
        key = r["doc_id"], r["license"]
        found[key] = max(found.get(key, 0), round(r["similarity"], 9))
        words = licenses.normalised(texts[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]]
        inside, own = licenses.template_bigrams(" ".join(words)), licenses.template_bigrams(dict(notices)[r["license"]])
        assert abs(r["similarity"] - 2 * len(inside & own) / (len(inside) + len(own))) < 1e-9
    # A window that repeats bigrams may be longer than its distinct ones: such may be found too, none within the bounds may be lost.
    assert set(found) == {k for k, b in bounded.items() if b >= 0.8} and len(found) > 12 and min(found.values()) < 0.83
    assert all(bounded[k] == s or bounded[k] < s <= best_window(texts[k[0]], dict(notices)[k[1]]) for k, s in found.items())
    assert all(bounded[k] == s for k, s in found.items() if k[1] == "second")


def test_telling_pattern_is_the_list_of_words():
    rng = random.Random(3)
    words = ["a", "ab", "abc", "b", "licence", "license", "licensed", "é", "éa"]
    for chosen in (words, words[:1], words[4:7], words[7:]):
        for _ in range(200):
            text = "".join(rng.choice("abcliencsd é") for _ in range(rng.randint(1, 4))) + rng.choice(["", *words])
            assert bool(re.fullmatch(licenses.one_of(chosen), text)) == (text in chosen)


def test_license_bounds_lose_nothing():
    rng = random.Random(4)
    for _, text in licenses.NOTICES:
        own, telling = licenses.template_bigrams(text), set(licenses.telling_words(text, 0.8))
        for _ in range(50):
            words = [w for w in licenses.normalised(text) if rng.random() > 0.12] + ["x"] * rng.randint(0, 3)
            other = licenses.template_bigrams(" ".join(words))
            if 2 * len(own & other) / max(1, len(own) + len(other)) >= 0.8:
                low, high = licenses.size_bounds(len(own), 0.8)
                assert low <= len(other) <= high and telling & set(words)


def test_pipeline_against_brute_force(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text, source FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    good = []
    for doc, text, _ in docs:
        n, _, _, _, repeats = metrics_by_hand(text)
        if n >= 10 and 100 * repeats <= 20 * n:
            good.append((doc, text))
    fps = np.array([fingerprint_by_hand(t) for _, t in good], np.uint64)
    single = [good[i] for i in sorted(set(groups_by_hand(fps).tolist()))]
    clean = [d for d, c in zip(single, contamination_by_hand(single, items, 10)) if not c[1]]
    assert 0 < len(clean) < len(single) < len(good) < len(docs)
    whole = word_ids(public_path(packing.VOCABULARY)).whole
    expected = []
    for doc, text in clean:
        masked = pii.masked(text, pii.base_spans(text))
        ids = whole.encode(masked, add_special_tokens=False).ids + [1]
        expected += [(doc, s // 4096, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for s in range(0, len(ids), 4096)]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    check_layout(rows, 4096)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, expected))
