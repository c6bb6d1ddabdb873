"""Secret scan with an incremental ledger of scanned blobs (operator 1). DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorastat.llm.common import materialize, scratch_path
from agorastat.sources.storage import path_exists


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern without zero-length matches, and a condition on each match.

    ``value`` names the group that must have ``at_least`` characters. A change of any of them
    needs a new ``version``: texts are scanned again for that rule only.
    """

    kind: str
    pattern: str
    value: int = 0
    at_least: int = 1
    version: int = 1


_QUOTE = "[\"']?"

RULES = (
    Rule(
        "assign",
        rf"(?i:password|passwd|secret|token|api_?key){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)",
        value=1,
        at_least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # a run that is too short has no longer one inside
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE_KINDS = ("assign", "access", "hex")

SPANS = "array<struct<start:long,end:long>>"
CHUNK = 512  # matches folded into one list
FILTER_BITS = 1 << 28  # of the filter of paths to scan: 32 MB at most, whatever the number of paths


def spans_of(text: Column, rule: Rule) -> Column:
    """Start and end (code points) of the rule's matches that meet its condition.

    Spark gives the matched texts and, by splitting, the texts between them; their lengths
    in turn are the places. Matches are folded in chunks, so that a text with very many of them does not
    copy one growing list at each.
    """
    pattern = F.lit(rule.pattern)
    matches, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else matches
    triples = F.arrays_zip(matches.alias("m"), gaps.alias("g"), values.alias("v"))
    inner = F.filter(triples, lambda t: t["m"].isNotNull())  # the last gap has no match

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["g"])
        end = start + F.char_length(part["m"])
        span = F.struct(start.alias("start"), end.alias("end"))
        long_enough = F.char_length(part["v"]) >= rule.at_least
        return F.struct(end.alias("at"), F.when(long_enough, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    def chunk(state: Column, parts: Column) -> Column:
        begun = F.struct(state["at"].alias("at"), F.array().cast(SPANS).alias("spans"))
        folded = F.aggregate(parts, begun, step)
        return F.transform(F.array(folded), lambda f: F.struct(f["at"].alias("at"), F.array_append(state["lists"], f["spans"]).alias("lists")))[0]

    def folded(parts: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(1), F.size(parts), F.lit(CHUNK)), lambda i: F.slice(parts, i, CHUNK))
        nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPANS}>").alias("lists"))
        return F.aggregate(chunks, nothing, chunk, lambda state: F.flatten(state["lists"]))

    return F.when(text.rlike(rule.pattern), F.transform(F.array(inner), folded)[0]).otherwise(F.array().cast(SPANS))


_LEDGER = f"blob string, kind string, version int, spans {SPANS}"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at the path: one row per scanned blob and rule version, also where nothing was found."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def blobs(versions: DataFrame) -> DataFrame:
    """``(path, blob)``: the SHA-256 of each text; a null text is an empty one."""
    return versions.select("path", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("blob"))


def with_path_of(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``versions`` whose path has the hash of a path of ``wanted``, and few others; texts stay where they lie.

    The hashes are bits in maps of 4 kB, of which there are ``FILTER_BITS`` / 32,768 at most: the broadcast is bounded.
    """
    bit = F.pmod(F.xxhash64("path"), F.lit(FILTER_BITS))
    width = 32_768
    maps = wanted.select(bit.alias("_bit")).groupBy(F.expr(f"int(_bit div {width})").alias("_map"))
    maps = maps.agg(F.bitmap_construct_agg(F.col("_bit") % width).alias("_bits"))
    held = versions.withColumn("_bit", bit).withColumn("_map", F.expr(f"int(_bit div {width})")).join(F.broadcast(maps), "_map")
    byte = "conv(hex(substring(_bits, int(_bit % 32768 div 8) + 1, 1)), 16, 10)"
    return held.filter(F.expr(f"(int({byte}) & shiftleft(1, int(_bit % 8))) <> 0")).select(*versions.columns)


def scan_unseen(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, hashed: DataFrame | None = None) -> DataFrame:
    """Scan the texts of ``versions(path, text)`` that the ledger lacks, add them to it, and return its rows.

    A text is known by its SHA-256, so copies and unchanged versions are scanned once. Only
    hashes are compared; one path of each unseen blob carries its text, and only texts of such paths (and the few
    whose paths share a bit with them) are shuffled: none if nothing is unseen. ``hashed`` may give ``blobs(versions)``. The ledger
    grows by one commit at the end: a failed run leaves nothing, and a repeated one finds its rows.
    A null text is an empty one; repeated rows change nothing.
    """
    spark = versions.sparkSession
    hashed = blobs(versions) if hashed is None else hashed
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = ledger(spark, ledger_path).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    unseen = (
        hashed.groupBy("blob")
        .agg(F.min(F.struct("path")).alias("first"))
        .join(seen, "blob", "left")
        .select("blob", F.col("first.path").alias("path"), F.array_except(wanted, F.coalesce("seen", F.array_except(wanted, wanted))).alias("due"))
        .filter(F.size("due") > 0)
    )
    unseen = materialize(unseen, "unseen")
    text = F.coalesce(F.col("text"), F.lit(""))
    carried = with_path_of(versions.select("path", "text"), unseen).select("path", text.alias("text"), F.sha2(text, 256).alias("blob"))
    same = carried["path"].eqNullSafe(unseen["path"]) & (carried["blob"] == unseen["blob"])
    texts = carried.join(unseen, same).select(carried["blob"], carried["text"], "due")

    def due(rule: Rule) -> Column:
        found = F.when(F.exists("due", lambda d: (d["kind"] == rule.kind) & (d["version"] == rule.version)), spans_of(F.col("text"), rule))
        return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), found.alias("spans"))

    scanned = texts.select("blob", F.explode(F.array(*[due(r) for r in rules])).alias("r")).select("blob", "r.*")
    scanned.filter("spans IS NOT NULL").write.mode("append").parquet(ledger_path)
    return ledger(spark, ledger_path)


def findings(versions: DataFrame, scanned: DataFrame, rules: tuple[Rule, ...] = RULES, hashed: DataFrame | None = None) -> DataFrame:
    """Each path and text version with its spans by kind (``kind``, ``start``, ``end``; by start, then rule order).

    Only blobs with a finding are grouped; the paths of a blob that occurs very often meet them in
    a plain join, which adaptive execution splits.
    """
    order = {r.kind: n for n, r in enumerate(rules)}
    listed = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(order[r.kind]).alias("rank")) for r in rules])
    current = scanned.sparkSession.range(1).select(F.inline(listed))  # one row per rule
    hits = (
        scanned.filter(F.size("spans") > 0)
        .join(F.broadcast(current), ["kind", "version"])
        .dropDuplicates(["blob", "kind"])
        .select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"), F.col("kind").alias("kind"), s["end"].alias("end"))).alias("spans"))
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    )
    paths = blobs(versions) if hashed is None else hashed
    none = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")
    return paths.join(hits, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def report(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Counts and digests per document; without a path the ledger begins empty in the shared folder."""
    spark = docs.sparkSession
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    hashed = materialize(blobs(versions), "blobs")
    scanned = scan_unseen(versions, ledger_path or scratch_path(spark, "ledger"), hashed=hashed)
    found = findings(versions, scanned, hashed=hashed)
    base_kinds = ", ".join(f"'{k}'" for k in BASE_KINDS)
    parts = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        F.col("path").alias("doc_id"),
        *[F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2({parts.format(f'filter(spans, s -> s.kind IN ({base_kinds}))')}, 256) AS base_sha256"),
        F.expr(f"{parts.format('spans')} AS spans"),
        "blob",
    )
