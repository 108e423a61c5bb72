"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds one row for each
blob and rule version that has been scanned, with the spans found; a scan reads only the blobs that
have no row yet under the version at hand, and the ledger's rows are joined back to every path (row)
that has the blob. Texts are scanned where they are read and never shuffled: a task scans a blob once
and sends on its digest and spans, which are then brought to one row for each blob. With a ledger, the
digests of all paths are first held against it, and only texts whose digest is new are handed to the scan.

Null text counts as empty; an empty text has no findings. An empty table has none either. A null id or
source is an ordinary path, and repeated rows each get their findings. A very long text is scanned whole,
as one row of a batch of its own at most. Two scans that append to one ledger at once may both add a
blob's row; rows are equal then, and count once when read. Columns of the input other than key and text
are not read, so none clashes. Spans are code points, the end exclusive. Failed matches still use up the
text they match.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitefold.llm.common import documents, materialise


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: re.Pattern
    #: Characters that a group must have at least, else the match is dropped.
    group: int = 0
    least: int = 1
    #: A text without any of these strings cannot match; none means that it can.
    needs: tuple[str, ...] = ()
    base: bool = False


# The base patterns, in the order of their kinds, then the patterns of common providers.
RULES = (
    Rule("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8, (":", "="), True),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16, ("AKIA",), True),
    Rule("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32, (), True),
    Rule("pem", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?"), needs=("-----BEGIN",)),
    Rule("jwt", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), needs=("eyJ",)),
    Rule("github", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}"), needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"), needs=("xox",)),
    Rule("google", re.compile(r"\bAIza[A-Za-z0-9_-]{35}"), needs=("AIza",)),
    Rule("url", re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{3,64}@"), needs=("://",)),
)


def rule_version(rules=RULES) -> str:
    return hashlib.sha256(repr([(r.kind, r.pattern.pattern, r.pattern.flags, r.group, r.least) for r in rules]).encode()).hexdigest()[:16]


def find(text: str, rules=RULES) -> list[tuple[int, int, int]]:
    """(start, rule's number, end) of all findings in order."""
    found = []
    for k, r in enumerate(rules):
        if r.needs and not any(x in text for x in r.needs):
            continue
        found += [(m.start(), k, m.end()) for m in r.pattern.finditer(text) if len(m[r.group]) >= r.least]
    return sorted(found)


SPANS = "array<struct<start:int,kind:int,end:int>>"


#: Digests that a task remembers to scan a text once; beyond them it starts anew and may scan a text again.
MOST_SEEN = 200_000


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """blobs (blob, text), with repeats, to ledger rows (blob, rule_version, spans)."""
    version = rule_version(rules)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            new, spans = [], []
            for k, blob in enumerate(b.column(0).to_pylist()):
                if blob not in seen:
                    if len(seen) >= MOST_SEEN:
                        seen.clear()
                    seen.add(blob)
                    new.append(blob)
                    spans.append([{"start": s, "kind": r, "end": e} for s, r, e in find(b.column(1)[k].as_py(), rules)])
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), pa.array([version] * len(new), pa.string()), pa.array(spans, kind)], names=["blob", "rule_version", "spans"])

    rows = blobs.select("blob", "text").mapInArrow(run, f"blob binary, rule_version string, spans {SPANS}")
    return rows.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))


def read_ledger(spark, ledger: str, rules=RULES) -> DataFrame:
    """(blob, rule_version, spans) of the version at hand, each blob once."""
    rows = spark.read.parquet(ledger).where(F.col("rule_version") == rule_version(rules))
    return rows.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", ledger: str | None = None, rules=RULES) -> DataFrame:
    """key, blob and spans of every row.

    ledger: a folder that keeps the ledger between runs; new rows are appended to it. Without one the
    ledger lives for this call only.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    blob = F.unhex(F.sha2(body, 256)).alias("blob")
    paths, texts = docs.select(F.col(key), blob), docs.select(blob, body.alias("text"))
    if ledger and _exists(spark, ledger):
        unseen = paths.select("blob").distinct().join(read_ledger(spark, ledger, rules), "blob", "left_anti")
        texts = texts.join(materialise(unseen, "unseen-blobs"), "blob", "left_semi")
    rows = materialise(scan_blobs(texts, rules), "ledger")  # first aside, so that a job that fails half way adds nothing
    if ledger:
        rows.write.mode("append").parquet(ledger)
        rows = read_ledger(spark, ledger, rules)
    found = rows.where(F.size("spans") > 0).select("blob", "spans")
    return paths.join(found, "blob", "left").select(F.col(key), "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def digest(found: DataFrame, key: str = "doc_id", rules=RULES) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as one string."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    n_base = sum(r.base for r in rules)
    label = lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] < n_base)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        F.col(key),
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(rules) if r.base],
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", label), ",").alias("spans"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return digest(scan(documents(spark, sf_dir)))
