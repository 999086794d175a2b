"""Operator 10: secret scans over an incremental, content-addressed blob ledger.

Every version of a path is addressed by the SHA-256 of its text. The ledger, a
Parquet table on shared storage partitioned by rule version, holds the
findings of each (blob, rule version) pair ever scanned. A run scans only the
pairs that the ledger lacks, appends them, and joins all findings back to
every path that holds the blob.

Scale: a run that meets a ledger asks it with the addresses alone first, and
reads the texts of unseen blobs only. Each task ships a blob's compressed text
at most once, so a text that a third of all paths share reaches the shuffle
once per task; copies are then scanned once. Paths shuffle as (ids, 32-byte
address) only.

Edge cases: a null text is the empty blob; null and repeated ids are paths of
their own; an empty table scans nothing; extra columns are ignored, clashing
names cannot meet since the join sees renamed keys only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stage_table
from contrail.operators.joins import maybe_broadcast
from contrail.sources.tables import read_or_empty

#: Version of the rules below; a new one makes every blob unseen again.
RULE_VERSION = "1"
#: Kinds in the order that breaks ties between spans of equal start; the first three are base kinds.
KINDS = ("assign", "access", "hex", "pem", "token")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_TOKEN = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,})", re.ASCII)

BLOBS = "blob binary, packed binary"
FINDINGS = "blob binary, spans array<struct<start: int, rank: int, end: int>>"


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of every finding in ``text``, sorted."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [(m.start(), 3, m.end()) for m in _PEM.finditer(text)]
    if "_" in text or "xox" in text or "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text)]
    return sorted(out)


def address(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _pack_blobs(batches):
    """(address, compressed text) of each blob's first row in this task."""
    import hashlib

    import pyarrow as pa
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    seen: set[bytes] = set()
    for batch in batches:
        blobs, packed = [], []
        for value in batch.column(0):
            raw = (value.as_py() or "").encode()
            blob = hashlib.sha256(raw).digest()
            if blob not in seen:
                seen.add(blob)
                blobs.append(blob)
                packed.append(squeeze(raw))
        yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(packed, pa.binary())],
                                         names=["blob", "packed"])


def _scan_blobs(batches):
    import pyarrow as pa
    import zstandard

    kind = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        spans = [[{"start": s, "rank": k, "end": e} for s, k, e in find_spans(unpack(v.as_py()).decode())]
                 for v in batch.column("packed")]
        yield pa.RecordBatch.from_arrays([batch.column("blob").cast(pa.binary()), pa.array(spans, kind)],
                                         names=["blob", "spans"])


def read_ledger(spark, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of the rule version: blob, spans (empty before the first scan).

    A blob that two runs at once have appended is one row: both found the same.
    """
    rows = read_or_empty(spark, f"{ledger}/rule_version={rule_version}", FINDINGS)
    return rows.groupBy("blob").agg(F.first("spans").alias("spans"))


def unseen_texts(versions: DataFrame, ledger: str, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame | None:
    """Texts whose blobs the ledger lacks; None if it has them all.

    The ledger is asked with addresses only, each task's once; texts are read
    again for the blobs that it lacks.
    """
    spark = versions.sparkSession
    known = read_or_empty(spark, f"{ledger}/rule_version={rule_version}", FINDINGS)
    texts = versions.select(F.col(text_col).alias("text"))
    if known.isEmpty():
        return texts
    addresses = texts.select(address(F.col("text")).alias("blob")).distinct()
    lacking = stage_table(addresses.join(known.select("blob"), "blob", "left_anti"), "unseen")
    n = lacking.count()
    if not n:
        return None
    return texts.join(maybe_broadcast(lacking, n), address(F.col("text")) == F.col("blob"), "left_semi")


def scan_unseen(versions: DataFrame, ledger: str, text_col: str = "text", rule_version: str = RULE_VERSION) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks and append their findings to it."""
    texts = unseen_texts(versions, ledger, text_col, rule_version)
    if texts is None:
        return
    blobs = texts.mapInArrow(_pack_blobs, BLOBS).groupBy("blob").agg(F.first("packed").alias("packed"))
    blobs.mapInArrow(_scan_blobs, FINDINGS).write.mode("append").parquet(f"{ledger}/rule_version={rule_version}")


def scan(versions: DataFrame, ledger: str, path_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
         rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of every path: ``path_cols`` and spans (start, rank of the kind, end; code points)."""
    scan_unseen(versions, ledger, text_col, rule_version)
    # Written, so that the join reads two exchanges and adaptive execution can split a blob that many paths hold.
    found = stage_table(read_ledger(versions.sparkSession, ledger, rule_version)
                        .select(F.col("blob").alias("_blob"), "spans"), "findings")
    paths = versions.select(*path_cols, address(F.col(text_col)).alias("_address"))
    return (paths.join(found, F.col("_address") == F.col("_blob"), "left")
            .select(*path_cols, F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans")))


def _of_rank(rank: int):
    return lambda s: s["rank"] == rank


def digest(found: DataFrame, path_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts per base kind, hash of the base spans, and all spans as text."""
    kinds = F.array(*map(F.lit, KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("spans", _of_rank(k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(BASE_KINDS)]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(*path_cols, *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
