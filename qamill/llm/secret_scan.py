"""Secrets in texts: known patterns, and random strings found by token efficiency.

Ordinary text takes few tokens of a byte-pair vocabulary for its characters;
random strings take many.  Runs of 20 or more characters of base64 and
identifier alphabets are candidates; known digests, UUIDs, numbers and
identifiers made of words are taken out; what has at most RATIO characters per
token is reported as ``random``, unless a pattern already covers a part of it.

Spans count code points, end exclusive.  Cases: null or empty text: no spans.
Repeated rows: each is scanned.  Texts are scanned whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.llm.token_store import vocabulary_path
from qamill.session import ship_package

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters per token, at most, of a random string.
RATIO = 2.0
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Whole runs of 32 and more, as the leftmost non-overlapping runs of any length are whole.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")
MIN_ASSIGNED, MIN_ACCESS = 8, 16
#: Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
_HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
#: Words (one case, or a capital first) joined by signs, each with a short number at most.
_IDENTIFIER = re.compile(r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}(?:[_+/=-]+|$))+")
_CAMEL = re.compile(r"(?:[A-Z]?[a-z]{2,})(?:[A-Z][a-z]{2,})*[0-9]{0,4}")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def known(s: str) -> bool:
    """A digest, an id or a name, or no mixture of characters at all."""
    if _HEXADECIMAL.fullmatch(s) and len(s) in DIGESTS or _UUID.fullmatch(s):
        return True
    if not re.search("[0-9]", s) or not re.search("[A-Za-z]", s):
        # Letters and signs alone, or numbers and signs alone: random only if both cases alternate like no name does.
        if not (re.search("[a-z]", s) and re.search("[A-Z]", s)) or _CAMEL.fullmatch(s.replace("_", "").replace("-", "")):
            return True
    return bool(_IDENTIFIER.fullmatch(s) or _CAMEL.fullmatch(s))


def spans_of(text: str, encoding) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e in found)
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if any(x < e and s < y for x, y in base) or known(m[0]):
            continue
        if e - s <= RATIO * len(encoding.encode_ordinary(m[0])):
            found.append((s, 3, e))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _rows(batches, text: str, path: str):
    encoding = _encoding(path)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        at = batch.schema.names.index(text)
        for k in range(0, batch.num_rows, 512):
            some = batch.slice(k, 512)
            spans = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in spans_of(t or "", encoding)] for t in some.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(some.columns) if i != at), pa.array(spans, pa.list_(kind))],
                names=[*(n for i, n in enumerate(some.schema.names) if i != at), "spans"])


def scan(spark: SparkSession, df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None) -> DataFrame:
    """The key columns and spans (kind, start, end) of each row; no shuffle."""
    ship_package(spark)
    path = vocabulary or vocabulary_path(VOCABULARY)
    picked = df.select(*keys, F.col(text).cast("string").alias("scanned_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(lambda it: _rows(it, "scanned_text", path), f"{schema}, spans array<struct<kind:string,start:long,end:long>>")


def op3_token_efficiency_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("random"),
                        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
