"""Secrets in texts: patterns that stand alone, and parts of multipart credentials that count only together.

The base scan finds assignments, access identifiers and long hexadecimal strings. Other parts are too weak to report
alone: user names or identifiers in assignments (``id``), opaque mixed tokens (``key``) and addresses of services
(``endpoint``). An interval join links parts of different roles whose scopes (``SCOPE`` code points around each) meet;
a weak part is reported only if a complementary part shares its scope: a key needs an identifier, an identifier needs a
key or a secret, and an endpoint needs both.

The join is a semi-join on bins of ``SCOPE`` code points with the scopes as condition, so that a page with
thousands of parts makes no pairs. Each row of the input gets one row with the spans of its own text, whether its doc_id
is missing, repeated or neither. A text has to fit into a task. Null texts are empty; empty texts and empty tables have no spans. Other columns are
ignored and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_HINTS = ("passw", "secret", "token", "apikey", "api_key")
#: Weak parts, found by words that hold one of the characters beside them.
WEAK = (
    ("id", ":=", re.compile(r"\b(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[\w.@+-]{3,}", re.I | re.A)),
    ("key", "", re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", re.A)),
    ("endpoint", ":", re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3|jdbc:[a-z]+)://[^\s\"'<>]+|\bhost(?:name)?[\"']?\x20*[:=]\x20*[\"']?[\w.-]{3,}", re.A)),
)
_DIGIT = re.compile(r"[0-9]")
#: Code points on either side of a part in which its counterparts may stand.
SCOPE = 200
KINDS = {"assign": 0, "access": 1, "hex": 2, "id": 3, "key": 4, "endpoint": 5}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of the patterns that are reported alone, in order of start and kind."""
    low = text.lower()
    found = []
    if any(h in low for h in _HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS[s[0]]))


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Parts that don't count alone, but for those inside a base span."""
    found = []
    for kind, hint, pattern in WEAK:
        if (hint and not any(c in text for c in hint)) or (kind == "key" and not _DIGIT.search(text)):
            continue
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for _, a, b in base):
                found.append((kind, *m.span()))
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for low in range(0, len(ids), 500):
            base_lists, weak_lists, names = [], [], []
            for doc_id, scalar in zip(ids.slice(low, 500).to_pylist(), texts.slice(low, 500), strict=True):
                text = scalar.as_py() or ""
                base = base_spans(text)
                base_lists.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                weak = weak_spans(text, base)
                weak_lists.append([{"kind": k, "start": a, "end": b} for k, a, b in weak])
                names.append(hashlib.sha256(f"{doc_id}:{text}".encode()).digest() if weak else None)
            spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([ids.slice(low, 500), pa.array(names, pa.binary()), pa.array(base_lists, spans), pa.array(weak_lists, spans)], names=["doc_id", "text_id", "base", "weak"])


def _near(parts: DataFrame, others: DataFrame) -> DataFrame:
    """Parts whose scope meets another part: equi-join on bins, intervals as condition."""
    first, last = (F.floor((F.col(c) + d) / SCOPE) for c, d in (("start", -SCOPE), ("end", SCOPE)))
    binned = parts.withColumn("bin", F.explode(F.sequence(first, last)))
    beside = others.select(F.col("text_id").alias("o_text"), F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE))).alias("o_bin"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    meets = (F.col("text_id") == F.col("o_text")) & (F.col("bin") == F.col("o_bin")) & (F.col("o_start") < F.col("end") + SCOPE) & (F.col("start") - SCOPE < F.col("o_end"))
    return binned.join(beside, meets, "left_semi").select(*parts.columns).distinct()


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, base and linked (arrays of kind, start, end; code points, end exclusive)."""
    spans = "array<struct<kind string, start long, end long>>"
    scanned = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, f"doc_id long, text_id binary, base {spans}, weak {spans}")
    scanned = written(scanned, "secret-parts")
    linkable = scanned.where("text_id is not null")
    # One text of very many rows without a doc_id has one text_id: its parts are joined once.
    parts = lambda column, *kinds: linkable.select("text_id", F.explode(column).alias("s")).select("text_id", "s.*").where(F.col("kind").isin(*kinds)).distinct()
    ids = parts("weak", "id").unionAll(parts("base", "access"))
    keys = parts("weak", "key").unionAll(parts("base", "assign", "hex"))
    endpoints = parts("weak", "endpoint")
    linked = _near(parts("weak", "key"), ids).unionAll(_near(parts("weak", "id"), keys)).unionAll(_near(_near(endpoints, ids), keys))
    linked = linked.distinct().groupBy("text_id").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    none = F.lit([]).cast(spans)
    plain = scanned.where("text_id is null").select("doc_id", "base", none.alias("linked"))
    return plain.unionAll(linkable.select("doc_id", "text_id", "base").join(linked, "text_id", "left").select("doc_id", "base", F.coalesce("linked", none).alias("linked")))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    rank = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    ordered = F.transform(
        F.array_sort(F.transform(F.concat("base", "linked"), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(ordered).alias("spans"))
