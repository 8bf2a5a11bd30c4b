"""Secret scan with multipart credential linking.

Three base kinds are matched in the whole text: assignments to secret-like
names, access ids and long hexadecimal strings. Weak parts (identifiers by
name, high-entropy strings, endpoints) are no finding by themselves. They are
interval-joined within scopes of ``SCOPE`` code points and reported only when
complementary parts co-occur: a weak secret next to an identifier or endpoint, a
weak identifier next to a secret, an endpoint next to an identifier and a secret.

The join is an equi-join on (document, bin of ``SCOPE`` code points) with the
distance as a further condition, so a document of any length spreads over many
tasks and a part meets only what fits into the bins it covers and one on either
side.

Defined results: null text is empty (no findings); equal ``doc_id`` and repeated
rows give a row each, with equal findings for equal rows; null ``doc_id`` stays
null; an empty table gives no rows; other columns are ignored. Matching time is
linear in the text's length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import id_text, materialize, prepare

SCOPE = 300
BASE_KINDS = ("assign", "access", "hex")
ENTROPY = 4.0           # bits a character that a weak secret has at least

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENT = re.compile(r"""(?ai:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20?[:=]\x20?["']?([A-Za-z0-9@._-]{4,})""")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"(?a)(?:https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+=%-]{4,}")

PART = "struct<kind:string,role:string,weak:boolean,start:int,end:int>"
SCANNED = ("doc_id long, text_key long, n_assign long, n_access long, n_hex long, base_sha256 string, base string,"
           f" parts array<{PART}>")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base findings (kind, start, end) by start, then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(BASE_KINDS[k], a, b) for a, k, b in sorted(found)]


def _entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def parts(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Parts for linking, or none where nothing weak could be linked."""
    weak = [("ident", "id", m.start(), m.end()) for m in _IDENT.finditer(text)]
    weak += [("endpoint", "endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    taken = [(a, b) for _, a, b in base] + [(a, b) for _, _, a, b in weak]
    for m in _TOKEN.finditer(text) if weak or base else ():
        s = m[0]
        if _entropy(s) >= ENTROPY and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) \
                and not any(a < m.end() and m.start() < b for a, b in taken):
            weak.append(("keystring", "secret", m.start(), m.end()))
    strong = [(k, "id" if k == "access" else "secret", a, b) for k, a, b in base]
    if not weak or len({r for _, r, _, _ in weak + strong}) < 2:
        return []
    return [{"kind": k, "role": r, "weak": w, "start": a, "end": b}
            for group, w in ((weak, True), (strong, False)) for k, r, a, b in group]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, linkable = [], []
        for x in b.column("text"):
            text = x.as_py()
            spans = base_spans(text)
            base.append(spans)
            linkable.append(parts(text, spans))
        joined = [",".join(f"{k}:{a}:{e}" for k, a, e in spans) for spans in base]
        counts = [Counter(k for k, _, _ in spans) for spans in base]
        kind = pa.struct([("kind", pa.string()), ("role", pa.string()), ("weak", pa.bool_()),
                          ("start", pa.int32()), ("end", pa.int32())])
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "text_key": b.column("text_key"),
            **{f"n_{k}": pa.array([c[k] for c in counts], pa.int64()) for k in BASE_KINDS},
            "base_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() for s in joined], pa.string()),
            "base": pa.array(joined, pa.string()), "parts": pa.array(linkable, pa.list_(kind))})


def link_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with their complement in scope, as (doc_id, text_key, kind,
    start, end), from rows (doc_id, text_key, parts)."""
    one = found.where(F.size("parts") > 0).select("doc_id", "text_key", F.explode("parts").alias("p")) \
        .select("doc_id", "text_key", "p.*").distinct()
    # a part lies in all bins that it covers; what is in scope of any of its code points shares one of them
    weak = one.where("weak").withColumn("bin", F.explode(F.expr(f"sequence(start div {scope}, end div {scope})")))
    near = one.select(F.col("doc_id").alias("d"), "text_key", F.col("role").alias("r"), F.col("start").alias("s"),
                      F.col("end").alias("e"),
                      F.explode(F.expr(f"sequence(start div {scope} - 1, end div {scope} + 1)")).alias("bin")) \
        .groupBy("d", "text_key", "r", "s", "bin").agg(F.max("e").alias("e"))
    met = weak.join(near, ["text_key", "bin"]).where(
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("role") != F.col("r"))
        & (F.col("s") - F.col("end") <= scope) & (F.col("start") - F.col("e") <= scope))
    roles = met.groupBy("doc_id", "text_key", "kind", "role", "start", "end").agg(
        F.max(F.col("r") == "id").alias("id"), F.max(F.col("r") == "secret").alias("secret"),
        F.max(F.col("r") == "endpoint").alias("endpoint"))
    return roles.where("(role = 'secret' and (id or endpoint)) or (role = 'id' and secret)"
                       " or (role = 'endpoint' and id and secret)") \
        .select("doc_id", "text_key", "kind", "start", "end")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): counts and digest of the base
    kinds and ``spans``, all findings as ``kind:start:end`` in code points."""
    spark = docs.sparkSession
    prepare(spark)
    keyed = id_text(docs).withColumn("text_key", F.xxhash64("text"))
    found = materialize(keyed.mapInArrow(_scan, SCANNED), "secret-scan")
    linked = link_parts(found, scope).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("more"))
    more = linked.select(F.col("doc_id").alias("d"), "text_key", "more")
    rows = found.join(more, (found["text_key"] == more["text_key"]) & found["doc_id"].eqNullSafe(more["d"]), "left")
    # all findings by start, base kinds first at the same place
    order = "filter(split(base, ','), s -> s != '')"
    both = F.expr(f"""array_join(transform(array_sort(concat(
        transform({order}, (s, i) -> struct(int(split(s, ':')[1]) as start, i as place, s as span)),
        transform(coalesce(more, array()), (m, i) ->
            struct(m.start as start, 1000000000 + i as place, concat_ws(':', m.kind, m.start, m.end) as span)))),
        x -> x.span), ',')""")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                       F.when(F.col("more").isNull(), F.col("base")).otherwise(both).alias("spans"))
