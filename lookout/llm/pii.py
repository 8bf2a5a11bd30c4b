"""Personal data by patterns and bootstrapped contextual extraction.

Base kinds (e-mail, IPv4, card and phone numbers) are matched in the whole text
and are the seeds. Every identifier-like token or run of digit groups (joined by single
separators of the base kinds: space, dot, hyphen, brackets), seed or not, is an
occurrence of an instance (its letters and digits) in a lexical pattern (the two words
before it). The pattern-instance graph is scored for each kind in turns: a pattern by the
share of its occurrences whose instances are believed to be of the kind, an
instance by its patterns (noisy or; seeds stay at one), until no belief grows. Instances above
``CONFIDENCE`` are reported wherever they occur outside the base findings.

Only patterns with ``SUPPORT`` different seed instances and a score of ``TRUST`` are believed,
so a frequent number doesn't add up a belief from many weak patterns. Graph edges
are aggregated before every shuffle and stored, so a pattern or instance that
occurs in a third of all rows is a few edges or a splittable join.

Defined results: null text is empty (no findings); equal ``doc_id`` and repeated
rows give a row each; null ``doc_id`` stays null; an empty table gives no rows;
``find_pii`` ignores other columns, ``redact`` keeps them. Matching time is linear
in the text's length.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import id_text, materialize, parts_for, prepare
from lookout.session import Scratch, discard

BASE_KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
CONFIDENCE = 0.9
ROUNDS = None           # turns of scoring; None: until no belief grows by more than TOLERANCE
TOLERANCE = 1e-3
TRUST = 0.5             # patterns that score less have no say
PART_EDGES = 500_000    # edges to a task of the scoring

# written so that no start is tried twice within one run of characters
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# a run of digit groups between the ends of tokens, brackets may stand beside another separator
_GROUPS = re.compile(r"(?<![^\s\[{<\"':;,*#|])[(+]{0,2}[0-9]++(?:[\x20().-]{1,2}+[0-9]++)+(?=[.,;:!?\"')\]}>*#|]*+(?:\s|\Z))")
_CANDIDATE = re.compile(r"\S+")
_DIGIT_OR_AT = re.compile(r"[0-9@]")
_PUNCTUATION = ".,;:!?\"'()[]{}<>*#&%$|"
_OUTSIDE = re.compile(r"[^A-Za-z0-9]+")

FOUND = ("doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
         " base string, seen array<struct<kind:string,start:int,end:int,instance:string,pattern:string>>")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base findings (kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def _pattern(text: str, start: int) -> str:
    """The two words before ``start``, in lower case and without punctuation."""
    words: list[str] = []
    end = start
    while end > 0 and len(words) < 2:
        while end > 0 and text[end - 1].isspace():
            end -= 1
        a = end
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        if end > a:
            words.insert(0, text[a:end].lower().strip(_PUNCTUATION))
        end = a
    return " ".join(words)


def candidates(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of digit groups and whole tokens, with four digits or an at sign, and whether
    their pattern counts (not for the first token of a run, which has the run's)."""
    runs = [m.span() for m in _GROUPS.finditer(text) if sum("0" <= c <= "9" for c in m[0]) >= 4]
    yield from ((a, b, True) for a, b in runs)
    at = 0
    for m in _CANDIDATE.finditer(text):
        if not _DIGIT_OR_AT.search(m[0]):
            continue
        token = m[0].strip(_PUNCTUATION)
        if "@" not in token[1:-1] and sum("0" <= c <= "9" for c in token) < 4:
            continue
        a = m.start() + m[0].index(token)
        b = a + len(token)
        while at < len(runs) and runs[at][1] <= a:
            at += 1
        x, y = runs[at] if at < len(runs) else (b, b)
        if x >= b or not (x >= m.start() and y <= m.end()):
            yield a, b, not (m.start() <= x < b and text[m.start():x].strip(_PUNCTUATION) == "")


def occurrences(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Identifier-like tokens: the base findings, and the candidates that overlap none."""
    out = [(k, a, b, True) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    at = 0
    for a, b, counts in sorted(candidates(text)):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not any(x < b and a < y for x, y in taken[at:at + 8]):
            out.append((None, a, b, counts))
    return [{"kind": k, "start": a, "end": b, "instance": _OUTSIDE.sub("", text[a:b]).lower(),
             "pattern": _pattern(text, a) if counts else None} for k, a, b, counts in out]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                      ("instance", pa.string()), ("pattern", pa.string())])
    for b in batches:
        base, seen = [], []
        for x in b.column("text"):
            text = x.as_py()
            base.append(base_spans(text))
            seen.append(occurrences(text, base[-1]))
        joined = [",".join(f"{k}:{a}:{e}" for k, a, e in spans) for spans in base]
        counts = [Counter(k for k, _, _ in spans) for spans in base]
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "text_key": b.column("text_key"),
            **{f"n_{k}": pa.array([c[k] for c in counts], pa.int64()) for k in BASE_KINDS},
            "base_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() for s in joined], pa.string()),
            "base": pa.array(joined, pa.string()), "seen": pa.array(seen, pa.list_(kind))})


def score_graph(edges: DataFrame, rounds: int | None = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """Belief (``instance``, ``kind``, ``belief``) after ``rounds`` turns, or once no belief
    grows by more than ``TOLERANCE`` (beliefs never fall), over stored ``edges`` (``pattern``, ``instance``, ``n``, ``seed``: the kind or null).

    Occurrences are summed once, and patterns with fewer than ``support`` instances, which can never
    be believed, are left out of the turns, with the seeds that stand in no other pattern. What
    a turn writes replaces what the turn before wrote."""
    edges = edges.where("pattern is not null")
    parts = parts_for(edges.count(), PART_EDGES)
    seeds = edges.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct() \
        .withColumn("belief", F.lit(1.0))
    seeds = materialize(seeds.coalesce(parts), "pii-seeds")
    summed = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    totals = summed.groupBy("pattern").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("instances")) \
        .where(F.col("instances") >= support).drop("instances")
    pairs = materialize(summed.join(totals, "pattern").coalesce(parts), "pii-pairs")
    first = materialize(seeds.join(pairs.select("instance").distinct(), "instance", "left_semi").coalesce(parts), "pii-first")
    belief, past = first, []
    for _ in count() if rounds is None else range(rounds):
        votes = pairs.join(belief, "instance").groupBy("pattern", "kind", "total") \
            .agg(F.sum(F.col("n") * F.col("belief")).alias("w"), F.count(F.lit(1)).alias("instances")) \
            .where(F.col("instances") >= support)
        scores = votes.select("pattern", "kind", (F.col("w") / (F.col("total") + 0.1)).alias("score")).where(F.col("score") >= trust)
        scores = materialize(scores.coalesce(parts), "pii-scores")
        heard = pairs.select("pattern", "instance").join(scores, "pattern").groupBy("instance", "kind") \
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("belief"))
        old = belief.select("instance", "kind", F.lit(None).cast("double").alias("belief"), F.col("belief").alias("was"))
        both = heard.withColumn("was", F.lit(None).cast("double")).unionByName(old).groupBy("instance", "kind") \
            .agg(F.max("belief").alias("belief"), F.max("was").alias("was"))
        both = materialize(both.coalesce(parts), "pii-belief")
        discard(scores, *past)
        past = [both]
        belief = both.select("instance", "kind", F.greatest("belief", "was").alias("belief"))
        if both.where(F.col("belief") > F.coalesce("was", F.lit(0.0)) + TOLERANCE).isEmpty():
            break
    return seeds.unionByName(belief).groupBy("instance", "kind").agg(F.max("belief").alias("belief"))


def _discovered(found: DataFrame, confidence: float, rounds: int | None, support: int) -> DataFrame:
    """Further findings (doc_id, text_key, kind, start, end) of stored scans."""
    seen = found.select("doc_id", "text_key", F.explode("seen").alias("o")).select("doc_id", "text_key", "o.*")
    with Scratch() as temp:
        edges = materialize(seen.where("instance != ''").groupBy("pattern", "instance", F.col("kind").alias("seed"))
                            .agg(F.count(F.lit(1)).alias("n")), "pii-edges")
        belief = score_graph(edges, rounds, support)
        best = belief.where(F.col("belief") >= confidence).groupBy("instance") \
            .agg(F.max(F.struct("belief", "kind")).alias("b")).select("instance", F.col("b.kind").alias("found"))
        # only instances that also stand outside the base findings matter
        open_ = edges.where("seed is null").select("instance").distinct()
        best = temp.keep(materialize(best.join(open_, "instance", "left_semi"), "pii-found"))
    return seen.where("kind is null").join(best, "instance") \
        .select("doc_id", "text_key", F.concat("found", F.lit("_context")).alias("kind"), "start", "end").distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("text_key", F.xxhash64("text"))


def find_pii(docs: DataFrame, confidence: float = CONFIDENCE, rounds: int | None = ROUNDS,
             support: int = SUPPORT) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): counts and digest of the base
    kinds and ``spans``, all findings as ``kind:start:end`` in code points."""
    spark = docs.sparkSession
    prepare(spark)
    found = materialize(_keyed(docs).mapInArrow(_scan, FOUND), "pii-scan")
    more = _discovered(found, confidence, rounds, support).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("more"))
    added = more.select(F.col("doc_id").alias("d"), "text_key", F.expr(
        "array_join(transform(more, m -> concat_ws(':', m.kind, m.start, m.end)), ',')").alias("added"))
    rows = found.drop("seen").join(
        added, (found["text_key"] == added["text_key"]) & found["doc_id"].eqNullSafe(added["d"]), "left")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), "added")
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def redact(docs: DataFrame, confidence: float = CONFIDENCE, rounds: int | None = ROUNDS,
           support: int = SUPPORT) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by its kind in brackets;
    all columns and rows stay."""
    spark = docs.sparkSession
    prepare(spark)
    with Scratch() as temp:
        found = materialize(_keyed(docs).mapInArrow(_scan, FOUND), "pii-scan")
        spans = found.where("base != ''").select("doc_id", "text_key", F.explode(F.split("base", ",")).alias("s")) \
            .select("doc_id", "text_key", F.expr("struct(int(split(s, ':')[1]) as start, int(split(s, ':')[2]) as end,"
                                                 " split(s, ':')[0] as kind)").alias("s"))
        more = _discovered(found, confidence, rounds, support) \
            .select("doc_id", "text_key", F.struct("start", "end", F.regexp_replace("kind", "_context$", "").alias("kind")).alias("s"))
        by_doc = temp.keep(materialize(spans.unionByName(more).groupBy("doc_id", "text_key")
                                       .agg(F.sort_array(F.collect_set("s")).alias("spans")), "pii-spans"))
    names = {n: _free(docs, n) for n in ("d", "k", "spans")}
    by_doc = by_doc.select(F.col("doc_id").alias(names["d"]), F.col("text_key").alias(names["k"]),
                           F.col("spans").alias(names["spans"]))
    joined = docs.join(by_doc, F.col("doc_id").cast("long").eqNullSafe(F.col(names["d"]))
                       & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col(names["k"])), "left")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans_ = b.column("text").to_pylist(), b.column(names["spans"]).to_pylist()
            new = [t if not s else mask(t, s) for t, s in zip(texts, spans_)]
            yield b.select(kept).set_column(kept.index("text"), "text", pa.array(new, pa.string()))

    kept = docs.columns
    return joined.select(*docs.columns, names["spans"]).mapInArrow(replace, docs.schema)


def mask(text: str, spans: list[dict]) -> str:
    """``text`` with spans (sorted by start) replaced; overlapping spans are one."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name
