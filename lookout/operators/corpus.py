"""Vocabulary, postings and TF-IDF as DataFrame transformations.

Shapes (rows, never one row per term with a whole list in it):

* tokens      ``(doc_id, pos, term)``
* forward     ``(part, doc_no, doc_id, terms)``   -- a document's terms with counts
* term counts ``(doc_id, term, tf)``              -- the postings with counts
* vocabulary  ``(term_id, term)``                 -- dense ids in code-point order
* idf model   ``(term, df, cf, idf)``
* weights     ``(doc_id, term, tf, weight)``      -- L2-normalised per document

Physical plan choices:

* Term counts are computed inside each document row (sort + run lengths), so
  producing postings shuffles nothing, and the forward index is written by
  the tasks that read the text.
* The per-term aggregation combines in the map tasks first, so a hot term
  ships one partial count per task, never its postings.
* The idf model is written to the checkpoint folder before it is joined back
  (see :func:`fit_idf`), so the planner sees its real size: it is broadcast
  only when under ``spark.sql.autoBroadcastJoinThreshold``.
* The forward index is bucketed by parts of the documents. A table of terms too large to broadcast
  comes to the postings (:func:`with_terms`): a part gets the rows of the terms it holds, and
  postings stay where they are. A norm needs no shuffle after either.
* The document count is a scalar subquery, not a collected Python value and
  not a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import UNKNOWN_BYTES, broadcasts, label, materialize, materialize_bucketed, partitions_for, written_bytes


BUCKET_BYTES = 8 << 20       # of input; its postings take some twenty times as much when sorted in memory


# ---------------------------------------------------------------- tokens --

def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           stems: DataFrame | None = None) -> DataFrame:
    """T1..T7: kept tokens with their position among kept tokens.

    ``stems`` is an optional ``(term, stem)`` dictionary (see
    :mod:`lookout.operators.stemming`); every token is replaced by its stem."""
    out = (docs.select(F.col(id_col).alias("doc_id"),
                       F.posexplode(T.normalized_tokens(F.col(text_col))).alias("pos", "term")))
    if stems is not None:
        out = apply_stems(out, stems)
    return out


def apply_stems(df: DataFrame, stems: DataFrame, col: str = "term") -> DataFrame:
    """Replace ``col`` by its stem through the ``(term, stem)`` dictionary."""
    d = stems.select(F.col("term").alias("_raw"), F.col("stem").alias("_stem"))
    return (df.join(d, df[col] == d["_raw"], "left")
            .withColumn(col, F.coalesce(F.col("_stem"), F.col(col)))
            .drop("_raw", "_stem"))


def _runs(df: DataFrame, sorted_col: str) -> tuple[DataFrame, Column]:
    """``df`` with the run starts of a sorted token array, and the array of ``(term, tf)``, one
    entry per run of equal terms. All tokens of a document come from the task that read the
    document, so counting them in the row needs no shuffle. Both arrays are columns of their
    own (not expressions), so the lambdas read them instead of sorting again per element."""
    s = F.col(sorted_col)
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                      lambda i: (n > 0) & ((i == 1) | (F.element_at(s, i)
                                                       != F.try_element_at(s, (i - 1).cast("int")))))
    st = F.col("_starts")
    runs = F.transform(st, lambda x, j: F.struct(
        F.element_at(s, x).alias("term"),
        (F.coalesce(F.try_element_at(st, (j + 2).cast("int")), n + 1) - x).cast("bigint").alias("tf")))
    return df.withColumn("_starts", starts), runs


def run_lengths(df: DataFrame, sorted_col: str, out: str = "terms") -> DataFrame:
    """Replace a sorted token array by the array ``out`` of ``(term, tf)``."""
    with_starts, runs = _runs(df, sorted_col)
    return with_starts.select(*[c for c in df.columns if c != sorted_col], runs.alias(out))


def run_counts(df: DataFrame, sorted_col: str) -> DataFrame:
    """A sorted token array as ``(term, tf)`` rows."""
    with_starts, runs = _runs(df, sorted_col)
    return with_starts.select(*[c for c in df.columns if c != sorted_col], F.inline(runs))


def sorted_tokens(text: Column) -> Column:
    return F.sort_array(T.normalized_tokens(F.coalesce(text, F.lit(""))))       # array_sort would run a lambda per comparison


def forward_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int | None = None) -> DataFrame:
    """``(part, doc_no, doc_id, terms)``, written: each document's terms with counts. ``doc_no`` numbers
    documents by input split and place in it (not densely), so neighbours in the input are
    neighbours in number; writing fixes it. The texts are dealt into parts of documents once, about
    ``BUCKET_BYTES`` of input each, which also spreads an input of few splits; a document's postings then
    stay in one task through stems, weights and norms."""
    n = n or buckets(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("doc_no"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    rows = rows.withColumn("part", label(docs.sparkSession, n, F.pmod(F.hash("doc_no"), F.lit(n)))).repartition(n, "part")
    return materialize_bucketed(run_lengths(rows.select("part", "doc_no", "doc_id", sorted_tokens(F.col("_t")).alias("_s")), "_s"),
                                "forward", "part", n, dealt=True)


def buckets(docs: DataFrame) -> int:
    """The number of buckets of an index of ``docs``, from the planner's size (rows of unknown size: as many as
    shuffles have partitions)."""
    size = written_bytes(docs)
    return partitions_for(docs.sparkSession, size if size < UNKNOWN_BYTES else 0, BUCKET_BYTES)


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stems: DataFrame | None = None) -> DataFrame:
    """``(doc_id, term, tf)``: raw term frequency per document.

    Counted inside each document row (no shuffle of tokens or postings). With ``stems``
    the counts are re-aggregated per stem, which does shuffle postings
    (several raw terms of a document may share a stem)."""
    tf = run_counts(docs.select(F.col(id_col).alias("doc_id"), sorted_tokens(F.col(text_col)).alias("_s")), "_s")
    if stems is not None:
        tf = (apply_stems(tf, stems)
              .groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")))
    return tf


def normalized_documents(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``(doc_id, normalized)``; a row-local expression, no shuffle."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       T.normalized_text(F.col(text_col)).alias("normalized"))


# ------------------------------------------------------------ vocabulary --

def number_rows(rows: DataFrame, by: list[str], id_col: str, partitions: int | None = None) -> DataFrame:
    """The rows with ``id_col``: 0, 1, 2, ... in the order of the columns ``by``.

    A global ``row_number() over (order by ...)`` would pull every row
    into one task. Instead the rows are range-partitioned (boundaries from
    a sample, so a crowded prefix is split like any other range), sorted
    inside each partition and numbered by position; the result is written to
    the checkpoint folder so numbering is fixed even if tasks are retried.
    Per-partition counts (one row per partition, a bounded table) then give
    each partition its offset."""
    rows = materialize(rows, "rows")                          # its size is known, and sampling reads files
    n = partitions or partitions_for(rows.sparkSession, written_bytes(rows))
    ranged = materialize(rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
                         .withColumn("_mono", F.monotonically_increasing_id()), "dense-ids")
    ranged = ranged.select(*rows.columns, F.shiftright("_mono", 33).alias("_part"),
                           F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range partition: the window over it is tiny by construction.
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_n")).alias("_offset"))
    return (ranged.join(F.broadcast(offsets), "_part")
            .select((F.col("_offset") + F.col("_local")).alias(id_col), *rows.columns))


def dense_ids(values: DataFrame, col: str, id_col: str, partitions: int | None = None) -> DataFrame:
    """Number the distinct values of ``col`` 0, 1, 2, ... in sort order (see :func:`number_rows`)."""
    return number_rows(values.select(col), [col], id_col, partitions)


def vocabulary(tf: DataFrame) -> DataFrame:
    """V1: ``(term_id, term)`` over every distinct term."""
    return dense_ids(tf.select("term").distinct(), "term", "term_id")


def term_frequency(tf: DataFrame) -> DataFrame:
    """V2: ``(term, cf)`` total occurrences over the corpus."""
    return tf.groupBy("term").agg(F.sum("tf").alias("cf"))


def bounded_terms(tf: DataFrame, min_cf: int = 2, max_cf: int | Column = 1800) -> DataFrame:
    """V3 filter: terms whose total occurrence count lies in [min_cf, max_cf]."""
    return term_frequency(tf).where(F.col("cf").between(min_cf, max_cf)).select("term")


def bounded_vocabulary(tf: DataFrame, min_cf: int = 2, max_cf: int = 1800) -> DataFrame:
    """V3: ``(term_id, term)`` of the frequency-bounded vocabulary."""
    return dense_ids(bounded_terms(tf, min_cf, max_cf), "term", "term_id")


def inverted_index(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """V5: boolean postings ``(term_id, doc_id)``; terms outside the
    vocabulary are skipped. ``tf`` already holds one row per (doc, term)."""
    return tf.join(vocab, "term").select("term_id", "doc_id")


# ---------------------------------------------------------------- TF-IDF --

def document_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery (evaluated once)."""
    return docs.select(F.count(F.lit(1)).cast("double")).scalar()


def term_stats(tf: DataFrame) -> DataFrame:
    """``(term, df, cf)``: document frequency and total occurrences per term,
    one partial + final aggregation of the postings (a hot term ships one
    partial row per task)."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def idf_from_stats(stats: DataFrame, n_docs: Column, terms: DataFrame | None = None,
                   min_cf: int | None = None, max_cf: int | Column | None = None,
                   persist: bool = True) -> DataFrame:
    """V6 fit from per-term statistics: ``(term, df, cf, idf)`` with the
    smoothed idf ``ln((1 + n) / (1 + df)) + 1``. ``terms`` restricts the
    model to a vocabulary; ``min_cf``/``max_cf`` apply the V3 bounds. With
    ``persist`` the model is written to the checkpoint folder, so joins
    against it are planned with its real size."""
    if min_cf is not None:
        stats = stats.where(F.col("cf") >= min_cf)
    if max_cf is not None:
        stats = stats.where(F.col("cf") <= max_cf)
    if terms is not None:
        stats = stats.join(terms.select("term"), "term", "left_semi")
    model = stats.select("term", "df", "cf",
                         (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))
    return materialize(model, "idf") if persist else model


def fit_idf(tf: DataFrame, n_docs: Column, terms: DataFrame | None = None,
            min_cf: int | None = None, max_cf: int | None = None,
            persist: bool = True) -> DataFrame:
    """V6 fit straight from postings (see :func:`idf_from_stats`)."""
    return idf_from_stats(term_stats(tf), n_docs, terms, min_cf, max_cf, persist)


def part_terms(tf: DataFrame) -> DataFrame:
    """``(part, term, df, cf)``, written: the terms of every part of the postings, each once, with its counts there."""
    return materialize(tf.groupBy("part", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")), "part-terms")


def with_terms(postings: DataFrame, held: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """``postings``, bucketed by ``part`` into ``n``, with the columns of the written ``table`` (one row per
    ``term``), null for terms that it lacks. A small one is broadcast. Of a larger one each part is sent
    the rows of its terms (``held``: ``part, term``), which are far fewer than its postings; those aren't shuffled: both
    sides lie by part, so their union does, and the first of a part's rows of a term is the table's."""
    if broadcasts(table):
        return postings.join(table, "term", "left")
    new = [c for c in table.columns if c != "term"]
    sent = held.select(F.col("part").alias("_part"), "term").join(table, "term").withColumn("_mark", F.lit(0)).repartition(n, "_part")
    so_far = Window.partitionBy("_part", "term").orderBy("_mark").rowsBetween(Window.unboundedPreceding, 0)
    # by another name, as Spark doesn't take the column of a catalog table for that of the other side
    mine = postings.select(F.col("part").alias("_part"), *[c for c in postings.columns if c != "part"], F.lit(1).alias("_mark"))
    return mine.unionByName(sent, allowMissingColumns=True) \
        .select("*", *(F.first(c, ignorenulls=True).over(so_far).alias(f"_{c}") for c in new)).where("_mark = 1") \
        .withColumnRenamed("_part", "part").select(*postings.columns, *(F.col(f"_{c}").alias(c) for c in new))


def unit_length(rows: DataFrame, *ids: str) -> DataFrame:
    """``weight`` for ``idf``: tf * idf scaled to unit length per ``ids``, null where the idf is."""
    w = rows.withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*ids)))
    return w.select(*[c for c in rows.columns if c != "idf"], (F.col("_w") / norm).alias("weight"))


def transform(tf: DataFrame, idf: DataFrame, id_col: str = "doc_id", keep_unknown: bool = False) -> DataFrame:
    """V6/V8 transform: the columns of ``tf`` and ``weight``, tf * idf scaled to unit length
    per ``id_col``. Terms outside the model are dropped (zero weights are never stored),
    or with ``keep_unknown`` stay with a null weight."""
    joined = tf.join(idf.select("term", "idf"), "term", "left" if keep_unknown else "inner")
    return unit_length(joined.select(*tf.columns, "idf"), id_col)


def query_counts(queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                 stems: DataFrame | None = None) -> DataFrame:
    """``(query_id, term, tf)`` for a batch of query texts, counted inside
    each query row like document terms (``query_id`` is the query key)."""
    toks = queries.select(F.col(id_col).alias("query_id"),
                          F.array_sort(T.normalized_tokens(F.col(text_col))).alias("_s"))
    tf = run_counts(toks, "_s")
    if stems is not None:
        tf = (apply_stems(tf, stems)
              .groupBy("query_id", "term").agg(F.sum("tf").alias("tf")))
    return tf


# -------------------------------------------------------- field indexes --

def field_index(places: DataFrame, fields: dict[str, Column], id_col: str = "doc_id") -> DataFrame:
    """V9: ``(field, term, doc_id)`` without duplicates, for already-cleaned
    fields.

    ``fields`` maps a field name to a column of cleaned text. ``id_col`` is
    the place key (one row per place), so each (field, place) is one row and
    its words are de-duplicated inside the row: the index is built with no
    shuffle at all."""
    stacked = places.select(
        F.col(id_col).alias("doc_id"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("field"), col.alias("value"))
                            for name, col in fields.items()])).alias("f"))
    return stacked.select(F.col("f.field").alias("field"),
                          F.explode(F.array_distinct(T.words(F.col("f.value")))).alias("term"),
                          "doc_id")
