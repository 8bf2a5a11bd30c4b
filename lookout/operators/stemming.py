"""Stemming as a vocabulary-sized job.

The stemmer is a rule table compiled to a Catalyst expression
(:mod:`lookout.functions.stem`). Rather than evaluating it per token, the distinct
terms are stemmed once into a ``(term, stem)`` dictionary, which
is written to the checkpoint folder and joined back. Its cost grows with
the vocabulary, not the corpus; the planner broadcasts the dictionary only
when its written size is under the broadcast threshold, otherwise it is a
sort-merge join on ``term`` whose input is the per-document term counts
(already one row per (doc, term)), not raw tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stem as porter2
from ..functions import text as T
from ..session import broadcasts, materialize


def stem_dictionary(terms: DataFrame, col: str = "term", persist: bool = True) -> DataFrame:
    """``(term, stem)`` for the distinct values of ``col``."""
    d = terms.select(F.col(col).alias("term")).distinct().select("term", porter2.stem("term").alias("stem"))
    return materialize(d, "stems") if persist else d


def corpus_stems(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stem dictionary of every kept (unstemmed) token of a corpus. Terms
    are de-duplicated with partial aggregation before any Python runs."""
    toks = docs.select(F.explode(T.normalized_tokens(F.col(text_col))).alias("term"))
    return stem_dictionary(toks)


def stem_postings(tf: DataFrame, stems: DataFrame, key: str | None = None, buckets: int = 0) -> DataFrame:
    """Postings in stems from unstemmed postings (``term``, ``tf`` and the document's columns): each
    term is replaced by its stem and counts are summed per (document, stem). ``key`` says that the postings
    lie in that many ``buckets`` of it: so does the result, with a shuffle only if the dictionary is
    too large to broadcast."""
    d = stems.select(F.col("term").alias("_t"), F.col("stem").alias("_s"))
    of = [c for c in tf.columns if c not in ("term", "tf")]
    joined = tf.join(d, tf.term == d._t)
    if key and not broadcasts(d):
        joined = joined.repartition(buckets, key)
    return sum_stems(joined.select(*of, F.col("_s").alias("stem"), "tf"))


def sum_stems(tf: DataFrame) -> DataFrame:
    """Postings in stems from postings with their ``stem``: counts are summed per (document, stem)."""
    of = [c for c in tf.columns if c not in ("term", "stem", "tf")]
    return tf.groupBy(*of, F.col("stem").alias("term")).agg(F.sum("tf").alias("tf"))


def second_pass(tf: DataFrame) -> DataFrame:
    """Normalise already-normalised terms once more, as the original ranked
    engine did when it built its vocabulary from processed text: the token
    rules run again on each stem and the stem is stemmed again (Porter2 is
    not idempotent: ``course`` -> ``cours`` -> ``cour``). Returns the
    columns of ``tf`` in second-pass terms: counts per document, or of the
    whole corpus if ``tf`` is ``(term, tf)`` of that."""
    kept = tf.where(T.keep_token(F.col("term")))
    return stem_postings(kept, stem_dictionary(kept.select("term")))


def query_stems(queries: DataFrame, text_col: str = "text") -> DataFrame:
    """Stem dictionary of a query batch's own tokens (bounded by the batch,
    so it is not persisted)."""
    toks = queries.select(F.explode(T.normalized_tokens(F.col(text_col))).alias("term"))
    return stem_dictionary(toks, persist=False)


def stemmed_text(docs: DataFrame, tokens: DataFrame, stems: DataFrame) -> DataFrame:
    """T8 with stemming: ``(doc_id, normalized)``, stems re-joined in token
    order ('' for a document without kept tokens). Grouping is per
    document, so a group is one document's own tokens."""
    from .corpus import apply_stems
    s = apply_stems(tokens, stems)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "term")))
    joined = s.groupBy("doc_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["term"]), " ").alias("normalized"))
    return (docs.select("doc_id").join(joined, "doc_id", "left")
            .select("doc_id", F.coalesce(F.col("normalized"), F.lit("")).alias("normalized")))
