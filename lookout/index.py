"""A searchable corpus: the write-once index tables and the searches on them.

    idx = SearchIndex(documents)                 # (doc_id, text)
    idx.conjunctive(queries)                     # (query_id, doc_id)
    idx.ranked(queries, k=5)                     # (query_id, doc_id, score, rank)
    idx.two_stage(queries, places, "Italian", "Terrace", k=10)

``queries`` is a DataFrame ``(query_id, text)``, so a batch runs as one
job. Every part is built on first use and written once to the shared
checkpoint folder as Parquet: the forward index (each document's terms with
counts), the stem dictionary, per-term statistics, the idf model, the weighted
postings and the term-ordered :class:`~lookout.sources.index_store.PostingStore` that
the searches read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import corpus as C
from .operators import search as S
from .operators import stemming as ST
from .session import materialize, materialize_bucketed, partitions_for
from .sources.index_store import BLOCK_BITS, POSTING_BYTES, SHARD_BYTES, PostingStore, shard_of, term_places


class SearchIndex:
    """Index of one corpus.

    ``stem`` stems every term (the original engine's default). ``min_cf`` /
    ``max_cf`` bound the ranked vocabulary by total occurrences; the upper bound
    grows with the corpus to ``max_per_doc`` occurrences a document (None: it
    stays absolute, as the original had it for 2000 records; 1900 of them are 0.95
    a document). ``passes=2`` builds that vocabulary from twice-normalised text as
    the original did. ``shards`` is the number of the store's files, by default
    from its size."""

    def __init__(self, docs: DataFrame, *, stem: bool = True, min_cf: int = 2,
                 max_cf: int = 1900, max_per_doc: float | None = 0.95,
                 passes: int = 1, shards: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text",
                 reuse: "SearchIndex | None" = None):
        self.docs = docs.select(F.col(id_col).alias("doc_id"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        self.stem, self.min_cf, self.max_cf, self.passes = stem, min_cf, max_cf, passes
        self.max_per_doc, self.shards = max_per_doc, shards
        if reuse is not None:
            # another index over the same documents: share the tables that
            # do not depend on the settings that differ
            self.__dict__["parts"] = reuse.parts
            self.__dict__["forward"] = reuse.forward
            self.__dict__["raw_terms"] = reuse.raw_terms
            if reuse.stem:
                self.__dict__["stems"] = reuse.stems
            if reuse.stem == stem:
                self.__dict__["numbered"] = reuse.numbered
                self.__dict__["part_terms"] = reuse.part_terms
                self.__dict__["term_stats"] = reuse.term_stats

    # ------------------------------------------------------------ tables --

    @cached_property
    def parts(self) -> int:
        """The number of parts that the documents are dealt into."""
        return C.buckets(self.docs)

    @cached_property
    def forward(self) -> DataFrame:
        """``(part, doc_no, doc_id, terms)`` in unstemmed terms, counted inside document rows."""
        return C.forward_index(self.docs, n=self.parts)

    @cached_property
    def raw_postings(self) -> DataFrame:
        """Unstemmed ``(part, doc_no, doc_id, term, tf)``."""
        return self.forward.select("part", "doc_no", "doc_id", F.inline("terms"))

    @cached_property
    def raw_terms(self) -> DataFrame:
        """``(part, term, df, cf)`` of the unstemmed postings."""
        return C.part_terms(self.raw_postings)

    @cached_property
    def stems(self) -> DataFrame:
        """``(term, stem)`` for the corpus vocabulary."""
        return ST.stem_dictionary(self.raw_terms.select("term"))

    @cached_property
    def numbered(self) -> DataFrame:
        """``(part, doc_no, doc_id, term, tf)`` in index terms (stems when ``stem``)."""
        if not self.stem:
            return self.raw_postings
        stemmed = C.with_terms(self.raw_postings, self.raw_terms, self.stems, self.parts)
        return materialize_bucketed(ST.sum_stems(stemmed), "stemmed", "part", self.parts, dealt=True)

    @cached_property
    def part_terms(self) -> DataFrame:
        """``(part, term, df, cf)`` of the postings in index terms."""
        return C.part_terms(self.numbered) if self.stem else self.raw_terms

    @cached_property
    def postings(self) -> DataFrame:
        """``(doc_id, term, tf)`` in index terms."""
        return self.numbered.select("doc_id", "term", "tf")

    @cached_property
    def term_stats(self) -> DataFrame:
        """``(term, df, cf)`` of every index term: the one aggregation of the
        postings by term, by way of their parts, written once; the idf, the vocabulary and the store's
        directory all read it."""
        return materialize(self.part_terms.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")), "term-stats")

    @cached_property
    def idf(self) -> DataFrame:
        """``(term, df, cf, idf)`` of the bounded ranked vocabulary."""
        stats = self.term_stats
        if self.stem:
            # the vectoriser's own tokeniser never sees one-character terms
            stats = stats.where(F.length("term") >= 2)
        n = C.document_count(self.docs)
        top = F.lit(self.max_cf)
        if self.max_per_doc is not None:
            top = F.greatest(top, n * self.max_per_doc)
        if self.passes == 2:
            # total counts suffice: a second-pass term's is the sum of its terms'
            tf = stats.select("term", F.col("cf").alias("tf"))
            vocab = C.bounded_terms(ST.second_pass(tf), self.min_cf, top)
            return C.idf_from_stats(stats, n, terms=vocab)
        return C.idf_from_stats(stats, n, min_cf=self.min_cf, max_cf=top)

    @cached_property
    def weighted(self) -> DataFrame:
        """``(part, doc_no, doc_id, term, tf, weight)`` of all postings, the weight null for
        terms outside the ranked vocabulary."""
        return self.weigh(self.idf.select("term", "idf"))

    def weigh(self, terms: DataFrame) -> DataFrame:
        """The postings with their weights and the columns of ``terms`` (written, one row per ``term``, with its
        ``idf``), null for terms it lacks. One pass over the bucketed postings, which aren't shuffled, so the
        weights need not be written."""
        return C.unit_length(C.with_terms(self.numbered, self.part_terms, terms, self.parts), "part", "doc_no")

    @cached_property
    def weights(self) -> DataFrame:
        """The weighted index ``(doc_id, term, tf, weight)``, unit length per document."""
        return self.weighted.where("weight is not null").select("doc_id", "term", "tf", "weight")

    @cached_property
    def store(self) -> PostingStore:
        """The term-ordered posting blocks, bitmaps and directory."""
        stats = self.term_stats.join(self.idf.select("term", "idf"), "term", "left")
        rows = self.term_stats.agg(F.sum("df")).first()[0] or 0
        shards = self.shards or partitions_for(self.docs.sparkSession, rows * POSTING_BYTES, SHARD_BYTES)
        stats = materialize(stats, "directory-stats")
        # shards come to the postings with the idf, so they are evaluated and shuffled once
        placed = self.weigh(term_places(stats, rows, shards)).withColumn("shard", shard_of(F.shiftright("doc_no", BLOCK_BITS)))
        return PostingStore.write(placed, stats, shards=shards)

    @cached_property
    def vocabulary(self) -> DataFrame:
        """``(term_id, term)`` of every index term, dense in term order."""
        return C.dense_ids(self.term_stats, "term", "term_id")

    # ----------------------------------------------------------- queries --

    def query_counts(self, queries: DataFrame) -> DataFrame:
        """``(query_id, term, tf)`` of a batch in index terms, written once."""
        stems = ST.query_stems(queries) if self.stem else None
        return materialize(C.query_counts(queries, stems=stems), "query-counts")

    def query_vectors(self, queries: DataFrame, counts: DataFrame | None = None) -> DataFrame:
        """``(query_id, term, tf, weight)``: unit-length query vectors with the fitted idf."""
        counts = counts if counts is not None else self.query_counts(queries)
        return C.transform(counts, self.idf, id_col="query_id")

    def located(self, queries: DataFrame) -> DataFrame:
        """A batch's terms in the store: ``(query_id, term, tf, weight, shard, ...)``, the weight null
        for known terms outside the ranked vocabulary."""
        return self.store.locate(C.transform(self.query_counts(queries), self.idf, id_col="query_id", keep_unknown=True))

    def conjunctive(self, queries: DataFrame) -> DataFrame:
        """Documents holding every known term of each query."""
        return S.conjunctive_bitmaps(self.store, self.located(queries))

    def cosines(self, queries: DataFrame) -> DataFrame:
        """``(query_id, doc_id, score)`` of all documents that share a term with a query."""
        return S.stored_scores(self.store, self.located(queries))

    def ranked(self, queries: DataFrame, k: int = 5, maxima: bool = True) -> DataFrame:
        """R2: top ``k`` documents per query by TF-IDF cosine. With ``maxima``, block maxima
        decide which postings are scored; without, all are, in fewer jobs (for small indexes)."""
        if not maxima:
            return S.top_k(self.cosines(queries), k)
        return S.ranked_blocks(self.store, self.located(queries), k).top

    def two_stage(self, queries: DataFrame, places: DataFrame, cuisine: str, facility: str,
                  price: bool = True, k: int = 10) -> DataFrame:
        """Conjunctive filter, composite score, true top ``k``."""
        return S.two_stage_stored(self.store, self.located(queries), places, cuisine, facility, price, k)
