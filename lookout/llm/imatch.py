"""I-Match document fingerprints.

A document's terms are its distinct words. Of these only terms within a band of
inverse document frequency count (found in at least ``LEAST_DOCS`` and at most a share of
``MOST`` of all documents: neither words of one text nor function words). For each of
several random subsets of this lexicon, the document's terms in it are sorted and
hashed; the fingerprint is the list of hashes (``-`` for no term). Subsets of four
sizes let fingerprints of partly equal texts agree in part: the likeness of two is
the share of equal hashes among those that either has.

With ``whole``, a text without any hash of lexicon terms takes all its words for
lexicon: the first hash is that of all its terms, the others are those of the subsets.
A text like that is compared with any other by the hashes of all words of both.
Without it, such texts share the fingerprint of dashes.

All terms' document frequencies are counted, over rows or, with ``whole``, over
distinct texts, so that a group of copies doesn't move its words out of the band. No text
is shuffled for that: a term's least and greatest text hash tell whether it stands in one text
only, and rows that have copies take their surplus off the terms above the band.

The lexicon grows with the corpus; its size is measured against ``LEXICON_BOUND``. Up to it, all
tasks get it. Beyond, a text's lexicon terms are found by exclusion (:func:`_by_exclusion`): those
above the band are few whatever the corpus, and those below it stand in one text, to which they
are sent, so no posting is shuffled; only the words that cutting a text makes are looked up.

The next document's text comes by one shuffle: documents go to blocks of
consecutive ids, each block's first document to the block before it as well, and a
window takes the next row in the block. All later steps keep that partitioning.

Only DataFrame operations are used. Defined results: null text is empty, with no
terms, and two fingerprints without any hash have likeness 1 (with ``whole``, only texts
without any word have one); rows with null ``doc_id`` come first in order, equal ``doc_id`` in the order of
their texts; one document alone is its own next; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookout.llm.common import checkpoint_root, id_text, materialize, parts_for

LEAST_DOCS = 2          # documents that a term stands in
LEAST = 0.0             # share of them, for callers that want a smaller lexicon
MOST = 0.05
# random subsets of the lexicon: each keeps one term in so many
SUBSETS = (4,) * 2 + (16,) * 4 + (64,) * 6 + (256,) * 12
LEXICON_BOUND = 2_000_000
COPIES_BOUND = 2_000_000    # hashes of texts that have copies, at a time
BLOCK_ROWS = 2048
MOST_BLOCKS = 100_000
BLOCKS_A_TASK = 2           # where a shuffle's number of tasks is fixed


def term_ids(text: Column) -> Column:
    """Distinct words of a text (letters and digits, lower case), hashed."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def _in_subset(k: int) -> Callable[[Column], Column]:
    """Whether subset ``k`` holds a term."""
    return lambda t: F.pmod(F.xxhash64(t, F.lit(k + 1)), F.lit(SUBSETS[k])) == 0


@dataclass(frozen=True)
class Band:
    """Terms by document frequency."""
    within: DataFrame            # t
    above: DataFrame             # t; a share of the texts each, so at most 1 / MOST times as many as a text has on average
    below: DataFrame | None      # h, t: terms that only the text of hash h has; None if those below stand in more


def _surplus(docs: DataFrame, copies: DataFrame, terms: DataFrame) -> DataFrame:
    """(``t``, ``more``): by how much a term's rows outnumber its texts, for ``terms`` in rows that have copies. The
    hashes of such texts go to all tasks, ``COPIES_BOUND`` at a time."""
    copied = copies.where("copies > 1")
    turns = -(-copied.count() // COPIES_BOUND)
    out = terms.select("t", F.lit(0.0).alias("more"))
    for i in range(turns):
        some = F.broadcast(copied.where(F.pmod("h", F.lit(turns)) == i))
        rows = docs.select("text", F.xxhash64("text").alias("h")).join(some, "h")
        # a row counts one by its copies; the shares of a text add up to one but for rounding
        out = out.unionByName(rows.select((1 - 1 / F.col("copies")).alias("more"), F.explode(term_ids(F.col("text"))).alias("t"))
                              .join(terms.select("t"), "t").select("t", "more"))
    return out.groupBy("t").agg(F.round(F.sum("more")).cast("long").alias("more"))


def band(docs: DataFrame, least: float = LEAST, most: float = MOST, whole: bool = False) -> Band:
    """Counts all terms, over rows or with ``whole`` over distinct texts."""
    h = F.xxhash64("text").alias("h")
    if whole:
        copies = materialize(docs.groupBy(h).agg(F.count(F.lit(1)).alias("copies")), "imatch-copies")
        n = copies.count()
    else:
        n = docs.count()
    low, top = max(LEAST_DOCS, least * n), max(LEAST_DOCS, most * n)
    counts = materialize(docs.select(h, F.explode(term_ids(F.col("text"))).alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("df"), F.min("h").alias("lo"), F.max("h").alias("hi")), "imatch-terms")
    single = F.col("lo") == F.col("hi") if whole else F.col("df") == 1
    if whole:
        # rows are no fewer than texts, so up to the top only one text or more has to be told
        unsure = F.col("df") > top if low <= 2 else F.col("df") >= low
        some = materialize(counts.where(unsure & ~single).select("t", "df"), "imatch-unsure")
        exact = materialize(some.join(_surplus(docs, copies, some), "t").select("t", (F.col("df") - F.col("more")).alias("df")), "imatch-exact")
        within = exact.where(F.col("df").between(low, top)).select("t")
        if low <= 2:
            within = within.unionByName(counts.where(~unsure & ~single).select("t"))
    else:
        exact = counts
        within = counts.where(F.col("df").between(low, top)).select("t")
    return Band(within, exact.where(F.col("df") > top).select("t"),
                counts.where(single).select(F.col("lo").alias("h"), "t") if low <= 2 else None)


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST, whole: bool = False) -> DataFrame:
    """Terms (``t``) within the band, each with the numbers of its subsets. Document
    frequencies are counted over rows, or with ``whole`` over distinct texts."""
    return _with_subsets(band(docs, least, most, whole).within)


def _with_subsets(terms: DataFrame) -> DataFrame:
    chosen = F.array(*(F.when(_in_subset(k)(F.col("t")), F.lit(k)) for k in range(len(SUBSETS))))
    return terms.select("t", F.filter(chosen, lambda k: k.isNotNull()).alias("subsets"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either has terms in."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == "-") & (y == "-"), F.lit(None)).otherwise((x == y).cast("double")))
    held = F.filter(pairs, lambda x: x.isNotNull())
    total = F.aggregate(held, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(held) == 0, F.lit(1.0)).otherwise(total / F.size(held))


def _listed(hashes: Column) -> Column:
    """The hash of every subset, ``-`` where the text has no term in it."""
    return F.array(*(F.coalesce(F.try_element_at(hashes, F.lit(k)), F.lit("-")) for k in range(len(SUBSETS))))


def _hash(terms: Column) -> Column:
    return F.substring(F.sha1(F.array_join(terms.cast("array<string>"), " ")), 1, 10)


def _of_all_terms(text: Column) -> Column:
    """A fingerprint from all words of a text: their hash, and those of the subsets."""
    def hashes(terms: Column) -> Column:
        kept = [terms] + [F.filter(terms, _in_subset(k)) for k in range(1, len(SUBSETS))]
        return F.array(*(F.when(F.size(x) > 0, _hash(x)).otherwise(F.lit("-")) for x in kept))
    return F.element_at(F.transform(F.array(F.sort_array(term_ids(text))), hashes), 1)


def _no_hash(hashes: Column) -> Column:
    return F.forall(hashes, lambda h: h == "-")


def _compared(a: Column, b: Column, text_a: Column, text_b: Column) -> Column:
    """Likeness by lexicon terms, or by all where one of the texts has none."""
    return F.when(_no_hash(a) | _no_hash(b), likeness(_of_all_terms(text_a), _of_all_terms(text_b))) \
        .otherwise(likeness(a, b))


def _with_next(docs: DataFrame, below: DataFrame | None = None, tasks: int = 0) -> DataFrame:
    """Rows (``block``, ``ghost``, ``doc_id``, ``text``, ``next_text``, ``place``); a ghost is the row after
    a block's last one, without a next text of its own. With ``below`` (``h``, ``t``), also the terms that only the text
    and only the next text have (``rare``, ``next_rare``): they come to its blocks by the texts' shuffle, which then has
    so many ``tasks``: as their number is fixed, it is done once for all that reads it."""
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    blocks = max(1, min(MOST_BLOCKS, -(-n // BLOCK_ROWS)))
    lo, hi = (0, 0) if lo is None else (lo, hi)
    # in doubles, as ids may span more than a long; only the order of the blocks matters
    width = (float(hi) - float(lo) + 1) / blocks
    block = F.coalesce(F.floor((F.col("doc_id").cast("double") - float(lo)) / width), F.lit(0).cast("long"))
    # one row per block: at most MOST_BLOCKS rows, so the broadcast is bounded
    placed = docs.withColumn("block", block)
    heads = placed.groupBy("block").agg(F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("head"))
    order = Window.orderBy("block")
    heads = materialize(heads.select("head", F.col("block").alias("of"), F.lag("block").over(order).alias("before"),
                                     F.last("block").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("last")),
                        "block-heads")
    heads = heads.select("head", "of", F.coalesce("before", "last").alias("before"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    joined = placed.join(F.broadcast(heads), (key == F.col("head")) & (F.col("block") == F.col("of")), "left")
    homes = F.when(F.col("before").isNull(), F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("ghost")))) \
        .otherwise(F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("ghost")),
                           F.struct(F.col("before").alias("block"), F.lit(1).alias("ghost"))))
    both = joined.select(F.explode(homes).alias("h"), "doc_id", "text").select("h.block", "h.ghost", "doc_id", "text")
    more = []
    if below is not None:
        h = F.xxhash64("text").alias("h")
        rare = below.groupBy("h").agg(F.collect_list("t").alias("rare")) \
            .join(both.select("block", h).distinct(), "h").withColumn("mark", F.lit(0))
        both = both.withColumns({"h": h, "mark": F.lit(1)}).unionByName(rare, allowMissingColumns=True).repartition(tasks, "block")
        so_far = Window.partitionBy("block", "h").orderBy("mark").rowsBetween(Window.unboundedPreceding, 0)
        none = F.array().cast("array<long>")
        both = both.withColumn("rare", F.coalesce(F.first("rare", ignorenulls=True).over(so_far), none)).where("mark = 1")
        more = ["rare"]
    order = Window.partitionBy("block").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "text")
    return both.select("block", "ghost", "doc_id", "text", *more, F.lead("text").over(order).alias("next_text"),
                       *(F.coalesce(F.lead(c).over(order), none).alias(f"next_{c}") for c in more),
                       F.row_number().over(order).alias("place"))


def _edited(rows: DataFrame) -> DataFrame:
    """The rows with ``n_chars``, the edited text and ``meta``, what stands once per row."""
    half = F.expr("length(text) div 2")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")) \
        .withColumn("edited", F.concat(F.expr("left(text, int(length(text) - length(text) div 2))"),
                                       F.coalesce(F.left("next_text", half), F.lit(""))))
    return rows.withColumn("meta", F.struct("n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited"))


def _tagged(own: Column, other: Column) -> Column:
    """One entry per term and text of it, with a bit for each text; an entry of bit 0, under a
    number of its own so that a shuffle spreads them, keeps what stands once per row."""
    return F.concat(F.transform(own, lambda t: F.struct(t.alias("t"), F.lit(1).alias("w"))),
                    F.transform(other, lambda t: F.struct(t.alias("t"), F.lit(2).alias("w"))),
                    F.array(F.struct(F.xxhash64("block", "place", "doc_id").alias("t"), F.lit(0).alias("w"))))


KEPT = ("block", "place", "ghost", "doc_id", "meta", "w", "t", "k")


def _long(rows: DataFrame, own: Column, other: Column) -> DataFrame:
    return rows.select("block", "place", "ghost", "doc_id", F.explode(_tagged(own, other)).alias("x"), "meta") \
        .select("block", "place", "ghost", "doc_id", "x.t", "x.w", F.when(F.col("x.w") == 0, F.col("meta")).alias("meta"))


def _by_join(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """A row per (row, text of it, lexicon term, subset ``k``), and one of bit 0 per row; terms joined to the lexicon."""
    rows = _edited(_with_next(docs))
    return _long(rows, term_ids(F.col("text")), term_ids(F.col("edited"))).join(terms, "t", "left") \
        .where("w = 0 or subsets is not null").withColumn("k", F.explode_outer("subsets")).select(*KEPT)


def _by_exclusion(docs: DataFrame, terms: DataFrame, found: Band) -> DataFrame:
    """:func:`_by_join` without shuffling postings. A word of a text or its next one is in the lexicon unless it is above
    the band or only that text has it. Words of the edited text that neither has, made by the cuts and at most a few, are
    looked up and come back to their block."""
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            min(MOST_BLOCKS, parts_for(docs.count(), BLOCKS_A_TASK * BLOCK_ROWS)))
    rows = _edited(_with_next(docs, found.below, n)) \
        .withColumns({"own": term_ids(F.col("text")), "other": term_ids(F.col("edited")),
                      "next": F.coalesce(term_ids(F.col("next_text")), F.array().cast("array<long>"))})
    rows = rows.withColumn("both", F.concat("own", "next")).withColumn("out", F.concat("rare", "next_rare"))
    within = F.array(*(_in_subset(k)(F.col("t")) for k in range(len(SUBSETS))))
    above = F.broadcast(found.above.withColumn("above", F.lit(True)))
    known = F.array_intersect(F.array_except("other", "out"), "both")
    kept = _long(rows, F.array_except("own", "rare"), known).join(above, "t", "left").where("w = 0 or above is null") \
        .select("*", F.posexplode(within).alias("k", "is_in")).where("if(w = 0, k = 0, is_in)") \
        .withColumn("k", F.when(F.col("w") > 0, F.col("k"))).select(*KEPT)
    # the same columns as above, for the same shuffle
    new = F.array_except(F.array_except("other", "both"), "out")
    cut = rows.select("block", "place", F.explode(new).alias("t")).join(terms, "t") \
        .select("block", "place", "t", F.lit(2).alias("w"), F.explode("subsets").alias("k"))
    return kept.unionByName(cut.repartition(n, "block"), allowMissingColumns=True)


def fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST, whole: bool = False) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): fingerprints of its text and of its
    edited text (second half replaced by the next document's start), and how
    alike its fingerprint is to the edited text's and the next document's; for
    ``whole`` see above."""
    checkpoint_root(docs.sparkSession)
    docs = id_text(docs)
    found = band(docs, least, most, whole)
    terms = materialize(_with_subsets(found.within).where("size(subsets) > 0"), "imatch-lexicon")
    if terms.count() <= LEXICON_BOUND:
        kept = _by_join(docs, F.broadcast(terms))
    elif found.below is None:        # with a share as least, the lexicon is bounded by it
        kept = _by_join(docs, terms)
    else:
        kept = _by_exclusion(docs, terms, found)
    # the sorted terms of each (row, text, subset) make a hash, a row's hashes its fingerprints
    sets = kept.groupBy("block", "place", "w", "k").agg(
        F.max("ghost").alias("ghost"), F.max("doc_id").alias("doc_id"), F.max("meta").alias("meta"),
        F.sort_array(F.collect_list("t")).alias("terms"))
    hashed = F.struct("k", _hash(F.col("terms")).alias("h"))
    docs_ = sets.groupBy("block", "place").agg(
        F.max("ghost").alias("ghost"), F.max("doc_id").alias("doc_id"), F.max("meta").alias("meta"),
        F.map_from_entries(F.collect_list(F.when(F.col("w") == 1, hashed))).alias("a"),
        F.map_from_entries(F.collect_list(F.when(F.col("w") == 2, hashed))).alias("b")) \
        .withColumn("a", _listed(F.col("a"))).withColumn("b", _listed(F.col("b")))
    order = Window.partitionBy("block").orderBy("place")
    out = docs_.withColumn("c", F.lead("a").over(order)) \
        .withColumn("next_text", F.lead("meta.text").over(order)).where("ghost = 0")
    pairs = (("b", "meta.edited"), ("c", "next_text"))
    if whole:
        shown = [F.when(_no_hash(F.col(x)), _of_all_terms(F.col(text))).otherwise(F.col(x))
                 for x, text in (("a", "meta.text"), ("b", "meta.edited"))]
        near = [_compared(F.col("a"), F.col(x), F.col("meta.text"), F.col(text)) for x, text in pairs]
    else:
        shown = [F.col("a"), F.col("b")]
        near = [likeness(F.col("a"), F.col(x)) for x, _ in pairs]
    return out.select("doc_id", "meta.n_chars", "meta.edited_sha256", F.array_join(shown[0], ".").alias("fingerprint"),
                      F.array_join(shown[1], ".").alias("edited_fingerprint"),
                      near[0].alias("near_edited"), near[1].alias("near_next"))
