"""URL filter by association rules.

A URL's tokens are its scheme, host, host suffixes, path words and query names.
Urls that a given host-and-path rule decides are labelled by it; the others carry
the label ``none``, so a combination is not called blocked because the few
labelled urls that have it are. FP-growth mines frequent combinations of tokens
and label over all urls, and the association rules that end in ``block`` or ``allow``
are pruned by confidence, support and lift.
Urls are matched through an inverted index from token to rules: a rule fires
when all its tokens are met, and the most confident one decides. A url that no
given rule fits and no mined rule fires on is allowed.

Tokens that stand in exactly the same urls (a host implies its suffixes, a url that
holds a third of all rows brings all its words) are one item to the mining, and a
rule names all of them; otherwise n such tokens would give 2^n combinations that say the
same. Matching runs once per distinct set of tokens, so a host with a third of all
pages is matched few times.

Only DataFrame operations and Spark's own FP-growth are used. Defined results:
null urls and urls without ``://`` have an empty host and path, fit no rule and
are allowed; equal ``page_id`` and repeated rows give a row each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import checkpoint_root, materialize

SUPPORT = 0.01
CONFIDENCE = 0.9
LIFT = 1.05
MOST_LABELS = 127            # of a host name; of a longer host the suffixes up to here and the whole
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]          # verdict, host, path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host in lower case, both empty without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.regexp_extract(F.coalesce(url, F.lit("")), shape, 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.coalesce(url, F.lit("")), shape, 2)


def given_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(MOST_LABELS))), lambda i: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, n - i + 1, i), ".")))
    suffixes = F.concat(suffixes, F.array(F.concat(F.lit("host:"), host)))
    words = F.transform(F.filter(F.split(F.lower(path), "[^a-z]+"), lambda w: w != ""), lambda w: F.concat(F.lit("path:"), w))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda w: w != ""),
                        lambda w: F.concat(F.lit("query:"), F.substring_index(w, "=", 1)))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(F.coalesce(url, F.lit("")), "://", 1))))
    return F.when(host == "", F.array().cast("array<string>")) \
        .otherwise(F.array_distinct(F.concat(scheme, suffixes, words, names)))


def groups(rows: DataFrame) -> DataFrame:
    """``(token, item, members)`` of stored rows (``tokens``): tokens that stand in the same rows have
    one ``item``, the least of them, and all ``members``. Rows are told apart by their distinct
    set of tokens; covers are compared by size and three independent sums of hashes."""
    sets = rows.groupBy(F.sort_array(F.array_distinct("tokens")).alias("tokens")).agg(F.count(F.lit(1)).alias("n"))
    hashes = [F.sum(F.xxhash64("tokens", F.lit(seed)).cast("decimal(38,0)")).alias(f"h{seed}") for seed in range(3)]
    marked = sets.select("tokens", "n", F.explode("tokens").alias("token"))
    cover = marked.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sets"), *hashes)
    listed = cover.groupBy("n", "sets", "h0", "h1", "h2").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return listed.select(F.explode("members").alias("token"), F.col("members")[0].alias("item"), "members")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
         lift: float = LIFT) -> DataFrame:
    """Rules (``rule_id``, ``tokens``, ``verdict``, ``confidence``, ``support``) from stored rows
    (``tokens``, ``label``)."""
    # only frequent tokens can stand in a rule, so only they are grouped
    n = labelled.count()
    frequent = labelled.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token") \
        .agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= support * n).select("token")
    frequent = materialize(frequent, "url-frequent")
    sets = labelled.groupBy(F.sort_array(F.array_distinct("tokens")).alias("tokens"), "label").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("set_id", F.xxhash64("tokens"))
    sets = materialize(sets, "url-sets")
    kept = sets.select("set_id", "label", "n", F.explode("tokens").alias("token")).join(frequent, "token")
    kept = kept.groupBy("set_id", "label", "n").agg(F.collect_list("token").alias("tokens"))
    members = materialize(groups(kept.select("tokens")), "url-groups")
    items = kept.select("set_id", "label", "n", F.explode("tokens").alias("token")) \
        .join(members.select("token", "item"), "token").groupBy("set_id", "label", "n").agg(F.collect_set("item").alias("items"))
    # every row is a transaction, those without a frequent token too
    rest = sets.join(items.select("set_id", "label"), ["set_id", "label"], "left_anti").select("label", "n", F.array().cast("array<string>").alias("items"))
    rows = materialize(items.select("label", "n", "items").unionByName(rest), "url-items")
    transactions = rows.select(F.concat("items", F.array(F.concat(F.lit("="), F.col("label")))).alias("items"),
                               F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("items")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(transactions)
    rules = model.associationRules.where(F.col("consequent")[0].isin("=block", "=allow")
                                         & ~F.exists("antecedent", lambda x: x.startswith("="))
                                         & (F.col("lift") >= lift))
    rules = materialize(rules.select("antecedent", F.expr("substring(consequent[0], 2)").alias("verdict"), "confidence", "support")
                        .withColumn("id", F.xxhash64("antecedent", "verdict")), "url-mined")
    named = rules.select("id", "verdict", "confidence", "support", F.explode("antecedent").alias("item")) \
        .join(members.where("token = item").select("item", "members"), "item").groupBy("id", "verdict", "confidence", "support") \
        .agg(F.sort_array(F.flatten(F.collect_list("members"))).alias("tokens"))
    return named.select("tokens", "verdict", "confidence", "support", F.xxhash64("tokens").alias("rule_id"))


def judge(pages: DataFrame, rules: list[Rule], support: float = SUPPORT,
          confidence: float = CONFIDENCE) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``): ``host``, ``path``, the given ``rule`` or
    null, ``verdict``, and the mined rule that decided, if one did."""
    checkpoint_root(pages.sparkSession)
    url = F.col("url").cast("string")
    host, path = url_parts(url)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), tokens(url, host, path).alias("tokens"),
                        given_rule(host, path, rules).alias("given"))
    rows = materialize(rows, "url-tokens")
    labelled = rows.where("size(tokens) > 0") \
        .select("tokens", F.coalesce("given.verdict", F.lit("none")).alias("label"))
    mined = materialize(mine(labelled, support, confidence), "url-rules")

    # inverted index: token -> rules; each distinct set of indexed tokens is matched once
    index = materialize(mined.select("rule_id", F.size("tokens").alias("need"), F.explode("tokens").alias("token")),
                        "url-index")
    open_ = rows.where("given is null and size(tokens) > 0").select(F.sort_array("tokens").alias("tokens")).distinct() \
        .withColumn("set_id", F.xxhash64("tokens"))
    met = open_.select("set_id", F.explode("tokens").alias("token")).join(index, "token") \
        .groupBy("set_id", "rule_id", "need").agg(F.count(F.lit(1)).alias("have")).where("have = need")
    best = met.join(mined.select("rule_id", "tokens", "verdict", "confidence", "support"), "rule_id") \
        .groupBy("set_id").agg(F.max(F.struct("confidence", "support", F.col("verdict") == "block", "tokens", "verdict"))
                               .alias("best")) \
        .select("set_id", F.col("best.verdict").alias("mined"), F.array_join("best.tokens", " ").alias("mined_rule"))
    best = materialize(best, "url-verdicts")
    out = rows.withColumn("set_id", F.when(F.col("given").isNull(), F.xxhash64(F.sort_array("tokens")))) \
        .join(best, "set_id", "left")
    return out.select("page_id", "host", "path", F.col("given.rule").alias("rule"),
                      F.coalesce("given.verdict", "mined", F.lit("allow")).alias("verdict"), "mined_rule")
