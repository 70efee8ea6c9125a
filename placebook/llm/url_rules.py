"""URL filtering: stated host and path rules, then association rules mined from labelled URLs.

Method: every URL is a small set of tokens (host suffixes, path words, query keys). Spark's FP-growth mines
the combinations of the bad rows, which are then counted over all labelled rows; rules survive by support, by confidence, and only if no shorter
rule says the same as surely. They are matched by an inverted index: each rule is filed under its rarest
token, the URLs' tokens are joined to it, and a hit needs the whole combination.

Nulls, URLs without '://' and empty tables: host and path are empty, no token, no rule, verdict `allow`.
Repeated rows and repeated ids each keep their verdict. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.llm.common import Scratch, ascii_lower

#: Stated rules: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first '://' up to '/', '?', '#'; A-Z lower-cased. Path: then up to '?' or '#'."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def stated_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest stated rule that fits, as struct(rule, verdict); NULL if none does."""
    fits = [(F.when(((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p),
                    F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))))
            for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: host suffixes of up to three labels and the whole host, path words, the query's keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(3)),
                           lambda k: F.when(F.size(labels) >= k, F.concat(F.lit("h:"), F.array_join(F.slice(labels, -k, k), "."))))
    words = F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("[0-9]")),
                        lambda x: F.concat(F.lit("p:"), ascii_lower(x)))
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("q:"), F.split_part(x, F.lit("="), F.lit(1))))
    whole = F.array(F.when(F.size(labels) > 3, F.concat(F.lit("h:"), host)))
    return F.array_distinct(F.filter(F.concat(suffixes, whole, words, keys), lambda x: x.isNotNull()))


def mine(baskets: DataFrame, scratch: Scratch, min_support: int, min_confidence: float) -> DataFrame:
    """Rules (items, support, confidence, rarest) from baskets (items, bad): combinations that go with bad.

    min_support is a number of bad rows, at every size. Combinations are mined from the bad rows; those found are
    counted over all labelled rows, one row per distinct token set, filed under their rarest token.
    """
    rows = scratch.keep(baskets.groupBy(F.array_sort("items").alias("items")).agg(
        F.count("*").alias("n"), F.count_if("bad").alias("n_bad")), "baskets")
    bad = baskets.filter("bad").select("items")
    n = rows.agg(F.sum("n_bad")).first()[0]
    schema = "items array<string>, support long, confidence double, rarest string"
    if not n or n < min_support:
        return baskets.sparkSession.createDataFrame([], schema)
    share = max(min_support - 0.5, 0.5) / n                      # half a row less: rounding can't ask for one more
    sets = scratch.keep(FPGrowth(itemsCol="items", minSupport=share).fit(bad)
                        .freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("support")), "itemsets")
    single = scratch.keep(rows.select(F.explode("items").alias("token"), "n").groupBy("token").agg(F.sum("n").alias("freq")), "tokens")
    filed = (sets.select("items", "support", F.explode("items").alias("token")).join(single, "token")
             .groupBy("items", "support").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest")))
    filed = scratch.keep(filed.select(F.col("items").alias("needs"), "support", "rarest"), "filed")
    held = (rows.select("items", "n", F.explode("items").alias("rarest")).join(filed, "rarest")
            .filter(F.size(F.array_except("needs", "items")) == 0)
            .groupBy("needs", "support", "rarest").agg(F.sum("n").alias("freq")))
    rules = (held.select(F.col("needs").alias("items"), "support", (F.col("support") / F.col("freq")).alias("confidence"), "rarest")
             .filter(F.col("confidence") >= min_confidence))
    rules = scratch.keep(rules, "rules")
    # a rule is redundant if leaving out items gives a rule at least as sure
    shorter = (rules.select("items", "confidence", F.explode("items").alias("out"))
               .select("items", "confidence", F.array_remove("items", F.col("out")).alias("part"))
               .join(rules.select(F.col("items").alias("part"), F.col("confidence").alias("sure")), "part")
               .filter("sure >= confidence").select("items").distinct())
    return scratch.keep(rules.join(shorter, "items", "left_anti"), "index")


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, min_support: int = 20, min_confidence: float = 0.8) -> DataFrame:
    """pages (page_id, url) and labelled (page_id, bad boolean) -> page_id, host, path, rule, verdict, mined_rule,
    confidence. A stated rule decides first; else a page is blocked if a mined rule holds."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "url")
    host, path = host_path(F.col("url"))
    urls = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    urls = urls.withColumn("items", tokens(F.col("host"), F.col("path"), F.col("url")))
    taught = (labelled.filter("bad is not null and page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad")))
    baskets = urls.join(taught, "page_id").filter(F.size("items") > 0).select("items", "bad")
    index = mine(baskets, scratch, min_support, min_confidence)
    # one row per distinct token set: a hot host costs one look-up, not one per page
    sets = urls.filter(F.size("items") > 0).select("items").distinct()
    hits = (sets.withColumn("rarest", F.explode("items"))
            .join(index.select("rarest", F.col("items").alias("needs"), "confidence"), "rarest")
            .filter(F.size(F.array_except("needs", "items")) == 0)
            .groupBy("items").agg(F.max(F.struct("confidence", F.array_join("needs", "&").alias("mined_rule"))).alias("best")))
    out = urls.withColumn("stated", stated_rule(F.col("host"), F.col("path"), rules)).join(hits, "items", "left")
    return out.select(
        "page_id", "host", "path", F.col("stated.rule").alias("rule"),
        F.coalesce("stated.verdict", F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("best.mined_rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"))

