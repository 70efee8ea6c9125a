"""Which of many keys occur in which texts, by an inverted index over character grams or words.

A key occurs in a text only if all its grams do, so it is filed under one of them: the one that fewest texts
hold. Texts meet the keys filed under their grams, and a comparison in full settles what remains. Texts are worked on
once however often they occur, and neither side is ever held against all of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.session import materialise

GRAM = 8


def grams(text: Column, sizes: list[int]) -> Column:
    """Distinct runs of so many characters each."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def run(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        parts = F.transform(chars, lambda c, i: F.array_join(F.slice(chars, i + 1, n), ""))
        return F.filter(parts, lambda g: F.length(g) == n)

    runs = [run(n) for n in sizes]
    return F.array_distinct(F.concat(*runs))


def matches(texts: DataFrame, keys: DataFrame, text: str = "text", key: str = "key") -> DataFrame:
    """The rows of texts beside the rows of keys whose key is a substring of the text.

    Both tables' columns are kept and must differ in name; texts should be distinct. An empty key is in every text.
    Null texts and keys match nothing.
    """
    keys = keys.filter(F.col(key).isNotNull())
    texts = texts.filter(F.col(text).isNotNull())
    sizes = sorted(r[0] for r in keys.select(F.least(F.length(key), F.lit(GRAM)).alias("n")).distinct().collect())     # GRAM + 1 at most
    if not sizes:
        return texts.limit(0).join(keys.limit(0), F.lit(True))
    size = F.least(F.length(key), F.lit(GRAM))
    own = F.coalesce(*[F.when(size == n, grams(F.col(key), [n])) for n in sizes])
    filed = keys.select(F.col(key).alias("_key"), F.explode(own).alias("_gram")).distinct()
    said = materialise(texts.withColumn("_gram", F.explode(grams(F.col(text), sizes)))
                       .join(filed.select("_gram").distinct(), "_gram", "left_semi"), "text-grams")
    return _by_rarest(said, filed, keys, text, key)


def words(text: Column) -> Column:
    """Distinct words of a text, in a case that letters share if patterns that ignore case take them for one another."""
    folded = F.upper(F.replace(F.lower(text), F.lit("\u0307"), F.lit("")))       # the dot that a capital İ leaves above its small letter
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(r"(?U)(\w+)"), F.lit(1)))


def word_matches(texts: DataFrame, keys: DataFrame, text: str = "text", key: str = "key") -> DataFrame:
    """As `matches`, for keys that count only where words begin and end with them: rows whose key is a part of a word may be absent.

    All words of such a key are words of the text, so it is filed under the one that fewest texts hold: texts meet
    the keys that share a rare word with them, where three characters of a long registry's names are shared by nearly all.
    Keys without words (signs, or nothing at all) are looked up by grams.
    """
    keys = keys.filter(F.col(key).isNotNull())
    texts = texts.filter(F.col(text).isNotNull())
    has_word = F.size(words(F.col(key))) > 0
    filed = keys.filter(has_word).select(F.col(key).alias("_key"), F.explode(words(F.col(key))).alias("_gram")).distinct()
    said = materialise(texts.withColumn("_gram", F.explode(words(F.col(text))))
                       .join(filed.select("_gram").distinct(), "_gram", "left_semi"), "text-words")
    found = _by_rarest(said, filed, keys.filter(has_word), text, key)
    signs = keys.filter(~has_word)
    return found if signs.isEmpty() else found.unionByName(matches(texts, signs, text, key))


def _by_rarest(said: DataFrame, filed: DataFrame, keys: DataFrame, text: str, key: str) -> DataFrame:
    """Texts (said: with every _gram of theirs) beside the keys they hold, by the _gram of each key that fewest texts have."""
    often = said.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))
    rarest = filed.join(often, "_gram", "left").groupBy("_key").agg(F.min(rank)["gram"].alias("_gram"))
    postings = keys.join(rarest, F.col(key) == F.col("_key")).drop("_key")
    return said.join(postings, "_gram").filter(F.contains(F.col(text), F.col(key))).drop("_gram")


def first_match(texts: DataFrame, keys: DataFrame, order: str, text: str = "text", key: str = "key") -> DataFrame:
    """(text, order) of the first key, by `order`, that each text holds; texts that hold none are absent."""
    return matches(texts.select(text).distinct(), keys.select(order, key), text, key).groupBy(text).agg(F.min(order).alias(order))
