"""First come, first served: records in order, each takes the first of its choices still free."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placebook.operators.skew import lookup
from placebook.session import materialise, materialise_counting


def first_come(wishes: DataFrame) -> DataFrame:
    """Serve records in the order of `ord`: ord, choices -> ord, choice, tag.

    `choices` is an array of structs (key, tag), best first. Taken one record after the other, a key goes
    to the first record that gets round to it. The same allocation is reached in rounds: every record
    asks for its best remaining key, every key keeps the earliest asker, and the rest ask for their
    next. A key may change hands while earlier records are still being turned away elsewhere; when
    nobody is turned away any more, the result stands. Records that get nothing are absent.
    """
    state = materialise(wishes.filter(F.size("choices") > 0)
                        .select("ord", "choices", F.lit(0).alias("at")), "wishes")
    while True:
        asked = state.withColumn("key", F.get("choices", F.col("at"))["key"])
        best = asked.groupBy("key").agg(F.min("ord").alias("winner"))
        turned_away = F.expr("ord != winner and at + 1 < size(choices)")
        judged, n_lost = materialise_counting(
            lookup(asked, best, ["key"]), "wishes", turned_away)
        won = judged.filter("ord = winner")
        if n_lost == 0:
            return won.select("ord", F.col("key").alias("choice"), F.get("choices", F.col("at"))["tag"].alias("tag"))
        state = won.select("ord", "choices", "at").unionByName(
            judged.filter(turned_away).select("ord", "choices", (F.col("at") + 1).alias("at")))
