"""Map raw merchant spellings to vendors by exact or contained alias.

Containment starts from an equality join on grams: a text meets those others whose rarest
gram it holds, and only these are looked for in it. So the work follows the characters of
the distinct spellings and aliases, not their product, nor the lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.workspace import materialize, sized, spread

# Characters of a gram: enough that few texts share the rarest one of a longer text, numbered names included.
GRAM = 8
_BLANKS = " \t\n\r\x0b\x0c"


def needle(raw: Column) -> Column:
    """Trimmed lower-case spelling; empty text becomes NULL."""
    return F.nullif(F.lower(F.btrim(raw, F.lit(_BLANKS))), F.lit(""))


def alias_index(vendors: DataFrame) -> DataFrame:
    """``alias, pos, vendor_id``: one row per lower-case alias, the vendor's own name included.

    Aliases are numbered in vendor order. One that two vendors share keeps its first
    place and goes to the last of them.
    """
    names = F.concat(
        F.array("canonical_name"),
        F.coalesce(F.from_json("aliases_json", "array<string>"), F.array().cast("array<string>")),
    )
    spelled = vendors.select("vendor_id", F.posexplode(names).alias("i", "name")).select(
        F.lower("name").alias("alias"), "vendor_id", F.struct("vendor_id", "i").alias("pos")
    )
    return spelled.filter("alias <> ''").groupBy("alias").agg(
        F.min("pos").alias("pos"), F.max_by("vendor_id", "pos").alias("vendor_id")
    )


def _grams(size: int, text: Column) -> Column:
    """The distinct pieces of ``size`` characters, none if the text is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(size))))
    return F.when(F.length(text) >= size, pieces).otherwise(F.array().cast("array<string>"))


def _own_grams(text: Column) -> Column:
    """The grams a text can be found by: its own of ``GRAM`` characters, or the whole of a shorter one."""
    return F.when(F.length(text) < GRAM, F.array(text)).otherwise(_grams(GRAM, text))


def containing(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``text, pattern``: every pair of a distinct ``text`` and a distinct ``pattern`` that stands in it.

    A pattern is posted under that one of its grams which the fewest texts hold, so a text meets the patterns whose rarest
    gram it holds, and each is then looked for. A pattern shorter than a gram is its own. So a text gives at most ``GRAM``
    pieces per character, however many lengths the patterns have.
    """
    shorter = [row[0] for row in patterns.select(F.length("pattern").alias("n")).filter(F.col("n") < GRAM).distinct().collect()]
    grams = F.concat(_grams(GRAM, F.col("text")), *[_grams(n, F.col("text")) for n in shorter])
    held = materialize(texts.select("text", F.explode(grams).alias("gram")), "text_grams")
    frequency = held.groupBy("gram").agg(F.count("*").alias("texts"))
    # A gram that no text holds rules its pattern out.
    posted = (
        patterns.select("pattern", F.explode(_own_grams(F.col("pattern"))).alias("gram"))
        .join(frequency, "gram", "left")
        .groupBy("pattern").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("rarest"))
        .filter("rarest.texts > 0").select("pattern", "rarest.gram")
    )
    return held.join(posted, "gram").filter(F.contains("text", "pattern")).select("text", "pattern")


def canonicalize(spellings: DataFrame, index: DataFrame) -> DataFrame:
    """``raw, vendor_id`` for the distinct ``raw`` values of ``spellings``; no match gives NULL.

    An exact alias wins; else the longest alias that contains the spelling or is
    contained in it, the earliest alias on equal length.
    """
    # Written once: each is read by several of the joins below.
    raws = sized(materialize(spellings.select("raw").distinct().withColumn("needle", needle(F.col("raw"))), "spellings"))
    index = sized(materialize(index, "alias_index"))
    needles = raws.filter("needle IS NOT NULL").select("needle").distinct()
    exact = needles.join(index, F.col("needle") == F.col("alias")).select("needle", "vendor_id")
    misses = materialize(needles.join(index, F.col("needle") == F.col("alias"), "left_anti"), "misses")

    score = F.struct(
        (-F.length("alias")).alias("shorter"), F.col("pos").alias("pos"), F.col("vendor_id").alias("vendor_id")
    )
    # Small files that give many grams per row: one task would cut them all.
    misses, aliases = spread(misses), spread(index.select("alias"))
    inside = containing(misses.select(F.col("needle").alias("text")), aliases.select(F.col("alias").alias("pattern")))
    around = containing(aliases.select(F.col("alias").alias("text")), misses.select(F.col("needle").alias("pattern")))
    found = inside.select(F.col("text").alias("needle"), F.col("pattern").alias("alias")).unionByName(
        around.select(F.col("pattern").alias("needle"), F.col("text").alias("alias"))
    )
    loose = (
        found.join(index, "alias").groupBy("needle").agg(F.min(score).alias("score"))
        .select("needle", "score.vendor_id")
    )
    return raws.join(exact.unionByName(loose), "needle", "left").select("raw", "vendor_id")
