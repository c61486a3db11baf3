"""Document fingerprints (operator 6), DataFrame functions only: SpotSigs.

A spot signature is a chain of ``CHAIN`` content words that follows a common
word (an anchor); the text's start is an anchor too, so that every text with a
content word has one. A document's fingerprint is its sorted set of 32-bit
hashes of signatures. Likeness is the Jaccard resemblance of two sets. The
quotient of the two set lengths bounds it from above, which partitions sets by
length and prunes comparisons.

Fixed words alone leave texts without them (tables, code, other languages) with
next to no signature. With ``cover`` all common words are anchors, a run of more
than ``CHAIN`` of them (or one that ends the text) is content, a content word
whose hash says so starts a chain, and so does one that ``CHAIN`` words without a
start precede. Then every content word lies in a signature.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

CHAIN = 3
# Articles, forms of "to be" and pronouns that start a chain ...
ANCHORS = ("the a an is was are this that "
           "der die das ein eine ist "
           "le la les un une est "
           "el los las una es").split()
# ... and other common words, which chains pass over.
COMMON = ("of and to in for with on as by at from it or be not "
          "und den dem von zu im mit auf nicht für "
          "de des du et en que qui pour dans au "
          "del y se por con para su lo").split()
_MARK = "\u0001"
#: With ``cover``, one content word in so many starts a chain by its hash.
ONE_IN = 4


def _any(words: list[str]) -> str:
    return "(?<![^ ])(?:" + "|".join(words) + ") "


def _covered(plain: Column, chain: int) -> Column:
    """Content words with marks at most ``chain`` words apart."""
    common = "(?:" + "|".join(ANCHORS + COMMON) + ") "
    spots = F.concat(F.lit(_MARK), F.regexp_replace(
        F.concat(F.trim(plain), F.lit(" ")), f"(?<![^ ])(?:{common}){{1,{chain}}}(?!{common}|$)", _MARK))
    chosen = lambda w: (w != "") & ~w.startswith(_MARK) & (F.pmod(F.hash(w), F.lit(ONE_IN)) == 0)
    words = F.transform(F.split(spots, " "), lambda w: F.when(chosen(w), F.concat(F.lit(_MARK), w)).otherwise(w))
    free = f"[^ {_MARK}]"
    return F.regexp_replace(F.array_join(words, " "), f"(?<!{free})((?:{free}++ ){{{chain}}})(?={free})", f"$1{_MARK}")


def chains(text: Column, chain: int = CHAIN, cover: bool = False) -> Column:
    """A text's spot signatures in order, as words; null for null."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    if cover:
        spots = _covered(plain, chain)
    else:
        content = F.regexp_replace(F.concat(F.ltrim(plain), F.lit(" ")), _any(COMMON), "")
        spots = F.concat(F.lit(_MARK), F.regexp_replace(content, _any(ANCHORS), _MARK))
    word = f"{_MARK}*[^ {_MARK}]+"  # with the marks of its own anchors
    found = F.regexp_extract_all(spots, F.lit(f"{_MARK}(?=({word}(?: {word}){{0,{chain - 1}}}))"), F.lit(1))
    return F.transform(found, lambda c: F.translate(c, _MARK, ""))


def signatures(text: Column, chain: int = CHAIN, cover: bool = False) -> Column:
    """Sorted distinct hashes (int) of a text's spot signatures; null for null."""
    return F.array_sort(F.array_distinct(F.transform(chains(text, chain, cover), lambda c: F.hash(c))))


def fingerprint(hashes: Column) -> Column:
    """The set as text: eight hex digits for each signature."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard resemblance of two sets; 1 for two empty ones. Pairs whose
    lengths rule out ``at_least`` get 0 without being compared."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (F.when(longer == 0, 1.0)
            .when((shorter == 0) | (shorter < longer * at_least), 0.0)
            .otherwise(shared / (F.size(a) + F.size(b) - shared)))


def length_partition(length: Column, threshold: float) -> Column:
    """Sets that may reach the threshold lie in the same or the next partition."""
    return F.floor(F.log(F.greatest(length, F.lit(1))) / -math.log(threshold)).cast("int")


def similar_sets(sets: DataFrame, threshold: float = 0.8, set_col: str = "hashes") -> DataFrame:
    """Pairs (low, high, likeness) of different equal-set classes that reach the
    threshold; ``sets`` has one row per class: (class, set).

    Sets are partitioned by length and meet where they share one of their
    rarest signatures: two sets with resemblance t share a signature among the
    first ``n - ceil(t n) + 1`` of each, in any common order.
    """
    s = sets.select("class", F.col(set_col).alias("hashes")).where(F.size("hashes") > 0)
    each = s.select("class", F.explode("hashes").alias("h"))
    order = each.groupBy("h").agg(F.count("*").alias("df"))
    ranked = (each.join(order, "h").groupBy("class")
              .agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("by_df")))
    n = F.size("by_df")
    prefix = ranked.select(
        "class", n.alias("n"),
        F.explode(F.slice("by_df", F.lit(1), n - F.ceil(n * threshold - 1e-9).cast("int") + 1)["h"]).alias("h"))
    part = length_partition(F.col("n"), threshold)
    left = prefix.select(F.col("class").alias("low"), F.col("n").alias("n_low"), "h",
                         F.explode(F.array(part - 1, part, part + 1)).alias("part"))
    right = prefix.select(F.col("class").alias("high"), F.col("n").alias("n_high"), "h", part.alias("part"))
    fits = F.least("n_low", "n_high") >= F.greatest("n_low", "n_high") * threshold - 1e-9
    pairs = left.join(right, ["h", "part"]).where((F.col("low") < F.col("high")) & fits).select("low", "high").distinct()
    a = s.select(F.col("class").alias("low"), F.col("hashes").alias("a"))
    b = s.select(F.col("class").alias("high"), F.col("hashes").alias("b"))
    return (pairs.join(a, "low").join(b, "high")
            .select("low", "high", likeness(F.col("a"), F.col("b"), threshold).alias("likeness"))
            .where(F.col("likeness") >= threshold))


def _neighbours(keys: DataFrame) -> DataFrame:
    """The row that follows each row of distinct (k1, k2, id, n_chars) in
    descending order of id (nulls last; ties by k1, k2), and after the last the
    first: (k1, k2, next1, next2) and the same seen from the next row.

    Rows are ordered in ranges; a row looks ahead within its range, and the last
    of a range takes the first of the next one, from a table of one row each.
    """
    order = [F.col("id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ids")
    inside = W.partitionBy("part").orderBy(*order)
    row = F.struct("k1", "k2")
    # heads: one row per range
    heads = (ranged.withColumn("at", F.row_number().over(inside)).where("at = 1")
             .select("part", row.alias("head"), F.lit(1).alias("one")))
    heads = heads.select(
        "part", F.coalesce(F.lead("head").over(W.partitionBy("one").orderBy("part")),
                           F.first("head").over(W.partitionBy("one").orderBy("part"))).alias("beyond"))
    return (ranged.withColumn("inside", F.lead(row).over(inside))
            .join(F.broadcast(heads), "part")  # at most one row per shuffle partition
            .select("k1", "k2", "n_chars", F.coalesce("inside", "beyond").alias("next")))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cover: bool = False) -> DataFrame:
    """(id, next_id, text, edited, hashes, next_hashes): each text, the text whose last
    third is replaced by the beginning of the next document's, and signatures."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = slim.select(F.xxhash64("id", "text").alias("k1"), F.xxhash64("text", "id").alias("k2"), "id", "text")
    texts = keyed.repartition("k1", "k2")  # texts move once; read twice
    keys = keyed.select("k1", "k2", "id", F.length("text").alias("n_chars")).distinct()
    links = staged(_neighbours(keys), "neighbours")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    asked = links.select(F.col("next.k1").alias("k1"), F.col("next.k2").alias("k2"),
                         F.col("k1").alias("for1"), F.col("k2").alias("for2"), third.alias("ask"))
    one_each = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("id").alias("next_id"))
    given = one_each.join(asked, ["k1", "k2"]).select(
        F.col("for1").alias("k1"), F.col("for2").alias("k2"), "next_id",
        F.substring("text", F.lit(1), F.col("ask")).alias("begin"), signatures(F.col("text"), cover=cover).alias("next_hashes"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    return (texts.join(given, ["k1", "k2"])
            .select("id", "next_id", "text", F.concat(F.substring("text", F.lit(1), n - cut), F.col("begin")).alias("edited"),
                    signatures(F.col("text"), cover=cover).alias("hashes"), "next_hashes"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cover: bool = False) -> DataFrame:
    """(doc_id, next_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    n_signatures, near_edited, near_next), one row per input row.

    A null text counts as empty; an empty text, or one without letters and
    digits, has an empty set, and two empty sets are alike (1). Null ids come
    last, ties of ids by a hash of id and text; rows equal in both are one
    document and get the same result each. A lone document is its own next one.
    Other columns are ignored; an empty table gives no rows. With ``cover`` every
    content word lies in a signature (see the top); without, anchors are the
    fixed words only.
    """
    with_both = with_edited(docs, id_col, text_col, cover).withColumn(
        "edited_hashes", signatures(F.col("edited"), cover=cover))
    return with_both.select(
        F.col("id").alias(id_col), "next_id", F.length("text").cast("long").alias("n_chars"),
        F.col("edited").alias("edited_text"),
        fingerprint(F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        F.size("hashes").alias("n_signatures"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
