"""Line dedup (operator 10), DataFrame functions only: suffix array over
line-ID sequences by prefix doubling.

All documents' lines, by (id, line number), form one long sequence of line
IDs; suffixes end with their document. Suffixes that share a prefix stand
together in the suffix array: they are a longest-common-prefix interval, and
the first of them by position is the original, the others are later copies.

Prefix doubling gives each suffix the rank of its first 1, 2, 4, ... lines from
the ranks of the two halves. Only equality of ranks is used, so a rank is a
64-bit name (hash of the halves' names) and needs no global sort: windows over
each document make all of them. A prefix of any length is named by the two
powers that overlap on it.

A repeated run counts from ``MIN_CHARS`` characters on. So each suffix is cut
where its lines reach that many, which depends on the lines alone: suffixes
with the same cut prefix are one interval, and all but the first of them start
a repeated run. The same is done for prefixes that end at a line. Runs that
overlap merge, and their union is that of all maximal repeated runs: within a
maximal run, the prefix cut at its first line and those that end at each later
line lie in the run and cover it. Lines that occur once are dropped first; no
run contains them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_and_text, staged

MIN_CHARS = 60


def _lines(docs: DataFrame) -> DataFrame:
    """(k1, k2, id, pos, line, chars): k1 and k2 stand for id and text."""
    split = docs.select("k1", "k2", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "content"))
    return split.select("k1", "k2", "id", "pos", F.xxhash64("content").alias("line"),
                        (F.length("content") + 1).cast("long").alias("chars"))


def _repeated(lines: DataFrame) -> DataFrame:
    """Counts are summed before the shuffle, and the join is Spark's to deal, so
    that it can split a line that many documents share."""
    often = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line")
    return lines.join(often, "line")


def _named(lines: DataFrame, levels: int) -> DataFrame:
    """Names of the 1, 2, 4, ... lines from each position; null where the
    document (or the stretch of repeated lines) ends before."""
    doc = W.partitionBy("k1", "k2").orderBy("pos")
    # a repeated row of the table gives each position twice
    out = lines.withColumn("_before", F.lag("pos").over(doc)).where("_before is null or _before < pos")
    out = out.drop("_before").withColumnRenamed("line", "name0")
    for k in range(levels):
        step = 1 << k
        second = F.when(F.lead("pos", step).over(doc) == F.col("pos") + step, F.lead(f"name{k}", step).over(doc))
        out = out.withColumn(f"name{k + 1}", F.when(F.col(f"name{k}").isNotNull() & second.isNotNull(),
                                                    F.xxhash64(f"name{k}", second)))
    return out


def _cut_length(frame: Column, step: int, min_chars: int) -> Column:
    """Lines from the frame's first element on, ``step`` 1 or -1 per line, until
    they hold ``min_chars``; null if they end before."""
    start = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).alias("n"))
    reached = F.aggregate(frame, start, lambda acc, x: F.when(
        (acc["chars"] < min_chars) & (x["pos"] == F.col("pos") + step * acc["n"]),
        F.struct((acc["chars"] + x["chars"]).alias("chars"), (acc["n"] + 1).alias("n"))).otherwise(acc))
    return F.when(reached["chars"] >= min_chars, reached["n"])


def _run_name(frame: Column, n: Column, levels: int, step: int) -> Column:
    """Name of the n lines: their number and the names of the two powers of two
    that cover them. Element i of the frame is the line ``step * i`` away."""
    out = F.lit(None).cast("long")
    for k in range(levels + 1):
        size = 1 << k
        low, high = (F.lit(0), n - size) if step == 1 else (n - 1, F.lit(size - 1))
        name = F.xxhash64(n, F.get(frame, low)[f"name{k}"], F.get(frame, high)[f"name{k}"])
        fits = n >= size if k == levels else (n >= size) & (n < 2 * size)
        out = F.when(fits, name).otherwise(out)
    return out


def _runs(named: DataFrame, levels: int, min_chars: int) -> DataFrame:
    """Cut prefixes (k1, k2, id, pos, high, name): lines pos to high - 1."""
    doc = W.partitionBy("k1", "k2").orderBy("pos")
    line = F.struct("pos", "chars", *[f"name{k}" for k in range(levels + 1)])
    out = (named.withColumn("ahead", F.collect_list(line).over(doc.rowsBetween(0, min_chars - 1)))
           .withColumn("behind", F.reverse(F.collect_list(line).over(doc.rowsBetween(1 - min_chars, 0))))
           .withColumn("n_ahead", _cut_length(F.col("ahead"), 1, min_chars))
           .withColumn("n_behind", _cut_length(F.col("behind"), -1, min_chars)))
    run = lambda low, high, name: F.struct(low.cast("int").alias("pos"), high.cast("int").alias("high"), name.alias("name"))
    pos, n, m = F.col("pos"), F.col("n_ahead"), F.col("n_behind")
    both = F.array(run(pos, pos + n, _run_name(F.col("ahead"), n, levels, 1)),
                   run(pos - m + 1, pos + 1, _run_name(F.col("behind"), m, levels, -1)))
    return (out.select("k1", "k2", "id", F.explode(F.array_distinct(both)).alias("run"))
            .select("k1", "k2", "id", "run.*").where("name is not null"))


def _later_copies(runs: DataFrame) -> DataFrame:
    place = F.struct("id", "k1", "k2", "pos", "high")  # all columns: both uses read one exchange
    dealt = runs.repartition("name")
    first = dealt.groupBy("name").agg(F.min(place).alias("first"))
    return dealt.join(first, "name").where(F.col("first") < place).select("k1", "k2", "pos", "high")


def _merged(runs: DataFrame) -> DataFrame:
    """Per document, sorted disjoint ranges [low, high) of deleted lines."""
    doc = W.partitionBy("k1", "k2").orderBy("pos", "high")
    seen = F.max("high").over(doc.rowsBetween(W.unboundedPreceding, -1))
    return (runs.withColumn("new", F.when(seen >= F.col("pos"), 0).otherwise(1))
            .withColumn("island", F.sum("new").over(doc.rowsBetween(W.unboundedPreceding, 0)))
            .groupBy("k1", "k2", "island").agg(F.min("pos").alias("low"), F.max("high").alias("high"))
            .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans")))


def _cut(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, rest, spans, n_lines, kept_text): the rows of ``docs`` with the
    deleted ranges of their lines; ``rest`` holds the other columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*others) if others else F.lit(None).cast("void")
    slim = docs.select(*id_and_text(docs, id_col, text_col), rest.alias("rest"))
    keyed = slim.select(F.xxhash64("id", "text").alias("k1"), F.xxhash64("text", "id").alias("k2"), "id", "text", "rest")
    lines = _repeated(staged(_lines(keyed.where(F.col("text").isNotNull())), "lines"))
    levels = min_chars.bit_length() - 1  # a line has a character at least, its end
    spans = _merged(_later_copies(_runs(staged(_named(lines, levels), "line-names"), levels, min_chars)))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("id", "text", "rest", "spans")
    lines_of = F.split("text", "\n", -1)
    none = F.array().cast("array<struct<low:int,high:int>>")
    cut = joined.select("id", "text", "rest", F.coalesce("spans", none).alias("spans"),
                        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines_of)).alias("n_lines"))
    # the kept ranges lie between the deleted ones
    kept = F.transform(
        F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["high"])),
        lambda low, i: F.struct(low.alias("low"), F.coalesce(F.get("spans", i)["low"], F.col("n_lines")).alias("high")))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
        kept, lambda s: F.slice(lines_of, s["low"] + 1, s["high"] - s["low"]))), "\n"))
    return cut.withColumn("kept_text", text)


def remove_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, spans, kept_text), one row per input row.

    A line goes if it lies in a run of consecutive lines of at least
    ``min_chars`` characters, line ends included, that also starts at an earlier place, by id, then
    text, then line number; the earlier place may be in the same document. A
    null text has no lines and stays null; an empty one has one empty line.
    Null ids come first. Rows equal in id and text are one document and get the
    same result each. Other columns are ignored; an empty table gives no rows.
    A very long document is one row of its own size plus small rows per
    repeated line.
    """
    cut = _cut(docs.select(id_col, text_col), min_chars, id_col, text_col)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["high"] - s["low"]).cast("long"))
    return cut.select(F.col("id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"),
                      removed.alias("n_removed"), "spans", "kept_text")


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                           text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the same rows and columns, the texts cut as in
    :func:`remove_repeated_lines` and ``length_col``, if there, brought up to date."""
    cut = _cut(docs, min_chars, id_col, text_col)

    def column(c: str):
        if c == id_col:
            return F.col("id")
        if c == text_col:
            return F.col("kept_text")
        if c == length_col:
            return F.when(F.size("spans") > 0, F.length("kept_text")).otherwise(F.col("rest")[c])
        return F.col("rest")[c]

    return cut.select(*[column(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
