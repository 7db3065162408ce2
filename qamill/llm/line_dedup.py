"""Near-duplicate lines by an exact set-similarity join, with Spark functions only.

A line's tokens are its distinct 5-word shingles (lower case; a line of fewer
words is one token).  Two lines match if the Jaccard similarity of their sets
is 0.75 or more.  A line is removed if any earlier line, in order of doc_id,
then place, then row, matches it; lines without words never match.  A row is
named by a hash of its text beside its doc_id, so that rows of one doc_id are
told apart.

Tokens are ordered by rarity: that of a shingle is the rarity of its rarest
word, from a table of BUCKETS word counts over the whole corpus (words share a
counter by hash, so the table has a fixed size; any order gives exact results,
a good one makes fewer candidates).  Matching sets share one of their first
n - ceil(0.75 n) + 1 tokens; lengths, and the places of a shared token in both
sets, bound what can be common.

Equal lines are one from the start.  Among the lines of a token each is
compared with the earliest first; those without a match so far are then
compared with all earlier lines of their tokens that pass the filters, and one
more: a 256-bit parity table of each set, whose differing bits bound from
below how many tokens are not common.

Tokens are 64-bit numbers: a level of rarity (LEVELS, by logarithm) above 58 bits of a hash.

Cases: null text: one empty line, kept.  Null doc_id: lines are kept and match
nothing.  Rows that share a doc_id are rows of their own, in the order of their
texts' hashes at equal places; rows that repeat doc_id and text are one, and
each of them loses the same lines.  Very long texts: a text is one row's work.
Empty table: no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qamill.llm.columns import let, words
from qamill.llm.tables import constant, passing, released, staged

SHINGLE = 5
PART, WHOLE = 75, 100
BUCKETS = 1 << 16
HASH_BITS = 58
LEVELS = 32
#: Copies (three numbers each) that are sent to every task; more are taken out by a shuffle.
BROADCAST_ROWS = 1_000_000

#: What names a line, in the order that decides which line is the earlier one.
PLACE = ["doc_id", "line_no", "row"]


def row_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def word_counts(docs: DataFrame) -> list[int]:
    """Occurrences of the words of each bucket, over all texts; BUCKETS numbers at most reach the driver."""
    counted = docs.select(F.explode(words(F.lower("text"))).alias("w")).groupBy(
        F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    out = [0] * BUCKETS
    for r in counted.toLocalIterator():
        out[r["b"]] = r["n"]
    return out


def _line_words(line: Column) -> Column:
    """Words of a line.  Lines whose only blanks are spaces, nearly all, need no regular expression to be split."""
    plain = F.array_remove(F.split(line, " "), "")
    return F.when(line.rlike(r"[\x09-\x0D]"), words(line)).otherwise(plain)


def _tokens(line: Column, levels: Column) -> Column:
    """Distinct tokens of a line, rarest first; empty if it has no words."""
    low, high = F.lit((1 << HASH_BITS) - 1), F.lit(~((1 << HASH_BITS) - 1))
    # Each word as one number: level of its count above, hash below.
    word = lambda h: h.bitwiseAND(low) + F.shiftleft(F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), HASH_BITS)
    coded = F.transform(F.transform(_line_words(F.lower(line)), lambda x: F.xxhash64(x)), word)

    def token(least: Column, hashed: Column) -> Column:
        return least.bitwiseAND(high) + hashed.bitwiseAND(low)

    def shingle(w: Column, i: Column) -> Column:
        five = [F.get(w, i + j) if j else F.get(w, i) for j in range(SHINGLE)]
        return token(F.least(*five), F.xxhash64(*five))

    def tokens(w: Column) -> Column:
        return F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: shingle(w, i))).when(
            F.size(w) > 0, F.array(token(F.array_min(w), F.xxhash64(w)))).otherwise(F.array().cast("array<bigint>"))
    return F.sort_array(F.array_distinct(let(coded, tokens)))


def tokenized(lines: DataFrame, counts: list[int]) -> DataFrame:
    """lines with column ``tokens``."""
    top = math.log2(max(counts) + 2)
    levels = constant([int(LEVELS * math.log2(n + 1) / top) for n in counts], "bigint")
    return lines.withColumn("tokens", _tokens(F.col("line"), levels))


def _parity(tokens: Column) -> Column:
    """Four numbers: of each of 256 places, whether an odd number of tokens falls on it."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))
    part = lambda g: F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: F.when(
        F.shiftright(t, 6).bitwiseAND(F.lit(3)) == g, acc.bitwiseXOR(bit(t))).otherwise(acc))
    return F.array(*[part(g) for g in range(4)])


def lines_of(docs: DataFrame) -> DataFrame:
    """PLACE (line_no from 0) and line of every line."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), F.posexplode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line_no", "line"))


def _needed(n: Column, m: Column) -> Column:
    """Common tokens, times PART + WHOLE, that sets of n and m must have."""
    return (n + m) * PART


def removed_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """PLACE of the lines that an earlier line matches."""
    docs = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    counts = word_counts(docs)
    lines = lines_of(docs)
    # The first of equal lines stands for all; those at a later place go.
    place = F.struct(*PLACE)
    keyed = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"), place.alias("place"))
    firsts = staged(spark, keyed.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.max("place").alias("last")).where(
        "first < last").drop("last"), "firsts")
    copies = staged(spark, keyed.join(firsts, ["k1", "k2"]).where("place > first").select("place.*").distinct(), "copies")
    released(spark, firsts)
    few = copies.count() <= BROADCAST_ROWS
    single = lines.join(F.broadcast(copies), PLACE, "left_anti") if few else lines
    # Only the first tokens of a line leave the scan.
    n = F.size("tokens")
    prefix = tokenized(single, counts).select(*PLACE, n.alias("n"), F.slice(
        "tokens", F.lit(1), (n - F.ceil(n * PART / WHOLE) + 1).cast("int")).alias("prefix"))
    if not few:
        prefix = prefix.join(copies, PLACE, "left_anti")
    each = prefix.select(*PLACE, "n", F.posexplode("prefix").alias("at", "token"))
    order = W.partitionBy("token").orderBy(*PLACE)
    near = each.withColumn("before", F.lag("n").over(order)).withColumn("after", F.lead("n").over(order)).where(
        "before is not null or after is not null")
    shared = staged(spark, near.select(
        "token", *PLACE, "n", "at", *[F.first(c).over(order).alias(f"{c}0") for c in (*PLACE, "n", "at")]), "shared")
    # The whole sets of those lines that share a token with another.
    ids = staged(spark, shared.select(*PLACE).distinct(), "ids")
    picked = tokenized(lines.where(passing(ids)), counts).join(ids, PLACE, "left_semi").dropDuplicates(PLACE)
    sets = staged(spark, picked.select(*PLACE, "tokens"), "sets")
    released(spark, ids)
    place0 = [f"{c}0" for c in PLACE]

    def could(n1: str, at1: str, n2: str, at2: str) -> Column:
        left = F.least(F.col(n1) - F.col(at1), F.col(n2) - F.col(at2))
        return (F.least(n1, n2) * WHOLE >= F.greatest(n1, n2) * PART) & (left * (PART + WHOLE) >= _needed(F.col(n1), F.col(n2)))

    def matched(pairs: DataFrame) -> DataFrame:
        """PLACE of pairs (PLACE, place0) that match."""
        two = pairs.join(sets, PLACE).join(sets.select(*[F.col(c).alias(f"{c}0") for c in (*PLACE, "tokens")]), place0)
        return two.where(F.size(F.array_intersect("tokens", "tokens0")) * (PART + WHOLE) >= _needed(F.size("tokens"), F.size("tokens0"))).select(
            *PLACE).distinct()

    later = F.struct(*PLACE) > F.struct(*[F.col(f"{c}0").alias(c) for c in PLACE])
    names = [*PLACE, *place0]
    stars = staged(spark, shared.where(later & could("n", "at", "n0", "at0")).select(*names).distinct(), "pairs")
    gone = staged(spark, matched(stars), "gone")
    # Those that the earliest left: all earlier lines of their tokens.
    held = sets.select(*PLACE, _parity(F.col("tokens")).alias("parity"))
    rest = shared.select("token", *PLACE, "n", "at").join(gone, PLACE, "left_anti")
    rest = staged(spark, rest.join(held, PLACE), "rest")
    wanted = rest.select("token").distinct()
    earlier = shared.select("token", *PLACE, "n", "at").join(wanted, "token", "left_semi").join(held, PLACE).select(
        "token", *[F.col(c).alias(f"{c}0") for c in (*PLACE, "n", "at", "parity")])
    differ = sum((F.bit_count(F.get("parity", F.lit(g)).bitwiseXOR(F.get("parity0", F.lit(g)))) for g in range(4)), F.lit(0))
    common = (F.col("n") + F.col("n0") - differ) * (PART + WHOLE) >= _needed(F.col("n"), F.col("n0")) * 2
    pairs = rest.join(earlier, (rest["token"] == earlier["token"]) & later & could("n", "at", "n0", "at0") & common).select(*names).distinct()
    pairs = staged(spark, pairs.join(stars, names, "left_anti"), "pairs")
    released(spark, rest, shared, stars)
    out = staged(spark, copies.select(*PLACE).union(gone).union(matched(pairs)).distinct(), "removed")
    released(spark, copies, gone, pairs, sets)
    return out


def deduplicated(spark: SparkSession, docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """docs with the removed lines taken out of text (other columns as they are).

    drop_emptied: documents that lose their last line with words go; those that had none stay.
    """
    gone = removed_lines(spark, docs).groupBy(F.col("doc_id").alias("removed_id"), F.col("row").alias("removed_row")).agg(
        F.collect_set("line_no").alias("removed_lines"))
    rows = docs.select(F.struct(*docs.columns).alias("whole"), F.col("doc_id").cast("long").alias("id"), row_key().alias("key"))
    # Rows that lose no line stay where they are: only those that may do meet in the join.
    gone = staged(spark, gone, "removed")
    may = F.col("id").isNotNull() & passing(gone.select("removed_id", "removed_row"), "id", "key")
    rest = rows.where(~may).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in gone.schema])
    out = rows.where(may).join(gone, (F.col("id") == F.col("removed_id")) & (F.col("key") == F.col("removed_row")), "left").unionByName(rest)
    kept = let(F.split(F.col("whole.text").cast("string"), "\n"), lambda x: F.transform(F.array_except(
        F.sequence(F.lit(0), F.size(x) - 1), F.col("removed_lines")), lambda i: F.get(x, i)))
    text = F.when(F.col("removed_lines").isNull(), F.col("whole.text")).otherwise(F.array_join(kept, "\n"))
    out = out.withColumn("left_over", text)
    if drop_emptied:
        out = out.where(F.col("removed_lines").isNull() | F.col("left_over").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[(F.col("left_over") if c == "text" else F.col("whole")[c]).alias(c) for c in docs.columns])


def op4_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (places from 0, ascending, comma-joined) per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    gone = removed_lines(spark, docs).groupBy(F.col("doc_id").alias("removed_id"), F.col("row").alias("removed_row")).agg(
        F.array_sort(F.collect_set("line_no")).alias("lines"))
    size = docs.select("doc_id", row_key().alias("key"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    lines = F.coalesce("lines", F.array().cast("array<int>"))
    return size.join(gone, (F.col("doc_id") == F.col("removed_id")) & (F.col("key") == F.col("removed_row")), "left").select(
        "doc_id", "n_lines", F.size(lines).cast("long").alias("n_removed"), F.array_join(lines.cast("array<string>"), ",").alias("removed_lines"))
