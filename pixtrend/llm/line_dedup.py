"""Exact near-duplicate lines by a set-similarity join, in DataFrame operations only.

Lines are sets of lower-cased words.  Lines with equal sets form a class, known
by its first place (document, line number); only classes are compared:

1. *Rarity.*  Word counts over hash buckets (a table of fixed size) rank the
   words; a word's 64-bit hash is rearranged, without loss, so that its rank
   leads.  A line is then a sorted array of numbers, rarest word first.
2. *Prefix.*  Sets that reach the similarity share one of their rarest
   ``n - ceil(t n) + 1`` words, so classes meet on those words only.
3. *Filters.*  Length, position of the shared word, and a parity bitmap of the
   set discard pairs that cannot reach it.  A semi-join keeps classes
   with a possible partner: it emits no pairs.
4. *Verification.*  The remaining lines meet again with their whole word sets;
   a line goes if an earlier line reaches the Jaccard.  This is a semi-join as
   well, which stops at the first such line: a group of thousands of near
   copies costs about one comparison each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixtrend.llm.scratch import materialise

#: Similarity as an exact fraction.
NUM, DEN = 4, 5
RARITY_BITS = 16
#: Rows of wanted places (16 bytes each) up to which they are broadcast to the
#: scan of the texts; beyond, lines are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Sets of up to this size have no partner but an equal set.
LONELY = DEN // (DEN - NUM) - 2
#: Up to this size a set's bitmap is 64 bits wide, beyond it 128.
NARROW = 96
LAST = (1 << 63) - 1
SIZE_BITS = 18
BIG = (1 << SIZE_BITS) - 1


def words_of(line: Column) -> Column:
    """The words between ASCII white space, with repeats; the empty word, left
    by white space at the ends or in a row, may be among them."""
    odd = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\x0b"))
    return F.split(F.lower(F.when(odd, F.translate(line, "\t\r\f\x0b", "    ")).otherwise(line)), " ")  # a plain split is no regex


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(d, line_no, line): one row per line; null keys come last."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("d"),
                       F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("line_no", "line"))


def rarity_ranks(lines: DataFrame) -> Column:
    """Array literal: the rank of each hash bucket by how many words fall in it."""
    bucket = F.xxhash64("word").bitwiseAND(F.lit((1 << RARITY_BITS) - 1)).cast("int")
    counted = lines.select(F.explode(words_of(F.col("line"))).alias("word")).groupBy(bucket.alias("bucket")).count()
    count = {r["bucket"]: r["count"] for r in counted.collect()}  # at most 2**RARITY_BITS rows
    rank = [0] * (1 << RARITY_BITS)
    for k, b in enumerate(sorted(range(1 << RARITY_BITS), key=lambda b: (count.get(b, 0), b))):
        rank[b] = k
    return F.split(F.lit(",".join(map(str, rank))), ",").cast("array<int>")


def word_set(line: Column, ranks: Column) -> Column:
    """Sorted distinct word numbers of a line, rarest first.  A number holds the
    bucket's rank in its high bits and the hash's other bits below, which
    together are the hash again."""
    def number(h: Column) -> Column:
        # never null, which lets Spark sort the numbers as plain longs
        rank = F.coalesce(F.get(ranks, h.bitwiseAND(F.lit((1 << RARITY_BITS) - 1)).cast("int")), F.lit(0)) - F.lit(1 << (RARITY_BITS - 1))
        return F.shiftleft(rank.cast("long"), 64 - RARITY_BITS).bitwiseOR(F.shiftrightunsigned(h, RARITY_BITS))

    numbers = F.array_distinct(F.transform(words_of(line), lambda w: number(F.xxhash64(w))))
    return F.sort_array(F.array_remove(numbers, number(F.xxhash64(F.lit("")))))


def prefix_length(n: Column) -> Column:
    return (n - F.floor((n * NUM + (DEN - 1)) / DEN) + 1).cast("int")


def bitmap(s: Column) -> tuple[Column, Column]:
    """Parity bitmap of a set in two halves; up to ``NARROW`` elements the
    second is empty.  Both halves together (xor) are always the 64-bit one."""
    def parity(half: int | None) -> Column:
        def step(acc: Column, x: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
            return acc.bitwiseXOR(bit if half is None else F.when(x.bitwiseAND(F.lit(64)) == 64 * half, bit).otherwise(F.lit(0).cast("long")))

        return F.aggregate(s, F.lit(0).cast("long"), step)

    wide = F.size(s) > NARROW
    return F.when(wide, parity(0)).otherwise(parity(None)), F.when(wide, parity(1)).otherwise(F.lit(0).cast("long"))


def may_reach(a: str, b: str) -> Column:
    """Bitmap, length and positional filters on two rows that share a prefix word."""
    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    na, nb = c(a, "n"), c(b, "n")
    x0, x1 = c(a, "bits0").bitwiseXOR(c(b, "bits0")), c(a, "bits1").bitwiseXOR(c(b, "bits1"))
    differ = F.when((na > NARROW) & (nb > NARROW), F.bit_count(x0) + F.bit_count(x1)).otherwise(F.bit_count(x0.bitwiseXOR(x1)))
    ahead = F.least(na - c(a, "at"), nb - c(b, "at"))
    return ((differ * (NUM + DEN) <= (na + nb) * (DEN - NUM) + F.when((na >= BIG) | (nb >= BIG), F.lit(128 * (NUM + DEN))).otherwise(0))
            & (F.least(na, nb) * DEN >= F.greatest(na, nb) * NUM) & (ahead * (NUM + DEN) >= (na + nb) * NUM))


def _judge(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All lines as (d, line_no, n, k1, k2), and the places that stay."""
    lines = lines_of(docs, key, text)
    ranks = rarity_ranks(lines)
    s = F.col("s")
    bits0, bits1 = bitmap(s)
    n = F.size(s)
    sets = lines.select("d", "line_no", word_set(F.col("line"), ranks).alias("s"))
    table = materialise(sets.select(
        "d", "line_no", n.alias("n"), F.xxhash64(s, F.lit(1)).alias("k1"), F.xxhash64(F.lit(2), s).alias("k2"), bits0.alias("bits0"), bits1.alias("bits1"),
        # a prefix word only brings lines together: half of its hash will do
        F.transform(F.slice(s, 1, F.greatest(prefix_length(n), F.lit(1))), lambda x: F.hash(x)).alias("prefix")), "lines")

    filled = table.where("n > 0")
    first = filled.groupBy("k1", "k2").agg(F.min(F.struct("d", "line_no")).alias("p")).select("k1", "k2", "p.d", "p.line_no")
    first = materialise(first, "first-places")
    classes = filled.where(F.col("n") > LONELY).join(first, ["k1", "k2", "d", "line_no"], "left_semi")
    posted = classes.select("d", F.col("line_no").cast("long").alias("line_no"), F.least(F.col("n"), F.lit(BIG)).cast("long").alias("n"), "bits0", "bits1",
                            F.posexplode("prefix").alias("pos", "g"))
    # line number, size and position share one number: a line of four words or more has 8 bytes at least
    tight = posted.select("g", "d", "bits0", "bits1", F.shiftleft("line_no", 2 * SIZE_BITS).bitwiseOR(F.shiftleft("n", SIZE_BITS))
                          .bitwiseOR(F.when(F.col("n") >= BIG, 0).otherwise(F.col("pos")).cast("long")).alias("at"))

    def loose(side: str) -> DataFrame:
        at = F.col("at")
        return tight.select("g", "d", "bits0", "bits1", F.shiftrightunsigned(at, 2 * SIZE_BITS).alias("line_no"),
                            F.shiftrightunsigned(at, SIZE_BITS).bitwiseAND(F.lit(BIG)).alias("n"), at.bitwiseAND(F.lit(BIG)).alias("at")).alias(side)

    a, b = loose("a"), loose("b")
    other = (F.col("a.d") != F.col("b.d")) | (F.col("a.line_no") != F.col("b.line_no"))
    active = materialise(a.join(b, (F.col("a.g") == F.col("b.g")) & other & may_reach("a", "b"), "left_semi")
                         .select("d", "line_no", "g").distinct(), "active-lines")

    # the whole sets of the active lines, found again in the texts
    places = materialise(active.select("d", "line_no").distinct(), "active-places")
    small = places.count() <= BROADCAST_ROWS
    holders = places.select("d").distinct()
    held = lines_of(docs.join(F.broadcast(holders) if small else holders, F.coalesce(F.col(key).cast("long"), F.lit(LAST)) == F.col("d"), "left_semi"), key, text)
    whole = materialise(held.withColumn("line_no", F.col("line_no").cast("long")).join(F.broadcast(places) if small else places, ["d", "line_no"])
                        .select("d", "line_no", word_set(F.col("line"), ranks).alias("s")), "active-sets")
    full = active.join(whole, ["d", "line_no"])
    a, b = full.alias("a"), full.alias("b")
    earlier = (F.col("b.d") < F.col("a.d")) | ((F.col("b.d") == F.col("a.d")) & (F.col("b.line_no") < F.col("a.line_no")))
    both = F.size("a.s") + F.size("b.s")
    similar = ((F.least(F.size("a.s"), F.size("b.s")) * DEN >= F.greatest(F.size("a.s"), F.size("b.s")) * NUM)
               & (F.size(F.array_intersect("a.s", "b.s")) * (NUM + DEN) >= both * NUM))
    later = a.join(b, (F.col("a.g") == F.col("b.g")) & earlier & similar, "left_semi").select("d", "line_no").distinct()
    kept = (first.select("d", F.col("line_no").cast("long").alias("line_no")).join(later, ["d", "line_no"], "left_anti")
            .unionByName(table.where("n = 0").select("d", F.col("line_no").cast("long").alias("line_no")).distinct()))
    return table, kept


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``d, n_lines, kept``: per key (null: the largest long) the number of
    lines and the sorted numbers of those that stay.

    A line goes if an earlier line, by (key, line number), has a Jaccard of 0.8
    or more with it over their sets of lower-cased words.  Lines without words
    stay.  Rows that repeat a key are judged as one place each line: with equal
    texts they keep the same lines.  Null and empty texts are one empty line."""
    table, kept = _judge(docs, key, text)
    counts = table.groupBy("d").agg((F.max("line_no") + 1).alias("n_lines"))
    stay = kept.groupBy("d").agg(F.sort_array(F.collect_list(F.col("line_no").cast("int"))).alias("kept"))
    return counts.join(stay, "d", "left").select("d", "n_lines", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the later similar lines cut out of ``text``, and columns
    ``n_lines`` and ``n_kept``.  Null texts stay null; other columns are kept,
    columns of the new names are replaced."""
    kept = materialise(kept_lines(docs, key, text), "kept-lines")
    docs = docs.drop("n_lines", "n_kept")
    names = docs.columns
    joined = (docs.withColumn("_d", F.coalesce(F.col(key).cast("long"), F.lit(LAST)))
              .join(kept.select(F.col("d").alias("_d"), F.col("n_lines").alias("_n"), F.col("kept").alias("_kept")), "_d", "left"))
    joined = joined.withColumn("_lines", F.split(F.col(text), "\n", -1))  # split once, not once a line
    lines = F.col("_lines")
    short = F.array_join(F.transform(F.filter(F.col("_kept"), lambda i: i < F.size(lines)), lambda i: F.get(lines, i)), "\n")
    same = F.size("_kept") == F.size(lines)
    clean = F.when(F.col(text).isNull(), F.lit(None).cast("string")).when(same, F.col(text)).otherwise(short)
    return joined.select(*[clean.alias(text) if c == text else F.col(c) for c in names], F.col("_n").alias("n_lines"), F.size("_kept").alias("n_kept"))
