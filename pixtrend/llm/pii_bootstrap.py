"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Base patterns find e-mail addresses, IP addresses, card and phone numbers.
Those that stand alone between blanks are the seeds.  The words around the seeds of a
kind induce lexical patterns; a pattern that mostly holds one kind is trusted,
and what else stands in its slot, and could be of that kind, becomes an
instance of it; new instances support further patterns.  Patterns and instances form a
bipartite graph (distinct pairs), scored in rounds of joins and sums.

Every text is read once, into its matches and the few words around them; all
further work is on those rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.llm.ranking import left_join_skewed
from pixtrend.llm.scratch import materialise

KINDS = ("email", "ip", "card", "phone")
#: Base patterns.  Possessive loops need no stack; a match may begin only where
#: its run does (or where the last match ended), which keeps long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character has no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Tokens with a digit or an at sign, one blank apart.
CHUNK = r"(?<!\S)(?=\S*[0-9@])\S++(?:\x20(?=\S*[0-9@])\S++)*+"
#: What an unseen identifier of a kind may look like (in lower case).
PLAUSIBLE = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^(?:[0-9a-f]{0,4}:){2,7}[0-9a-f]{0,4}$|^[0-9]{1,3}(?:[-_][0-9]{1,3}){3}$",
    "card": r"^[0-9](?:[ ./-]?[0-9]){11,18}$",
    "phone": r"^[(]?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}$",
}
#: Characters before and after a chunk in which its context words are sought.
CONTEXT = 80
#: A longer instance is known by its hash, and is of no kind.
LONGEST = 128
#: Distinct instances that a pattern needs, its least confidence, the least score of an instance, and rounds.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE, ROUNDS = 5, 0.8, 0.8, 4

HIT = "array<struct<kind:string,i:int,gap:int,value:string,before:string,after:string>>"


def _matches(text: Column, kind: str, regex: str, context: bool) -> Column:
    """Array of (kind, i, gap, value, before, after): matches with the code
    points between each and the one before it, and the text around chunks."""
    found, gaps = F.regexp_extract_all(text, F.lit(regex), F.lit(0)), F.split(text, regex, -1)
    none = F.lit(None).cast("string")

    def hit(x: Column, i: Column) -> Column:
        around = (F.substring(x["g"], -CONTEXT, CONTEXT), F.substring(x["n"], 1, CONTEXT)) if context else (none, none)
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), x["m"].alias("value"), around[0].alias("before"), around[1].alias("after"))

    after = F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))) if context else found
    zipped = F.arrays_zip(found.alias("m"), gaps.alias("g"), after.alias("n"))
    return F.filter(F.transform(zipped, hit), lambda h: h["value"].isNotNull())


def _hits(text: Column) -> Column:
    none = F.array().cast(HIT)
    parts = []
    for kind, regex in BASE.items():
        needed = text.rlike("[0-9]") if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
        parts.append(F.when(needed, _matches(text, kind, regex, False)).otherwise(none))
    parts.append(F.when(text.rlike("[0-9@]"), _matches(text, "chunk", CHUNK, True)).otherwise(none))
    return F.coalesce(F.concat(*parts), none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' check sum (every second from the right doubled, its digits added) ends in 0."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """The checks of the base patterns beyond their expressions."""
    digits = _digits(value)
    n = F.length(digits)

    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+", "")
        return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))

    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", F.forall(F.split(value, r"\."), small))
            .when(kind == "card", F.when(n.between(13, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15)).otherwise(False))


def _spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, before, after): base matches that hold, and chunks."""
    along = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    hits = found.select("row", F.inline("hits")).withColumn("size", F.length("value"))
    return (hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along))
            .withColumn("start", F.col("end") - F.col("size")).where((F.col("kind") == "chunk") | _valid(F.col("kind"), F.col("value")))
            .select("row", "kind", "start", "end", "value", "before", "after"))


def _chunks(spans: DataFrame) -> DataFrame:
    """(row, start, end, instance, seed, before, after): each chunk without the
    marks at its ends and its label, ``seed`` the kind of the base match it
    is.  Chunks that touch a base match otherwise are left out."""
    c = spans.where("kind = 'chunk'").drop("kind")
    lead = F.regexp_extract("value", r"^(?:[^A-Za-z0-9+(]*(?:[A-Za-z_]+[:=])?[^A-Za-z0-9+(]*)", 0)
    trail = F.regexp_extract("value", r"(?<![^A-Za-z0-9)])[^A-Za-z0-9)]*+$", 0)
    c = (c.withColumn("lead", lead).withColumn("core", F.expr("substring(value, length(lead) + 1)")).withColumn("trail", trail)
         .withColumn("start", F.col("start") + F.length("lead")).withColumn("end", F.col("end") - F.length("trail"))
         .where("start < end").withColumn("core", F.lower(F.expr("substring(core, 1, end - start)")))
         .withColumn("instance", F.when(F.length("core") <= LONGEST, F.col("core")).otherwise(F.sha2(F.col("core").cast("binary"), 256)))
         .withColumn("before", F.concat("before", F.lit(" "), F.trim("lead"))))
    base = spans.where("kind <> 'chunk'")
    same = base.select("row", "start", "end", F.col("kind").alias("seed"))
    # a chunk touches a match if one that begins no later ends after its start, or one begins inside it
    both = c.select("row", "start", "end", "instance", "before", "after", F.lit(None).cast("long").alias("base_start"), F.lit(None).cast("long").alias("base_end")) \
        .unionByName(base.select("row", "start", "end", F.lit(None).cast("string").alias("instance"), F.lit("").alias("before"), F.lit("").alias("after"),
                                 F.col("start").cast("long").alias("base_start"), F.col("end").cast("long").alias("base_end")))
    ahead = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("row").orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, 0)
    touched = both.withColumn("until", F.max("base_end").over(ahead)).withColumn("next", F.min("base_start").over(back)).where("instance is not null")
    free = (F.coalesce(F.col("until") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True)))
    out = touched.withColumn("free", free).join(same.dropDuplicates(["row", "start", "end"]), ["row", "start", "end"], "left").where("free or seed is not null")
    return out.select("row", "start", "end", "instance", "seed", "before", "after")


def _patterns(before: Column, after: Column) -> Column:
    """Lexical patterns of a place: two words before; a word before and one after; a label before."""
    left, right = (F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "") for c in (before, after))
    w1, w2 = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2))
    v1 = F.try_element_at(right, F.lit(1))
    return F.array_compact(F.array(F.concat(w2, F.lit(" "), w1, F.lit(" _")), F.concat(w1, F.lit(" _ "), v1), F.when(w1.rlike("[:=#]$"), F.concat(w1, F.lit(" _")))))


def _could_be(instance: Column) -> dict[str, Column]:
    return {k: instance.rlike(regex) for k, regex in PLAUSIBLE.items()}


def bootstrap(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Instances (instance, kind, score) that trusted patterns found, and the
    patterns of the last round (pattern, kind, support, confidence).

    The support of a pattern for a kind is the sum of its instances' scores, seeds
    1; its confidence is the support over support, instances that are of
    another kind or cannot be of this one, and 1.  An instance's score is one minus the
    product of (1 - confidence) over the trusted patterns that hold it.
    """
    could = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in _could_be(F.col("instance")).items()]))
    named = chunks.withColumn("could", could).where("seed is not null or size(could) > 0 or instance rlike '[0-9].*[0-9].*[0-9].*[0-9]'")
    edges = materialise(named.select("instance", "seed", "could", F.explode(_patterns(F.col("before"), F.col("after"))).alias("pattern"))
                        .groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("could").alias("could")), "edges")
    seen = materialise(edges.where("seed is not null").groupBy("pattern", "seed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_SUPPORT).select("pattern").distinct(), "seeded")
    # new instances can lift patterns with fewer seeds: keep those of instances that a seeded pattern reaches
    reach = edges.join(seen, "pattern", "left_semi").where("seed is null").select("instance").distinct()
    live = edges.join(reach, "instance", "left_semi").select("pattern").union(seen).distinct()
    edges = materialise(edges.join(live, "pattern", "left_semi"), "live-edges")
    degree = edges.groupBy("instance").agg(F.count(F.lit(1)).alias("degree"))

    found = None
    patterns = None
    for step in range(ROUNDS):
        if found is None:
            scored = edges.withColumn("kind", F.col("seed")).withColumn("score", F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0))
        else:
            known = materialise(found.join(degree, "instance"), "known")
            scored = left_join_skewed(edges, known.select("instance", F.col("kind").alias("new"), F.col("score").alias("by"), "degree"), ["instance"], F.col("degree"))
            scored = scored.select("pattern", "instance", "seed", "could", F.coalesce("seed", "new").alias("kind"),
                                   F.when(F.col("seed").isNotNull(), 1.0).otherwise(F.coalesce("by", F.lit(0.0))).alias("score"))
        total = scored.groupBy("pattern").agg(*[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"pos_{k}") for k in KINDS],
                                              *[F.sum(F.when(F.col("kind").isNull() & ~F.array_contains("could", k), 1.0).otherwise(0.0)).alias(f"odd_{k}") for k in KINDS],
                                              F.count(F.lit(1)).alias("size"))
        every = functools.reduce(lambda a, b: a + b, [F.col(f"pos_{k}") for k in KINDS])
        rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"pos_{k}").alias("support"), (F.col(f"pos_{k}") / (every + F.col(f"odd_{k}") + 1)).alias("confidence")) for k in KINDS])
        # of confidence above one half there is one kind at most
        patterns = materialise(total.select("pattern", "size", F.inline(rows)).where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE)), f"patterns-{step}")
        slots = left_join_skewed(edges.where("seed is null"), patterns, ["pattern"], F.col("size")).where("kind is not null and array_contains(could, kind)")
        mean = slots.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score")).where(F.col("score") >= MIN_SCORE)
        best = mean.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b")).select("instance", "b.kind", "b.score")
        before = 0 if found is None else found.count()
        found = materialise(best, f"instances-{step}")
        if found.count() == before:
            break
    return found, patterns.select("pattern", "kind", "support", "confidence")


def identifiers(docs: DataFrame) -> DataFrame:
    """Personal data of every row of ``docs``: doc_id, ``base`` and ``spans``, arrays of
    (kind, start, end) by kind as in ``KINDS``, then start; code points, end exclusive.

    ``base`` holds the matches of the base patterns, leftmost and not overlapping per kind;
    ``spans`` those and what the trusted patterns found.  Null or empty text has none.
    Rows that repeat one another each have a row; other columns are ignored;
    an empty table gives none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = materialise(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _hits(text).alias("hits")), "hits")
    spans = materialise(_spans(found), "spans")
    chunks = materialise(_chunks(spans), "chunks")
    instances, _ = bootstrap(chunks)
    places = chunks.where("seed is null").groupBy("instance").agg(F.count(F.lit(1)).alias("places"))
    sized = materialise(instances.join(places, "instance"), "found-instances")
    added = left_join_skewed(chunks.where("seed is null"), sized.select("instance", "kind", "places"), ["instance"], F.col("places")).where("kind is not null")
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    rows = (spans.where("kind <> 'chunk'").select("row", "kind", "start", "end", F.lit(True).alias("base"))
            .unionByName(added.select("row", "kind", "start", "end", F.lit(False).alias("base"))))
    span = F.struct(order.alias("o"), "start", "end", "kind")
    lists = rows.groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))
    plain = [F.coalesce(F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))),
                        F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias(c) for c in ("base", "spans")]
    return found.select("row", "doc_id").join(lists, "row", "left").select("doc_id", *plain)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
