"""Mixing sources to target weights by entropy balancing.

Sources get target amounts of words.  The copies a text is given follow the
rates closest to one copy each, in relative entropy, among the rates of at
most ``CAP`` that meet every source's target: a rate is exp(dual * size),
tilted exponentially in the text's words and cut at ``CAP``.  The dual of a
source is the root of a monotone function; Newton steps inside a shrinking
bracket find all duals at once, each step one aggregation over the counts of
texts by source and size.

Rates are then rounded to copies.  Texts that are large against the target
come first, from the largest down, each size making up for the words that the
larger ones were given too much or too little.  The dual is then solved again
for the others and what is left of the target; there the running sum of the
fractions is rounded, so that the count of extra copies never strays by more
than one half.  Which texts of one size get the extra copy is decided by a
hash of the id.

Everything is DataFrame functions.  Sums run over integers (rates in units of
2**-30), so no result depends on the order of a sum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestide.llm.common import materialised, numbered, partitions

WORDS = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)          # of the sources in order, repeating
CAP = 3                      # largest rate, and largest share of a target in its source
UNIT = 1 << 30               # rates are counted in 1 / UNIT
LARGE = 1000                 # a text of more than target / LARGE words is rounded first
STEPS = 80                   # Newton or bisection; 20 or so are needed
BROADCAST_ROWS = 200_000     # classes (source, size) sent to every executor, at most
SALTS = 32                   # parts of a class where there are more
CELL = 50_000                # texts of one class that are ranked together
CHUNK = 4_096                # repeated rows that are written by one task

_EXACT = "decimal(38,0)"
_FAR = 1e300                 # a dual beyond every bound: rate 0 or CAP


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (tag, source_size; one row each) with ``target``: weights
    in the order of the tags share the sum of all sizes; a target stops at
    ``cap`` times its source's size and the excess is shared again, by
    weight, until none is above."""
    place = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    named = materialised(numbered(sources, "place", F.asc("tag")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), place + 1)))
    total, every = named.agg(F.sum("source_size"), F.sum("weight")).first()
    most, level, stopped = F.col("source_size") * cap, (total or 0) / (every or 1), -1
    while True:
        above = F.col("weight") * F.lit(level) > most
        kept, n, free = named.agg(F.sum(F.when(above, most)), F.count(F.when(above, 1)),
                                  F.sum(F.when(~above, F.col("weight")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - (kept or 0)) / free
    wanted = F.least(F.col("weight") * F.lit(level), most.cast("double"))
    return named.select("tag", "source_size", wanted.alias("target"))


def _rate(dual: Column, scaled: Column, cap: int) -> Column:
    """The rate in units: exp(dual * scaled size), cut at ``cap``."""
    power = dual * scaled
    return F.when(power >= math.log(cap), F.lit(cap * UNIT)).otherwise(
        F.least(F.floor(F.exp(F.least(power, F.lit(math.log(cap)))) * UNIT), F.lit(cap * UNIT))).cast("long")


def balance(classes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """``rate`` (in units) of every row of ``classes`` (tag, size > 0, n)
    such that n * size * rate sums up to ``wanted`` (tag, target) in each
    tag, or comes as near as rates between 0 and ``cap`` can."""
    every = F.sum((F.col("n") * F.col("size")).cast(_EXACT))
    state = classes.groupBy("tag").agg(every.alias("words"), F.sum("n").alias("texts"),
                                       F.min("size").alias("least")).join(wanted, "tag")
    mean = (F.col("words") / F.col("texts")).cast("double")
    share = F.col("target") / F.col("words").cast("double")
    shortest = F.col("least") / mean         # of the scaled sizes
    grows = share >= 1
    state = state.select(
        "tag", "target", mean.alias("mean"),
        # at these duals every rate is on one side of what is wanted
        F.when(grows, 0.0).when(share <= 0, -_FAR).otherwise(F.log(share) / shortest).alias("low"),
        F.when(grows, math.log(cap) / shortest).otherwise(0.0).alias("high"),
        F.when(share >= cap, _FAR).when(share <= 0, -_FAR).otherwise(0.0).alias("dual"),
        F.lit(math.inf).alias("gap"), ((share >= cap) | (share <= 0)).alias("done"))
    state = materialised(state)
    for _ in range(STEPS):
        moving = state.where(~F.col("done"))
        if moving.isEmpty():
            break
        scaled = F.col("size") / F.col("mean")
        rate = _rate(F.col("dual"), scaled, cap)
        words = (F.col("n") * F.col("size")).cast(_EXACT)
        bends = F.when(rate < cap * UNIT, words * rate.cast(_EXACT) * F.col("size")).otherwise(F.lit(0))
        sums = classes.join(moving, "tag").groupBy("tag", *state.columns[1:]).agg(
            F.sum(words * rate.cast(_EXACT)).alias("got"), F.sum(bends.cast(_EXACT)).alias("bend"))
        gap = F.col("got").cast("double") / UNIT - F.col("target")
        slope = F.col("bend").cast("double") / UNIT / F.col("mean")
        low = F.when(gap < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("high")).otherwise(F.col("dual"))
        newton = F.col("dual") - F.col("now") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        quick = F.abs("now") <= F.col("gap") / 2
        ends = (F.abs("now") <= F.greatest(F.lit(0.01), F.col("target") * 1e-8)) | (F.col("low") >= F.col("high"))
        moved = sums.select("tag", "target", "mean", "dual", "gap", low.alias("low"), high.alias("high"),
                            gap.alias("now"), slope.alias("slope")).select(
            "tag", "target", "mean", "low", "high",
            F.when(ends, F.col("dual")).when(inside & quick, newton)
             .otherwise((F.col("low") + F.col("high")) / 2).alias("dual"),
            F.abs("now").alias("gap"), ends.alias("done"))
        state = materialised(moved.unionByName(state.where("done")))
    return classes.join(state.select("tag", "mean", "dual"), "tag").select(
        classes["*"], _rate(F.col("dual"), F.col("size") / F.col("mean"), cap).alias("rate"))


def _copies(rated: DataFrame) -> DataFrame:
    """tag, size, n, copies (of every text) and extra (how many of the n
    texts get one more): fractions summed up from the largest size down and
    rounded.  A tag has one row for each size, at most as many as the longest
    text has words."""
    part = F.col("n").cast(_EXACT) * F.pmod(F.col("rate"), F.lit(UNIT)).cast(_EXACT)
    down = Window.partitionBy("tag").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("part").over(down) + UNIT // 2

    def whole(x):
        return F.floor(x / F.lit(UNIT).cast("decimal(11,0)"))

    return rated.withColumn("part", part.cast(_EXACT)).select(
        "tag", "size", "n", F.floor(F.col("rate") / UNIT).cast("long").alias("copies"),
        (whole(upto) - whole(upto - F.col("part"))).cast("long").alias("extra"))


def _carried(rated: DataFrame) -> DataFrame:
    """tag, size, n, copies and extra like ``_copies``, for the few large
    sizes of a tag (fewer than LARGE * source size / target): the words that
    rounding a size misses are carried to the next smaller one."""
    fraction = F.pmod(F.col("rate"), F.lit(UNIT)).cast("double") / UNIT
    listed = rated.groupBy("tag").agg(F.sort_array(F.collect_list(F.struct(
        "size", "n", F.floor(F.col("rate") / UNIT).cast("long").alias("copies"), fraction.alias("fraction"))),
        asc=False).alias("sizes"))

    def step(state, x):
        size, n = x["size"].cast("double"), x["n"].cast("double")
        due = state["due"] + size * n * x["fraction"]
        extra = F.least(x["n"], F.greatest(F.lit(0).cast("long"), F.round(due / size).cast("long")))
        return F.struct((due - size * extra).alias("due"), F.concat(state["extra"], F.array(extra)).alias("extra"))

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<long>").alias("extra"))
    return listed.select("tag", F.explode(F.arrays_zip(
        "sizes", F.aggregate("sizes", start, step)["extra"].alias("extra"))).alias("x")).select(
        "tag", "x.sizes.size", "x.sizes.n", "x.sizes.copies", "x.extra")


def class_copies(classes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """tag, size, n, copies and extra for every class of texts with words."""
    sized = classes.where("size > 0")
    first = balance(sized, wanted, cap).join(wanted, "tag")
    large = materialised(_carried(first.where(F.col("size") * LARGE > F.col("target"))))
    taken = large.groupBy("tag").agg(
        F.sum(F.col("size") * (F.col("n") * F.col("copies") + F.col("extra"))).alias("taken"))
    rest = wanted.join(taken, "tag", "left").select(
        "tag", (F.col("target") - F.coalesce("taken", F.lit(0))).alias("target"))
    small = materialised(sized.join(wanted, "tag").where(F.col("size") * LARGE <= F.col("target")).drop("target"))
    return materialised(large.unionByName(_copies(balance(small, rest, cap))))


def _with_class(units: DataFrame, classes: DataFrame) -> DataFrame:
    """``units`` with the columns of their class: sent to every executor
    where the classes are few, else joined with every class in parts, so that
    a frequent size does not end up in one task."""
    if classes.count() <= BROADCAST_ROWS:
        return units.join(F.broadcast(classes), ["tag", "size"])
    salted = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = units.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["tag", "size", "salt"]).drop("salt")


def _pick(units: DataFrame) -> DataFrame:
    """``units`` (tag, size, doc_id, m rows each, with n and extra of their
    class) with ``more``: how many of the m rows get the extra copy.  Classes
    are dealt into cells by a hash of the id; a cell's part of the extra
    copies follows from the rows before and in it."""
    none = units.where("extra = 0 or extra = n").withColumn(
        "more", F.when(F.col("extra") == 0, F.lit(0).cast("long")).otherwise(F.col("m")))
    some = units.where("extra > 0 and extra < n").withColumn("hash", F.xxhash64("doc_id", F.lit(7)))
    some = some.withColumn("cell", F.pmod("hash", F.ceil(F.col("n") / CELL)).cast("int"))
    cells = some.groupBy("tag", "size", "cell").agg(
        F.sum("m").alias("held"), F.max("n").alias("n"), F.max("extra").alias("extra"))
    upto = F.sum("held").over(Window.partitionBy("tag", "size").orderBy("cell"))

    def due(x):
        return F.floor(x.cast(_EXACT) * F.col("extra") / F.col("n").cast("decimal(19,0)")).cast("long")

    cells = cells.select("tag", "size", "cell", (due(upto) - due(upto - F.col("held"))).alias("due"))
    inside = Window.partitionBy("tag", "size", "cell").orderBy("hash", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("m").over(inside), F.lit(0))
    some = some.withColumn("before", before).join(cells, ["tag", "size", "cell"]).withColumn(
        "more", F.greatest(F.lit(0), F.least(F.col("m"), F.col("due") - F.col("before"))))
    return none.unionByName(some.select(none.columns))


def _rows(units: DataFrame) -> DataFrame:
    """One row for each of the m rows of a unit; many repeats are written by
    several tasks."""
    few = units.where(F.col("m") <= CHUNK).withColumn("from", F.lit(0).cast("long"))
    many = units.where(F.col("m") > CHUNK).withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(CHUNK).cast("long"))))
    many = many.repartition(partitions(units.sparkSession))
    here = F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, F.col("m")) - 1)
    return few.unionByName(many).withColumn("at", F.explode(here))


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs``
    (doc_id, source, text).

    ``size`` is the number of words; null and empty texts have none and take
    none.  A null source is one source, the last.  Null ids and repeated rows
    are kept (rows equal in id, source and size are told apart by nothing but
    their copies); other columns are ignored; an empty table gives no rows.
    """
    tag = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), "source"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    units = materialised(docs.select("doc_id", tag.alias("tag"), size.alias("size")).groupBy(
        "doc_id", "tag", "size").agg(F.count("*").alias("m")))
    classes = materialised(units.groupBy("tag", "size").agg(F.sum("m").alias("n")))
    sources = targets(classes.groupBy("tag").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")),
                      weights, cap)
    copies = class_copies(classes, sources.select("tag", "target"), cap)
    nothing = classes.where("size = 0").select(
        "tag", "size", "n", F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("extra"))
    known = materialised(copies.unionByName(nothing).join(sources, "tag"))
    picked = _rows(_pick(_with_class(units, known)))
    gets = F.col("copies") + (F.col("at") < F.col("more")).cast("long")
    return picked.select("doc_id", "size", "source_size", "target", (F.col("size") * gets).alias("taken"))
