"""Mixing sources to target weights by Pareto order sampling.

Targets: sources share the wanted total by weight; a target stops at
``max_copies`` times its source's size, and the excess is reshared by
weight among the others until none is above (one aggregate over the
source table per round).

Selection, per source: a document is due ``e = min(level * weight,
max_copies)`` copies, with the level at which the source's documents are
due its target (weights by document; equal ones if none are given). The
whole part of ``e`` is certain. For the fraction ``p``, which differs from
document to document, each gets a uniform number u from a hash of its id,
and documents are ranked by Pareto order, ``(u / (1 - u)) / (p / (1 - p))``;
the least ranks are taken up to the words still wanted.

No task sorts a source. The rank becomes a 62-bit number, and the cut is
found digit by digit: words per (source, leading 8 bits), aggregated map
side, give the digit in which a source's cut lies, until every cut lies in
a cell of at most ``CELL`` documents. These cells are walked in rank order
(a document that no longer fits is passed over, and the shortest of those
joins at the end if that comes nearer), so a source ends within a short
document of its target.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import common
from tagloom.operators.indexing import dense_id

MAX_COPIES = 3
CELL = 512
_BITS = 62
_DIGIT = 8


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """``source, weight``: sources by code point, null last, weigh 1 to
    ``cycle``, repeating."""
    ranked = dense_id(sizes.select("source"), [F.col("source").asc_nulls_last()], "rank")
    return ranked.select("source", (F.col("rank") % cycle + 1).cast("double").alias("weight"))


def water_level(sources: DataFrame, total: float) -> float | None:
    """Words per unit of weight at which the capped targets add up to
    ``total``; None if all sources are capped. Two numbers a round reach
    the driver."""
    level = None
    while True:
        free = F.lit(True) if level is None else F.col("weight") * level <= F.col("cap")
        w, capped = sources.agg(F.sum(F.when(free, F.col("weight"))),
                                F.sum(F.when(~free, F.col("cap")))).first()
        if not w:
            return None
        now = (total - (capped or 0)) / w
        if level is not None and now <= level:
            return level
        level = now


def source_sizes(docs: DataFrame, source_col: str, size_col: str) -> DataFrame:
    return (docs.groupBy(F.col(source_col).alias("source"))
            .agg(F.sum(size_col).alias("source_size"), F.count(F.lit(1)).alias("n")))


def targets(sizes: DataFrame, weights: DataFrame, share: float = 1.0,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, n, target``. A source without a weight, or
    with one that is not positive, gets no target."""
    w = weights.select(F.col("source").alias("_source"), F.col("weight"))
    s = (sizes.join(w, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
         .withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
         .withColumn("cap", F.col("source_size").cast("double") * max_copies))
    s = common.written(s, "mix-sources")
    total = (s.agg(F.sum("source_size")).first()[0] or 0) * share
    level = water_level(s, total)
    target = F.col("cap") if level is None else F.least("cap", F.col("weight") * level)
    return s.select("source", "source_size", "n",
                    F.when(F.col("weight") > 0, target).otherwise(0.0).alias("target"))


def _levels(rows: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """``state`` with the ``level`` of each source at which ``min(level *
    weight, max_copies)`` copies of its documents (``weight, size``) add up
    to its target. Newton's method, one aggregate a round over sources that
    have documents above the cap; sums are decimals, so reruns agree."""
    top = F.col("level") * F.col("heaviest") > max_copies
    state = state.withColumn("level", F.when(F.col("mass") > 0, F.col("target") / F.col("mass")).otherwise(0.0))
    state = common.written(state.withColumn("open", top), "mix-level")
    while not state.filter("open").isEmpty():
        level = state.filter("open").select(F.col("source").alias("_source"), F.col("level").alias("_level"))
        over = F.col("_level") * F.col("weight") >= max_copies
        part = (rows.join(level, F.col("source").eqNullSafe(F.col("_source"))).groupBy("_source")
                .agg(F.sum(F.when(over, F.col("size")).otherwise(0)).alias("full"),
                     F.sum(F.when(~over, _mass()).otherwise(0)).cast("double").alias("free"))
                .withColumn("found", F.lit(True)))
        next_ = F.when(F.col("free") > 0, (F.col("target") - max_copies * F.col("full")) / F.col("free")).otherwise(1e300)
        moved = F.col("open") & (next_ > F.col("level") * (1 + 1e-9))
        state = common.written(
            state.join(part, F.col("found") & F.col("source").eqNullSafe(F.col("_source")), "left")
            .select(*(c for c in state.columns if c not in ("level", "open")),
                    F.when(moved, next_).otherwise(F.col("level")).alias("level"),
                    (moved & (next_ < 1e300)).alias("open")), "mix-level")
    return state.drop("open")


def _mass() -> Column:
    return (F.col("weight") * F.col("size")).cast("decimal(38,9)")


def mix(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        size_col: str = "size", share: float = 1.0, max_copies: int = MAX_COPIES, seed: int = 11,
        weight_col: str | None = None) -> DataFrame:
    """``docs`` with ``source_size, target`` (of its source) and ``copies``
    (how often the mix takes the document, 0 to ``max_copies``).

    ``size_col`` holds whole numbers (null: 0). ``weight_col`` says how much
    more often a document of a source is taken than another (null, negative
    or not a number: 0, which is never). A null source is a source.
    Documents with null or equal ids are told apart by a row number that is
    stored with them once. Documents of size 0 get copies like others of
    their rank. An empty table stays empty. Columns of ``docs`` named like
    an output are replaced. Same ids, sizes, weights, sources and seed: same
    result.
    """
    own = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col(source_col).alias("source"),
        F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias("size"),
        F.when((own > 0) & (own < 1e9), own).otherwise(0.0).alias("weight"),
        ((F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) + 0.5) / float(1 << 53)).alias("u"))
    rows = common.numbered(rows, "mix-numbered")
    light = rows.drop("doc")
    sizes = source_sizes(light, "source", "size")
    heavy = light.groupBy(F.col("source").alias("_source")).agg(
        F.sum(_mass()).cast("double").alias("mass"), F.max("weight").alias("heaviest"))
    state = (targets(sizes, weights, share, max_copies).join(heavy, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    state = _levels(light, state, max_copies).select("source", "source_size", "n", "target", "level")

    def due(rows: DataFrame, state: DataFrame) -> DataFrame:
        """Rows beside their source's state, with certain copies ``whole``
        and the chance ``p`` of one more."""
        s = state.withColumnRenamed("source", "_source")
        # a fraction that is 0 or 1 but for rounding is 0 or 1
        e = F.round(F.least(F.col("level") * F.col("weight"), F.lit(float(max_copies))), 9)
        return (rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("e", e)
                .withColumn("whole", F.floor("e").cast("int")).withColumn("p", F.col("e") - F.col("whole")).drop("e"))

    need = due(light, state).groupBy(F.col("source").alias("_source")).agg(
        F.sum((F.col("p") * F.col("size")).cast("decimal(38,9)")).cast("double").alias("need"))
    state = common.written(state.join(need, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                           .withColumn("prefix", F.lit(0).cast("long")).withColumn("shift", F.lit(_BITS)), "mix-state")

    def with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
        """``due`` rows with their rank ``v``."""
        odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
        top = F.least(F.floor(odds / (1 + odds) * float(1 << 40)), F.lit((1 << 40) - 1)).cast("long")
        low = F.xxhash64("row").bitwiseAND(F.lit((1 << 22) - 1))    # tells equal ids apart
        return due(rows, state).withColumn(
            "v", F.when(F.col("p") > 0, F.shiftleft(top, 22).bitwiseOR(low)).otherwise(F.lit(1 << _BITS)))

    wide = (F.col("need") > 0) & (F.col("n") > CELL) & (F.col("shift") > 0)
    while not state.filter(wide).isEmpty():
        state = common.written(_narrower(with_state(light, state.filter(wide)), state, wide), "mix-state")
    cells = (with_state(light, state.filter("need > 0"))
             .filter("shiftright(v, shift) = prefix").groupBy("source")
             .agg(F.first("need").alias("cell_need"),
                  F.sort_array(F.collect_list(F.struct("v", "row", "size"))).alias("cell"))
             .withColumn("walk", F.expr(
                 "aggregate(cell, named_struct('used', cast(0 as bigint), 'rows', cast(array() as array<bigint>)),"
                 " (a, x) -> if(a.used + x.size <= cell_need, named_struct('used', a.used + x.size, 'rows',"
                 " array_append(a.rows, x.row)), a))"))
             # the shortest document passed over joins if that comes nearer
             .withColumn("next", F.expr(
                 "array_min(transform(filter(cell, x -> not array_contains(walk.rows, x.row)),"
                 " x -> named_struct('size', x.size, 'row', x.row)))"))
             .select(F.col("source").alias("_source"), F.expr(
                 "if(next.size < 2 * (cell_need - walk.used), array_append(walk.rows, next.row), walk.rows)")
                 .alias("chosen")))
    state = common.written(
        state.join(cells, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"), "mix-cut")
    drawn = (F.col("need") > 0) & (F.col("p") > 0) & ((F.col("v") < F.expr("shiftleft(prefix, shift)"))
                                   | F.coalesce(F.array_contains("chosen", F.col("row")), F.lit(False)))
    out = ["source_size", "target", "copies"]
    return (with_state(rows, state).withColumn("copies", F.col("whole") + drawn.cast("int"))
            .select(*(F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in out), *out))


def _narrower(rows: DataFrame, state: DataFrame, wide: Column) -> DataFrame:
    """The state with every wide cell narrowed by one digit: the cell in
    which the running words of the source's digits reach ``need``."""
    step = F.least(F.lit(_DIGIT), F.col("shift"))
    hist = (rows.filter("shiftright(v, shift) = prefix")
            .withColumn("to", (F.col("shift") - step).cast("int"))
            .groupBy("source", F.expr("shiftright(v, to)").alias("digit"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("in_digit"),
                 F.first("need").alias("want"), F.first("to").alias("to")))
    order = Window.partitionBy("source").orderBy("digit")       # at most 2^8 rows per source
    cut = (hist.withColumn("upto", F.sum("words").over(order))
           .filter((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("words") < F.col("want")))
           .select(F.col("source").alias("_source"), F.col("digit").alias("new_prefix"),
                   (F.col("want") - (F.col("upto") - F.col("words"))).alias("new_need"),
                   F.col("in_digit").alias("new_n"), "to"))
    narrowed = state.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left")
    past = F.col("to").isNull()         # rounding: the words of the cell do not reach need, so all are taken
    new = {"prefix": F.when(past, F.col("prefix") + 1).otherwise(F.col("new_prefix")),
           "need": F.when(past, F.col("need")).otherwise(F.col("new_need")),
           "n": F.when(past, F.lit(0)).otherwise(F.col("new_n")),
           "shift": F.when(past, F.col("shift")).otherwise(F.col("to"))}
    return narrowed.select(*(F.when(wide, new[c]).otherwise(F.col(c)).cast(t).alias(c) if c in new else F.col(c)
                             for c, t in state.dtypes))
