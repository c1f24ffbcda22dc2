"""Mixing sources to target weights by entropy balancing.

Of all rates at which documents could be taken, those nearest to one in relative entropy are sought that meet the token target
of each source and no rate above a bound. They are exponentials of the document's size, cut at the bound, whose
exponents solve a convex dual problem with one variable for each source. Newton steps solve it for all sources at
once; a step sums over counts of documents by source and size. Rates then become whole copies, by size, and copies are dealt to documents.
Sums that decide are sums of whole numbers, so that another order of rows gives the same mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitloom.llm.batches import free_name
from visitloom.operators.positions import numbered
from visitloom.session import through_storage

WEIGHTS = (3, 1, 2)
GROWTH = 1.5  # words of the mix to those of all documents
MOST = 2  # copies of a document
WORD = r"[^\x20\x09-\x0D]+"

# Newton steps, of which some ten are needed; steps that mend what rounding has left.
STEPS, MENDS = 200, 5
# Parts of a word and of a copy in which sums are taken.
_WORD_PARTS, _COPY_BITS = 1 << 10, 24
# Documents of one size are dealt into so many slices of so many slices by a hash.
_SLICES = 256
# Equal rows that are counted out in one task.
_REPEATED = 1000

_INSIDE = (Window.unboundedPreceding, -1)


def _sized(documents: DataFrame, doc_id: str, text: str, source: str, **names: str) -> DataFrame:
    """`documents` with key, which sorts as source with null last and is never null, and size, the words of the text."""
    key = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    return documents.withColumns({names.get("key", "key"): key, names.get("size", "size"): size})


def token_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, growth: float = GROWTH, most: int = MOST
) -> DataFrame:
    """`sources` (key, source_size) with `target`: a share of growth * all sizes.

    Sources weigh `weights` in turn, in the order of their keys. No target is above most * source_size: what is too
    much is shared again by weight among the rest, until none is above.
    """
    if not 0 < growth <= most or not weights or min(weights) <= 0:
        raise ValueError("growth has to be above 0 and at most `most`, weights above 0")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.expr(f"int((position - 1) % {len(weights)}) + 1"))
    weighed = numbered(sources, F.col("key")).select("key", "source_size", weight.cast("double").alias("weight"))
    weighed = through_storage(weighed, "weighed-sources")
    total, level = growth * (weighed.agg(F.sum("source_size")).first()[0] or 0), 0.0
    bound = most * F.col("source_size")
    while True:
        # The level only rises, and with it the sources that are full.
        full = F.col("weight") * level >= bound
        sums = weighed.agg(F.sum(F.when(full, bound)), F.sum(F.when(~full, F.col("weight")))).first()
        if not sums[1] or (risen := (total - (sums[0] or 0)) / sums[1]) <= level:
            break
        level = risen
    return weighed.select("key", "source_size", F.least(F.col("weight") * level, bound.cast("double")).alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(key, tilt, mean): with rates least(most, exp(tilt * size / mean)) the cells of a source have its target.

    cells: (key, size, n documents); mean: of the sizes that are not 0. A Newton step that leaves what is known to hold the
    solution is replaced by a half of it. A source that is taken `most` times as a whole has an infinite tilt.
    """
    cells = cells.where("size > 0")
    means = cells.groupBy("key").agg((F.sum(F.expr("size * n")) / F.sum("n")).alias("mean"))
    joined = targets.join(means, "key")
    full = F.col("target") >= most * F.col("source_size")
    nothing = F.lit(None).cast("double")
    state = joined.select(
        "key", "target", "mean", F.when(full, float("inf")).otherwise(0.0).alias("tilt"),
        nothing.alias("low"), nothing.alias("high"), full.alias("done"),
    )
    state = through_storage(state, "tilts")
    x = F.col("size") / F.col("mean")
    tokens = F.col("n") * F.col("size") * F.exp(F.least(F.col("tilt") * x, F.lit(math.log(most))))
    slope = F.when(F.col("tilt") * x < math.log(most), tokens * x).otherwise(0.0)
    for _ in range(STEPS):
        if state.where("NOT done").isEmpty():
            return state.select("key", "tilt", "mean")
        sums = (
            cells.join(state.where("NOT done"), "key")
            .groupBy("key")
            .agg(*(F.sum(F.rint(v * _WORD_PARTS).cast("bigint")).alias(c) for c, v in (("taken", tokens), ("slope", slope))))
            .select("key", (F.col("taken") / _WORD_PARTS).alias("taken"), (F.col("slope") / _WORD_PARTS).alias("slope"))
        )
        over = F.col("taken") > F.col("target")
        near = F.abs(F.col("taken") - F.col("target")) <= F.greatest(F.lit(16 / _WORD_PARTS), F.col("target") * 1e-9)
        known = state.join(sums, "key", "left").select(
            "key", "target", "mean", "tilt", "taken", "slope", (F.col("done") | near).alias("done"),
            F.when(over, F.col("low")).otherwise(F.col("tilt")).alias("low"),
            F.when(over, F.col("tilt")).otherwise(F.col("high")).alias("high"),
        )
        # Where one side is not known yet, a step is at most 1 + 2 * |tilt| long.
        reach = 1 + 2 * F.abs("tilt")
        least, greatest = F.coalesce("low", F.col("tilt") - reach), F.coalesce("high", F.col("tilt") + reach)
        step = F.col("tilt") + F.try_divide(F.col("target") - F.col("taken"), F.col("slope"))
        half = F.when(F.col("low").isNull(), least).when(F.col("high").isNull(), greatest).otherwise((least + greatest) / 2)
        moved = F.when(F.col("done"), F.col("tilt")).when((step > least) & (step < greatest), step).otherwise(half)
        # All is worked out from one tilt, so in one select.
        state = through_storage(known.select("key", "target", "mean", moved.alias("tilt"), "low", "high", "done"), "tilts")
    raise ArithmeticError(f"no tilts found in {STEPS} steps")


def _copies(cells: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(key, size, n, rate, copies): whole copies of the n documents of a source and size, near n * rate.

    Rates are rounded along falling sizes, so that what one size lacks the next one gets; then, in each source, one copy
    more or less of the size nearest to what is lacking or too much, a few times.
    """
    rate = F.when(F.col("size") == 0, 1.0).otherwise(
        F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(most))))
    )
    rated = cells.join(tilts(cells, targets, most), "key", "left").select("key", "size", "n", rate.alias("rate"))
    parts = rated.withColumn("parts", F.col("n") * F.rint(F.col("rate") * (1 << _COPY_BITS)).cast("bigint"))
    # Sizes of one number of binary digits are rounded together: a source may have very many sizes.
    falling = Window.partitionBy("key", F.length(F.bin("size"))).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    half = 1 << (_COPY_BITS - 1)
    ahead = parts.withColumn("upto", F.sum("parts").over(falling))
    copies = F.expr(f"shiftright(upto + {half}L, {_COPY_BITS}) - shiftright(upto - parts + {half}L, {_COPY_BITS})")
    copies = F.least(F.greatest(copies, F.lit(0)), F.col("n") * most)
    rounded = through_storage(ahead.select("key", "size", "n", "rate", copies.alias("copies")), "copies")
    for _ in range(MENDS):
        taken = rounded.groupBy("key").agg(F.sum(F.expr("size * copies")).alias("taken"))
        lack = targets.join(taken, "key").select("key", (F.col("target") - F.col("taken")).alias("lack"))
        able = F.when(F.col("lack") > 0, F.col("copies") < F.col("n") * most).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs("lack") - F.col("size"))
        best = (
            rounded.join(lack, "key")
            .where(able & (left < F.abs("lack")))
            .groupBy("key")
            .agg(F.min(F.struct(left.alias("left"), F.col("size"), F.signum("lack").cast("bigint").alias("more"))).alias("best"))
        )
        best = through_storage(best.select("key", "best.size", "best.more"), "mends")
        if best.isEmpty():
            break
        mended = rounded.join(best, ["key", "size"], "left")
        mended = mended.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("more")
        rounded = through_storage(mended, "copies")
    return rounded


def _dealt(documents: DataFrame, weights: Sequence[int], growth: float, most: int) -> DataFrame:
    """(doc_id, key, size, m, source_size, target, rate, low, more): of the m equal rows `more` are taken low + 1 times,
    the rest low times. documents: (doc_id, key, size)."""
    groups = documents.groupBy("doc_id", "key", "size").agg(F.count(F.lit(1)).alias("m"))
    draw = F.xxhash64("key", "size", "doc_id", F.lit("mix"))
    groups = groups.withColumns({"draw": draw, "slice": F.pmod(draw, F.lit(_SLICES * _SLICES))})
    groups = through_storage(groups, "sized-documents")
    cells = through_storage(groups.groupBy("key", "size").agg(F.sum("m").alias("n")), "sizes")
    sizes = cells.groupBy("key").agg(F.sum(F.expr("size * n")).alias("source_size"))
    targets = through_storage(token_targets(sizes, weights, growth, most), "targets")
    copies = _copies(cells, targets, most)

    # The place of each document among those of its source and size: by slices of slices, then inside a slice.
    fine = groups.groupBy("key", "size", "slice").agg(F.sum("m").alias("held"))
    fine = through_storage(fine.withColumn("outer", F.expr(f"slice div {_SLICES}")), "slices")
    outer = fine.groupBy("key", "size", "outer").agg(F.sum("held").alias("held"))
    by_outer = Window.partitionBy("key", "size").orderBy("outer").rowsBetween(*_INSIDE)
    by_slice = Window.partitionBy("key", "size", "outer").orderBy("slice").rowsBetween(*_INSIDE)
    outer = outer.join(copies, ["key", "size"]).join(targets, "key")
    outer = outer.withColumn("outer_start", F.coalesce(F.sum("held").over(by_outer), F.lit(0))).drop("held")
    fine = fine.withColumn("fine_start", F.coalesce(F.sum("held").over(by_slice), F.lit(0))).drop("held")
    starts = fine.join(outer, ["key", "size", "outer"])
    in_slice = Window.partitionBy("key", "size", "slice").orderBy("draw", "doc_id").rowsBetween(*_INSIDE)
    placed = groups.withColumn("before", F.coalesce(F.sum("m").over(in_slice), F.lit(0)))
    placed = placed.join(starts, ["key", "size", "slice"])
    start = F.col("outer_start") + F.col("fine_start") + F.col("before")
    more = F.greatest(F.lit(0), F.least(F.col("m"), F.expr("copies % n") - start))
    return placed.select(
        "doc_id", "key", "size", "m", "source_size", "target", "rate",
        F.expr("copies div n").alias("low"), more.cast("bigint").alias("more"),
    )


def mix_plan(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, growth: float = GROWTH, most: int = MOST,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, rate, copies, taken.

    size: words of the text between blanks and the control characters 9 to 13; source_size: of its source, target: words that the mix is to
    take from it (`token_targets`); rate: how often the document would be taken, copies: how often it is, taken: copies * size.
    A null or empty text has size 0, takes nothing and is taken once. Null sources are one source, the last one. Repeated rows each give
    a row, and may differ in copies; a null doc_id stays null. Documents of one size in a source are taken in the order of a
    hash of source, size and doc_id, so runs agree. Other columns play no part; an empty table gives an empty result.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    rows = _sized(rows, "doc_id", "text", "source").select("doc_id", "key", "size")
    dealt = through_storage(_dealt(rows, weights, growth, most), "dealt-copies")
    halves = F.array(
        F.struct(F.expr("low + 1").alias("copies"), F.col("more").alias("rows")),
        F.struct(F.col("low").alias("copies"), F.expr("m - more").alias("rows")),
    )
    each = dealt.withColumn("half", F.explode(halves)).where("half.rows > 0")
    kept = ["doc_id", "size", "source_size", "target", "rate", "half.copies", F.expr("half.copies * size").alias("taken")]
    few = each.where(f"half.rows <= {_REPEATED}").withColumn("nth", F.explode(F.expr("sequence(1L, half.rows)")))
    # Very many equal rows are counted out in pieces, by many tasks.
    piece = F.explode(F.expr(f"sequence(0L, (half.rows - 1) div {_REPEATED})"))
    many = each.where(f"half.rows > {_REPEATED}").withColumn("piece", piece).repartition("doc_id", "piece")
    left = f"sequence(1L, least({_REPEATED}L, half.rows - piece * {_REPEATED}L))"
    many = many.withColumn("nth", F.explode(F.expr(left)))
    return few.select(*kept).union(many.select(*kept))


def mixed(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, growth: float = GROWTH, most: int = MOST,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix: each document of `documents`, with all its columns, as often as `mix_plan` takes it."""
    names = {n: free_name(documents, f"mix_{n}") for n in ("id", "key", "size", "low", "more", "m", "nth")}
    sized = _sized(documents, doc_id, text, source, key=names["key"], size=names["size"])
    rows = sized.select(F.col(doc_id).alias("doc_id"), F.col(names["key"]).alias("key"), F.col(names["size"]).alias("size"))
    dealt = _dealt(rows, weights, growth, most).select(
        F.col("doc_id").alias(names["id"]), *(F.col(c).alias(names[c]) for c in ("key", "size", "low", "more", "m"))
    )
    dealt = through_storage(dealt, "dealt-copies")
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col(f"c.{names['id']}"))
    for c in ("key", "size"):
        same = same & (F.col(f"d.{names[c]}") == F.col(f"c.{names[c]}"))
    joined = sized.alias("d").join(dealt.alias("c"), same)
    wanted = [F.col(f"d.`{c}`") for c in documents.columns]
    low, more, m = (F.col(names[c]) for c in ("low", "more", "m"))
    alike = joined.where((more == 0) | (more == m)).select(*wanted, (low + (more > 0).cast("bigint")).alias(names["nth"]))
    # Of equal rows with unlike copies any may be the ones with more.
    nth = F.row_number().over(Window.partitionBy(names["id"], f"c.{names['key']}", f"c.{names['size']}").orderBy(F.lit(0)))
    unlike = joined.where((more > 0) & (more < m)).withColumn(names["nth"], nth)
    unlike = unlike.select(*wanted, (low + (F.col(names["nth"]) <= more).cast("bigint")).alias(names["nth"]))
    both = alike.union(unlike).where(F.col(names["nth"]) > 0)
    return both.withColumn(names["nth"], F.explode(F.sequence(F.lit(1), names["nth"]))).drop(names["nth"])
