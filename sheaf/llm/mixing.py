"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source shares one expected number of copies. Its whole part is taken for sure; the fractional
parts are rounded dependently: two documents trade mass (copies times words) at random until one of them is integral,
which keeps both expectations and the words taken in all. Blocks of documents are folded so, each leaves at most one
fractional document, and the leftovers are folded again in blocks until one is left per source.

Only DataFrame functions run; blocks hold about ``BLOCK`` documents whatever the size of the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import bind, settle, small, spare_name, word_count

BLOCK = 64
WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0, share: float = 1.0) -> DataFrame:
    """``source, source_size, rows, target`` of a frame ``(source, size)``.

    Sources in code point order, NULL last, take the weights in turn. The targets divide ``share`` of all sizes by
    weight; none exceeds ``cap`` times its source, and what lies above goes to the others by weight. That is
    ``least(cap * source_size, level * weight)`` for the one level at which the targets add up. The sum of these is
    a concave function of the level, the lowest of the lines ``caps of the first k sources + level * weight of the
    others`` with sources ordered by ``cap * source_size / weight``; the level is therefore the highest of those where
    each line alone would reach the total. One narrow row per source meets in one task, not one per document.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = totals.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, F.lit(len(weights))))
    ).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    left = wanted - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    return (
        weighted.withColumn("_level", F.greatest(left / weight_left, F.lit(0.0)))
        .withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size", "rows", F.least("most", F.col("_level") * F.col("weight")).alias("target"))
    )


def _pivot(state: Column, item: Column) -> Column:
    """Fold step: the fractional document of ``state`` against ``item``; the one that gets integral is put to ``done``."""

    def held(doc: Column, mass: Column, p: Column, has: Column, done: Column) -> Column:
        return F.struct(
            has.alias("has"), doc.alias("doc"), mass.alias("mass"), p.alias("p"), done.alias("done")
        )

    def decided(doc: Column, take: Column | int) -> Column:
        return F.struct(doc.alias("doc"), (F.lit(take) if isinstance(take, int) else take).cast("int").alias("take"))

    def trade(x: Column) -> Column:
        m, n = state["mass"], item["mass"]
        to_state, to_item = x["up"], x["down"]
        upward = item["u"] * (to_state + to_item) < to_item
        # the traded mass either fills the receiver or empties the giver
        p = F.when(upward, state["p"] + to_state / m).otherwise(state["p"] - to_item / m)
        q = F.when(upward, item["p"] - to_state / n).otherwise(item["p"] + to_item / n)
        state_done = F.when(upward, (1 - state["p"]) * m <= item["p"] * n).otherwise(
            state["p"] * m <= (1 - item["p"]) * n
        )
        item_done = F.when(upward, (1 - state["p"]) * m >= item["p"] * n).otherwise(
            state["p"] * m >= (1 - item["p"]) * n
        )
        state_take = decided(state["doc"], F.when(upward, 1).otherwise(0))
        item_take = decided(item["doc"], F.when(upward, 0).otherwise(1))
        done = (
            F.when(state_done & item_done, F.concat(state["done"], F.array(state_take, item_take)))
            .when(state_done, F.concat(state["done"], F.array(state_take)))
            .otherwise(F.concat(state["done"], F.array(item_take)))
        )
        return held(
            F.when(state_done, item["doc"]).otherwise(state["doc"]),
            F.when(state_done, n).otherwise(m),
            F.when(state_done, q).otherwise(p),
            ~(state_done & item_done),
            done,
        )

    first = held(item["doc"], item["mass"], item["p"], F.lit(True), state["done"])
    room = F.struct(
        F.least((1 - state["p"]) * state["mass"], item["p"] * item["mass"]).alias("up"),
        F.least(state["p"] * state["mass"], (1 - item["p"]) * item["mass"]).alias("down"),
    )
    return F.when(~state["has"], first).otherwise(bind(room, trade))


def _uniform(*parts) -> Column:
    """A number from 0 up to 1 that depends on nothing but the given values, so that a rerun draws it again."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def round_copies(items: DataFrame, seed: int = 0) -> DataFrame:
    """``source, doc, take`` for items ``(source, doc, mass, p)``: 0 or 1, with the mass of each source kept.

    The last fractional document of a source goes to the nearer side, so the mass taken in a source differs from the
    expected one by at most half of that document. ``doc`` is any struct that
    tells the items of a source apart. Items without mass are drawn on their own. Each level of the reduction tree
    is checkpointed.
    """
    items = settle(items)
    empty = (F.col("mass") <= 0) | (F.col("p") <= 0) | (F.col("p") >= 1)
    done = [
        items.where(empty).select("source", "doc", (_uniform(F.lit(seed), F.lit(-1), "source", "doc") < F.col("p")).cast("int").alias("take"))
    ]
    open_items = items.where(~empty)
    counts = settle(open_items.groupBy("source").agg(F.count(F.lit(1)).alias("open")))
    sources, most = counts.agg(F.count(F.lit(1)), F.coalesce(F.max("open"), F.lit(0))).first()
    level = 0
    while most > 0:
        blocks = F.ceil(F.col("open") / float(BLOCK ** (level + 1))).cast("bigint")
        draw = F.xxhash64(F.lit(seed), F.lit(level), "source", "doc")
        counts_here = counts.withColumnRenamed("source", "_source")
        blocked = (
            open_items.join(small(counts_here, sources), F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("_block", F.pmod(draw, blocks))
            .groupBy("source", "_block")
            .agg(
                F.sort_array(
                    F.collect_list(
                        F.struct(_uniform(F.lit(seed), F.lit(level), "doc", "source").alias("u"), "doc", "mass", "p")
                    )
                ).alias("_items")
            )
        )
        a_doc = F.get("_items", F.lit(0))
        pair = blocked.schema["_items"].dataType.elementType["doc"].dataType.simpleString()
        zero = F.struct(
            F.lit(False).alias("has"),
            a_doc["doc"].alias("doc"),
            F.lit(0.0).alias("mass"),
            F.lit(0.0).alias("p"),
            F.array().cast(f"array<struct<doc:{pair},take:int>>").alias("done"),
        )
        folded = settle(blocked.select("source", F.aggregate("_items", zero, _pivot).alias("s")))
        done.append(folded.select("source", F.explode("s.done").alias("d")).select("source", "d.doc", "d.take"))
        open_items = folded.where("s.has").select("source", "s.doc", "s.mass", "s.p")
        if most <= BLOCK ** (level + 1):
            last = (F.col("p") >= 0.5).cast("int")
            done.append(open_items.select("source", "doc", last.alias("take")))
            break
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def mix_sizes(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: float = 3.0,
    share: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """Copies for each kind of row of a frame ``(doc_id, source, size)``: one row per kind.

    Rows alike in all three columns are one kind and rounded together (``n`` of them get the same ``copies``). Any
    column may be NULL; documents without a source are a source of their own. Result: ``doc_id, source, size, n,
    source_size, target, copies``. A source without words has target 0 and no copies.
    """
    kinds = settle(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = settle(source_targets(kinds.select("source", (F.col("size") * F.col("n")).alias("size")), weights, cap, share))
    per_copy = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    known = targets.select(
        F.col("source").alias("_source"), "source_size", "target", per_copy.alias("_expected")
    )
    known = small(known, known.count())
    expected = kinds.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor("_expected")
    items = expected.select(
        "source",
        F.struct("doc_id", "size", "n").alias("doc"),
        (F.col("size") * F.col("n")).cast("double").alias("mass"),
        (F.col("_expected") - whole).alias("p"),
    )
    return (
        round_copies(items, seed)
        .join(known, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "doc.doc_id",
            "source",
            "doc.size",
            "doc.n",
            "source_size",
            "target",
            (whole + F.col("take")).cast("bigint").alias("copies"),
        )
    )


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The mixture itself: every document as often as it is taken, all columns of ``docs`` unchanged.

    ``docs`` has ``doc_id``, ``source`` and ``text``, and any other columns. Sizes are words of the whole text;
    NULL and empty texts have none and are taken by the same expected number of copies.
    """
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    copies = mix_sizes(sized, weights, cap, seed=seed).where(F.col("copies") > 0)
    alike = (
        F.col("_d.doc_id").eqNullSafe(F.col("_c.doc_id"))
        & F.col("_d.source").eqNullSafe(F.col("_c.source"))
        & (word_count("_d.text") == F.col("_c.size"))
    )
    copy = spare_name(docs, "_copy")
    every = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_c.copies"))).alias(copy)
    return docs.alias("_d").join(copies.alias("_c"), alike).select("_d.*", every).drop(copy)
