"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

A source's target in words over its size is the number of copies each of its documents should get. The whole part is
certain; the fractions are rounded dependently. Two fractional documents meet and, at random, words move from one to the
other until one fraction is 0 or 1; expectation and the sum of words stay as they were. The document that is still
fractional goes on to the next meeting. Documents of a source fold this way in groups of at most about FAN rows, the
groups' residuals fold in the next round, and so on: a reduction tree whose rounds grow with the logarithm of the
largest source. One residual per source is rounded on its own, so a source misses its target by less than one document
(and by rounding of the target itself).

All random numbers are hashes of the ids, so reruns agree. Null texts have size 0, blank ones too; documents of size 0
take nothing and join no meeting. The null source is a source of its own, the last. Rows with the same id and text are
rows like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import stored

FAN = 256  # documents that fold in one array
WORD = r"[^\x20\x09-\x0D]+"
ITEM = "struct<p:double,size:long,copies:long,doc_id:long,row:long>"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size).

    Weights repeat over the sources in code-point order, null last. The total is shared by weight; a source gets at most
    `cap` times its size, and what it leaves is shared among the others by weight until none is above. With sources in
    order of size per weight, those at their cap are a prefix, so running sums find the final share at once. The table
    has one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.get(cycle, ((F.row_number().over(order) - 1) % len(weights)).cast("int")).cast("long"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("left_words", F.col("total") - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # fits: with all smaller ones at their cap, this source's share is within its own
        .withColumn("fits", F.col("left_words") * F.col("weight") <= cap * F.col("source_size") * F.col("left_weight"))
    )
    # the first that fits sets the share of itself and of all after it
    first = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "left_words", "left_weight"))).over(every)
    final = shared.withColumn("share", first)
    uncapped = F.col("share.left_words") * F.col("weight") < cap * F.col("source_size") * F.col("share.left_weight")
    target = F.when(
        uncapped, (F.col("share.left_words") * F.col("weight")).cast("double") / F.col("share.left_weight").cast("double")
    ).otherwise((cap * F.col("source_size")).cast("double"))
    return final.select("source", "source_size", target.alias("target"))


def uniform(*columns: Column | str) -> Column:
    """A number in (0, 1) from a hash; 53 bits, never 0."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def meet(state: Column, item: Column, step: int) -> Column:
    """Fold step: the carried document meets the next one; the settled one joins the list, the other is carried on."""
    carry, done = state["carry"], state["done"]
    ratio = item["size"].cast("double") / carry["size"].cast("double")  # words of the item per word of the carry
    up = F.least(1 - carry["p"], item["p"] * ratio)
    down = F.least(carry["p"], (1 - item["p"]) * ratio)
    grows = uniform(carry["doc_id"], carry["row"], item["doc_id"], item["row"], F.lit(step)) * (up + down) < down

    def with_p(who: Column, p: Column) -> Column:
        return who.withField("p", p)

    def settled(who: Column, extra: int) -> Column:
        return F.struct(F.lit(float(extra)).alias("p"), who["size"].alias("size"), (who["copies"] + extra).alias("copies"), who["doc_id"].alias("doc_id"), who["row"].alias("row"))

    def result(new_carry: Column, out: Column) -> Column:
        return F.struct(new_carry.alias("carry"), F.concat(done, F.array(out)).alias("done"))

    full = 1 - carry["p"] <= item["p"] * ratio  # the carry reaches 1 before the item reaches 0
    empty = carry["p"] <= (1 - item["p"]) * ratio  # the carry reaches 0 before the item reaches 1
    met = (
        F.when(grows & full, result(with_p(item, item["p"] - (1 - carry["p"]) / ratio), settled(carry, 1)))
        .when(grows, result(with_p(carry, carry["p"] + item["p"] * ratio), settled(item, 0)))
        .when(empty, result(with_p(item, item["p"] + carry["p"] / ratio), settled(carry, 0)))
        .otherwise(result(with_p(carry, carry["p"] - (1 - item["p"]) * ratio), settled(item, 1)))
    )
    return F.when(carry.isNull(), F.struct(item.alias("carry"), done.alias("done"))).otherwise(met)


def fold(groups: DataFrame, step: int) -> DataFrame:
    """(source, group, items) with the documents of each group folded into `carry` and `done`."""
    start = F.struct(F.lit(None).cast(ITEM).alias("carry"), F.array().cast(f"array<{ITEM}>").alias("done"))
    folded = F.aggregate("items", start, lambda state, item: meet(state, item, step))
    return groups.select("source", folded.alias("folded"))


def round_copies(docs: DataFrame, largest: int) -> DataFrame:
    """(source, doc_id, row, size, copies) from (source, doc_id, row, size, copies, p); `largest`: rows of the largest source."""
    item = F.struct("p", "size", "copies", "doc_id", "row").alias("item")
    fractional = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    settled = [docs.filter(~fractional).select("source", "doc_id", "row", "size", "copies")]
    level = docs.filter(fractional).select("source", item)
    for step in range(max(1, math.ceil(math.log(max(largest, 2), FAN // 2))) + 1):
        groups = max(1, math.ceil(largest / (FAN // 2) ** (step + 1)))
        grouped = level.groupBy("source", F.pmod(F.xxhash64("item.doc_id", "item.row", F.lit(step)), F.lit(groups)).alias("group"))
        items = F.array_sort(F.collect_list("item"), lambda x, y: in_turn(x, y)).alias("items")
        folded = stored(fold(grouped.agg(items), step), "mixing-round")
        settled.append(folded.select("source", F.inline("folded.done")).select("source", "doc_id", "row", "size", "copies"))
        level = folded.filter("folded.carry is not null").select("source", F.col("folded.carry").alias("item"))
        if groups == 1:
            break
    last = level.select("source", "item.*")
    lucky = uniform("doc_id", "row", F.lit("last")) < F.col("p")
    settled.append(last.select("source", "doc_id", "row", "size", (F.col("copies") + lucky.cast("long")).alias("copies")))
    result = settled[0]
    for part in settled[1:]:
        result = result.unionByName(part)
    return result


def in_turn(x: Column, y: Column) -> Column:
    """Longest first: what is left over at the end is short. Ties by id, row and fraction."""
    def order(name: str, sign: int) -> Column:
        return F.when(x[name] < y[name], -sign).when(x[name] > y[name], sign).otherwise(0)

    keys = [order("size", -1), order("doc_id", 1), order("row", 1), order("p", 1)]
    nonzero = F.filter(F.array(*[F.coalesce(k, F.lit(0)) for k in keys]), lambda k: k != 0)
    return F.coalesce(F.get(nonzero, F.lit(0)), F.lit(0))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cap: int = 3) -> DataFrame:
    """Per row: doc_id, row (a hash of its text), size, source, source_size, target, copies, taken (copies x size)."""
    sized = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("row"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mixing-sizes",
    )
    counted = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    largest = counted.agg(F.max("n")).first()[0] or 0
    targets = source_targets(counted.select("source", "source_size"), cap=cap).withColumnRenamed("source", "of")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.least(F.floor(ratio), F.lit(cap)).cast("long")
    wanted = joined.withColumn("copies", copies).withColumn("p", F.when(F.col("size") > 0, ratio - F.col("copies")).otherwise(F.lit(0.0)))
    rounded = round_copies(wanted.select("source", "doc_id", "row", "size", "copies", "p"), largest)
    return rounded.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "row", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
