"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.llm.common import col, ranked, written

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 4096  # documents rounded in one go
FAN = 64  # chunks whose leftovers meet in one node of the tree
EDGE = 1e-9  # a chance this close to 0 or 1 is settled


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from rows of (source, size).

    Sources by code point, null last, weigh `weights`, repeating, and share
    `share` of all sizes. A target stops at `most` times its source's size; the
    level that the others are raised to grows until what they share adds up.
    Every round sums the written source table; only sums come to the driver.
    """
    totals = rows.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"), F.count("*").alias("n"))
    placed = ranked(totals.withColumn("_none", F.col("source").isNull()), ["_none", "source"], rank="_place", name="sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    sources = written(placed.withColumn("_w", weight).drop("_none", "_place"), "sources")
    cap = F.col("source_size") * most
    whole, level, full = sources.agg(F.sum("source_size"), F.lit(0.0), F.lit(-1)).first()
    budget = share * (whole or 0.0)
    while budget:
        above = F.col("_w") * level > cap
        held, free, now = sources.agg(F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("_w"))), F.count(F.when(above, 1))).first()
        if now == full:
            break
        if not free:
            level = math.inf
            break
        level, full = (budget - held) / free, now
    target = cap if level == math.inf else F.least(F.col("_w") * F.lit(level), cap)
    return sources.select("source", "source_size", "n", target.alias("target"))


def pivotal(chances: list[float], draws: list[float]) -> tuple[list[int], int | None, float]:
    """Rounds chances to 0 or 1 pair by pair; the sum of the chances never changes.

    Of the two open ones, one takes mass from the other at random until one is
    settled, so that each ends at 1 with exactly its chance. Returns the settled
    values, and the place and chance of the one left open, if any.
    """
    out, open_at, a = [0] * len(chances), None, 0.0
    for k, b in enumerate(chances):
        if b <= EDGE or b >= 1 - EDGE:
            out[k] = int(b > 0.5)
        elif open_at is None:
            open_at, a = k, b
        else:
            total = a + b
            if total < 1:
                if draws[k] * total >= a:  # k takes it all
                    open_at = k
                a = total
            else:
                if draws[k] * (2 - total) < 1 - b:  # the open one is settled at 1, k keeps the rest
                    out[open_at] = 1
                    open_at = k
                else:
                    out[k] = 1
                a = total - 1
            if a <= EDGE or a >= 1 - EDGE:
                out[open_at] = int(a > 0.5)
                open_at = None
    return out, open_at, a


def _rounded(finish: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", ignore_index=True)
        draws = rows["draw"].tolist()
        out, left, a = pivotal(rows["chance"].tolist(), draws)
        extra = pd.array(out, dtype="Int32")
        if left is not None:
            if finish:
                # the last draw decided a pair already; its fraction's next digits are fresh
                extra[left] = int((draws[left] * 7919.0 + 0.5) % 1.0 < a)
            else:
                extra[left] = pd.NA
                rows.loc[left, "chance"] = a
        rows["extra"] = extra
        return rows

    return run


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", tag_col: str | None = None,
) -> DataFrame:
    """doc_id, size (words), source_size, target, copies and taken (copies times size) of each row.

    Every document of a source is due target / source_size copies: the whole
    part for all, the fraction as a chance that pivotal rounding settles. Within its source a
    document's rank by size decides its chunk, so that mass moves between
    documents of like size, the words taken stay near the target, and a hot source is
    many chunks. The one chance that each chunk leaves open goes up a tree,
    `FAN` to a node, each level written, until the last is drawn.

    Draws are hashes of seed, id and rank: reruns agree. Null text: size 0.
    A null source is a source of its own. Sources of size 0 and empty tables have
    nothing to take. Wholly equal rows are interchangeable; each has its own copies.
    `tag_col` (a long) tells rows of one id apart and is kept as tag.
    """
    tag = [tag_col] if tag_col else []
    sizes = docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), words(col(text_col)).alias("size"), *[col(c).alias("tag") for c in tag])
    rows = written(sizes.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))), "sizes")
    targets = written(source_targets(rows, weights, share, most), "targets").select(F.col("source").alias("_of"), "source_size", "n", "target")
    # largest first: what stays open to the end is small
    placed = ranked(rows.withColumn("_less", -F.col("size")), ["source", "_less", "h", "doc_id", *["tag" for _ in tag]], ["source"], name="by-size")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "h", "rank"), 11) / F.lit(float(1 << 53))
    ready = placed.join(targets, F.col("source").eqNullSafe(F.col("_of"))).withColumn("due", due).select(
        "doc_id", "source", "size", "rank", F.expr(f"rank div {CHUNK}").alias("node"), "source_size", "target",
        F.floor("due").cast("int").alias("base"), (F.col("due") - F.floor("due")).alias("chance"), draw.alias("draw"), *["tag" for _ in tag],
    )
    largest = targets.agg(F.max("n")).first()[0] or 0
    schema = "doc_id {}, source string, size long, rank long, node long, source_size double, target double, base int, chance double, draw double{}, extra int".format(
        rows.schema["doc_id"].dataType.simpleString(), ", tag long" * len(tag)
    )
    nodes = math.ceil(largest / CHUNK)
    level = written(ready.groupBy("source", "node").applyInPandas(_rounded(False), schema), "rounded")
    settled = level.where("extra is not null")
    while True:
        nodes = math.ceil(nodes / FAN)
        left = level.where("extra is null").drop("extra").withColumn("node", F.expr(f"node div {FAN}"))
        level = written(left.groupBy("source", "node").applyInPandas(_rounded(nodes <= 1), schema), "rounded")
        settled = settled.unionByName(level.where("extra is not null"))
        if nodes <= 1:
            break
    copies = F.col("base") + F.col("extra")
    return settled.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), *["tag" for _ in tag])
