"""Sharding along a Hilbert curve through quantised metadata. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.llm.common import col, ranked, written


def hilbert_index(dims: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of the cell with these coordinates, each an integer of `bits` bits.

    Walks from the highest bit of the coordinates to the lowest. At each
    level the coordinates' bits name a corner of the current cube; the cube's
    orientation (entry corner e and direction d) turns it into the place along
    the curve, and says how the next smaller cube is turned. The tables below
    have one entry per corner (and direction) and follow from the Gray code.
    """
    n = len(dims)
    corners, mask = 1 << n, (1 << n) - 1

    def rotl(x: int, k: int) -> int:
        k %= n
        return ((x << k) | (x >> (n - k))) & mask

    gray = [w ^ (w >> 1) for w in range(corners)]
    place = [gray.index(g) for g in range(corners)]
    entry = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(corners)]
    ones = lambda w: 0 if not w & 1 else 1 + ones(w >> 1)  # noqa: E731  trailing ones
    turn = [0 if w == 0 else ones(w if w % 2 else w - 1) % n for w in range(corners)]
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    at = lambda xs, k: F.element_at(array(xs), (k + 1).cast("int"))
    # place along the curve by direction and turned corner; the next entry corner, turned back
    places = [place[rotl(c, n - (d + 1) % n)] for d in range(n) for c in range(corners)]
    entries = [rotl(entry[w], d + 1) for d in range(n) for w in range(corners)]

    def step(acc: Column, corner: Column) -> Column:
        w = at(places, acc.d * corners + acc.e.bitwiseXOR(corner))
        return F.struct(
            (acc.h * corners + w).cast("long").alias("h"),
            w.cast("int").alias("w"),
            acc.e.alias("e"),
            acc.d.alias("d"),
        )

    def advance(acc: Column) -> Column:
        return F.struct(
            acc.h.alias("h"),
            acc.w.alias("w"),
            acc.e.bitwiseXOR(at(entries, acc.d * corners + acc.w)).cast("int").alias("e"),
            ((acc.d + at(turn, acc.w) + 1) % n).cast("int").alias("d"),
        )

    levels = F.array(*[
        sum(((F.shiftright(x.cast("int"), b).bitwiseAND(F.lit(1))) * (1 << k) for k, x in enumerate(dims)), F.lit(0)).cast("int")
        for b in reversed(range(bits))
    ])
    zero = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("w"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(levels, zero, lambda acc, c: advance(step(acc, c)), lambda acc: acc.h)


def cells_by_rank(df: DataFrame, name: str, bits: int) -> DataFrame:
    """(value, cell): each distinct value of a column with its place among them, spread over 2**bits cells; null first."""
    values = df.select(col(name).alias("value")).distinct()
    places = ranked(values, ["value"], rank="place", name="values")
    n = places.count()
    return places.select("value", F.floor(F.col("place") * (1 << bits) / max(1, n)).cast("int").alias("cell"))


def hilbert_shards(
    docs: DataFrame, shards: int = 40, bits: int = 8, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("source", "lang"), overhead: int = 16
) -> DataFrame:
    """Cuts the documents into `shards` runs along a Hilbert curve, counts at most one apart.

    The dimensions are the rank of each column of `by` among its values and the
    binary logarithm of the size, each quantised to `bits` bits, so a shard's
    file has narrow bounds in all of them and a filter on any skips most files.

    Returns id, size (UTF-8 bytes plus `overhead`; a null text has none),
    text_crc32 (of a null text: of no bytes), curve (the index), law 'rows',
    shard, slot (gapless from 0 in the shard) and grown_shard (null: the law is not by
    key). Null metadata is the first value. Ties along the curve go by the metadata, size, checksum and id; wholly equal rows
    are interchangeable, and all are kept. Fewer rows than shards leave shards
    empty; an empty table gives no rows. Extra columns are ignored.
    """
    bare = docs.select(
        col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(col(text_col)), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.coalesce(col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        *[col(c).cast("string").alias(f"_by{k}") for k, c in enumerate(by)],
    )
    bare = written(bare, "sizes")
    placed = bare
    dims = []
    for k in range(len(by)):
        cells = written(cells_by_rank(bare, f"_by{k}", bits), "cells").select(F.col("value").alias(f"_v{k}"), F.col("cell").alias(f"_c{k}"))
        placed = placed.join(cells, F.col(f"_by{k}").eqNullSafe(F.col(f"_v{k}"))).drop(f"_v{k}")
        dims.append(F.col(f"_c{k}"))
    scale = (1 << bits) / 40.0  # sizes up to a terabyte
    dims.append(F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.col("size").cast("double")) * scale)).cast("int"))
    curved = placed.withColumn("curve", hilbert_index(dims, bits))
    order = ["curve", *[f"_by{k}" for k in range(len(by))], "size", "text_crc32", "doc_id"]
    rows = written(ranked(curved, order, rank="_rank", name="curve"), "sharded")
    n = rows.count()
    base, extra = divmod(n, shards)
    head = extra * (base + 1)  # the first `extra` shards hold one row more
    rank = F.col("_rank")
    shard = F.when(rank < head, F.expr(f"_rank div {base + 1}")).otherwise(F.expr(f"{extra} + (_rank - {head}) div {max(1, base)}"))
    slot = F.when(rank < head, rank % (base + 1)).otherwise((rank - head) % max(1, base))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
