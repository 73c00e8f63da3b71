"""SimHash near-duplicates by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import col, partitions, written
from bazaarlens.llm.components import connected_components, star_links

# rows of one half of a tile: an anchor with more fingerprints is compared tile by tile
TILE = 512
# shingles of a text hashed at a time
SLICE = 16_384
# links kept before they are thinned to stars
HELD_LINKS = 500_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each 1 if set in over half the XXH64 (seed 42) of the shingles, repeats included; without words 0."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    del words  # of a long text the words take far more memory than their ends
    starts, stops = np.concatenate([[0], ends[: n - 1]]), ends[-n:] - 1
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_digest
    for k in range(0, n, SLICE):
        parts = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[k : k + SLICE].tolist(), stops[k : k + SLICE].tolist(), strict=True)])
        counts += np.unpackbits(np.frombuffer(parts, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the columns of `keep` of each row; fp holds the unsigned fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            kept = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *kept], names=["doc_id", "fp", *[f"_{c}" for c in keep]])

    bare = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("_words"), *[col(c).alias(f"_{c}") for c in keep])
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in bare.schema.fields[2:]]
    found = bare.mapInArrow(run, ", ".join([f"doc_id {bare.schema['doc_id'].dataType.simpleString()}", "fp long", *kinds]))
    return found.select("doc_id", "fp", *[col(f"_{c}").alias(c) for c in keep])


def parts_of(distance: int) -> tuple[int, int]:
    """(parts, check bits r): two fingerprints within `distance` differ in at most one bit in one of the parts of 2**r - 1 bits."""
    parts = distance // 2 + 1
    return parts, (64 // parts + 1).bit_length() - 1


def anchors(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home): every anchor within covering radius plus threshold of each fingerprint.

    The anchors of a part are the words of the perfect Hamming code of length
    2**r - 1, whose covering radius is 1: a word's home is the one anchor within
    1. Two words that differ in at most one bit (the part's threshold) are both
    within 2 of the home of either, so a fingerprint goes to all anchors within 2.
    """
    parts, r = parts_of(distance)
    n = (1 << r) - 1
    bits = fps.view(np.uint64)
    pairs = np.array([[i, i ^ s] for s in range(1, n + 1) for i in range(1, n + 1) if i < i ^ s]).reshape(n, -1, 2)  # by syndrome s
    one = np.uint64(1)
    flips = (one << (pairs[..., 0] - 1).astype(np.uint64)) | (one << (pairs[..., 1] - 1).astype(np.uint64))
    rows, found, homes = [], [], []
    for part in range(parts):
        word = (bits >> np.uint64(part * (64 // parts))) & np.uint64((1 << n) - 1)
        syndrome = np.zeros(len(word), dtype=np.int64)
        for place in range(1, n + 1):
            syndrome ^= np.where((word >> np.uint64(place - 1)) & one, place, 0)
        home = np.where(syndrome > 0, word ^ (one << np.maximum(syndrome - 1, 0).astype(np.uint64)), word)
        away = np.flatnonzero(syndrome)
        visits = word[away, None] ^ flips[syndrome[away] - 1]
        rows += [np.arange(len(word)), np.repeat(away, visits.shape[1])]
        # the part is mixed into the anchor; a clash of two anchors only adds comparisons
        found += [(x * np.uint64(parts) + np.uint64(part)).view(np.int64) for x in (home, visits.ravel())]
        homes += [np.ones(len(word), dtype=bool), np.zeros(visits.size, dtype=bool)]
    return np.concatenate(rows), np.concatenate(found), np.concatenate(homes)


def _replicated(fps: DataFrame, distance: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            rows, anchor, home = anchors(values, distance)
            for k in range(0, len(rows), 100_000):
                s = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[s]), pa.array(values[rows[s]]), pa.array(home[s])], names=["anchor", "fp", "home"])

    return fps.mapInArrow(run, "anchor long, fp long, home boolean")


def _compared(distance: int):
    """Links within each run of equal tiles of a sorted partition, thinned to stars; a tile's rows are bounded."""

    def links(tile: np.ndarray, fp: np.ndarray, home: np.ndarray):
        bits, held, count = fp.view(np.uint64), [], 0
        at, step = np.arange(len(tile)), 1
        while True:
            at = at[at + step < len(tile)]
            at = at[(tile[at] == tile[at + step]).all(axis=1)]
            if not len(at):
                break
            near = (np.bitwise_count(bits[at] ^ bits[at + step]) <= distance) & (home[at] | home[at + step])
            if near.any():
                held.append((fp[at[near]], fp[at[near] + step]))
                count += int(near.sum())
                if count > HELD_LINKS:
                    held = [star_links(*map(np.concatenate, zip(*held, strict=True)))]
                    count = 0
            step += 1
        return star_links(*map(np.concatenate, zip(*held, strict=True))) if held else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            if kept:
                rows = [np.concatenate(x) for x in zip(kept, rows, strict=True)]
            tile = np.stack(rows[:3], axis=1)
            if not len(tile):
                continue
            last = np.flatnonzero((tile != tile[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut and (found := links(tile[:cut], rows[3][:cut], rows[4][:cut])):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["u", "v"])
            kept = [x[cut:] for x in rows]
        if kept and len(kept[0]) and (found := links(np.stack(kept[:3], axis=1), kept[3], kept[4])):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["u", "v"])

    return run


def near_links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Links (u, v) that connect all of the distinct fingerprints (column fp) within `distance` bits, a spanning part of them.

    Fingerprints are replicated to their anchors. Anchors that one fingerprint
    alone has drop out by a count. An anchor with many is cut into tiles of
    `TILE` against `TILE` fingerprints, each a task's bounded work; of a
    tile's links one per fingerprint is kept, which connects the same.
    """
    spark = fps.sparkSession
    near = _replicated(fps, distance)
    busy = near.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("homed")).where("n > 1 and homed")
    busy = written(busy.select(F.col("anchor").alias("at"), F.ceil(F.col("n") / TILE).cast("long").alias("cuts")), "anchors")
    met = near.join(busy, F.col("anchor") == F.col("at"))
    own = F.pmod(F.xxhash64("fp"), F.col("cuts"))
    dealt = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    tiles = dealt.select("anchor", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "home")
    sorted_tiles = tiles.repartition(partitions(spark), "anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return sorted_tiles.mapInArrow(_compared(distance), "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, with_root: bool = False) -> DataFrame:
    """(doc_id, fp, component_id) per row: fingerprint, and the smallest id reachable over fingerprints within `distance` bits.

    Equal fingerprints are one node, so copies cost one row. A null or empty
    text has no words: fingerprint zero, linked like any other. Null ids are
    never the smallest unless a group has no other; repeated ids and rows keep
    a row each. An empty table gives no rows; extra columns are ignored.
    With `with_root` there is a column root, the group's smallest fingerprint, which also tells groups without an id apart.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(near_links(classes.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = written(rooted.join(least, "root").select(F.col("fp").alias("of"), "component_id", *["root"] * with_root), "named")
    return rows.join(named, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id", *["root"] * with_root)
