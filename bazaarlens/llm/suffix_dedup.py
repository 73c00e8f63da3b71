"""Repeated byte strings: all suffixes up to a depth, grouped by content anchors and hashes, by runs of neighbouring suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import col, written

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SLICE = 1 << 18  # suffixes cut into runs at a time
BLOCK = 64  # suffixes of a run that the first digit takes together
_LOW = np.uint64((1 << 20) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Strings:
    """Hashes of any substrings of some bytes: prefix sums of a polynomial, brought to a common power."""

    _up = _down = None

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if Strings._up is None or len(Strings._up) < n:
            size = max(n, SLICE + 4096)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            Strings._up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE)]), dtype=np.uint64)
            Strings._down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]), dtype=np.uint64)
            Strings._value = mixed(np.arange(1, 257, dtype=np.uint64))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(Strings._value[data] * Strings._up[: n - 1], out=self.sums[1:])

    def hash(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * Strings._down[start])

    def grams(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length, by start."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * Strings._down[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def runs(strings: Strings, ends: np.ndarray, threshold: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, place, first, last) of the runs of suffixes in documents laid end to end.

    A suffix's anchor is the least hash among the substrings of `gram` bytes
    in its first `threshold` bytes, with its distance from the start: equal
    for all suffixes that agree on those bytes. Neighbouring suffixes mostly share
    it, and make a run. Suffixes shorter than the threshold have none.
    """
    width = threshold - gram + 1
    grams = strings.grams(gram)
    if len(grams) < width:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    least = sliding_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), width)
    place = (least & _LOW).astype(np.int64)
    start = np.arange(len(place))
    end = ends[np.searchsorted(ends, start, side="right")]
    good = start + threshold <= end
    # a run also ends where a document does: the suffixes between are not good
    edge = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (good[1:] != good[:-1])]))
    last = np.concatenate([edge[1:] - 1, [len(place) - 1]])
    kept = good[edge]
    first, last = edge[kept], last[kept]
    return grams[place[first]].view(np.int64), place[first], first, last


def blocks(data: np.ndarray, ends: np.ndarray, threshold: int, gram: int) -> tuple[np.ndarray, ...]:
    """(digit, whole, first, last) of the blocks that runs are cut into, by distance from the anchor, `BLOCK` suffixes to a full one.

    `digit` is a hash of the anchor, the distance, and the bytes that all suffixes of a full block
    share, `whole` one of all bytes of the block as it is, with its place.
    """
    strings = Strings(data)
    anchor, place, first, last = runs(strings, ends, threshold, gram)
    near, far = (place - last) // BLOCK, (place - first) // BLOCK
    n = far - near + 1
    run = np.repeat(np.arange(len(n)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[run]
    top = place[run] - BLOCK * number  # the block's last possible suffix
    a, b = np.maximum(first[run], top - BLOCK + 1), np.minimum(last[run], top)
    core = strings.hash(top, threshold - BLOCK + 1) + mixed(number.view(np.uint64))
    whole = strings.hash(a, b - a + threshold) + mixed(((top - a) * 1000 + (top - b)).view(np.uint64))
    digit = mixed(core + BASE * anchor[run].view(np.uint64))
    return digit.view(np.int64), whole.view(np.int64), a, b


def _slices(batch: pa.RecordBatch, at: int, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, row, offset in the row's text): documents laid end to end up to a size, long ones in overlapping parts."""
    parts, rows, offsets, size = [], [], [], 0
    for k, value in enumerate(batch.column(at)):
        text = np.frombuffer(value.as_buffer(), dtype=np.uint8) if value.is_valid and value.as_buffer() is not None else np.zeros(0, dtype=np.uint8)
        for start in range(0, max(1, len(text) - threshold + 1), SLICE):
            part = text[start : start + SLICE + threshold - 1]
            if len(part) < threshold:
                continue
            if size and size + len(part) > SLICE:
                yield np.concatenate(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(offsets)
                parts, rows, offsets, size = [], [], [], 0
            parts.append(part)
            rows.append(k)
            offsets.append(start)
            size += len(part)
    if parts:
        yield np.concatenate(parts), np.cumsum([len(p) for p in parts]), np.array(rows), np.array(offsets)


def _first_pass(docs: DataFrame, threshold: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, ends, rows, offsets in _slices(batch, 2, threshold):
                digit, whole, first, last = blocks(data, ends, threshold, gram)
                owner = np.searchsorted(ends, first, side="right")
                shift = offsets[owner] - np.concatenate([[0], ends[:-1]])[owner]
                at = pa.array(rows[owner])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(digit), pa.array(whole), *[pa.array((x + shift).astype(np.int32)) for x in (first, last)]],
                    names=["id", "tk", "digit", "whole", "first", "last"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {kind}, tk long, digit long, whole long, first int, last int")


def _listed(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(row, its list's columns as arrays) for a column `list` of structs."""
    lists = batch.column(batch.num_columns - 1)
    flat, edges = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    cols = [flat.field(n).to_numpy(zero_copy_only=False) for n in names]
    for k in range(batch.num_rows):
        yield k, [c[edges[k] : edges[k + 1]] for c in cols]


def _bytes(batch: pa.RecordBatch, at: int, row: int) -> np.ndarray:
    return np.frombuffer(batch.column(at)[row].as_buffer(), dtype=np.uint8)


def _parts(data: np.ndarray, first: np.ndarray, last: np.ndarray, tail: int) -> Iterator[tuple[int, np.ndarray, Strings]]:
    """(shift, which, hashes): a long text in parts, each with what starts in it and room after that."""
    step = SLICE
    if len(data) <= 2 * step:
        yield 0, np.arange(len(first)), Strings(data)
        return
    for begin in range(0, len(data), step):
        which = np.flatnonzero((first >= begin) & (first < begin + step))
        if len(which):
            yield begin, which, Strings(data[begin : int(last[which].max()) + tail])


def _last_pass(met: DataFrame, threshold: int) -> DataFrame:
    """Blocks opened into suffixes: (id, tk, digit, string, at, alone); `string` is the last digit, all bytes up to the threshold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (digit, first, last, alone) in _listed(batch, ["digit", "first", "last", "alone"]):
                data = _bytes(batch, 2, k)
                for low, which, strings in _parts(data, first, last, threshold):
                    n = last[which] - first[which] + 1
                    block = np.repeat(which, n)
                    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[block]
                    owner = pa.array(np.full(len(at), k))
                    string = strings.hash(at - low, threshold).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(digit[block]), pa.array(string), pa.array(at), pa.array(alone[block])],
                        names=["id", "tk", "digit", "string", "at", "alone"],
                    )

    kind = met.schema["id"].dataType.simpleString()
    return met.mapInArrow(work, f"id {kind}, tk long, digit long, string long, at long, alone boolean")


def _with_text(docs: DataFrame, items: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """id, tk, text and the array `list` of a document's items; a document's items are no more than its bytes."""
    lists = items.groupBy(F.col("id").alias("_id"), F.col("tk").alias("_tk")).agg(F.collect_set(F.struct(*names)).alias("list"))
    return docs.join(lists, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk")), how).select("id", "tk", "text", "list")


def repeated_spans(docs: DataFrame, threshold: int = 400, gram: int = 128) -> DataFrame:
    """(id, tk, first, last): suffixes first to last of a document whose first `threshold` bytes start somewhere else, too. See `dedup`."""
    found = written(_first_pass(docs, threshold, gram), "blocks")
    groups = found.groupBy("digit").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")).where("n > 1")
    groups = written(groups.select(F.col("digit").alias("_d"), (F.col("a") == F.col("b")).alias("same")), "groups")
    met = written(found.join(groups, F.col("digit") == F.col("_d")).drop("_d"), "met")
    spans = met.where("same").select("id", "tk", "first", "last")

    # blocks that differ beyond the digit: equal ones are classes, one of each is opened
    mixed_up = met.where("not same")
    kinds = mixed_up.groupBy("digit", "whole").agg(F.count("*").alias("n"), F.min(F.struct("id", "tk", "first", "last")).alias("one"))
    kinds = written(kinds, "kinds")
    many = written(kinds.where("n > 1").select(F.col("digit").alias("_d"), F.col("whole").alias("_w")), "many")
    spans = spans.unionByName(mixed_up.join(many, (F.col("digit") == F.col("_d")) & (F.col("whole") == F.col("_w"))).select("id", "tk", "first", "last"))
    opened = kinds.select("one.*", "digit", (F.col("n") == 1).alias("alone"))
    suffixes = written(_last_pass(_with_text(docs, opened, ["digit", "first", "last", "alone"]), threshold), "suffixes")
    ends = suffixes.groupBy("digit", "string").count().where("count > 1")
    ends = written(ends.select(F.col("digit").alias("_d"), F.col("string").alias("_s")), "ends")
    alone = suffixes.where("alone").join(ends, (F.col("digit") == F.col("_d")) & (F.col("string") == F.col("_s")))
    return spans.unionByName(alone.select("id", "tk", F.col("at").cast("int").alias("first"), F.col("at").cast("int").alias("last")))


def _cut(threshold: int, kept_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, sums, texts, starts, stops = [], [], [], [], [], [], []
            spans = [x for _, x in _listed(batch, ["first", "last"])]
            for k, (first, last) in enumerate(spans):
                value = batch.column(2)[k]
                data = (value.as_buffer() if value.is_valid else None) or b""
                data = memoryview(data)
                order = np.argsort(first, kind="stable")
                a, b = first[order], np.maximum.accumulate(last[order] + threshold) if len(order) else last
                fresh = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]])) if len(a) else np.zeros(0, dtype=int)
                begins = a[fresh]
                ends = b[np.concatenate([fresh[1:] - 1, [len(a) - 1]])] if len(a) else begins
                digest, at, pieces = hashlib.sha256(), 0, []
                for x, y in [*zip(begins.tolist(), ends.tolist(), strict=True), (len(data), len(data))]:
                    digest.update(data[at:x])
                    if kept_text:
                        pieces.append(bytes(data[at:x]))
                    at = y
                sizes.append(len(data))
                removed.append(int((ends - begins).sum()))
                counts.append(len(begins))
                sums.append(digest.hexdigest())
                if kept_text:
                    texts.append(b"".join(pieces))
                    starts.append(begins.tolist())
                    stops.append(ends.tolist())
            cols = [batch.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, counts)], pa.array(sums, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if kept_text:
                cols += [pa.array(texts, pa.binary()), pa.array(starts, pa.list_(pa.int64())), pa.array(stops, pa.list_(pa.int64()))]
                names += ["kept", "starts", "ends"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return work


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 400, gram: int = 128, kept_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row, after cutting every byte of a string of `threshold` bytes that also starts anywhere else.

    The suffixes of all texts (UTF-8, never across documents) are grouped up to the threshold in two
    passes, by hashes. They aren't sorted: that would move the threshold's bytes for each byte of
    text. Equal hashes count as equal bytes, without a look at the bytes. The first digit (what a pass groups by) is taken for up to 64 neighbouring
    suffixes at a time, a block: the least substring hash within the threshold and its distance (`runs`), and the 337 bytes that
    the block's suffixes share (`blocks`). Blocks alone with their digit are unique and drop out,
    and blocks equal in all bytes are repeated as a whole. What is left lies at the ends of
    repeated passages: one block of each kind is opened, and the last
    digit, all bytes up to the threshold, decides each suffix. Groups are
    told by counts, joined back from written tables; no group is
    gathered in one task, no pairs are made, and nothing is capped.

    Null text: empty. Rows are told apart by id and text, so repeated ids are no
    trouble; wholly repeated rows repeat each other's strings. `kept_text` adds the
    remaining bytes and the spans (starts, ends).
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"))
    spans = repeated_spans(rows, threshold, gram)
    met = _with_text(rows, spans, ["first", "last"], "left").withColumn("list", F.coalesce("list", F.expr("cast(array() as array<struct<first:int,last:int>>)")))
    schema = f"doc_id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return met.mapInArrow(_cut(threshold, kept_text), schema + ", kept binary, starts array<long>, ends array<long>" * kept_text)
