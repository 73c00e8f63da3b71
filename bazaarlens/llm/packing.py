"""Packing token sequences: non-negative least squares over length combinations."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import col, ranked, written

# fixed value: how the byte-level vocabulary cuts a text before merging
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """The byte-level vocabulary of a tokenizer file, read on the driver and sent along, as only it need have the file.

    Gives the ids that the tokenizers library gives; its faster sibling does the
    merging, with which the same vocabulary is read by rank. As there,
    `encode_special_tokens` reads the file's added tokens as ordinary text; without
    it each one in a text is its own id.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        self.vocab: dict[str, int] = file["model"]["vocab"]
        self.added: dict[str, int] = {}
        if not encode_special_tokens:
            for token in file.get("added_tokens", []):
                if token["single_word"] or token["lstrip"] or token["rstrip"]:
                    raise ValueError(f"added token {token['content']!r} takes in or asks for what is around it")
                self.added[token["content"]] = token["id"]
        self.coder = None

    def __getstate__(self):
        return {"vocab": self.vocab, "added": self.added, "coder": None}

    def ids(self, text: str | None) -> np.ndarray:
        import tiktoken

        if self.coder is None:
            # printable bytes stand for themselves, the others for the characters from 256 on
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in set(plain)]
            byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
            ranks = {bytes(byte[c] for c in token): k for token, k in self.vocab.items() if all(c in byte for c in token) and token != "<|endoftext|>"}
            self.coder = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        if not self.added:
            return np.array(self.coder.encode_ordinary(text or ""), dtype="<u4")
        ids: list[int] = []
        # the longest of those that begin at one place
        for part in re.split("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")", text or ""):
            ids += [self.added[part]] if part in self.added else self.coder.encode_ordinary(part)
        return np.array(ids, dtype="<u4")


def cut(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of each row, full windows and the rest, the ids with `end` after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, starts, lengths, sums, totals = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(tokenizer.ids(text.as_py()), np.array([end], dtype="<u4"))
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    owner.append(k)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
            ids_of = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_of, *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    bare = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = bare.schema["doc_id"].dataType.simpleString()
    return bare.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of the lengths, repeats allowed, that fill the window; a pair has 0 as its third."""
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    have[window] = False
    found = []
    for a in [0, *sorted(int(x) for x in lengths if x <= window // 3)]:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[have[b] & have[window - a - b]]
        found.append(np.stack([window - a - b, b, np.full(len(b), a)], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=int)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats x of the combinations whose summed lengths come nearest to the histogram.

    Projected gradient with momentum; a column of the matrix has ones at its lengths, so
    products are gathers and counts. Length 0 has no row.
    """
    if not len(combos):
        return np.zeros(0)
    x = y = np.zeros(len(combos))
    bound = 3.0 * np.bincount(combos.ravel())[1:].max()  # of the largest eigenvalue
    goal, t = histogram.astype(float), 1.0
    for _ in range(rounds):
        made = sum(np.bincount(combos[:, k], y, len(goal)) for k in range(3))
        off = made - goal
        off[0] = 0
        new = np.maximum(0, y - off[combos].sum(axis=1) / bound)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


def plan(histogram: dict[int, int], window: int = 1024) -> list[tuple[Counter, int]]:
    """(lengths with their multiplicity, repeats) of every sequence pattern; they use up the histogram exactly.

    Full windows stand alone. The least-squares repeats are rounded, largest
    first, as far as the lengths last. The residue is packed greedily: the
    longest length left, then each time the longest that still fits, and
    the pattern is repeated while its lengths last, so a large residue
    of one length costs one step. The work depends on the window alone.
    """
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns: list[tuple[Counter, int]] = []

    def use(pattern: Counter, most: int) -> None:
        n = min(most, *(int(left[k]) // m for k, m in pattern.items()))
        if n > 0:
            for k, m in pattern.items():
                left[k] -= n * m
            patterns.append((pattern, n))

    if left[window]:
        use(Counter({window: 1}), int(left[window]))
    combos = combinations(np.flatnonzero(left), window)
    x = repeat_counts(combos, left)
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 0.5:
            break
        use(Counter(int(v) for v in combos[k] if v), int(np.rint(x[k])))
    while left.any():
        pattern, space = Counter(), window
        while space:
            fits = np.flatnonzero(left[: space + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = int(min(left[length] - pattern[length], space // length))
            if n <= 0:
                # used up by this pattern: try the next shorter one
                shorter = [int(v) for v in fits if left[v] > pattern[int(v)]]
                if not shorter:
                    break
                length = shorter[-1]
                n = int(min(left[length] - pattern[length], space // length))
            pattern[length] += n
            space -= n * length
        use(pattern, int(left.sum()))
    return patterns


def pack(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end: int = 0) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece of each row.

    Documents are cut into full windows and a rest. Only the counts of the
    lengths (at most `window`) come to the driver, which plans the patterns; each piece's rank
    among those of its length then finds its pattern, sequence and offset in
    the plan, a table whose size depends on the window alone.

    A null or empty text is the end id alone. Repeated rows and ids are packed
    each on their own; wholly equal pieces are interchangeable. An empty table has no pieces.
    """
    spark = docs.sparkSession
    pieces = written(cut(docs, tokenizer, id_col, text_col, window, end), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots, first, upto = [], 0, Counter()
    for pattern, n in plan(histogram, window):
        at = 0
        for length, m in sorted(pattern.items(), reverse=True):
            slots.append((length, upto[length], upto[length] + n * m, first, n, at))
            upto[length] += n * m
            at += length * m
        first += n
    table = spark.createDataFrame(slots, "_length long, _from long, _to long, _first long, _n long, _at long")
    placed = ranked(pieces, ["length", "doc_id", "start"], ["length"], rank="_rank", name="by-length")
    mine = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    turn = F.col("_rank") - F.col("_from")
    return placed.join(F.broadcast(table), mine).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_first") + turn % F.col("_n")).alias("sequence_id"),
        (F.col("_at") + F.floor(turn / F.col("_n")).cast("long") * F.col("length")).alias("offset"),
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end: int = 0, pad: int = 0) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, padded to the window unless their length is a power of two.

    `packed` is what `pack` gave for these documents, whose ids must be distinct.
    A sequence gathers at most `window` ids.
    """
    wanted = packed.groupBy(F.col("doc_id").alias("_of")).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(tokenizer.ids(text), np.array([end], dtype="<u4"))
                rows += [(c["sequence_id"], c["offset"], ids[c["start"] : c["start"] + c["length"]].tolist()) for c in cuts]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    texts = docs.select(col(id_col).alias("_id"), col(text_col).cast("string").alias("text"))
    met = texts.join(wanted, F.col("_id").eqNullSafe(F.col("_of"))).select("text", "cuts")
    parts = met.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    whole = parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    size = F.size("ids")
    filled = F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - size))
    return whole.select("sequence_id", F.when(size.bitwiseAND(size - 1) == 0, F.col("ids")).otherwise(filled).alias("ids"))
