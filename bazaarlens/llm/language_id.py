"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.llm.common import col, written

START = 256  # stands in contexts for the places before a document's first byte
SLICE = 1 << 20  # bytes scored at a time


@dataclass
class PpmModels:
    """Frozen statistics per language: how often byte c followed bytes a, b, as rows of (a, b, c, count)."""

    langs: list[str]
    triples: list[np.ndarray]
    _tables: list[np.ndarray] = field(default_factory=list, repr=False)
    _symbol: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"langs": self.langs, "triples": self.triples, "_tables": [], "_symbol": None}

    def _build(self) -> None:
        """Bits per symbol for each two-symbol context, one table a language.

        Symbols are the bytes seen in training, one symbol for every other byte,
        and the start. A context that was never seen uses the next shorter one.
        """
        seen = np.unique(np.concatenate([t[:, 2] for t in self.triples])) if self.triples else np.zeros(0, dtype=int)
        n = len(seen)  # symbol n: a byte never seen; n + 1: the start
        self._symbol = np.full(257, n, dtype=np.int32)
        self._symbol[seen] = np.arange(n)
        self._symbol[START] = n + 1
        for triples in self.triples:
            a, b, c = (self._symbol[triples[:, k]] for k in range(3))
            count = triples[:, 3].astype(np.float64)
            flat = np.full((1, n + 1), 1 / 256)
            zero = _escaped(np.bincount(c, count, n + 1)[None], flat)
            one = np.repeat(zero, n + 2, axis=0)
            which, at = np.unique(b, return_inverse=True)
            one[which] = _escaped(_sums(at, c, count, len(which), n + 1), one[which])
            two = np.repeat(one[None], n + 2, axis=0).reshape(-1, n + 1)
            which, at = np.unique(a * (n + 2) + b, return_inverse=True)
            two[which] = _escaped(_sums(at, c, count, len(which), n + 1), two[which])
            self._tables.append(-np.log2(two).astype(np.float32))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language's statistics."""
        if self._symbol is None:
            self._build()
        out, k = np.zeros((len(texts), len(self.langs))), 0
        pad = self._symbol[START]
        while k < len(texts):
            last, size = k, 0
            while last < len(texts) and (last == k or size + len(texts[last]) < SLICE):
                size += len(texts[last]) + 2
                last += 1
            out[k:last] = self._slice(texts[k:last], pad)
            k = last
        return out

    def _slice(self, texts: list[bytes], pad: int) -> np.ndarray:
        sizes = np.array([len(t) for t in texts])
        starts = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]]) + 2
        data = self._symbol[np.frombuffer(b"\0\0" + b"\0\0".join(texts), dtype=np.uint8)]
        data[starts - 2] = data[starts - 1] = pad
        out, width = np.zeros((len(texts), len(self.langs))), self._tables[0].shape[1]
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        owner = np.repeat(np.arange(len(texts)), sizes + 2)
        real = np.ones(len(data), dtype=bool)
        real[starts - 2] = real[starts - 1] = False
        at = np.flatnonzero(real)
        place = (data[at - 2] * (width + 1) + data[at - 1]) * width + data[at]
        edges = np.searchsorted(owner[at], full)
        for k, table in enumerate(self._tables):
            out[full, k] = np.add.reduceat(table.ravel()[place].astype(np.float64), edges)
        return out


def _sums(at: np.ndarray, c: np.ndarray, count: np.ndarray, rows: int, width: int) -> np.ndarray:
    return np.bincount(at * width + c, count, rows * width).reshape(rows, width)


def _escaped(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Chances after each context: seen symbols by count, the rest by the escape's share of the shorter context's chances.

    The escape counts as often as there are distinct symbols. Symbols that the
    context has seen are excluded from the shorter one, so that all
    chances of the 256 bytes add to 1.
    """
    seen = counts > 0
    distinct = seen.sum(axis=1, keepdims=True)
    total = counts.sum(axis=1, keepdims=True) + distinct
    rest = np.maximum(1 - (shorter * seen).sum(axis=1, keepdims=True), 1e-12)
    return np.where(seen, counts / total, np.maximum(distinct / total * shorter / rest, 1e-12))


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, a, b, c, n): counted triples of bytes of the whole texts of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                keys = []
                for t in (t for t, of in zip(texts, langs, strict=True) if of == lang and t):
                    x = np.concatenate([[START, START], np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int64)])
                    keys.append(np.unique((x[:-2] * 257 + x[1:-1]) * 257 + x[2:], return_counts=True))
                if keys:
                    key, at = np.unique(np.concatenate([k for k, _ in keys]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([c for _, c in keys])).astype(np.int64)
                    cols = [pa.array([lang] * len(key)), *[pa.array(x.astype(np.int32)) for x in (key // 257 // 257, key // 257 % 257, key % 257)], pa.array(n)]
                    yield pa.RecordBatch.from_arrays(cols, names=["lang", "a", "b", "c", "n"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, a int, b int, c int, n long")
    return found.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 300) -> PpmModels:
    """Models from at most `sample_docs` whole documents of each language, those whose hash of id and text is least.

    Rows without a language or text teach nothing; rows equal in both are one, however many share an id or have none. What comes to the driver is
    the models: at most one count per language and distinct three bytes.
    """
    rows = labelled.select(col(id_col).alias("id"), col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit("sample"), "text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    # dealt by both columns first, so that a language's rows meet in one task only after every task has left but its least
    picked = rows.select("lang", "h").repartition("lang", "h").distinct().withColumn("r", place).where(F.col("r") <= sample_docs)
    last = picked.groupBy("lang").agg(F.max("h").alias("last")).select(F.col("lang").alias("of"), "last")
    # one bound per language, as many as models that come to the driver; rows equal in id and text teach once
    taught = rows.join(F.broadcast(last), (F.col("lang") == F.col("of")) & (F.col("h") <= F.col("last"))).dropDuplicates(["lang", "h"])
    by: dict[str, list] = {}
    for r in _counts(taught).collect():
        by.setdefault(r[0], []).append(r[1:])
    langs = sorted(by, key=lambda x: x.encode())
    return PpmModels(langs, [np.array(sorted(by[x]), dtype=np.int64) for x in langs])


def predict(docs: DataFrame, models: PpmModels, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """lang_pred and score for each row, after the columns of `keep`; the text is the only input, and is sent to a worker once.

    The language whose statistics code the whole text in the fewest bits wins,
    ties to the first by code point; score is its share of the chances of all
    languages (0 to 1). `und` with score 0: a null text, one without
    a letter, or no language learned. Nothing is shuffled; repeated rows are
    scored each on their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ask = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            pred, score = np.full(len(ask), "und", dtype=object), np.zeros(len(ask))
            rows = np.flatnonzero(ask)
            if len(rows) and models.langs:
                bits = models.code_lengths([texts[int(k)].as_py().encode("utf-8", "surrogatepass") for k in rows])
                best = bits.argmin(axis=1)
                gap = bits - bits.min(axis=1, keepdims=True)
                pred[rows] = np.array(models.langs, dtype=object)[best]
                score[rows] = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
            others = iter(range(batch.num_columns - 2))
            kept = [texts if c == text_col else batch.column(next(others)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    text = col(text_col).cast("string")
    asked = F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))
    bare = docs.select(*[col(c) for c in keep if c != text_col], text.alias("_text"), asked.alias("_ask"))
    kinds = [f"`{c}` {'string' if c == text_col else docs.schema[c].dataType.simpleString()}" for c in keep]
    return bare.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that nothing is learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """Learns from the documents that are not held out and predicts all of them: id, held_out, lang_pred, score, and `keep`."""
    models = train(docs.where(~held_out(col(id_col))), id_col, text_col, lang_col)
    named = docs.select(col(id_col).alias("doc_id"), held_out(col(id_col)).alias("held_out"), col(text_col).alias("_whole"), *[col(c).alias(f"_k_{c}") for c in keep if c != text_col])
    own = {c: "_whole" if c == text_col else f"_k_{c}" for c in keep}
    out = predict(named, models, "_whole", ("doc_id", "held_out", *own.values()))
    return out.select("doc_id", "held_out", "lang_pred", "score", *[col(own[c]).alias(c) for c in keep])
