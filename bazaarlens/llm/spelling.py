"""Spelling variants: words one edit apart, found by pivotal bigrams against bigram prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import col, written
from bazaarlens.llm.suffix_dedup import BASE, mixed

# fixed values: the characters of a word; with capitals lower-cased, 90 kinds, so at most 8,100 bigrams
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 3  # rarest bigrams that, with one edit, must hold a common one: two disjoint ones are always among them
CELLS = 1 << 20  # letters taken together
BLOCK = 1024  # words of one key that meet a probe in one place
HEAD = 6  # letters that a key has at least, as far as the word allows
LONG = 64  # letters beyond which a word is told by a digest until it is verified
SHARE, HOTTEST = 16, 65_536  # one word in so many is counted to find keys that many words share, and the most of those that are split


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, occurrences: int = 2, slip: int | None = 31) -> DataFrame:
    """(word, n) of the maximal runs of letters of whole texts, capitals A-Z lower-cased.

    With `slip`, a run whose crc32 with its document's id that number divides has lost the code point
    that the crc32 chooses. Shorter results and rarer words are left out.
    """
    runs = docs.select(col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(col(text_col), F.lit(f"{LETTERS}{{{least},}}+"), F.lit(0))).alias("run"))
    words = runs.select(F.coalesce("id", F.lit("")).alias("id"), F.translate("run", UPPER, LOWER).alias("word"))
    if slip:
        coded = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2, F.length("word")))
        words = coded.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("word")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their letters as a matrix of code points) for each length, at most `CELLS` letters or one word at a time."""
    coded = [w.encode("latin-1") for w in column.to_pylist()]
    sizes = np.array([len(w) for w in coded])
    for size in np.unique(sizes).tolist():
        rows, most = np.flatnonzero(sizes == size), max(1, CELLS // size)
        for at in range(0, len(rows), most):
            some = rows[at : at + most]
            yield some, np.frombuffer(b"".join(coded[k] for k in some), dtype=np.uint8).reshape(len(some), size)


def _grams(letters: np.ndarray) -> np.ndarray:
    return letters[:, :-1].astype(np.int64) * 256 + letters[:, 1:]


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each bigram occurs in the distinct words, by its two code points. At most 8,100 counts come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                total += np.bincount(_grams(letters).ravel(), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    counts = np.zeros(1 << 16, dtype=np.int64)
    for r in words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r[0]] = r[1]
    return counts


def pivots(cost: np.ndarray) -> np.ndarray:
    """Places of the two bigrams of each row that do not overlap and cost least in sum, by dynamic programming over places."""
    n, width = cost.shape
    rows = np.arange(n)
    one, one_at = np.full(n, np.inf), np.zeros(n, dtype=np.int64)  # the cheapest bigram that ends two places back
    two, two_at = np.full(n, np.inf), np.zeros((n, 2), dtype=np.int64)
    for i in range(2, width):
        better = cost[:, i - 2] < one
        one, one_at = np.where(better, cost[:, i - 2], one), np.where(better, i - 2, one_at)
        total = one + cost[rows, i]
        better = total < two
        two = np.where(better, total, two)
        two_at[better, 0], two_at[better, 1] = one_at[better], i
    return two_at


def _tail(size: int) -> int:
    """Letters at the end that a key of a word of `size` letters can name: a power of two, at most size - `HEAD`."""
    return 0 if size <= HEAD else 1 << ((size - HEAD).bit_length() - 1)


def _sums(letters: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... letters of each word."""
    out = np.zeros((letters.shape[0], letters.shape[1] + 1), dtype=np.uint64)
    np.cumsum((letters + np.uint64(1)) * np.cumprod(np.full(letters.shape[1], BASE), dtype=np.uint64), axis=1, out=out[:, 1:])
    return out


def _keys(letters: np.ndarray, row: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows again with the keys of each bigram at `place`: hashes of letters that a near word has, too.

    A single edit that spares a bigram lies on one side of it. Say on its right (the other side is the
    same, read backwards): all up to the bigram's end is equal, and the bigram as far from the
    start, which limits its position. If those are fewer than `HEAD` letters, the edit lies
    either behind the first `HEAD`, which are then equal, or before, and then the last size - `HEAD` are. Sizes differ by one at
    most, so a key names the last `_tail(size)`, and also `_tail(size - 1)` for the shorter word's sake.
    """
    size = letters.shape[1]
    ahead, back = _sums(letters), _sums(letters[:, ::-1])
    tails = {_tail(size)} | ({_tail(size - 1)} if size > least else set())
    rows, keys = [], []

    def add(mark: int, row: np.ndarray, at: np.ndarray, head: np.ndarray | int, tail: int, first: np.ndarray, last: np.ndarray) -> None:
        marks = (at.astype(np.uint64) << np.uint64(32)) + np.uint64(mark + 4 * tail)
        rows.append(row)
        keys.append(mixed(mixed(first[row, head] + marks) + last[row, tail]))

    for side, (at, first, last) in enumerate(((place, ahead, back), (size - 2 - place, back, ahead))):
        far = at + 2 >= HEAD
        add(side, row[far], at[far], at[far] + 2, 0, first, last)
        if size >= HEAD:
            add(side, row[~far], at[~far], HEAD, 0, first, last)
        for tail in tails:
            add(side + 2, row[~far], at[~far], at[~far] + 2, tail, first, last)
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def _signatures(words: DataFrame, counts: np.ndarray, probe: bool, least: int) -> DataFrame:
    """(key, last, name): the keys of a word's two pivots (`probe`) or of its prefix of rarest bigrams; last is the rank of the prefix's end."""
    order = np.lexsort((np.arange(len(counts)), counts))
    rank = np.empty(len(counts), dtype=np.int64)
    rank[order] = np.arange(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, letters in _by_length(batch.column(0)):
                grams = _grams(letters)
                ranks = rank[grams]
                last = np.partition(ranks, PREFIX - 1, axis=1)[:, PREFIX - 1]
                inside = ranks <= last[:, None]  # with all places of the bigram that ends it
                if probe:
                    place = pivots(np.where(inside, counts[grams], np.inf))
                    row, place = np.repeat(np.arange(len(rows)), 2), place.ravel()
                else:
                    row, place = np.nonzero(inside)
                row, keys = _keys(letters, row, place, least)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(last[row].astype(np.int32)), batch.column(1).take(pa.array(rows[row]))], names=["key", "last", "name"])

    return words.select("word", "name").mapInArrow(run, "key long, last int, name string")


def near_words(words: DataFrame, least: int = 7) -> DataFrame:
    """(word, other): the pairs of words that differ by exactly one inserted, deleted or replaced code point, smaller word first.

    Bigrams are ordered by how many words have them, rarest first. One edit spoils one of two disjoint
    bigrams at most, so of two near words the one whose prefix of three rarest bigrams ends earlier has a pivot in
    the other's prefix. Pivots probe the index of prefixes by key (`_keys`), and what meets is verified by its edit distance.
    A key that many words share is cut into blocks, which its probes visit all; such keys are told from
    a share of the words, and how they are cut changes no pair. `words`: distinct words of at least `least` letters, 4 or more.
    """
    counts = gram_counts(words)
    words = words.select("word", F.when(F.length("word") > LONG, F.concat(F.lit("#"), F.sha2(F.col("word").cast("binary"), 256))).otherwise(F.col("word")).alias("name"))
    index, probes = _signatures(words, counts, False, least), _signatures(words, counts, True, least)
    some = _signatures(words.where(F.pmod(F.xxhash64("word"), F.lit(SHARE)) == 0), counts, False, least)
    hot = some.groupBy("key").agg(F.ceil(F.count("*") * SHARE / BLOCK).cast("long").alias("blocks")).where("blocks > 1")
    hot = written(hot.orderBy(F.desc("blocks"), "key").limit(HOTTEST).withColumnRenamed("key", "of"), "hot")
    # at most `HOTTEST` short rows
    cut = lambda rows: rows.join(F.broadcast(hot), F.col("key") == F.col("of"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    index = cut(index).select("key", F.pmod(F.xxhash64("name"), F.col("blocks")).alias("block"), "last", "name")
    probes = cut(probes).select(F.col("key").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"), F.col("last").alias("end"), F.col("name").alias("probe"))
    met = index.join(probes.hint("merge"), (F.col("key") == F.col("k")) & (F.col("block") == F.col("b")) & (F.col("end") <= F.col("last")) & (F.col("name") != F.col("probe")))
    long = F.col("name").startswith("#") | F.col("probe").startswith("#")
    met = met.where(long | ((F.abs(F.length("name") - F.length("probe")) <= 1) & (F.levenshtein("name", "probe", 1) == 1)))
    met = written(met.select(F.least("name", "probe").alias("name"), F.greatest("name", "probe").alias("probe")).distinct(), "met")
    # digests are verified as the words they stand for
    told = words.where(F.length("word") > LONG).select(F.col("name").alias("of"), F.col("word").alias("whole"))
    pairs = met.where(long)
    for c in ("name", "probe"):
        pairs = pairs.join(told, F.col(c) == F.col("of"), "left").withColumn(c, F.coalesce("whole", c)).drop("of", "whole")
    pairs = met.where(~long).unionByName(pairs.where(F.levenshtein("name", "probe", 1) == 1))
    return pairs.select(F.least("name", "probe").alias("word"), F.greatest("name", "probe").alias("other"))


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of `forms` (word, form), which has no circles.

    Every round doubles the steps taken, so a chain of k forms takes log2(k) rounds.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = roots.select(F.col("word").alias("of"), F.col("root").alias("next"))
        steps = written(roots.join(on, F.col("root") == F.col("of"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        roots = steps.select("word", "root")
        if not steps.where("moved").head(1):
            return roots


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, occurrences: int = 2, ratio: int = 10, slip: int | None = 31
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the whole texts; see `word_counts` and `near_words`.

    A word's form is its near word of largest n, ties to the smallest in code-point order, if that
    is at least `ratio` (over 1) times its own n; its root is the last form reached by following forms, or itself.
    Null texts have no words, a null id counts as empty text; repeated rows count each. No words: no rows.
    """
    words = written(word_counts(docs, id_col, text_col, max(least, 4), occurrences, slip), "words")
    pairs = written(near_words(words, max(least, 4)), "near")
    both = pairs.select("word", F.col("other").alias("near")).unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("near")))
    both = both.join(words.select(F.col("word").alias("of"), F.col("n").alias("near_n")), F.col("near") == F.col("of"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    taken = -F.col("best.less") >= F.col("n") * ratio
    found = words.join(best.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left").select(
        "word", F.when(taken, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, -F.col("best.less")).alias("form_n")
    )
    found = written(found, "variants")
    roots = followed(found.where("form is not null")).select(F.col("word").alias("of"), "root")
    return found.join(roots, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
