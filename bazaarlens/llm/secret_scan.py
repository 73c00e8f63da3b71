"""Secret scan: fixed patterns, and random-looking strings by two character Markov models. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlens.llm.common import col

# fixed values: the kinds of the contract in their order, their patterns, and the length their decisive part needs
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]+", 32),
)
# the characters the models know, and what they read: long runs of them with a digit
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# words that programs' names are made of, for the ordinary samples
NAME_WORDS = (
    "get set user token cache value name list index file path load read write handler manager service config test error request response client server data model view state event action type node tree map key "
    "query result table column field source target input output stream buffer thread process task queue worker job status code message format parse build create update delete remove insert find search filter sort "
    "group count total size length width height start end first last next previous current default global local public private static final abstract base main module package library version release update package "
    "account address customer order product price payment invoice report summary detail image audio video text string number integer boolean array object class method function argument parameter return"
).split()
NAME_TRIPLES = 12_000
SPANS = "array<struct<start:int,k:int,end:int,kind:string>>"


def _none() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


def spans_of(text: Column, pattern: str, kind: str, k: int, worthy) -> Column:
    """Array of (start, k, end, kind) of the leftmost non-overlapping matches that are `worthy`, in code points.

    The texts between the matches come from split, the matches from
    extract_all, and the places from their running lengths.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.coalesce(F.length(p["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(k).alias("k"), end.alias("end"), F.lit(kind).alias("kind"))
        found = F.when(p["hit"].isNotNull() & worthy(p["hit"]), F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    zero = F.struct(F.lit(0).alias("at"), _none().alias("found"))
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(pairs, zero, step, lambda acc: acc["found"])).otherwise(_none())


def base_spans(text: Column, kind: str) -> Column:
    """The contract's spans of one kind.

    Runs of `access` and `hex` below the needed length are left out by the
    pattern itself: a run is matched from its first possible start to its end
    either way. A short `assign` match still uses up its text, as written.
    """
    k, (_, pattern, least) = next((k, p) for k, p in enumerate(PATTERNS) if p[0] == kind)
    if kind == "assign":
        return spans_of(text, pattern, kind, k, lambda m: F.length(F.regexp_extract(m, pattern, 2)) >= least)
    least -= 4 * (kind == "access")
    return spans_of(text, f"{pattern[:-1]}{{{least},}}", kind, k, lambda m: F.lit(True))


@dataclass(frozen=True)
class MarkovModels:
    """Two first-order models of characters, as log-likelihood ratios (random over ordinary, in bits) of each pair."""

    ratios: tuple[float, ...]  # by first character, then second, in ALPHABET order
    threshold: float = 0.5  # bits a pair over which a string counts as random

    def score(self, s: Column) -> Column:
        """Mean ratio over the pairs of `s`; above 0, a random string is the likelier source."""
        n = len(ALPHABET)
        table = F.array(*[F.lit(float(x)) for x in self.ratios])
        at = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1)
        pairs = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: a * n + b + 1)
        return F.aggregate(pairs, F.lit(0.0), lambda a, i: a + F.element_at(table, i)) / F.greatest(F.lit(1), F.size(at) - 1)


def _pair_counts(strings: DataFrame) -> dict[str, int]:
    """Counts of the character pairs of column `s`; at most the square of the alphabet comes to the driver."""
    chars = F.filter(F.split(F.col("s"), ""), lambda c: c != "")
    pairs = strings.select(chars.alias("c")).where(F.size("c") > 1).select(
        F.explode(F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: F.concat(a, b))).alias("pair")
    )
    return {r[0]: r[1] for r in pairs.groupBy("pair").count().collect()}


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 2000, generated: int = 20_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(random, ordinary, unseen) strings, each a column `s`: the first two to train on, the last ordinary ones of words that the others lack.

    Random: `generated` strings in hexadecimal, base 64 and capitals from a
    hash of a counter, with and without digits, and as codes with dashes. Ordinary: identifiers as programs write them, built from
    words that are common in them and from those of at most `sample_docs` documents (whose id's hash
    is least): plain, capitalised, joined by _, - and /, with small numbers
    and years. Words inside a base match, or that mix in digits, aren't taken.
    """
    spark = docs.sparkSession
    n = F.col("id")
    code = F.sha2(F.concat(F.lit("sample"), n.cast("string")), 256)
    coded = F.regexp_replace(F.base64(F.unhex(code)), "=+$", "")
    random = spark.range(generated).select(
        F.when(n % 5 == 0, code).when(n % 5 == 1, coded).when(n % 5 == 2, F.regexp_replace(F.upper(coded), "[+/]", "7"))
        .when(n % 5 == 3, F.regexp_replace(coded, "[^A-Za-z]", "")).otherwise(F.regexp_replace(F.substring(code, 1, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")).alias("s")
    )
    rows = docs.select(col(id_col).alias("i"), col(text_col).alias("t")).where("t is not null").withColumn("h", F.xxhash64(F.col("i").cast("string")))
    last = rows.select("h").orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    chosen = rows.where(F.col("h") <= F.lit(last).cast("long"))  # repeated ids share a hash and come along
    clean = F.regexp_replace(F.col("t"), PATTERNS[0][1], " ")
    words = F.filter(F.split(clean, "[^A-Za-z0-9]+"), lambda w: F.rlike(w, F.lit("^[A-Za-z]{2,}$")))
    some = chosen.select(words.alias("w")).where(F.size("w") > 2)
    triples = F.transform(
        F.sequence(F.lit(1), F.size("w") - 2, F.lit(3)),
        lambda i: F.struct(F.element_at("w", i).alias("a"), F.element_at("w", i + 1).alias("b"), F.element_at("w", i + 2).alias("c"), i.alias("i")),
    )
    part = some.select(F.explode(triples).alias("x")).select("x.*").unionByName(_named(spark, NAME_WORDS[: -len(NAME_WORDS) // 5]))
    return random, _forms(part), _forms(_named(spark, NAME_WORDS[-len(NAME_WORDS) // 5 :]))


def _named(spark: SparkSession, words: list[str]) -> DataFrame:
    """(a, b, c, i): triples of the given words."""
    names, pick = F.array(*[F.lit(w) for w in words]), lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(words)))
    return spark.range(NAME_TRIPLES).select(*[F.get(names, pick(k)).alias(c) for k, c in enumerate("abc")], F.col("id").cast("int").alias("i"))


def _forms(part: DataFrame) -> DataFrame:
    """Names as programs write them, of the words a, b and c."""
    year = (F.lit(1990) + F.col("i") % 40).cast("string")
    small = (F.col("i") % 100).cast("string")
    forms = F.array(
        F.concat_ws("_", F.lower("a"), F.lower("b"), F.lower("c")), F.concat(F.lower("a"), F.initcap("b"), F.initcap("c"), small),
        F.concat_ws("-", F.lower("a"), F.lower("b"), year), F.concat_ws("/", F.lit(""), F.lower("a"), F.lower("b"), F.lower("c")),
        F.concat_ws("_", F.upper("a"), F.upper("b"), small), F.concat_ws("_", F.upper("c"), F.upper("a"), F.upper("b")), F.concat_ws("-", year, F.format_string("%02d", F.col("i") % 12 + 1), F.format_string("%02d", F.col("i") % 28 + 1)),
        F.concat(F.initcap("a"), F.initcap("b"), F.initcap("c"), small), F.concat(F.initcap("a"), F.initcap("b"), F.initcap("c")), F.concat(F.lower("a"), F.lower("b"), F.lower("c")),
        F.concat_ws("/", F.lower("a"), F.concat_ws("_", F.lower("b"), F.lower("c")), F.concat(F.initcap("a"), F.initcap("b"))), F.concat_ws("/", F.lower("c"), F.concat_ws("-", F.lower("a"), F.lower("b"), small)),
        F.concat(F.lit("="), F.lower("a"), F.lit("="), small), F.concat(F.repeat(F.substr(F.lit("=-_+"), F.col("i") % 4 + 1, F.lit(1)), F.lit(24)), F.lower("a")), F.concat(F.lower("a"), year, F.format_string("%02d%02d", F.col("i") % 12 + 1, F.col("i") % 28 + 1), F.lower("b")),
    )
    return part.select(F.explode(forms).alias("s"))


def train(random: DataFrame, ordinary: DataFrame, smoothing: float = 5.0) -> MarkovModels:
    """Both models from labelled strings (column `s`): smoothed chances of the second character after the first."""
    n, tables = len(ALPHABET), []
    for strings in (random, ordinary):
        counts = _pair_counts(strings)
        table = []
        for a in ALPHABET:
            row = [counts.get(a + b, 0) + smoothing for b in ALPHABET]
            total = sum(row)
            table += [math.log2(x / total) for x in row]
        tables.append(table)
    return MarkovModels(tuple(round(x - y, 4) for x, y in zip(*tables, strict=True)) if n else ())


def chosen(models: MarkovModels, unseen: DataFrame, alarms: float = 0.002) -> MarkovModels:
    """The models with the threshold that the share `alarms` of ordinary strings, of words they weren't trained on, lies over; 0.1 at least."""
    long = unseen.where(F.rlike("s", F.lit(f"^{CANDIDATE}$"))).select(models.score(F.col("s")).alias("score"))
    return MarkovModels(models.ratios, max(0.1, round(long.agg(F.percentile("score", 1 - alarms)).first()[0], 3)))


def scan(docs: DataFrame, models: MarkovModels, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Secrets of every whole text: id, n_assign, n_access, n_hex, n_markov, found (array of start, k, end, kind), and the columns of `keep`.

    Base spans are the contract's patterns. The models add runs of 20 or more
    key characters that hold a letter, lie in no base span and
    score over `threshold` bits a pair, the models' own if none is given. Places are code points, the end
    exclusive, ordered by start, then kind. A null text is read as empty: no
    spans. Repeated rows are scanned each on their own; nothing is shuffled.
    """
    bare = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("_t"), *[col(c) for c in keep])
    based = bare.select("*", *[base_spans(F.col("_t"), kind).alias(f"_{kind}") for kind, _, _ in PATTERNS])
    based = based.withColumn("_base", F.concat(*[F.col(f"_{kind}") for kind, _, _ in PATTERNS]))
    least = models.threshold if threshold is None else threshold
    added = spans_of(F.col("_t"), CANDIDATE, "markov", len(PATTERNS), lambda m: F.when(F.rlike(m, F.lit("[A-Za-z]")), models.score(m) > least).otherwise(F.lit(False)))
    outside = F.filter(F.col("_added"), lambda s: ~F.exists(F.col("_base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    based = based.withColumn("_added", added).withColumn("_markov", outside)
    return based.select(
        "doc_id", *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex", "markov")],
        F.array_sort("_base").alias("base"), F.array_sort(F.concat("_base", "_markov")).alias("found"), *[col(c) for c in keep],
    )


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """`text` with each span, overlapping ones as one, replaced by `mark`; a null text stays null."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.when(fresh, F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    rest = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.lit(2147483647))))
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(rest)


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> MarkovModels:
    """Models from the labelled samples of these documents, and their threshold from names of words that aren't among them; without documents, from names alone."""
    random, ordinary, unseen = labelled_samples(docs, id_col, text_col)
    return chosen(train(random, ordinary), unseen)
