"""The registered queries of the operators: whole tables in, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.suffix_dedup import dedup

    return dedup(table(spark, folder, "documents"), threshold=400)


def op2_ann_forest(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.ann_forest import search

    return search(table(spark, folder, "embeddings"))


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.packing import Tokenizer, pack

    return pack(table(spark, folder, "documents"), Tokenizer(tokenizer_path(), encode_special_tokens=False))


def op5_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.simhash import simhash_groups

    found = simhash_groups(table(spark, folder, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.mixing import mix

    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.sharding import hilbert_shards

    return hilbert_shards(table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.secret_scan import joined, scan, trained

    docs = table(spark, folder, "documents")
    found = scan(docs, trained(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), "n_markov",
    )


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.html_text import extract

    return extract(table(spark, folder, "pages"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.language_id import identify

    return identify(table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.vector_codes import compress

    return compress(table(spark, folder, "embeddings"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.license_scan import scan

    return scan(table(spark, folder, "documents")).drop("spans")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from bazaarlens.llm.spelling import variants

    return variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_ann_forest, op3_embedding_dedup, op4_pack, op5_simhash_groups, op6_mix, op7_hilbert_shards, op8_secret_scan, op9_html_text, op10_language_id,
    op11_vector_codes, op12_license_scan, op13_spelling_variants,
)}



def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The rounds written out one after the other; vectors of one length."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT q.r, q.p, any_value(q.v) AS v, min(row(list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.e)) AS best
 FROM cut q JOIN c{k} c ON c.p = q.p GROUP BY q.r, q.p)""")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT p, best[2] AS e, j, sum(v[j]) AS total, count(*) AS n FROM a{k}, range(1, 1 + (SELECT max(len(v)) FROM cut)) t(j) GROUP BY ALL),
m{k} AS (SELECT p, e, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{k} GROUP BY p, e),
c{k + 1} AS (SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.e = c.e)""")
    return f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS w
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
cut AS (SELECT r, p, list_slice(w, p * (len(w) // {parts}) + 1, (p + 1) * (len(w) // {parts})) AS v FROM kept, range({parts}) t(p)),
c0 AS (SELECT p, r - 1 AS e, v FROM cut WHERE r <= {entries}),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS sha FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM books) AS codebooks_sha256 FROM kept JOIN coded USING (r)"""


def _license_sql() -> str:
    from bazaarlens.llm import license_scan as L

    found = L.templates()
    facts = ", ".join(f"({k}, '{t.label}', {t.base}, {len(t.words)}, {t.gap}, {t.least})" for k, t in enumerate(found))
    grams = ", ".join(f"({k}, {at}, '{' '.join(t.words[at : at + L.K])}')" for k, t in enumerate(found) for at in range(len(t.words) - L.K + 1))
    return f"""
WITH facts(template, label, base, size, gap, least) AS (VALUES {facts}), table_grams(template, place, gram) AS (VALUES {grams}),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{L.WORD}') AS words FROM documents),
rolled AS (SELECT r, pos, array_to_string(list_slice(words, pos + 1, pos + {L.K}), ' ') AS gram FROM docs, unnest(range(0, len(words) - {L.K - 1})) t(pos)),
voted AS (SELECT r, template, pos - place AS diagonal, list(DISTINCT place) AS places FROM rolled JOIN table_grams USING (gram) GROUP BY ALL),
stepped AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= gap THEN 0 ELSE 1 END AS fresh FROM voted JOIN facts USING (template)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS island FROM stepped),
merged AS (SELECT r, template, label, base, size, least, list_distinct(flatten(list(places))) AS places, min(diagonal + list_min(places)) AS start, max(diagonal + list_max(places)) + {L.K} AS stop
 FROM numbered GROUP BY r, template, island, label, base, size, least),
scored AS (SELECT *, len(list_distinct(flatten(list_transform(places, lambda p: range(p, p + {L.K}))))) / greatest(size, stop - start) AS similarity FROM merged),
held AS (SELECT *, CASE WHEN base OR coalesce(start >= max(stop) OVER (PARTITION BY r, base ORDER BY start, stop, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS fresh
 FROM scored WHERE similarity >= least),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY r, base ORDER BY start, stop, template ROWS UNBOUNDED PRECEDING) AS run FROM held),
kept AS (SELECT * FROM (SELECT *, max(similarity) OVER (PARTITION BY r, base, run) AS best FROM runs) WHERE similarity = best),
per AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
 array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(similarity) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN per USING (r)"""


# Only op3, op11 and op12 have an SQL form: the others need 64-bit XXH64 or CRC-32, byte windows of every
# text, tokens, frozen models or random rounding, and are tested against brute force.
SQL: dict[str, str] = {
    "op3_embedding_dedup": """
WITH RECURSIVE usable AS (
 SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT u AS node, u AS root FROM links UNION SELECT l.v, r.root FROM reached r JOIN links l ON l.u = r.node),
counted AS (SELECT u, count(*) AS n FROM links GROUP BY u), rooted AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON u = vec_id LEFT JOIN rooted ON node = vec_id""",
    "op11_vector_codes": _codes_sql(),
    "op12_license_scan": _license_sql(),
}
