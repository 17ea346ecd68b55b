"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.llm import bpe, decontam, fim, html, jaccard, merkle, ranking, rollups, rules, shards, sketches, surrogates, toxicity
from biblioscope.llm.shared import Work

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer(spark))


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(documents, rules.fit(documents)).drop("text")


def _labelled(spark: SparkSession, sf_dir: str, label: str, of: int, held_out: int) -> DataFrame:
    return ranking.sample(_table(spark, sf_dir, "labels"), label, ranking.remainder(F.col("doc_id"), of) != held_out)


def _verdicts(scored: DataFrame, of: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        (ranking.remainder(F.col("doc_id"), of) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op5_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; a third of the documents is held out."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ranking.fit(documents, _labelled(spark, sf_dir, "quality", 3, 1))
    return _verdicts(ranking.scored(documents, model), 3, 1)


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; a fifth of the documents is held out."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, _labelled(spark, sf_dir, "toxic", 5, 0))
    return _verdicts(toxicity.scored(documents, model, offending=None), 5, 0)


@_query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extracted(pages, html.fit(pages)).drop("html")


@_query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    return jaccard.similar(Work(spark), _table(spark, sf_dir, "documents"))


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document."""
    return decontam.contaminated(Work(spark), _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL["op8_decontamination"] = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
), tokens AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS token
    FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), items AS (
    SELECT id AS item_id, token, count(*) OVER (PARTITION BY id) AS n_item_shingles FROM tokens WHERE kind = 'b'
)
SELECT id AS doc_id, item_id, n_item_shingles, count(*) AS n_shared, count(*) / n_item_shingles AS containment
FROM tokens JOIN items USING (token) WHERE kind = 'd'
GROUP BY id, item_id, n_item_shingles HAVING 100 * count(*) >= 75 * n_item_shingles
"""

#: Keys of the registered queries; a user passes secret ones.
SURROGATE_KEY = ORDER_KEY = b"registered query"


@_query
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(documents, surrogates.fit(Work(spark), documents, SURROGATE_KEY))


@_query
def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the shards, which are written along the way."""
    work = Work(spark)
    index = shards.write(_table(spark, sf_dir, "documents"), tokenizer(spark), f"{work.path}/shards", ORDER_KEY, end=50_256)
    return work.stage(index)


@_query
def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the corpus after four batches and a repeated one.

    The documents come; those labelled toxic are revised to the text behind their first line; those labelled
    bad go, with the counts they have by then; a batch that was committed is sent once more.
    """
    work = Work(spark)
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    versions = {"byte_bpe_50k": tokenizer(spark), "words": None}
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    bad = labels.where("quality = 0").select("doc_id").distinct()
    rollup = rollups.Rollup(spark, f"{work.path}/rollup")

    old = work.stage(rollups.counted(documents, versions))
    rollup.commit("1-documents", rollups.signed(old, 1))
    revised = rollups.among(documents.select("doc_id", "source", "lang", "text"), toxic).withColumn("text", F.regexp_replace("text", r"^[^\n]*\n?", ""))
    new = work.stage(rollups.counted(revised, versions))
    changes = rollups.signed(old.join(toxic, "doc_id", "left_semi"), -1).union(rollups.signed(new, 1))
    rollup.commit("2-revised", changes)
    now = old.join(toxic, "doc_id", "left_anti").union(new)
    rollup.commit("3-removed", rollups.signed(now.join(bad, "doc_id", "left_semi"), -1))
    rollup.commit("2-revised", changes)
    return rollup.totals()


@_query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, and as rebuilt from it."""
    made = fim.transformed(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), restored)


SQL["op11_fill_in_middle"] = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
           list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id AS varchar), '')), i, 8) AS bigint)) AS h
    FROM documents
), parts AS (
    SELECT doc_id, text, len(u) AS n, h, array_to_string(u[:least(h[1] % (len(u) + 1), h[2] % (len(u) + 1))], '') AS prefix,
           array_to_string(u[least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) + 1:greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1))], '') AS middle,
           array_to_string(u[greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) + 1:], '') AS suffix,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@_query
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies, and whether it stays."""
    return sketches.near_copies(Work(spark), _table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and where a tampered third of the leaves leads to."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    values = [F.col(c) for c in documents.columns]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = documents.select("doc_id", "lang", merkle.leaf(*values).alias("leaf"), F.when(changed, merkle.leaf(*values[:-1], merkle.lowered(values[-1]))).alias("changed"))
    proven = merkle.proofs(Work(spark), leaves).withColumn("folded_root", merkle.folded(F.coalesce("changed", "leaf"), F.col("proof")))
    proof = merkle.digest_of(F.col("proof")).alias("proof_sha256")
    return proven.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree_sql(name: str, levels: int) -> str:
    """Levels of the trees of ``name``0 (g, i, d, n), their runs, and the way up of every node of level 0; a tree's top stays as it is."""
    steps = []
    for k in range(levels):
        steps += [
            f"{name}r{k} AS MATERIALIZED (SELECT g, i // 8 AS i, any_value(n) AS n, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY g, i // 8)",
            f"{name}{k + 1} AS MATERIALIZED (SELECT g, i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (n + 7) // 8 AS n FROM {name}r{k})",
        ]
    return ", ".join(steps)


def _way_sql(name: str, start: str, levels: int) -> str:
    """The rows of ``start`` (g, i, proof, f) led up the trees of ``name``."""
    steps, before = [], start
    for k in range(levels):
        sides = "array_to_string(ds[:y], '') AS b, array_to_string(ds[y + 2:], '') AS a"
        steps.append(
            f"{name}w{k} AS (SELECT * EXCLUDE (n, a, b, y, ds, proof, f), proof || b || a AS proof, CASE WHEN n > 1 THEN sha256(b || f || a) ELSE f END AS f"
            f" FROM (SELECT w.* EXCLUDE (i), w.i // 8 AS i, r.n, w.i % 8 AS y, r.ds, {sides} FROM {before} w JOIN {name}r{k} r ON r.g = w.g AND r.i = w.i // 8))"
        )
        before = f"{name}w{k}"
    return ", ".join(steps)


_ENCODED = " || ".join(f"coalesce(strlen({x}::varchar)::varchar || ':' || {x}::varchar, '-')" for x in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: crc32 bit by bit: a step of -1 shifts, others are the next byte.
_CRC = "xor(list_reduce(flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])), lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, (c & 1) * 3988292384) END, 4294967295::bigint), 4294967295::bigint)"

# Trees of up to 8^8 documents a language and 8^3 languages.
SQL["op13_merkle_manifest"] = f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, lang, sha256({_ENCODED} || coalesce(strlen(text)::varchar || ':' || text, '-')) AS leaf,
           CASE WHEN {_CRC} % 3 = 0 THEN sha256({_ENCODED} || coalesce(strlen({_LOWERED})::varchar || ':' || {_LOWERED}, '-')) END AS changed
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), t0 AS MATERIALIZED (SELECT g, i, leaf AS d, n FROM placed), {_tree_sql("t", 8)},
u0 AS MATERIALIZED (SELECT -1 AS g, g AS i, d, count(*) OVER () AS n FROM t8), {_tree_sql("u", 3)},
start AS (SELECT doc_id, leaf, g, i, '' AS proof, coalesce(changed, leaf) AS f FROM placed), {_way_sql("t", "start", 8)},
over AS (SELECT w.* EXCLUDE (g, i), t8.d AS subroot, -1 AS g, w.g AS i FROM tw7 w JOIN t8 ON t8.g = w.g), {_way_sql("u", "over", 3)}
SELECT doc_id, leaf, subroot, u3.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u3.d AS verified FROM uw2 JOIN u3 ON u3.g = uw2.g
"""
