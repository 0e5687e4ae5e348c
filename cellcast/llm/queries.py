"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.llm import alignment, edit_walk, lattice, packing, part_codes, prefix_forest, range_coder, set_join, snapshots, suffixes, target_ratio, toxicity, url_trees
from cellcast.llm.rows import documents, fold
from cellcast.session import cut_lineage, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The tokenizer file on this machine; the same package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_subword_lattice")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    held_out = F.coalesce(fold("doc_id", 10) == 0, F.lit(False))
    docs = documents(table(spark, sf_dir, "documents"))
    model = lattice.fit_lattice(docs.select("text", (~held_out).alias("train")), public_tokenizers.path("piece_bpe_32k.model"))
    scored = lattice.score_lattice(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op2_range_coder")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "ids")
    range_coder.write_ids(table(spark, sf_dir, "documents"), folder, word_bpe(), end_id=2)
    return range_coder.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


URL_RULES = [
    url_trees.Rule("allow", "com", "/"),
    url_trees.Rule("block", "example.com", "/en/"),
    url_trees.Rule("allow", "www.example.com", "/en/"),
    url_trees.Rule("block", "net", "/es/"),
    url_trees.Rule("block", "net", "/fr/"),
]


@query("op3_url_trees")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op4_sparse_suffixes")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "copy", "start_word", "end_word")


@query("op5_set_relation_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = set_join.join_sets(table(spark, sf_dir, "documents"), set_join.Similarity(words=3, share=90))
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


@query("op6_counterfactual_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    score = F.col("toxicity_score")
    return scored.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query("op7_vector_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), word_bpe(), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_snapshot_collapse", """
    WITH c AS (SELECT conv_id, count(*) AS n_turns,
                      list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
                      string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rendered
               FROM conversations GROUP BY conv_id),
    whole AS (SELECT turns, n_turns, min(rendered) AS rendered, min(conv_id) AS conv_id, count(*) AS n_equal FROM c GROUP BY turns, n_turns),
    inner_prefix AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM whole) p),
    kept AS (SELECT w.* FROM whole w LEFT JOIN inner_prefix i ON w.turns = i.turns WHERE i.turns IS NULL)
    SELECT conv_id, CAST(0 AS INT) AS part, n_turns, n_equal, rendered FROM kept""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.collapse_snapshots(table(spark, sf_dir, "conversations"))


@query("op9_edit_walk_leaks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_walk.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_target_ratio")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    scored = target_ratio.score_ratio(docs, target_ratio.fit_ratio(docs, trusted))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("in_target")).alias("kept"), "score",
    )


@query("op11_galloping_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align_tokens(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    written = cut_lineage(aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "codes", "times"))
    scored = alignment.score_links(written, *paths)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _book_sql() -> str:
    """Codebooks of 16 parts of 4 components, assigned and moved twice, and assigned again."""
    parts = ", ".join(f"v[4 * p + {j + 1}] AS x{j}" for j in range(4))
    far = " + ".join(f"(q.x{j} - c.x{j}) * (q.x{j} - c.x{j})" for j in range(4))
    steps = []
    for r in range(3):
        steps.append(f"a{r} AS (SELECT q.vec_id, q.p, min(({far}) * 64 + c.e) AS m FROM parts q JOIN c{r} c ON c.p = q.p GROUP BY q.vec_id, q.p)")
        if r < 2:
            means = ", ".join(f"CAST(floor(CAST(sum(q.x{j}) AS DOUBLE) / count(*)) AS BIGINT) AS x{j}" for j in range(4))
            steps.append(f"s{r} AS (SELECT a.p, a.m % 64 AS e, {means} FROM a{r} a JOIN parts q ON q.vec_id = a.vec_id AND q.p = a.p GROUP BY a.p, a.m % 64)")
            moved = ", ".join(f"coalesce(s.x{j}, c.x{j}) AS x{j}" for j in range(4))
            steps.append(f"c{r + 1} AS (SELECT c.p, c.e, {moved} FROM c{r} c LEFT JOIN s{r} s ON s.p = c.p AND s.e = c.e)")
    return f"""
    WITH kept AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
                  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    parts AS (SELECT vec_id, p, {parts} FROM kept, (SELECT unnest(range(16)) AS p) r),
    c0 AS (SELECT q.p, f.e, q.x0, q.x1, q.x2, q.x3
           FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64) f JOIN parts q ON q.vec_id = f.vec_id),
    {", ".join(steps)},
    coded AS (SELECT vec_id, string_agg(format('{{:02x}}', m % 64), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
    book AS (SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept k JOIN coded c ON c.vec_id = k.vec_id, book"""


@query("op12_sliced_part_codes", _book_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = part_codes.compress_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.lit(part_codes.books_digest(books)).alias("codebooks_sha256")
    return part_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)


@query("op13_prefix_forest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return prefix_forest.search_forest(prefix_forest.plant_forest(vectors), vectors.where("vec_id % 50 = 0"), 5)
