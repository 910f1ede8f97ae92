"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.llm import ann, bpe, langid, lm, merkle, packing, pieces, simhash, substring_dedup, suffix_dedup, topk, toxicity, vector_codes
from rampart.llm.common import held_out

CONTEXT = 2048  # tokens of a packed sequence
TOXIC = 0.7  # from this score on a text counts as toxic
REPEAT_BYTES = 50  # bytes of a string that must not repeat
REPEAT_WORDS = 50  # words of a passage that must not repeat
TAMPERED = 5  # documents with a crc32 that this divides have a tampered text
SHINGLE, BITS = 3, 3  # words of a shingle, differing bits of linked fingerprints


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op6_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 7, 2).alias("held_out"))
    return lm.score(docs, tokenizer_path(), "held_out")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), REPEAT_BYTES)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    model = langid.train(docs, where=~out & F.col("doc_id").isNotNull())
    return langid.identify(docs.select("doc_id", "text", out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 3, 1)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), where=~out & F.col("doc_id").isNotNull())
    found = toxicity.score(docs.select("doc_id", "text", out.alias("held_out")), model)
    return found.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= TOXIC).cast("int").alias("predicted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), REPEAT_WORDS)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(_table(spark, sf_dir, "documents"), SHINGLE, BITS)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), CONTEXT)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*fields, "text").alias("leaf"),
                         F.when(hit, merkle.leaf_digest(*fields, lowered)).alias("tampered"))
    found = merkle.manifest(leaves, ["source"], ["doc_id"])
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(_table(spark, sf_dir, "embeddings"), group_col="label")
    return found.select("vec_id", "code", "error", F.col("group_error").alias("label_error"), "codebooks_sha256")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_bpe, op2_nearest_neighbours, op3_lm_scoring, op4_suffix_dedup, op5_language_id, op6_top_inner_products, op7_toxicity, op8_substring_dedup, op9_simhash, op10_best_fit_packing,
                                                                                op11_merkle_manifest, op12_vector_codes, op13_sentencepiece)}

def _merkle_sql(levels: int = 8) -> str:
    """Every level of both trees (up to 16**levels leaves) written out: nodes, and what a leaf's node has beside it."""

    def grow(name: str, tree: str, first: str) -> str:
        """{name}{k}: nodes (tree columns, p, h, n) of level k; {name}_run{k}: their runs' joined digests."""
        key = f"{tree}, " if tree else ""
        ctes = [f"{name}0 AS MATERIALIZED ({first})"]
        for k in range(levels):
            ctes.append(f"{name}_run{k} AS MATERIALIZED (SELECT {key}p // 16 AS p, string_agg(h, '' ORDER BY p) AS run, any_value(n) AS n FROM {name}{k} GROUP BY {key}p // 16)")
            ctes.append(f"{name}{k + 1} AS MATERIALIZED (SELECT {key}p, CASE WHEN n = 1 THEN run ELSE sha256(run) END AS h, (n + 15) // 16 AS n FROM {name}_run{k})")
        return ",\n".join(ctes)

    def climb(source: str, out: str, name: str, tree: str, node: str) -> str:
        """{out}{k}: leaves with the folded node and the siblings up to level k."""
        ctes, on = [], " AND ".join(["r.p = (u.p // %d) // 16", *([f"r.{tree} = u.{tree}"] if tree else [])])
        for k in range(levels):
            before = source if k == 0 else f"{out}{k - 1}"
            at = f"((u.p // {16 ** k}) % 16)"
            left, right = f"substr(r.run, 1, 64 * {at})", f"substr(r.run, 64 * {at} + 65)"
            ctes.append(f"""{out}{k} AS MATERIALIZED (SELECT u.* REPLACE (
                CASE WHEN r.n = 1 THEN u.{node} ELSE sha256({left} || u.{node} || {right}) END AS {node},
                CASE WHEN r.n = 1 THEN u.proof ELSE u.proof || {left} || {right} END AS proof)
                FROM {before} u JOIN {name}_run{k} r ON {on % 16 ** k})""")
        return ",\n".join(ctes)

    part = lambda e: f"coalesce(strlen(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    digits = "[CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, b: {step}), 4294967295)"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
        WITH d AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s, {leaf('text')} AS leaf,
                          CASE WHEN doc_id IS NOT NULL AND {crc} % {TAMPERED} = 0 THEN {leaf(lowered)} END AS tampered FROM documents),
        l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY s) AS n FROM d),
        {grow('t', 's', 'SELECT s, p, leaf AS h, n FROM l')},
        {grow('g', '', f'SELECT s - 1 AS p, h, count(*) OVER () AS n FROM t{levels}')},
        start AS (SELECT doc_id, leaf, s, p, coalesce(tampered, leaf) AS node, '' AS proof FROM l),
        {climb('start', 'a', 't', 's', 'node')},
        again AS (SELECT * REPLACE (s - 1 AS p) FROM a{levels - 1}),
        {climb('again', 'b', 'g', '', 'node')}
        SELECT u.doc_id, u.leaf, t.h AS subroot, g.h AS root, sha256(u.proof) AS proof_sha256, u.node AS folded_root, u.node = g.h AS verified
        FROM b{levels - 1} u JOIN t{levels} t USING (s) CROSS JOIN g{levels} g"""


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Every distance of every round by plain arithmetic, each round written out."""
    ctes = ["""v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, len(embedding) // 4 AS m,
                            [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
                     WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
            "x AS MATERIALIZED (SELECT r, part, w[part * m + 1:part * m + m] AS w FROM v, range(4) t(part))",
            "b0 AS MATERIALIZED (SELECT part, r - 1 AS e, w FROM x WHERE r <= 256)"]
    for k in range(rounds + 1):
        ctes.append(f"""n{k} AS MATERIALIZED (SELECT r, part, min(row(d, e)) AS best FROM
            (SELECT x.r, x.part, b.e, CAST(list_sum([(x.w[i] - b.w[i]) * (x.w[i] - b.w[i]) FOR i IN range(1, len(x.w) + 1)]) AS BIGINT) AS d
             FROM x JOIN b{k} b USING (part)) GROUP BY r, part)""")
        if k < rounds:
            ctes.append(f"""m{k} AS (SELECT part, best[2] AS e, i, CAST(sum(w[i]) AS BIGINT) AS s, count(*) AS c
                FROM n{k} JOIN x USING (r, part), range(1, len(w) + 1) t(i) GROUP BY part, e, i)""")
            ctes.append(f"""b{k + 1} AS MATERIALIZED (SELECT part, e, coalesce(any_value(moved.w), any_value(b.w)) AS w FROM b{k} b LEFT JOIN
                (SELECT part, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS w FROM m{k} GROUP BY part, e) moved USING (part, e) GROUP BY part, e)""")
    return f"""
        WITH {", ".join(ctes)},
        coded AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM n{rounds} GROUP BY r),
        book AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM v JOIN coded USING (r) CROSS JOIN book"""


#: op6: every score by plain arithmetic; op11, op12: every level, every round written out. op8: every window of 50 words, joined, against its smallest document.
ORACLE_SQL: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_vector_codes": _codes_sql(),
    "op8_substring_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
        win AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
        least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
        gone AS (SELECT DISTINCT r, j FROM (SELECT r, unnest(range(i, i + 50)) AS j FROM win JOIN least USING (h) WHERE m < doc_id)),
        words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op6_top_inner_products": """
        WITH v AS (SELECT row_number() OVER () AS n, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum([q.w[i] * c.w[i] FOR i IN range(1, len(q.w) + 1)]) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 20 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
