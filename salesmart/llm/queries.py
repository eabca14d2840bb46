"""The registered queries of the operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table it is meant for and returns the whole result.  Where SQL cannot express
a query it has no entry in ``ORACLE_SQL`` and is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.llm import (
    decontamination,
    fill_in_middle,
    fingerprints,
    licenses,
    lm_scoring,
    merkle,
    minhash,
    mixing,
    sharding,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from salesmart.llm.common import lower_ascii, table


def _vocabulary() -> dict[str, float]:
    import public_tokenizers

    return token_counts.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rule_table(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = fingerprints.with_next(docs, "doc_id", "text", "mark")
    both = fingerprints.with_edited(paired)
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.digest(F.col("mark")).alias("fingerprint"),
        fingerprints.digest(F.col("edited_mark")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        fingerprints.likeness(F.col("mark"), F.col("next.mark")).alias("near_next"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), _vocabulary())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    return sharding.shard_records(docs).select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), _vocabulary())
    return counts.withColumn("over_limit", token_counts.over_limit(F.col("n_tokens")))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("f_id").alias("doc_id"), simhash.hex_print(F.col("f_print")).alias("fingerprint"),
                        F.col("f_component").alias("component_id"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), names=licenses.NAMES).drop("blocks")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = [lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS]
    made = merkle.manifest(docs, carry=F.when(chosen, merkle.leaf_digest(*fields)))
    return made.select(
        F.col("m_key").alias("doc_id"), F.col("m_leaf").alias("leaf"), F.col("m_subroot").alias("subroot"),
        F.col("m_root").alias("root"), merkle.digest(merkle.proof_text(F.col("m_proof"))).alias("proof_sha256"),
        merkle.folded(F.coalesce("m_carry", "m_leaf"), F.col("m_proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("p_id").alias("doc_id"), F.col("p_n").alias("n_shingles"),
                        F.col("p_component").alias("component_id"),
                        F.col("p_id").eqNullSafe(F.col("p_component")).alias("kept"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_license_scans": op10_license_scans,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

#: CRC-32 of the decimal id, a byte and then its eight bits at a time (the polynomial is a fixed value).
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"


def _merkle_sql(levels: int) -> str:
    """The Merkle manifest in SQL, for trees of at most 16 ** ``levels`` leaves.

    One table of nodes for each level of the sources' trees (a) and of the tree
    of their subroots (b).  A tree that is finished below a level keeps its
    node's hash there, so every tree ends at the last level.
    """
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tower(letter: str, tree: str, size: str) -> str:
        return "".join(f"""
), {letter}{i + 1} AS (
  SELECT {tree} AS tree, r // 16 AS r, any_value({size}) AS {size},
         CASE WHEN any_value({size}) > {16 ** i} THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h,
         list(h ORDER BY r) AS run
  FROM {letter}{i} GROUP BY {tree}, r // 16""" for i in range(levels))

    def climb(letter: str, base: str, same: str) -> str:
        return "".join(f"""
JOIN {letter}{i + 1} ON {same.format(letter + str(i + 1))} AND {letter}{i + 1}.r = {base}.r // {16 ** (i + 1)}"""
                       for i in range(levels))

    def beside(letter: str, base: str, size: str) -> list[tuple[str, str]]:
        steps = []
        for i in range(levels):
            at = f"{base}.r // {16 ** i} % 16"
            steps.append(tuple(f"CASE WHEN {base}.{size} > {16 ** i} THEN array_to_string({letter}{i + 1}.run[{part}], '') "
                               "ELSE '' END" for part in (f"1:{at}", f"{at} + 2:16")))
        return steps

    sides = beside("a", "a0", "size") + beside("b", "b0", "trees")
    proof = " || ".join(f"({side})" for pair in sides for side in pair)
    steps = "".join(f", ({left}) AS l{i}, ({right}) AS r{i}" for i, (left, right) in enumerate(sides))
    fold = "coalesce(tampered, leaf)"
    folds = ""
    for i in range(2 * levels):
        on = f"size > {16 ** i}" if i < levels else f"trees > {16 ** (i - levels)}"
        folds += f"""
), f{i + 1} AS (
  SELECT *, CASE WHEN {on} THEN sha256(l{i} || {fold} || r{i}) ELSE {fold} END AS now{i + 1} FROM f{i}"""
        fold = f"now{i + 1}"
    return f"""
WITH leaves AS (
  SELECT doc_id, source, {leaf('text')} AS h,
         CASE WHEN crc % 5 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         END AS tampered
  FROM (SELECT *, {_CRC} AS crc FROM documents)
), a0 AS (
  SELECT doc_id, source AS tree, h, tampered, count(*) OVER (PARTITION BY source) AS size,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS r
  FROM leaves{tower("a", "tree", "size")}
), b0 AS (
  SELECT a{levels}.tree AS source, 0 AS tree, h, count(*) OVER () AS trees,
         row_number() OVER (ORDER BY a{levels}.tree NULLS FIRST) - 1 AS r
  FROM a{levels}{tower("b", "tree", "trees")}
), f0 AS (
  SELECT a0.doc_id, a0.h AS leaf, a0.tampered, a0.size, b0.trees, b0.h AS subroot, b{levels}.h AS root,
         sha256({proof}) AS proof_sha256{steps}
  FROM a0{climb("a", "a0", "{0}.tree IS NOT DISTINCT FROM a0.tree")}
JOIN b0 ON b0.source IS NOT DISTINCT FROM a0.tree{climb("b", "b0", "{0}.tree = 0")}{folds}
)
SELECT doc_id, leaf, subroot, root, proof_sha256, {fold} AS folded_root, {fold} = root AS verified FROM f{2 * levels}
"""


ORACLE_SQL = {
    "op1_url_filters": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM parsed
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
    "op11_fill_in_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
         array_to_string(units[b + 1:n], '') AS s
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op12_merkle_manifest": _merkle_sql(5),
}
