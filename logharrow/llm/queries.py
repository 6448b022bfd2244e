"""Queries over the driver's tables for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.lines import remove_repeated_lines

    found = remove_repeated_lines(documents(spark, sf_dir), min_lines=2, min_chars=50)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM documents
), seq AS (
  SELECT doc_id, k, line, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS pos FROM lines WHERE trim(line) <> ''
), pairs AS (
  SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM seq
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, pos) AS copy FROM pairs WHERE nxt IS NOT NULL
), late AS (
  SELECT doc_id, pos FROM ranked WHERE copy > 1 UNION SELECT doc_id, pos + 1 FROM ranked WHERE copy > 1 UNION
  SELECT doc_id, pos FROM (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS copy FROM seq) WHERE copy > 1 AND length(line) >= 50
), flagged AS (
  SELECT l.doc_id, l.k, l.line, t.pos IS NOT NULL AS gone
  FROM lines l LEFT JOIN seq s ON s.doc_id = l.doc_id AND s.k = l.k LEFT JOIN late t ON t.doc_id = s.doc_id AND t.pos = s.pos
), found AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept
  FROM flagged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(kept) END AS kept_sha256
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.packing import pack, tokenise

    pieces = pack(tokenise(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=2))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.imatch import fingerprint_neighbours

    return fingerprint_neighbours(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.substrings import remove_repeats

    found = remove_repeats(documents(spark, sf_dir), width=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = """
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM documents
), word AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM cut
), win AS (
  SELECT doc_id, word, i, CASE WHEN count(*) OVER w = 50 THEN string_agg(word, ' ') OVER w END AS seq
  FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), late AS (
  SELECT doc_id, word, i, seq IS NOT NULL AND min(doc_id) OVER (PARTITION BY seq) < doc_id AS starts FROM win
), covered AS (
  SELECT doc_id, word, i, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM late
), found AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id
"""


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.sharding import shuffle_to_shards

    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir)
    put = shuffle_to_shards(docs, ["doc_id", "text"], F.octet_length(text) + 1, shards=16)
    text = F.coalesce("record.text", F.lit(""))
    return put.select(
        F.col("record.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.token_files import read_token_files, token_files_path, write_token_files

    manifest = write_token_files(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), token_files_path(spark), end_id=0)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def held_out() -> "F.Column":
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.toxicity import fit, score

    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(~held_out()))
    found = score(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.decontamination import mark

    found = mark(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", F.array_join("item_ids", ",").alias("item_ids"), "best_share")


#: Key of the queries' surrogates; a real run passes a secret.
SURROGATE_KEY = "surrogate key of the queries"


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.surrogates import replace_entities

    found = replace_entities(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)
    return found.select("doc_id", "n_entities", F.array_join("kinds", ",").alias("kinds"), "text")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.simhash import simhash_components

    found = simhash_components(documents(spark, sf_dir), width=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    from logharrow.llm.clusters import kmeans

    found = kmeans(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), clusters=8, rounds=10, seed=3)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    of = lambda values, kind: F.get(F.lit(values).cast(f"array<{kind}>"), F.col("cluster"))
    return found.assigned.select(
        "vec_id", "cluster", "distance", of(found.inertia, "bigint").alias("cluster_inertia"), F.lit(sum(found.inertia)).cast("bigint").alias("inertia"), of(names, "string").alias("centroid_sha256"),
    )


def _op11_sql(rounds: int = 10) -> str:
    """The rounds one after the other: a<r> has the vectors' clusters under the centroids c<r>."""
    parts = ["""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS k, x FROM kept ORDER BY sha256('3:' || vec_id), x LIMIT 8
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'k': k}}) AS near FROM (
    SELECT v.r, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept v, c{i} c
  ) GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT near.k AS k, p, sum(x[p])::BIGINT AS s, count(*) AS n FROM a{i} JOIN kept USING (r), range(1, 65) t(p) GROUP BY near.k, p
), c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x FROM s{i} GROUP BY k) m ON m.k = c.k
)""")
    return f"""WITH {", ".join(parts)}
SELECT v.vec_id, near.k::INT AS cluster, near.d AS distance, sum(near.d) OVER (PARTITION BY near.k)::BIGINT AS cluster_inertia, sum(near.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v USING (r) JOIN c{rounds} c ON c.k = near.k"""


OP11_SQL = _op11_sql()


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.quality import document_statistics, fit, with_score
    from logharrow.llm.scratch import materialise

    stats = materialise(document_statistics(documents(spark, sf_dir)), "document-statistics")
    model = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()))
    found = with_score(stats, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the damage that crc32 of `conv_id:turn` deals out; times says how often a row is left there."""
    spelt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn")).cast("binary")) % 20
    text, role = spelt("text"), spelt("role")
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logharrow.llm.conversations import repair

    found = repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), times_col="times", texts=False)
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


#: CRC-32 of a short ASCII string, its polynomial reversed, bit by bit: DuckDB has no function for it.
CRC32_SQL = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({s}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"""


def _op13_sql() -> str:
    """The Viterbi backward, row by row: v0 to v3 hold (cost, audit, lines) to the end from each state."""
    least = lambda *options: f"list_min([{', '.join(options)}])"
    edit = lambda to, cost, letter, line: f"{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a, 't': {line} || {to}.t}}"
    follow, role = (2, 2, 3, 2), {2: "user", 3: "assistant"}
    far = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"
    base = []
    for s in range(4):
        options = [edit(f"p.v{s}", 3, "D", "[]::VARCHAR[]"), f"CASE WHEN need THEN {far} ELSE {edit(f'p.v{follow[s]}', '2 + late', 'R', f'''['{role[follow[s]]}:' || r.text]''')} END"]
        for initial, to in {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s].items():
            options.append(f"CASE WHEN need OR left(r.role, 1) <> '{initial}' THEN {far} ELSE {edit(f'p.v{to}', 'late', 'K', '''[r.role || ':' || r.text]''')} END")
        base.append(f"{least(*options)} AS b{s}")
    insert = lambda of, to: f"{{'c': {of}.c + 2, 'a': 'I' || {of}.a, 't': ['{role[to]}:'] || {of}.t}}"
    return f"""WITH RECURSIVE spelt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), dealt AS (
  SELECT conv_id, turn, role, text, xor({CRC32_SQL.format(s="name")}, 4294967295) % 20 AS fault FROM spelt
), after AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM dealt, range(2) t(k) WHERE fault <> 0 AND (k = 0 OR fault = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM after
), judged AS (
  SELECT *, ending = '' AS blank, ending <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM placed
), faulty AS MATERIALIZED (
  SELECT *, blank OR duplicate AS need, (NOT blank AND NOT duplicate AND ending NOT IN ('.', '!', '?'))::BIGINT AS late FROM judged
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, sum(late)::BIGINT AS truncated,
    count(*) FILTER (WHERE earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faulty GROUP BY conv_id
), path AS (
  SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS v0, {{'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}} AS v1,
    {{'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']}} AS v2, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS v3 FROM sums
  UNION ALL
  SELECT conv_id, i, {least("b0", insert("w2", 2))}, {least("b1", insert("w2", 2))}, w2, w3 FROM (
    SELECT *, {least("b2", insert("b3", 3))} AS w2, {least("b3", insert("b2", 2))} AS w3 FROM (
      SELECT r.conv_id, r.i, {", ".join(base)} FROM path p JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i - 1))
)
SELECT o.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated,
  coalesce(s.illegal, 0)::BIGINT AS illegal, coalesce(p.v0.c, 0)::BIGINT AS cost, coalesce(p.v0.a, '') AS audit, sha256(coalesce(array_to_string(p.v0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN path p ON p.i = 1 AND p.conv_id IS NOT DISTINCT FROM o.conv_id"""


OP13_SQL = _op13_sql()


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_packing, op3_imatch_fingerprints, op4_substring_dedup, op5_sharding, op6_token_files, op7_toxicity, op8_benchmark_decontamination, op9_pii_surrogates, op10_simhash_near_dedup, op11_centroid_clustering, op12_quality_classifier, op13_conversation_repair)}
ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op4_substring_dedup": OP4_SQL, "op11_centroid_clustering": OP11_SQL, "op13_conversation_repair": OP13_SQL}
