"""The registered queries of the training-data operators, and their DuckDB twins."""

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from rookery.llm import (
    chat,
    decontaminate,
    exact,
    lm,
    minhash,
    packing,
    pages,
    pii,
    quality,
    repeats,
    resample,
    runs,
    shards,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(_table(spark, folder, "documents"))
    return packed.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op3_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_classes(_table(spark, folder, "documents"))


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    events = chat.events_of_turns(turns.unionByName(added))
    return chat.read_back(chat.render(chat.reconstruct(events)))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(_table(spark, folder, "documents"))


def op6_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, folder, "documents"), keep_text=False).drop("kept")


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(_table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.find_runs(runs.with_planted_runs(_table(spark, folder, "documents"))))


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(_table(spark, folder, "pages"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_repeated_strings": op6_repeated_strings,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pii": op9_pii,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html_extraction": op12_html_extraction,
    "op13_importance_resampling": op13_importance_resampling,
}


def _sql_escaped(text: str) -> str:
    out = f"replace({text}, chr(92), chr(92) || chr(92))"
    for control in chat.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


_MARKS = len(chat.OPEN) + len(chat.AFTER_ROLE) + len(chat.CLOSE)

_CRC_TABLE = """list_transform(range(256), lambda v: list_reduce(list_prepend(v, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _sql_features(table: str, key: str) -> str:
    """(key, feature) rows: all words and pairs of neighbouring words of a table's texts."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(regexp_split_to_array({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    return f"""
        SELECT row, {key} AS key, len(words) AS n_words, unnest(list_concat(words,
            list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1]))) AS feature
        FROM (SELECT row_number() OVER () AS row, *, {words} AS words FROM {table})"""


ORACLE_SQL = {
    "op13_importance_resampling": f"""
        WITH raw AS ({_sql_features("documents", "doc_id")}),
        target AS ({_sql_features("benchmark", "item_id")}),
        crc AS (SELECT {_CRC_TABLE} AS steps),
        spelled AS (SELECT DISTINCT feature, hex(encode(feature)) AS digits FROM (SELECT feature FROM raw UNION ALL SELECT feature FROM target)),
        hashed AS (
            SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2),
                lambda k: ('0x' || digits[2 * k + 1:2 * k + 2])::BIGINT)),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM spelled, crc
        ),
        s AS (SELECT bucket, count(*) AS n FROM raw JOIN hashed USING (feature) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (feature) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
                / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)
        ),
        weighed AS (
            SELECT row, count(*) AS n_features, any_value(n_words) AS n_words,
                (sum(gain) - (((sum(gain) % count(*)) + count(*)) % count(*))) // count(*) AS weight
            FROM raw JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY row
        ),
        scored AS (
            SELECT d.row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(n_words, 0) AS n_words,
                coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                    (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
            FROM (SELECT row_number() OVER () AS row, doc_id FROM documents) d LEFT JOIN weighed USING (row)
        ),
        ranked AS (
            SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able
            FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (row)""",
    "op4_chat_formatting": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {_MARKS}) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op8_exact_dedup": """
        WITH plain AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM plain WINDOW same AS (PARTITION BY norm)""",
}
