"""Registered queries: usage, cost, status, quotas, profiles."""

from pyspark.sql import functions as F

from docvec.functions import numbers
from docvec.functions import text as tx
from docvec.operators import embed, profile, usage
from docvec.plans.registry import query, table

TOKENS = r"len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}\p{Z}\s]'))::BIGINT"
MODEL = "CASE role WHEN 'user' THEN 'text-embedding-3-small' WHEN 'assistant' THEN 'jina-v2-base' ELSE role END"
PRICE = "CASE role WHEN 'user' THEN 0.00000002::DOUBLE WHEN 'assistant' THEN 0.0000001::DOUBLE END"


@query(
    """SELECT event_id, greatest(least(value, 80.0), 20.5) AS clamped, event_type AS plain,
              CASE WHEN event_id % 2 = 0 THEN event_type || chr(10) END AS code, true AS now_is_iso
       FROM events"""
)
def small_functions(spark, sf):
    """Clamped numbers, texts without quote marks, code out of fences, and the time as ISO-8601."""
    fence = F.concat(F.lit("x ```"), F.when(F.col("event_id") % 2 == 0, "python").otherwise("sql"), F.lit("\n"), "event_type", F.lit("\n``` y"))
    return table(spark, sf, "events").select(
        "event_id",
        numbers.clamp(F.col("value"), 20.5, 80.0).alias("clamped"),
        tx.unquote(F.concat(F.lit('"'), "event_type", F.lit('"'))).alias("plain"),
        tx.fenced_code(fence).alias("code"),
        numbers.iso_now().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$").alias("now_is_iso"),
    )


def requests(spark, sf):
    """Each conversation as one request batch per role."""
    model = (
        F.when(F.col("role") == "user", "text-embedding-3-small")
        .when(F.col("role") == "assistant", "jina-v2-base")
        .otherwise(F.col("role"))
    )
    return table(spark, sf, "conversations").select(
        model.alias("model"), F.col("conv_id").alias("user_id"), F.col("text").alias("content"), "turn"
    )


@query(f"SELECT conv_id, turn, {TOKENS} AS tokens FROM conversations")
def token_counts(spark, sf):
    rows = table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", usage.token_count(F.col("text")).alias("tokens"))


@query("SELECT conv_id, turn, len(string_split(text, ' '))::BIGINT AS tokens FROM conversations")
def token_counts_by_tokenizer(spark, sf):
    rows = table(spark, sf, "conversations")
    counted = usage.token_count(F.col("text"), lambda texts: [len(t.split(" ")) for t in texts])
    return rows.select("conv_id", "turn", counted.alias("tokens"))


@query(
    f"""SELECT {MODEL} AS model, conv_id AS user_id, SUM({TOKENS})::BIGINT AS total_tokens, count(*) AS items,
               CASE WHEN conv_id % 2 = 0 THEN SUM({TOKENS}) ELSE SUM(length(text)) END::BIGINT AS billed
        FROM conversations GROUP BY role, conv_id"""
)
def token_usage(spark, sf):
    rows = requests(spark, sf).withColumn("length", F.length("content"))
    counted = usage.batch_tokens(rows, ["model", "user_id"])
    reported = rows.groupBy("model", "user_id").agg(F.sum("length").alias("reported"))
    both = counted.join(reported, ["model", "user_id"])
    billed = usage.billed_tokens(F.col("total_tokens"), F.col("reported"), F.col("user_id") % 2 == 0)
    return both.select("model", "user_id", "total_tokens", "items", billed.alias("billed"))


@query(
    f"""SELECT {MODEL} AS model, SUM({TOKENS})::BIGINT AS total_tokens,
               round(max({PRICE}) * SUM({TOKENS}), 10) AS cost,
               CASE WHEN max({PRICE}) IS NULL THEN 'unknown model' END AS error
        FROM conversations GROUP BY role"""
)
def usage_cost(spark, sf):
    counted = usage.batch_tokens(requests(spark, sf), ["model"])
    priced = usage.with_cost(counted, embed.models(spark))
    return priced.select("model", "total_tokens", F.round("cost", 10).alias("cost"), "error")


@query(
    f"""SELECT conv_id::VARCHAR AS user_id, {MODEL} AS model_name, 0::BIGINT AS input_tokens,
               SUM({TOKENS})::BIGINT AS completion_tokens, 'chat' AS application, 1 AS requests,
               round(max({PRICE}) * SUM({TOKENS}), 10) AS cost, 36::BIGINT AS id_length,
               'docvec' AS source_platform_application
        FROM conversations GROUP BY role, conv_id"""
)
def usage_events(spark, sf):
    counted = usage.batch_tokens(requests(spark, sf), ["model", "user_id"])
    events = usage.usage_events(usage.with_cost(counted, embed.models(spark)), application=F.lit("chat"))
    return events.withColumns(
        {"cost": F.round("cost", 10), "id_length": F.length("transaction_id").cast("bigint")}
    ).drop("transaction_id")


@query(
    """SELECT event_type AS model, user_id, SUM(length(props))::BIGINT AS total_token_count, count(*) AS input_item_count,
              round(avg(value), 9) AS response_time_ms FROM events GROUP BY ALL"""
)
def usage_metrics(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("model"), "user_id", F.length("props").alias("total_tokens"),
        F.lit(1).alias("items"), F.col("value").alias("response_time_ms"),
    )
    found = usage.usage_metrics(rows)
    return found.withColumn("response_time_ms", F.round("response_time_ms", 9))


@query(
    f"""SELECT role, SUM({TOKENS})::BIGINT AS prompt_tokens, SUM({TOKENS} + turn)::BIGINT AS total_tokens
        FROM conversations GROUP BY role"""
)
def usage_totals(spark, sf):
    tokens = usage.token_count(F.col("text"))
    rows = table(spark, sf, "conversations").select(
        "role", tokens.alias("prompt_tokens"), (tokens + F.col("turn")).alias("total_tokens")
    )
    return usage.usage_totals(rows, ["role"])


def results(spark, sf):
    """Events as chunk results: the user is the file, an error event a chunk that failed."""
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("user_id").alias("file_id"), F.col("event_id").alias("chunk_id"), (~failed).alias("written"),
        F.when(failed, F.col("props")).alias("error"),
    )


REPORT = """SELECT user_id AS file_id, count(*) AS chunks, count(*) FILTER (event_type <> 'error') AS vectors,
                   max(CASE WHEN event_type = 'error' THEN props END) AS error FROM events GROUP BY user_id"""


@query(REPORT)
def file_report(spark, sf):
    return usage.file_report(results(spark, sf))


@query(
    f"""SELECT count(*) AS files, count(*) FILTER (error IS NULL) AS completed, SUM(vectors)::BIGINT AS vectors
        FROM ({REPORT})"""
)
def run_summary(spark, sf):
    return usage.run_summary(usage.file_report(results(spark, sf)))


@query(
    """SELECT user_id AS file_id, arg_max(event_type, event_id) AS status, max(ts) AS timestamp
       FROM events GROUP BY user_id"""
)
def file_status(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("user_id").alias("file_id"), F.col("event_type").alias("status"), "ts", "event_id"
    )
    return usage.latest_status(log, tie="event_id")


@query(
    f"""SELECT c.c_custkey::VARCHAR AS file_id, CASE WHEN r.error IS NOT NULL THEN 'failed'
               WHEN r.chunks > 0 THEN 'completed' ELSE 'processing' END AS status
        FROM customer c LEFT JOIN ({REPORT}) r ON r.file_id = c.c_custkey"""
)
def file_states(spark, sf):
    listed = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file_id"))
    report = usage.file_report(results(spark, sf)).withColumn("file_id", F.col("file_id").cast("string"))
    return usage.file_states(listed, report).select("file_id", "status")


def quotas(spark, sf):
    cap = F.when(F.col("c_nationkey") != 3, F.lit(1000))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("application"), cap.alias("hard_cap"), F.col("c_acctbal").alias("usage_available")
    )


def quota_requests(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("application"))


OPEN = "SELECT c_custkey FROM customer WHERE c_nationkey <> 3 AND c_acctbal > 0"


@query(f"SELECT o_orderkey FROM orders WHERE o_custkey IN ({OPEN})")
def quota_gate(spark, sf):
    return usage.quota_gate(quota_requests(spark, sf), quotas(spark, sf))[0].select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE o_custkey NOT IN ({OPEN})")
def quota_rejects(spark, sf):
    return usage.quota_gate(quota_requests(spark, sf), quotas(spark, sf))[1].select("o_orderkey")


@query(
    """SELECT event_id, event_type, round(avg(value) OVER (PARTITION BY event_type ORDER BY event_id
              ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS mean_latency FROM events"""
)
def latency_moving_avg(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    counted = embed.numbered(rows, ["event_type"], "event_id")
    found = usage.latency_mean(counted, "event_type", "value", width=1_000)
    return found.select("event_id", "event_type", F.round("mean_latency", 6).alias("mean_latency"))


# ---------------------------------------------------------------- profiles

PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query(
    """SELECT 'Columns (Properties): p_partkey, p_name, p_brand, p_type, p_size' || chr(10) || 'Example Rows:' || chr(10)
              || string_agg('Row ' || rn || ': p_partkey: ' || p_partkey || ', p_name: ' || p_name || ', p_brand: ' || p_brand
              || ', p_type: ' || p_type || ', p_size: ' || p_size || chr(10), '' ORDER BY rn) AS text
       FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn FROM part) WHERE rn <= 2"""
)
def profile_text(spark, sf):
    return profile.sample_text(table(spark, sf, "part"), ["p_partkey"], PART)


@query(
    """SELECT 'Columns (Properties): ' || max(CASE WHEN rn = 1 THEN array_to_string(json_keys(props), ', ') END) || chr(10)
              || 'Example Rows:' || chr(10)
              || string_agg('Row ' || rn || ': k: ' || json_extract_string(props, '$.k') || chr(10), '' ORDER BY rn) AS text
       FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM events) WHERE rn <= 2"""
)
def profile_json_text(spark, sf):
    return profile.json_sample_text(table(spark, sf, "events"), "props", ["event_id"])


@query("SELECT event_id, ts AS utc FROM events")
def naive_utc(spark, sf):
    rows = table(spark, sf, "events")
    return rows.select("event_id", numbers.naive_utc(F.to_utc_timestamp(F.col("ts"), F.current_timezone())).alias("utc"))


@query("SELECT DISTINCT unnest(json_keys(props)) AS field FROM events")
def metadata_fields(spark, sf):
    return profile.json_fields(table(spark, sf, "events"), "props")


WORDS = r"len(list_filter(regexp_split_to_array({0}, '[\s\x1c-\x1f\x{{85}}\x{{a0}}\x{{2028}}\x{{2029}}\x{{3000}}]+'), lambda x: x <> ''))"


def profile_sql(name, column):
    return f"""SELECT '{name}' AS name, count(*) AS n_rows, count(*) FILTER ({column} IS NULL) AS n_null,
        count(DISTINCT {column}) AS n_distinct, round(avg(length({column})), 6) AS mean_length,
        round(avg({WORDS.format(column)}), 6) AS mean_words"""


PROFILE = " UNION ALL ".join(
    f"{profile_sql(c, c + '::VARCHAR')} FROM {t}" for t, c in [("documents", "doc_id"), ("documents", "text"), ("documents", "lang"), ("documents", "source")]
)


def documents_profile(spark, sf):
    rows = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    found = profile.column_profile(rows, exact=True)
    return found.withColumns({c: F.round(c, 6) for c in ("mean_length", "mean_words")})


@query(PROFILE)
def profile_columns(spark, sf):
    return documents_profile(spark, sf)


@query(
    f"""SELECT name, mean_words >= 2 AND n_distinct::DOUBLE / greatest(n_rows - n_null, 1) >= 0.1 AS embed
        FROM ({PROFILE})"""
)
def fields_to_embed(spark, sf):
    return profile.fields_to_embed(documents_profile(spark, sf)).select("name", "embed")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, '{c} of type {t}, for example ' || coalesce(substr(min({c}::VARCHAR), 1, 40), 'null')
            AS description, '{t}' AS type FROM part"""
        for c, t in [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int")]
    )
)
def attribute_info(spark, sf):
    return profile.attribute_info(table(spark, sf, "part"), PART)
