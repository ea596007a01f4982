"""The registered queries of the operators; each derives its digest columns from real outputs."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.llm import chat, infill, jaccard, language, mixing, pieces, secrets, spotsigs, tokenfiles, topk, urls, variants, warc
from docvec.llm.kernels import small_batches
from docvec.plans.registry import query


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: sure findings, and weak parts linked to their complements."""
    found = secrets.scan(load(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)

    def of(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(of, secrets.KINDS),
        F.sha2(secrets.spelled(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


URL_RULES = (
    urls.Rule("org", "/", urls.ALLOW),
    urls.Rule("example.org", "/es/", urls.BLOCK),
    urls.Rule("example.org", "/en/1", urls.BLOCK),
    urls.Rule("com", "/fr/", urls.ALLOW),
    urls.Rule("com", "/de/", urls.BLOCK),
)
# Where no rule fits: hosts of advertisement and pages without content.
URL_GLOBS = (
    urls.Rule("ads.*", "", urls.BLOCK),
    urls.Rule("*spam*", "", urls.BLOCK),
    urls.Rule("*cheap-*", "", urls.BLOCK),
    urls.Rule("*", "/*login", urls.BLOCK),
    urls.Rule("*", "/*.exe", urls.BLOCK),
)


@query(
    """
    WITH parts AS (
        SELECT page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages
    ), split AS (
        SELECT page_id, translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, x.p AS path FROM parts
    ), named AS (
        SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
            WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
            WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
            WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
            WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
        FROM split
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN host LIKE 'ads.%' OR host LIKE '%.ads.%' OR host LIKE '%spam%' OR host LIKE '%cheap-%' THEN 'block'
        WHEN path LIKE '/%login%' OR path LIKE '/%.exe%' THEN 'block'
        ELSE 'allow' END AS verdict
    FROM named
    """
)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the rules, run as one automaton."""
    return urls.judge(load(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, URL_GLOBS).drop("url")


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(docs, usable=~language.held_out(F.col("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as wavelet matrices and read back from them."""
    import public_tokenizers

    encoder = tokenfiles.tokenizer_encoder(public_tokenizers.path("word_bpe_49k.json"))
    shards = tokenfiles.write(load(spark, sf_dir, "documents", "doc_id", "text"), encoder, end=1)
    return tokenfiles.digests(shards).withColumnRenamed("key", "doc_id")


@query(
    """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, d.vec_id,
            CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM usable q JOIN usable d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
        WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return topk.top_k(load(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 50 == 0)


@query()
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    found = mixing.mix(load(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate")


CONTROL_SQL = "|".join(c.replace("|", "\\|").replace("[", "\\[").replace("]", "\\]") for c in chat.CONTROLS)
SAMPLE_TURN = "</s>[INST] ok [/INST]"


@query(
    rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{SAMPLE_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{SAMPLE_TURN}'
    ), sized AS (
        SELECT *, role || chr(10) || text || chr(10) AS line,
            length(role || text) + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
                + len(regexp_extract_all(role || chr(10) || text, '{CONTROL_SQL}')) + {sum(map(len, chat.MARKS))} AS chars
        FROM turns
    ), told AS (
        SELECT conv_id, count(*) AS n_turns, string_agg(line, '' ORDER BY turn, role, text) AS all_text,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
        sha256(loss) AS loss_sha256, formatted_chars
    FROM told
    """
)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted as token ids and read back from them."""
    import public_tokenizers

    rows = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    sample = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(SAMPLE_TURN).alias("text"),
    )
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return chat.digests(chat.format_table(rows.unionByName(sample), vocabulary), vocabulary)


@query()
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 80 % common five-word shingles."""
    return jaccard.join(load(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next one are."""
    return spotsigs.stability(load(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("key", "doc_id")


@query()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode(load(spark, sf_dir, "documents", "doc_id", "text"), model)
    found = pieces.digests(pieces.decode(coded, model))
    return found.select(
        "doc_id",
        "n_tokens",
        "ids_crc32",
        F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
        F.coalesce(F.col("decoded") == F.col("text"), F.lit(True)).alias("round_trip"),
    )


@query(
    """
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
            sha256('1:' || doc_id) AS d
        FROM documents
    ), numbers AS (
        SELECT doc_id, t, tokens, CAST(len(tokens) AS BIGINT) AS n,
            list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h
        FROM drawn
    ), cuts AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM numbers
    ), parts AS (
        SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:n], '') AS s
        FROM cuts
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
    FROM parts
    """
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its form for filling in the middle, and the text restored from that."""
    made = infill.transform(load(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "fim.*")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query(
    """
    WITH paid AS (
        SELECT page_id, sha256(coalesce(html, '')) AS digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size FROM pages
    ), firsts AS (
        SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM paid
    )
    SELECT page_id, size AS payload_bytes, digest AS payload_digest,
        CASE WHEN size >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN size >= 100 AND page_id > first THEN first END AS refers_to
    FROM firsts
    """
)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of web archives, read back from them."""
    archives = warc.write(load(spark, sf_dir, "pages", "page_id", "url", "html"))
    found = warc.read(archives, with_payload=False)
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", warc.sound(found).alias("record_type"), "refers_to")


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents with the spelling it is a variant of."""
    return variants.group(variants.word_counts(load(spark, sf_dir, "documents", "doc_id", "text")))
