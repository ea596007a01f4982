"""Registered queries: chunking and embedding."""

from pyspark.sql import functions as F

from docvec.functions import maps, sql
from docvec.functions import text as tx
from docvec.operators import chunk, embed, sections
from docvec.plans.query_accounts import TOKENS
from docvec.plans.registry import query, table
from docvec.sources import documents

SIZE, OVERLAP = 500, 50


def docs(spark, sf):
    return documents.string_docs(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def chunked(spark, sf, chunks):
    rows = chunk.explode_chunks(docs(spark, sf), chunks)
    return rows.select("id", "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "content")


# ---------------------------------------------------------------- SQL for the same rules

WINDOWS = """
    SELECT doc_id || '_' || i AS id, doc_id::VARCHAR AS doc_id, i AS chunk_index,
           substr(text, i * {step} + 1, {size}) AS content
    FROM (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) <= {size} THEN 1
                 ELSE ((length(text) - {size} + {step} - 1) // {step}) + 1 END)) AS i
          FROM documents WHERE length(text) > 0)"""

STRIP = r"regexp_replace({0}, '^[\s\x1c-\x1f\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{3000}}]+|[\s\x1c-\x1f\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{3000}}]+\z', '', 'g')"

NUMBERED = """
    SELECT doc_id || '_' || (rn - 1) AS id, doc_id::VARCHAR AS doc_id, rn - 1 AS chunk_index, content
    FROM (SELECT doc_id, content, row_number() OVER (PARTITION BY doc_id ORDER BY {order}) AS rn
          FROM {source} WHERE content <> '')"""

# Walks the pieces of all texts in step, one piece each round: a piece joins the open chunk
# while it fits, else it opens the next one.
MERGED_LINES = (
    """WITH RECURSIVE p AS (
         SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ps FROM documents),
       w AS (
         SELECT doc_id, 1 AS i, 1 AS c, ps[1] AS open, ps FROM p WHERE len(ps) > 0
         UNION ALL
         SELECT doc_id, i + 1,
                CASE WHEN length(open) + 1 + length(ps[i + 1]) <= 500 THEN c ELSE c + 1 END,
                CASE WHEN length(open) + 1 + length(ps[i + 1]) <= 500 THEN open || chr(10) || ps[i + 1]
                     ELSE ps[i + 1] END, ps
         FROM w WHERE i < len(ps)),
       done AS (SELECT doc_id, c, """
    + STRIP.format("arg_max(open, i)")
    + " AS content FROM w GROUP BY doc_id, c)"
    + NUMBERED.format(order="c", source="done")
)

# The recursive rule by position: lines first; runs of short lines and the words of long
# lines are cut at the last border that fits, found from the text itself.
RECURSIVE = (
    r"""WITH RECURSIVE lines AS (
         SELECT doc_id, unnest(ps) AS line, unnest(range(1, len(ps) + 1)) AS n
         FROM (SELECT doc_id, regexp_extract_all(text, '\n[^\n]*|[^\n]+') AS ps FROM documents)),
       marked AS (
         SELECT *, length(line) >= 500 AS big,
                SUM(CASE WHEN length(line) >= 500 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS run
         FROM lines),
       groups AS (
         SELECT doc_id, MIN(n) AS n, 0 AS m, chr(10) AS sep, string_agg(line, '' ORDER BY n) AS body
         FROM marked WHERE NOT big GROUP BY doc_id, run
         UNION ALL
         SELECT doc_id, n, m, ' ', body FROM (
           SELECT doc_id, n, MIN(m) AS m, string_agg(word, '' ORDER BY m) AS body
           FROM (SELECT doc_id, n, m, word, SUM(CASE WHEN length(word) >= 500 THEN 1 ELSE 0 END)
                        OVER (PARTITION BY doc_id, n ORDER BY m) AS run
                 FROM (SELECT doc_id, n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS m
                       FROM (SELECT doc_id, n, regexp_extract_all(line, ' [^ ]*|[^ ]+') AS ws
                             FROM marked WHERE big)))
           WHERE length(word) < 500 GROUP BY doc_id, n, run)
         UNION ALL
         SELECT doc_id, n, m, '', word
         FROM (SELECT doc_id, n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS m
               FROM (SELECT doc_id, n, regexp_extract_all(line, ' [^ ]*|[^ ]+') AS ws FROM marked WHERE big))
         WHERE length(word) >= 500),
       w AS (
         SELECT doc_id, n, m, sep, 0 AS c, '' AS content, body AS rest FROM groups
         UNION ALL
         SELECT doc_id, n, m, sep, c + 1, substr(rest, 1, cut), substr(rest, cut + 1)
         FROM (SELECT *, CASE WHEN length(rest) <= 500 THEN length(rest) WHEN sep = '' THEN 500
                              ELSE 501 - strpos(reverse(substr(rest, 2, 500)), sep) END AS cut
               FROM w WHERE rest <> '')),
       done AS (SELECT doc_id, n, m, c, """
    + STRIP.format("content")
    + " AS content FROM w)"
    + NUMBERED.format(order="n, m, c", source="done")
)


# Pieces with their border positions; each round finds one chunk's first and last piece. A
# chunk reaches as far as it fits, and the following one starts as far back as the overlap
# and its first new piece allow.
OVERLAPPED = """
       sized AS (
         SELECT {key}, piece, i, SUM(length(piece) + {gap}) OVER (PARTITION BY {key} ORDER BY i) AS ends FROM pieces),
       lists AS (
         SELECT {key}, list(piece ORDER BY i) AS ps, list_prepend(0, list(ends::BIGINT ORDER BY i)) AS borders, count(*) AS n
         FROM sized GROUP BY {key}),
       w AS (
         SELECT {key}, ps, borders, n, 0 AS c, 0 AS s,
                least(n, greatest(1, len(list_filter(borders, lambda x: x <= 500 + {gap})) - 1)) AS e FROM lists
         UNION ALL
         SELECT {key}, ps, borders, n, c + 1, s,
                least(n, greatest(e + 1, len(list_filter(borders, lambda x: x <= borders[s + 1] + 500 + {gap})) - 1))
         FROM (SELECT {key}, ps, borders, n, c, e, least(e, greatest(s, len(list_filter(borders, lambda x: x <
                 greatest(borders[e + 1] - {gap} - 50, borders[e + 1] + length(ps[e + 1]) - 500))))) AS s FROM w WHERE e < n)),
       done AS (SELECT {key}, c, """ + STRIP.format("array_to_string(ps[s + 1:e], '{join}')") + " AS content FROM w)"

WORDS_OVERLAPPED = (
    """WITH RECURSIVE pieces AS (
         SELECT doc_id, unnest(ps) AS piece, unnest(range(1, len(ps) + 1)) AS i
         FROM (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS ps FROM documents)),"""
    + OVERLAPPED.replace("{key}", "doc_id").replace("{gap}", "1").replace("{join}", " ")
    + NUMBERED.format(order="c", source="done")
)

BLANK_OVERLAPPED = (
    """WITH RECURSIVE pieces AS (
         SELECT doc_id, unnest(ps) AS piece, unnest(range(1, len(ps) + 1)) AS i
         FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ps FROM documents)),"""
    + OVERLAPPED.replace("{key}", "doc_id").replace("{gap}", "2").replace("{join}", "\n\n")
    + NUMBERED.format(order="c", source="done")
)

# Groups of pieces as in RECURSIVE: runs of short lines, runs of short words of a long line,
# and the characters of a long word.
RECURSIVE_OVERLAPPED = (
    RECURSIVE[: RECURSIVE.index("groups AS (")]
    + r"""words AS (
         SELECT doc_id, n, m, word, length(word) >= 500 AS big,
                SUM(CASE WHEN length(word) >= 500 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, n ORDER BY m) AS run
         FROM (SELECT doc_id, n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS m
               FROM (SELECT doc_id, n, regexp_extract_all(line, ' [^ ]*|[^ ]+') AS ws FROM marked WHERE big))),
       pieces AS (
         SELECT doc_id, MIN(n) OVER (PARTITION BY doc_id, run) AS n, 0 AS m, n AS i, line AS piece FROM marked WHERE NOT big
         UNION ALL
         SELECT doc_id, n, MIN(m) OVER (PARTITION BY doc_id, n, run), m, word FROM words WHERE NOT big
         UNION ALL
         SELECT doc_id, n, m, unnest(range(1, length(word) + 1)), unnest(string_split(word, '')) FROM words WHERE big),"""
    + OVERLAPPED.replace("{key}", "doc_id, n, m").replace("{gap}", "0").replace("{join}", "")
    .replace("ps, borders, n,", "ps, borders, k,").replace("count(*) AS n", "count(*) AS k")
    .replace("least(n,", "least(k,").replace("WHERE e < n)", "WHERE e < k)")
    + NUMBERED.format(order="n, m, c", source="done")
)


@query(WINDOWS.format(size=SIZE, step=SIZE - OVERLAP))
def window_chunks(spark, sf):
    return chunked(spark, sf, chunk.window_chunks(F.col("content"), SIZE, OVERLAP))


@query(
    """WITH RECURSIVE w AS (
         SELECT doc_id, 0 AS c, '' AS content, text AS rest FROM documents
         UNION ALL
         SELECT doc_id, c + 1, substr(rest, 1, cut), substr(rest, cut + 1)
         FROM (SELECT *, CASE WHEN length(rest) <= 300 THEN length(rest)
                              WHEN strpos(reverse(substr(rest, 1, 300)), ' .') > 0
                              THEN 301 - strpos(reverse(substr(rest, 1, 300)), ' .')
                              ELSE 300 END AS cut
               FROM w WHERE rest <> ''))"""
    + NUMBERED.format(order="c", source="w")
)
def window_chunks_at_sentences(spark, sf):
    return chunked(spark, sf, chunk.window_chunks(F.col("content"), 300, 0, ". "))


@query(WINDOWS.format(size=SIZE, step=SIZE - OVERLAP))
def sql_chunks(spark, sf):
    """The same windows by SQL alone, through a table function."""
    sql.register(spark)
    return spark.sql(
        f"""SELECT concat(d.id, '_', c.chunk_index) AS id, d.id AS doc_id, CAST(c.chunk_index AS BIGINT) AS chunk_index, c.content
            FROM {{docs}} d, LATERAL window_chunks(d.content, {SIZE}, {OVERLAP}) c""",
        docs=docs(spark, sf),
    )


# Each sentence a line; of six lines the first is a heading, the third one below it, the fifth code.
@query(
    r"""WITH l AS (
            SELECT doc_id, unnest(ls) AS x, unnest(range(len(ls))) AS i
            FROM (SELECT doc_id, string_split(translate(text, chr(10) || chr(9) || chr(13) || '#`~', '   '), '. ') AS ls FROM documents)
        ), s AS (
            SELECT doc_id, i // 6 AS block, i % 6 >= 2 AS below,
                   string_agg(CASE WHEN i % 6 = 4 THEN '```' || chr(10) || '# ' || x || chr(10) || '```' ELSE x END, chr(10) ORDER BY i)
                     FILTER (i % 6 NOT IN (0, 2)) AS content
            FROM l GROUP BY ALL
        ), t AS (
            SELECT s.doc_id, block, below, trim(content, ' ' || chr(10)) AS content, trim(a.x) AS h1, trim(b.x) AS h2
            FROM s JOIN l a ON a.doc_id = s.doc_id AND a.i = block * 6 LEFT JOIN l b ON b.doc_id = s.doc_id AND b.i = block * 6 + 2 AND below
        )
        SELECT doc_id::VARCHAR AS doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block, below) - 1 AS section_index, content, h1, h2
        FROM t WHERE content <> ''"""
)
def markdown_sections(spark, sf):
    lines = F.split(F.translate("text", "\n\t\r#`~", "   "), r"\. ")

    def marked(x, i):
        at, code = i % 6, F.concat(F.lit("```\n# "), x, F.lit("\n```"))
        return F.when(at == 0, F.concat(F.lit("# "), x)).when(at == 2, F.concat(F.lit("## "), x)).when(at == 4, code).otherwise(x)

    rows = table(spark, sf, "documents", "doc_id", "text").withColumn("markdown", F.array_join(F.transform(lines, marked), "\n"))
    found = sections.explode_sections(documents.string_docs(rows, "doc_id", "markdown"))
    meta = F.col("metadata")
    return found.select(
        "doc_id", F.col("section_index").cast("bigint").alias("section_index"), "content", meta["Header 1"].alias("h1"), meta["Header 2"].alias("h2")
    )


@query(MERGED_LINES)
def char_chunks(spark, sf):
    return chunked(spark, sf, chunk.character_chunks(F.col("content"), separator="\n"))


@query(RECURSIVE)
def recursive_chunks(spark, sf):
    """Defaults. No text has a blank line, so the SQL starts at single line breaks."""
    return chunked(spark, sf, chunk.recursive_chunks(F.col("content")))


@query(RECURSIVE)
def recursive_chunks_at_lines(spark, sf):
    return chunked(spark, sf, chunk.recursive_chunks(F.col("content"), separators=("\n", " ", "")))


@query(RECURSIVE_OVERLAPPED)
def recursive_chunks_overlap(spark, sf):
    return chunked(spark, sf, chunk.recursive_chunks(F.col("content"), SIZE, OVERLAP))


@query(WORDS_OVERLAPPED)
def char_chunks_overlap(spark, sf):
    return chunked(spark, sf, chunk.character_chunks(F.col("content"), SIZE, OVERLAP, separator=" "))


@query(
    """SELECT doc_id || '_' || (i - 1) AS id, doc_id::VARCHAR AS doc_id, i - 1 AS chunk_index, ps[i] AS content
       FROM (SELECT doc_id, string_split(text, '. ') AS ps FROM documents) d,
            LATERAL (SELECT unnest(range(1, len(d.ps) + 1)) AS i)"""
)
def custom_chunks(spark, sf):
    return chunked(spark, sf, chunk.custom_chunks(F.col("content"), lambda text: text.split(". ")))


@query(BLANK_OVERLAPPED)
def char_chunks_at_blank_lines(spark, sf):
    """The default separator, in texts whose lines have blank ones between them."""
    spaced = docs(spark, sf).withColumn("content", F.replace("content", F.lit("\n"), F.lit("\n\n")))
    rows = chunk.explode_chunks(spaced, chunk.character_chunks(F.col("content"), SIZE, OVERLAP))
    return rows.select("id", "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "content")


ROUTED = """
    SELECT id, doc_id, chunk_index, content, 'en' AS lang FROM ({lines}) WHERE doc_id IN
        (SELECT doc_id::VARCHAR FROM documents WHERE lang = 'en')
    UNION ALL SELECT id, doc_id, chunk_index, content, 'other' FROM ({recursive}) WHERE doc_id NOT IN
        (SELECT doc_id::VARCHAR FROM documents WHERE lang = 'en')"""


@query(ROUTED.format(lines=MERGED_LINES, recursive=RECURSIVE))
def routed_chunks(spark, sf):
    """English documents ask for the character chunker at lines, the others for none or an unknown one."""
    english = F.col("lang") == "en"
    asked = F.when(
        english,
        maps.from_columns(
            {"chunker_name": F.lit("CharacterChunker"), "chunker_information": F.lit('{"separator": "\\n"}')}
        ),
    ).otherwise(maps.from_columns({"chunker_name": F.lit("markdownchunker")}))
    rows = documents.string_docs(
        table(spark, sf, "documents", "doc_id", "text", "lang"), "doc_id", "text", maps.merge(asked)
    ).withColumn(
        "lang", F.when(F.col("metadata")["chunker_name"] == "CharacterChunker", "en").otherwise("other")
    )
    return chunk.chunk_by_metadata(rows).select(
        "id", "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "content", "lang"
    )


@query(
    """SELECT role, conv_id, turn, ((row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) // 100) + 1 AS batch
       FROM conversations"""
)
def chunk_batches(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "role", "conv_id", "turn", (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("seq")
    )
    return embed.batches(rows, ["role"], "seq", 100).select("role", "conv_id", "turn", "batch")


@query(
    r"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\s\x1c-\x1f\x{85}\x{a0}\x{2028}\x{2029}\x{3000}]+'),
                                                   lambda x: x <> '') AS ws FROM documents)
        SELECT doc_id, CASE WHEN len(ws) <= 750 THEN text
                            WHEN len(ws) >= 1250 THEN array_to_string(ws[501:1250], ' ')
                            ELSE array_to_string(ws[len(ws) - 749:len(ws)], ' ') END AS content FROM w"""
)
def cut_text(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.cut_words(F.col("text")).alias("content"))


# ---------------------------------------------------------------- embedding

HASHED = r"""
    SELECT {key}, d, v / CASE WHEN len > 0 THEN len ELSE 1 END AS v FROM (
      SELECT {key}, d, coalesce(n, 0)::DOUBLE AS v,
             sqrt(SUM(coalesce(n, 0)::DOUBLE * coalesce(n, 0)) OVER (PARTITION BY {key})) AS len
      FROM (SELECT {key}, unnest(range(0, 64)) AS d FROM {source}) g
      LEFT JOIN (SELECT {key}, ('0x' || substr(md5(tok), 1, 8))::BIGINT % 64 AS d, count(*) AS n
                 FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS tok
                       FROM {source}) GROUP BY ALL) c
      USING ({key}, d))"""


@query(
    f"""SELECT doc_id::VARCHAR AS id, d AS position, round(v::FLOAT::DOUBLE, 5) AS value
        FROM ({HASHED.format(key='doc_id', text='text', source='documents')}) WHERE v > 0"""
)
def hash_embed(spark, sf):
    """The non-zero positions of each document's vector."""
    rows = docs(spark, sf).select("id", F.posexplode(embed.hash_embedder(F.col("content"))).alias("position", "v"))
    return rows.filter("v > 0").select(
        "id", F.col("position").cast("bigint").alias("position"),
        F.round(F.col("v").cast("double"), 5).alias("value"),
    )


@query(
    f"""SELECT doc_id::VARCHAR AS id, length(text)::DOUBLE AS v0, (length(text) - length(replace(text, ' ', '')))::DOUBLE AS v1,
               {TOKENS} AS prompt_tokens FROM documents"""
)
def embed_model(spark, sf):
    """A caller's model, here two plain measures of a text."""
    vector = embed.model_embedder(F.col("content"), lambda ts: [[len(t), t.count(" ")] for t in ts], dim=2)
    rows = embed.embed(docs(spark, sf), vector)
    return rows.select(
        "id",
        F.col("vector")[0].cast("double").alias("v0"),
        F.col("vector")[1].cast("double").alias("v1"),
        "prompt_tokens",
    )


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN length(text) % 7 <> 0 THEN length(text)::DOUBLE END AS v0, length(text) % 7 = 0 AS failed FROM documents")
def embed_failures(spark, sf):
    """A caller's model that sends vectors of a wrong size for some texts: these alone have no vector."""

    def model(texts):
        return [[len(t), 1.0][: 1 if len(t) % 7 == 0 else 2] for t in texts]

    rows = embed.embed(docs(spark, sf), embed.model_embedder(F.col("content"), model, dim=2, batch_size=10, strict=False))
    return rows.select("id", F.col("vector")[0].cast("double").alias("v0"), F.col("vector").isNull().alias("failed"))



@query(
    """SELECT role, (rn - 1) // 16 + 1 AS batch, count(*) AS items,
              md5(string_agg(text, '|' ORDER BY rn)) AS digest
       FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations)
       GROUP BY ALL"""
)
def embed_batches(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "role", "text", (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("seq")
    )
    found = embed.content_batches(rows, ["role"], "seq", "text", embed.REQUEST_BATCH["gateway"])
    return found.select("role", "batch", "items", F.md5(F.array_join("contents", "|")).alias("digest"))


@query(
    """WITH m(model, dflt, ovr, allowed) AS (VALUES ('text-embedding-3-small', 1024, true, [256, 512, 1024, 1536]),
              ('jina-v2-base', 768, false, [768]), ('text-embedding-ada-002', 1536, false, [1536]),
              ('text-embedding-3-large', 1024, true, [256, 1024, 3072])),
            r AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'text-embedding-3-small' WHEN 1 THEN 'jina-v2-base'
                  WHEN 2 THEN 'text-embedding-ada-002' WHEN 3 THEN 'text-embedding-3-large' ELSE 'other' END AS model,
                  CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 1024 WHEN 2 THEN 1536 ELSE 7 END AS requested FROM events)
       SELECT event_id, r.model, requested,
              CASE WHEN m.model IS NULL THEN 'unknown model' WHEN requested IS NULL THEN NULL
                   WHEN NOT ovr AND requested <> dflt THEN 'dimensions cannot be changed'
                   WHEN NOT list_contains(allowed, requested) THEN 'dimensions not supported' END AS error,
              CASE WHEN m.model IS NULL THEN NULL WHEN requested IS NULL THEN dflt
                   WHEN NOT ovr AND requested <> dflt THEN NULL
                   WHEN NOT list_contains(allowed, requested) THEN NULL ELSE requested END AS dims
       FROM r LEFT JOIN m ON r.model = m.model"""
)
def embed_dims(spark, sf):
    names = F.array(*[F.lit(m[0]) for m in embed.MODELS], F.lit("other"))
    asked = F.array(F.lit(None).cast("int"), F.lit(1024), F.lit(1536), F.lit(7))
    requests = table(spark, sf, "events").select(
        "event_id",
        names[(F.col("event_id") % 5).cast("int")].alias("model"),
        asked[(F.col("user_id") % 4).cast("int")].alias("dims"),
    )
    return embed.resolve_dims(requests, embed.models(spark))


@query(
    """SELECT d.doc_id::VARCHAR AS id, d.lang, round(e.embedding[1]::DOUBLE, 6) AS first
       FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id"""
)
def pair_by_id(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector")
    )
    paired = embed.pair_by_id(rows, vectors)
    return paired.select("id", "lang", F.round(F.col("vector")[0].cast("double"), 6).alias("first"))
