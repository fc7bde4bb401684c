"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.llm import (
    chat,
    decontamination,
    packing,
    periodic_runs,
    quality,
    simhash,
    spelling,
    suffix,
    token_counts,
    token_files,
    topk,
    toxicity,
    warc,
)
from studymart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    """Documents and the benchmark items they hold."""
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), added=packing.added_tokens())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: A conversation whose texts look like control strings.
_CONTROL_CASE = """
    SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
    AS t(conv_id, turn, role, text)"""


def op3_chat(spark, sf_dir):
    """Digests of all conversations and of the control case, read back from their formatted strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat.turn_events(rows.unionByName(spark.sql(_CONTROL_CASE)))
    back = chat.read_back(chat.render(chat.final_messages(log)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("turns.loss_text", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_topk(spark, sf_dir):
    """The 20 best vectors for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_token_counts(spark, sf_dir):
    """Words and word pieces of all documents."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    """Fingerprint and group of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_quality(spark, sf_dir):
    """Evidence, site posteriors and verdict for all documents."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark, sf_dir):
    """All pages, written to archives and read back."""
    folder = scratch_path(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark, sf_dir):
    """Toxicity of all documents, learned from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "n_windows", "n_near")


def op10_suffix(spark, sf_dir):
    """What all documents lose to 100-byte strings that start earlier."""
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_spelling(spark, sf_dir):
    """Near words, form and root of the words of all documents, with variants planted by document and word."""
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), altered=spelling.planted_variants)
    return spelling.variants(counts)


def _repeat_from_somewhere(doc: int | None, words: list) -> list:
    """In a tenth of the documents, the words from some place on repeat the first of them."""
    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    unit = words[at : at + period]
    return words[:at] + (unit * -(-(n - at) // period))[: n - at]


def op12_periodic_runs(spark, sf_dir):
    """Digests of the runs of all documents, their longest run by periods, and the text without repeats."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), altered=_repeat_from_somewhere)
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    line = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")

    def more(a, b):  # the runs come by start, then period
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(a["period"].isNull() | (right > left), b).otherwise(a)

    none = F.struct(*(F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")))
    best = found.withColumn("best", F.aggregate("runs", none, more))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_token_files(spark, sf_dir):
    """All documents as they are read back from the files of their token ids."""
    folder = scratch_path(spark, "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    rows = token_files.read_token_files(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_chat": op3_chat,
    "op4_topk": op4_topk,
    "op5_token_counts": op5_token_counts,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_suffix": op10_suffix,
    "op11_spelling": op11_spelling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_files": op13_token_files,
}

#: DuckDB text for the queries that SQL can express.
ORACLES = {
    "op1_decontamination": """
        WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
                   FROM documents),
        b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
              FROM benchmark),
        k AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
        ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
               FROM d JOIN k ON len(w) >= k, unnest(range(1, len(w) - k + 2)) AS t(i)),
        bs AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, array_to_string(w[i:i + 4], ' ') AS s
               FROM b, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
        m AS (SELECT doc_id, item_id, count(*) AS n_matched FROM ds JOIN bs USING (k, s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shingles, n_matched, n_matched / n_shingles AS containment
        FROM m JOIN n USING (item_id) WHERE n_matched >= ceil(n_shingles * 0.8 - 1e-9)""",
    "op3_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
            FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES
                  (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
        e AS (
            SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g') AS shown,
                   regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g') AS actor
            FROM c),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
                   coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS loss,
                   sum(length(actor) + length(shown) + 16
                       + CASE WHEN role = 'assistant' THEN 4 ELSE 13 END)::BIGINT AS formatted_chars
            FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op4_topk": """
        WITH q AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
    "op8_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
        f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
              FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
}
