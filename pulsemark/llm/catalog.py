"""The queries of the training-text operators, over the whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemark.llm import (
    alignment, chat, decontaminate, langid, lines, lm, lz_print, ngram_join, periods, quality, spiece, token_counts, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(column: str, m: int):
    """crc32 of a column as text modulo m; 0 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % m, F.lit(0))


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-bilinear and unigram scores of every document, learned from those that are not held out."""
    docs = _table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), (remainder("doc_id", 7) == 2).alias("held_out"), "text")
    return lm.score_texts(docs).withColumnRenamed("id", "doc_id")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document, the digest of their ids, and whether decoding gives the text back."""
    docs = _table(spark, folder, "documents").withColumn("_sha", F.sha2(F.col("text"), 256))
    coded = spiece.encode(docs, ["doc_id", "_sha"])
    return coded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("piece_ids", " "), 256).alias("pieces_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.sha2(F.col("decoded"), 256) == F.coalesce("_sha", F.sha2(F.lit(""), 256))).alias("round_trip"))


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from the labels: 0 toxic, 1 not toxic but of low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality")).alias("grade"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and tail probabilities of every document, and whether it is rather good than not."""
    docs = _table(spark, folder, "documents")
    model = quality.fit(docs, grades(_table(spark, folder, "labels")), top=2)
    return quality.grade(docs, model, ["doc_id"]).withColumn("keep", F.col("p_at_least_2") >= 0.5)


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the two thirds that are not held out."""
    docs = _table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 3) == 1)
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op5_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared with each other and the next one's."""
    docs = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return lz_print.fingerprints_with_next(docs).withColumnRenamed("id", "doc_id")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words, word pieces and unknown words of every document."""
    return token_counts.count_tokens(_table(spark, folder, "documents"), ["doc_id"])


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from every formatted conversation, and from one that says the control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    table = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.check_format(table.union(extra))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item within the edit budget, one row per document and item."""
    docs = _table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return decontaminate.find_leaks(docs, _table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document among links of Jaccard similarity 0.8 over 5-word shingles."""
    return ngram_join.near_components(_table(spark, folder, "documents"), n=5, percent=80)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and dropped lines of every document, and the digest of what is left of its text."""
    kept = lines.drop_recurring(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("text_sha256"))


#: Documents of at least this probability are predicted to be toxic.
TOXIC = 0.3


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probability that a document is toxic, learned from labels of those that are not held out."""
    docs = _table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    model = toxicity.fit(docs, _table(spark, folder, "labels").where(remainder("doc_id", 4) != 2))
    graded = toxicity.grade(docs, model, ["doc_id", "held_out"])
    return graded.select(
        "doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["id"].cast("long")).alias("nearest"), "terms")


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document, scored by counts of the corpus."""
    found = alignment.aligned(_table(spark, folder, "documents"), ["doc_id"])
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return alignment.with_link_counts(found.withColumn("groups_sha256", digest).drop("groups"))


def looped(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) in which every tenth id's text, by hash, ends in a loop of its own words.

    With h = crc32(doc_id as text) and g = h div 10, words from a = g mod n on become the p words from a on, again
    and again, with p = 1 + (n - a) div (3 + g mod 8). Rows with a null id keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), found.alias("w"))
    sized = split.withColumn("n", F.when(F.size("w") > 0, F.size("w"))).withColumn("a", F.expr("int(g % n)"))
    placed = sized.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    loop = F.expr("flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p))))")
    new = F.array_join(F.concat(F.expr("slice(w, 1, a)"), F.slice(loop, F.lit(1), F.expr("n - a"))), " ")
    return placed.select("doc_id", F.when(F.col("n").isNull(), F.col("text")).otherwise(new).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, the longest one, and what is left without the repeats."""
    docs = looped(_table(spark, folder, "documents"))
    found = periods.find_runs(docs, ["doc_id"])
    rows = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"),
        best["length"].alias("length"), (-best["period"]).alias("period"),
        F.floor(-1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(rows, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_lm_scoring, op2_sentencepiece, op3_quality_classifier, op4_language_id, op5_lz_fingerprint,
    op6_token_counts, op7_chat_format, op8_decontamination, op9_ngram_jaccard_join, op10_line_dedup,
    op11_toxicity, op12_tokenizer_alignment, op13_periodic_runs,
)}

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"""

ORACLE: dict[str, str] = {
    "op9_ngram_jaccard_join": f"""
        WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        items AS (SELECT doc_id, unnest(s) AS g FROM sets),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM sizes
            UNION
            SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT s.doc_id, s.n AS n_shingles, m.component_id
        FROM sizes s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
    """,
    "op10_line_dedup": """
        WITH raw AS (
            SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k_
            FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
        clean AS (SELECT doc_id, k_, line, trim(translate(line, chr(9) || chr(13), '  '), ' ') AS c FROM raw),
        masked AS (SELECT doc_id, k_, line, regexp_replace(c, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM clean),
        placed AS (
            SELECT *, len(t) AS size, CASE WHEN len(t) > 4 THEN {'n': len(t), 'h': t[1:4]} END AS leaf
            FROM (SELECT doc_id, k_, string_split_regex(m, ' +') AS t FROM masked WHERE m <> '')),
        sentences AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(string_split_regex(text, '[.' || chr(10) || '] ?')) AS s FROM documents)
            WHERE s <> ''),
        often AS (SELECT s FROM sentences GROUP BY s HAVING count(*) >= 3),
        copies AS (
            SELECT doc_id FROM sentences LEFT JOIN (SELECT s, true AS o FROM often) USING (s) GROUP BY doc_id
            HAVING 2 * sum(CASE WHEN o THEN length(s) ELSE 0 END) >= sum(length(s))),
        held AS (SELECT DISTINCT doc_id, t, leaf, size FROM placed),
        leaves AS (
            SELECT leaf FROM held WHERE leaf IS NOT NULL GROUP BY leaf HAVING count(*) >= 3 AND count(DISTINCT t) > 1),
        lines AS (SELECT t, leaf, size, count(*) AS docs FROM held SEMI JOIN leaves USING (leaf) GROUP BY ALL),
        fields AS (SELECT t, leaf, size, docs, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM lines),
        votes AS (SELECT leaf, pos, token FROM fields GROUP BY ALL HAVING sum(docs) >= 3),
        stay AS (SELECT *, count(*) OVER (PARTITION BY leaf, pos) AS kinds FROM votes QUALIFY kinds <= 8),
        general AS (
            SELECT t, leaf, list(CASE WHEN s.token IS NULL THEN '<*>' ELSE 'is ' || f.token END ORDER BY f.pos) AS names
            FROM fields f LEFT JOIN stay s USING (leaf, pos, token) GROUP BY t, leaf, size
            HAVING count(s.token) >= 0.6 * size),
        named AS (
            SELECT p.doc_id, p.k_, CASE WHEN g.t IS NULL THEN ['line', p.t::VARCHAR]
                ELSE list_concat(['leaf'], g.names) END AS template
            FROM placed p LEFT JOIN general g ON p.t = g.t),
        recurring AS (
            SELECT template FROM named LEFT JOIN (SELECT doc_id, true AS copy FROM copies) USING (doc_id)
            GROUP BY template
            HAVING count(DISTINCT CASE WHEN copy IS NULL THEN doc_id END) >= 3
                AND 10 * count(DISTINCT CASE WHEN copy IS NULL THEN doc_id END) >= count(DISTINCT doc_id)),
        dropped AS (SELECT doc_id, k_ FROM named SEMI JOIN recurring USING (template)),
        kept AS (
            SELECT r.doc_id, count(*) AS n_lines, count(d.k_) AS n_dropped,
                string_agg(CASE WHEN d.k_ IS NULL THEN r.line END, chr(10) ORDER BY r.k_) AS text
            FROM raw r LEFT JOIN dropped d ON r.doc_id = d.doc_id AND r.k_ = d.k_ GROUP BY r.doc_id)
        SELECT o.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
            CASE WHEN o.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS text_sha256
        FROM documents o LEFT JOIN kept k USING (doc_id)
    """,
    "op7_chat_format": """
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (
            SELECT *, length(text)
                + len(regexp_extract_all(text, '\\\\|</?s>|\\[/?INST\\]|<</?SYS>>|<</?ROLE>>')) AS n,
                length(role)
                + len(regexp_extract_all(role, '\\\\|</?s>|\\[/?INST\\]|<</?SYS>>|<</?ROLE>>')) AS r
            FROM said)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                AS loss_sha256,
            sum(n + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15
                ELSE r + 21 END)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
}
