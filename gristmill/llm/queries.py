"""Registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import (
    attribution,
    bpe,
    decontaminate,
    langid,
    neardup,
    periodicity,
    phrases,
    pii,
    rules,
    secrets,
    sharding,
    toxicity,
    warc_zst,
)
from gristmill.llm.common import fold, held_out, table

COUNT_RANKS = "byte_bpe_50k.tiktoken"
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles, learnt from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    by_lang = langid.profiles(docs.where(fold(F.col("doc_id")) != 0), "text", "lang")
    return (
        docs.select("doc_id", "text")
        .withColumn("found", langid.predict(F.col("text"), by_lang))
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the multi-language ranks, and the text back from them."""
    import public_tokenizers

    vocabulary = bpe.Vocabulary(
        spark, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary, keep=["doc_id"]).select(
        "doc_id",
        F.size("bpe.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the language is the stratum of the cutoffs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = rules.judge(docs, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"m.{c}" for c in counts], "base_failed", "kept")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by links of four-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, words=4)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: basic spans, and those the classifier adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.summary(pii.scan(docs))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark items in the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with the corpus-wide verdict on each value."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return secrets.summary(secrets.scan(docs))


def op8_warc_zst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive and back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")

    def page(column: str):
        return F.regexp_extract(column, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    return warc_zst.round_trip(pages).select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to_id").alias("refers_to"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token belongs to the line it starts in."""
    import public_tokenizers

    encoder = attribution.Encoder(
        spark, public_tokenizers.path(COUNT_RANKS), public_tokenizers.PATTERN
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = attribution.section_counts(docs, encoder)
    return counted.select(
        "doc_id", "section", "start", "end", F.col("tokens").cast("long").alias("n_tokens")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by compression distance."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        model.score(F.col("text")).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, equal texts together as far as even shards allow."""
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one in ten of which is made to repeat itself."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = periodicity.planted(F.col("doc_id"), F.col("text"))
    return periodicity.digest(periodicity.scan(docs.select("doc_id", text.alias("text"))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_personal_data": op5_personal_data,
    "op6_decontamination": op6_decontamination,
    "op7_secrets": op7_secrets,
    "op8_warc_zst": op8_warc_zst,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_sharding": op11_sharding,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op8_warc_zst": """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
               FROM pages),
    a AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS r
          FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN r <> page_id THEN r END AS refers_to
    FROM a""",
    # Runs of twelve words or more hold six words in a row that equal those one period on.
    "op12_periodic_runs": r"""
    WITH t AS (SELECT list_reduce(list_prepend(k, range(8)),
                        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v, k
               FROM range(256) r(k)),
    crc_table AS (SELECT list(v ORDER BY k) AS v FROM t),
    d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'),
                                     lambda w: w <> '') AS given,
                 xor(list_reduce(list_prepend(4294967295, list_transform(
                         string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                     lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1])), 4294967295) AS h
          FROM documents, crc_table),
    p AS (SELECT *, len(given) AS n, h // 10 AS g,
                 CASE WHEN len(given) > 0 THEN (h // 10) % len(given) ELSE 0 END AS a FROM d),
    q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM p),
    docs AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                 THEN list_transform(range(n), lambda i: given[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
                 ELSE given END AS w FROM q),
    -- Spread before grams are made, as a list operation walks its whole list.
    spread AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM docs),
    grams AS (SELECT doc_id, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
                                     lead(word, 4) OVER o, lead(word, 5) OVER o) AS six,
                     lead(word, 5) OVER o IS NOT NULL AS whole
              FROM spread WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y
              ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i WHERE x.whole AND y.whole),
    islands AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e
                FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS gap FROM pairs)
                GROUP BY doc_id, q, gap),
    runs AS (SELECT doc_id, s, e, min(q) AS q FROM islands WHERE e - s >= greatest(12, 2 * q)
             GROUP BY doc_id, s, e),
    listed AS (SELECT doc_id, count(*) AS n_runs,
                      sha256(string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256,
                      min({'l': s - e, 's': s, 'q': q}) AS best
               FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS plain
             FROM spread ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period,
           (-1000 * best.l) // best.q AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
           sha256(coalesce(plain, '')) AS collapsed_sha256
    FROM docs LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_collocations": r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
    f AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
          FROM starts, range(1, 6) r(size) WHERE i + size - 1 <= len(words) GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
    often AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE f >= 100),
    cuts AS (SELECT lang, phrase, words, size, f, k, array_to_string(words[1:k], ' ') AS head,
                    array_to_string(words[k + 1:size], ' ') AS tail
             FROM often, range(1, 5) r(k) WHERE k < size),
    scores AS (SELECT c.lang, c.phrase, c.words, c.size, c.f AS a, l.f AS l, r.f AS r, n, k,
                      ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
               FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = head
               JOIN often r ON r.lang = c.lang AND r.phrase = tail JOIN total t ON t.lang = c.lang),
    one AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (SELECT lang, array_to_string(words[s:e], ' ') AS phrase, f
               FROM often, range(1, 6) x(s), range(1, 6) y(e) WHERE s <= e AND e <= size AND e - s + 1 < size),
    most AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank",
           phrase, a, l, r, n, score
    FROM one LEFT JOIN most m USING (lang, phrase) WHERE m.f IS NULL OR 100 * m.f < 100 * a
    QUALIFY "rank" <= 2000""",
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
