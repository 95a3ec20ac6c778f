"""The operators bound to the test tables: name -> query, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, collocations, hpylm, jaccard, licenses, pii, ppm, pstable, raking, sharding, spotsigs, variants, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded by the multilingual vocabulary and decoded again, as digests."""
    return bpe.tokenize(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
        keep=["doc_id"],
    )


@query()
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the texts and labels outside the held-out fold."""
    documents = table(spark, folder, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = ppm.fit(documents.filter(fold != 0))
    held_out = F.coalesce(fold == 0, F.lit(True)).alias("held_out")  # nothing is learned from a row without an id
    return ppm.predict(documents, model, keep=[F.col("doc_id"), held_out])


@query("""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
named AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response_id FROM sized)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND response_id IS DISTINCT FROM page_id AND response_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND response_id IS DISTINCT FROM page_id THEN response_id END AS refers_to
FROM named
""")
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back by byte ranges."""
    records = warc.read_archives(warc.write_archives(table(spark, folder, "pages")), range_bytes=4 << 20, whole=True)

    def page(column: str):  # null where the record is of a row without an id
        return F.regexp_extract(column, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query("""
WITH RECURSIVE unit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN counted ON vec_id = counted.a
""")
def op1_vector_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label at cosine 0.93 or more, with their groups."""
    return pstable.near_duplicates(table(spark, folder, "embeddings"))


#: Per document its distinct five-word shingles (fewer words: all of them as one); A-Z in lower case.
SHINGLES = r"""
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
         lambda w: w <> '') AS words FROM documents WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes m ON a.doc_id = m.doc_id JOIN sizes n ON b.doc_id = n.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
"""


@query(f"""
WITH RECURSIVE {SHINGLES}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON d.doc_id = c.a
LEFT JOIN sizes s ON d.doc_id = s.doc_id
""")
def op2_shingle_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that share three quarters of their shingles, as components."""
    return jaccard.similar_sets(table(spark, folder, "documents"))


@query()
def op4_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited copy, with their likeness."""
    return spotsigs.edited_likeness(table(spark, folder, "documents"))


@query()
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and digest of the strict spans, and all spans."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    told = pii.find(documents, drop=["text"])
    strict = F.filter("pii_spans", lambda x: x["base"])
    kinds = F.transform(strict, lambda x: x["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)
    ]
    digest = F.sha2(F.encode(pii.printed(strict), "UTF-8"), 256)
    return told.select("doc_id", *counts, digest.alias("base_sha256"), pii.printed(F.col("pii_spans")).alias("spans"))


def raked_sql(sweeps: int = 40, temper: float = raking.TEMPER, seed: int = 7) -> str:
    """The mixing query in SQL: as many sweeps as surely suffice, each a step of its own."""
    dims = ("source", "lang", "topic")
    has = lambda *parts: "(" + " OR ".join(f"contains(t, '{p}')" for p in parts) + ")"
    steps = [
        f"""rows AS (
  SELECT doc_id, source, lang, coalesce('=' || source, '-') AS d_source, coalesce('=' || lang, '-') AS d_lang,
         CAST(len(list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS n_tokens,
         '=' || CASE WHEN t = '' THEN 'empty' WHEN {has("icense", "ICENSE", "opyright", "ights reserved")} THEN 'legal'
           WHEN {has(" | ")} THEN 'table' WHEN {has("%%%", "###", "$$$", "&&&", "***")} THEN 'noise'
           WHEN {has("!!")} THEN 'shouting' WHEN {has("@", "+1 (")} THEN 'contact' ELSE 'prose' END AS d_topic,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), t)), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""".replace("\\\\", "\\"),
        "cells AS (SELECT d_source, d_lang, d_topic, sum(n_tokens) AS tokens FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for d in dims:
        steps.append(
            f"t_{d} AS (SELECT d_{d}, pow(CAST(sum(tokens) AS DOUBLE), {temper})"
            f" / sum(pow(CAST(sum(tokens) AS DOUBLE), {temper})) OVER () AS share_{d} FROM cells GROUP BY d_{d})"
        )
    joins = " ".join(f"JOIN t_{d} USING (d_{d})" for d in dims)
    steps.append(f"w0 AS (SELECT *, CAST(tokens AS DOUBLE) AS w FROM cells {joins})")
    for i in range(sweeps * len(dims)):
        d = dims[i % len(dims)]
        steps.append(f"w{i + 1} AS (SELECT * REPLACE (w * share_{d} / sum(w) OVER (PARTITION BY d_{d}) AS w) FROM w{i})")
    steps.append(f"final AS (SELECT *, w / tokens * sum(tokens) OVER () AS ratio FROM w{sweeps * len(dims)})")
    steps.append("top AS (SELECT max(ratio) AS most FROM final)")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, source, lang, substr(d_topic, 2) AS topic, n_tokens,
       round(CASE WHEN n_tokens > 0 THEN ratio ELSE 0 END, 6) AS weight,
       round(CASE WHEN n_tokens > 0 THEN ratio / most ELSE 0 END, 6) AS probability,
       CASE WHEN n_tokens > 0 AND (ratio / most >= 1 OR u < ratio / most) THEN 1 ELSE 0 END AS copies
FROM rows LEFT JOIN final USING (d_source, d_lang, d_topic) CROSS JOIN top"""


@query(raked_sql())
def op10_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight and sampling decision under tempered source, language and format marginals."""
    documents = table(spark, folder, "documents").withColumn("topic", raking.format_of(F.col("text")))
    marginals = {d: F.col(d) for d in ("source", "lang", "topic")}
    mixed = raking.mix(documents, marginals, drop=["text", "n_chars"])
    return mixed.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


@query()
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families named in every document."""
    documents = table(spark, folder, "documents")
    found = licenses.scan(documents, licenses.fit(documents), keep=["doc_id"])
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "n_notices")


@query()
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log-probability under a model learned from the documents outside the held-out fold."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return hpylm.score(table(spark, folder, "documents"), held_out)


@query()
def op11_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in random order, written as eight shards of equal numbers of records and read back."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    written = sharding.write_shards(documents, 8, sharding.text_bytes("text"))
    return written.select(
        "doc_id",
        (sharding.text_bytes("text") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def collocations_sql(longest: int = 5, threshold: int = 100, top: int = 2000) -> str:
    """The phrase query in SQL: all n-grams of all pieces, counted."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
  FROM pieces, range(1, {longest + 1}) AS sizes(size) WHERE len(words) >= size),
known AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {threshold}),
cuts AS (
  SELECT lang, size, phrase, f, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words FROM known WHERE size >= 2),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.f AS a, h.f AS l, t.f AS r, n, k,
         (1000 * CAST(c.f AS HUGEINT) * n) // (CAST(h.f AS HUGEINT) * t.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN known h ON h.lang = c.lang AND h.phrase = array_to_string(words[1:k], ' ')
  JOIN known t ON t.lang = c.lang AND t.phrase = array_to_string(words[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, unnest([array_to_string(string_split(phrase, ' ')[1:size - 1], ' '),
                                array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS phrase, f AS a
  FROM known WHERE size >= 3)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best ANTI JOIN inside USING (lang, phrase, a)
QUALIFY rank <= {top}"""


@query(collocations_sql())
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of every language that hold together most."""
    return collocations.collocations(table(spark, folder, "documents"))


@query()
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the form that each may be a misspelling of."""
    return variants.spelling_variants(table(spark, folder, "documents"))
