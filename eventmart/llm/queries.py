"""Queries over the corpus tables, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    collocations,
    ego_join,
    jaccard_join,
    line_dedup,
    maxscore,
    mixing,
    pii_crf,
    piece_codec,
    quality_rules,
    secret_scan,
    suffix_dedup,
    toxicity,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@_query(
    """
    WITH RECURSIVE usable AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
      SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reached(id, other) AS (
      SELECT vec_id, vec_id FROM embeddings
      UNION
      SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other
    ), counted AS (
      SELECT x, count(*) AS n FROM links GROUP BY x
    )
    SELECT r.id AS vec_id, coalesce(max(c.n), 0)::BIGINT AS n_links,
           min(r.other) AS component_id, r.id = min(r.other) AS kept
    FROM reached r LEFT JOIN counted c ON c.x = r.id GROUP BY r.id
    """
)
def op1_ego_join(spark, sf_dir):
    return ego_join.near_duplicates(_read(spark, sf_dir, "embeddings"))


@_query(
    r"""
    WITH lines AS (
      SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
    ), places AS (
      SELECT doc_id, pos, l[pos + 1] || chr(10) || l[pos + 2] || chr(10) || l[pos + 3] AS w
      FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM lines)
    ), later AS (
      SELECT doc_id, pos FROM (
        SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth
        FROM places WHERE regexp_matches(w, '[^\x20\x09-\x0D]'))
      WHERE nth > 1
    ), covered AS (
      SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest([0, 1, 2]) AS k)
    ), marked AS (
      SELECT u.doc_id, u.pos, u.line, c.pos IS NOT NULL AS gone
      FROM (SELECT doc_id, unnest(range(0, len(l))) AS pos, unnest(l) AS line FROM lines) u
      LEFT JOIN covered c ON u.doc_id = c.doc_id AND u.pos = c.pos
    )
    SELECT d.doc_id,
           CASE WHEN d.text IS NULL THEN NULL
                ELSE coalesce(string_agg(m.line, chr(10) ORDER BY m.pos)
                              FILTER (WHERE NOT m.gone), '') END AS text,
           count(m.pos)::BIGINT AS n_lines,
           count(*) FILTER (WHERE m.gone)::BIGINT AS n_removed
    FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
    GROUP BY d.doc_id, d.text
    """
)
def op2_line_dedup(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@_query()
def op3_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.repeated_spans(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["words"]).alias("n_words"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
        .alias("spans"),
    )


def _spans(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id",
        *[secret_scan.counted("base_spans", k).alias(f"n_{k}") for k in kinds],
        F.sha2(secret_scan.joined("base_spans"), 256).alias("base_sha256"),
        secret_scan.joined("spans").alias("spans"),
    )


@_query()
def op4_secret_scan(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return _spans(secret_scan.scan(docs), secret_scan.KINDS)


@_query()
def op6_pii_crf(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return _spans(pii_crf.scan(docs), pii_crf.KINDS)


@_query()
def op9_toxicity(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, grammar).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


@_query()
def op5_sentencepiece(spark, sf_dir):
    coded = piece_codec.round_trip(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


@_query()
def op7_quality_rules(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.train(docs, _read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).drop("text")


@_query(
    r"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT
               AS size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 7))::BIGINT AS h
      FROM documents
    ), sources AS (
      SELECT source, source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
               WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
    ), levels AS (
      SELECT *, row_number() OVER o AS nth,
        (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (
            o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / (2 * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
          AS level
      FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
    ), met AS (
      SELECT nth AS nth0, level AS height FROM levels WHERE level * weight <= 2 * source_size
      ORDER BY nth LIMIT 1
    ), targets AS (
      SELECT source, source_size,
             CASE WHEN nth < nth0 THEN (2 * source_size)::DOUBLE ELSE height * weight END AS target,
             ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 7))::BIGINT::DOUBLE
               / 268435456.0::DOUBLE AS u
      FROM levels, met
    ), numbered AS (
      SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY s.source
                                ORDER BY s.size, s.h, s.doc_id NULLS FIRST) AS k
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           least(floor(k * rate + u) - floor((k - 1) * rate + u), 2)::BIGINT AS copies,
           least(floor(k * rate + u) - floor((k - 1) * rate + u), 2)::BIGINT * size AS taken
    FROM numbered
    """
)
def op8_mixing(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).drop("text", "source")


@_query(
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), shingles AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:least(i + 4, len(w))], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
            FROM words WHERE len(w) > 0)
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), links AS (
      SELECT a.doc_id AS x, b.doc_id AS y
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
      JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, p.n, q.n
      HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
    ), reached(id, other) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other
    )
    SELECT d.doc_id, coalesce(max(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN reached r ON r.id = d.doc_id GROUP BY d.doc_id
    """
)
def op10_ngram_jaccard(spark, sf_dir):
    return jaccard_join.near_duplicates(_read(spark, sf_dir, "documents"))


@_query(
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(string_split_regex(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ), worded AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), places AS (
      SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), counted AS (
      SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
      FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS m)
      WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
    ), totals AS (
      SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang
    ), candidates AS (
      SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m >= 2
    ), cuts AS (
      SELECT c.lang, c.phrase, c.a, t.n, k, x.f AS l, y.f AS r,
             (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
      FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
      JOIN totals t ON t.lang = c.lang
      JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
      JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
    ), held AS (
      SELECT DISTINCT lang, array_to_string(w[i:j], ' ') AS phrase, a
      FROM (SELECT *, unnest(range(i + 1, m + 1)) AS j
            FROM (SELECT *, unnest(range(1, m)) AS i FROM candidates))
      WHERE j - i + 1 < m
    ), lowest AS (
      SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM lowest o
      WHERE NOT EXISTS (SELECT 1 FROM held h
                        WHERE h.lang = o.lang AND h.phrase = o.phrase AND h.a >= o.a)
    )
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked WHERE rank <= 2000
    """
)
def op11_collocations(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("text", "lang")
    return collocations.top_phrases(docs)


@_query(
    """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), scores AS (
      SELECT q.vec_id AS query_id, d.vec_id,
             list_inner_product(q.x::DOUBLE[], d.x::DOUBLE[])::BIGINT AS score
      FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.x) = len(d.x)
      WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scores)
    WHERE rank <= 5
    """
)
def op12_maxscore(spark, sf_dir):
    return maxscore.search(_read(spark, sf_dir, "embeddings"))


@_query()
def op13_whitening(spark, sf_dir):
    white = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))
