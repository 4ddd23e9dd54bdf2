"""The registered queries of this subpackage, and the same in DuckDB's SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm.decontaminate import benchmark_hits
from clicktide.llm.fingerprints import fingerprint_pairs
from clicktide.llm.jaccard import jaccard_components
from clicktide.llm.licenses import license_scan
from clicktide.llm.lines import drop_wide_lines
from clicktide.llm.negatives import hard_negatives
from clicktide.llm.packing import pack_documents
from clicktide.llm.search import ranked_search
from clicktide.llm.sharding import assign_shards
from clicktide.llm.simhash import hex_digits, simhash_components
from clicktide.llm.substrings import repeated_spans
from clicktide.llm.toxicity import HELD_OUT, fit_toxicity, fold_of, score_toxicity
from clicktide.llm.urls import url_filter

URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
#: A line on so many sites, in as many different texts, is boilerplate.
MIN_SITES = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    return hits.select(
        "doc_id", "n_words", "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score", F.array_join("expressions", ",").alias("expressions"), "freedom",
    )


def op3_repeated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash_components(_table(spark, sf_dir, "documents"))
    return linked.withColumn("fingerprint", hex_digits(F.col("fingerprint")))


def op5_line_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return drop_wide_lines(docs, min_sites=MIN_SITES).drop("source")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokens=1024)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rules).drop("url")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold_of("doc_id") == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return assign_shards(docs, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, _table(spark, sf_dir, "benchmark"), k=50)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", turned))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_repeated_text": op3_repeated_text,
    "op4_simhash": op4_simhash,
    "op5_line_sites": op5_line_sites,
    "op6_pack": op6_pack,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_lpt_shards": op9_lpt_shards,
    "op10_fingerprint": op10_fingerprint,
    "op11_ranked_search": op11_ranked_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_jaccard_join": op13_jaccard_join,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(column: str, apart: str = "\\x3A-\\x60") -> str:
    text = f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({text}, '[^\\x00-\\x2F{apart}\\x7B-\\x7F]+')"


#: ASCII that stands in no term of op11, besides what no word has.
_NOT_TERMS = "\\x3A-\\x40\\x5B-\\x60"
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, {_sql_words('text')} AS w FROM documents),
        items AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_sql_words('text')} AS w
            FROM benchmark),
        sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
        places AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
        patterns AS (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM places),
        spans AS (
            SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM patterns) WHERE len(w) >= n),
        hits AS (
            SELECT r, i, spans.n, item FROM spans
            JOIN patterns ON patterns.n = spans.n
                         AND patterns.p = array_to_string(w[i:i + spans.n - 1], ' ')),
        hit_words AS (
            SELECT r, count(DISTINCT j) AS n_hit
            FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r),
        hit_items AS (
            SELECT r, count(DISTINCT item) AS n_items,
                   string_agg(DISTINCT item, ',' ORDER BY item) AS names
            FROM hits GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)""",
    "op5_line_sites": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, * FROM documents),
        parts AS (SELECT r, source, text, string_split(text, chr(10)) AS lines FROM docs),
        lines AS (
            SELECT r, source, text, unnest(lines) AS line, unnest(range(len(lines))) AS nth FROM parts),
        normal AS (
            SELECT *, lower(trim(regexp_replace(line, '\\s+', ' ', 'g'))) AS norm FROM lines),
        wide AS (
            SELECT norm FROM normal WHERE norm <> ''
            GROUP BY norm HAVING count(DISTINCT coalesce(source, chr(0))) >= {MIN_SITES}
               AND count(DISTINCT text) >= {MIN_SITES}),
        marked AS (SELECT normal.*, wide.norm IS NOT NULL AS gone
                   FROM normal LEFT JOIN wide ON normal.norm = wide.norm),
        sums AS (
            SELECT r, count(*) AS n, count(*) FILTER (gone) AS n_gone,
                   string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone) AS rest
            FROM marked GROUP BY r)
        SELECT doc_id, coalesce(n, 0) AS n_lines,
               coalesce(n_gone, 0) AS n_removed,
               CASE WHEN n_gone > 0 THEN coalesce(rest, '') ELSE text END AS text
        FROM docs LEFT JOIN sums USING (r)""",
    "op7_url_filter": f"""
        WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
        rests AS (
            SELECT page_id, row_number() OVER () AS nth,
                   CASE WHEN contains(url, '://')
                        THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
        parts AS (
            SELECT page_id, nth,
                   translate(raw, '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM hosts),
        fitting AS (
            SELECT nth, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
            FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY nth)
        SELECT page_id, host, path, rule,
               coalesce(v, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN fitting USING (nth)""",
    "op11_ranked_search": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, {_sql_words('text', _NOT_TERMS)} AS w FROM documents),
        sizes AS (SELECT r, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
        sums AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM sizes),
        flat AS (SELECT r, unnest(w) AS term FROM docs),
        tfs AS (SELECT r, term, count(*) AS tf FROM flat GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs, sums GROUP BY term),
        items AS (
            SELECT row_number() OVER () AS i, item_id, list_distinct({_sql_words('text', _NOT_TERMS)}) AS w
            FROM benchmark),
        asked AS (SELECT i, item_id, unnest(w) AS term FROM items),
        scored AS (
            SELECT i, item_id, r, doc_id, CAST(sum(
                w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_all)))
            ) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), sums
            GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS nth
            FROM scored WHERE score > 0)
        SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= 50""",
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT a.r AS a, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT a, anchor_id, r AS p, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= 5),
        ranked AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY a, p ORDER BY score DESC, vec_id, r) AS nth
            FROM positives JOIN scored USING (a, anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE nth <= 10""",
    "op13_jaccard_join": f"""
        WITH RECURSIVE docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                      '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)])
                END AS s
            FROM docs),
        flat AS (SELECT r, unnest(s) AS shingle FROM sets),
        shared AS (
            SELECT a.r AS a, b.r AS b, count(*) AS n FROM flat a JOIN flat b USING (shingle)
            WHERE a.r <> b.r GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sets x ON x.r = a JOIN sets y ON y.r = b
            WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
        reach AS (
            SELECT a, b FROM links
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a AS r, min(doc_id) AS reached FROM reach JOIN sets ON sets.r = b GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, least(doc_id, reached) AS component_id
        FROM sets LEFT JOIN least USING (r)""",
}
