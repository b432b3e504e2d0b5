"""The registered queries of the corpus operators: (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medclaims.llm import (
    decontamination,
    exact_dedup,
    language_id,
    licences,
    minhash_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    spelling_variants,
    substring_dedup,
    vector_codes,
)
from medclaims.llm.common import share_package
from medclaims.llm.tokenizers_path import tokenizer_path

SHARDS = [1.0] * 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(run: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(_table(spark, sf_dir, "documents"))


def _with_labels(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": _over_documents(lambda docs: substring_dedup.remove_repeats(docs).drop("spans")),
    "op2_language_id": _over_documents(
        lambda docs: language_id.label_documents(docs).selectExpr("doc_id", "held_out", "lang_pred", "score", "size(spans) AS n_spans")
    ),
    "op3_minhash_dedup": _over_documents(minhash_dedup.near_groups),
    "op4_quality_rules": _with_labels(quality_rules.judge),
    "op5_mixing": _over_documents(mixing.mix_tokens),
    "op6_quality_classifier": _with_labels(quality_classifier.classify),
    "op7_sharding": _over_documents(lambda docs: sharding.shard_rows(docs, SHARDS)),
    "op8_packing": _over_documents(lambda docs: packing.pack(docs, tokenizer_path(packing.TOKENIZER))),
    "op9_licences": _over_documents(
        lambda docs: licences.scan(docs).selectExpr("doc_id", "n_paragraphs", "array_join(families, ',') AS families", "probability", "similarity")
    ),
    "op10_exact_dedup": _over_documents(exact_dedup.exact_groups),
    "op11_vector_codes": lambda spark, sf_dir: vector_codes.code_vectors(_table(spark, sf_dir, "embeddings")),
    "op12_spelling_variants": _over_documents(spelling_variants.spelling_forms),
    "op13_decontamination": lambda spark, sf_dir: decontamination.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    ).drop("hits"),
}



# the crc32 of the byte list b in DuckDB: fixed polynomial, table by its rule
_CRC_TABLE = """SELECT [list_reduce([c] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)
                        FOR c IN range(256)] AS crcs"""
_CRC = "xor(list_reduce([4294967295] || b, lambda h, x: xor(h >> 8, crcs[xor(h & 255, x) + 1])), 4294967295)"


def _vector_codes_sql(parts: int = 16, entries: int = 64, size: int = 4, rounds: int = 2) -> str:
    """Every distance of every round; a book has one row per part and entry."""
    distance = " + ".join(f"(k.v[{i}] - b.v[{i}]) * (k.v[{i}] - b.v[{i}])" for i in range(1, size + 1))
    means = ", ".join(f"floor(sum(v[{i}]) / count(*)::DOUBLE)::BIGINT" for i in range(1, size + 1))
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
            SELECT r, p, v, min(d) AS d, arg_min(e, d * {entries} + e) AS e
            FROM (SELECT r, k.p, k.v, e, {distance} AS d FROM pieces k JOIN book{k} b ON k.p = b.p) GROUP BY r, p, v)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
                SELECT p, e, coalesce(m.v, b.v) AS v
                FROM book{k} b LEFT JOIN (SELECT p, e, [{means}] AS v FROM near{k} GROUP BY p, e) m USING (p, e))""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, [floor(256 * x)::BIGINT FOR x IN embedding] AS v
            FROM embeddings WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pieces AS MATERIALIZED (
            SELECT r, p, v[{size} * p + 1 : {size} * p + {size}] AS v
            FROM (SELECT r, v, unnest(range({parts})) AS p FROM kept)
        ), book0 AS MATERIALIZED (
            SELECT p, r - 1 AS e, v FROM pieces WHERE r <= {entries}
        ), {", ".join(steps)}, codes AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
            FROM near{rounds} GROUP BY r
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
        FROM kept JOIN codes USING (r)
    """


ORACLE_SQL: dict[str, str] = {
    "op10_exact_dedup": """
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op1_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM words WHERE len(w) >= 35
        ), phrases AS (
            SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS phrase FROM windows
        ), repeated AS (
            SELECT doc_id, i FROM phrases QUALIFY count(*) OVER (PARTITION BY phrase) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
        ), numbered AS (
            SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM numbered ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op13_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), starts AS (
            SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM starts
        ), places AS (
            SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
        ), found AS (
            SELECT r, p.n, i, item_id
            FROM (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS win FROM places) p JOIN windows USING (n, win)
        ), hit AS (
            SELECT r, count(*) AS n_hit
            FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS i FROM found) GROUP BY r
        ), met AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN met USING (r)
    """,
    "op11_vector_codes": _vector_codes_sql(),
    "op12_spelling_variants": """
        WITH RECURSIVE lists AS MATERIALIZED (
            """ + _CRC_TABLE + """
        ), runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
            GROUP BY doc_id, run
        ), bytes AS (
            SELECT doc_id, run, n,
                   flatten([CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c)::BIGINT - 64] END
                            FOR c IN string_split(doc_id || ':' || run, '')]) AS b
            FROM runs
        ), hashed AS (
            SELECT run, n, """ + _CRC + """ AS h FROM bytes, lists
        ), altered AS (
            SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM hashed
        ), words AS MATERIALIZED (
            SELECT word, sum(n)::BIGINT AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ), places AS MATERIALIZED (
            SELECT word, left(word, i - 1) AS a, substr(word, i + 1) AS z
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), shorter AS (
            SELECT DISTINCT places.word, w.word AS near FROM places JOIN words w ON a || z = w.word
        ), near AS (
            SELECT x.word, y.word AS near FROM places x JOIN places y USING (a, z) WHERE x.word <> y.word
            UNION ALL SELECT word, near FROM shorter UNION ALL SELECT near, word FROM shorter
        ), best AS (
            SELECT near.word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word) AS form, max(w.n) AS form_n
            FROM near JOIN words w ON near.near = w.word GROUP BY near.word
        ), forms AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
                   CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), walk AS (
            SELECT word, form AS root FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL
        ), ends AS (
            SELECT walk.word, walk.root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL
        )
        SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM forms LEFT JOIN ends USING (word)
    """,
}
