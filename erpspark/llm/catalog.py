"""Registered queries of the corpus operators and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from erpspark.llm import byte_bpe, html_main, jaccard_join, line_dedup, manifest, merkle, packing, quality_pu, quality_rules, secret_scan, simhash_vptree, substring_dedup, whitening
from erpspark.llm.scratch import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op5_substring_dedup",
    r"""
    WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM documents),
    places AS (SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS i FROM words WHERE len(w) >= 50),
    windows AS (SELECT p.doc_id, p.i, sha256(array_to_string(w.w[p.i : p.i + 49], ' ')) AS h FROM places p JOIN words w USING (doc_id)),
    firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h HAVING count(DISTINCT doc_id) > 1),
    covered AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i FROM windows JOIN firsts USING (h) WHERE doc_id > first_id),
    each_word AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM words),
    kept AS (SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.i) AS t FROM each_word e ANTI JOIN covered c ON c.doc_id = e.doc_id AND c.i = e.i GROUP BY e.doc_id)
    SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
    FROM words w LEFT JOIN kept k USING (doc_id)
    """,
)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no passage of an earlier document covers."""
    out = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), digest=True)
    return out.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__kept").alias("kept_sha256"))


@query(
    "op8_line_dedup",
    r"""
    WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
    keyed AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    judged AS (SELECT d.doc_id, d.i, d.line, c.keeper IS NOT NULL AND c.keeper <> d.doc_id AS gone FROM keyed d LEFT JOIN common c ON c.k = d.k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the long lines that recur in five documents or more, but for their last holder."""
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), digest=True)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.col("__kept").alias("kept_sha256"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict per document."""
    out = quality_rules.judge(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    out = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [secret_scan.count_kind(F.col("__base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return out.select("doc_id", *counts, F.sha2(secret_scan.listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"), secret_scan.listed(F.col("__spans")).alias("spans"))


@query("op9_merkle_fingerprint")
def op9_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return merkle.edit_prints(documents(spark, sf_dir))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return packing.pack(packing.pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


@query("op1_pu_quality")
def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out remainder are not looked at."""
    out = quality_pu.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", quality_pu.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_main_text")
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = ship(spark).read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_main.extract(pages).select("page_id", "url", F.col("__text").alias("text"), F.col("__n_chars").alias("n_chars"))


@query(
    "op3_jaccard_groups",
    r"""
    WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM documents),
    grams AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM words)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
    reach AS (SELECT doc_id, doc_id AS other FROM words UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
    SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM words w LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
    """,
)
def op3_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document under links of similarity 0.85 of 4-word shingles."""
    return jaccard_join.groups(documents(spark, sf_dir), n=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path), path)
    n_tokens = F.size(byte_bpe.id_list(F.col("__ids"))).cast("long").alias("n_tokens")
    return out.select("doc_id", n_tokens, F.sha2(F.col("__ids").cast("binary"), 256).alias("ids_sha256"), F.sha2("__bytes", 256).alias("decoded_sha256"))


@query(
    "op13_manifest",
    r"""
    WITH RECURSIVE rows AS (SELECT *, CASE WHEN text IS NOT NULL AND
            (list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k::INT)::BIGINT & 1)))),
                lambda r, b: xor(r >> 1, CASE WHEN xor(r, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) & 1) = 1
            THEN replace(text, chr(10), '') END AS cut, coalesce('1' || source, '0') AS tree FROM documents),
    fields AS (SELECT doc_id, tree, cut,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        text FROM rows),
    leaves AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || strlen(cut) || ':' || cut) AS cut_leaf FROM fields),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    nodes AS (SELECT tree, 0 AS level, i, n, leaf AS d FROM ranked
        UNION ALL SELECT tree, max(level) + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, i // 3),
    subroots AS (SELECT tree, d, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
    over AS (SELECT 0 AS level, i, n, d FROM subroots
        UNION ALL SELECT max(level) + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM over WHERE n > 1 GROUP BY i // 3),
    steps AS (
        SELECT a.tree, a.level, a.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
        FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.tree, a.level, a.i
        UNION ALL
        SELECT s.tree, t.level + a.level, s.i, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i), ''), coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i), '')
        FROM subroots s JOIN (SELECT tree, max(level) AS level FROM nodes GROUP BY tree) t ON t.tree = s.tree
        JOIN over a ON a.n > 1 AND a.i = s.i // (3 ** a.level)::BIGINT JOIN over b ON a.level = b.level AND a.i // 3 = b.i // 3 GROUP BY s.tree, t.level, s.i, a.level, a.i),
    depths AS (SELECT tree, max(level) AS depth FROM nodes GROUP BY tree),
    climb AS (SELECT r.tree, r.i AS rank, r.i, 0 AS level, coalesce(r.cut_leaf, r.leaf) AS h, '' AS sibs FROM ranked r
        UNION ALL SELECT c.tree, c.rank, CASE WHEN c.level < d.depth THEN c.i // 3 ELSE 0 END, c.level + 1, sha256(s.l || c.h || s.r), c.sibs || s.l || s.r
        FROM climb c JOIN depths d ON d.tree = c.tree JOIN steps s ON s.tree = c.tree AND s.level = c.level AND (s.level >= d.depth OR s.i = c.i)),
    ends AS (SELECT tree, rank, arg_max(h, level) AS h, arg_max(sibs, level) AS sibs FROM climb GROUP BY tree, rank)
    SELECT r.doc_id, r.leaf, s.d AS subroot, o.d AS root, sha256(e.sibs) AS proof_sha256, e.h AS folded_root, e.h = o.d AS verified
    FROM ranked r JOIN subroots s USING (tree) JOIN ends e ON e.tree = r.tree AND e.rank = r.i CROSS JOIN (SELECT d FROM over WHERE n = 1) o
    """,
)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and the root it leads to after tampering."""
    return manifest.Manifest(documents(spark, sf_dir)).prove()


@query("op11_simhash_groups")
def op11_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every document and the group of fingerprints within three bits of each other."""
    out = simhash_vptree.groups(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whitened by the four leading components of the distinct ones."""
    return whitening.whiten(ship(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))
