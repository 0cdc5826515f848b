"""Production queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pennant.llm.common import ship_code
from pennant.llm.decontaminate import contaminated
from pennant.llm.entropy_mix import mix
from pennant.llm.exact_dedup import exact_groups
from pennant.llm.html_extract import extract
from pennant.llm.jaccard_join import jaccard_components
from pennant.llm.language_id import languages
from pennant.llm.lm_score import lm_scores
from pennant.llm.merkle_manifest import tampered_manifest
from pennant.llm.quality import quality
from pennant.llm.sentencepiece_codec import load, round_trips
from pennant.llm.substring_dedup import substring_dedup
from pennant.llm.token_alignment import align
from pennant.llm.url_filter import rule_table, url_verdicts

SENTENCEPIECE_MODEL = os.environ.get("PENNANT_SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
BYTE_LEVEL_FILE = os.environ.get("PENNANT_BYTE_LEVEL_FILE", "/opt/tokenizers/byte_bpe_50k.json")

# The listed rules.
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"), load(SENTENCEPIECE_MODEL))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), _file(BYTE_LEVEL_FILE), _file(SENTENCEPIECE_MODEL))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join, op2_decontaminate, op3_exact_dedup, op4_sentencepiece, op5_substring_dedup, op6_language_id, op7_quality,
        op8_url_filter, op9_lm_score, op10_html_extract, op11_entropy_mix, op12_token_alignment,
        op13_merkle_manifest,
    )
}

ORACLE = {
    "op1_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5
                THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
        ), e AS (
            SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
        ), c(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT c.doc_id, e.b FROM c JOIN e ON c.other = e.a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM c GROUP BY doc_id) m USING (doc_id)""",
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
            FROM documents
        ), o AS (
            SELECT doc_id, body, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
            FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM o""",
    "op8_url_filter": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), s AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
        ), r(verdict, h, p) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
                   ('block', 'net', '/fr/')
        )
        SELECT page_id, host, path, rule, coalesce(found, 'allow') AS verdict
        FROM s LEFT JOIN LATERAL (
            SELECT h || p AS rule, verdict AS found FROM r
            WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            ORDER BY length(h || p) DESC LIMIT 1
        ) ON true""",
    "op13_merkle_manifest": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
        ), d AS (
            SELECT *, row_number() OVER () AS rid, coalesce('=' || source, '') AS f,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
            FROM documents
        ), l AS (
            SELECT rid, doc_id, f, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0
                        THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS altered
            FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d), crc
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY f ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY f) AS n FROM l
        ), t(f, n, lvl, pos, digest) AS (
            SELECT f, n, 0, pos, leaf FROM p
            UNION ALL
            SELECT f, n, lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM t WHERE n > 16 ** lvl GROUP BY f, n, lvl, pos // 16
        ), s AS (
            SELECT f, lvl AS depth, digest AS subroot, row_number() OVER (ORDER BY f) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n <= 16 ** lvl
        ), u(n, lvl, pos, digest) AS (
            SELECT n, 0, pos, subroot FROM s
            UNION ALL
            SELECT n, lvl + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM u WHERE n > 16 ** lvl GROUP BY n, lvl, pos // 16
        ), r AS (SELECT digest AS root FROM u WHERE n <= 16 ** lvl),
        sib AS (
            SELECT rid, t.lvl, t.pos, t.digest, t.pos < p.pos // (16 ** t.lvl)::BIGINT AS before, t.pos = p.pos // (16 ** t.lvl)::BIGINT AS self
            FROM p JOIN t ON t.f = p.f AND t.n > 16 ** t.lvl AND t.pos // 16 = p.pos // (16 ** (t.lvl + 1))::BIGINT
            UNION ALL
            SELECT rid, 100 + u.lvl, u.pos, u.digest, u.pos < s.pos // (16 ** u.lvl)::BIGINT, u.pos = s.pos // (16 ** u.lvl)::BIGINT
            FROM p JOIN s USING (f) JOIN u ON u.n > 16 ** u.lvl AND u.pos // 16 = s.pos // (16 ** (u.lvl + 1))::BIGINT
        ), side AS (
            SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS step,
                   coalesce(string_agg(digest, '' ORDER BY pos) FILTER (before), '') AS a,
                   coalesce(string_agg(digest, '' ORDER BY pos) FILTER (NOT before AND NOT self), '') AS b
            FROM sib GROUP BY rid, lvl
        ), up(rid, step, got) AS (
            SELECT rid, 0, coalesce(altered, leaf) FROM p
            UNION ALL
            SELECT up.rid, up.step + 1, sha256(a || got || b) FROM up JOIN side ON side.rid = up.rid AND side.step = up.step + 1
        ), last AS (SELECT rid, arg_max(got, step) AS folded_root FROM up GROUP BY rid),
        proof AS (SELECT rid, sha256(string_agg(a || b, '' ORDER BY step)) AS proof_sha256 FROM side GROUP BY rid)
        SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.root AS verified
        FROM p JOIN s USING (f) JOIN last USING (rid) LEFT JOIN proof USING (rid), r""",
}
