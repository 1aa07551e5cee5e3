"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkclaims.llm import (
    exact_dedup,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    pii,
    ppm,
    prefix_trie,
    quality_rules,
    topk,
    toxicity,
)
from sparkclaims.llm.words import SQL_BLANK_RUN, SQL_LOWER, SQL_WORD, ascii_lower

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _root_on_workers(spark: SparkSession) -> None:
    """Python workers of a local session find the package as the driver does.

    On a cluster the package is shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    _root_on_workers(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


@query(
    "op1_line_dedup",
    f"""WITH d AS (SELECT doc_id, source, text,
        CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents),
      pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
      counted AS (SELECT source, line, count(*) AS n FROM
        (SELECT source, unnest(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '{SQL_WORD}')))) AS line FROM d)
        GROUP BY ALL HAVING count(*) >= 3),
      common AS (SELECT c.source, list(c.line) AS dropped FROM counted c
        JOIN pages p ON c.source IS NOT DISTINCT FROM p.source WHERE c.n > 0.1 * p.n GROUP BY c.source),
      cut AS (SELECT d.*, list_filter(lines, lambda l: NOT list_contains(coalesce(c.dropped, []), l)) AS rest
        FROM d LEFT JOIN common c ON d.source IS NOT DISTINCT FROM c.source)
      SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(rest, chr(10)) END AS text,
        len(list_filter(lines, lambda l: regexp_matches(l, '{SQL_WORD}'))) AS lines_before,
        len(lines) - len(rest) AS lines_dropped FROM cut""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


_BASE_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '{SQL_BLANK_RUN}'), lambda w: w <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{SQL_WORD}')) AS lines
      FROM documents),
      w AS (SELECT doc_id, p, array_to_string(words[p:p + 7], ' ') AS win FROM
        (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM d WHERE len(words) > 8)),
      twice AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM
        (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
      rep AS (SELECT doc_id, sum(least(8, coalesce(p - q, 8))) AS n FROM twice GROUP BY doc_id),
      m AS (SELECT d.doc_id, len(words) AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
        length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_capitals,
        len(list_filter(words, lambda x: list_contains({list(quality_rules.STOP_WORDS)!r}, lower(x)))) AS n_stop_words,
        len(lines) AS n_lines,
        len(list_filter(lines, lambda l: regexp_matches(l, '^[ \\t]*[-*•]'))) AS n_bullet_lines,
        len(list_filter(lines, lambda l: regexp_matches(l, '(\\.\\.\\.|…)[ \\t\\r]*$'))) AS n_ellipsis_lines
        FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id)"""


def _rules_sql() -> str:
    parts = []
    for rule in quality_rules.RULES:
        below = "1" if rule.denominator == "one" else rule.denominator
        if rule.least is not None:
            parts.append(f"{rule.numerator} >= CAST({rule.least} AS DOUBLE) * {below}")
        if rule.most is not None:
            parts.append(f"{rule.numerator} <= CAST({rule.most} AS DOUBLE) * {below}")
    return " AND ".join(parts)


@query(
    "op3_quality_rules",
    f"""{_BASE_SQL}, b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
      SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
        CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
        NOT base_failed AND {_rules_sql()} AS kept FROM b""",
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    "op9_exact_dedup",
    f"""WITH d AS (SELECT doc_id, sha256({SQL_LOWER}) AS text_sha256 FROM documents)
      SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = max(doc_id) OVER g AS kept, text_sha256
      FROM d WINDOW g AS (PARTITION BY text_sha256)""",
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, folder))


@query("op7_mixing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return mixing.taken_per_row(*mixing.mix(docs))


@query("op8_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, folder).select("doc_id", "text"))


#: The key of the surrogates; a parameter in production.
SURROGATE_KEY = "surrogates-of-the-test-tables"


@query("op2_pii_surrogates")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, folder), SURROGATE_KEY)


@query("op10_license_scan", license_scan.scan_sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder))


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, labels(spark, folder)), name="score")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % toxicity.FOLDS == toxicity.HELD_OUT
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op5_ppm_score")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(documents(spark, folder))


@query("op6_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


def _crc32_sql(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal text, bit by bit."""
    signs = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    bit = "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda r, z: {bit})"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {signs}), lambda c, b: {byte}))"


def _merkle_sql(levels: int = 6) -> str:
    """The manifest level by level, for trees of up to ``levels`` levels."""
    changed = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        parts = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
        return f"sha256({' || '.join(parts)})"

    tables = [
        f"""d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
          {leaf('text')} AS leaf, CASE WHEN {_crc32_sql('doc_id')} % 5 = 0 THEN {leaf(changed)} ELSE {leaf('text')} END AS value
          FROM documents)""",
        """g0 AS MATERIALIZED (SELECT rid, s, leaf AS digest, value, '' AS proof, count(*) OVER (PARTITION BY s) AS n,
          row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos FROM d)""",
    ]

    def climb(name: str) -> None:
        tables.append(f"{name}n0 AS (SELECT s, pos, n, digest FROM {name}0)")
        for k in range(levels):
            tables.append(f"""{name}n{k + 1} AS MATERIALIZED (SELECT s, pos // 16 AS pos, (n + 15) // 16 AS n,
                CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
                FROM {name}n{k} GROUP BY s, pos // 16, n)""")

    def fold(name: str) -> None:
        for k in range(levels):
            tables.append(f"""{name}f{k + 1} AS MATERIALIZED (SELECT f.rid, f.s, f.pos // 16 AS pos,
                CASE WHEN min(n.n) = 1 THEN f.value ELSE
                  sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.value ELSE n.digest END, '' ORDER BY n.pos)) END AS value,
                f.proof || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos <> f.pos), '') AS proof
                FROM {name}f{k} f JOIN {name}n{k} n ON f.s = n.s AND f.pos // 16 = n.pos // 16
                GROUP BY f.rid, f.s, f.pos, f.value, f.proof)""")

    climb("g")
    tables.append("gf0 AS (SELECT rid, s, pos, value, proof FROM g0)")
    fold("g")
    tables.append(f"r0 AS (SELECT 0 AS s, s AS pos, count(*) OVER () AS n, digest FROM gn{levels})")
    climb("r")
    tables.append(f"rf0 AS (SELECT rid, 0 AS s, s AS pos, value, proof FROM gf{levels})")
    fold("r")
    return f"""WITH {', '.join(tables)} SELECT doc_id, leaf, r0.digest AS subroot, top.digest AS root,
        sha256(proof) AS proof_sha256, f.value AS folded_root, f.value = top.digest AS verified
        FROM d JOIN rf{levels} f ON d.rid = f.rid JOIN r0 ON d.s = r0.pos CROSS JOIN rn{levels} top"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.audit(docs, tampered, {"text": ascii_lower(F.col("text"))})


@query(
    "op12_exact_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS codes FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.codes, c.codes) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
      SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM s
      WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
      QUALIFY row_number() OVER best <= 20""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    _root_on_workers(spark)
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def _trie_sql() -> str:
    """The trie from whole rebuilt sequences; a path is its turns' digests one after the other."""
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL),
      k AS (SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS ref,
        len(list_filter(string_split_regex(text, '{SQL_BLANK_RUN}'), lambda w: w <> '')) AS words FROM t),
      o AS (SELECT conv_id, list(ref ORDER BY turn NULLS FIRST, ref) AS refs, list(words ORDER BY turn NULLS FIRST, ref) AS sizes,
        {_crc32_sql('conv_id')} % 4 AS h FROM k GROUP BY conv_id),
      r AS (SELECT o.conv_id, list_concat(coalesce(list_slice(b.refs, 1, o.h), []), list_slice(o.refs, o.h + 1, len(o.refs))) AS refs,
        list_concat(coalesce(list_slice(b.sizes, 1, o.h), []), list_slice(o.sizes, o.h + 1, len(o.sizes))) AS sizes
        FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
      p AS (SELECT conv_id, d, len(refs) AS m, array_to_string(list_slice(refs, 1, d), '') AS path, coalesce(sizes[d], 0) AS w
        FROM (SELECT *, unnest(range(0, len(refs) + 1)) AS d FROM r)),
      n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE min(w) END AS w, max(m) AS longest,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (m = d), '')) AS ends
        FROM p GROUP BY path, d),
      up AS (SELECT *, unnest(range(0, d + 1)) AS a FROM n),
      below AS (SELECT substr(path, 1, 64 * a) AS path, a AS d, count(*) FILTER (longest = d) AS n_leaves,
        count(*) FILTER (d = a + 1) AS n_children, sum((n_convs - 1) * w) AS saved FROM up GROUP BY substr(path, 1, 64 * a), a)
      SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves,
        CAST(b.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
      FROM n JOIN below b ON n.path = b.path AND n.d = b.d
      LEFT JOIN n q ON q.d = n.d - 1 AND q.path = substr(n.path, 1, 64 * (n.d - 1))"""


@query("op13_prefix_trie", _trie_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    _root_on_workers(spark)
    conversations = spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet")
    conv = F.col("conv_id")
    return prefix_trie.trie(conversations, F.crc32(conv.cast("string")) % 4, conv - conv % 20)
