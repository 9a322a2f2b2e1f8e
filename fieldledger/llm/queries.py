"""Registered queries of the corpus operators and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger.llm import audit, chat, fuzzy, language, mixing, packing, quality, repeats, secrets, simhash, templates, trie, url_rules
from fieldledger.llm.common import table


def op1_fuzzy_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.fingerprints(table(spark, sf_dir, "documents"))


def op2_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc")


def op4_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.fixed_rules(spark))


#: Fixed by the contract: a conversation of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.formatted(chat.text_parts(rows)))


def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.plan(table(spark, sf_dir, "documents"))).drop("reads")


def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).drop("text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secret_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.find(docs, secrets.train(docs))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_fuzzy_fingerprint,
        op2_byte_language,
        op3_template_decontamination,
        op4_packed_tokens,
        op5_simhash_pivots,
        op6_url_rules,
        op7_chat_format,
        op8_repeated_spans,
        op9_curriculum_mix,
        op10_ordinal_quality,
        op11_filter_audit,
        op12_secret_field,
        op13_conversation_trie,
        pipeline,
    )
    return {f.__name__: f for f in found}


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)
#: One bit of a CRC-32: the byte of the text comes in at every eighth.
_CRC_BYTE = "CASE WHEN j % 8 = 0 THEN xor(k, ascii(substr(s, CAST(j // 8 + 1 AS BIGINT), 1))) ELSE k END"
_CRC_STEP = f"xor(({_CRC_BYTE}) >> 1, 3988292384 * (({_CRC_BYTE}) & 1))"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op6_url_rules": f"""
        WITH rules(rh, rp, v) AS (VALUES {_RULE_ROWS}),
        cut AS (SELECT page_id, row_number() OVER () AS r,
                       CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (SELECT page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        fit AS (SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
                FROM parts, rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN fit USING (r)""",
    "op7_chat_format": f"""
        WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                      UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
        joined AS (SELECT conv_id, count(*) AS n_turns,
                          string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                          coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
                          sum(length(role || text) + 20 + length(regexp_replace(role || text, '[^<\\[]', '', 'g'))) AS formatted_chars
                   FROM rows GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars FROM joined""",
    "op8_repeated_spans": f"""
        WITH words AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        starts AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
        windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS t FROM starts),
        twice AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1),
        gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS spot FROM windows SEMI JOIN twice USING (t)),
        lists AS (SELECT r, list(spot) AS spots FROM gone GROUP BY r),
        kept AS (SELECT doc_id, len(w) AS n_words, coalesce(len(spots), 0) AS n_removed,
                        CASE WHEN spots IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(spots, i)) END AS k
                 FROM words LEFT JOIN lists USING (r))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
               sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""",
    "op13_conversation_trie": f"""
        WITH said AS (SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
                      FROM conversations WHERE conv_id IS NOT NULL),
        lists AS (SELECT c, list({{'r': role, 't': text}} ORDER BY p) AS l, CAST(c AS VARCHAR) AS s FROM said GROUP BY c),
        crcs AS (SELECT c, l, xor(list_reduce(range(0, CAST(8 * length(s) AS BIGINT)), lambda k, j: {_CRC_STEP}, 4294967295), 4294967295) % 6 AS h FROM lists),
        built AS (SELECT a.c, coalesce(b.l[1:a.h], []) || a.l[a.h + 1:] AS l FROM crcs a LEFT JOIN crcs b ON b.c = a.c - a.c % 100),
        starts AS (SELECT c, len(l) AS n, l, unnest(range(0, len(l) + 1)) AS d FROM built),
        members AS (SELECT c, n, d, l[1:d] AS k, l[1:d - 1] AS up FROM starts),
        nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(k[d].t), 0) AS own,
                         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '') AS ends FROM members GROUP BY k, d),
        kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
        known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
        spread AS (SELECT k[1:e] AS k, own, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM known)),
        sums AS (SELECT k, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM spread GROUP BY k)
        SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, leaves AS n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
        FROM known a JOIN sums USING (k) LEFT JOIN nodes b ON a.d > 0 AND b.k = a.k[1:a.d - 1]""",
    "op11_filter_audit": f"""
        WITH base AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        flags AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
                         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f FROM base),
        rated AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id),
        docs AS (SELECT part, f, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM flags LEFT JOIN rated USING (doc_id)),
        counts AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM docs GROUP BY part, f),
        letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
        orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
                   WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        steps AS (SELECT array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, s.i AS step, o[s.i] AS x, o[1:s.i - 1] AS before
                  FROM orders, letters s),
        cases AS (SELECT part, filter_order, step, x, n, good, bad, f[x] AS hit, len(list_filter(before, lambda y: f[y])) > 0 AS gone,
                         f[x] AND len(list_filter(f, lambda y: y)) = 1 AS alone FROM counts, steps),
        sums AS (SELECT part, filter_order, step, x, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
                        sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (alone) AS unique_fails,
                        sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(bad) FILTER (hit AND NOT gone) AS toxic_lost
                 FROM cases GROUP BY part, filter_order, step, x)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley FROM sums""",
}


def corpus_oracles() -> dict[str, str]:
    return dict(ORACLES)
