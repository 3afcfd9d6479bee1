"""The operators as queries over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_search, chat, conversation_repair, exact_dedup, jaccard_join, lm_scoring, mixing, piece_codec, rule_classifier, secret_scan, substring_dedup, token_counts, vector_codes
from .storage import table

#: The conversation that is added to the table, both turns with this text.
ADDED_CONVERSATION = -7
ADDED_TEXT = "</s>[INST] ok [/INST]"


def op1_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


def op3_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_documents(table(spark, sf_dir, "documents"))


#: Target weights of the mix: three domains, which the sources' numbers tell apart, and the languages in each.
MIX = mixing.Mix(share=0.6, max_epochs=2, domains={"crawl": 25, "library": 45, "forum": 30}, languages={"en": 40, "de": 20, "fr": 20, "es": 20})


def source_domain() -> Column:
    number = F.col("source").substr(F.lit(4), F.length("source")).try_cast("int")
    return F.when(number == 0, "crawl").when(number < 10, "library").when(number.isNotNull(), "forum")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select_mix(table(spark, sf_dir, "documents"), source_domain(), MIX)
    return taken.select("row.doc_id", *mixing.LEAF, F.col("tokens_").alias("n_tokens"), "copies")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED_CONVERSATION, 0, "user", ADDED_TEXT), (ADDED_CONVERSATION, 1, "assistant", ADDED_TEXT)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(rows.unionByName(added)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = rule_classifier.train(docs, labels, ~rule_classifier.held_out(F.col("doc_id")))
    return rule_classifier.classify(docs, model).select("doc_id", rule_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).drop("n_points")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.audit_digests(rows, conversation_repair.damage(rows))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_lm_backoff, op2_jaccard_join, op3_ann_search, op4_piece_codec, op5_mix_sources, op6_chat_format, op7_quality_rules,
            op8_secret_scan, op9_token_counts, op10_exact_dedup, op11_substring_dedup, op12_conversation_repair, op13_vector_codes,
        )
    }


OP1_SQL = rf"""
WITH words AS (
  SELECT doc_id, w, unnest(range(len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)
), grams AS (
  SELECT doc_id, i, w[i + 1] AS g1, CASE WHEN i > 0 THEN w[i : i + 1] END AS g2, CASE WHEN i > 1 THEN w[i - 1 : i + 1] END AS g3 FROM words
), counted AS (
  SELECT doc_id, i, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS n,
    count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
    CASE WHEN i > 0 THEN count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) ELSE 0 END AS c2,
    CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) ELSE 0 END AS c3
  FROM grams
), context AS (
  SELECT *, lag(c1) OVER w AS d1, lag(c2) OVER w AS d2, least(i, {lm_scoring.ORDER - 1}) AS most FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), scored AS (
  SELECT doc_id, CASE WHEN c3 > 0 THEN c3 / d2 WHEN c2 > 0 THEN pow({lm_scoring.ALPHA}, most - 1) * (c2 / d1)
    WHEN c1 > 0 THEN pow({lm_scoring.ALPHA}, most) * (c1 / n) ELSE pow({lm_scoring.ALPHA}, most + 1) / (n + 1) END AS s
  FROM context
), summed AS (SELECT doc_id, count(*) AS n_words, CAST(sum(CAST(round(ln(s) * 1e6) AS BIGINT)) AS BIGINT) AS total_micro FROM scored GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(total_micro, 0) AS total_micro, total_micro / 1e6 / n_words AS score
FROM documents LEFT JOIN summed USING (doc_id)
"""


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_aggregate(s, 'string_agg', ' ') AS s FROM (
    SELECT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0))
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.least_, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a, min(b) AS least_ FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


def _cases(column: str, weights: dict[str, int], default: int) -> str:
    return str(default) if not weights else f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END"


def _level_sql(rows: str, parent: str, node: str, budget: str) -> str:
    """Rows of ``rows`` (with capacity and weight) with their share of the parent's budget."""
    by = f"PARTITION BY {parent} " if parent else ""
    return f"""
  SELECT *, least(CAST(capacity AS DOUBLE), weight * max(level_) OVER ({by})) AS share FROM (
    SELECT *, ({budget} - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_
    FROM ({rows}) WINDOW w AS ({by}ORDER BY capacity / weight, {node}))"""


OP5_SQL = rf"""
WITH slim AS (
  SELECT doc_id, coalesce(CASE WHEN number = 0 THEN 'crawl' WHEN number < 10 THEN 'library' WHEN number IS NOT NULL THEN 'forum' END, 'unknown') AS domain,
    coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS origin, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens_
  FROM (SELECT *, TRY_CAST(substr(source, 4) AS INT) AS number FROM documents)
), leaves AS (
  SELECT domain, language, origin, sum(tokens_) AS tokens, sum(tokens_) * {MIX.max_epochs} AS capacity FROM slim GROUP BY ALL
), d AS ({_level_sql(f"SELECT domain, sum(capacity) AS capacity, {_cases('domain', MIX.domains, MIX.default_weight)} AS weight FROM leaves GROUP BY domain", "", "domain", f"(SELECT CAST(floor(sum(tokens) * {MIX.share}) AS DOUBLE) FROM leaves)")}
), l AS ({_level_sql(f"SELECT x.*, d.share AS up FROM (SELECT domain, language, sum(capacity) AS capacity, {_cases('language', MIX.languages, MIX.default_weight)} AS weight FROM leaves GROUP BY ALL) x JOIN d USING (domain)", "domain", "language", "up")}
), s AS ({_level_sql(f"SELECT x.*, l.share AS up FROM (SELECT *, {_cases('origin', MIX.sources, MIX.default_weight)} AS weight FROM leaves) x JOIN l USING (domain, language)", "domain, language", "origin", "up")}
), plan AS (
  SELECT domain, language, origin, CAST(floor(round(share, 6)) AS BIGINT) // tokens AS epochs, CAST(floor(round(share, 6)) AS BIGINT) % tokens AS rest FROM s WHERE tokens > 0
), ordered AS (
  SELECT *, sum(tokens_) OVER (PARTITION BY domain, language, origin ORDER BY md5({MIX.seed} || ':' || epochs || ':' || doc_id)) AS running
  FROM slim JOIN plan USING (domain, language, origin)
)
SELECT doc_id, domain, language, origin, tokens_ AS n_tokens, CAST(epochs + CAST(running <= rest AS INT) AS BIGINT) AS copies
FROM ordered WHERE epochs + CAST(running <= rest AS INT) > 0
"""

_CONTROL_RE = "|".join("".join("\\" + c if c in "[]/<>" else c for c in x) for x in chat.CONTROL)

OP6_SQL = rf"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {ADDED_CONVERSATION}, 0, 'user', '{ADDED_TEXT}'
  UNION ALL SELECT {ADDED_CONVERSATION}, 1, 'assistant', '{ADDED_TEXT}'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL_RE}')) + len(regexp_extract_all(text, '\\[\\<\[]'))
    + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 29 + length(role) END AS n_points
  FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n_points) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

def _spans_sql(number: int, rule: secret_scan.Rule) -> str:
    """The spans of a rule: places are what lies between its matches and the matches before."""
    pattern = rule.pattern.replace("(?ai:", "(?i:").replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, upto - length(m) AS start_, upto AS end_ FROM (
    SELECT *, CAST(sum(length(pre) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto FROM (
      SELECT doc_id, unnest(m) AS m, unnest(s[1 : len(m)]) AS pre, unnest(g) AS g, unnest(range(len(m))) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS s, regexp_extract_all(t, '{pattern}', {rule.group}) AS g
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
  WHERE length(g) >= {rule.least}"""


_JOINED_SQL = "string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, number)"

OP8_SQL = f"""
WITH spans AS ({" UNION ALL ".join(_spans_sql(i, r) for i, r in enumerate(secret_scan.RULES))}),
digests AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    {_JOINED_SQL} FILTER (WHERE number < {len(secret_scan.BASE_KINDS)}) AS base, {_JOINED_SQL} AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN digests USING (doc_id)
"""

OP10_SQL = r"""
WITH named AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM named WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id)
"""


OP11_SQL = rf"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row, i, md5(array_to_string(w[i : i + {substring_dedup.WINDOW - 1}], ' ')) AS s FROM (SELECT row, w, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) AS i FROM words)
), covered AS (
  SELECT DISTINCT row, j FROM (SELECT row, unnest(range(i, i + {substring_dedup.WINDOW})) AS j FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1)
), marked AS (
  SELECT row, each.w AS word, each.j AS j, covered.j IS NOT NULL AS gone FROM (SELECT row, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS j FROM words) each LEFT JOIN covered USING (row, j)
), digests AS (
  SELECT row, count(*) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM marked GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM words LEFT JOIN digests USING (row)
"""


def _repairs_sql() -> str:
    """Rows (state, initial that the turn needs, code, cost, next state) of all macro edits."""
    out = []
    for state in range(4):
        at = state
        for k in range(3):
            for edit in "KRD":
                code, cost = "I" * k + edit, k * conversation_repair.INSERT
                if edit == "D":
                    out.append((state, "any", code, cost + conversation_repair.DELETE, at))
                elif edit == "R":
                    out.append((state, "any", code, cost + conversation_repair.REROLE, conversation_repair.FORCED[at]))
                else:
                    out += [(state, role, code, cost, end) for (a, role), end in conversation_repair.KEPT.items() if a == at]
            at = conversation_repair.FORCED[at]
    return ", ".join(f"({s}, '{role}', '{code}', {cost}, {end})" for s, role, code, cost, end in out)


#: CRC-32 byte by byte, each byte by eight steps of its polynomial.
_CRC_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, step: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""

OP12_SQL = rf"""
WITH RECURSIVE kinds AS (
  SELECT *, {_CRC_SQL} % {conversation_repair.DAMAGES} AS kind FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(sha256(role) || text)) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), turns AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
), macros(state, role, code, cost, next_) AS (VALUES {_repairs_sql()}
), layers AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, 0 AS cost, '' AS audit FROM turns
  UNION ALL
  SELECT conv_id, i, state, cost, audit FROM (
    SELECT l.conv_id, t.i, m.next_ AS state, l.cost + m.cost + CASE WHEN t.fault = 'truncated' AND m.code NOT LIKE '%D' THEN {conversation_repair.TRUNCATED} ELSE 0 END AS cost, l.audit || m.code AS audit
    FROM layers l JOIN turns t ON t.conv_id = l.conv_id AND t.i = l.i + 1 JOIN macros m ON m.state = l.state AND m.role IN ('any', t.initial) AND (m.code LIKE '%D' OR coalesce(t.fault, '') NOT IN ('blank', 'duplicate')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1
), cheapest AS (
  SELECT conv_id, cost, audit FROM (
    SELECT conv_id, cost + {conversation_repair.INSERT} * closing AS cost, audit || repeat('I', closing) AS audit
    FROM layers JOIN (SELECT conv_id, max(i) AS i FROM turns GROUP BY 1) USING (conv_id, i) JOIN (VALUES {", ".join(map(str, conversation_repair.CLOSING.items()))}) AS c(state, closing) USING (state))
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
), edits AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS i, count(*) FILTER (WHERE edit <> 'D') OVER w AS place
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(length(audit))) AS j FROM cheapest WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), repaired AS (
  SELECT e.conv_id, e.j, CASE WHEN edit = 'K' THEN role WHEN (place - max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role,
    CASE WHEN edit = 'I' THEN '' ELSE text END AS text
  FROM edits e LEFT JOIN turns t ON t.conv_id = e.conv_id AND t.i = e.i WHERE edit <> 'D'
), shas AS (SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY j)) AS repaired_sha256 FROM repaired GROUP BY 1
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY 1
)
SELECT conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))}, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN stats USING (conv_id) LEFT JOIN cheapest USING (conv_id) LEFT JOIN shas USING (conv_id)
"""


def _rounds_sql() -> str:
    """Book 0, and of every round the assignment and the next book. A distance and its entry are one number, so that the least is the nearest entry of lowest index."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    out = []
    for k in range(vector_codes.ROUNDS + 1):
        out.append(f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, p, CAST(least_ % {entries} AS BIGINT) AS e, CAST(least_ // {entries} AS BIGINT) AS distance FROM (
    SELECT vec_id, parts.p AS p, min(CAST(list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + e) AS least_
    FROM parts JOIN b{k} USING (p) GROUP BY vec_id, parts.p)
)""")
        if k < vector_codes.ROUNDS:
            out.append(f"""
b{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, y) AS y FROM b{k} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY d) AS m FROM (
      SELECT p, e, d, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS d FROM parts JOIN a{k} USING (vec_id, p)) GROUP BY p, e, d)
    GROUP BY p, e) USING (p, e)
)""")
    return ",".join(out)


OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (SELECT unnest(range({vector_codes.PARTS})) AS p
), parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // {vector_codes.PARTS}) + 1 : (p + 1) * (len(v) // {vector_codes.PARTS})] AS x FROM kept, p
), b0 AS MATERIALIZED (
  SELECT p, e, x AS y FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {vector_codes.ENTRIES}) USING (vec_id)
),{_rounds_sql()},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(distance) AS BIGINT) AS error FROM a{vector_codes.ROUNDS} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM b{vector_codes.ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def oracle_sql() -> dict[str, str]:
    """Without op3, whose search is approximate at every size, and op4, op7 and op9, which SQL can't express; their tests are in tests/llm."""
    return {"op1_lm_backoff": OP1_SQL, "op2_jaccard_join": OP2_SQL, "op5_mix_sources": OP5_SQL, "op6_chat_format": OP6_SQL, "op8_secret_scan": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op11_substring_dedup": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_vector_codes": OP13_SQL}
