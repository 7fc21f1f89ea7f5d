"""One query per operator of the training-data pipeline, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.chat_format import NAMED, ROLES, chat_digests, format_chats, read_chats
from tessera.llm.common import ship_package
from tessera.llm.decontaminate import find_contamination
from tessera.llm.filter_audit import audit_filters
from tessera.llm.licenses import TEMPLATES, WORD, license_report, telling
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.lm_score import score_texts
from tessera.llm.minhash_dedup import near_duplicates
from tessera.llm.mixing import mix_sources
from tessera.llm.pii import find_pii, fit_trees
from tessera.llm.quality import THRESHOLD, fit_quality, score_quality
from tessera.llm.token_count import count_tokens
from tessera.llm.vector_dedup import near_vectors
from tessera.llm.whitening import whiten_vectors
from tessera.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        _QUERIES[name] = run
        if sql:
            _ORACLES[name] = sql.strip()
        return fn

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@_query(
    "op1_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
      FROM documents),
    keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM lines),
    owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k)
    SELECT x.doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE o.owner IS NOT NULL AND o.owner <> x.doc_id) AS n_dropped,
           sha256(coalesce(string_agg(x.line, chr(10) ORDER BY x.pos)
                  FILTER (WHERE o.owner IS NULL OR o.owner = x.doc_id), '')) AS kept_sha256
    FROM keyed x LEFT JOIN owners o ON x.k = o.k
    GROUP BY x.doc_id
    """,
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op2_minhash_near_dedup")
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


@_query("op3_embedding_near_dedup")
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def _license_rows() -> str:
    """(license, variant, text, need, never): a chosen match has a word of every list in need, and none of never."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = lambda words: "[" + ", ".join(quoted(w.decode()) for w in sorted(words)) + "]::VARCHAR[]"
    out = []
    for name, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            need, never = telling(name, set(WORD.findall(text.encode().lower())))
            out.append(f"({quoted(name)}, {i}, {quoted(text)}, [{', '.join(map(listed, need))}]::VARCHAR[][], {listed(never)})")
    return ", ".join(out)


@_query(
    "op4_license_scan",
    rf"""
    WITH templates(license, variant, text, need, never) AS (VALUES {_license_rows()}),
    segments AS (
      SELECT doc_id, 'line' AS kind, unnest(range(len(p))) AS pos, unnest(p) AS segment
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)
      UNION ALL
      SELECT * FROM (
        SELECT doc_id, 'paragraph' AS kind, unnest(range(len(p))) AS pos, unnest(p) AS segment
        FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\n[ \t\r]*\n') AS p FROM documents))
      WHERE contains(segment, chr(10))),
    worded AS (
      SELECT *, regexp_extract_all(translate(segment, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM segments),
    grams AS (
      SELECT doc_id, kind, pos, w, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM worded WHERE len(w) > 0),
    known AS (
      SELECT license, variant, need, never, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS t
      FROM (SELECT license, variant, need, never, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM templates)),
    hits AS (
      SELECT doc_id, kind, pos, license, 2.0 * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice,
             len(list_filter(need, lambda x: NOT list_has_any(x, w))) = 0 AND NOT list_has_any(never, w) AS told
      FROM grams, known
      WHERE 3 * len(g) >= 2 * len(t) AND 2 * len(g) <= 3 * len(t) AND 2 * len(list_intersect(g, t)) >= 0.8 * (len(g) + len(t))),
    best AS (
      SELECT doc_id, kind, pos, license, round(max(dice), 6)::DOUBLE AS dice, max(dice) FILTER (told) AS told FROM hits GROUP BY ALL),
    chosen AS (
      SELECT * FROM best WHERE told IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, kind, pos ORDER BY told DESC, license) = 1),
    found AS (
      SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice FROM chosen GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0)::DOUBLE AS best_dice
    FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id
    """,
)
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


_HASH = "('0x' || substr(md5(concat_ws('/', {})), 1, 15))::BIGINT"
_H = "(ln(list_sum(list_transform(l, lambda t: exp({a} * ln(t / total))))) - list_sum(list_transform(l, lambda t: exp({a} * ln(t / total)) * {a} * ln(t / total))) / list_sum(list_transform(l, lambda t: exp({a} * ln(t / total)))))"


@_query(
    "op5_mix_sources",
    rf"""
    WITH RECURSIVE toks AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
    per AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM toks GROUP BY source),
    one AS (SELECT list(tokens::DOUBLE) AS l, sum(tokens)::DOUBLE AS total, count(*) AS n,
                   max(tokens) AS most, min(tokens) AS fewest FROM per WHERE tokens > 0),
    halved AS (
      SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
      UNION ALL
      SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
      FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, {_H.format(a="((lo + hi) / 2)")} >= 0.92 * ln(n) AS ok
            FROM halved, one WHERE i < 40)),
    expo AS (
      SELECT one.*, round(greatest(
               CASE WHEN {_H.format(a="1.0")} >= 0.92 * ln(n) THEN 1.0 ELSE (SELECT lo FROM halved WHERE i = 40) END,
               CASE WHEN ln(most / fewest) <= ln(2.0) THEN 0.0 ELSE 1.0 - ln(2.0) / ln(most / fewest) END), 6) AS a
      FROM one),
    plan AS (
      SELECT source, tokens, CASE WHEN tokens = most THEN tokens WHEN tokens = 0 THEN 0
               ELSE round(most * exp(a * ln(tokens / total)) / exp(a * ln(most / total)))::BIGINT END AS budget
      FROM per, expo),
    sized AS (
      SELECT source, tokens, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS full_passes,
             CASE WHEN tokens > 0 THEN budget - (budget // tokens) * tokens ELSE 0 END AS rest,
             greatest(1, ceil(tokens / 1000000))::BIGINT AS blocks
      FROM plan),
    wide AS (
      SELECT t.*, full_passes, rest, {_HASH.format("'1', 'home', coalesce(doc_id::VARCHAR, 'null')")} % blocks AS home
      FROM toks t JOIN sized s ON t.source IS NOT DISTINCT FROM s.source),
    per_block AS (
      SELECT source, home, full_passes, rest, sum(n_tokens) AS n FROM wide WHERE rest > 0 GROUP BY ALL),
    ranked AS (
      SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY
        {_HASH.format("'1', 'block', full_passes::VARCHAR, coalesce(source, 'null'), home::VARCHAR")}, home
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM per_block),
    part AS (
      SELECT w.*, r.rest - r.before AS room, r.n FROM wide w JOIN ranked r
        ON w.source IS NOT DISTINCT FROM r.source AND w.home = r.home WHERE r.before < r.rest),
    inside AS (
      SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, home ORDER BY
        {_HASH.format("'1', 'doc', full_passes::VARCHAR, coalesce(doc_id::VARCHAR, 'null')")}, doc_id, n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM part),
    mixed AS (
      SELECT doc_id, source, n_tokens, home, full_passes AS pass FROM inside WHERE before < room
      UNION ALL
      SELECT doc_id, source, n_tokens, home, unnest(range(full_passes)) AS pass FROM wide WHERE full_passes > 0)
    SELECT doc_id, source, n_tokens, pass,
           {_HASH.format("'1', 'block', pass::VARCHAR, coalesce(source, 'null'), home::VARCHAR")} AS block,
           {_HASH.format("'1', 'doc', pass::VARCHAR, coalesce(doc_id::VARCHAR, 'null')")} AS slot
    FROM mixed
    """,
)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@_query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = find_pii(docs, fit_trees(docs))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256)
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest.alias("base_sha256"), "spans")


@_query(
    "op7_decontaminate",
    r"""
    WITH dw AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    bw AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    wins AS (
      SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win, least(10, len(w)) AS size
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM bw WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT size FROM wins),
    spots AS (
      SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size),
    hits AS (
      SELECT s.doc_id, s.i, s.size, x.item_id FROM spots s
      JOIN wins x ON x.size = s.size AND x.win = array_to_string(list_slice(s.w, s.i, s.i + s.size - 1), ' ')),
    covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
           sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
    FROM dw d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
    """,
)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


@_query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit_quality(docs, table(spark, sf_dir, "labels"))
    out = score_quality(docs, net)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@_query("op9_lm_score")
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_texts(table(spark, sf_dir, "documents"), learn_from=_remainder(7) != 2)
    return out.select("doc_id", (_remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query("op10_token_count")
def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


#: A conversation that holds marks of the template as text.
SPOOF = "</s>[INST] ok [/INST]"
_CONTROL = r"<\\*(?:/?s>|\|endoftext\|>)|\[\\*(?:/?(?:SYS|INST|ROLE)|REPLY|TEXT)\]"
_SHELL = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in ROLES.items())


@_query(
    "op11_chat_format",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '{SPOOF}'), (-7, 1, 'assistant', '{SPOOF}')),
    sized AS (
      SELECT *, role || chr(10) || text || chr(10) AS line, length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
             + CASE role {_SHELL} ELSE {sum(map(len, NAMED))} + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars
      FROM turns)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoof = spark.createDataFrame([(-7, 0, "user", SPOOF), (-7, 1, "assistant", SPOOF)], turns.schema)
    return chat_digests(read_chats(format_chats(turns.unionByName(spoof), path), path))


@_query(
    "op12_filter_audit",
    r"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
    words AS (SELECT t.*, first, regexp_extract_all(t.text, '[^\x20\x09-\x0D]+') AS w FROM texts t JOIN firsts f ON t.text = f.text),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    masks AS (
      SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(words.doc_id > first, false)::INT AS mask,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id),
    cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
    letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (
      SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
    steps AS (
      SELECT filter_order, i::INT AS step, bits[i] AS f, coalesce(list_sum(list_slice(bits, 1, i - 1)), 0)::INT AS before
      FROM (SELECT *, unnest(range(1, 6)) AS i FROM orders)),
    counted AS (
      SELECT part, filter_order, step, f,
             sum(CASE WHEN mask & (before | f) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN mask & f <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN mask & f <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN mask = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN mask & f <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN mask & f <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM cells, steps GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM counted
    """,
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten_vectors(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this package's operators

    return corpus_pipeline.run(spark, sf_dir)
