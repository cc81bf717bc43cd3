"""Queries over the driver tables, one for each operator of the reference, with the SQL that an independent engine answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions import rules
from loomset.functions import text as X
from loomset.operators import assemble, audit, balance, infer, normalize, prompts, sample, seal, state, vet
from loomset.scratch import new_path, scratch
from loomset.sources import records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return keep


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def conversations(spark: SparkSession, d: str) -> DataFrame:
    return normalize.conversation_messages(_table(spark, d, "conversations"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents")


def failures(spark: SparkSession, d: str) -> DataFrame:
    """documents as unified failures; the class comes from labels."""
    lab = _table(spark, d, "labels").select(F.col("doc_id").alias("_d"), F.when(F.col("quality") == 0, "missing_step").when(F.col("toxic") == 1, "safety_bypass").otherwise("clean_pass").alias("failure_class"))
    docs = documents(spark, d)
    return docs.join(lab, docs.doc_id == F.col("_d"), "left").select(
        F.col("doc_id").alias("id"), F.coalesce("failure_class", F.lit("unknown")).alias("failure_class"), F.col("lang").alias("vertical"), F.col("source").alias("source_model"),
        F.col("text").alias("user_prompt"), F.col("text").alias("model_output"), F.lit("").alias("system_prompt"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("e1"), F.lit("e2"))).otherwise(F.array().cast("array<string>")).alias("errors"), "source",
    )


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """documents as pairs to vet; the user's text is constant, so that equal answers make equal conversations."""
    tasks = F.array(*map(F.lit, rules.TASKS))
    return documents(spark, d).select(F.col("doc_id").alias("id"), F.element_at(tasks, (F.col("doc_id") % 5 + 1).cast("int")).alias("task"), F.array(X.message("system", F.lit("s")), X.message("user", F.lit("look at this")), X.message("assistant", F.col("text"))).alias("messages"), F.struct(F.lit("x").alias("failure_class"), F.col("lang").alias("vertical"), F.col("source").alias("source_model")).alias("metadata"))


#: Keywords that occur in the generated text; the default ones hardly do.
WORDS = {"diagnose": ["tion"], "repair": ["the"], "prevent": ["ing"], "detect": ["ent"], "compare": ["ch"]}
TYPES = {"licence": ["license"], "contact": ["@"], "worthless": ["worthless"], "ending": ["tion", "keit"]}

# Pieces of SQL that oracles share.
SPACE = r"[\s\x1c-\x1f\x{85}\pZ\x0b]+"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{SPACE}|{SPACE}$', '', 'g')"


def _degenerate(t: str) -> str:
    w = f"substr({t}, a::INTEGER + 1, 200)"
    return f"CASE WHEN len({t}) <= 120 THEN false ELSE len(list_filter(range(0, least(len({t}) - 120, 5000), 200), lambda a: len({w}) >= 123 AND len({w}) - len(replace({w}, left({w}, 40), '')) >= 120)) > 0 END"


def _any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def _case(x: str, table: dict[str, list[str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(x, w)} THEN '{k}'" for k, w in table.items()) + f" ELSE '{default}' END"


M = "m AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS ms FROM conversations GROUP BY conv_id)"
FIRST = "list_filter(ms, lambda x: x.role = '{0}')[1].content"
FP = f"sha256({_strip('lower(coalesce(' + FIRST.format('assistant') + ', ' + chr(39) * 2 + '))')})"
KEY = "sha256(concat('42|', {0}))"
PAIR_TASK = "['diagnose', 'repair', 'prevent', 'detect', 'compare'][doc_id % 5 + 1]"
REASON = f"list_filter([CASE WHEN len({_strip('x.content')}) = 0 THEN x.role || ' is empty' WHEN (x.role = 'assistant' AND len({_strip('x.content')}) < 50) OR (x.role = 'user' AND len({_strip('x.content')}) < 10) THEN x.role || ' has only ' || len({_strip('x.content')}) || ' characters' END FOR x IN ms], lambda r: r IS NOT NULL)[1]"
TOTAL = "coalesce(list_sum([len(coalesce(x.content, '')) FOR x IN ms]), 0)::INTEGER"
ROLES = "[coalesce(x.role, '?') FOR x IN ms]"
GATE = f"""CASE WHEN ms IS NULL OR len(ms) < 2 THEN 'format' WHEN NOT list_contains({ROLES}, 'assistant') OR NOT list_contains({ROLES}, 'user')
    OR (list_contains({ROLES}, 'system') AND {ROLES}[1] <> 'system') THEN 'roles' WHEN {REASON} IS NOT NULL THEN 'content' WHEN {TOTAL} > 32000 THEN 'length' END"""
FAILED = "f AS (SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NULL THEN 'unknown' WHEN quality = 0 THEN 'missing_step' WHEN toxic = 1 THEN 'safety_bypass' ELSE 'clean_pass' END AS failure_class, lang AS vertical, source AS source_model, text AS user_prompt, text AS model_output, CASE WHEN d.doc_id % 3 = 0 THEN 'e1; e2' ELSE 'none reported' END AS errors FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


# Audit: A1-A6, E2, H3-H10, H14, H17, W5, W7, C16


@query("audit_first_failing_gate", f"WITH {M} SELECT coalesce({GATE}, 'clean') AS gate, count(*) AS n FROM m GROUP BY 1")
def _(s, d):
    return audit.first_failures(conversations(s, d))


DETAIL = f"""CASE WHEN len(ms) < 2 THEN 'messages: ' || len(ms) || ', at least 2 are needed' WHEN NOT list_contains({ROLES}, 'assistant') THEN 'the assistant is missing'
    WHEN NOT list_contains({ROLES}, 'user') THEN 'the user is missing' WHEN list_contains({ROLES}, 'system') AND {ROLES}[1] <> 'system' THEN 'a system message comes late' WHEN {REASON} IS NOT NULL THEN {REASON}
    WHEN {TOTAL} > 32000 THEN {TOTAL} || ' characters in all, over 32000' END"""


@query("audit_gates_detail", f"WITH {M} SELECT conv_id, {GATE} AS gate, {DETAIL} AS detail FROM m")
def _(s, d):
    return audit.gated(conversations(s, d)).select("conv_id", "gate", "detail")


EDGE = """VALUES
 (1, array(named_struct('role','user','content','0123456789'), named_struct('role','assistant','content',repeat('a', 50)))),
 (2, array(named_struct('role','user','content','0123456789'), named_struct('role','assistant','content',repeat('a', 49)))),
 (3, array(named_struct('role','user','content','012345678'), named_struct('role','assistant','content',repeat('a', 50)))),
 (4, array(named_struct('role','user','content',' 012345678 '), named_struct('role','system','content','x'), named_struct('role','assistant','content',repeat('a', 50)))),
 (5, array(named_struct('role','user','content','only one'))),
 (6, array(named_struct('role','assistant','content',repeat('a', 60)), named_struct('role','assistant','content',repeat('a', 60)))),
 (7, array(named_struct('role','user','content',repeat('u', 60)), named_struct('role','user','content',repeat('a', 60)))),
 (8, array(named_struct('role','user','content',repeat('u', 1000)), named_struct('role','assistant','content',repeat('a', 31000)))),
 (9, array(named_struct('role','user','content',repeat('u', 1001)), named_struct('role','assistant','content',repeat('a', 31000)))),
 (10, array(named_struct('role','user','content','0123456789'), named_struct('role','tool','content','  '), named_struct('role','assistant','content',repeat('a', 50)))),
 (11, cast(null as array<struct<role:string,content:string>>)) AS t(id, messages)"""
EDGE_SQL = """m(id, ms) AS (VALUES
 (1, [{'role': 'user', 'content': '0123456789'}, {'role': 'assistant', 'content': repeat('a', 50)}]),
 (2, [{'role': 'user', 'content': '0123456789'}, {'role': 'assistant', 'content': repeat('a', 49)}]),
 (3, [{'role': 'user', 'content': '012345678'}, {'role': 'assistant', 'content': repeat('a', 50)}]),
 (4, [{'role': 'user', 'content': ' 012345678 '}, {'role': 'system', 'content': 'x'}, {'role': 'assistant', 'content': repeat('a', 50)}]),
 (5, [{'role': 'user', 'content': 'only one'}]),
 (6, [{'role': 'assistant', 'content': repeat('a', 60)}, {'role': 'assistant', 'content': repeat('a', 60)}]),
 (7, [{'role': 'user', 'content': repeat('u', 60)}, {'role': 'user', 'content': repeat('a', 60)}]),
 (8, [{'role': 'user', 'content': repeat('u', 1000)}, {'role': 'assistant', 'content': repeat('a', 31000)}]),
 (9, [{'role': 'user', 'content': repeat('u', 1001)}, {'role': 'assistant', 'content': repeat('a', 31000)}]),
 (10, [{'role': 'user', 'content': '0123456789'}, {'role': 'tool', 'content': '  '}, {'role': 'assistant', 'content': repeat('a', 50)}]),
 (11, NULL))"""


@query("audit_gate_edges", f"WITH {EDGE_SQL} SELECT id, {GATE} AS gate FROM m")
def _(s, d):
    return audit.gated(s.sql(f"SELECT * FROM {EDGE}")).select("id", "gate")


@query("audit_degenerate_messages", f"WITH {M} SELECT conv_id, len(list_filter(ms, lambda x: {_degenerate('x.content')})) > 0 AS bad FROM m")
def _(s, d):
    return conversations(s, d).select("conv_id", audit.degenerate_reason(F.col("messages")).isNotNull().alias("bad"))


@query("audit_system_prompts", "WITH t AS (SELECT count(DISTINCT conv_id) AS total FROM conversations) SELECT substr(text, 1, 100) AS prompt, count(*) AS n, round(100 * count(*) / any_value(total), 4) AS pct FROM conversations, t WHERE role = 'system' GROUP BY 1 ORDER BY n DESC, prompt LIMIT 10")
def _(s, d):
    return audit.system_prompts(conversations(s, d))


@query("audit_system_prompt_kinds", f"WITH {M} SELECT count(DISTINCT substr(ms[1].content, 1, 100)) AS prompts FROM m WHERE ms[1].role = 'system'")
def _(s, d):
    return audit.system_prompt_kinds(conversations(s, d))


@query("audit_role_sequences", f"WITH {M}, c AS (SELECT array_to_string({ROLES}, ' → ') AS roles, count(*) AS n FROM m GROUP BY 1) SELECT roles, n, round(100 * n / sum(n) OVER (), 4) AS pct FROM c ORDER BY n DESC, roles LIMIT 5")
def _(s, d):
    return audit.role_sequences(conversations(s, d))


@query("audit_message_counts", f"WITH {M}, c AS (SELECT len(ms)::INTEGER AS messages, count(*) AS n FROM m GROUP BY 1) SELECT messages, n, round(100 * n / sum(n) OVER (), 4) AS pct FROM c")
def _(s, d):
    return audit.message_counts(conversations(s, d))


PROFILE = "SELECT kind, count(*) AS n, min(len) AS min, list_sort(list(len))[count(*) // 10 + 1] AS p10, list_sort(list(len))[count(*) // 2 + 1] AS median, list_sort(list(len))[9 * count(*) // 10 + 1] AS p90, max(len) AS max FROM l GROUP BY kind"


@query("audit_length_profile", f"WITH {M}, l AS (SELECT role AS kind, len(text)::INTEGER AS len FROM conversations WHERE role IN ('assistant', 'user') UNION ALL SELECT 'total', {TOTAL} FROM m) {PROFILE}")
def _(s, d):
    return audit.length_profile(audit.length_rows(conversations(s, d)))


@query("audit_document_lengths", f"WITH l AS (SELECT lang AS kind, len(text)::INTEGER AS len FROM documents) {PROFILE}")
def _(s, d):
    return audit.length_profile(documents(s, d).select(F.col("lang").alias("kind"), F.length("text").alias("len")))


@query("audit_over_limit", f"WITH {M} SELECT count(*) FILTER ({TOTAL} > 3000) AS over, round(100 * count(*) FILTER ({TOTAL} > 3000) / count(*), 4) AS pct FROM m")
def _(s, d):
    return audit.over_limit(conversations(s, d), 3000)


@query("audit_duplicates", f"WITH {M} SELECT count(*) AS n, count(DISTINCT {FP}) AS kinds, count(*) - count(DISTINCT {FP}) AS dups FROM m")
def _(s, d):
    return audit.duplicates(conversations(s, d))


VERDICT = f"SELECT count(*) AS total, count(*) FILTER ({GATE} IS NULL) AS clean, count(*) FILTER ({GATE} IS NOT NULL) AS rejected, count(*) - count(DISTINCT {FP}) AS dups FROM m"


@query("audit_verdict", f"WITH {M}, v AS ({VERDICT}) SELECT *, CASE WHEN total = 0 THEN NULL WHEN rejected = 0 AND dups = 0 THEN 'PASS' WHEN rejected = 0 THEN 'PASS with duplicates' WHEN rejected * 100 < total THEN 'PASS below 1 % rejected' ELSE 'FAIL' END AS verdict FROM v")
def _(s, d):
    return audit.verdict(conversations(s, d))


@query("audit_combined", f"WITH {M}, v AS ({VERDICT.replace('SELECT ', 'SELECT (conv_id % 3)::VARCHAR AS file, ')} GROUP BY 1) SELECT file, sum(total)::BIGINT AS total, sum(clean)::BIGINT AS clean, sum(rejected)::BIGINT AS rejected, sum(dups)::BIGINT AS dups, round(100 * sum(clean) / sum(total), 4) AS pct FROM v GROUP BY ROLLUP (file)")
def _(s, d):
    parts = None
    for k in range(3):
        one = audit.verdict(conversations(s, d).where(F.col("conv_id") % 3 == k)).withColumn("file", F.lit(str(k)))
        parts = one if parts is None else parts.union(one)
    return audit.combined(parts)


@query("audit_first_rejections", f"WITH {M} SELECT conv_id, {GATE} AS gate FROM m WHERE {GATE} IS NOT NULL ORDER BY conv_id LIMIT 20")
def _(s, d):
    return audit.first_rejections(conversations(s, d), ["conv_id"]).drop("detail")


@query("audit_samples", f"WITH {M} SELECT conv_id, coalesce(substr({FIRST.format('system')}, 1, 60), 'N/A') AS system, coalesce(substr({FIRST.format('user')}, 1, 120), 'N/A') AS user, coalesce(substr({FIRST.format('assistant')}, 1, 120), 'N/A') AS assistant FROM m ORDER BY {KEY.format('conv_id')}, conv_id LIMIT 10")
def _(s, d):
    return audit.previews(audit.samples(conversations(s, d), "conv_id")).select("conv_id", "system", "user", "assistant")


@query("message_flatten", "SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS pos, role, len(text)::INTEGER AS len FROM conversations")
def _(s, d):
    return conversations(s, d).select("conv_id", F.posexplode("messages").alias("pos", "m")).select("conv_id", "pos", "m.role", F.length("m.content").alias("len"))


@query("message_first_last", f"WITH {M} SELECT conv_id, md5({FIRST.format('assistant')}) AS first, md5(list_filter(ms, lambda x: x.role = 'assistant')[-1].content) AS last, {TOTAL} AS total FROM m")
def _(s, d):
    c = conversations(s, d)
    return c.select("conv_id", F.md5(X.first_content(c.messages, "assistant")).alias("first"), F.md5(X.last_content(c.messages, "assistant")).alias("last"), X.total_length(c.messages).alias("total"))


@query("chat_render", f"WITH {M} SELECT conv_id, md5(array_to_string(['<|' || x.role || '|>' || chr(10) || x.content || chr(10) || '<|end|>' || chr(10) FOR x IN ms], '')) AS h FROM m")
def _(s, d):
    return conversations(s, d).select("conv_id", F.md5(assemble.rendered(F.col("messages"))).alias("h"))


# Scalars: L1-L19


@query("text_strip", rf"SELECT id, {_strip('x')} AS y FROM (VALUES (1, chr(9) || ' a b ' || chr(10)), (2, chr(160) || 'x' || chr(8195)), (3, chr(28) || chr(133) || 'y' || chr(31)), (4, ''), (5, '   '), (6, NULL)) t(id, x)")
def _(s, d):
    rows = [(1, "\t a b \n"), (2, "\xa0x "), (3, "\x1c\x85y\x1f"), (4, ""), (5, "   "), (6, None)]
    return s.createDataFrame(rows, "id int, x string").select("id", X.strip(F.col("x")).alias("y"))


@query("text_functions", f"SELECT doc_id, lower(substr(text, 1, 30)) AS low, len(text)::BIGINT AS n, (len(text) - len(replace(text, 'the', ''))) // 3 AS the, sha256(text) AS h, ceil(len(text) / 4)::BIGINT AS tokens, len({_strip('text')})::INTEGER AS stripped FROM documents")
def _(s, d):
    t = F.col("text")
    return documents(s, d).select("doc_id", F.lower(X.prefix(t, 30)).alias("low"), F.length(t).cast("long").alias("n"), X.occurrences(t, F.lit("the")).alias("the"), X.sha256(t).alias("h"), balance.token_estimate(t).alias("tokens"), F.length(X.strip(t)).alias("stripped"))


@query("text_degenerate", f"SELECT doc_id, {_degenerate('text')} AS bad FROM documents")
def _(s, d):
    return documents(s, d).select("doc_id", X.degenerate(F.col("text")).alias("bad"))


@query("text_degenerate_edges", f"WITH t AS (SELECT n, p, repeat(substr('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789äöüßéè', 1, p::INTEGER), 200)[1:n] AS x FROM range(118, 330) a(n), (VALUES (39), (40), (41), (66), (67)) b(p)) SELECT n, p, {_degenerate('x')} AS bad FROM t")
def _(s, d):
    n, p = s.range(118, 330).select(F.col("id").alias("n")), s.createDataFrame([(k,) for k in (39, 40, 41, 66, 67)], "p int")
    x = F.expr("substring(repeat(substring('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789äöüßéè', 1, p), 200), 1, cast(n as int))")
    return n.crossJoin(F.broadcast(p)).select("n", "p", X.degenerate(x).alias("bad"))  # five rows


@query("json_parse", "SELECT event_id, (props->>'$.k')::BIGINT AS k, json_valid(props) AS ok FROM events")
def _(s, d):
    return _table(s, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.try_parse_json("props").isNotNull().alias("ok"))


@query("source_split", "SELECT x, CASE WHEN x IS NULL THEN 'unknown' ELSE coalesce(nullif(array_to_string(string_split(x, '_')[3:], '_'), ''), CASE WHEN len(string_split(x, '_')) >= 3 THEN '' ELSE 'unknown' END) END AS failure_class FROM (VALUES ('selfheal_repair_incomplete_execution'), ('a_b'), ('a'), (''), (NULL), ('a_b_'), ('a_b_c')) t(x)")
def _(s, d):
    rows = [(x,) for x in ("selfheal_repair_incomplete_execution", "a_b", "a", "", None, "a_b_", "a_b_c")]
    return s.createDataFrame(rows, "x string").select("x", F.coalesce(X.split_part_rest(F.col("x"), "_", 3, 2), F.lit("unknown")).alias("failure_class"))


@query("file_stem", r"SELECT x, regexp_extract(x, '([^/]+)\.[^./]+$', 1) AS stem FROM (VALUES ('/a/b/shard_01.jsonl'), ('x.json'), ('/a/none')) t(x)")
def _(s, d):
    return s.createDataFrame([("/a/b/shard_01.jsonl",), ("x.json",), ("/a/none",)], "x string").select("x", X.file_stem(F.col("x")).alias("stem"))


# Normalising, classification and prompts: C1-C10, E1, F1-F7


NESTED = [
    ("1", "drift", "law", "m1", ("ask", "out", "sys"), (["e1", "e2"],), None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None, None, None, None),
    ("2", None, None, None, (None, None, None), (None,), None, None, None, None, None, None),
    ("3", None, "med", None, None, None, "selfheal_repair_bad_plan", "spec", "do it", "because", "done", ("gm",)),
    ("4", None, None, None, None, None, "x_rank", None, " do ", "", "out ", None),
    ("5", None, None, None, None, None, None, None, "", None, None, None),
]
NESTED_SCHEMA = "id string, failure_class string, vertical string, source_model string, context struct<user_prompt string, model_output string, system_prompt string>, failure_details struct<errors array<string>>, source string, specialty string, instruction string, reasoning string, output string, lineage struct<gen_model string>"
NESTED_SQL = """v(id, failure_class, vertical, source_model, user_prompt, model_output, system_prompt, errors, source, specialty, instruction, reasoning, output, gen_model) AS (VALUES
 ('1', 'drift', 'law', 'm1', 'ask', 'out', 'sys', 'e1,e2', NULL, NULL, NULL, NULL, NULL, NULL), (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL),
 ('2', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL), ('3', NULL, 'med', NULL, NULL, NULL, NULL, NULL, 'selfheal_repair_bad_plan', 'spec', 'do it', 'because', 'done', 'gm'),
 ('4', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'x_rank', NULL, ' do ', '', 'out ', NULL), ('5', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '', NULL, NULL, NULL))"""


@query("normalize_failures", f"""WITH {NESTED_SQL} SELECT coalesce(id, 'unknown') AS id, CASE WHEN instruction IS NULL THEN coalesce(failure_class, 'unknown') ELSE coalesce(nullif(array_to_string(string_split(source, '_')[3:], '_'), ''), 'unknown') END AS failure_class,
    coalesce(vertical, 'general') AS vertical, CASE WHEN instruction IS NULL THEN coalesce(source_model, 'unknown') ELSE coalesce(gen_model, specialty, 'unknown') END AS source_model,
    CASE WHEN instruction IS NULL THEN coalesce(user_prompt, '') ELSE instruction END AS user_prompt, CASE WHEN instruction IS NULL THEN coalesce(model_output, '') ELSE coalesce(output, '') END AS model_output,
    coalesce(system_prompt, '') AS system_prompt, CASE WHEN instruction IS NULL THEN coalesce(errors, '') ELSE '' END AS errors FROM v""")
def _(s, d):
    u = normalize.unified_failures(s.createDataFrame(NESTED, NESTED_SCHEMA))
    return u.drop("source").withColumn("errors", F.array_join("errors", ","))


@query("normalize_instruction_pairs", f"""WITH {NESTED_SQL}, t AS (SELECT vertical, {_strip("coalesce(instruction, '')")} AS i, {_strip("coalesce(reasoning, '')")} AS r, {_strip("coalesce(output, '')")} AS o FROM v)
SELECT i AS ask, CASE WHEN r <> '' THEN r || chr(10) || chr(10) || o ELSE o END AS answer, coalesce(vertical, '') AS vertical FROM t WHERE i <> '' AND o <> ''""")
def _(s, d):
    df = s.createDataFrame(NESTED, NESTED_SCHEMA).withColumns({"mechanism": F.lit(None).cast("string"), "fingerprint": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})
    p = normalize.instruction_pairs(df, "selfheal")
    return p.select(F.get("messages", F.lit(1))["content"].alias("ask"), F.get("messages", F.lit(2))["content"].alias("answer"), "metadata.vertical")


@query("normalize_backfill_pairs", f"WITH {NESTED_SQL}, t AS (SELECT id, source, coalesce(instruction, user_prompt) AS ask, CASE WHEN instruction IS NULL THEN model_output ELSE output END AS answer FROM v) SELECT id, {_case('source', rules.SOURCE_TASKS, 'diagnose')} AS task, ask, answer FROM t WHERE ask <> '' AND answer <> ''")
def _(s, d):
    u = normalize.unified_failures(s.createDataFrame(NESTED, NESTED_SCHEMA))
    return normalize.backfill_pairs(u).select("id", "task", F.get("messages", F.lit(1))["content"].alias("ask"), F.get("messages", F.lit(2))["content"].alias("answer"))


@query("source_tasks", f"SELECT x, {_case('x', rules.SOURCE_TASKS, 'diagnose')} AS task FROM (VALUES ('a_repair_prevent'), ('pairwise_rank'), ('compare'), ('detect_x'), ('none'), ('')) t(x)")
def _(s, d):
    rows = [("a_repair_prevent",), ("pairwise_rank",), ("compare",), ("detect_x",), ("none",), ("",)]
    return s.createDataFrame(rows, "x string").select("x", normalize.source_task(F.col("x")).alias("task"))


@query("classify_failure_types", f"WITH t(x) AS (VALUES ('HALLUCINated'), ('bad Schema'), ('missing tool'), ('a tool call'), ('ignored it'), ('too general'), ('PII leak'), ('stale'), ('clean_pass'), ('nothing'), ('')) SELECT x, {_case('lower(x)', rules.FAILURE_TYPES, 'other')} AS kind FROM t")
def _(s, d):
    rows = [(x,) for x in ("HALLUCINated", "bad Schema", "missing tool", "a tool call", "ignored it", "too general", "PII leak", "stale", "clean_pass", "nothing", "")]
    return s.createDataFrame(rows, "x string").select("x", normalize.failure_type(F.col("x")).alias("kind"))


@query("classify_documents", f"SELECT doc_id, {_case('lower(text)', TYPES, 'other')} AS kind FROM documents")
def _(s, d):
    return documents(s, d).select("doc_id", normalize.failure_type(F.col("text"), TYPES).alias("kind"))


@query("judge_traces", f"WITH {M} SELECT conv_id, 'judge' AS vertical, {_case('lower(' + FIRST.format('user') + ')', TYPES, 'other')} AS failure_type, len(ms)::INTEGER AS messages FROM m WHERE len(ms) >= 2 AND {TOTAL} >= 100")
def _(s, d):
    t = normalize.judge_traces(conversations(s, d), TYPES)
    return t.select("conv_id", "metadata.vertical", "metadata.failure_type", F.size("messages").alias("messages"))


def _prompt_sql(task: str, repair: str = "''") -> str:
    import re

    fields = {"source_model": "source_model", "vertical": "vertical", "failure_class": "failure_class", "errors": "errors", "user_prompt": "substr(user_prompt, 1, 2000)", "model_output": "substr(model_output, 1, 3000)", "repair_output": f"substr({repair}, 1, 3000)"}
    parts = re.split(r"\{(\w+)\}", rules.TEMPLATES[task])
    return " || ".join(fields[p] if k % 2 else "'" + p.replace("'", "''") + "'" for k, p in enumerate(parts) if p)


TASK_ROWS = "r AS (SELECT f.*, (i - 1)::INTEGER AS task_ord, ['diagnose', 'repair', 'prevent', 'detect', 'compare'][i] AS task FROM f, range(1, 6) t(i) WHERE user_prompt <> '')"
PROMPTS = "CASE task " + " ".join(f"WHEN '{t}' THEN {_prompt_sql(t)}" for t in rules.TASKS if t != "compare") + " END"


@query("task_rows", f"WITH {FAILED}, {TASK_ROWS} SELECT id, task_ord, task FROM r")
def _(s, d):
    return prompts.task_rows(failures(s, d)).select("id", "task_ord", "task")


@query("task_prompts", f"WITH {FAILED}, {TASK_ROWS} SELECT id, task, md5({PROMPTS}) AS h, len({PROMPTS})::INTEGER AS n FROM r WHERE task <> 'compare'")
def _(s, d):
    p = prompts.task_rows(failures(s, d)).where("task <> 'compare'").withColumn("p", prompts.prompt(F.col("task")))
    return p.select("id", "task", F.md5("p").alias("h"), F.length("p").alias("n"))


STUB = "CASE WHEN ('0x' || substr(md5({0}), 1, 6))::BIGINT % 7 <> 0 THEN 'root cause, step, check, evidence, score: ' || upper(md5({0})) || ' and the confidence is stated' END"
STAGE_A = f"a AS (SELECT *, {STUB.format(PROMPTS)} AS response FROM r WHERE task <> 'compare')"
STAGE_B = f"b AS (SELECT r.*, {STUB.format('(' + _prompt_sql('compare', chr(99) + 'oalesce(q.response, ' + chr(39) * 2 + ')') + ')')} AS response FROM r LEFT JOIN (SELECT id, response FROM a WHERE task = 'repair') q ON r.id = q.id WHERE r.task = 'compare')"


@query("inference_two_stages", f"WITH {FAILED}, {TASK_ROWS}, {STAGE_A}, {STAGE_B.replace('r.*', 'r.id, r.task, r.task_ord').replace('source_model', 'r.source_model').replace('vertical', 'r.vertical')} SELECT id, task, task_ord, response FROM a WHERE response IS NOT NULL UNION ALL SELECT id, task, task_ord, response FROM b WHERE response IS NOT NULL")
def _(s, d):
    p, _errors = infer.live_pairs(failures(s, d), lambda df: df.withColumn("response", infer.stub_response(F.col("request"))))
    return p.select("id", "task", "task_ord", F.get("messages", F.lit(2))["content"].alias("response"))


@query("inference_errors", f"WITH {FAILED}, {TASK_ROWS}, {STAGE_A}, {STAGE_B.replace('r.*', 'r.id, r.task, r.task_ord').replace('source_model', 'r.source_model').replace('vertical', 'r.vertical')} SELECT id, task FROM a WHERE response IS NULL UNION ALL SELECT id, task FROM b WHERE response IS NULL")
def _(s, d):
    _pairs, errors = infer.live_pairs(failures(s, d), lambda df: df.withColumn("response", infer.stub_response(F.col("request"))))
    return errors.select("id", "task")


# Vetting: G1-G7, J2


COHERENT = "CASE task " + " ".join(f"WHEN '{t}' THEN {_any('lower(text)', w)}" for t, w in WORDS.items()) + " ELSE false END"
VETTED = f"""k AS (SELECT DISTINCT md5(text) AS h FROM documents WHERE doc_id % 10 = 0), p AS (SELECT doc_id AS id, text, {PAIR_TASK} AS task, md5(text) AS h FROM documents),
g AS (SELECT id, text, task, {_strip('text')} <> '' AS g1, len(text) >= 50 AS g2, NOT ({_degenerate('text')}) AS g3, {COHERENT} AS g5, row_number() OVER (PARTITION BY h ORDER BY id) = 1 AND h NOT IN (SELECT h FROM k) AS g4 FROM p),
n AS (SELECT *, g1::INTEGER + g2::INTEGER + g3::INTEGER + g4::INTEGER + g5::INTEGER AS gates FROM g),
v AS (SELECT *, gates >= 4 AS passed, CASE gates WHEN 5 THEN 70 WHEN 4 THEN 60 ELSE 10 * gates END AS score,
    CASE WHEN gates >= 4 THEN 'pass' ELSE 'failed gates: ' || concat_ws(', ', CASE WHEN NOT g1 THEN 'source_tags' END, CASE WHEN NOT g2 THEN 'content_length' END, CASE WHEN NOT g3 THEN 'degenerate' END, CASE WHEN NOT g5 THEN 'coherence' END) END AS reason FROM n)"""


def vetted(s: SparkSession, d: str) -> DataFrame:
    known = documents(s, d).where("doc_id % 10 = 0").select(X.conversation_hash(F.array(X.message("system", F.lit("s")), X.message("user", F.lit("look at this")), X.message("assistant", F.col("text")))).alias("fingerprint"))
    return vet.vet(pairs(s, d).withColumn("answer", X.answer_fingerprint(F.col("messages"))), ["id"], known, keywords=WORDS)


@query("vet_pairs", f"WITH {VETTED} SELECT id, task, gates, passed, score, reason FROM v")
def _(s, d):
    return vetted(s, d).select("id", "task", "gates", "passed", "score", "reason")


@query("vet_all_combinations", """WITH c AS (SELECT i, (i & 1) > 0 AS g1, (i & 2) > 0 AS g2, (i & 4) > 0 AS g3, (i & 8) > 0 AS g5, (i & 16) > 0 AS g4 FROM range(32) t(i)),
n AS (SELECT *, g1::INTEGER + g2::INTEGER + g3::INTEGER + g4::INTEGER + g5::INTEGER AS gates FROM c)
SELECT i, gates, gates >= 4 AS passed, CASE gates WHEN 5 THEN 70 WHEN 4 THEN 60 ELSE 10 * gates END AS score, CASE WHEN gates >= 4 THEN 'pass' ELSE 'failed gates: ' || concat_ws(', ', CASE WHEN NOT g1 THEN 'source_tags' END,
    CASE WHEN NOT g2 THEN 'content_length' END, CASE WHEN NOT g3 THEN 'degenerate' END, CASE WHEN NOT g5 THEN 'coherence' END) END AS reason FROM n""")
def _(s, d):
    bits = s.range(32).select(F.col("id").alias("i"), *((F.col("id").bitwiseAND(1 << k) > 0).alias(f"gate_{g}") for k, g in enumerate(vet.GATES)), (F.col("id").bitwiseAND(16) > 0).alias("unseen"))
    return vet.scored(bits).select("i", "gates", "passed", "score", "reason")


@query("vet_counters", f"WITH {VETTED} SELECT task, count(*) AS raw, count(*) FILTER (passed) AS vetted, count(*) FILTER (NOT passed) AS rejected FROM v GROUP BY task")
def _(s, d):
    return state.counters(vetted(s, d), "task")


@query("vet_rejections", f"WITH {VETTED} SELECT reason, count(*) AS n FROM v WHERE NOT passed GROUP BY reason")
def _(s, d):
    return vetted(s, d).where("not passed").groupBy("reason").agg(F.count("*").alias("n"))


@query("known_fingerprints_anti_join", "SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0)")
def _(s, d):
    docs = documents(s, d).withColumn("fingerprint", X.sha256(F.col("text")))
    return sample.bloom_keep_new(docs, docs.where("doc_id % 10 = 0").select("fingerprint"), "fingerprint").select("doc_id")


# Deduplication, sampling, splits: W1-W8, U1, U2, H1, H2, H18


@query("dedup_keep_first", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256({_strip('lower(text)')})")
def _(s, d):
    return sample.keep_first(documents(s, d), X.sha256(X.strip(F.lower("text"))), ["doc_id"]).select("doc_id")


@query("dedup_conversations", f"WITH {M} SELECT min(conv_id) AS conv_id FROM m GROUP BY {FP}")
def _(s, d):
    return sample.keep_first(conversations(s, d), X.answer_fingerprint(F.col("messages")), ["conv_id"]).select("conv_id")


@query("dedup_removed", f"SELECT count(*) AS before, count(DISTINCT {_strip('lower(text)')}) AS after, count(*) - count(DISTINCT {_strip('lower(text)')}) AS removed, round(100 * (count(*) - count(DISTINCT {_strip('lower(text)')})) / count(*), 4) AS pct FROM documents")
def _(s, d):
    docs = documents(s, d)
    return assemble.removed(docs, sample.keep_first(docs, X.sha256(X.strip(F.lower("text"))), ["doc_id"]))


QUOTA = "q AS (SELECT lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY lang), z AS (SELECT *, row_number() OVER (ORDER BY n, f) - 1 AS r, count(*) OVER () AS k, sum(n) OVER () AS t FROM q), u AS (SELECT lang, n, CASE WHEN t <= 402 THEN n ELSE least(n, 402 // k + (r < 402 % k)::BIGINT) END AS take FROM z)"


@query("sample_strata_quota", f"WITH {QUOTA} SELECT lang, n, take FROM u")
def _(s, d):
    return sample.strata_quota(documents(s, d), "lang", 402, "doc_id")


@query("sample_stratified", f"WITH {QUOTA}, r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {KEY.format('doc_id')}, doc_id) AS r FROM documents) SELECT doc_id, r.lang FROM r JOIN u ON r.lang = u.lang WHERE r <= take")
def _(s, d):
    return sample.stratified_sample(documents(s, d), "lang", 402, "doc_id").select("doc_id", "lang")


@query("sample_shuffled_cap", f"SELECT doc_id FROM documents ORDER BY {KEY.format('doc_id')}, doc_id LIMIT 333")
def _(s, d):
    return sample.shuffled_cap(documents(s, d), 333, "doc_id").select("doc_id")


@query("sample_head_cap", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 200")
def _(s, d):
    return sample.head_cap(documents(s, d), 200, ["doc_id"]).select("doc_id", "n_chars")


@query("split_exact", f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {KEY.format('doc_id')}, doc_id) <= floor(count(*) OVER () * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS split FROM documents")
def _(s, d):
    return sample.exact_split(documents(s, d), 0.1, "doc_id").select("doc_id", "split")


@query("split_by_hash", f"SELECT doc_id, CASE WHEN ('0x' || substr({KEY.format('doc_id')}, 1, 12))::BIGINT / 281474976710656.0::DOUBLE < 0.1 THEN 'eval' ELSE 'train' END AS split FROM documents")
def _(s, d):
    return sample.hash_split(documents(s, d), 0.1, "doc_id").select("doc_id", "split")


@query("union_sources", "SELECT 0 AS source_ord, doc_id AS id, text, lang FROM documents UNION ALL SELECT 1, page_id, html, NULL FROM pages UNION ALL SELECT 2, item_id, text, NULL FROM benchmark")
def _(s, d):
    parts = [documents(s, d).select(F.col("doc_id").alias("id"), "text", "lang"), _table(s, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")), _table(s, d, "benchmark").select(F.col("item_id").alias("id"), "text")]
    return assemble.bag_union(parts).select("source_ord", "id", "text", "lang")


@query("counts_by_source", "SELECT source, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY source")
def _(s, d):
    return assemble.counts_by(documents(s, d), F.col("source"), "source", "doc_id")


@query("counts_by_failure_type", f"SELECT {_case('lower(text)', TYPES, 'other')} AS kind, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY 1")
def _(s, d):
    return assemble.counts_by(documents(s, d), normalize.failure_type(F.col("text"), TYPES), "kind", "doc_id")


ASSEMBLED = f"""{M}, x AS (SELECT 0 AS so, 'c' AS sp, conv_id AS ln, {FP} AS fp FROM m), b AS (SELECT 1 AS so, 'd' AS sp, doc_id AS ln, sha256({_strip('lower(text)')}) AS fp FROM documents),
k AS (SELECT so, sp, ln, row_number() OVER (PARTITION BY fp ORDER BY so, sp, ln) AS r FROM (SELECT * FROM x UNION ALL SELECT * FROM b)), u AS (SELECT so, sp, ln, so || '|' || sp || '|' || ln AS key FROM k WHERE r = 1),
a AS (SELECT so, sp, ln, CASE WHEN row_number() OVER (ORDER BY {KEY.format('key')}, key) <= floor(count(*) OVER () * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS split FROM u)"""


def assembled(s: SparkSession, d: str) -> DataFrame:
    a = conversations(s, d).select("messages", F.lit("c").alias("source_path"), F.col("conv_id").alias("line_no"))
    b = pairs(s, d).select("messages", F.lit("d").alias("source_path"), F.col("id").alias("line_no"))
    return assemble.assemble([a, b])


@query("assemble_split", f"WITH {ASSEMBLED} SELECT so AS source_ord, ln AS line_no, split FROM a")
def _(s, d):
    return assembled(s, d).select("source_ord", "line_no", "split")


@query("path_order", "SELECT path, (dense_rank() OVER (ORDER BY string_split(path, '/')) - 1)::INTEGER AS file_ord FROM (VALUES ('a/b.x'), ('a.x/b'), ('a/b/c'), ('a'), ('b/a')) t(path)")
def _(s, d):
    from loomset.sources.records import path_order

    return path_order(s.createDataFrame([("a/b.x",), ("a.x/b",), ("a/b/c",), ("a",), ("b/a",)], "path string"))


# Stamping, seal, ledger: C11-C14, H11-H13, C17, K7


CELLS = f"""{VETTED}, c AS (SELECT v.id, sha256({_strip('lower(v.text)')}) AS fingerprint, coalesce(d.lang, 'general') AS domain, v.task AS task_type, v.score AS verification_score FROM v JOIN documents d ON d.doc_id = v.id WHERE passed),
e AS (SELECT *, substr(sha256(fingerprint || '|' || task_type || '|' || id), 1, 32) AS cell_id, CASE WHEN verification_score >= 80 THEN 'honey' WHEN verification_score >= 60 THEN 'cluster' ELSE 'cell' END AS grade FROM c)"""


def cells(s: SparkSession, d: str) -> DataFrame:
    return seal.stamp(vetted(s, d).where("passed"))


@query("stamp_cells", f"WITH {CELLS} SELECT cell_id, fingerprint, domain, task_type, verification_score, grade, id::VARCHAR AS source_pair_id FROM e")
def _(s, d):
    return cells(s, d).select("cell_id", "fingerprint", "domain", "task_type", "verification_score", "grade", "source_pair_id")


@query("ledger_pairs", f"WITH {CELLS} SELECT cell_id AS pair_id, fingerprint, domain, task_type, verification_score AS score, grade AS tier, 'curator' AS gen_model, 'loomset' AS cook_script, id::VARCHAR AS source_file FROM e")
def _(s, d):
    return seal.ledger_pairs(cells(s, d))


@query("ledger_average_score", f"WITH {CELLS} SELECT round(avg(nullif(verification_score, 0)), 1) AS avg_score FROM e")
def _(s, d):
    return seal.average_score(cells(s, d))


@query("ledger_grades", f"WITH {CELLS} SELECT grade, count(*) AS n FROM e GROUP BY grade")
def _(s, d):
    return seal.grade_distribution(cells(s, d)).select(F.explode("grades").alias("grade", "n"))


ROOT = """t(lvl, i, h) AS (SELECT 0, row_number() OVER (ORDER BY {0}) - 1, {1} FROM {2}
    UNION ALL SELECT * FROM (WITH x AS (SELECT * FROM t) SELECT any_value(lvl) + 1, i // 2, sha256(arg_min(h, i) || arg_max(h, i)) FROM x GROUP BY i // 2 HAVING (SELECT count(*) FROM x) > 1))"""


@query("seal_root", f"WITH RECURSIVE {ROOT.format('doc_id', 'sha256(text)', 'documents')} SELECT h AS root, 'BATCH-LS-' || substr(sha256(h), 1, 12) AS batch_id FROM t ORDER BY lvl DESC LIMIT 1")
def _(s, d):
    root = seal.hash_root(documents(s, d).select("doc_id", X.sha256(F.col("text")).alias("h")), "h", "doc_id")
    return s.createDataFrame([(root,)], "root string").select("root", seal.batch_id(F.col("root")).alias("batch_id"))


@query("ledger_header", f"""WITH RECURSIVE {CELLS}, {ROOT.format('id', 'fingerprint', 'e')}, root AS (SELECT h FROM t ORDER BY lvl DESC LIMIT 1), counted AS (SELECT grade, count(*) AS n FROM e GROUP BY grade)
SELECT 'BATCH-LS-' || substr(sha256(h), 1, 12) AS batch_id, 'general' AS domain, h AS merkle_root, 1.0::DOUBLE AS gate_pass_rate, (SELECT round(avg(nullif(verification_score, 0)), 1) FROM e) AS avg_score,
    (SELECT '{{' || string_agg('"' || grade || '":' || n, ',' ORDER BY grade) || '}}' FROM counted) AS tier_distribution, '' AS audit_timestamp, 0.0::DOUBLE AS contamination_rate, 0 AS think_tags_found FROM root""")
def _(s, d):
    rows = seal.stamp(vetted(s, d).where("passed"), carry=["id"])
    header, _pairs = seal.ledger_batch(rows, "id")
    return header.withColumn("tier_distribution", F.to_json("tier_distribution"))


@query("ledger_pushed", f"WITH {CELLS} SELECT cell_id, 'BATCH-LS-x' AS pushed_in FROM e")
def _(s, d):
    return seal.mark_pushed(cells(s, d), "BATCH-LS-x").select("cell_id", "pushed_in")


@query("lineage_manifest", """WITH n AS (SELECT count(*) AS n FROM documents), l AS (SELECT 'curator' AS model_id, 'BATCH-LS-' || substr(sha256('train'), 1, 12) AS batch_id, 'run-2024-01-02' AS training_run_id, n AS pairs_used, 0.5::DOUBLE AS loss, 0.0::DOUBLE AS eval_loss, '2024-01-02T03:04:05' AS trained_at FROM n)
SELECT model_id, batch_id, pairs_used, '{"model_id":"curator","batch_id":"' || batch_id || '","training_run_id":"run-2024-01-02","pairs_used":' || pairs_used || ',"loss":0.5,"eval_loss":0.0,"trained_at":"2024-01-02T03:04:05"}' AS manifest FROM l""")
def _(s, d):
    import hashlib

    row = seal.lineage(hashlib.sha256(b"train").hexdigest(), "2024-01-02T03:04:05", documents(s, d).count(), 0.5, s)
    return row.select("model_id", "batch_id", "pairs_used").crossJoin(seal.manifest(row))  # one row each


@query("preflight_report", f"WITH {M}, t AS (SELECT * FROM m WHERE conv_id % 10 > 0) SELECT (SELECT count(*) FROM t) AS train_count, (SELECT count(*) FROM m WHERE conv_id % 10 = 0) AS eval_count, (SELECT count(DISTINCT substr(ms[1].content, 1, 100)) FROM t WHERE ms[1].role = 'system') AS system_prompt_diversity, (SELECT count(*) FROM t) >= 400 AS enough")
def _(s, d):
    c = conversations(s, d)
    return audit.preflight_report(c.where("conv_id % 10 > 0"), c.where("conv_id % 10 = 0"), least=400)


@query("audit_result", f"WITH {M}, g AS (SELECT coalesce({GATE}, 'clean') AS gate, {FP} AS fp FROM m), r AS (SELECT gate, count(*) AS n FROM g WHERE gate <> 'clean' GROUP BY gate) SELECT 'all' AS file, count(*) AS total, count(*) FILTER (gate = 'clean') AS clean, count(*) FILTER (gate <> 'clean') AS rejected, count(*) - count(DISTINCT fp) AS dups, (SELECT '{{' || coalesce(string_agg('\"' || gate || '\":' || n, ',' ORDER BY gate), '') || '}}' FROM r) AS rejections FROM g")
def _(s, d):
    return audit.audit_result(conversations(s, d), "all").withColumn("rejections", F.to_json("rejections"))


@query("domain_remap", "SELECT x, CASE WHEN x IS NULL OR x = 'failure_analysis' THEN 'general' ELSE x END AS domain FROM (VALUES ('failure_analysis'), ('law'), (NULL)) t(x)")
def _(s, d):
    return s.createDataFrame([("failure_analysis",), ("law",), (None,)], "x string").select("x", seal.domain(F.col("x")).alias("domain"))


@query("training_steps", "SELECT n, floor(n // 32 * 0.8::DOUBLE)::BIGINT AS steps FROM (VALUES (0), (31), (32), (202500), (1000)) t(n)")
def _(s, d):
    return s.createDataFrame([(0,), (31,), (32,), (202500,), (1000,)], "n int").select("n", assemble.training_steps(F.col("n")).alias("steps"))


@query("run_totals", "SELECT source AS shard, count(*)::BIGINT AS records, sum(n_chars)::BIGINT AS raw, count(*) FILTER (lang = 'en') AS vetted, 0::BIGINT AS cells, count(*) FILTER (n_chars < 50) AS errors FROM documents GROUP BY ROLLUP (source)")
def _(s, d):
    m = documents(s, d).groupBy(F.col("source").alias("shard")).agg(F.count("*").alias("records"), F.sum("n_chars").alias("raw"), F.count_if(F.col("lang") == "en").alias("vetted"), F.lit(0).cast("long").alias("cells"), F.count_if(F.col("n_chars") < 50).alias("errors"))
    return seal.run_totals(m)


# Incremental state: J1, T1-T3


@query("state_unprocessed", "SELECT path, sha256 FROM (VALUES ('a', '1'), ('a2', '9'), ('b', '2'), ('c', '1')) t(path, sha256) WHERE (path, sha256) NOT IN (VALUES ('a', '1'), ('b', '1'))")
def _(s, d):
    files = s.createDataFrame([("a", "1"), ("a2", "9"), ("b", "2"), ("c", "1")], "path string, sha256 string")
    return state.unprocessed(files, s.createDataFrame([("a", "1"), ("b", "1")], "path string, sha256 string"))


@query("state_totals", "SELECT count(*)::BIGINT AS records, sum(value)::BIGINT AS raw, count(*) FILTER (event_type = 'error') AS vetted, 0::BIGINT AS rejected, 0::BIGINT AS cells, 0::BIGINT AS errors FROM (SELECT event_type, 1 AS value FROM events)")
def _(s, d):
    zero = F.lit(0).cast("long")
    e = _table(s, d, "events").groupBy("user_id").agg(F.count("*").alias("records"), F.count("*").alias("raw"), F.count_if(F.col("event_type") == "error").alias("vetted"), zero.alias("rejected"), zero.alias("cells"), zero.alias("errors"))
    return state.totals(e)


@query("state_commits", "SELECT source AS shard, count(*) AS records, (SELECT count(DISTINCT sha256(text)) FROM documents e WHERE e.source = d.source) AS fingerprints FROM documents d GROUP BY source")
def _(s, d):
    """Two attempts, of which the first dies before its shards are marked: only what the second wrote counts."""
    path = new_path(s, "state")
    docs = documents(s, d).select(F.col("source").alias("shard_key"), X.sha256(F.col("text")).alias("fingerprint"))
    n = docs.groupBy("shard_key").agg(F.count("*").alias("records"))
    metrics = n.select("shard_key", F.lit("run").alias("run_id"), F.col("shard_key").alias("shard"), "records", *(F.lit(0).cast("long").alias(c) for c in state.COUNTERS[1:]))
    state.append(docs.withColumn("attempt", F.lit("one")), path, "fingerprints")
    state.append(metrics.withColumn("attempt", F.lit("one")), path, "metrics")
    shards = n.select("shard_key", F.col("shard_key").alias("path"), F.lit("").alias("sha256"), "records", *(F.lit(0).cast("long").alias(c) for c in ("pairs_generated", "pairs_vetted", "cells_stamped")))
    none = s.createDataFrame([], "shard_key string, id string, task string, error string")
    state.commit(path, "two", shards, docs, metrics, none)
    seen = state.load(s, path, "fingerprints").groupBy("shard_key").agg(F.count("*").alias("fingerprints"))
    return state.load(s, path, "metrics").join(seen, "shard_key").select("shard", "records", "fingerprints")


@query("state_default", "SELECT 0::BIGINT AS shards, 0::BIGINT AS fingerprints")
def _(s, d):
    path = new_path(s, "state")
    return state.load(s, path, "shards").agg(F.count("*").alias("shards")).crossJoin(state.load(s, path, "fingerprints").agg(F.count("*").alias("fingerprints")))  # one row each


@query("time_formats", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS compact FROM events")
def _(s, d):
    return _table(s, d, "events").select("event_id", state.stamp_of(F.col("ts")).alias("iso"), state.stamp_of(F.col("ts"), compact=True).alias("compact"))


@query("reconcile_chunks", """WITH r AS (SELECT doc_id, doc_id % 4 AS chunk, row_number() OVER (PARTITION BY text, doc_id % 4 ORDER BY doc_id) AS k, min(doc_id % 4) OVER (PARTITION BY text) AS first FROM documents)
SELECT doc_id, CASE WHEN k > 1 THEN 'chunk duplicate' WHEN chunk <> first THEN 'cross duplicate' ELSE 'kept' END AS state FROM r""")
def _(s, d):
    docs = documents(s, d).select("doc_id", (F.col("doc_id") % 4).alias("chunk"), X.sha256(F.col("text")).alias("fingerprint"))
    return sample.reconciled(docs, "fingerprint", "chunk", ["doc_id"]).select("doc_id", "state")


# Readers: S1-S14, A1-A6 from files. The driver's tables are written as JSON lines, with blank and broken lines between.


#: Bytes of text that one task gets on average, at most, when lines are written.
SHARE = 64 << 20


def _written(table: DataFrame, rows: DataFrame, key: str, line: Column) -> str:
    """Lines of rows as text files, in a folder for each key % 4: a broken line after each seventh key, a blank one after each fifth.

    Rows are dealt by ranges of key within each folder, whose files, in order of their names, hold its lines in order. There are as
    many ranges as the texts of table, which the rows are made of, have shares, where the session has fewer shuffle partitions.
    """
    more = F.filter(
        F.array(F.struct(F.lit(0).alias("k"), line.alias("line")), F.struct(F.lit(1).alias("k"), F.concat(F.lit('{"id": '), F.col(key)).alias("line")), F.struct(F.lit(2).alias("k"), F.lit(" ").alias("line"))),
        lambda x: (x["k"] == 0) | ((x["k"] == 1) & (F.col(key) % 7 == 0)) | ((x["k"] == 2) & (F.col(key) % 5 == 0)),
    )
    path = new_path(rows.sparkSession, "json-lines")
    part = F.col(key) % 4
    n = -(-(table.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARE)
    rows = rows.repartitionByRange(n, part, key) if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartitionByRange(part, key)
    rows = rows.select(part.alias("part"), key, F.explode(more).alias("x")).select("part", key, "x.k", "x.line")
    rows.sortWithinPartitions("part", key, "k").select("part", "line").write.partitionBy("part").text(path)
    return path


LINES = "l AS (SELECT {0}, {0} % 4 AS part, k, row_number() OVER (PARTITION BY {0} % 4 ORDER BY {0}, k) AS line_no{2} FROM {1}, range(3) t(k) WHERE k = 0 OR (k = 1 AND {0} % 7 = 0) OR (k = 2 AND {0} % 5 = 0))"
DOC_LINES = LINES.format("doc_id", "documents", ", text")


def _part(path: str = "source_path"):
    return F.regexp_extract(path, "part=([0-9]+)", 1).cast("long").alias("part")


def document_lines(s: SparkSession, d: str) -> str:
    fields = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("a_b_c").alias("source"), F.col("text").alias("instruction"), F.col("lang").alias("output"))
    docs = documents(s, d)
    return _written(docs, docs, "doc_id", F.to_json(fields))


def conversation_lines(s: SparkSession, d: str) -> str:
    """Conversations, of which some lack their messages and some have a text instead."""
    c = conversations(s, d)
    line = F.when(F.col("conv_id") % 11 == 0, '{"other": 1}').when(F.col("conv_id") % 13 == 0, '{"messages": "none"}').otherwise(F.to_json(F.struct("messages")))
    return _written(_table(s, d, "conversations"), c, "conv_id", line)


@query("jsonl_lenient_scan", f"WITH {DOC_LINES} SELECT part, line_no, doc_id::VARCHAR AS id, md5(text) AS h FROM l WHERE k = 0")
def _(s, d):
    ok, _bad = records.read_lenient(s, document_lines(s, d), records.FAILURE, folders=True)
    return ok.select(_part(), "line_no", "id", F.md5("instruction").alias("h"))


@query("jsonl_quarantine", f"WITH {DOC_LINES} SELECT part, line_no, '{{\"id\": ' || doc_id AS line FROM l WHERE k = 1")
def _(s, d):
    _ok, bad = records.read_lenient(s, document_lines(s, d), records.FAILURE, folders=True)
    return bad.select(_part(), "line_no", "line")


@query("jsonl_line_counts", f"WITH {DOC_LINES} SELECT part, count(*) FILTER (k < 2) AS lines FROM l GROUP BY part")
def _(s, d):
    return records.line_counts(s, document_lines(s, d), folders=True).select(_part(), "lines")


@query("jsonl_skipping", f"WITH {DOC_LINES} SELECT doc_id::VARCHAR AS id, md5(text) AS h FROM l WHERE k = 0")
def _(s, d):
    return records.read_skipping(s, document_lines(s, d), records.FAILURE).select("id", F.md5("instruction").alias("h"))


@query("jsonl_audit", f"""WITH {M}, {LINES.format("conv_id", "m", ", ms")}, g AS (SELECT part, line_no, CASE WHEN conv_id % 11 = 0 OR conv_id % 13 = 0 THEN 'format' ELSE {GATE} END AS gate,
    CASE WHEN conv_id % 11 = 0 THEN 'no messages' WHEN conv_id % 13 = 0 THEN 'messages are no list of objects' ELSE {DETAIL} END AS detail FROM l WHERE k = 0)
SELECT part, line_no, gate, 'line ' || line_no || ': ' || detail AS detail FROM g""")
def _(s, d):
    rows, _bad = audit.file_records(records.read_for_audit(s, conversation_lines(s, d), folders=True))
    return audit.gated(rows).select(_part(), "line_no", "gate", "detail")


@query("jsonl_parse_errors", f"WITH {LINES.format('conv_id', '(SELECT DISTINCT conv_id FROM conversations)', '')} SELECT part, line_no FROM l WHERE k = 1")
def _(s, d):
    _rows, bad = audit.file_records(records.read_for_audit(s, conversation_lines(s, d), folders=True))
    return bad.select(_part(), "line_no")


@query("jsonl_training", f"WITH {M} SELECT md5(ms[1].content) AS first, len(ms)::INTEGER AS messages FROM m WHERE len(ms) >= 2")
def _(s, d):
    path = new_path(s, "training")
    conversations(s, d).where("size(messages) >= 2").select("messages").write.json(path)
    rows = records.read_training(s, path)
    return rows.select(F.md5(F.get("messages", F.lit(0))["content"]).alias("first"), F.size("messages").alias("messages"))


@query("jsonl_cells", f"WITH {CELLS} SELECT cell_id, fingerprint, domain, task_type, verification_score, grade, id::VARCHAR AS source_pair_id FROM e")
def _(s, d):
    path = new_path(s, "cells")
    cells(s, d).write.json(path)
    return records.read_strict(s, path, records.CELL)


@query("assemble_write", f"WITH {ASSEMBLED} SELECT split, count(*) AS n, count(DISTINCT sp) AS sources FROM a GROUP BY split")
def _(s, d):
    path = new_path(s, "data-set")
    with scratch(s):  # the union goes once full/ is written
        assemble.write_full(assembled(s, d), path)
    assemble.write_lines(s, path)
    n = None
    for part in ("train", "eval"):
        one = s.read.schema(records.CONVERSATION).json(f"{path}/{part}").agg(F.lit(part).alias("split"), F.count("messages").alias("n"))
        n = one if n is None else n.union(one)
    return n.join(s.read.parquet(f"{path}/full").groupBy("split").agg(F.count_distinct("source_path").alias("sources")), "split")


@query("jsonl_discover", """SELECT doc_id % 4 AS part, sha256(string_agg('{"id":' || doc_id || ',"n_chars":' || n_chars || '}' || chr(10), '' ORDER BY doc_id)) AS sha256,
    sum(strlen('{"id":' || doc_id || ',"n_chars":' || n_chars || '}') + 1)::BIGINT AS bytes FROM documents GROUP BY 1""")
def _(s, d):
    path = new_path(s, "shards")
    rows = documents(s, d).select("doc_id", (F.col("doc_id") % 4).alias("part"), F.to_json(F.struct(F.col("doc_id").alias("id"), "n_chars")).alias("line"))
    rows.repartition(4, "part").sortWithinPartitions("part", "doc_id").select("part", "line").write.partitionBy("part").text(path)
    records.require(s, path)
    return records.discover(s, path, "part-*.txt").select(_part("path"), "sha256", "bytes")


# Specified checks: Z1-Z14


@query("balance_sources", "SELECT source, n, pct, pct > 5.0 AS over FROM (SELECT source, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY source)")
def _(s, d):
    return balance.shares(documents(s, d), "source", 5.0)


@query("balance_targets", "WITH t(kind, low, high) AS (VALUES ('ending', 60.0::DOUBLE, 70.0::DOUBLE), ('licence', 1.0, 2.0), ('none', 5.0, 10.0)), c AS (SELECT " + _case("lower(text)", TYPES, "other") + " AS kind, count(*) AS n FROM documents GROUP BY 1), p AS (SELECT kind, n, round(100 * n / sum(n) OVER (), 4) AS pct FROM c), j AS (SELECT t.kind, low, high, coalesce(n, 0) AS n, coalesce(pct, 0) AS pct FROM t LEFT JOIN p ON t.kind = p.kind) SELECT *, CASE WHEN pct < low THEN 'below' WHEN pct > high THEN 'above' ELSE 'within' END AS state FROM j")
def _(s, d):
    return balance.target_bands(documents(s, d).select(normalize.failure_type(F.col("text"), TYPES).alias("kind")), "kind", {"ending": (60, 70), "licence": (1, 2), "none": (5, 10)})


@query("allow_list", "SELECT conv_id, text AS prompt FROM conversations WHERE role = 'system' AND text NOT IN (SELECT text FROM conversations WHERE role = 'system' AND conv_id % 2 = 0)")
def _(s, d):
    p = _table(s, d, "conversations").where("role = 'system'").select("conv_id", F.col("text").alias("prompt"))
    return balance.unexpected(p, "prompt", p.where("conv_id % 2 = 0")).select("conv_id", "prompt")


LEAK = r"SELECT {0}, unnest([array_to_string(w[i : i + 7], ' ') FOR i IN range(1, len(w) - 6)]) AS g FROM (SELECT {0}, list_filter(regexp_split_to_array(lower(text), '[ \t\n\r\f\x0b]+'), lambda x: x <> '') AS w FROM {1}) WHERE len(w) >= 8"


@query("leak_check", f"WITH a AS ({LEAK.format('doc_id', 'documents')}), b AS ({LEAK.format('item_id', 'benchmark')}) SELECT DISTINCT doc_id FROM a WHERE g IN (SELECT g FROM b)")
def _(s, d):
    return balance.leaked(documents(s, d), _table(s, d, "benchmark")).select("doc_id")


@query("tier_counts", "SELECT CASE WHEN x >= 80 THEN 'honey' WHEN x >= 60 THEN 'cluster' ELSE 'cell' END AS tier, count(*) AS n FROM (SELECT 40 + doc_id % 61 AS x FROM documents) GROUP BY 1")
def _(s, d):
    return balance.tiers(documents(s, d).select((40 + F.col("doc_id") % 61).alias("x")), "x")


@query("domain_scores", "SELECT lang, count(*) AS n, round(avg(40 + doc_id % 61), 1) AS avg_score, round(100 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents GROUP BY lang")
def _(s, d):
    return balance.by_domain(documents(s, d).withColumn("x", 40 + F.col("doc_id") % 61), "lang", "x")


@query("configuration_scores", "SELECT source, count(*) AS n, round(avg(40 + doc_id % 61), 1) AS avg_score, round(100 * count(*) FILTER (40 + doc_id % 61 >= 80) / count(*), 4) AS top_rate FROM documents GROUP BY source")
def _(s, d):
    return balance.by_configuration(documents(s, d).withColumn("x", 40 + F.col("doc_id") % 61), "source", "x")


@query("scarce_weights", "SELECT doc_id, i::INTEGER AS copy FROM documents, range(1, 4) t(i) WHERE i <= CASE lang WHEN 'es' THEN 3 WHEN 'de' THEN 2 ELSE 1 END")
def _(s, d):
    return balance.weighted(documents(s, d), "lang", {"es": 3, "de": 2}).select("doc_id", "copy")


@query("invalid_json", "SELECT id FROM (VALUES (1, '{\"a\": 1}'), (2, '{a}'), (3, NULL), (4, '[1, 2]'), (5, '{\"a\": ')) t(id, x) WHERE x IS NULL OR NOT json_valid(x)")
def _(s, d):
    rows = [(1, '{"a": 1}'), (2, "{a}"), (3, None), (4, "[1, 2]"), (5, '{"a": ')]
    return balance.invalid_json(s.createDataFrame(rows, "id int, x string"), "x").select("id")


@query("failure_taxonomy", "SELECT * FROM (VALUES ('reasoning', 'missing_step'), ('reasoning', 'false_assumption'), ('knowledge', 'hallucination'), ('knowledge', 'overgeneralization'), ('instruction', 'drift'), ('instruction', 'schema_break'), ('agent', 'tool_misuse')) t(family, mode)")
def _(s, d):
    return balance.taxonomy(s)


@query("pack_sequences", """WITH RECURSIVE p AS (SELECT doc_id, ceil(len(text) / 4)::BIGINT AS t, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 16 AS shard FROM documents),
o AS (SELECT shard, t, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS k FROM p),
r AS (SELECT shard, k, t, t AS used, 0::BIGINT AS bin FROM o WHERE k = 1 UNION ALL
    SELECT o.shard, o.k, o.t, CASE WHEN r.used > 0 AND r.used + o.t > 4096 THEN o.t ELSE r.used + o.t END, CASE WHEN r.used > 0 AND r.used + o.t > 4096 THEN r.bin + 1 ELSE r.bin END FROM r JOIN o ON o.shard = r.shard AND o.k = r.k + 1)
SELECT shard, bin, count(*) AS n, sum(t)::BIGINT AS tokens FROM r GROUP BY shard, bin""")
def _(s, d):
    p = balance.packed(documents(s, d).select("doc_id", balance.token_estimate(F.col("text")).alias("tokens")), "tokens", "doc_id", shards=16)
    return p.groupBy("shard", "bin").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
