"""Registered grading queries (X6: D13-D17, J1-J5, J7-J9, S5, U1).

Items, recorded responses and recorded run outputs are derived by fixed
rules from the driver's tables; every query reads its whole table(s).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.functions import text as X
from rankforge.operators import grading as G
from rankforge.plans.catalog_text import (_DHOLES, _HOLES, _HPAT, NL, d_join, d_rstrip, d_rstrip_lines,
                                          d_splitlines, d_strip)

Q: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _tbl(spark, sf, name):
    return fx.table(spark, sf, name)


def _d_norm(x):
    return d_join(d_rstrip_lines(d_splitlines(d_rstrip(x))))


def _d_canon(x):
    y = (f"regexp_replace(replace(replace(coalesce({x}, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), "
         "'\\n$', '')")
    return d_join(d_rstrip_lines(f"string_split({y}, {NL})"))


def _d_j4(j, depth=3):
    """DuckDB J4 over valid JSON: strings, scalars and lists nested to ``depth``."""
    item = f"coalesce(json_extract_string(e{depth}, '$'), 'null')" if depth == 1 else _d_j4(f"e{depth}", depth - 1)
    return (f"(CASE WHEN json_type({j}) = 'VARCHAR' THEN json_extract_string({j}, '$') "
            f"WHEN json_type({j}) = 'ARRAY' THEN array_to_string(list_transform(json_extract({j}, '$[*]'), "
            f"lambda e{depth}: {item}), {NL}) ELSE coalesce(CAST(json({j}) AS VARCHAR), 'null') END)")


# ---- D15 + J4 + J5 (deduction cases over lineitem) ------------------------------------
_CASES = [
    "l_orderkey AS item_id",
    "CASE l_returnflag WHEN 'N' THEN 'stdin_stdout' WHEN 'A' THEN 'function_call' ELSE 'other' END AS type",
    "CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN '[null,[\"[a\",[\"b\"]]]' "
    "WHEN l_linenumber = 6 THEN '{bad' "
    "WHEN l_returnflag = 'A' THEN concat('[', CAST(CAST(l_quantity AS INT) AS STRING), ', \"x\"]') "
    "WHEN l_linenumber % 2 = 0 THEN concat('\"', CAST(CAST(l_quantity AS INT) AS STRING), '\"') "
    "ELSE concat('[\"', CAST(CAST(l_quantity AS INT) AS STRING), '\", \"ok\"]') END AS output",
    "CASE WHEN l_discount < 0.02 THEN 'wrong' WHEN l_linenumber = 4 THEN 'null' "
    "WHEN l_linenumber = 5 THEN 'null\\n[a\\nb' "
    "WHEN l_returnflag = 'A' THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '\\n') "
    "WHEN l_linenumber % 2 = 0 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '   \\n\\n') "
    "ELSE concat(CAST(CAST(l_quantity AS INT) AS STRING), '  \\nok\\n') END AS got",
    "CASE WHEN l_tax = 0 THEN 'Traceback: boom' WHEN l_tax = 0.01 THEN '  ' ELSE '' END AS stderr",
]
_D_CASES = (
    "SELECT l_orderkey AS item_id, "
    "CASE l_returnflag WHEN 'N' THEN 'stdin_stdout' WHEN 'A' THEN 'function_call' ELSE 'other' END AS type, "
    "CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN '[null,[\"[a\",[\"b\"]]]' "
    "WHEN l_linenumber = 6 THEN '{bad' "
    "WHEN l_returnflag = 'A' THEN concat('[', CAST(CAST(l_quantity AS INT) AS VARCHAR), ', \"x\"]') "
    "WHEN l_linenumber % 2 = 0 THEN concat('\"', CAST(CAST(l_quantity AS INT) AS VARCHAR), '\"') "
    "ELSE concat('[\"', CAST(CAST(l_quantity AS INT) AS VARCHAR), '\", \"ok\"]') END AS output, "
    "CASE WHEN l_discount < 0.02 THEN 'wrong' WHEN l_linenumber = 4 THEN 'null' "
    f"WHEN l_linenumber = 5 THEN concat('null', {NL}, '[a', {NL}, 'b') "
    f"WHEN l_returnflag = 'A' THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), {NL}) "
    f"WHEN l_linenumber % 2 = 0 THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), '   ', {NL}, {NL}) "
    f"ELSE concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), '  ', {NL}, 'ok', {NL}) END AS got, "
    "CASE WHEN l_tax = 0 THEN 'Traceback: boom' WHEN l_tax = 0.01 THEN '  ' ELSE '' END AS stderr "
    "FROM lineitem")

_DED_SQL = f"""
WITH r AS ({_D_CASES}),
c AS (SELECT * EXCLUDE (output), CASE WHEN output IS NULL THEN 'null' WHEN json_valid(output) THEN output END AS output FROM r),
e AS (SELECT *, CASE WHEN output IS NULL THEN NULL WHEN type = 'stdin_stdout' THEN {_d_j4('output')}
                     WHEN type = 'function_call' THEN
                          CASE WHEN json_type(output) = 'ARRAY' AND json_array_length(output) > 0
                               THEN {_d_j4("json_extract(output, '$[0]')")} ELSE {_d_j4('output')} END
                END AS exp FROM c),
k AS (SELECT item_id, type IN ('stdin_stdout', 'function_call') AS known,
             {d_strip("coalesce(stderr, '')")} = ''
             AND coalesce({_d_norm("coalesce(got, '')")} = {_d_norm('exp')}, false) AS correct FROM e)
SELECT item_id, count(*) FILTER (WHERE known AND correct) AS passed, count(*) FILTER (WHERE known) AS total,
       CAST(CASE WHEN count(*) FILTER (WHERE known AND correct) = count(*) FILTER (WHERE known) THEN 1.0 ELSE 0.0 END
            AS DOUBLE) AS score
FROM k GROUP BY item_id"""


@register("ded_cases_li", _DED_SQL)
def ded_cases_li(spark: SparkSession, sf: str) -> DataFrame:
    c = _tbl(spark, sf, "lineitem").selectExpr(*_CASES)
    return G.grade_cases(c)


# ---- HVM: T10 + J7 + S5 + all-pass --------------------------------------------------------
_HVM_ITEM = [
    "o_orderkey AS item_id",
    f"{_HOLES} AS response",
    "CASE WHEN o_orderkey % 17 = 0 THEN array('?a', '?b', '?c') ELSE array('?a', '?b') END AS holes",
    "map('?a', sequence(CAST(0 AS BIGINT), CAST(60 AS BIGINT)), '?b', sequence(CAST(-6 AS BIGINT), CAST(0 AS BIGINT)))"
    " AS domains",
    "array(concat('out', CAST(o_custkey % 100 AS STRING)), CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE 'x\\r\\n' END)"
    " AS expected",
    "array(concat('out', CAST(o_custkey % 100 AS STRING), '  \\n'), "
    "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'y' ELSE 'x' END) AS got",
]


@register("holes_grade_orders", f"""
WITH d AS (SELECT o_orderkey, o_custkey, {_DHOLES} AS x FROM orders),
b AS (SELECT o_orderkey, o_custkey, regexp_extract_all(x, '(?is)<HOLES>\\s*(.*?)\\s*</HOLES>', 1)[-1] AS blk FROM d),
l AS (SELECT *, list_filter(list_transform({d_splitlines(d_strip('blk'))}, lambda z: {d_strip('z')}),
                            lambda z: z <> '' AND NOT starts_with(z, '#')) AS body FROM b),
v AS (SELECT *, blk IS NULL OR len(list_filter(body, lambda z: NOT regexp_matches(z, '{_HPAT}'))) > 0 AS bad,
             list_distinct(list_transform(body, lambda z: regexp_extract(z, '{_HPAT}', 1))) AS ks,
             CAST(regexp_extract(list_filter(body, lambda z: regexp_extract(z, '{_HPAT}', 1) = '?a')[-1],
                                 '{_HPAT}', 2) AS BIGINT) AS va,
             CAST(regexp_extract(list_filter(body, lambda z: regexp_extract(z, '{_HPAT}', 1) = '?b')[-1],
                                 '{_HPAT}', 2) AS BIGINT) AS vb FROM l),
r AS (SELECT o_orderkey,
             CASE WHEN bad THEN 'missing'
                  WHEN list_sort(ks) <> list_sort(CASE WHEN o_orderkey % 17 = 0 THEN ['?a', '?b', '?c']
                                                      ELSE ['?a', '?b'] END) THEN 'not_all'
                  WHEN NOT (va BETWEEN 0 AND 60 AND vb BETWEEN -6 AND 0) THEN 'domain' END AS reason,
             len(list_filter(range(1, 3), lambda i: {_d_canon("[concat('out', CAST(o_custkey % 100 AS VARCHAR)), 'x' || chr(13) || chr(10)][i]")}
                 <> {_d_canon("[concat('out', CAST(o_custkey % 100 AS VARCHAR), '  ' || chr(10)), CASE WHEN o_orderkey % 3 = 0 THEN 'y' ELSE 'x' END][i]")})) = 0
               AND o_orderkey % 19 <> 0
               AS outputs_ok FROM v)
SELECT o_orderkey AS item_id, CAST(CASE WHEN reason IS NULL AND outputs_ok THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score,
       coalesce(reason, CASE WHEN outputs_ok THEN 'ok' ELSE 'mismatch' END) AS reason FROM r""")
def holes_grade_orders(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "orders").selectExpr(*_HVM_ITEM)
    d = d.withColumn("answers", X.parse_holes("response"))
    v = G.holes_verdict(F.col("answers"), F.col("holes"), F.col("domains"))
    d = d.withColumn("v", v).withColumn("outputs_ok", G.all_outputs_pass("expected", "got"))
    ok = F.col("v.ok") & F.col("outputs_ok")
    return d.select("item_id", F.when(ok, 1.0).otherwise(0.0).alias("score"),
                    F.coalesce(F.col("v.reason"), F.when(F.col("outputs_ok"), "ok").otherwise("mismatch"))
                    .alias("reason"))


# ---- J8 -----------------------------------------------------------------------------
_ELR_RESP = ("concat('<answer> ', CAST(o_custkey % 10 AS STRING), ' </answer>', "
             "CASE WHEN o_orderkey % 4 = 0 THEN '<Answer>7</Answer>' ELSE '' END)")


@register("answer_elr_orders", f"""
WITH d AS (SELECT o_orderkey, o_custkey % 10 AS expected,
                  concat('<answer> ', CAST(o_custkey % 10 AS VARCHAR), ' </answer>',
                         CASE WHEN o_orderkey % 4 = 0 THEN '<Answer>7</Answer>' ELSE '' END) AS response
           FROM orders)
SELECT o_orderkey AS item_id,
       {d_strip("coalesce(regexp_extract_all(response, '(?is)<Answer>(.*?)</Answer>', 1)[-1], '')")}
         = CAST(expected AS VARCHAR) AS ok FROM d""")
def answer_elr_orders(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "orders").selectExpr("o_orderkey AS item_id", "o_custkey % 10 AS expected",
                                             f"{_ELR_RESP} AS response")
    return d.select("item_id", G.answer_match("response", "expected").alias("ok"))


# ---- J9 -----------------------------------------------------------------------------
_ABD = [
    "doc_id AS item_id",
    "'a = input()\\nb = input()' AS program",
    "CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN '<INPUT></INPUT>' "
    "ELSE concat('<think>scratch</think><INPUT>\\n', text, '\\n</INPUT>') END AS response",
    "source AS expected",
    "CASE WHEN doc_id % 3 = 0 THEN concat(source, '  \\n') ELSE lang END AS got",
    "CASE WHEN doc_id % 11 = 0 THEN 'Traceback' WHEN doc_id % 13 = 0 THEN ' ' ELSE '' END AS run_error",
]


def _abd_sql() -> str:
    tidy = f"regexp_replace({d_join(d_rstrip_lines(d_splitlines(d_strip('b'))))}, '\\n+$', '')"
    es = f"replace({d_strip('expected')}, chr(13) || chr(10), chr(10))"
    gs = f"replace({d_strip('got')}, chr(13) || chr(10), chr(10))"
    eq = (f"(expected = got OR {es} = {gs} OR "
          f"{d_rstrip_lines(d_splitlines(es))} = {d_rstrip_lines(d_splitlines(gs))})")
    return f"""
WITH d AS (SELECT doc_id AS item_id, 'a = input()' || chr(10) || 'b = input()' AS program,
                  CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN '<INPUT></INPUT>'
                       ELSE concat('<think>scratch</think><INPUT>', chr(10), text, chr(10), '</INPUT>') END
                  AS response,
                  source AS expected,
                  CASE WHEN doc_id % 3 = 0 THEN concat(source, '  ', chr(10)) ELSE lang END AS got,
                  CASE WHEN doc_id % 11 = 0 THEN 'Traceback' WHEN doc_id % 13 = 0 THEN ' ' ELSE '' END AS run_error
           FROM documents),
t AS (SELECT *, coalesce(regexp_extract_all(regexp_replace(response, '(?s)<think>.*?</think>', '', 'g'),
                                            '(?is)<INPUT>(.*?)</INPUT>', 1)[-1], '') AS b,
             regexp_matches(response, '(?is)<INPUT>.*?</INPUT>') AS tags FROM d),
g AS (SELECT *, {tidy} AS gen_in FROM t),
n AS (SELECT *, len({d_splitlines('gen_in')}) AS n_lines,
             (length(program) - length(replace(program, 'input()', ''))) / 7 AS calls FROM g),
r AS (SELECT item_id,
             CASE WHEN gen_in = '' AND NOT tags THEN 'no_input'
                  WHEN NOT (n_lines >= calls) THEN 'invalid_input'
                  WHEN run_error <> '' THEN 'error'
                  WHEN NOT {eq} THEN 'mismatch' ELSE 'ok' END AS reason FROM n)
SELECT item_id, CAST(CASE WHEN reason = 'ok' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS score, reason FROM r"""


@register("abduction_docs", _abd_sql())
def abduction_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(*_ABD)
    return G.grade_abduction(d).select("item_id", "score", "reason")


# ---- D13 / D14 ----------------------------------------------------------------------
@register("summary_sum_ev", fx.duck_with("fx_ev") + """
SELECT env AS task, sum(CASE WHEN success THEN score ELSE 0.0 END) AS total_score_sum,
       count(*) FILTER (WHERE CASE WHEN success THEN score ELSE 0.0 END > 0) / greatest(count(*), 1)
         AS success_rate,
       count(*) AS n
FROM fx_ev GROUP BY env""")
def summary_sum_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf).select(F.col("env").alias("task"), F.col("score").alias("reward"),
                                   (~F.col("success")).alias("failed"))
    return G.summary_sum(e, "task", "reward", failed="failed")


@register("summary_mean_ev", fx.duck_with("fx_ev") + """,
r AS (SELECT env AS task, score * CASE WHEN seq_id % 3 = 0 THEN 100 ELSE 1 END AS reward FROM fx_ev)
SELECT task, coalesce(avg(reward), 0.0) AS total_score_mean,
       coalesce(avg(CASE WHEN abs(reward - 1.0) <= 1e-8 + 1e-5 * 1.0
                           OR abs(reward - 100.0) <= 1e-8 + 1e-5 * 100.0 THEN 1.0 ELSE 0.0 END), 0.0) AS success
FROM r GROUP BY task""")
def summary_mean_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf).select(F.col("env").alias("task"),
                                   (F.col("score") * F.when(F.col("seq_id") % 3 == 0, 100).otherwise(1))
                                   .alias("reward"))
    return G.summary_mean(e, "task", "reward")


# ---- D16 / D17 / J14 ----------------------------------------------------------------
_PAYLOAD = ("CASE seq_id % 4 "
            "WHEN 0 THEN to_json(named_struct('total_score', k, 'success_rate', k % 2, 'num_evaluated', k % 7)) "
            "WHEN 1 THEN to_json(named_struct('score', k % 5, 'n', k % 3)) "
            "WHEN 2 THEN '{}' "
            "ELSE to_json(named_struct('total_score', k % 4, 'success_rate', 0, "
            "'details', array(named_struct('id', seq_id, 'reward', k % 2), named_struct('id', 0, 'reward', 1)))) END")
_D_PAYLOAD = ("CASE seq_id % 4 "
              "WHEN 0 THEN json_object('total_score', k, 'success_rate', k % 2, 'num_evaluated', k % 7) "
              "WHEN 1 THEN json_object('score', k % 5, 'n', k % 3) "
              "WHEN 2 THEN '{}'::JSON "
              "ELSE json_object('total_score', k % 4, 'success_rate', 0, "
              "'details', json_array(json_object('id', seq_id, 'reward', k % 2), json_object('id', 0, 'reward', 1))) END")


@register("eval_records_ev", f"""
WITH p AS (SELECT seq_id, CAST({_D_PAYLOAD} AS VARCHAR) AS payload
      FROM (SELECT event_id AS seq_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))
SELECT seq_id,
       coalesce(TRY_CAST(json_extract_string(payload, '$.total_score') AS DOUBLE),
                TRY_CAST(json_extract_string(payload, '$.score') AS DOUBLE), 0.0) AS score,
       CAST(coalesce(TRY_CAST(json_extract_string(payload, '$.num_evaluated') AS DOUBLE),
                     TRY_CAST(json_extract_string(payload, '$.n') AS DOUBLE), 0.0) AS BIGINT) AS n,
       coalesce(TRY_CAST(json_extract_string(payload, '$.success_rate') AS DOUBLE), 0.0) AS success_rate,
       coalesce(TRY_CAST(json_extract_string(payload, '$.success_rate') AS DOUBLE), 0.0) > 0 AS success,
       CAST(json_extract(payload, '$.details[0]') AS VARCHAR) AS first_detail
FROM p""")
def eval_records_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events").selectExpr(
        "event_id AS seq_id", "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k")
    p = e.selectExpr("seq_id", f"{_PAYLOAD} AS payload")
    r = G.eval_record("payload")
    t = G.task_result("payload")
    return p.select("seq_id", r["score"].alias("score"), r["n"].alias("n"),
                    r["success_rate"].alias("success_rate"), t["success"].alias("success"),
                    t["first_detail"].alias("first_detail"))


# ---- J1 / J2 -----------------------------------------------------------------------------
_D_CANON = ("CAST(json_object('env', concat('vector:', lang), "
            "'extra', json_object('n', n_chars, 'source', source), 'prompt', {p}) AS VARCHAR)")


@register("challenge_ids_docs", f"""
SELECT doc_id, sha256({_D_CANON.format(p='text')}) AS challenge_id FROM documents""")
def challenge_ids_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "concat('vector:', lang) AS env",
        "to_json(named_struct('source', source, 'n', n_chars)) AS extra", "text AS prompt")
    return d.select("doc_id", G.challenge_id("env", "extra", "prompt").alias("challenge_id"))


@register("verified_docs", f"""
WITH d AS (SELECT doc_id, lang,
                  sha256({_D_CANON.format(p="CASE WHEN doc_id % 9 = 0 THEN concat(text, '!') ELSE text END")})
                  AS stored,
                  sha256({_D_CANON.format(p='text')}) AS recomputed FROM documents)
SELECT lang, count(*) AS verified FROM d WHERE stored = recomputed GROUP BY lang""")
def verified_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "lang", "concat('vector:', lang) AS env",
        "to_json(named_struct('source', source, 'n', n_chars)) AS extra", "text AS prompt")
    tampered = F.when(F.col("doc_id") % 9 == 0, F.concat("prompt", F.lit("!"))).otherwise(F.col("prompt"))
    d = d.withColumn("challenge_id", G.challenge_id(F.col("env"), F.col("extra"), tampered))
    return G.verify_integrity(d).groupBy("lang").agg(F.count(F.lit(1)).alias("verified"))


# ---- J3 -> J5 -> D15 ---------------------------------------------------------------
_VER = ("CASE doc_id % 8 "
        "WHEN 0 THEN to_json(named_struct('test_cases', array(named_struct('type', 'stdin_stdout', 'input', text, "
        "'output', source)))) "
        "WHEN 1 THEN concat(\"{'test_cases': [{'type': 'function_call', 'input': [1], 'output': ['\", source, \"', 'x']}, "
        "{'type': 'other'}]}\") "
        "WHEN 2 THEN concat('{\"test_cases\": [{\"type\": \"stdin_stdout\", \"output\": [\"', lang, "
        "'\", [null, [\"[', source, '\"]]]}]}') "
        "WHEN 3 THEN '{\"test_cases\": []}' WHEN 4 THEN '{not json' WHEN 5 THEN '' WHEN 6 THEN '[1]' ELSE NULL END")
_VER_GOT = ("CASE WHEN doc_id % 3 = 0 THEN 'wrong' WHEN doc_id % 8 IN (0, 1) THEN concat(source, ' \\n') "
            "WHEN doc_id % 8 = 2 THEN concat(lang, '\\nnull\\n[', source) ELSE 'null' END")


@register("verification_docs", """
SELECT doc_id,
       CASE WHEN doc_id % 8 IN (0, 2, 5) THEN 1 WHEN doc_id % 8 = 1 THEN 2 ELSE 0 END AS n_cases,
       CASE WHEN doc_id % 8 = 0 THEN length(text) END AS input_chars,
       CAST(CASE WHEN doc_id % 8 IN (0, 1, 2, 5) AND doc_id % 3 <> 0 THEN 1 ELSE 0 END AS BIGINT) AS passed,
       CAST(CASE WHEN doc_id % 8 IN (0, 1, 2, 5) THEN 1 ELSE 0 END AS BIGINT) AS total,
       CAST(CASE WHEN doc_id % 8 IN (0, 1, 2, 5) AND doc_id % 3 <> 0 THEN 1 ELSE 0 END AS DOUBLE) AS score,
       CASE WHEN doc_id % 8 IN (4, 6) THEN 'invalid' WHEN doc_id % 8 IN (3, 7) THEN 'no_cases' END AS reason
FROM documents""")
def verification_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads parsed (J3), expectations (J5) held against recorded outputs."""
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", f"{_VER} AS verification_info",
        "CASE WHEN doc_id % 8 = 5 THEN '{\"test_cases\": [{\"type\": \"stdin_stdout\"}]}' END AS test_cases",
        f"{_VER_GOT} AS got")
    v = G.parse_verification(d).select(
        F.col("doc_id").alias("item_id"), "cases", "reason", "got", F.coalesce(F.size("cases"), F.lit(0)).alias("n_cases"),
        F.char_length(F.get_json_object(F.get("cases", F.lit(0))["input"], "$")).alias("input_chars"))
    c = v.select("item_id", "got", F.explode("cases").alias("c")).select(
        "item_id", "c.type", "c.output", "got", F.lit("").alias("stderr"))
    g = G.grade_items_with_cases(v, c)
    return g.join(v.select("item_id", "n_cases", F.when(F.col("item_id") % 8 == 0, F.col("input_chars")).cast("bigint")
                           .alias("input_chars")), "item_id").withColumnRenamed("item_id", "doc_id")


# ---- U1 - U3: registry dispatch over a mixed item table --------------------------------
def _registry() -> G.EnvRegistry:
    reg = G.EnvRegistry()
    reg.register("vector:elr")(G.grade_answer)
    reg.register("vector:sat")(G.grade_sat)
    reg.register("vector:hvm")(G.grade_holes)

    @reg.register("vector:abd", program="a = input()\nb = input()")
    def _abd(program):
        return G.grade_abduction_row(F.lit(program))

    @reg.register("vector:ded")
    def _ded():
        return G.grade_deduction("cases", F.lower(F.col("env")) == "vector:ded")

    return reg


_SAT_RESP = ("concat('x1=', CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE '0' END, ' x2=', "
             "CASE WHEN c_custkey % 3 = 0 THEN 'False' ELSE '1' END, CASE WHEN c_custkey % 5 = 0 THEN ' x1=False' ELSE '' END)")
_HVM_SQL = Q["holes_grade_orders"][1]


@register("grade_all_mixed", f"""
WITH elr AS (SELECT 'vector:ELR' AS env, o_orderkey AS item_id,
                    CASE WHEN {d_strip("coalesce(regexp_extract_all(concat('<answer> ', CAST(o_custkey % 10 AS VARCHAR), ' </answer>', CASE WHEN o_orderkey % 4 = 0 THEN '<Answer>7</Answer>' ELSE '' END), '(?is)<Answer>(.*?)</Answer>', 1)[-1], '')")}
                              = CAST(o_custkey % 10 AS VARCHAR) THEN 1.0 ELSE 0.0 END::DOUBLE AS score,
                    NULL::VARCHAR AS reason FROM orders),
abd AS ({_abd_sql()}),
hvm AS ({_HVM_SQL}),
sat AS (SELECT c_custkey AS item_id, (c_custkey % 2 = 0 AND c_custkey % 5 <> 0) OR c_custkey % 3 = 0 AS ok FROM customer),
ded AS (SELECT doc_id AS item_id, CASE WHEN doc_id % 6 = 0 THEN 'no_cases' WHEN doc_id % 4 = 1 THEN 'mismatch' ELSE 'ok' END
          AS reason FROM documents),
oth AS (SELECT 'other:zzz' AS env, c_custkey AS item_id, 0.0::DOUBLE AS score, 'unknown_env' AS reason FROM customer)
SELECT * FROM elr UNION ALL SELECT 'vector:abd', item_id, score, reason FROM abd UNION ALL SELECT * FROM oth
UNION ALL SELECT 'vector:HVM', item_id, score, reason FROM hvm
UNION ALL SELECT 'vector:sat', item_id, CASE WHEN ok THEN 1.0 ELSE 0.0 END::DOUBLE,
                 CASE WHEN ok THEN 'ok' ELSE 'unsatisfied' END FROM sat
UNION ALL SELECT 'vector:ded', item_id, CASE WHEN reason = 'ok' THEN 1.0 ELSE 0.0 END::DOUBLE, reason FROM ded""")
def grade_all_mixed(spark: SparkSession, sf: str) -> DataFrame:
    orders, docs, cust = (_tbl(spark, sf, t) for t in ("orders", "documents", "customer"))
    elr = orders.selectExpr("'vector:ELR' AS env", "o_orderkey AS item_id", "CAST(o_custkey % 10 AS STRING) AS expected",
                            f"{_ELR_RESP} AS response")
    abd = docs.selectExpr(*_ABD).selectExpr("'vector:abd' AS env", "item_id", "response", "got", "run_error", "expected")
    hvm = orders.selectExpr(*_HVM_ITEM).selectExpr("'vector:HVM' AS env", "item_id", "response", "holes", "domains",
                                                   "expected AS expected_runs", "got AS got_runs")
    sat = cust.selectExpr("'vector:sat' AS env", "c_custkey AS item_id", f"{_SAT_RESP} AS response",
                          "array(array(1, -2)) AS clauses")
    ded = docs.selectExpr(
        "'vector:ded' AS env", "doc_id AS item_id",
        "CASE WHEN doc_id % 6 <> 0 THEN array("
        "named_struct('type', 'stdin_stdout', 'output', to_json(array(text)), 'got', "
        "CASE WHEN doc_id % 4 = 1 THEN concat('not ', text) ELSE text END, 'stderr', ''), "
        "named_struct('type', 'function_call', 'output', CAST(NULL AS STRING), 'got', 'null', 'stderr', ' ')) END AS cases")
    other = cust.selectExpr("'other:zzz' AS env", "c_custkey AS item_id")
    mixed = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [elr, abd, hvm, sat, ded, other])
    return _registry().grade_all(mixed)



# ---- U2: a user's grader over the recorded responses of planned tasks -------------------
@register("evaluate_tasks_orders", """
SELECT c.c_custkey AS uid, o.o_orderkey AS item_id,
       CAST(CASE WHEN o.o_orderstatus <> 'P' AND o.o_totalprice >= 1000 * (o.o_custkey % 200) THEN 1 ELSE 0 END AS DOUBLE) AS score,
       CASE WHEN o.o_orderstatus = 'P' THEN 'no_response'
            WHEN o.o_totalprice >= 1000 * (o.o_custkey % 200) THEN 'high' ELSE 'low' END AS reason
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def evaluate_tasks_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's orders are the planned tasks; pending ones have no response."""
    orders = _tbl(spark, sf, "orders")
    tasks = orders.join(_tbl(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .selectExpr("c_custkey AS uid", "o_orderkey AS item_id")
    said = orders.where("o_orderstatus <> 'P'").selectExpr(
        "o_custkey AS uid", "o_orderkey AS item_id", "o_totalprice AS got", "1000 * (o_custkey % 200) AS least")
    high = F.col("got") >= F.col("least")
    mine = F.struct(F.when(high, 1.0).otherwise(0.0).alias("score"), F.when(high, "high").otherwise("low").alias("reason"))
    return G.evaluate_rows(tasks, said, mine, ["uid", "item_id"])


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items() if v[1] is not None}
