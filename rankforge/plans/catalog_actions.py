"""Registered action-format and item-prompt queries.

Function calls and action texts are built by fixed rules from the
conversations table (whole texts are the thoughts); prompts from whole
documents; SAT prompts over recorded clauses of orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.functions import actions as A
from rankforge.functions.text import WHOLE, sat_satisfied
from rankforge.plans.catalog_text import NL, _dhash, _hash, d_strip

Q: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


_SPEC = A.HOUSEHOLD_SPEC
# calls built per turn: the 13 functions, an unknown one, too many arguments, a wrong argument name
_CALLS = [(f, args) for f, _, args, _ in _SPEC] + [("fly", ("x",)), ("take", ("obj", "recep", "extra")),
                                                   ("open", ("obj",))]
_VAL = {"obj": "concat('obj ', CAST(conv_id % 7 AS {t}))", "recep": "concat('recep ', CAST(turn AS {t}))",
        "x": "'y'", "extra": "'z'"}


def _spark_args(args):
    if not args:
        return "CAST(map() AS MAP<STRING, STRING>)"
    return "map(" + ", ".join(f"'{a}', {_VAL[a].format(t='STRING')}" for a in args) + ")"


def _duck_args(args):
    if not args:
        return "json_object()"
    return "json_object(" + ", ".join(f"'{a}', {_VAL[a].format(t='VARCHAR')}" for a in args) + ")"


_N = len(_CALLS)
_SP_FN = "CASE turn % {n} ".format(n=_N) + " ".join(f"WHEN {i} THEN '{f}'" for i, (f, _) in enumerate(_CALLS)) + " END"
_SP_ARGS = "CASE turn % {n} ".format(n=_N) + " ".join(
    f"WHEN {i} THEN {_spark_args(a)}" for i, (_, a) in enumerate(_CALLS)) + " END"
_DK_ARGS = "CASE turn % {n} ".format(n=_N) + " ".join(
    f"WHEN {i} THEN {_duck_args(a)}" for i, (_, a) in enumerate(_CALLS)) + " END"
_DK_SPEC = ", ".join(
    f"('{f}', '{nm}', {len(args)}, {repr(args[0]) if args else 'NULL'}, {repr(args[1]) if len(args) > 1 else 'NULL'}, "
    f"{repr(cj) if cj else 'NULL'})" for f, nm, args, cj in _SPEC)


@register("function_calls_conv", f"""
WITH spec AS (SELECT * FROM (VALUES {_DK_SPEC}) t(fn, name, nargs, a0, a1, conj)),
d AS (SELECT conv_id, turn, concat('Sure: ', CAST(json_object('thought', text, 'function_name',
             concat(' ', {_SP_FN}, ' '), 'arguments', {_DK_ARGS}) AS VARCHAR), {NL}, 'Done.') AS x FROM conversations),
p AS (SELECT conv_id, turn, '{{' || regexp_replace(regexp_replace(x, '^[^{{]*\\{{', ''), '\\}}[^}}]*$', '') || '}}' AS js
      FROM d),
q AS (SELECT conv_id, turn, json_extract_string(js, '$.thought') AS thought,
             {d_strip("json_extract_string(js, '$.function_name')")} AS f, json_extract(js, '$.arguments') AS a FROM p),
r AS (SELECT q.*, s.name, s.nargs, s.conj, s.a0, s.a1, len(json_keys(q.a)) AS n,
             json_extract_string(q.a, '$."' || s.a0 || '"') AS v0, json_extract_string(q.a, '$."' || s.a1 || '"') AS v1
      FROM q LEFT JOIN spec s ON q.f = s.fn),
e AS (SELECT *, CASE WHEN name IS NULL THEN 'invalid_function' WHEN n > nargs THEN 'too_many_args'
                     WHEN n >= 1 AND v0 IS NULL THEN 'missing_arg' WHEN n = 2 AND v1 IS NULL THEN 'missing_arg'
                END AS error FROM r)
SELECT conv_id, turn, {_dhash('thought', 'th')},
       CASE WHEN error IS NULL THEN CASE n WHEN 0 THEN name WHEN 1 THEN name || ' ' || v0
                                      ELSE name || ' ' || v0 || ' ' || conj || ' ' || v1 END END AS action, error
FROM e""")
def function_calls_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", f"concat('Sure: ', to_json(named_struct('thought', text, 'function_name', "
                           f"concat(' ', {_SP_FN}, ' '), 'arguments', {_SP_ARGS})), '\\nDone.') AS x")
    r = d.select("conv_id", "turn", A.call_to_action("x").alias("r"))
    return r.select("conv_id", "turn", *_hash(F.col("r.thought"), "th"), F.col("r.action").alias("action"),
                    F.col("r.error").alias("error"))


# ---- T19 + T20 ------------------------------------------------------------------------------
_ACTS = ["go to recep {t}", "take obj {c} from recep {t}", "put obj {c} in/on  recep {t}", "inventory",
         "look around", "heat obj {c} with recep {t} with more", "dance {t}", "examine recep {t} with obj {c}",
         "toggle lamp's {c}", "use \"x\" {c}", "open"]


def _act_expr(t):
    parts = []
    for i, a in enumerate(_ACTS):
        sql = "'" + a.replace("'", "''") + "'"
        sql = sql.replace("{t}", f"' || CAST(turn AS {t}) || '").replace("{c}", f"' || CAST(conv_id % 7 AS {t}) || '")
        parts.append(f"WHEN {i} THEN {sql}")
    return f"CASE turn % {len(_ACTS)} " + " ".join(parts) + " END"


_DK_SPEC2 = ", ".join(
    f"({i}, '{f}', '{nm}', {repr(list(args))}, {repr(cj) if cj else 'NULL'})" for i, (f, nm, args, cj) in enumerate(_SPEC))


def _d_lit(text: str) -> str:
    """A Python string as a DuckDB expression (newlines via chr(10))."""
    parts = ["'" + p.replace("'", "''") + "'" for p in text.split("\n")]
    return " || chr(10) || ".join(parts)


def _d_repr(x):
    e = f"replace(replace(replace(replace({x}, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return (f"(CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || {e} || '\"' "
            f"ELSE '''' || replace({e}, '''', '\\''') || '''' END)")


@register("action_calls_conv", f"""
WITH spec AS (SELECT * FROM (VALUES {_DK_SPEC2}) t(ord, fn, name, args, conj)),
d AS (SELECT conv_id, turn, text AS thought, {_act_expr('VARCHAR')} AS a FROM conversations),
m AS (SELECT d.*, s.fn, s.name, s.args AS arg_names, s.conj FROM d LEFT JOIN spec s ON starts_with(d.a, s.name)
      QUALIFY row_number() OVER (PARTITION BY d.conv_id, d.turn ORDER BY s.ord NULLS LAST) = 1),
r AS (SELECT *, {d_strip('substr(a, length(name) + 1)')} AS rest FROM m),
p AS (SELECT *, CASE WHEN conj IS NOT NULL
                     THEN list_transform(string_split_regex(rest, '\\s+' || conj || '\\s+'), lambda z: {d_strip('z')})
                     WHEN rest <> '' THEN [rest] ELSE []::VARCHAR[] END AS parts FROM r),
e AS (SELECT *, CASE WHEN fn IS NULL THEN 'invalid_action' WHEN len(parts) > len(arg_names) THEN 'too_many_args' END
                AS error FROM p),
o AS (SELECT *, CASE WHEN error IS NULL THEN
        '{{' || chr(10) || '  "thought": ' || to_json(thought)::VARCHAR || ',' || chr(10) || '  "function_name": '
        || to_json(fn)::VARCHAR || ',' || chr(10) || '  "arguments": '
        || CASE WHEN len(parts) = 0 THEN '{{}}' ELSE '{{' || chr(10) || array_to_string(list_transform(range(1, len(parts) + 1),
             lambda i: '    ' || to_json(arg_names[i])::VARCHAR || ': ' || to_json(parts[i])::VARCHAR), ',' || chr(10))
             || chr(10) || '  }}' END || chr(10) || '}}' END AS js,
      CASE WHEN error IS NULL THEN '```python' || chr(10) || '#' || thought || chr(10) || fn || '('
        || CASE len(parts) WHEN 0 THEN '' WHEN 1 THEN {_d_repr('parts[1]')}
                ELSE {_d_repr('parts[1]')} || ',' || {_d_repr('parts[2]')} END || ')' || chr(10) || '```' END AS code
      FROM e)
SELECT conv_id, turn, fn, CAST(len(parts) AS INTEGER) AS n_args, error, {_dhash('js', 'js')}, {_dhash('code', 'code')}
FROM o""")
def action_calls_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "conversations").selectExpr("conv_id", "turn", "text AS thought",
                                                       f"{_act_expr('STRING')} AS a")
    c = d.select("conv_id", "turn", "thought", A.action_to_call("a").alias("c"))
    return c.select("conv_id", "turn", F.col("c.fn").alias("fn"), F.size("c.args").alias("n_args"),
                    F.col("c.error").alias("error"), *_hash(A.call_json(F.col("thought"), F.col("c")), "js"),
                    *_hash(A.call_to_code(F.col("thought"), F.col("c")), "code"))


# ---- shopping form (T18 / T20) -------------------------------------------------------------
_D_INNER = "split_part(list_last(string_split(action, '[')), ']', 1)"
_D_SHOP_CODE = ("'```python' || chr(10) || '# ' || text || chr(10) || "
                "CASE WHEN starts_with(action, 'search') THEN 'search(' || " + _d_repr(_D_INNER) + " || ')' "
                "WHEN starts_with(action, 'click') THEN 'click(' || " + _d_repr(_D_INNER) + " || ')' ELSE '' END"
                " || chr(10) || '```'")


@register("shop_calls_conv", f"""
WITH d AS (SELECT conv_id, turn, text,
                  CASE turn % 3 WHEN 0 THEN json_object('thought', text, 'function_name', 'search',
                                                        'arguments', json_object('keywords', role || ' ' || CAST(conv_id AS VARCHAR)))
                                WHEN 1 THEN json_object('thought', text, 'function_name', 'click',
                                                        'arguments', json_object('item', 'it''em ' || CAST(turn AS VARCHAR)))
                                ELSE json_object('thought', text, 'function_name', 'buy', 'arguments', json_object()) END
                  AS js FROM conversations),
a0 AS (SELECT conv_id, turn, text, CASE json_extract_string(js, '$.function_name')
        WHEN 'search' THEN 'search[' || json_extract_string(js, '$.arguments.keywords') || ']'
        WHEN 'click' THEN 'click[' || json_extract_string(js, '$.arguments.item') || ']' END AS action FROM d),
a AS (SELECT conv_id, turn, text, action, coalesce(action, '') AS action_t FROM a0)
SELECT conv_id, turn, action, {_dhash(_D_SHOP_CODE.replace("action", "action_t").replace("action_t_t", "action_t"), 'code')}
FROM a""")
def shop_calls_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "text",
        "CASE turn % 3 WHEN 0 THEN to_json(named_struct('thought', text, 'function_name', 'search', 'arguments', "
        "map('keywords', concat(role, ' ', CAST(conv_id AS STRING))))) "
        "WHEN 1 THEN to_json(named_struct('thought', text, 'function_name', 'click', 'arguments', "
        "map('item', concat('it''em ', CAST(turn AS STRING))))) "
        "ELSE to_json(named_struct('thought', text, 'function_name', 'buy', 'arguments', "
        "CAST(map() AS MAP<STRING, STRING>))) END AS js")
    r = d.select("conv_id", "turn", "text", A.shop_call_to_action("js").alias("r"))
    return r.select("conv_id", "turn", F.col("r.action").alias("action"),
                    *_hash(A.shop_to_code(F.col("text"), F.coalesce(F.col("r.action"), F.lit(""))), "code"))


# ---- T21 ------------------------------------------------------------------------------------
@register("prompts_docs", f"""
SELECT doc_id, {_dhash("text || " + _d_lit(A.ANSWER_PROMPT_TAIL), 'ans')},
       {_dhash("regexp_replace(text, '\\s+$', '') || " + _d_lit(A.CODE_PROMPT_HINT), 'code')}
FROM documents""")
def prompts_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", *_hash(A.answer_prompt("text"), "ans"), *_hash(A.code_prompt("text"), "code"))


@register("abduction_prompts_bench", f"""
SELECT item_id, {_dhash(_d_lit(A.ABDUCTION_PROMPT.split('{program}')[0]) + " || text || " + _d_lit(A.ABDUCTION_PROMPT.split('{program}')[1].split('{output}')[0]) + " || 'len=' || CAST(length(text) AS VARCHAR) || " + _d_lit(A.ABDUCTION_PROMPT.split('{output}')[1]), 'p')}
FROM benchmark""")
def abduction_prompts_bench(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.table(spark, sf, "benchmark")
    out = F.concat(F.lit("len="), F.length("text").cast("string"))
    return b.select("item_id", *_hash(A.abduction_prompt(F.col("text"), out), "p"))


_HOLE_ITEM = [
    "o_orderkey",
    "array(named_struct('op', 'PUSH', 'arg', '?a'), named_struct('op', 'LOAD', 'arg', CAST(o_orderkey % 3 AS STRING)), "
    "named_struct('op', 'ADD', 'arg', CAST(NULL AS STRING)), named_struct('op', 'PUSH', 'arg', '?b'), "
    "named_struct('op', 'MUL', 'arg', CAST(NULL AS STRING)), named_struct('op', 'PRINT', 'arg', CAST(NULL AS STRING)), "
    "named_struct('op', 'HALT', 'arg', CAST(NULL AS STRING))) AS code",
    "array('?a', '?b') AS holes",
    "map('?a', sequence(CAST(0 AS BIGINT), CAST(o_custkey % 30 AS BIGINT)), '?b', array(CAST(-1 AS BIGINT), 0, 1)) AS domains",
    "array(array(CAST(o_orderkey % 10 AS BIGINT), 3), array(CAST(o_custkey % 7 AS BIGINT))) AS inputs",
    "array(CAST(o_orderkey % 97 AS STRING), concat('x', CAST(o_custkey AS STRING))) AS expected",
]


def _d_hole_prompt():
    code = ("'000: PUSH ?a' || chr(10) || '001: LOAD ' || CAST(o_orderkey % 3 AS VARCHAR) || chr(10) || '002: ADD' "
            "|| chr(10) || '003: PUSH ?b' || chr(10) || '004: MUL' || chr(10) || '005: PRINT' || chr(10) || '006: HALT'")
    dom_a = ("CASE WHEN o_custkey % 30 + 1 > 15 THEN '?a ∈ [0, ' || CAST(o_custkey % 30 AS VARCHAR) || '] (integers)' "
             "ELSE '?a ∈ {' || array_to_string(list_transform(range(0, o_custkey % 30 + 1), lambda v: CAST(v AS VARCHAR)), ', ') || '}' END")
    dom_b = "'?b ∈ {-1, 0, 1}'"
    cases = ("'Case #0: input=[' || CAST(o_orderkey % 10 AS VARCHAR) || ', 3]  expected stdout=' || chr(10) || '---' || chr(10) "
             "|| CAST(o_orderkey % 97 AS VARCHAR) || chr(10) || '---' || chr(10) || 'Case #1: input=[' || CAST(o_custkey % 7 AS VARCHAR) "
             "|| ']  expected stdout=' || chr(10) || '---' || chr(10) || 'x' || CAST(o_custkey AS VARCHAR) || chr(10) || '---'")
    return (_d_lit(A.HOLE_PROMPT_HEAD) + " || " + code + " || " + _d_lit("\n\nHoles and domains:\n- ") + " || " + dom_a
            + " || " + _d_lit("\n- ") + " || " + dom_b + " || " + _d_lit("\n\nTest cases:\n") + " || " + cases
            + " || " + _d_lit(A.HOLE_PROMPT_TAIL))


@register("hole_prompts_orders", f"""
SELECT o_orderkey, {_dhash(_d_hole_prompt(), 'p')} FROM orders""")
def hole_prompts_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").selectExpr(*_HOLE_ITEM)
    return o.select("o_orderkey", *_hash(A.hole_prompt("code", "holes", "domains", "inputs", "expected"), "p"))


# ---- T22 ------------------------------------------------------------------------------------
@register("signatures_part", f"""
WITH p AS (SELECT p_partkey, concat('fn_', CAST(p_partkey AS VARCHAR)) AS name, p_name AS description,
                  concat('size of ', p_brand) AS d1, p_type AS d2, p_size % 2 = 0 AS only_size FROM part)
SELECT p_partkey, {_dhash("'def ' || name || '(size, ' || CASE WHEN only_size THEN 'kind=''kind''' ELSE 'kind' END "
                          "|| '):' || chr(10) || '    \"\"\"' || chr(10) || '    ' || description || chr(10) || chr(10) "
                          "|| '    :param size (integer): ' || d1 || chr(10) || '    :param kind (string): ' || d2 "
                          "|| chr(10) || '    \"\"\"' || chr(10)", 'sig')}
FROM p""")
def signatures_part(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.table(spark, sf, "part").selectExpr(
        "p_partkey", "concat('fn_', CAST(p_partkey AS STRING)) AS name", "p_name AS description",
        "array(named_struct('name', 'size', 'type', 'integer', 'description', concat('size of ', p_brand)), "
        "named_struct('name', 'kind', 'type', 'string', 'description', p_type)) AS params",
        "CASE WHEN p_size % 2 = 0 THEN array('size') ELSE array('size', 'kind') END AS required")
    return p.select("p_partkey", *_hash(A.function_signature("name", "description", "params", "required"), "sig"))


_D_TOOL = (
    "'{' || chr(10) || '  \"type\": \"function\",' || chr(10) || '  \"function\": {' || chr(10) || '    \"name\": ' || to_json(name) "
    "|| ',' || chr(10) || '    \"description\": ' || to_json(description) || ',' || chr(10) || '    \"parameters\": {' || chr(10) "
    "|| '      \"type\": \"object\",' || chr(10) || '      \"properties\": {' || chr(10) || '        \"kind\": {' || chr(10) "
    "|| '          \"type\": \"string\",' || chr(10) || '          \"description\": ' || to_json(p_type) || chr(10) || '        }' "
    "|| chr(10) || '      },' || chr(10) || '      \"required\": ' || CASE WHEN p_size % 2 = 0 THEN '[]' "
    "ELSE '[' || chr(10) || '        \"kind\"' || chr(10) || '      ]' END || chr(10) || '    }' || chr(10) || '  }' || chr(10) || '}'")


@register("tool_prompts_part", f"""
WITH p AS (SELECT p_partkey, concat('fn_', CAST(p_partkey AS VARCHAR)) AS name, p_name AS description, p_type, p_size FROM part),
t AS (SELECT p_partkey, {_D_TOOL} AS one FROM p),
q AS (SELECT p_partkey, 'You have the following functions available:' || chr(10) || chr(10) || one || chr(10) || one
             || chr(10) || chr(10) || 'If you want to invoke a provided function or tool, please reply in the following *JSON* format:'
             || chr(10) || '```json' || chr(10) || '{{' || chr(10) || '    "thought": "I think ...",' || chr(10)
             || '    "function_name": "function_name",' || chr(10) || '    "arguments": <valid json object of args>' || chr(10)
             || '}}' || chr(10) || '```' || chr(10) || 'Only reply the *JSON* object, no other text should be present.' || chr(10)
             AS prompt FROM t)
SELECT p_partkey, {_dhash('prompt', 'prompt')} FROM q""")
def tool_prompts_part(spark: SparkSession, sf: str) -> DataFrame:
    """Two functions a prompt, offered as JSON tools."""
    p = fx.table(spark, sf, "part").selectExpr(
        "p_partkey", "named_struct('name', concat('fn_', CAST(p_partkey AS STRING)), 'description', p_name, 'params', "
        "array(named_struct('name', 'kind', 'type', 'string', 'description', p_type)), 'required', "
        "CASE WHEN p_size % 2 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array('kind') END) AS f")
    return p.select("p_partkey", *_hash(A.tool_prompt(F.array("f", "f")), "prompt"))


# ---- science-task flavour (T18 / T19) -----------------------------------------------------
_SCI = A.SCIENCE_SPEC
_SCALLS = [(f, args) for f, _, args, _ in _SCI] + [("fly", ("x",)), ("open", ("obj", "x")), ("use", ("obj", "x"))]
_SVAL = {"obj": "concat('obj ', CAST(conv_id % 7 AS {t}))", "obj1": "'wire'", "obj2": "'battery'",
         "tool": "'lighter'", "container": "concat('cup ', CAST(turn AS {t}))", "liq": "'water'",
         "loc": "'kitchen'", "food": "'apple'", "duration": "CAST(turn AS {t})",
         "option": "CAST(conv_id % 5 AS {t})", "x": "'y'"}


def _sargs(args, duck):
    t = "VARCHAR" if duck else "STRING"
    if not args:
        return "json_object()" if duck else "CAST(map() AS MAP<STRING, STRING>)"
    body = ", ".join(f"'{a}', {_SVAL[a].format(t=t)}" for a in args)
    return f"json_object({body})" if duck else f"map({body})"


_SN = len(_SCALLS)
_S_FN = f"CASE turn % {_SN} " + " ".join(f"WHEN {i} THEN '{f}'" for i, (f, _) in enumerate(_SCALLS)) + " END"
_S_SP = f"CASE turn % {_SN} " + " ".join(f"WHEN {i} THEN {_sargs(a, False)}" for i, (_, a) in enumerate(_SCALLS)) + " END"
_S_DK = f"CASE turn % {_SN} " + " ".join(f"WHEN {i} THEN {_sargs(a, True)}" for i, (_, a) in enumerate(_SCALLS)) + " END"
_S_SPEC = ", ".join(
    f"('{f}', '{nm}', {len(args)}, {repr(args[0]) if args else 'NULL'}, {repr(args[1]) if len(args) > 1 else 'NULL'}, "
    f"{repr(cj) if cj else 'NULL'})" for f, nm, args, cj in _SCI)


@register("science_calls_conv", f"""
WITH spec AS (SELECT * FROM (VALUES {_S_SPEC}) t(fn, name, nargs, a0, a1, conj)),
d AS (SELECT conv_id, turn, CAST(json_object('thought', text, 'function_name', {_S_FN}, 'arguments', {_S_DK}) AS VARCHAR)
             AS js FROM conversations),
q AS (SELECT conv_id, turn, json_extract_string(js, '$.thought') AS thought,
             {d_strip("json_extract_string(js, '$.function_name')")} AS f, json_extract(js, '$.arguments') AS a FROM d),
r AS (SELECT q.*, s.name, s.conj, len(json_keys(q.a)) AS n,
             json_extract_string(q.a, '$."' || s.a0 || '"') AS v0, json_extract_string(q.a, '$."' || s.a1 || '"') AS v1
      FROM q LEFT JOIN spec s ON q.f = s.fn),
e AS (SELECT *, CASE WHEN name IS NULL THEN 'invalid_function' WHEN n = 1 AND v0 IS NULL THEN 'missing_arg'
                     WHEN n >= 2 AND conj IS NULL THEN 'no_conjunction'
                     WHEN n >= 2 AND (v0 IS NULL OR v1 IS NULL) THEN 'missing_arg' END AS error FROM r)
SELECT conv_id, turn, {_dhash('thought', 'th')},
       CASE WHEN error IS NULL THEN CASE WHEN n = 0 THEN name
            WHEN n = 1 THEN CASE f WHEN 'wait' THEN name || v0 WHEN 'choose' THEN v0 ELSE name || ' ' || v0 END
            ELSE name || ' ' || v0 || ' ' || conj || ' ' || v1 END END AS action, error
FROM e""")
def science_calls_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", f"to_json(named_struct('thought', text, 'function_name', {_S_FN}, 'arguments', {_S_SP})) AS js")
    r = d.select("conv_id", "turn", A.science_call_to_action("js").alias("r"))
    return r.select("conv_id", "turn", *_hash(F.col("r.thought"), "th"), F.col("r.action").alias("action"),
                    F.col("r.error").alias("error"))


_SACTS = ["look around", "look at obj {c}", "pick up obj {c}", "pour water {c} into cup {t}",
          "dunk cup {t} in water {c}", "wait{t}", "wait a while", "{c}", "focus on thing {c}",
          "connect a to b to c", "fly away", "task", "use tool {t} on obj {c}", "move obj {c}  to box {t}"]


def _sact_expr(t):
    parts = []
    for i, a in enumerate(_SACTS):
        sql = "'" + a + "'"
        sql = sql.replace("{t}", f"' || CAST(turn AS {t}) || '").replace("{c}", f"' || CAST(conv_id % 7 AS {t}) || '")
        parts.append(f"WHEN {i} THEN {sql}")
    return f"CASE turn % {len(_SACTS)} " + " ".join(parts) + " END"


_S_SPEC2 = ", ".join(
    f"({i}, '{f}', '{nm}', {repr(list(args))}::VARCHAR[], {repr(cj) if cj else 'NULL'})" for i, (f, nm, args, cj) in enumerate(_SCI))


@register("science_actions_conv", f"""
WITH spec AS (SELECT * FROM (VALUES {_S_SPEC2}) t(ord, fn, name, args, conj)),
d AS (SELECT conv_id, turn, text AS thought, {_sact_expr('VARCHAR')} AS a FROM conversations),
m AS (SELECT d.*, s.fn AS sfn, s.name, s.args AS sargs, s.conj AS sconj FROM d LEFT JOIN spec s ON starts_with(d.a, s.name)
      QUALIFY row_number() OVER (PARTITION BY d.conv_id, d.turn ORDER BY s.ord NULLS LAST) = 1),
k AS (SELECT *, regexp_full_match(a, '[0-9]+') AS digits FROM m),
c AS (SELECT conv_id, turn, thought, a, CASE WHEN digits THEN 'choose' ELSE sfn END AS fn,
             CASE WHEN digits THEN ['option'] ELSE sargs END AS arg_names,
             CASE WHEN digits THEN NULL ELSE sconj END AS conj,
             {d_strip("substr(a, CASE WHEN digits THEN 0 ELSE length(name) END + 1)")} AS rest FROM k),
p0 AS (SELECT *, CASE WHEN conj IS NOT NULL
                      THEN list_transform(string_split_regex(rest, '\\s+' || conj || '\\s+'), lambda z: {d_strip('z')})
                      WHEN rest <> '' THEN [rest] ELSE []::VARCHAR[] END AS parts0 FROM c),
p AS (SELECT *, regexp_extract_all(coalesce(parts0[1], ''), '\\d+')[1] AS dur FROM p0),
q AS (SELECT *, CASE WHEN fn = 'wait' AND len(parts0) = 1 THEN [dur] ELSE parts0 END AS parts FROM p),
e AS (SELECT *, CASE WHEN fn IS NULL THEN 'invalid_action' WHEN len(parts) > len(arg_names) THEN 'too_many_args'
                     WHEN fn = 'wait' AND len(parts0) = 1 AND dur IS NULL THEN 'no_duration' END AS error FROM q),
o AS (SELECT *, CASE WHEN error IS NULL THEN
        '{{' || chr(10) || '  "thought": ' || to_json(thought)::VARCHAR || ',' || chr(10) || '  "function_name": '
        || to_json(fn)::VARCHAR || ',' || chr(10) || '  "arguments": '
        || CASE WHEN len(parts) = 0 THEN '{{}}' ELSE '{{' || chr(10) || array_to_string(list_transform(range(1, len(parts) + 1),
             lambda i: '    ' || to_json(arg_names[i])::VARCHAR || ': ' || to_json(parts[i])::VARCHAR), ',' || chr(10))
             || chr(10) || '  }}' END || chr(10) || '}}' END AS js FROM e)
SELECT conv_id, turn, fn, CAST(len(parts) AS INTEGER) AS n_args, error, {_dhash('js', 'js')} FROM o""")
def science_actions_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "conversations").selectExpr("conv_id", "turn", "text AS thought",
                                                       f"{_sact_expr('STRING')} AS a")
    c = d.select("conv_id", "turn", "thought", A.science_action_to_call("a").alias("c"))
    return c.select("conv_id", "turn", F.col("c.fn").alias("fn"), F.size("c.args").alias("n_args"),
                    F.col("c.error").alias("error"), *_hash(A.call_json(F.col("thought"), F.col("c")), "js"))


# ---- J10 + J6 + T21 (seeded hash generator: no SQL twin) ----------------------------------------
# ---- J6 + SAT prompt over recorded clauses -------------------------------------------------
@register("sat_prompt_orders", f"""
WITH c AS (SELECT o_orderkey AS item_id,
                  [[o_custkey % 15 + 1, -(o_orderkey % 15 + 1)], [-(o_custkey % 7 + 1), 15]] AS cl FROM orders),
p AS (SELECT item_id, cl, concat('Find a satisfying assignment for the following 2-SAT formula over variables x1..x15:', {NL},
        array_to_string(list_transform(cl, lambda x: '(' || array_to_string(list_transform(x, lambda l:
          CASE WHEN l > 0 THEN 'x' || l ELSE '¬x' || (-l) END), ' ∨ ') || ')'), ' ∧ '), {NL},
        'Provide your answer as comma-separated assignments like `x1=True, x2=False, ...`, '
        || 'or respond `UNSAT` if it has no solution.') AS prompt FROM c)
SELECT item_id, list_bool_and(list_transform(cl, lambda x: list_bool_or(list_transform(x, lambda l:
         ((abs(l) % 2 = 1) = (l > 0)))))) AS satisfied, {_dhash('prompt', 'prompt')} FROM p""")
def sat_prompt_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded clauses, held against the assignment that sets the odd variables."""
    o = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS item_id",
        "array(array(CAST(o_custkey % 15 + 1 AS INT), CAST(-(o_orderkey % 15 + 1) AS INT)), "
        "array(CAST(-(o_custkey % 7 + 1) AS INT), 15)) AS clauses")
    odd = F.create_map(*[F.lit(x).cast(WHOLE) if j == 0 else F.lit(x % 2 == 1) for x in range(1, 16) for j in (0, 1)])
    return o.select("item_id", sat_satisfied(F.col("clauses"), odd).alias("satisfied"),
                    *_hash(A.sat_prompt(F.col("clauses"), 15, 2), "prompt"))


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items() if v[1] is not None}
