"""Registered text-function queries.

Inputs are built by fixed rules from whole texts of the driver's tables
(documents, pages, conversations, orders, lineitem) so that the tags,
fences and actions the functions look for occur; nothing is cut or sampled.
Long results are compared as (sha256, length).  Each entry pairs the Spark
builder with the DuckDB text of the same query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge import fixtures as fx
from rankforge.functions import text as T

NL = "chr(10)"


# ---- DuckDB expression helpers (oracle side) ----------------------------------
def d_strip(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def d_rstrip(x):
    return rf"regexp_replace({x}, '\s+$', '')"


def d_splitlines(x):
    return (f"(CASE WHEN {x} = '' THEN []::VARCHAR[] "
            rf"ELSE string_split(regexp_replace({x}, '\n$', ''), {NL}) END)")


def d_rstrip_lines(lst):
    return f"list_transform({lst}, lambda l: {d_rstrip('l')})"


def d_join(lst):
    return f"array_to_string({lst}, {NL})"


def _hash(col: F.Column, name: str = "h"):
    return [F.sha2(col, 256).alias(name), F.length(col).cast("bigint").alias(f"{name}_len")]


def _dhash(expr: str, name: str = "h"):
    return f"sha256({expr}) AS {name}, CAST(length({expr}) AS BIGINT) AS {name}_len"


Q: dict = {}


def _tbl(spark, sf, name):
    return fx.table(spark, sf, name)


def register(name: str, sql: str):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# ---- T1 -------------------------------------------------------------------------
_REASON_IN = ("concat(CASE doc_id % 3 WHEN 0 THEN '<think>' WHEN 1 THEN '<THINK>' ELSE '<thinking>' END, "
              "text, CASE doc_id % 3 WHEN 0 THEN '</think>' WHEN 1 THEN '</THINK>' ELSE '</thinking>' END, "
              "'\\n', text)")


@register("reasoning_docs", f"""
WITH d AS (SELECT doc_id, {_REASON_IN.replace("'\\n'", NL)} AS x FROM documents),
r AS (SELECT doc_id, regexp_replace(regexp_replace(x, '(?s)<think>.*?</think>', '', 'g'),
                                    '(?s)<thinking>.*?</thinking>', '', 'g') AS y FROM d)
SELECT doc_id, {_dhash('y')} FROM r""")
def reasoning_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr("doc_id", f"{_REASON_IN} AS x")
    return d.select("doc_id", *_hash(T.strip_reasoning("x")))


# ---- T2 -------------------------------------------------------------------------
_TAGS = ("p", "title", "li", "nosuchtag")


def _d_last_tag(x, tag):
    return f"coalesce(regexp_extract_all({x}, '(?is)<{tag}>(.*?)</{tag}>', 1)[-1], '')"


@register("tag_blocks_pages", "SELECT page_id, " + ", ".join(
    f"{_d_last_tag('html', t)} AS tag_{t}" for t in _TAGS) + " FROM pages")
def tag_blocks_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = _tbl(spark, sf, "pages")
    return p.select("page_id", *[T.last_tag_block("html", t).alias(f"tag_{t}") for t in _TAGS])


# ---- T1+T2+T3 ---------------------------------------------------------------------
_INPUT_IN = "concat('<think>x</think><INPUT>\\n  ', text, '  \\n\\n</INPUT> trailing')"


def _d_tidy(x):
    return f"regexp_replace({d_join(d_rstrip_lines(d_splitlines(d_strip(x))))}, '\\n+$', '')"


@register("tagged_input_docs", f"""
WITH d AS (SELECT doc_id, concat('<think>x</think><INPUT>', {NL}, '  ', text, '  ', {NL}, {NL},
                                 '</INPUT> trailing') AS x FROM documents),
e AS (SELECT doc_id, {_d_last_tag("regexp_replace(x, '(?s)<think>.*?</think>', '', 'g')", 'INPUT')} AS b FROM d)
SELECT doc_id, {_dhash(_d_tidy('b'))} FROM e""")
def tagged_input_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr("doc_id", f"{_INPUT_IN} AS x")
    return d.select("doc_id", *_hash(T.extract_tagged_input("x", "INPUT")))


# ---- T4 -------------------------------------------------------------------------
_FENCE_IN = ("CASE turn % 4 WHEN 0 THEN concat('```python\\n', text, '\\n```') "
             "WHEN 1 THEN concat('intro\\n```js\\n', text, '\\n```\\nmore ```python\\nprint(1)\\n```') "
             "WHEN 2 THEN concat('``` ', text, '```') ELSE text END")


@register("fences_conv", f"""
WITH d AS (SELECT conv_id, turn,
                  CASE turn % 4 WHEN 0 THEN concat('```python', {NL}, text, {NL}, '```')
                       WHEN 1 THEN concat('intro', {NL}, '```js', {NL}, text, {NL}, '```', {NL}, 'more ```python',
                                          {NL}, 'print(1)', {NL}, '```')
                       WHEN 2 THEN concat('``` ', text, '```') ELSE text END AS x
           FROM conversations),
e AS (SELECT conv_id, turn, {d_strip('''coalesce(regexp_extract_all(x, '(?s)```python\\s*\\n(.*?)```', 1)[-1],
        regexp_extract_all(x, '(?s)```(?:\\w*)\\s*\\n(.*?)```', 1)[-1],
        regexp_extract_all(x, '(?i)```(?:python)?\\s*([\\s\\S]*?)```', 1)[1], x)''')} AS y FROM d)
SELECT conv_id, turn, {_dhash('y')} FROM e""")
def fences_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "conversations").selectExpr("conv_id", "turn", f"{_FENCE_IN} AS x")
    return d.select("conv_id", "turn", *_hash(T.strip_fences("x")))


# ---- T5 -------------------------------------------------------------------------
@register("normalise_docs", f"""
WITH d AS (SELECT doc_id, concat(replace(text, {NL}, concat('  ', {NL})), '   ', {NL}, {NL}, '  ') AS x
           FROM documents)
SELECT doc_id, {_dhash(d_join(d_rstrip_lines(d_splitlines(d_rstrip('x')))))} FROM d""")
def normalise_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "concat(replace(text, '\\n', '  \\n'), '   \\n\\n  ') AS x")
    return d.select("doc_id", *_hash(T.normalise_output("x")))


# ---- T6 -------------------------------------------------------------------------
_ACTUAL = ("CASE doc_id % 4 WHEN 0 THEN text "
           "WHEN 1 THEN concat('  ', replace(text, '\\n', '\\r\\n'), '\\n') "
           "WHEN 2 THEN replace(text, '\\n', '  \\n') ELSE concat(text, 'x') END")


def _d_eq(e, a):
    es = f"replace({d_strip(e)}, chr(13) || chr(10), chr(10))"
    as_ = f"replace({d_strip(a)}, chr(13) || chr(10), chr(10))"
    return (f"(({e}) = ({a}) OR {es} = {as_} OR "
            f"{d_rstrip_lines(d_splitlines(es))} = {d_rstrip_lines(d_splitlines(as_))})")


@register("outputs_equal_docs", f"""
WITH d AS (SELECT doc_id, text AS e,
                  CASE doc_id % 4 WHEN 0 THEN text
                       WHEN 1 THEN concat('  ', replace(text, chr(10), chr(13) || chr(10)), chr(10))
                       WHEN 2 THEN replace(text, chr(10), '  ' || chr(10))
                       ELSE concat(text, 'x') END AS a FROM documents)
SELECT doc_id, {_d_eq('e', 'a')} AS eq FROM d""")
def outputs_equal_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr("doc_id", "text AS e", f"{_ACTUAL} AS a")
    return d.select("doc_id", T.outputs_equal("e", "a").alias("eq"))


# ---- T7 -------------------------------------------------------------------------
@register("canon_docs", f"""
WITH d AS (SELECT doc_id, CASE doc_id % 3
             WHEN 0 THEN concat(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10))
             WHEN 1 THEN concat(text, chr(10), chr(10))
             ELSE replace(text, chr(10), ' ' || chr(13)) END AS x FROM documents),
c AS (SELECT doc_id, regexp_replace(replace(replace(coalesce(x, ''), chr(13) || chr(10), chr(10)),
                                            chr(13), chr(10)), '\\n$', '') AS y FROM d)
SELECT doc_id, {_dhash(d_join(d_rstrip_lines(f"string_split(y, {NL})")))} FROM c""")
def canon_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "CASE doc_id % 3 WHEN 0 THEN concat(replace(text, '\\n', '\\r\\n'), '\\r\\n') "
        "WHEN 1 THEN concat(text, '\\n\\n') ELSE replace(text, '\\n', ' \\r') END AS x")
    return d.select("doc_id", *_hash(T.canon_output("x")))


# ---- T8 -------------------------------------------------------------------------
_PROG = ("CASE WHEN doc_id % 2 = 0 THEN 'for _ in range(int(input())):\\n    print(input())' "
         "ELSE 'a = input()\\nb = input()\\nc = input()' END")
_INP = "CASE WHEN doc_id % 2 = 0 THEN concat(CAST(n_chars % 50 AS STRING), '\\n', text) ELSE text END"


@register("enough_lines_docs", f"""
WITH d AS (SELECT doc_id,
                  CASE WHEN doc_id % 2 = 0 THEN 'for _ in range(int(input())):' || chr(10) || '    print(input())'
                       ELSE 'a = input()' || chr(10) || 'b = input()' || chr(10) || 'c = input()' END AS p,
                  CASE WHEN doc_id % 2 = 0 THEN concat(CAST(n_chars % 50 AS VARCHAR), chr(10), text)
                       ELSE text END AS i FROM documents),
l AS (SELECT doc_id, p, {d_splitlines('i')} AS lines FROM d)
SELECT doc_id,
       CASE WHEN contains(p, 'for _ in range(int(input()))') AND len(lines) > 0
                 AND regexp_full_match(lines[1], '[0-9]+')
            THEN len(lines) > CAST(lines[1] AS HUGEINT)
            ELSE len(lines) >= (length(p) - length(replace(p, 'input()', ''))) / 7 END AS ok
FROM l""")
def enough_lines_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr("doc_id", f"{_PROG} AS p", f"{_INP} AS i")
    return d.select("doc_id", T.enough_input_lines("p", "i").alias("ok"))


# ---- T9 + J6 ----------------------------------------------------------------------
_ASSIGN = ("concat('x', CAST(l_linenumber AS STRING), '=', CASE WHEN l_quantity > 25 THEN 'True' ELSE 'False' END,"
           " ' x', CAST(l_partkey % 10 AS STRING), '=', CASE WHEN l_partkey % 2 = 0 THEN '1' ELSE '0' END,"
           " ' x', CAST(l_linenumber AS STRING), '=', CASE WHEN l_tax > 0.04 THEN '1' ELSE 'False' END,"
           " ' x99=maybe')")


@register("sat_assign_li", f"""
WITH d AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey, {_ASSIGN} AS x FROM lineitem),
p AS (SELECT *, regexp_extract_all(x, 'x(\\d+)=(True|False|1|0)', 1) AS ks,
                regexp_extract_all(x, 'x(\\d+)=(True|False|1|0)', 2) AS vs FROM d),
e AS (SELECT rid, l_orderkey, l_linenumber, l_partkey, CAST(k AS BIGINT) AS k,
             lower(vs[i]) IN ('true', '1') AS v, i
      FROM (SELECT *, unnest(ks) AS k, unnest(range(1, len(ks) + 1)) AS i FROM p)),
last AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY rid, k ORDER BY i DESC) = 1),
agg AS (SELECT rid, l_orderkey, l_linenumber, l_partkey, count(*) AS n_vars, count(*) FILTER (WHERE v) AS n_true,
               bool_or(k = l_linenumber AND v) AS lit1, bool_or(k = l_partkey % 10 AND NOT v) AS lit2,
               bool_or(k = 3 AND v) AS lit3
        FROM last GROUP BY ALL)
SELECT l_orderkey, l_linenumber, n_vars, n_true,
       coalesce(lit1, false) OR coalesce(lit2, false) AS sat1,
       coalesce(lit3, false) AS sat2
FROM agg""")
def sat_assign_li(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey",
                                                    f"{_ASSIGN} AS x")
    # parse once; the map is then read four times
    d = d.select("l_orderkey", "l_linenumber", "l_partkey", T.parse_assignments("x").alias("m"))
    m = F.col("m")
    c1 = F.array(F.array(F.col("l_linenumber").cast("int"), -(F.col("l_partkey") % 10).cast("int")))
    c2 = F.array(F.array(F.lit(3)))
    return d.select("l_orderkey", "l_linenumber",
                    F.size(m).cast("bigint").alias("n_vars"),
                    F.size(F.filter(F.map_values(m), lambda v: v)).cast("bigint").alias("n_true"),
                    T.sat_satisfied(c1, m).alias("sat1"), T.sat_satisfied(c2, m).alias("sat2"))


# ---- T10 ------------------------------------------------------------------------
_HOLES = ("concat('pre <holes>?z = 1</holes> <HOLES>\\n?a = ', CAST(o_custkey % 100 AS STRING), "
          "'\\n# note\\n\\n  ?b=', CAST(-(o_orderkey % 7) AS STRING), "
          "CASE WHEN o_orderkey % 13 = 0 THEN '\\nbad line' ELSE '' END, "
          "CASE WHEN o_orderkey % 5 = 0 THEN '\\n?a = 5' ELSE '' END, '\\n</HOLES>')")


_DHOLES = ("concat('pre <holes>?z = 1</holes> <HOLES>', chr(10), '?a = ', CAST(o_custkey % 100 AS VARCHAR), "
           "chr(10), '# note', chr(10), chr(10), '  ?b=', CAST(-(o_orderkey % 7) AS VARCHAR), "
           "CASE WHEN o_orderkey % 13 = 0 THEN chr(10) || 'bad line' ELSE '' END, "
           "CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || '?a = 5' ELSE '' END, chr(10), '</HOLES>')")
_HPAT = "^(\\?[a-zA-Z]\\w*)\\s*=\\s*(-?\\d+)$"


@register("holes_orders", f"""
WITH d AS (SELECT o_orderkey, {_DHOLES} AS x FROM orders),
b AS (SELECT o_orderkey, regexp_extract_all(x, '(?is)<HOLES>\\s*(.*?)\\s*</HOLES>', 1)[-1] AS blk FROM d),
l AS (SELECT o_orderkey, blk, list_filter(list_transform({d_splitlines(d_strip('blk'))}, lambda z: {d_strip('z')}),
                                          lambda z: z <> '' AND NOT starts_with(z, '#')) AS body FROM b),
v AS (SELECT o_orderkey, blk IS NULL OR len(list_filter(body, lambda z: NOT regexp_matches(z, '{_HPAT}'))) > 0 AS bad,
             list_filter(body, lambda z: regexp_extract(z, '{_HPAT}', 1) = '?a') AS la,
             list_filter(body, lambda z: regexp_extract(z, '{_HPAT}', 1) = '?b') AS lb,
             list_distinct(list_transform(body, lambda z: regexp_extract(z, '{_HPAT}', 1))) AS ks FROM l)
SELECT o_orderkey, bad AS is_null,
       CASE WHEN bad THEN NULL ELSE CAST(regexp_extract(la[-1], '{_HPAT}', 2) AS BIGINT) END AS hole_a,
       CASE WHEN bad THEN NULL ELSE CAST(regexp_extract(lb[-1], '{_HPAT}', 2) AS BIGINT) END AS hole_b,
       CASE WHEN bad THEN NULL ELSE CAST(len(ks) AS INTEGER) END AS n_holes
FROM v""")
def holes_orders(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "orders").selectExpr("o_orderkey", f"{_HOLES} AS x")
    d = d.select("o_orderkey", T.parse_holes("x").alias("m"))
    m = F.col("m")
    return d.select("o_orderkey", m.isNull().alias("is_null"),
                    F.try_element_at(m, F.lit("?a")).cast("bigint").alias("hole_a"),
                    F.try_element_at(m, F.lit("?b")).cast("bigint").alias("hole_b"),
                    F.size(m).alias("n_holes")).withColumn(
        "n_holes", F.when(F.col("is_null"), F.lit(None)).otherwise(F.col("n_holes")))


# ---- T11-T14, T16 on FX-CONV wrapped assistant turns -------------------------------
_WRAP = ("CASE WHEN turn % 7 = 0 THEN concat('Thought:\\n', text) "
         "WHEN turn % 5 = 0 THEN concat('Thought:\\n', text, '\\n\\nAction:\\ngo to place ', "
         "CAST(turn AS STRING), '\\nAction: click[x]</s>') "
         "ELSE concat('Thought:\\n', text, '\\n\\nAction:\\n', 'go to place ', CAST(turn AS STRING)) END")
_DWRAP = (f"CASE WHEN turn % 7 = 0 THEN concat('Thought:', {NL}, text) "
          f"WHEN turn % 5 = 0 THEN concat('Thought:', {NL}, text, {NL}, {NL}, 'Action:', {NL}, 'go to place ', "
          f"CAST(turn AS VARCHAR), {NL}, 'Action: click[x]</s>') "
          f"ELSE concat('Thought:', {NL}, text, {NL}, {NL}, 'Action:', {NL}, 'go to place ', CAST(turn AS VARCHAR)) END")


def _conv_wrapped(spark, sf):
    return (_tbl(spark, sf, "conversations")
            .selectExpr("conv_id", "turn", f"{_WRAP} AS x"))


@register("react_conv", f"""
WITH d AS (SELECT conv_id, turn, {_DWRAP} AS x FROM conversations),
s AS (SELECT *, contains(x, 'Action:') AS has_a,
             string_split(x, 'Action:') AS parts FROM d),
r AS (SELECT *, CASE WHEN has_a THEN array_to_string(parts[1:len(parts) - 1], 'Action:')
                     WHEN contains(x, 'search[') OR contains(x, 'click[') THEN '' ELSE x END AS t_raw,
                CASE WHEN has_a THEN parts[-1]
                     WHEN contains(x, 'search[') OR contains(x, 'click[') THEN x ELSE '' END AS a_raw FROM s),
t AS (SELECT *, string_split(t_raw, 'Thought:') AS tp FROM r),
o AS (SELECT conv_id, turn,
             CASE WHEN len(tp) = 1 THEN t_raw ELSE {d_strip('tp[2]')} END AS thought,
             {d_strip('a_raw')} AS action, (NOT has_a) OR len(tp) = 1 AS invalid FROM t)
SELECT conv_id, turn, {_dhash('thought', 'th')}, action, invalid,
       {_dhash(f"concat('Thought:', {NL}, thought, {NL}, {NL}, 'Action:', {NL}, action)", 'rt')} FROM o""")
def react_conv(spark: SparkSession, sf: str) -> DataFrame:
    r = _conv_wrapped(spark, sf).select("conv_id", "turn", T.parse_react("x").alias("r"))
    return r.select("conv_id", "turn", *_hash(F.col("r.thought"), "th"), F.col("r.action").alias("action"),
                    F.col("r.invalid").alias("invalid"),
                    *_hash(T.to_react(F.col("r.thought"), F.col("r.action")), "rt"))


@register("single_action_conv", f"""
WITH d AS (SELECT conv_id, turn, {_DWRAP} AS x FROM conversations),
a AS (SELECT conv_id, turn, regexp_extract_all(x, 'Action:\\s*([^\\n]*)', 1) AS acts FROM d)
SELECT conv_id, turn,
       CASE WHEN len(acts) > 1 THEN NULL
            ELSE regexp_replace(regexp_replace(coalesce(acts[1], ''), '[^A-Za-z0-9, ]+', '', 'g'), ' +', ' ', 'g')
       END AS action,
       len(acts) > 1 AS error FROM a""")
def single_action_conv(spark: SparkSession, sf: str) -> DataFrame:
    r = _conv_wrapped(spark, sf).select("conv_id", "turn", T.single_action("x").alias("r"))
    return r.select("conv_id", "turn", "r.action", "r.error")


@register("first_action_conv", f"""
WITH d AS (SELECT conv_id, turn, regexp_replace({_DWRAP}, '</s>$', '') AS x FROM conversations
          ),
p AS (SELECT conv_id, turn, x, string_split(x, 'Action:') AS parts FROM d)
SELECT conv_id, turn, {d_strip("CASE WHEN len(parts) > 1 THEN parts[2] ELSE x END")} AS action FROM p""")
def first_action_conv(spark: SparkSession, sf: str) -> DataFrame:
    return _conv_wrapped(spark, sf).select("conv_id", "turn", T.first_action("x").alias("action"))


_FENCED = ("CASE WHEN turn % 3 = 0 THEN concat('do:\\n```', text, '```') "
           "WHEN turn % 3 = 1 THEN concat('```stop [', CAST(turn AS STRING), ']``` and ```x```') ELSE text END")


@register("fenced_conv", f"""
WITH d AS (SELECT conv_id, turn,
                  CASE WHEN turn % 3 = 0 THEN concat('do:', {NL}, '```', text, '```')
                       WHEN turn % 3 = 1 THEN concat('```stop [', CAST(turn AS VARCHAR), ']``` and ```x```')
                       ELSE text END AS x FROM conversations)
SELECT conv_id, turn, regexp_matches(x, '(?s)```(.*?)```') AS has_action,
       {_dhash("coalesce(regexp_extract_all(x, '(?s)```(.*?)```', 1)[1], '')", 'act')} FROM d""")
def fenced_conv(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "conversations").selectExpr("conv_id", "turn", f"{_FENCED} AS x")
    return d.select("conv_id", "turn", T.has_fenced_action("x").alias("has_action"),
                    *_hash(F.coalesce(T.fenced_action("x"), F.lit("")), "act"))


# ---- T15 ------------------------------------------------------------------------
@register("sql_block_docs", f"""
WITH d AS (SELECT doc_id, concat('Here:', {NL}, '```sql', {NL}, 'SELECT ', source, ' FROM t', {NL}, '```',
                                 {NL}, 'and ```sql', {NL}, text, {NL}, '``` end') AS x FROM documents),
s AS (SELECT doc_id, string_split(x, '```sql')[-1] AS after FROM d)
SELECT doc_id, {_dhash(d_strip("string_split(after, '```')[1]"))} FROM s""")
def sql_block_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "concat('Here:\\n```sql\\nSELECT ', source, ' FROM t\\n```\\nand ```sql\\n', text, "
        "'\\n``` end') AS x")
    return d.select("doc_id", *_hash(T.sql_block("x")))


# ---- T17 ------------------------------------------------------------------------
@register("code_comments_docs", f"""
WITH d AS (SELECT doc_id, concat('  ```python', {NL}, '# ', replace(text, '. ', '. #'), {NL},
                                 'x = 1  #', {NL}, '```  ') AS x FROM documents),
b AS (SELECT doc_id, {d_strip('x')} AS t FROM d),
b1 AS (SELECT doc_id, CASE WHEN starts_with(t, '```') AND contains(t, {NL})
                           THEN regexp_replace(t, '^[^\\n]*\\n', '') ELSE t END AS t FROM b),
b2 AS (SELECT doc_id, CASE WHEN suffix(t, '```') AND contains(t, {NL})
                           THEN regexp_replace(t, '\\n[^\\n]*$', '') ELSE t END AS body FROM b1),
c AS (SELECT doc_id, body, list_transform(regexp_extract_all(body, '#[^\\n]*', 0),
             lambda z: CASE WHEN {d_strip('z')} = '' THEN {NL} ELSE {d_strip('z')} END) AS cs FROM b2)
SELECT doc_id, {_dhash('body', 'body')}, {_dhash("array_to_string(cs, ' ')", 'cm')} FROM c""")
def code_comments_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = _tbl(spark, sf, "documents").selectExpr(
        "doc_id", "concat('  ```python\\n# ', replace(text, '. ', '. #'), '\\nx = 1  #\\n```  ') AS x")
    body = T.code_block_body("x")
    return d.select("doc_id", *_hash(body, "body"), *_hash(T.code_comments(body), "cm"))


# ---- T23 ------------------------------------------------------------------------
@register("shorten_docs", f"""
WITH d AS (SELECT doc_id, regexp_replace({d_strip('coalesce(text, ' + "''" + ')')}, '\\s+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 80 THEN t
                    WHEN regexp_extract(left(t, 80), '^(.*) ', 1) = '' THEN '…'
                    ELSE concat(regexp_extract(left(t, 80), '^(.*) ', 1), '…') END AS short FROM d""")
def shorten_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _tbl(spark, sf, "documents").select("doc_id", T.shorten("text").alias("short"))


# ---- T25 ------------------------------------------------------------------------
@register("shard_keys_ev", f"""
{fx.duck_with('fx_ev')}
SELECT seq_id, printf('%09d-%s-%d', CAST(block - (block % 20) AS BIGINT), model, seq_id * 1000) AS key FROM fx_ev""")
def shard_keys_ev(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.fx_ev(spark, sf)
    win = F.col("block") - F.pmod(F.col("block"), F.lit(20))
    return e.select("seq_id", T.shard_key(win, F.col("model"), F.col("seq_id") * 1000).alias("key"))


# ---- T26 ------------------------------------------------------------------------
@register("reassemble_conv", f"""
WITH s AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS whole FROM conversations GROUP BY conv_id),
l AS (SELECT conv_id, unnest(regexp_extract_all(whole, '[^\\n]*\\n|[^\\n]+$', 0)) AS line,
             unnest(range(1, len(regexp_extract_all(whole, '[^\\n]*\\n|[^\\n]+$', 0)) + 1)) AS line_no
      FROM s)
SELECT conv_id, CAST(line_no AS INTEGER) AS line_no, {_dhash('line', 'line')} FROM l""")
def reassemble_conv(spark: SparkSession, sf: str) -> DataFrame:
    from rankforge.operators.trajectories import reassemble_lines
    c = _tbl(spark, sf, "conversations")
    r = reassemble_lines(c, stream="conv_id", pos="turn", chunk="text")
    return r.select("conv_id", "line_no", *_hash(F.col("line"), "line"))


# ---- T27 ------------------------------------------------------------------------
@register("result_lines_ev", f"""
{fx.duck_with('fx_ev')},
r AS (SELECT *, row_number() OVER (PARTITION BY env, CAST(ts AS DATE) ORDER BY ts, seq_id) AS k,
             count(*) OVER (PARTITION BY env, CAST(ts AS DATE)) AS tot FROM fx_ev)
SELECT seq_id, printf('[RESULT] %3.0f%% | U%3d │ %-50s │ %-20s │ %s │ %6.4f │ %6.3fs',
                      round_even(k / tot * 100, 0), participant, coalesce(left(model, 50), ''), env,
                      CASE WHEN success THEN 'RECV' ELSE 'NULL' END, score, CAST(block % 97 AS DOUBLE) / 8)
       AS line FROM r""")
def result_lines_ev(spark: SparkSession, sf: str) -> DataFrame:
    from rankforge.operators.ops import ordinal_within
    # one progress bar per (env, day) round; a hot round is numbered hour by hour
    e = fx.fx_ev(spark, sf).withColumn("bar", F.concat_ws("|", "env", F.to_date("ts").cast("string")))
    e = ordinal_within(e, "bar", ["ts", "seq_id"], F.hour("ts")) \
        .join(e.groupBy("bar").agg(F.count(F.lit(1)).alias("tot")), "bar")
    pct = F.bround(F.col("ordinal") / F.col("tot") * 100, 0)
    return e.select("seq_id", T.result_line(pct, F.col("participant"), F.col("model"), F.col("env"),
                                            F.col("success"), F.col("score"),
                                            (F.col("block") % 97).cast("double") / 8).alias("line"))


QUERIES = {k: v[0] for k, v in Q.items()}
ORACLE = {k: v[1] for k, v in Q.items()}
