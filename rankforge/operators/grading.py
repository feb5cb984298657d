"""Grading recorded responses (X6): per-env answer checks over *recorded*
program outputs, all-pass scoring, batch summaries, evaluator payloads,
challenge ids, and the env registry that dispatches them (U1-U3).

Nothing executes submitted code: the reference's sandbox runs are replaced
by the outputs recorded next to each case.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions import text as X

# ---- fixed values ---------------------------------------------------------------
ISCLOSE_RTOL = 1e-5
ISCLOSE_ATOL = 1e-8
SUCCESS_REWARDS = (1.0, 100.0)
HEAVY_FIELDS = ("readme", "cords", "tagline", "instances")
# -------------------------------------------------------------------------------


# ---- J1 / J2 ------------------------------------------------------------------------
@F.pandas_udf(T.StringType())
def json_ascii_escape(s: pd.Series) -> pd.Series:
    """Escape non-ASCII characters of JSON text as \\uXXXX (surrogate pairs
    beyond the BMP), which is how Python's json.dumps writes them."""
    def esc(t):
        if t is None:
            return None
        out = []
        for ch in t:
            o = ord(ch)
            if o < 0x7F:
                out.append(ch)
            elif o < 0x10000:
                out.append(f"\\u{o:04x}")
            else:
                o -= 0x10000
                out.append(f"\\u{0xD800 + (o >> 10):04x}\\u{0xDC00 + (o & 0x3FF):04x}")
        return "".join(out)
    return s.map(esc)


def lower_escapes(j: Column) -> Column:
    """JSON text with the escapes of control characters in lower-case hex.
    A pair of backslashes is an escaped backslash and shields what follows."""
    out = j
    for code in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)):       # those whose hex digits have letters
        out = F.regexp_replace(out, r"(?<!\\)((?:\\\\)*)\\u%04X" % code, "$1\\\\u%04x" % code)
    return F.when(F.contains(j, F.lit("\\u00")), out).otherwise(j)


def canonical_challenge(env, extra_json, prompt) -> Column:
    """Sorted-key, no-space JSON of {env, extra, prompt} (variant objects
    keep keys sorted at every depth)."""
    extra = F.coalesce(F.try_parse_json(extra_json), F.parse_json(F.lit("{}")))
    return lower_escapes(F.to_json(F.struct(F.col(env).alias("env") if isinstance(env, str) else env.alias("env"),
                              extra.alias("extra"),
                              (F.col(prompt) if isinstance(prompt, str) else prompt).alias("prompt"))))


def challenge_id(env, extra_json, prompt, ascii_escape: bool = False) -> Column:
    """sha256 hex of the canonical challenge JSON.  UTF-8 text is the
    default; ``ascii_escape`` reproduces Python's \\uXXXX escaping."""
    j = canonical_challenge(env, extra_json, prompt)
    if ascii_escape:      # only rows with other characters go through Python
        odd = j.rlike(r"[^\x00-\x7E]")
        j = F.coalesce(json_ascii_escape(F.when(odd, j)), j)
    return F.sha2(j, 256)


def verify_integrity(df: DataFrame, stored: str = "challenge_id", **kw) -> DataFrame:
    """Keep rows whose recomputed id equals the stored one."""
    return df.filter(challenge_id(kw.get("env", "env"), kw.get("extra", "extra"),
                                  kw.get("prompt", "prompt"), kw.get("ascii_escape", False))
                     .eqNullSafe(F.col(stored)))


# ---- J4 / J5 / D15 ---------------------------------------------------------------
def _as_text(value) -> str:
    if isinstance(value, list):
        return "\n".join(map(_as_text, value))
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def _nested_text(s: pd.Series) -> pd.Series:
    return s.map(lambda j: None if j is None else _as_text(json.loads(j)))


def payload_to_text(j) -> Column:
    """J4 over JSON text: a string as is; a list joined by newlines, at any
    depth; anything else as its JSON text, so null and a missing payload are
    ``null``.  Text that isn't JSON gives SQL null.  Strings and lists of
    strings stay in the JVM; only other values go through Arrow."""
    j = F.col(j) if isinstance(j, str) else j
    j = F.coalesce(j, F.lit("null"))
    return _text_of_kind(j, _json_kind(j))


def _json_kind(j: Column) -> Column:
    """The type of JSON text, null for other text."""
    return F.schema_of_variant(F.try_parse_json(j))


def _text_of_kind(j: Column, kind: Column) -> Column:
    """J4 over JSON text of that type."""
    plain = F.when(kind == "STRING", F.get_json_object(j, "$")) \
        .when(kind == "ARRAY<STRING>", F.array_join(F.from_json(j, "array<string>"), "\n", "null"))
    return F.coalesce(plain, _nested_text(F.when(~kind.isin("STRING", "ARRAY<STRING>"), j)))


def case_expectation(ctype, output_json) -> Column:
    """Expected text of one case: stdin_stdout -> J4(output);
    function_call -> J4(first element of a non-empty list, else output).  A
    missing output is expected as the text ``null``; null for other types and
    for output text that isn't JSON."""
    ctype = F.col(ctype) if isinstance(ctype, str) else ctype
    o = F.col(output_json) if isinstance(output_json, str) else output_json
    return payload_to_text(_expected_json(ctype, o, F.try_parse_json(F.coalesce(o, F.lit("null")))))


def _expected_json(ctype: Column, o: Column, v: Column) -> Column:
    """The JSON text that a case's expectation is made of; ``v`` is the parsed ``o``."""
    is_list = F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))
    first = F.to_json(F.try_variant_get(v, "$[0]", "variant"))
    return F.coalesce(F.when((ctype == "function_call") & is_list, first),
                      F.when(ctype.isin("stdin_stdout", "function_call"), F.coalesce(o, F.lit("null"))).otherwise(F.lit("{")))


def case_passes(expected: Column, got: Column, stderr: Column) -> Column:
    """A clean run whose output equals the expectation, line ends trimmed;
    without an expectation nothing passes."""
    clean = X.py_strip(F.coalesce(stderr, F.lit(""))) == ""
    same = X.once(F.coalesce(got, F.lit("")), X.normalise_output) == X.once(expected, X.normalise_output)
    return clean & F.coalesce(same, F.lit(False))


def grade_cases(cases: DataFrame, item: str = "item_id") -> DataFrame:
    """D15 (+J5): per item, passed / total over its cases; cases of an
    unknown type do not count; score 1 iff all counted cases pass (an item
    whose cases are all of unknown type scores 1.0).

    ``cases``: item, type, output (JSON text or null), got, stderr.  They are
    dealt to all tasks before they are parsed, whatever the files they come
    from, and what is read more than once is a column, so computed once a row."""
    known = F.col("type").isin("stdin_stdout", "function_call")
    c = cases.repartition(int(cases.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # only a call's output is looked into
    c = c.withColumn("_v", F.when(F.col("type") == "function_call", F.try_parse_json(F.coalesce("output", F.lit("null")))))
    c = c.withColumn("_json", _expected_json(F.col("type"), F.col("output"), F.col("_v")))
    c = c.withColumn("_kind", _json_kind(F.col("_json")))
    c = c.withColumn("_exp", _text_of_kind(F.col("_json"), F.col("_kind")))
    correct = case_passes(F.col("_exp"), F.col("got"), F.col("stderr"))
    g = c.groupBy(item).agg(F.count_if(known & correct).alias("passed"), F.count_if(known).alias("total"))
    return g.withColumn("score", F.when(F.col("passed") == F.col("total"), 1.0).otherwise(0.0))


def grade_items_with_cases(items: DataFrame, cases: DataFrame, item: str = "item_id") -> DataFrame:
    """J3 tail: items without any case score 0 with a reason, the item's own
    (``reason`` of ``parse_verification``) when it has one."""
    g = grade_cases(cases, item)
    own = F.col("reason") if "reason" in items.columns else F.lit(None).cast("string")
    j = items.select(item, own.alias("_why")).join(g, item, "left")
    return j.select(item, F.coalesce("passed", F.lit(0)).alias("passed"),
                    F.coalesce("total", F.lit(0)).alias("total"),
                    F.coalesce("score", F.lit(0.0)).alias("score"),
                    F.when(F.col("score").isNull(), F.coalesce("_why", F.lit("no_cases"))).alias("reason"))


# ---- J3 --------------------------------------------------------------------------
_CASES_SCHEMA = "array<struct<type:string,input:variant,output:variant,fn_name:string>>"


@F.pandas_udf(T.StringType())
def _literal_to_json(s: pd.Series) -> pd.Series:
    """Python data literals as JSON text; null where it is none."""
    def conv(t):
        if t is None:
            return None
        try:
            return json.dumps(ast.literal_eval(t))
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
    return s.map(conv)


def parse_verification(df: DataFrame, col_info: str = "verification_info",
                       col_cases: str = "test_cases") -> DataFrame:
    """Verification payload -> ``cases``, an array of (type, input,
    output, fn_name) whose output and input are JSON text, as J4 and J5 read
    them.  ``verification_info``, or ``test_cases`` when that is null or
    empty; JSON first, Python literals as fallback (data only, in an Arrow
    batch that gets just those rows).  ``reason``: 'invalid' for a payload
    that is neither or no object, 'no_cases' without payload or cases."""
    raw = F.coalesce(F.nullif(F.col(col_info), F.lit("")), F.nullif(F.col(col_cases), F.lit("")))
    d = df.withColumn("_raw", raw).withColumn("_json", F.try_parse_json("_raw").isNotNull())
    d = d.withColumn("_ver", F.when(F.col("_json"), F.col("_raw")).otherwise(
        _literal_to_json(F.when(~F.col("_json"), F.col("_raw")))))
    is_object = F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("_ver")), F.lit("OBJECT")), F.lit(False))
    items = F.from_json(F.get_json_object(F.col("_ver"), "$.test_cases"), _CASES_SCHEMA)
    cases = F.transform(items, lambda c: F.struct(
        c["type"].alias("type"), F.to_json(c["input"]).alias("input"), F.to_json(c["output"]).alias("output"),
        c["fn_name"].alias("fn_name")))
    d = d.withColumn("cases", cases)
    reason = (F.when(F.col("_raw").isNull(), "no_cases").when(F.col("_ver").isNull() | ~is_object, "invalid")
              .when(F.coalesce(F.size("cases"), F.lit(0)) <= 0, "no_cases"))
    return d.withColumn("reason", reason).drop("_raw", "_json", "_ver")


# ---- J6 / J7 / S5 / HVM all-pass ------------------------------------------------------
def holes_verdict(answers, holes, domains) -> Column:
    """J7 + S5: (ok, reason).  Missing parse -> 'missing'; key set differs
    from the hole list -> 'not_all'; a value outside its domain ->
    'domain'; else ok."""
    def reason(a: Column) -> Column:
        keys = F.map_keys(a)
        same = (F.size(F.array_except(keys, holes)) == 0) & (F.size(F.array_except(holes, keys)) == 0)
        in_dom = F.forall(F.map_entries(a), lambda e: F.coalesce(
            F.array_contains(F.coalesce(F.try_element_at(domains, e["key"]), F.array().cast("array<bigint>")),
                             e["value"].try_cast("bigint")), F.lit(False)))
        return F.when(a.isNull(), "missing").when(~same, "not_all").when(~in_dom, "domain")
    return X.once(X.once(answers, reason), lambda r: F.struct(r.isNull().alias("ok"), r.alias("reason")))


def all_outputs_pass(expected, got, inputs: str | None = None) -> Column:
    """HVM all-pass: every input has a run that ended well (a missing run is
    null in ``got``) and whose canonical output equals the expected one.
    ``inputs`` names the inputs' array when it may be longer than
    ``expected``; an input without an expectation never passes."""
    n = F.size(inputs) if inputs else F.size(expected)
    pairs = F.slice(F.arrays_zip(F.col(expected).alias("e"), F.col(got).alias("g")), 1, F.greatest(n, F.lit(1)))
    hit = F.filter(pairs, lambda p: p["e"].isNotNull() & p["g"].isNotNull() & (X.canon_output(p["e"]) == X.canon_output(p["g"])))
    return F.when(n == 0, F.lit(True)).otherwise(F.size(hit) == n)


# ---- J8 ------------------------------------------------------------------------------
def answer_match(response, expected) -> Column:
    """ELR: stripped last <Answer> block equals str(expected)."""
    r = F.coalesce(F.col(response) if isinstance(response, str) else response, F.lit(""))
    got = X.py_strip(X.last_tag_block(r, "Answer"))
    return got == F.col(expected).cast("string")


# ---- J9 ------------------------------------------------------------------------------
def grade_abduction(df: DataFrame, program: str = "program", response: str = "response",
                    expected: str = "expected", got: str = "got", run_error: str = "run_error") -> DataFrame:
    """ABD over a recorded run: adds ``score`` and ``reason``.  The extracted
    input and its lines are separate projections, so each whole-text regex
    runs once per row however many rules read them."""
    resp = F.coalesce(F.col(response), F.lit(""))
    d = df.withColumn("_in", X.extract_tagged_input(resp, "INPUT")).withColumn(
        "_tags", X.has_tag_block(resp, "INPUT"))
    d = d.withColumn("_enough", X.enough_input_lines(F.col(program), F.col("_in")))
    clean = F.coalesce(F.col(run_error), F.lit("")) == ""        # any error text counts, blank ones too
    reason = (F.when((F.col("_in") == "") & ~F.col("_tags"), "no_input")
              .when(~F.col("_enough"), "invalid_input")
              .when(~clean, "error")
              .when(~X.outputs_equal(F.col(expected), F.coalesce(F.col(got), F.lit(""))), "mismatch")
              .otherwise("ok"))
    d = d.withColumn("reason", reason)
    return d.withColumn("score", F.when(F.col("reason") == "ok", 1.0).otherwise(0.0)).drop(
        "_in", "_tags", "_enough")


# ---- D13 / D14 -----------------------------------------------------------------------
def summary_sum(df: DataFrame, by: str = "task", reward: str = "reward",
                failed: str | None = None) -> DataFrame:
    """total_score_sum = sum of rewards (failed items count 0),
    success_rate = share of rewards > 0 over ``n or 1``, n."""
    r = F.col(reward) if failed is None else F.when(F.col(failed), 0.0).otherwise(F.col(reward))
    g = df.groupBy(by).agg(F.sum(r).alias("total_score_sum"), F.count_if(r > 0).alias("_ok"),
                           F.count(F.lit(1)).alias("n"))
    return g.select(by, "total_score_sum",
                    (F.col("_ok") / F.greatest(F.col("n"), F.lit(1))).alias("success_rate"), "n")


def isclose(a: Column, b: float) -> Column:
    return F.abs(a - F.lit(b)) <= F.lit(ISCLOSE_ATOL) + F.lit(ISCLOSE_RTOL) * F.lit(abs(b))


def summary_mean(df: DataFrame, by: str = "task", reward: str = "reward") -> DataFrame:
    """total_score_mean = mean reward, success = share of rewards close
    to 1 or 100; both 0.0 when there is nothing."""
    hit = reduce(lambda x, y: x | y, [isclose(F.col(reward), v) for v in SUCCESS_REWARDS])
    g = df.groupBy(by).agg(F.avg(reward).alias("total_score_mean"),
                           F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("success"))
    return g.select(by, F.coalesce("total_score_mean", F.lit(0.0)).alias("total_score_mean"),
                    F.coalesce("success", F.lit(0.0)).alias("success"))


# ---- D16 / D17 / J14 / J13 -----------------------------------------------------------
def _num(j, path):
    return F.get_json_object(j, path).try_cast("double")


def eval_record(payload) -> Column:
    """struct(score, n, success_rate) from an evaluator payload:
    total_score else score else 0; num_evaluated else n else 0."""
    p = F.col(payload) if isinstance(payload, str) else payload
    score = F.coalesce(_num(p, "$.total_score"), _num(p, "$.score"), F.lit(0.0))
    n = F.coalesce(_num(p, "$.num_evaluated"), _num(p, "$.n"), F.lit(0.0)).cast("bigint")
    sr = F.coalesce(_num(p, "$.success_rate"), F.lit(0.0))
    return F.struct(score.alias("score"), n.alias("n"), sr.alias("success_rate"))


def task_result(payload) -> Column:
    """struct(score, success, first_detail): only the first detail is
    kept; success = success_rate > 0."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.struct(F.coalesce(_num(p, "$.total_score"), F.lit(0.0)).alias("score"),
                    (F.coalesce(_num(p, "$.success_rate"), F.lit(0.0)) > 0).alias("success"),
                    F.get_json_object(p, "$.details[0]").alias("first_detail"))


def extra_payload(**cols: Column) -> Column:
    """JSON object of the given fields; null fields are left out."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in cols.items()]))


def drop_heavy_fields(c: Column, fields=HEAVY_FIELDS, image: str = "image") -> Column:
    """Drop the heavy nested fields of a deployment record (and
    ``image.readme``); fields that are absent are ignored by the caller's
    schema."""
    return c.dropFields(*fields, f"{image}.readme")


# ---- graders as columns ------------------------------------------------------------------
def _verdict(ok: Column, reason: Column) -> Column:
    return F.struct(F.when(ok, 1.0).otherwise(0.0).alias("score"), reason.alias("reason"))


def grade_answer(response: str = "response", expected: str = "expected") -> Column:
    """ELR verdict."""
    return _verdict(answer_match(response, expected), F.lit(None).cast("string"))


def grade_sat(response: str = "response", clauses: str = "clauses") -> Column:
    """SAT verdict: the assignments named in the response satisfy every clause."""
    ok = X.once(X.parse_assignments(response), lambda a: F.coalesce(X.sat_satisfied(clauses, a), F.lit(False)))
    return X.once(ok, lambda x: _verdict(x, F.when(x, "ok").otherwise("unsatisfied")))


def grade_holes(response: str = "response", holes: str = "holes", domains: str = "domains",
                expected: str = "expected_runs", got: str = "got_runs") -> Column:
    """HVM verdict over recorded runs."""
    return X.once(holes_verdict(X.parse_holes(response), F.col(holes), F.col(domains)), lambda v: X.once(
        all_outputs_pass(expected, got),
        lambda same: _verdict(v["ok"] & same, F.coalesce(v["reason"], F.when(same, "ok").otherwise("mismatch")))))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _expectations(types: pd.Series, outputs: pd.Series) -> pd.Series:
    """J5 of all cases of an item; null for other types and invalid JSON."""
    def one(kind, text):
        if kind not in ("stdin_stdout", "function_call"):
            return None
        try:
            value = json.loads("null" if text is None else text)
        except ValueError:
            return None
        if kind == "function_call" and isinstance(value, list) and value:
            value = value[0]
        return _as_text(value)
    return pd.Series([None if t is None else [one(a, b) for a, b in zip(t, o)] for t, o in zip(types, outputs)])


def grade_deduction(cases: str = "cases", when: Column | None = None) -> Column:
    """DED verdict of an item that carries its cases, an array of (type,
    output, got, stderr); ``when`` says which rows need one."""
    c = F.col(cases) if when is None else F.when(when, F.col(cases))
    exp = _expectations(c["type"], c["output"])

    def verdict(known: Column) -> Column:
        passed = F.filter(known, lambda x: case_passes(x["e"], x["c"]["got"], x["c"]["stderr"]))
        none = F.coalesce(F.size(c), F.lit(0)) <= 0
        return X.once(~none & (F.size(passed) == F.size(known)), lambda ok: _verdict(
            ok, F.when(none, "no_cases").when(ok, "ok").otherwise("mismatch")))
    return X.once(F.filter(F.arrays_zip(c.alias("c"), exp.alias("e")),
                           lambda x: x["c"]["type"].isin("stdin_stdout", "function_call")), verdict)


def grade_abduction_row(program: str = "program", response: str = "response", expected: str = "expected",
                        got: str = "got", run_error: str = "run_error") -> Column:
    """ABD verdict (the rules of ``grade_abduction``) as one column."""
    program = F.col(program) if isinstance(program, str) else program

    def reason(resp: Column) -> Column:
        return X.once(X.extract_tagged_input(resp, "INPUT"), lambda text: F.when(
            (text == "") & ~X.has_tag_block(resp, "INPUT"), "no_input")
            .when(~X.enough_input_lines(program, text), "invalid_input")
            .when(F.coalesce(F.col(run_error), F.lit("")) != "", "error")
            .when(~X.outputs_equal(F.col(expected), F.coalesce(F.col(got), F.lit(""))), "mismatch")
            .otherwise("ok"))
    return X.once(X.once(F.coalesce(F.col(response), F.lit("")), reason), lambda r: _verdict(r == "ok", r))


# ---- U1-U3 ------------------------------------------------------------------------------
@dataclass(frozen=True)
class EnvSpec:
    """A scored environment: ``grade`` gives the verdict column, a struct of
    score and reason, of the env's rows."""
    name: str
    grade: Callable[[], Column]
    defaults: dict = field(default_factory=dict)


class EnvRegistry:
    """Name -> EnvSpec, case-insensitive; U3 factories bind defaults."""

    def __init__(self):
        self._specs: dict[str, EnvSpec] = {}

    def register(self, name: str, **defaults):
        def deco(fn):
            self._specs[name.lower()] = EnvSpec(name, partial(fn, **defaults) if defaults else fn,
                                                defaults)
            return fn
        return deco

    def get(self, name: str) -> EnvSpec:
        try:
            return self._specs[name.lower()]
        except KeyError:
            raise KeyError(f"unknown env {name!r}") from None

    def names(self) -> list[str]:
        return sorted(s.name for s in self._specs.values())

    def grade_all(self, df: DataFrame, env_col: str = "env", item: str = "item_id") -> DataFrame:
        """Each row goes to its env's grader.  There is a branch per env, so a
        grader's plan holds that grader alone and compiles to code of its own
        size, and the filter on the env prunes partitions and row groups, so a
        branch reads its env's rows.  Rows of an unknown or null env come out
        with reason 'unknown_env'."""
        name = F.lower(F.col(env_col))
        other = ~F.coalesce(name.isin(*self._specs), F.lit(False)) if self._specs else F.lit(True)
        out = df.filter(other).select(env_col, item, F.lit(0.0).alias("score"), F.lit("unknown_env").alias("reason"))
        for key, spec in self._specs.items():
            # a generator gives both fields of the verdict, so it is computed once a row
            out = out.unionByName(df.filter(name == F.lit(key)).select(env_col, item, F.inline(F.array(spec.grade()))))
        return out


# ---- U2 -----------------------------------------------------------------------------------
def evaluate_rows(tasks: DataFrame, responses: DataFrame, grade: Column, keys: list[str]) -> DataFrame:
    """A user's grading column over the recorded responses of planned
    tasks (C8 or C7 rows): every task keeps a row, graded when its response
    is there, else failed with reason 'no_response'."""
    r = responses.withColumn("_there", F.lit(True))
    j = tasks.join(r, keys, "left")
    there = F.coalesce("_there", F.lit(False))
    v = F.when(there, grade).otherwise(_verdict(F.lit(False), F.lit("no_response")))
    return j.withColumn("_v", v).select(*keys, F.col("_v.score").alias("score"), F.col("_v.reason").alias("reason"))
