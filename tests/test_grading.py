import hashlib
import json

from pyspark.sql import functions as F

from rankforge.operators import grading as G


def test_challenge_id_matches_python(spark):
    rows = [("vector:sat", '{"b": 1, "a": [1, "é"]}', "prompt é\n\"q\""), ("x", None, "p"),
            ("x", "{}", "\x1f\x0b\x0e\x01\x1a\x1f tab\t \\u001F \\\x1f \b\f\r\x7f 🙂")]
    df = spark.createDataFrame(rows, "env string, extra string, prompt string")
    out = df.select("env", "extra", "prompt",
                    G.challenge_id("env", "extra", "prompt", ascii_escape=True).alias("h")).collect()
    for r in out:
        extra = json.loads(r.extra) if r.extra else {}
        want = hashlib.sha256(json.dumps({"env": r.env, "extra": extra, "prompt": r.prompt},
                                         sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        assert r.h == want


def test_payload_to_text(spark):
    cases = ['"abc"', '["1", 2, [3, 4]]', '5', None, '["[abc","x"]', '[null,"a"]', '["[1,2]","y"]', '[[["d"],"e"],[]]',
             '{"b": 1, "a": [2.5, "é"]}', 'null', '[]', 'true', '{bad']
    df = spark.createDataFrame([(c,) for c in cases], "j string")
    got = [r.t for r in df.select(G.payload_to_text("j").alias("t")).collect()]
    assert got == ["abc", "1\n2\n3\n4", "5", "null", "[abc\nx", "null\na", "[1,2]\ny", "d\ne\n",
                   '{"b": 1, "a": [2.5, "é"]}', "null", "", "true", None]


def test_grade_cases_quirks(spark):
    rows = [(1, "other", '"x"', "x", ""),                       # only unknown types -> 1.0
            (2, "stdin_stdout", '["a", "b"]', "a  \nb\n\n", ""),
            (2, "function_call", '[7, 1]', "7\n", ""),
            (3, "stdin_stdout", None, "anything", ""),           # a missing output is the text null
            (5, "stdin_stdout", None, "null", " "), (6, "function_call", "{bad", "", ""),
            (4, "stdin_stdout", '"a"', "a", "Traceback")]        # stderr fails
    df = spark.createDataFrame(rows, "item_id long, type string, output string, got string, stderr string")
    got = {r.item_id: (r.passed, r.total, r.score) for r in G.grade_cases(df).collect()}
    assert got == {1: (0, 0, 1.0), 2: (2, 2, 1.0), 3: (0, 1, 0.0), 4: (0, 1, 0.0),
                   5: (1, 1, 1.0), 6: (0, 1, 0.0)}


def test_summaries(spark):
    df = spark.createDataFrame([("t", 1.0), ("t", 0.0), ("t", 100.0), ("u", 0.5)], "task string, reward double")
    s = {r.task: r for r in G.summary_sum(df).collect()}
    assert s["t"].total_score_sum == 101.0 and s["t"].n == 3 and abs(s["t"].success_rate - 2 / 3) < 1e-12
    m = {r.task: r for r in G.summary_mean(df).collect()}
    assert abs(m["t"].success - 2 / 3) < 1e-12 and m["u"].success == 0.0


def test_parse_verification_literal_fallback(spark):
    rows = [(1, "{'test_cases': [{'type': 'stdin_stdout', 'input': '1', 'output': '2'}]}", None),
            (2, '{"test_cases": []}', None), (3, None, '{"test_cases": [{"type": "x"}]}'), (4, None, None),
            (5, "{not valid", None), (6, "", '{"test_cases": [{"output": [1, null]}]}'), (7, None, "{bad"), (8, "[1]", None)]
    df = spark.createDataFrame(rows, "id long, verification_info string, test_cases string")
    got = {r.id: (r.n, r.reason) for r in G.parse_verification(df).select(
        "id", F.coalesce(F.size("cases"), F.lit(0)).alias("n"), "reason").collect()}
    assert got == {1: (1, None), 2: (0, "no_cases"), 3: (1, None), 4: (0, "no_cases"), 5: (0, "invalid"), 6: (1, None), 7: (0, "invalid"),
                   8: (0, "invalid")}
    out = G.parse_verification(df).where("id in (1, 6)").orderBy("id").select(F.col("cases")[0]["output"].alias("o")).collect()
    assert [r.o for r in out] == ['"2"', "[1,null]"]


def test_registry_dispatch_unknown_env(spark):
    reg = G.EnvRegistry()

    @reg.register("A:B")
    def _g():
        return F.struct(F.lit(1.0).alias("score"), F.lit("ok").alias("reason"))

    df = spark.createDataFrame([("a:b", 1), ("zz", 2)], "env string, item_id long")
    got = {r.item_id: r.reason for r in reg.grade_all(df).collect()}
    assert got == {1: "ok", 2: "unknown_env"}
    assert G.EnvRegistry().grade_all(df).where("reason = 'unknown_env'").count() == 2
    assert reg.get("a:B").name == "A:B"


def test_holes_verdict_and_answers(spark):
    from rankforge.functions.text import parse_holes
    rows = [("<HOLES>?a=1\n?b=-1</HOLES>", ["?a", "?b"]), ("<HOLES>?a=1</HOLES>", ["?a", "?b"]),
            ("<HOLES>?a=99\n?b=0</HOLES>", ["?a", "?b"]), ("none", ["?a"])]
    df = spark.createDataFrame(rows, "t string, holes array<string>")
    dom = F.create_map(F.lit("?a"), F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")),
                       F.lit("?b"), F.array(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint")))
    got = [r.v.reason for r in df.select(G.holes_verdict(parse_holes("t"), F.col("holes"), dom).alias("v")).collect()]
    assert got == [None, "not_all", "domain", "missing"]
    ans = spark.createDataFrame([("<answer> 42 </answer>", 42), ("<Answer>1</Answer><Answer>2</Answer>", 1),
                                 (None, 0)], "r string, e long")
    assert [r.ok for r in ans.select(G.answer_match("r", "e").alias("ok")).collect()] == [True, False, False]


def test_abduction_reasons(spark):
    prog = "a = input()\nb = input()"
    rows = [("no tags here", "x", "x", ""), ("<INPUT></INPUT>", "x", "x", ""), ("<INPUT>1\n2</INPUT>", "x", "x", "Err"),
            ("<INPUT>1\n2</INPUT>", "x", "y", ""), ("<think><INPUT>z</INPUT></think><INPUT>1\n2\n</INPUT>", "x\n", "x", "")]
    df = spark.createDataFrame([(prog,) + r for r in rows], "program string, response string, expected string, "
                                                            "got string, run_error string")
    got = [(r.reason, r.score) for r in G.grade_abduction(df).collect()]
    assert got == [("no_input", 0.0), ("invalid_input", 0.0), ("error", 0.0), ("mismatch", 0.0), ("ok", 1.0)]


def test_runs_must_be_there(spark):
    df = spark.createDataFrame([(1, ["a"], ["a"], [1]), (2, [""], [None], [1]), (3, ["a"], ["a"], [1, 2]), (4, [], [], []),
                                (5, ["a", "b"], ["a"], [1])], "id int, e array<string>, g array<string>, i array<int>")
    got = [r.ok for r in df.orderBy("id").select(G.all_outputs_pass("e", "g", "i").alias("ok")).collect()]
    assert got == [True, False, False, True, True]


def test_user_grader_over_recorded_rows(spark):
    tasks = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "uid int, item_id int")
    resp = spark.createDataFrame([(1, 10, "<Answer>5</Answer>", 5), (2, 10, "<Answer>4</Answer>", 5)],
                                 "uid int, item_id int, response string, expected int")
    got = {(r.uid, r.item_id): (r.score, r.reason) for r in G.evaluate_rows(tasks, resp, G.grade_answer(), ["uid", "item_id"]).collect()}
    assert got == {(1, 10): (1.0, None), (1, 11): (0.0, "no_response"), (2, 10): (0.0, None)}


def test_answers_are_parsed_once_a_row(spark):
    """However often a verdict reads them, the block's regex is there once."""
    df = spark.createDataFrame([(1, "<HOLES>\n?a = 3\n?b = 1\n</HOLES>", ["?a", "?b"], ["x\n"], ["x"]), (2, None, ["?a"], ["x"], [None])],
                               "item_id int, response string, holes array<string>, expected_runs array<string>, got_runs array<string>")
    df = df.selectExpr("*", "map('?a', sequence(0L, 5L), '?b', sequence(0L, 5L)) as domains")
    out = df.select("item_id", F.inline(F.array(G.grade_holes())))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.0, "ok"), (2, 0.0, "missing")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("<HOLES>") == 1


def test_cases_of_one_file_are_dealt_to_all_tasks(spark):
    rows = [(i, "function_call", '[["a", 1], 2]', "a\n1", "") for i in range(8)]
    cases = spark.createDataFrame(rows, "item_id long, type string, output string, got string, stderr string").coalesce(1)
    graded = G.grade_cases(cases)
    assert "RoundRobinPartitioning" in graded._jdf.queryExecution().executedPlan().toString()
    assert [(r.passed, r.total, r.score) for r in graded.collect()] == [(1, 1, 1.0)] * 8
