"""Agent action formats (T18-T22) and item prompts (T21), Column in,
Column out.  The function specs are plan constants (literal arrays/maps), so
no join is needed to look them up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions.text import PY_WS, py_strip

# ---- fixed values: household-task function spec, in lookup order ------------------------
# (function, action name, argument names, conjunction)
HOUSEHOLD_SPEC = (
    ("goto", "go to", ("recep",), None),
    ("take", "take", ("obj", "recep"), "from"),
    ("put", "put", ("obj", "recep"), "in/on"),
    ("toggle", "toggle", ("obj",), None),
    ("open", "open", ("recep",), None),
    ("close", "close", ("recep",), None),
    ("heat", "heat", ("obj", "recep"), "with"),
    ("cool", "cool", ("obj", "recep"), "with"),
    ("clean", "clean", ("obj", "recep"), "with"),
    ("examine", "examine", ("recep", "obj"), "with"),
    ("look", "look", (), None),
    ("inventory", "inventory", (), None),
    ("use", "use", ("obj",), None),
)
# science-task function spec, in lookup order
SCIENCE_SPEC = (
    ("open", "open", ("obj",), None),
    ("close", "close", ("obj",), None),
    ("activate", "activate", ("obj",), None),
    ("deactivate", "deactivate", ("obj",), None),
    ("connect", "connect", ("obj1", "obj2"), "to"),
    ("disconnect", "disconnect", ("obj",), None),
    ("use", "use", ("tool", "obj"), "on"),
    ("lookaround", "look around", (), None),
    ("lookat", "look at", ("obj",), None),
    ("read", "read", ("obj",), None),
    ("move", "move", ("obj", "container"), "to"),
    ("pickup", "pick up", ("obj",), None),
    ("drop", "drop", ("obj",), None),
    ("pour", "pour", ("liq", "container"), "into"),
    ("dunk", "dunk", ("container", "liq"), "in"),
    ("mix", "mix", ("container",), None),
    ("goto", "go to", ("loc",), None),
    ("eat", "eat", ("food",), None),
    ("flush", "flush", ("obj",), None),
    ("focus", "focus on", ("obj",), None),
    ("choose", "choose", ("option",), None),
    ("wait", "wait", ("duration",), None),
    ("examine", "examine", ("obj",), None),
    ("task", "task", (), None),
    ("inventory", "inventory", (), None),
)
TOOL_PROMPT_HEAD = "You have the following functions available:\n\n"
TOOL_PROMPT_TAIL = (
    "\n\nIf you want to invoke a provided function or tool, please reply in the following *JSON* format:\n"
    "```json\n{\n"
    '    "thought": "I think ...",\n'
    '    "function_name": "function_name",\n'
    '    "arguments": <valid json object of args>\n'
    "}\n```\n"
    "Only reply the *JSON* object, no other text should be present.\n")
CODE_TOOL_PROMPT_HEAD = "Here are the signatures and docstrings of these functions:\n\n```python\n"
CODE_TOOL_PROMPT_TAIL = (
    "\n```"
    "\n\nIf you want to call these functions, please reply the python code block:\n"
    "```python\n"
    "# Write you thought in the code comment before you call any function.\n"
    "<write valid python code here.>\n"
    "```\n"
    'Only reply the code block with "```python" and "```",  no other text should be present.\n')
SAT_PROMPT_HEAD = "Find a satisfying assignment for the following {k}-SAT formula over variables x1..x{n}:\n"
SAT_PROMPT_TAIL = ("Provide your answer as comma-separated assignments like `x1=True, x2=False, ...`, "
                   "or respond `UNSAT` if it has no solution.")
ANSWER_PROMPT_TAIL = "\n\nProvide your solution in blocks <Answer>...</Answer>\nFor instance: \n<Answer>20</Answer>"
CODE_PROMPT_HINT = (
    "\n\n---\n"
    "⚠️ **Instructions** ⚠️\n"
    "Write a complete **Python 3** program that\n"
    "• reads *all* input from **STDIN** (using `input()` / `sys.stdin`),\n"
    "• writes *only* the required answer(s) to **STDOUT** using `print`,\n"
    "• contains no additional prompts or debug text, and\n"
    "• is returned as a single ```python … ``` fenced block.\n"
)
ABDUCTION_PROMPT = """You are a programming expert. Given a Python program and its expected output, you need to determine the exact input that would produce this output.

Program:
```python
{program}
```

Expected Output:
```
{output}
```

Task: Analyze the program to understand what input format it expects from stdin, then provide the input data that would produce the expected output.

You can provide any explanations, analysis, or reasoning you want. However, you MUST include the input data within <INPUT> </INPUT> tags.

Format the input data like this:
<INPUT>
[input data here - each line on a separate line as the program expects]
</INPUT>

I will extract only the content between these tags.

Requirements for the input data within the tags:
1. Each line of input should be on a separate line
2. Use the exact format the program expects  
3. Provide the raw input values that should be fed to stdin
4. Do not include any prefixes or extra formatting within the INPUT tags

Please analyze the program and provide the required input:"""
HOLE_PROMPT_HEAD = """You are given a small stack-based Virtual Machine program with UNKNOWN constants (holes).
Instruction set:
  PUSH n       ; push integer n (n can also be a hole like ?a)
  LOAD i       ; push i-th input integer (0-based)
  ADD SUB MUL DIV MOD
  DUP SWAP POP
  JMP k        ; absolute jump
  JMPZ k       ; jump if top==0
  JMPNZ k      ; jump if top!=0
  PRINT
  HALT

Program:
"""
HOLE_PROMPT_TAIL = """

Return ONLY the hole mapping in this exact format:

<HOLES>
?a=3
?b=-1
?c=42
</HOLES>
"""
HOLE_DOMAIN_LIST_MAX = 15
# -------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _spec_map(i: int, spec=HOUSEHOLD_SPEC):
    return F.create_map(*[x for row in spec for x in (F.lit(row[0]), _spec_val(row, i))])


def _spec_val(row, i):
    v = row[i]
    if i == 2:
        return F.array(*[F.lit(a) for a in v]).cast("array<string>")
    return F.lit(v).cast("string")


def _call_json(c) -> Column:
    """The text between the first '{' and the last '}', braces restored."""
    inner = F.regexp_replace(F.regexp_replace(_c(c), r"^[^{]*\{", ""), r"\}[^}]*\z", "")
    return F.concat(F.lit("{"), inner, F.lit("}"))


_CALL = "struct<thought:string,function_name:string,arguments:map<string,string>>"


# ---- T18 -----------------------------------------------------------------------------------
def call_to_action(c) -> Column:
    """Function-call JSON -> struct(thought, action, error).  Unknown
    function, more arguments than declared, or a declared argument missing
    -> null action with an error code."""
    p = F.from_json(_call_json(c), _CALL, {"allowUnquotedControlChars": "true"})
    fn = py_strip(p["function_name"])
    args = p["arguments"]
    names = F.try_element_at(_spec_map(2), fn)
    name = F.try_element_at(_spec_map(1), fn)
    conj = F.try_element_at(_spec_map(3), fn)
    n = F.coalesce(F.size(F.map_keys(args)), F.lit(0))
    a0 = F.try_element_at(args, F.try_element_at(names, F.lit(1)))
    a1 = F.try_element_at(args, F.try_element_at(names, F.lit(2)))
    err = (F.when(p.isNull() | fn.isNull(), "unparsable")
           .when(names.isNull(), "invalid_function")
           .when(n > F.size(names), "too_many_args")
           .when((n >= 1) & a0.isNull(), "missing_arg")
           .when((n == 2) & a1.isNull(), "missing_arg"))
    action = (F.when(n == 0, name)
              .when(n == 1, F.concat(name, F.lit(" "), a0))
              .otherwise(F.concat(name, F.lit(" "), a0, F.lit(" "), conj, F.lit(" "), a1)))
    return F.struct(p["thought"].alias("thought"), F.when(err.isNull(), action).alias("action"),
                    err.alias("error"))


def shop_call_to_action(c) -> Column:
    """Shopping form: search -> search[keywords], click -> click[item]."""
    p = F.from_json(_call_json(c), _CALL, {"allowUnquotedControlChars": "true"})
    fn = p["function_name"]
    act = (F.when(fn == "search", F.concat(F.lit("search["), F.try_element_at(p["arguments"], F.lit("keywords")),
                                           F.lit("]")))
           .when(fn == "click", F.concat(F.lit("click["), F.try_element_at(p["arguments"], F.lit("item")),
                                         F.lit("]"))))
    return F.struct(p["thought"].alias("thought"), act.alias("action"),
                    F.when(act.isNull(), F.lit("invalid_function")).alias("error"))


# ---- T19 -----------------------------------------------------------------------------------
def _spec_arr(spec=HOUSEHOLD_SPEC) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(f).alias("fn"), F.lit(nm).alias("name"),
                              F.array(*[F.lit(a) for a in args]).cast("array<string>").alias("args"),
                              F.lit(cj).cast("string").alias("conj"))
                     for i, (f, nm, args, cj) in enumerate(spec)])


def action_to_call(c) -> Column:
    """Action text -> struct(fn, args array, arg_names, error): the first spec
    (lookup order) whose name is a prefix; the name removed; the rest split
    on the conjunction (surrounding whitespace) or taken whole."""
    a = _c(c)
    s = F.try_element_at(F.filter(_spec_arr(), lambda x: F.startswith(a, x["name"])), F.lit(1))
    rest = py_strip(F.substring(a, F.length(s["name"]) + 1, 1 << 30))
    split = F.transform(F.split(rest, F.concat(F.lit(f"{PY_WS}+"), s["conj"], F.lit(f"{PY_WS}+")), -1),
                        lambda x: py_strip(x))
    parts = F.when(s["conj"].isNotNull(), split).when(rest != "", F.array(rest)) \
        .otherwise(F.array().cast("array<string>"))
    err = F.when(s.isNull(), "invalid_action").when(F.size(parts) > F.size(s["args"]), "too_many_args")
    return F.struct(s["fn"].alias("fn"), parts.alias("args"), s["args"].alias("arg_names"), err.alias("error"))


def science_call_to_action(c) -> Column:
    """Science-task form: no argument-count check; ``wait`` glues its
    duration to the name, ``choose`` is the bare option; two arguments need
    the function's conjunction.  struct(thought, action, error)."""
    sp = SCIENCE_SPEC
    p = F.from_json(_call_json(c), _CALL, {"allowUnquotedControlChars": "true"})
    fn = py_strip(p["function_name"])
    args = p["arguments"]
    names = F.try_element_at(_spec_map(2, sp), fn)
    name = F.try_element_at(_spec_map(1, sp), fn)
    conj = F.try_element_at(_spec_map(3, sp), fn)
    n = F.coalesce(F.size(F.map_keys(args)), F.lit(0))
    a0 = F.try_element_at(args, F.try_element_at(names, F.lit(1)))
    a1 = F.try_element_at(args, F.try_element_at(names, F.lit(2)))
    err = (F.when(p.isNull() | fn.isNull(), "unparsable")
           .when(names.isNull(), "invalid_function")
           .when((n == 1) & a0.isNull(), "missing_arg")
           .when((n >= 2) & conj.isNull(), "no_conjunction")
           .when((n >= 2) & (a0.isNull() | a1.isNull()), "missing_arg"))
    one = (F.when(fn == "wait", F.concat(name, a0)).when(fn == "choose", a0)
           .otherwise(F.concat(name, F.lit(" "), a0)))
    action = (F.when(n == 0, name).when(n == 1, one)
              .otherwise(F.concat(name, F.lit(" "), a0, F.lit(" "), conj, F.lit(" "), a1)))
    return F.struct(p["thought"].alias("thought"), F.when(err.isNull(), action).alias("action"),
                    err.alias("error"))


def science_action_to_call(c) -> Column:
    """Science-task form of T19: digit-only actions are ``choose``; ``wait``
    keeps the first number of its argument."""
    a = _c(c)
    s = F.try_element_at(F.filter(_spec_arr(SCIENCE_SPEC), lambda x: F.startswith(a, x["name"])), F.lit(1))
    digits = a.rlike(r"^[0-9]+$")
    choose = F.try_element_at(F.filter(_spec_arr(SCIENCE_SPEC), lambda x: x["fn"] == "choose"), F.lit(1))
    spec = F.when(digits, choose).otherwise(s)
    name_len = F.when(digits, F.lit(0)).otherwise(F.length(s["name"]))
    rest = py_strip(F.substring(a, name_len + 1, 1 << 30))
    split = F.transform(F.split(rest, F.concat(F.lit(f"{PY_WS}+"), spec["conj"], F.lit(f"{PY_WS}+")), -1),
                        lambda x: py_strip(x))
    parts = F.when(spec["conj"].isNotNull(), split).when(rest != "", F.array(rest)) \
        .otherwise(F.array().cast("array<string>"))
    dur = F.try_element_at(F.regexp_extract_all(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")),
                                                F.lit(r"\d+"), 0), F.lit(1))
    parts = F.when((spec["fn"] == "wait") & (F.size(parts) == 1), F.array(dur)).otherwise(parts)
    err = (F.when(spec.isNull(), "invalid_action").when(F.size(parts) > F.size(spec["args"]), "too_many_args")
           .when((spec["fn"] == "wait") & (F.size(parts) == 1) & dur.isNull(), "no_duration"))
    return F.struct(spec["fn"].alias("fn"), parts.alias("args"), spec["args"].alias("arg_names"),
                    err.alias("error"))


def _json_str(x: Column) -> Column:
    """JSON string literal of x (escaped, quoted), non-ASCII kept."""
    j = F.to_json(F.array(x))
    return F.substring(j, 2, F.length(j) - 2)


def call_json(thought, call) -> Column:
    """T19 output as indented JSON text (two-space indent, like a
    pretty-printed dump with ``ensure_ascii`` off); null on error."""
    names, vals = call["arg_names"], call["args"]
    n = F.size(vals)
    kv = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                     lambda i: F.concat(F.lit("    "), _json_str(F.element_at(names, i)), F.lit(": "),
                                        _json_str(F.element_at(vals, i))))
    args = F.when(n == 0, F.lit("{}")).otherwise(
        F.concat(F.lit("{\n"), F.array_join(kv, ",\n"), F.lit("\n  }")))
    body = F.concat(F.lit('{\n  "thought": '), _json_str(_c(thought)), F.lit(',\n  "function_name": '),
                    _json_str(call["fn"]), F.lit(',\n  "arguments": '), args, F.lit("\n}"))
    return F.when(call["error"].isNull(), body)


# ---- T20 -----------------------------------------------------------------------------------
def py_repr(x: Column) -> Column:
    """repr() of a str for the common printable case: single quotes unless
    the text has a single quote and no double quote; backslash, newline,
    carriage return and tab escaped."""
    e = F.replace(_c(x), F.lit("\\"), F.lit("\\\\"))
    for raw, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        e = F.replace(e, F.lit(raw), F.lit(esc))
    dq = F.contains(_c(x), F.lit("'")) & ~F.contains(_c(x), F.lit('"'))
    return F.when(dq, F.concat(F.lit('"'), e, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(e, F.lit("'"), F.lit("\\'")), F.lit("'")))


def call_to_code(thought, call) -> Column:
    """Household code form: fenced block with '#thought' and fn(args)."""
    vals = call["args"]
    n = F.size(vals)
    argtxt = F.when(n == 0, F.lit("")).when(n == 1, py_repr(vals[0])).otherwise(
        F.concat(py_repr(vals[0]), F.lit(","), py_repr(vals[1])))
    body = F.concat(F.lit("```python\n#"), _c(thought), F.lit("\n"), call["fn"], F.lit("("), argtxt,
                    F.lit(")\n```"))
    return F.when(call["error"].isNull(), body)


def shop_to_code(thought, action) -> Column:
    """Shopping code form: search('kw') / click('item') from search[..] / click[..]."""
    a = _c(action)
    inner = F.substring_index(F.substring_index(a, "[", -1), "]", 1)
    fn = F.when(F.startswith(a, F.lit("search")), "search").when(F.startswith(a, F.lit("click")), "click")
    call = F.when(fn.isNotNull(), F.concat(fn, F.lit("("), py_repr(inner), F.lit(")"))).otherwise(F.lit(""))
    return F.concat(F.lit("```python\n# "), _c(thought), F.lit("\n"), call, F.lit("\n```"))


# ---- T21 -----------------------------------------------------------------------------------
def sat_formula(clauses) -> Column:
    """(x1 ∨ ¬x2 ∨ ...) ∧ (...) over a clause list."""
    cl = F.transform(_c(clauses), lambda c: F.concat(F.lit("("), F.array_join(F.transform(
        c, lambda lit: F.concat(F.when(lit > 0, F.lit("")).otherwise(F.lit("¬")), F.lit("x"),
                                F.abs(lit).cast("string"))), " ∨ "), F.lit(")")))
    return F.array_join(cl, " ∧ ")


def sat_prompt(clauses, n: int, k: int) -> Column:
    return F.concat(F.lit(SAT_PROMPT_HEAD.format(k=k, n=n)), sat_formula(clauses), F.lit("\n"),
                    F.lit(SAT_PROMPT_TAIL))


def answer_prompt(problem) -> Column:
    return F.concat(_c(problem), F.lit(ANSWER_PROMPT_TAIL))


def code_prompt(prompt) -> Column:
    return F.concat(F.regexp_replace(_c(prompt), f"{PY_WS}+\\z", ""), F.lit(CODE_PROMPT_HINT))


def abduction_prompt(program, output) -> Column:
    head, rest = ABDUCTION_PROMPT.split("{program}")
    mid, tail = rest.split("{output}")
    return F.concat(F.lit(head), _c(program), F.lit(mid), _c(output), F.lit(tail))


def hole_prompt(code, holes, domains, inputs, expected) -> Column:
    """Hole-program prompt: numbered code lines, each hole's domain (a range
    when it has more than 15 values, else the set), and the test cases.
    ``code`` array<struct<op,arg>>, ``domains`` map<string,array<bigint>>,
    ``inputs`` array<array<bigint>>, ``expected`` array<string>."""
    prog = F.array_join(F.transform(_c(code), lambda x, i: F.concat(
        F.format_string("%03d", i), F.lit(": "), x["op"],
        F.when(x["arg"].isNotNull(), F.concat(F.lit(" "), x["arg"])).otherwise(F.lit("")))), "\n")

    def dom_line(h):
        d = F.element_at(_c(domains), h)
        rng = F.concat(h, F.lit(" ∈ ["), F.array_min(d).cast("string"), F.lit(", "),
                       F.array_max(d).cast("string"), F.lit("] (integers)"))
        st = F.concat(h, F.lit(" ∈ {"), F.array_join(F.transform(d, lambda v: v.cast("string")), ", "), F.lit("}"))
        return F.when(F.size(d) > HOLE_DOMAIN_LIST_MAX, rng).otherwise(st)

    holes_txt = F.array_join(F.transform(_c(holes), dom_line), "\n- ")
    cases = F.array_join(F.transform(F.arrays_zip(_c(inputs).alias("i"), _c(expected).alias("o")), lambda z, k: F.concat(
        F.lit("Case #"), k.cast("string"), F.lit(": input=["),
        F.array_join(F.transform(z["i"], lambda v: v.cast("string")), ", "), F.lit("]  expected stdout=\n---\n"),
        z["o"], F.lit("\n---"))), "\n")
    return F.concat(F.lit(HOLE_PROMPT_HEAD), prog, F.lit("\n\nHoles and domains:\n- "), holes_txt,
                    F.lit("\n\nTest cases:\n"), cases, F.lit(HOLE_PROMPT_TAIL))


# ---- T22 -----------------------------------------------------------------------------------
def function_signature(name, description, params, required) -> Column:
    """``def name(a, b='b'):`` and the docstring lines; ``params`` is an
    array<struct<name,type,description>>, ``required`` array<string>."""
    sig = F.array_join(F.transform(_c(params), lambda p: F.when(
        F.array_contains(_c(required), p["name"]), p["name"]).otherwise(
        F.concat(p["name"], F.lit("='"), p["name"], F.lit("'")))), ", ")
    doc = F.array_join(F.transform(_c(params), lambda p: F.concat(
        F.lit("    :param "), p["name"], F.lit(" ("), p["type"], F.lit("): "), p["description"], F.lit("\n"))), "")
    return F.concat(F.lit("def "), _c(name), F.lit("("), sig, F.lit("):\n"), F.lit('    """\n    '),
                    _c(description), F.lit("\n\n"), doc, F.lit('    """\n'))


def function_signatures(functions) -> Column:
    """The signatures of a list of functions, a blank line between them;
    ``functions`` is an array<struct<name,description,params,required>>."""
    return F.array_join(F.transform(_c(functions), lambda f: function_signature(
        f["name"], f["description"], f["params"], f["required"])), "\n")


def _quoted(x: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]\z", "")


def _block(items: Column, brackets: str, indent: int) -> Column:
    """A JSON list or object over lines; an empty one stays on its line."""
    pad = " " * indent
    body = F.concat(F.lit(f"{brackets[0]}\n{pad}  "), F.array_join(items, f",\n{pad}  "), F.lit(f"\n{pad}{brackets[1]}"))
    return F.when(F.size(items) > 0, body).otherwise(F.lit(brackets))


def tool_json(functions) -> Column:
    """The functions as JSON tool descriptions, two spaces a level."""
    def one(f):
        props = F.transform(f["params"], lambda p: F.concat(
            _quoted(p["name"]), F.lit(": {\n          \"type\": "), _quoted(p["type"]),
            F.lit(",\n          \"description\": "), _quoted(p["description"]), F.lit("\n        }")))
        return F.concat(
            F.lit('{\n  "type": "function",\n  "function": {\n    "name": '), _quoted(f["name"]),
            F.lit(',\n    "description": '), _quoted(f["description"]),
            F.lit(',\n    "parameters": {\n      "type": "object",\n      "properties": '), _block(props, "{}", 6),
            F.lit(',\n      "required": '), _block(F.transform(f["required"], _quoted), "[]", 6),
            F.lit("\n    }\n  }\n}"))
    return F.array_join(F.transform(_c(functions), one), "\n")


def tool_prompt(functions) -> Column:
    """The prompt that offers functions to be called by JSON."""
    return F.concat(F.lit(TOOL_PROMPT_HEAD), tool_json(functions), F.lit(TOOL_PROMPT_TAIL))


def code_tool_prompt(functions) -> Column:
    """The prompt that offers functions to be called by code."""
    return F.concat(F.lit(CODE_TOOL_PROMPT_HEAD), function_signatures(functions), F.lit(CODE_TOOL_PROMPT_TAIL))
