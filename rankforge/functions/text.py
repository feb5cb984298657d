"""Answer-extraction and text-normalisation functions (T1-T27), Column in,
Column out, all JVM-side (regex and higher-order functions, no UDF).

Python text semantics are kept on purpose:
* ``str.strip``/``rstrip``/``split()`` treat all Unicode whitespace as
  whitespace (``PY_WS``), Spark ``trim`` only spaces;
* ``splitlines`` breaks on more than ``\\n`` (``PY_LINE_BREAK``) and drops a
  final empty piece, ``split("\\n")`` does not;
* Python ``.`` does not match ``\\n`` only: Java needs ``(?d)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: Python's whitespace and line-break sets -----------------
PY_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
PY_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: The characters of ``PY_WS``: blanks can be cut off both ends without a regex.
PY_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
ELLIPSIS = "…"
SHORTEN_WIDTH = 80
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row however often it is
    read: the reads are of a lambda's variable, which no projection is folded into."""
    return F.element_at(F.transform(F.array(value), use), 1)


def py_strip(c) -> Column:
    return F.btrim(_c(c), F.lit(PY_WS_CHARS))


def py_rstrip(c) -> Column:
    return F.rtrim(_c(c), F.lit(PY_WS_CHARS))


def py_splitlines(c) -> Column:
    """``str.splitlines()``: no trailing empty piece, empty text -> []."""
    c = _c(c)
    parts = F.split(F.regexp_replace(c, f"(?:{PY_LINE_BREAK})\\z", ""), PY_LINE_BREAK, -1)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(parts)


def rstrip_lines(arr) -> Column:
    return F.transform(arr, lambda x: py_rstrip(x))


# ---- T1 ------------------------------------------------------------------------
def strip_reasoning(c) -> Column:
    """Delete <think>..</think> and <thinking>..</thinking> (case-sensitive)."""
    c = F.regexp_replace(_c(c), r"(?s)<think>.*?</think>", "")
    return F.regexp_replace(c, r"(?s)<thinking>.*?</thinking>", "")


# ---- T2 / T3 ---------------------------------------------------------------------
def last_tag_block(c, tag: str) -> Column:
    """Text of the last <tag>..</tag>, case-insensitive, across lines; '' if none."""
    blocks = F.regexp_extract_all(_c(c), F.lit(f"(?is)<{tag}>(.*?)</{tag}>"), 1)
    return F.coalesce(F.try_element_at(blocks, F.lit(-1)), F.lit(""))


def has_tag_block(c, tag: str) -> Column:
    return _c(c).rlike(f"(?is)<{tag}>.*?</{tag}>")


def tidy_block(c) -> Column:
    """strip, splitlines, rstrip each line, drop trailing blank lines, join."""
    lines = once(py_strip(c), lambda x: rstrip_lines(py_splitlines(x)))
    return F.regexp_replace(F.array_join(lines, "\n"), r"\n+\z", "")


def extract_tagged_input(c, tag: str = "INPUT") -> Column:
    """T1 + T2 + T3: the cleaned last <INPUT> block of a response."""
    return tidy_block(last_tag_block(strip_reasoning(c), tag))


# ---- T4 --------------------------------------------------------------------------
def strip_fences(c) -> Column:
    """Last ```python block; else last ```lang block; else the first loose
    fence; else the whole text; trimmed."""
    c = _c(c)
    py = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?s)```python\s*\n(.*?)```"), 1), F.lit(-1))
    any_ = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?s)```(?:\w*)\s*\n(.*?)```"), 1), F.lit(-1))
    loose = F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?i)```(?:python)?\s*([\s\S]*?)```"), 1), F.lit(1))
    return py_strip(F.coalesce(py, any_, loose, c))


# ---- T5 / T6 / T7 -------------------------------------------------------------------
def normalise_output(c) -> Column:
    """rstrip the whole text, then rstrip every line."""
    return F.array_join(rstrip_lines(py_splitlines(py_rstrip(c))), "\n")


def outputs_equal(expected, actual) -> Column:
    """Exact; else stripped with CRLF -> LF; else line-wise rstrip equality."""
    e, a = _c(expected), _c(actual)
    es = F.replace(py_strip(e), F.lit("\r\n"), F.lit("\n"))
    as_ = F.replace(py_strip(a), F.lit("\r\n"), F.lit("\n"))
    lines_eq = rstrip_lines(py_splitlines(es)) == rstrip_lines(py_splitlines(as_))
    return (e == a) | (es == as_) | lines_eq


def canon_output(c) -> Column:
    """CRLF/CR -> LF, drop exactly one trailing newline, rstrip each line
    (split on '\\n'); null -> ''."""
    c = F.coalesce(_c(c), F.lit(""))
    c = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    c = F.regexp_replace(c, r"\n\z", "")
    return F.array_join(F.transform(F.split(c, "\n", -1), lambda x: py_rstrip(x)), "\n")


# ---- T8 ----------------------------------------------------------------------------
def enough_input_lines(program, inp) -> Column:
    """Loop programs need more lines than the first line's count; others at
    least one line per ``input()`` call."""
    program, inp = _c(program), F.coalesce(_c(inp), F.lit(""))
    lines = py_splitlines(inp)
    calls = (F.length(program) - F.length(F.replace(program, F.lit("input()"), F.lit("")))) / 7
    first = F.try_element_at(lines, F.lit(1))
    loop = F.contains(program, F.lit("for _ in range(int(input()))")) & (F.size(lines) > 0) \
        & F.coalesce(first.rlike(r"^[0-9]+$"), F.lit(False))
    n_first = first.try_cast("decimal(38,0)")
    return F.when(loop, F.size(lines) > n_first).otherwise(F.size(lines) >= calls)


# ---- T9 / J6 -----------------------------------------------------------------------
#: Whole numbers read from answers.
WHOLE = "decimal(38,0)"


def _last_wins_map(entries, key_type: str, val_type: str) -> Column:
    """Fold (k, v) structs into a map where a later key replaces an earlier
    one; one pass, the entries array is evaluated once."""
    empty = F.create_map().cast(f"map<{key_type},{val_type}>")
    return F.aggregate(entries, empty, lambda acc, e: F.map_concat(
        F.map_filter(acc, lambda k, v: k != e["k"]), F.create_map(e["k"], e["v"])))


def parse_assignments(c) -> Column:
    """All ``x<int>=(True|False|1|0)``; the last one wins per variable;
    map<decimal(38,0), boolean>, as a variable's number may pass a long."""
    c = F.coalesce(_c(c), F.lit(""))
    pat = r"x(\d+)=(True|False|1|0)"
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pat), 1).alias("k"),
                         F.regexp_extract_all(c, F.lit(pat), 2).alias("v"))
    entries = F.transform(pairs, lambda p: F.struct(p["k"].try_cast(WHOLE).alias("k"),
                                                    F.lower(p["v"]).isin("true", "1").alias("v")))
    return _last_wins_map(F.filter(entries, lambda p: p["k"].isNotNull()), WHOLE, "boolean")


def sat_satisfied(clauses, assignment) -> Column:
    """Every clause has a literal whose variable is assigned with the
    matching sign; an unassigned variable satisfies nothing."""
    return F.forall(_c(clauses), lambda cl: F.exists(
        cl, lambda lit: F.coalesce(F.try_element_at(assignment, F.abs(lit.cast(WHOLE))) == (lit > 0),
                                   F.lit(False))))


# ---- T10 ---------------------------------------------------------------------------
def parse_holes(c) -> Column:
    """Last <HOLES> block, lines ``?name = int``; blank and '#' lines skipped;
    any other line -> null; the last value wins; map<string, decimal(38,0)>."""
    c = _c(c)
    blocks = F.regexp_extract_all(c, F.lit(r"(?is)<HOLES>\s*(.*?)\s*</HOLES>"), 1)
    pat = r"^(\?[a-zA-Z]\w*)\s*=\s*(-?\d+)$"

    def entries(block: Column) -> Column:
        lines = F.transform(once(py_strip(block), py_splitlines), lambda x: py_strip(x))
        body = F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("#")))
        return F.transform(body, lambda x: F.struct(
            F.when(x.rlike(pat), F.regexp_extract(x, pat, 1)).alias("k"),
            F.regexp_extract(x, pat, 2).try_cast(WHOLE).alias("v")))
    # a bad line leaves a null key: the whole parse is null then; so it is without a block, which has null entries
    return once(once(F.try_element_at(blocks, F.lit(-1)), entries), lambda e: F.when(
        e.isNotNull() & F.forall(e, lambda x: x["k"].isNotNull()), _last_wins_map(e, "string", WHOLE)))


# ---- T11 / T12 ----------------------------------------------------------------------
def parse_react(c) -> Column:
    """Split on the last 'Action:'; thought = between the 1st and 2nd
    'Thought:' (trimmed) or the raw text when there is none.  Without
    'Action:' the whole text is the action if it has search[ / click[,
    else the thought.  struct(thought, action, invalid)."""
    c = _c(c)
    has_action = F.contains(c, F.lit("Action:"))
    before = F.regexp_extract(c, r"(?s)^(.*)Action:", 1)
    after = F.substring_index(c, "Action:", -1)
    web = F.contains(c, F.lit("search[")) | F.contains(c, F.lit("click["))
    t_raw = F.when(has_action, before).when(web, F.lit("")).otherwise(c)
    a_raw = F.when(has_action, after).when(web, c).otherwise(F.lit(""))
    tparts = F.split(t_raw, "Thought:", -1)
    thought = F.when(F.size(tparts) == 1, t_raw).otherwise(py_strip(F.element_at(tparts, 2)))
    invalid = ~has_action | (F.size(tparts) == 1)
    return F.struct(thought.alias("thought"), py_strip(a_raw).alias("action"), invalid.alias("invalid"))


def to_react(thought, action) -> Column:
    return F.concat(F.lit("Thought:\n"), _c(thought), F.lit("\n\nAction:\n"), _c(action))


# ---- T13 / T14 / T15 / T16 / T17 -------------------------------------------------------
def single_action(c) -> Column:
    """All 'Action:' lines; more than one -> error; none -> ''; keep
    [A-Za-z0-9, ], squeeze and trim spaces.  struct(action, error)."""
    acts = F.regexp_extract_all(_c(c), F.lit(r"Action:\s*([^\n]*)"), 1)
    first = F.coalesce(F.try_element_at(acts, F.lit(1)), F.lit(""))
    clean = F.trim(F.regexp_replace(F.regexp_replace(first, r"[^A-Za-z0-9, ]+", ""), r" +", " "))
    return F.struct(F.when(F.size(acts) > 1, F.lit(None)).otherwise(clean).alias("action"),
                    (F.size(acts) > 1).alias("error"))


def first_action(c) -> Column:
    """Drop a trailing '</s>'; text between the 1st and 2nd 'Action:', else
    the whole text; trimmed."""
    c = F.regexp_replace(_c(c), r"</s>\z", "")
    parts = F.split(c, "Action:", -1)
    return py_strip(F.when(F.size(parts) > 1, F.element_at(parts, 2)).otherwise(c))


def sql_block(c) -> Column:
    """After the last ```sql fence, up to the next fence, trimmed."""
    after = F.substring_index(_c(c), "```sql", -1)
    return py_strip(F.substring_index(after, "```", 1))


def has_fenced_action(c) -> Column:
    return _c(c).rlike(r"(?s)```(.*?)```")


def fenced_action(c) -> Column:
    return F.try_element_at(F.regexp_extract_all(_c(c), F.lit(r"(?s)```(.*?)```"), 1), F.lit(1))


def code_block_body(c) -> Column:
    """Strip; drop an opening fence line and a closing fence line (each only
    when the text has more than one line)."""
    t = F.regexp_replace(py_strip(c), r"^```[^\n]*\n", "")
    return F.regexp_replace(t, r"\n[^\n]*```\z", "")


def code_comments(c) -> Column:
    """All '#...' (to end of line) stripped, empty ones become a newline,
    joined by a space."""
    cs = F.regexp_extract_all(_c(c), F.lit(r"(?d)#.*"), 0)
    cs = F.transform(cs, lambda x: F.when(py_strip(x) == "", F.lit("\n")).otherwise(py_strip(x)))
    return F.array_join(cs, " ")


# ---- T23 ---------------------------------------------------------------------------
#: Where a line may end: before a blank; after the hyphen of a hyphenated
#: word; before and after a run of hyphens between words.
_LETTER, _WORD_MARK = r"[^\d\W]", r"[\w!\"'&.,?]"
_LINE_END = (rf"(?:(?= )|(?<={_LETTER}{{2}}-)(?={_LETTER}-?{_LETTER})|(?<={_LETTER}-{_LETTER}-)(?={_LETTER}-?{_LETTER})"
             rf"|(?<={_WORD_MARK})(?=-{{2,}}\w)|(?<={_WORD_MARK}-{{2,80}})(?=\w))")


def shorten(c, width: int = SHORTEN_WIDTH) -> Column:
    """Collapse whitespace; if longer than ``width`` keep the longest prefix
    that ends where a line may and leaves room for the ellipsis.  null/empty
    -> ''."""
    t = F.regexp_replace(py_strip(F.coalesce(_c(c), F.lit(""))), f"{PY_WS}+", " ")
    head = F.regexp_extract(t, f"(?U)^(.{{0,{width - 1}}}){_LINE_END}", 1)
    return F.when(F.length(t) <= width, t).otherwise(F.concat(head, F.lit(ELLIPSIS)))


# ---- T24 / T25 / T27 -------------------------------------------------------------------
def report_cell(acc, n, starred) -> Column:
    """``{100*acc:.2f}/{n}``, wrapped in '*' for the env winner.  Ties round
    half to even as Python's formatter does (Java's rounds half up)."""
    cell = F.format_string("%.2f/%d", F.bround(_c(acc) * 100, 2), _c(n))
    return F.when(starred, F.concat(F.lit("*"), cell, F.lit("*"))).otherwise(cell)


def shard_key(window, uploader, upload_ns) -> Column:
    return F.format_string("%09d-%s-%d", _c(window), _c(uploader), _c(upload_ns))


def result_line(pct, uid, model, env, got_response, score, latency) -> Column:
    """Fixed-width progress line of one finished evaluation."""
    sep = " \u2502 "
    return F.format_string(f"[RESULT] %3.0f%% | U%3d{sep}%-50s{sep}%-20s{sep}%s{sep}%6.4f{sep}%6.3fs",
                           _c(pct), _c(uid), F.coalesce(F.substring(_c(model), 1, 50), F.lit("")),
                           _c(env), F.when(got_response, F.lit("RECV")).otherwise(F.lit("NULL")),
                           _c(score), _c(latency))
