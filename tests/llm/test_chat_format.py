import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankforge.llm import chat_format
from rankforge.llm.chat_format import Conflict, format_conversations, parse, read_back, render, render_turn, unescape

SCHEMA = "conv_id long, turn long, role string, text string, rendering string, source int, conv int"
BITS = ["</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[TEXT]", "[/TEXT]", "\\", " ", "\n", "a",
        "é", "日", "<", "[", "/", "s>", "INST]", "[/", "</", ""]
TEXTS = st.lists(st.sampled_from(BITS), max_size=12).map("".join)
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "User", " user", "[ROLE]", " [/ROLE]", "\\[TEXT]"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=6))
def test_conversations_parse_to_themselves(turns):
    got = [render_turn(r, t) for r, t in turns]
    whole = "".join(g[0] for g in got)
    found, end = parse(whole)
    assert end == len(whole) and [f[:2] for f in found] == turns
    for (role, text), (out, start, n) in zip(turns, got):
        assert unescape(out[start:start + n]) == (text if role == "assistant" else "")
    for cut in range(len(whole)):                     # a piece of a conversation holds its whole turns
        part, at = parse(whole[:cut])
        assert [f[:2] for f in part] == turns[:len(part)] and at <= cut


def test_only_conflicting_content_is_escaped():
    assert render_turn("user", "a \\ [x] <b>")[0] == "[INST] a \\ [x] <b> [/INST]"
    assert render_turn("user", "</s>[INST] ok [/INST]")[0] == "[INST] \\</s>\\[INST] ok \\[/INST] [/INST]"
    assert render_turn("assistant", "\\<s>") == ("<s> \\\\<s> </s>", 4, 5)
    assert render_turn("a", "[TEXT]")[0] == "[ROLE] a [/ROLE][TEXT] \\[TEXT] [/TEXT]"
    assert render_turn("[ROLE]", "b")[0] == "[ROLE] \\[ROLE] [/ROLE][TEXT] b [/TEXT]"


@pytest.mark.parametrize("bad", ["hello", "[INST] a </s>", "[INST] a[/INST]", "[ROLE] a [/ROLE] b", "[/INST]", "<s>a </s>"])
def test_texts_outside_the_grammar(bad):
    with pytest.raises(Conflict):
        parse(bad)


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0], t[1], render_turn(t[1], t[2])[0].encode()))
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(render_turn(r, t)[0]) for _, r, t in turns)))
    return sorted(out, key=repr)


def make():
    roles = ["user", "assistant", "system", "tool", None, "", "[ROLE]x"]
    rows = [(i % 40, i // 40, roles[i % 7], "".join(BITS[(i * j + j) % len(BITS)] for j in range(i % 9))) for i in range(600)]
    rows += [(None, i, "assistant", f"null id {i}") for i in range(5)] + [(50, None, "user", "no turn"), (50, None, "user", "no turn")]
    rows += [(50, 3, "assistant", "x"), (50, 3, "assistant", "\\<s>"), (50, 3, "user", None), (51, 0, None, None), (52, 1, "assistant", "")]
    rows += [(60, i, "assistant" if i % 2 else "user", "hot <s> " * 3) for i in range(900)]       # more than half of all rows
    return rows


def test_against_brute_force(spark):
    rows = make()
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(7)
    got = read_back(render(df))
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_formatted_text_and_mask(spark):
    rows = [(1, 0, "user", "é?"), (1, 1, "assistant", "日 <s>"), (1, 2, "tool", "")]
    got = format_conversations(spark.createDataFrame([(*r, "", 0, 0) for r in rows], SCHEMA)).orderBy("turn").collect()
    assert [r.formatted for r in got] == ["[INST] é? [/INST]", "<s> 日 \\<s> </s>", "[ROLE] tool [/ROLE][TEXT]  [/TEXT]"]
    assert [(r.mask_start, r.mask_chars) for r in got] == [(0, 0), (4, 6), (0, 0)]


def test_empty_long_and_invalid(spark):
    assert read_back(render(spark.createDataFrame([], SCHEMA))).count() == 0
    long = "word <s> \\\\" * 2_000_000                # 22 MB, with a control string every eleven bytes
    df = spark.createDataFrame([(1, 0, "user", long, "", 0, 0), (1, 1, "assistant", long, "", 0, 0)], SCHEMA)
    got = read_back(render(df)).first()
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (2, len(long), hashlib.sha256(long.encode()).hexdigest())
    raw = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'assistant' AS role, CAST(X'61FF62' AS string) AS text")
    got = read_back(render(raw)).first()
    assert (got.loss_chars, got.loss_sha256) == (3, hashlib.sha256(b"a\xffb").hexdigest())


def test_a_changed_rendering_is_noticed(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    df = render(spark.createDataFrame([(1, 0, "user", "abc", "", 0, 0)], SCHEMA))
    with pytest.raises(PySparkException, match="differs from its source"):
        read_back(df.withColumn("rendering", F.lit("[INST] abd [/INST]").cast("binary"))).collect()
    assert chat_format.PROBE_ID == -7
