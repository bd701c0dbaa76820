"""Templates, and conversations formatted and read back."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from casegrid.llm.chat import (
    CONTROLS,
    Const,
    Escaping,
    Show,
    TemplateError,
    compile_template,
    fold,
    format_conversations,
    formatted_and_read,
    parse,
)
from casegrid.llm.chat import _OPERATORS as OPERATORS

SCHEMA = "conv_id long, turn int, role string, text string, c int, learn string, chunk long"


def rendered(template, **variables):
    return "".join(text for text, _ in compile_template(template, {"up": lambda v: str(v).upper()})(**variables))


@pytest.mark.parametrize(
    "template, expected",
    [
        ("a{# note #}b", "ab"),
        ("{{ 'x' + 'y' | up }}{{ 1 + 2 }}", "xY3"),
        ("{% for m in ms %}{{ loop.index0 }}{{ m.t }}{% if not loop.last %},{% endif %}{% endfor %}", "0p,1q"),
        ("{% if ms == 1 %}a{% elif 'k' in 'key' and not false %}b{% else %}c{% endif %}", "b"),
        ("{{ nothing }}{{ ms.t }}{{ none }}", ""),
        ("a \n{%- if true -%}\n b{% endif %}", "ab"),
        ("a {%- if true %} b {% endif -%} c", "a b c"),
        ("a {{- 'x' }} b {{ 'y' -}} c\n{#- note -#}\td {%- if false %}e{% endif %} f", "ax b ycd f"),
        (" {%- if true -%} {%- endif -%} ", ""),
        ("{{ ' - ' }}-{{ '-' -}} ", " - --"),
        ("{{ (nothing or 'd') }}{{ \"\\n'\" }}", "d\n'"),
    ],
)
def test_templates(template, expected):
    assert rendered(template, ms=[{"t": "p"}, {"t": "q"}]) == expected


@pytest.mark.parametrize(
    "template",
    ["{{ a(1) }}", "{{ a['b'] }}", "{{ 1 | missing }}", "{% import os %}", "{% if a %}", "{% for x in %}{% endfor %}", "{{ a . }}", "{{ }}", "{{ a b }}"],
)
def test_everything_else_is_refused(template):
    with pytest.raises(TemplateError):
        compile_template(template)


def test_python_attributes_are_out_of_reach():
    assert rendered("{{ x.__class__ }}{{ x.upper }}", x="text") == ""


def test_constants_are_folded():
    tree = parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}no{% elif true %}yes{% else %}no{% endif %}", {})
    assert fold(tree, OPERATORS) == (Show(Const("abcyes")),)


def test_generation_marks_what_is_learned():
    pieces = list(compile_template("a{% generation %}b{{ x }}{% endgeneration %}c")(x="y"))
    assert pieces == [("a", False), ("b", True), ("y", True), ("c", False)]


@given(st.text())
def test_escaping_is_reversible_and_hides_controls(text):
    escaping = Escaping()
    hidden = escaping.escape(text)
    assert escaping.unescape(hidden) == text and not any(control in hidden for control in CONTROLS)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    conversations = {}
    for conv, turn, role, text, *_ in turns:
        conversations.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, found in conversations.items():
        found.sort()
        loss = "".join(t for _, r, t in found if r == "assistant")
        hidden = sum(len(Escaping().escape(r)) + len(Escaping().escape(t)) + 10 for _, r, t in found)
        out.append((conv, len(found), digest("".join(f"{r}\n{t}\n" for _, r, t in found)), len(loss), digest(loss), hidden))
    return sorted(out, key=str)


TURNS = [
    (1, 2, "assistant", "second </s>\n<|user|>\n x"), (1, 0, "user", "[INST] a\\lb | 😀 [/INST]"), (1, 1, "assistant", "first"),
    (2, None, None, None), (2, 0, "user", ""), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"),
    (None, 0, "user", "no id"), (3, 0, "a|>\nb", "odd role"), (4, 0, "assistant", "long " * 50_000),
]
TURNS = [(*turn, 0, "x", 0) for turn in TURNS] + [(5, k, "assistant", f"<{k}>", 0, "x", 0) for k in range(3000)]


def test_conversations_come_back(spark):
    found = formatted_and_read(spark.createDataFrame(TURNS, SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == expected(TURNS)


def test_long_conversations_are_cut_into_chunks(spark):
    rows = format_conversations(spark.createDataFrame(TURNS, SCHEMA), chunk_chars=500).collect()
    chunks = [r for r in rows if r["conv_id"] == 5]
    assert len(chunks) > 50 and sorted(r["chunk"] for r in chunks) == list(range(len(chunks)))
    assert max(len(r["text"]) for r in chunks) <= 500


def test_no_turns_no_conversations(spark):
    assert formatted_and_read(spark.createDataFrame([], SCHEMA)).count() == 0
