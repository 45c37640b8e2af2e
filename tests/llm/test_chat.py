import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rainloom.llm import chat
from rainloom.llm.templates import Const, Escaper, For, Template, TemplateError, Text

from .conftest import bag

TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "|", ">", "[", "/", "s>", "INST]", "é", "\n", "a "]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=5))
def test_formatting_is_reversible(turns):
    text, spans = Template(chat.TEMPLATE, chat.CONTROLS).render(messages=[{"role": r, "text": t} for r, t in turns])
    assert chat.read_turns(text) == turns
    assert [Escaper.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_language():
    run = lambda s, **v: Template(s).render(**v)[0]
    assert run("{% for x in xs -%}  {{ loop.index }}:{{ x.a|default('-')|upper }}{{ ', ' if not loop.last }}{%- endfor %}", xs=[{"a": "p"}, {}]) == "1:P, 2:-"
    assert run("{% if a and not b %}1{% elif a or c %}2{% else %}3{% endif %}", a=1, b=1) == "2"
    assert run("{% set y = n * 2 - 1 %}{{ y // 2 ~ '|' ~ y % 2 }}{# gone #}{{ 'b' in 'abc' }}{{ xs[1] }}{{ xs|join('-') }}", n=4, xs=["p", "q"]) == "3|1Trueqp-q"
    text, spans = Template("a{% generation %}b{{ x }}{% endgeneration %}c").render(x="yz")
    assert (text, spans) == ("abyzc", [(1, 4)])


def test_constants_are_folded():
    assert Template("{% if 1 + 1 == 2 %}a{{ 'x'|upper ~ 2 }}{% else %}c{% endif %}b").nodes == (Text("aX2b"),)
    loop = Template("{% for i in [1, 2] %}{{ i }}{{ 3 * 4 }}{% endfor %}").nodes[0]
    assert isinstance(loop, For) and loop.of == Const((1, 2)) and loop.body[1] == Text("12")


@pytest.mark.parametrize("bad", ["{{ x.__class__.__mro__ }}", "{% for c in x %}{% endfor %}", "{{ 9 ** 9 }}", "{{ f(1) }}", "{% import os %}", "{% if x %}", "{{ 'a' + 1 }}", "{{ x|no }}", "{{ 99999999999 * 99999999999 * 9 }}"])
def test_sandbox(bad):
    with pytest.raises(TemplateError):
        Template(bad).render(x=object())


def test_query(spark):
    rows = [(1, 1, "assistant", "yes\n"), (1, 0, "user", "hi"), (1, 2, "assistant", None), (2, 0, None, "x"), (2, 0, "system", "</s>"), (2, None, "user", "first"), (None, 0, "assistant", "é"), (3, 0, "user", ""), (3, 0, "user", "")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, piece string").repartition(4)
    expected = []
    full = rows + [(-1, 0, "user", chat.CONTROL_TEXT), (-1, 1, "assistant", chat.CONTROL_TEXT)]
    for conv in {r[0] for r in full}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in full if r[0] == conv))
        said = "".join(t for _, _, role, t in own if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((conv, len(own), digest("".join(f"{r}\n{t}\n" for _, _, r, t in own)), len(said), digest(said)))
    found = chat.query(turns)
    assert bag(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(expected, key=repr)
    whole = {r.conv_id: r.formatted for r in chat.render_conversations(turns).collect()}
    assert {r.conv_id: r.formatted_chars for r in found.collect() if r.conv_id != -1} == {k: len(v) for k, v in whole.items()}
    assert [r.conv_id for r in chat.query(turns.limit(0)).collect()] == [-1]
    # the table's own conversation -1 stays beside the control conversation
    clash = spark.createDataFrame([(-1, 0, "user", "mine", "", "")], "conv_id long, turn long, role string, text string, piece string, control string")
    both = chat.query(clash).collect()
    assert sorted((r.conv_id, r.n_turns, r.loss_chars) for r in both) == [(-1, 1, 0), (-1, 2, len(chat.CONTROL_TEXT))]
    with pytest.raises(ValueError):
        chat.render_turns(turns, "{% for m in messages %}{{ loop.last }}{% endfor %}")


@pytest.mark.parametrize("size", [1, 40, 10_000])
def test_written_conversations(spark, size, monkeypatch):
    """Chunks in order are the conversation, and what is read back doesn't depend on where they end."""
    monkeypatch.setattr(chat, "CHUNK", size)
    rows = [(c, t, ("user", "assistant", "system")[t % 3], f"say {c} {t} </s>" * (t % 4)) for c in range(9) for t in range(12)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(chat.render_turns(turns.selectExpr("*", "false AS control"), key="control")).collect()
    whole = {r.conv_id: (r.formatted, r.spans) for r in chat.render_conversations(turns).collect()}
    for c in range(9):
        own = sorted((r for r in made if r.conv_id == c), key=lambda r: r.chunk)
        assert [r.chunk for r in own] == list(range(len(own))) and (len(own) > 1) == (size < 1000)
        at, spans = 0, []
        for r in own:
            spans += [at + v for v in r.spans]
            at += len(r.formatted)
        assert ("".join(r.formatted for r in own), spans) == whole[c]
    found = bag(chat.query(turns), "conv_id", "turns_sha256", "loss_sha256", "formatted_chars")
    monkeypatch.setattr(chat, "CHUNK", 1_000_000)
    assert found == bag(chat.query(turns), "conv_id", "turns_sha256", "loss_sha256", "formatted_chars")
