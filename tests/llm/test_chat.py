import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import chat
from ledgerline.llm.template import Const, For, Output, Template, TemplateError, parse

SAID = st.lists(st.sampled_from(["\\", "#", "##", "###", "### User: ", "</turn>", "</turn>\n", "</role>", "Role <", "x", "é", "\n", ": "]), max_size=12).map("".join)
TURNS = "conv_id long, turn long, role string, text string"


def render(source, **values):
    return Template(source, values).render(**values)


def test_language():
    assert render("{{ a.b ~ '-' ~ a['b'] }}{# gone #}", a={"b": 3})[0] == "3-3"
    assert render("{% for x in l %}{{ loop.index }}{{ x }}{% if not loop.last %}, {% endif %}{% endfor %}", l=iter("ab"))[0] == "1a, 2b"
    assert render("a {%- if n > 1 and not n == 3 -%} b {%- elif n == 3 %}c{% else %}d{% endif %}", n=2)[0] == "ab"
    assert [render("{% if n == 1 %}a{% elif n == 2 %}b{% else %}c{% endif %}", n=n)[0] for n in (1, 2, 3)] == ["a", "b", "c"]
    assert render("{{ (1 + 2) * 3 - -1 }}{{ 7 % 4 }}{{ none }}{{ true }}{{ '\\n\\'' | length }}{{ x | default('y') | upper }}", x=None)[0] == "103true2Y"
    assert render("{{ 'a' in x }}{{ 'u' in m }}", x="cat", m={"u": 1})[0] == "truetrue"
    assert render("{% for t in l %}<{% generation %}{{ t }}{% endgeneration %}{% endfor %}", l=["ab", "", "c"]) == ("<ab<<c", [(1, 3), (5, 6)])
    assert render("{% generation %}a{{ x }}{% endgeneration %}{% generation %}c{% endgeneration %}", x="b") == ("abc", [(0, 3)])


def test_constants_fold():
    assert Template("a{{ 1 + 2 }}{% if 2 > 1 %}b{% else %}{{ x }}{% endif %}{{ 'c' | upper }}", ["x"]).tree == (Output(Const("a3bC")),)
    assert Template("{% if false and x %}a{% endif %}{% for i in x %}{{ '' }}{% endfor %}", ["x"]).tree == ()
    assert isinstance(parse("{% for i in x %}a{% endfor %}", ["x"])[0], For)


@pytest.mark.parametrize("source", [
    "{{ y }}", "{{ x.__class__() }}", "{{ x() }}", "{{ x | open }}", "{{ x | default }}", "{{ 1 + }}", "{{ (1 }}", "{{ 'a }}", "{% for x %}{% endfor %}",
    "{% if x %}", "{% endif %}", "{% import os %}", "{{ 1 % 0 }}", "{{ 'a' * 9 }}", "{{ " + "(" * 60 + "1" + ")" * 60 + " }}", "{% if x %}" * 60 + "{% endif %}" * 60, "{% for loop in x %}{% endfor %}"])
def test_refused_templates(source):
    with pytest.raises(TemplateError):
        Template(source, ["x"])


def test_values_are_sandboxed():
    for source in ("{{ x.__class__ }}", "{{ x }}", "{% for a in x %}b{% endfor %}", "{{ x < 1 }}"):
        with pytest.raises(TemplateError):
            render(source, x=object())
    with pytest.raises(TemplateError):
        Template("{{ x }}", ["x"]).render(y=1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "User", ""]) | SAID, SAID), max_size=5), st.integers(1, 40))
def test_whatever_is_said_reads_back(turns, cut):
    text, loss = chat.template().render(turns=[{"role": r, "text": t} for r, t in turns])
    reader = chat.Reader()
    parts = [text[i:i + cut] for i in range(0, len(text), cut)]
    assert [t for p in parts for t in reader.feed(p)] == turns and reader.rest == ""
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant" and t]


def test_parts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 10)
    pieces = [("aaaaaa", False), ("bbbbbb", True), ("cccccc", True), ("d", False), ("e", True)]
    assert list(chat._parts(pieces)) == [(0, "aaaaaabbbbbbcccccc", [(6, 18)]), (1, "de", [(1, 2)])]


def digests(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lost = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(lost), sha(lost), len(chat.template().render(turns=[{"role": r, "text": t} for r, t in turns])[0])


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, None, None, "x"), (2, 0, "tool", ""), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "tie"),
            (None, 5, "assistant", "no id"), (None, 4, "user", "</turn>"), (4, 0, "assistant", "\\### " * 300_000), (4, 1, "assistant", "é" * 1_200_000), (4, 2, "user", "end")]
    odd = spark.createDataFrame([(*r, "k", 1, [2]) for r in rows], TURNS + ", key string, part int, loss array<int>")
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    made = chat.formatted(odd)
    assert made.where("conv_id = 4").count() > 1
    for got in (chat.read_back(made, together=True), chat.read_back(made.orderBy("part"))):
        assert {r[0]: tuple(r[1:]) for r in got.collect()} == {c: digests(t) for c, t in want.items()}


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(spark.createDataFrame([], TURNS))).count() == 0
