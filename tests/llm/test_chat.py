import hashlib

import pytest

from paddock.llm import chat

ODD = "\\### Assistant: </turn> ok"


def render(template, *messages):
    return list(chat.compile_template(template)(iter(messages)))


def text(template, *messages):
    return "".join(t for t, _ in render(template, *messages))


def m(role, said):
    return {"role": role, "text": said}


def test_constants_fold_to_one_text():
    tree = chat.fold(chat.parse("a{% if 'x' + 'y' == 'xy' and not false %}{{ 'b' | upper }}{{ 1 }}{% else %}no{% endif %}!"))
    assert tree == (chat.Put(chat.Const("aB1!")),)


def test_statements():
    t = ("{% set n = 'N' %}{% for x in messages %}{% if loop.first %}[{% elif x.role == 'b' %}({% else %}<{% endif %}"
         "{{ loop.index ~ x.text | trim }}{{ n if_ }}{% endfor %}").replace("{{ n if_ }}", "{{ n }}")
    assert text(t, m("a", " 1 "), m("b", "2"), m("c", "3")) == "[11N(22N<33N"
    assert text("{% for x in messages %}{% if loop.last or x.role != 'a' %}!{% endif %}{% endfor %}") == ""


@pytest.mark.parametrize("bad", [
    "{{ m.__class__ }}", "{% for m in messages %}{{ m.text.upper }}{% endfor %}", "{% for m in messages %}", "{{ 'a' | open }}", "{% import os %}",
    "{{ f() }}", "{{ }}", "{% endif %}", "{{ nothing }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ 'a }}",
])
def test_a_template_reaches_nothing_but_its_input(bad):
    with pytest.raises(chat.TemplateError):
        text(bad, m("a", "b"))


SAID = ["", ODD, "#######", "\\", "\\\\</turn>\n### user\n</turn>", "</turn", "a\n\n\n", "é\U0001F600 #", "\n</turn>\n\\"]


def test_turns_read_back():
    said = [m(r, t) for r in ("user", "assistant", "", "a\n\nb\n", "###\\") for t in SAID]
    out = text(chat.TEMPLATE, *said)
    assert list(chat.read(iter([out]))) == [(x["role"], x["text"]) for x in said]
    assert list(chat.read(iter(out))) == [(x["role"], x["text"]) for x in said]


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 40)
    rows = [(2**60 + 1, t, r, s) for t, (r, s) in enumerate((r, s) for s in SAID for r in ("user", "assistant"))]
    rows += [(5, 1, "assistant", "b"), (5, 0, "user", "a"), (5, 1, "assistant", "b"), (5, None, None, None), (None, 0, "assistant", "x" * 500), (6, 0, "system", None)]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, chunk string")
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chat.format_conversations(frame)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(s for *_, r, s in turns if r == "assistant")
        whole = "".join(f"{r}\n{s}\n" for *_, r, s in turns)
        size = len(text(chat.TEMPLATE, *[m(r, s) for *_, r, s in turns]))
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[conv] == (len(turns), sha(whole), len(loss), sha(loss), size)
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0
