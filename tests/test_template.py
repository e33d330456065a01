"""Templates as expressions, against text put together by hand."""

import json

import pytest
from pyspark.sql import functions as F

from parley.operators import chat, template
from parley.queries import TEMPLATES

CHATS = [
    [("system", "Be brief."), ("user", " Hi there \n"), ("assistant", "Yes?")],
    [("user", "a"), ("assistant", "b"), ("user", "{{c}} {% x %}")],
    [("assistant", "é\n")],
    [],
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, [{"role": r, "content": c} for r, c in m]) for i, m in enumerate(CHATS)], "i int, messages array<struct<role: string, content: string>>")


def rendered(rows, text, **names):
    return [r[0] for r in rows.orderBy("i").select(template.compiled(text, F.col("messages"), **names)).collect()]


def test_chatml(rows):
    by_hand = ["".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in m) for m in CHATS]
    assert rendered(rows, TEMPLATES["chatml"]) == by_hand == [r[0] for r in rows.orderBy("i").select(chat.rendered(F.col("messages"))).collect()]
    assert rendered(rows, TEMPLATES["chatml"], add_generation_prompt=True) == [t + "<|im_start|>assistant\n" for t in by_hand]


def test_instructions(rows):
    """Another layout: the first system message stands by itself, turns are trimmed, answers end with a token."""
    by_hand = []
    for m in CHATS:
        text = "<s>"
        for i, (r, c) in enumerate(m):
            if r == "system":
                text += f"<<SYS>>\n{c}\n<</SYS>>\n" if i == 0 else ""
            elif r == "user":
                text += f"[INST] {c.strip()} [/INST]"
            else:
                text += f" {c}</s>" + ("" if i == len(m) - 1 else "\n")
        by_hand.append(text)
    assert rendered(rows, TEMPLATES["instructions"], bos_token="<s>", eos_token="</s>") == by_hand


def test_white_space_and_expressions(rows):
    text = "A  {%- if messages[0]['role'] == 'system' -%}  S: {{- messages[0].content | upper }}{% elif messages | length > 2 and not false %}\nmany {{ messages[-1]['role'] }}\n{% else %}\n  few\n  {# note #}\n  {% endif %}\nZ"
    assert rendered(rows, text) == ["AS:BE BRIEF.Z", "Amany user\nZ", "A  few\nZ", "A  few\nZ"]
    loop = "{% for m in messages[1:] %}{{ loop.index }}/{{ loop.length }}{% if 'a' in m['content'] or loop.first %}!{% endif %};{% endfor %}"
    assert rendered(rows, loop) == ["1/2!;2/2;", "1/2!;2/2;", "", ""]


def test_missing_content(spark):
    rows = spark.createDataFrame([(0, [{"role": "user", "content": None}])], "i int, messages array<struct<role: string, content: string>>")
    assert rendered(rows, "{% for m in messages %}{{ m.role }}: {{ m.content }}{% endfor %}") == ["user: None"]


@pytest.mark.parametrize("text", ["{% for m in messages %}x", "{% set x = 1 %}", "{{ eos_token }}", "{{ messages | tojson }}", "{% if messages %}a{% endfor %}"])
def test_what_is_not_supported_says_so(rows, text):
    with pytest.raises((ValueError, KeyError)):
        rendered(rows, text)


def test_templates_of_files(rows, tmp_path):
    (tmp_path / "tokenizer_config.json").write_text(json.dumps({"chat_template": TEMPLATES["instructions"], "bos_token": {"content": "<s>"}, "eos_token": "</s>", "pad_token": None}))
    text, names = template.read_template(f"{tmp_path}/tokenizer_config.json")
    assert names == {"bos_token": "<s>", "eos_token": "</s>"} and rendered(rows, text, **names)[1] == "<s>[INST] a [/INST] b</s>\n[INST] {{c}} {% x %} [/INST]"
    (tmp_path / "t.jinja").write_text("{{ 'x' }}")
    assert template.read_template(f"{tmp_path}/t.jinja") == ("{{ 'x' }}", {})
    (tmp_path / "other.json").write_text("{}")
    with pytest.raises(ValueError):
        template.read_template(f"{tmp_path}/other.json")


def test_no_python_in_the_plan(rows):
    plan = rows.select(template.compiled(TEMPLATES["chatml"], F.col("messages")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
