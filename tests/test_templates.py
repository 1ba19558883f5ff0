import random

import pytest
from pyspark.sql import functions as F

from verdigris.functions import rendering, templates

CHATML = (
    "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
)
HEADERS = """{{- bos_token }}
{%- for message in messages %}
    {{- '<|start_header_id|>' + message.role + '<|end_header_id|>\\n\\n' + message.content + '<|eot_id|>' }}
{%- endfor %}
{%- if add_generation_prompt %}
    {{- '<|start_header_id|>assistant<|end_header_id|>\\n\\n' }}
{%- endif %}
"""
INSTRUCT = """{{ bos_token }}
{% if messages[0]['role'] == "system" %}
S:{{ messages[0]['content'] | trim | upper }};
{% endif %}
{% for message in messages %}
  {% if message['role'] == 'user' and not loop.last %}
[INST] {{ message['content'] | trim }} [/INST]
  {% elif message.role == 'user' %}
[LAST]{{ message.content + '!' }}
  {% elif message['role'] != 'system' or (loop.first and false) %}
 {{ message['content'] | lower }}{{ eos_token }}
  {% else %}
-
  {% endif %}
{% endfor %}
end"""
SCHEMA = "messages array<struct<role: string, content: string>>"


def headers(turns, reply):
    parts = [f"<|start_header_id|>{role or ''}<|end_header_id|>\n\n{content or ''}<|eot_id|>" for role, content in turns]
    return "<s>" + "".join(parts) + ("<|start_header_id|>assistant<|end_header_id|>\n\n" if reply else "")


def chatml(turns, reply):
    return "".join(f"<|im_start|>{role or ''}\n{content or ''}<|im_end|>\n" for role, content in turns) + ("<|im_start|>assistant\n" if reply else "")


def instruct(turns, reply):
    """What the third template says, written out by hand."""
    out = "<s>\n"
    if turns and turns[0][0] == "system":
        out += f"S:{(turns[0][1] or '').strip().upper()};\n"
    for n, (role, content) in enumerate(turns):
        content = content or ""
        if role == "user" and n < len(turns) - 1:
            out += f"[INST] {content.strip()} [/INST]\n"
        elif role == "user":
            out += f"[LAST]{content}!\n"
        elif role != "system":
            out += f" {content.lower()}</s>\n"
        else:
            out += "-\n"
    return out + "end"


@pytest.mark.parametrize("source, by_hand", [(CHATML, chatml), (HEADERS, headers), (INSTRUCT, instruct)])
@pytest.mark.parametrize("reply", [False, True])
def test_templates_as_written_out_by_hand(spark, source, by_hand, reply):
    pick = random.Random(1)
    texts = ["", " a ", "SELECT 'x' {{ y }} {% if %}", "é\n", None, "|\\n|"]
    rows = [[(pick.choice(["system", "user", "assistant", None, "tool"]), pick.choice(texts)) for _ in range(pick.randint(0, 5))] for _ in range(150)]
    frame = spark.createDataFrame([(row,) for row in rows] + [(None,)], SCHEMA)
    template = templates.TextTemplate(source, "<s>", "</s>")
    found = [row.text for row in frame.select(template.render(F.col("messages"), reply).alias("text")).collect()]
    assert found == [by_hand(row, reply) for row in rows] + [None]


def test_declared_templates_as_text(spark):
    frame = spark.createDataFrame([([("system", "s"), ("user", None), (None, "x")],)], SCHEMA)
    for reply in (False, True):
        pairs = [(rendering.CHATML, templates.TextTemplate(CHATML)), (rendering.HEADERS, templates.TextTemplate(HEADERS, "<|begin_of_text|>"))]
        for declared, given in pairs:
            both = frame.select(declared.render(F.col("messages"), reply), given.render(F.col("messages"), reply)).first()
            assert both[0] == both[1]


@pytest.mark.parametrize(
    "source",
    [
        "{% set x = 1 %}", "{{ x }}", "{{ message['content'] }}", "{% for m in messages %}{% endfor %}", "{% for message in messages %}", "{% if true %}", "{% endif %}",
        "{% if bos_token %}{% endif %}", "{{ 'a' | replace('a', 'b') }}", "{{ 'a' ~ 'b' }}", "{{ 'a' + }}", "{{ messages[0]['name'] }}", "{{ messages[-1]['role'] }}",
        "{% for message in messages %}{% for message in messages %}{% endfor %}{% endfor %}", "{% if loop.first %}{% endif %}", "{{ 'a\\q' }}", "{{ raise_exception('x') }}",
        "{% if 'a' == 'b' %}{% else %}{% else %}{% endif %}", "{% for message in messages %}{% endfor %}{% for message in messages %}{% endfor %}", "{{ 'open }}",
    ],
)
def test_what_is_not_declared_fails_when_compiled(spark, source):
    with pytest.raises(ValueError, match="chat template"):
        templates.TextTemplate(source).render(F.col("messages"))
