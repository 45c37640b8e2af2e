"""What templates may not use: memory, time and depth beyond what their values allow."""

import time
import tracemalloc

import pytest

from rainloom.llm.templates import Template, TemplateError

DOUBLED = "{% set x = 'ab' %}" + "{% set x = x ~ x %}" * 60 + "{{ x }}"
NESTED = "{% set x = [1] %}" + "{% set x = [x, x] %}" * 60 + "{{ x == y }}"


@pytest.mark.parametrize("bad", [
    "{{ 'a' * 99999999999 }}", "{{ 99999999999 * 'a' }}", "{{ [0] * 9999999999 }}", "{{ '%1999999999d' % 1 }}", "{{ s * n }}", "{{ xs * n }}", "{{ '%1999999999d' % n }}",
    "{% for a in xs %}{% for b in xs %}{% endfor %}{% endfor %}", "{% for a in xs %}{% for b in xs %}{% for c in xs %}{% set y = a %}{% endfor %}{% endfor %}{% endfor %}",
    DOUBLED, NESTED, "{% set x = s * 5000 %}{{ x|replace('', x) }}", "{% set x = s * 5000 %}{{ [x, x, x]|join(x * 1000) }}", "{% for a in xs %}{{ s * 9999 }}{% endfor %}",
    "{{ " + "9" * 6000 + " }}", "{{ " + "(" * 9000 + "1" + ")" * 9000 + " }}", "{% if a %}" * 3000 + "{% endif %}" * 3000, "x" * 40000, "{{ xs }}", "{{ d }}", "{{ xs|string }}", "{{ [1] ~ '' }}",
    "{{ n|join }}", "{{ s|replace(1, 2) }}", "{{ xs|upper }}",
])
def test_templates_are_refused_before_they_cost_anything(bad):
    values = {"n": 9_999_999_999, "s": "text", "xs": list(range(10_000)), "d": {"a": 1}, "y": [1]}
    tracemalloc.start()
    began = time.perf_counter()
    with pytest.raises(TemplateError):
        Template(bad).render(**values)
    took, most = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 4 and most < 100 << 20  # tracing slows Python down some four times


def test_what_stays_allowed():
    run = lambda s, **v: Template(s).render(**v)[0]
    assert run("{{ 'ab' * 3 }}{{ 2 * 'c' }}{{ 7 % 4 }}{{ -n }}{{ n * n }}", n=5) == "abababcc3-525"
    assert run("{{ ([1] + [2, 3])|length }}{{ ([0] * 3)|join('-') }}{{ (xs + [4])|join(',') }}", xs=[1]) == "30-0-01,4"
    text = "word " * 4_000_000
    assert run("{{ m|trim|upper }}{{ m|replace('o', '0') }}{{ m ~ m }}", m=text) == text.strip().upper() + text.replace("o", "0") + text + text
    many = [{"role": "user", "text": "x" * (k % 7)} for k in range(50_000)]
    assert run("{% for m in messages %}<{{ m.role }}>{{ m.text|escape }}{% endfor %}", messages=many).count("<user>") == 50_000
