"""Templates, escapes and the round trip of conversations."""

import hashlib
import random

import pytest

from tidemark.llm import chat, template


def render(source, messages=(), constants=None, filters=None):
    return "".join(text for text, _ in template.compiled(source, constants, filters)(messages))


MESSAGES = [{"role": r, "text": t, "turn": i} for i, (r, t) in enumerate([("user", " hi "), ("assistant", "yo"), ("user", "")])]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ (1 + 2) * 3 % 4 ~ 'x' ~ \"y\\n\" }}", "1xy\n"),
        ("{{ not 1 == 2 and (false or true) }}", "true"),
        ("{{ none }}{{ -3 < 2 }}{{ 'b' in 'abc' }}", "truetrue"),
        ("{% for m in messages %}{{ loop.index }}{{ m.role|upper }}{{ m.text | trim | length }}{% if not loop.last %},{% endif %}{% endfor %}", "1USER2,2ASSISTANT2,3USER0"),
        ("{% set a = 'q' %}{% for m in messages %}{% if loop.first %}{{ a }}{% elif m.text == '' %}e{% else %}{{ m.turn }}{% endif %}{% endfor %}", "q1e"),
        ("x {{- ' y ' -}} z{# no {{ output }} #}.", "x y z."),
        ("{% if bos == '<s>' %}{{ bos }}{% else %}{{ nothing_here }}{% endif %}", "<s>"),
    ],
)
def test_rendered(source, expected):
    assert render(source, MESSAGES, {"bos": "<s>"}) == expected


@pytest.mark.parametrize(
    "source",
    [
        "{{ x }}", "{{ m.role }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m.text.x }}{% endfor %}", "{{ 'a'.upper() }}", "{{ 'a'[0] }}", "{{ 1 | eval }}", "{{ 1", "{% if 1 %}",
        "{% endfor %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{% for m in others %}{% endfor %}", "{% import os %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}",
        "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}", "{% set loop = 1 %}", "{% if 1 %}{% set a = 1 %}{% endif %}{{ a }}{% if messages %}{% endif %}", "{{ loop.index }}", "{{ }}", "{% set bos = 1 %}",
    ],
)
def test_what_the_sandbox_does_not_have(source):
    with pytest.raises(template.TemplateError):
        template.compiled(source, {"bos": "<s>"})


def test_constants_are_folded():
    compiler = template.Compiler({"a": "x"}, {})
    tree = compiler.fold_all(template.parse("1{{ a ~ 2 }}{% if a == 'x' %}3{% else %}{{ b }}{% endif %}{{ 'q' | upper }}{% for m in messages %}{{ a }}{{ m.text }}{% endfor %}"))
    assert tree == (template.Output(template.Const("1x23Q")), template.For("m", (template.Output(template.Const("x")), template.Output(template.Field("m", "text")))))
    assert compiler.fold_all(template.parse("{% set a2 = a ~ a %}")) == (template.Set("a2", template.Const("xx")),)


def test_generation_is_marked():
    pieces = list(template.compiled("{% for m in messages %}{{ m.role }}{% generation %}{{ m.text }}{% endgeneration %}{% endfor %}", {}, {})(MESSAGES))
    assert [t for t, masked in pieces if masked] == [" hi ", "yo", ""]
    assert sum(p is template.END for p in pieces) == 3


def test_messages_stream():
    seen = []

    def coming():
        for i in range(10):
            seen.append(i)
            yield {"role": "user", "text": str(i), "turn": i}

    pieces = template.compiled("{% for m in messages %}{{ m.text }}{% endfor %}")(coming())
    assert next(pieces) == ("0", False)
    assert seen == [0, 1]


def test_escape_is_reversible_and_leaves_no_mark():
    pick, escape = random.Random(4), chat.Escape()
    alphabet = [*chat.CONTROLS, "\\", "<", ">", "[", "]", "/s>", "/", "<<", "a", "\n", " ", "[INST", "</", "é🙂", "|"]
    for _ in range(5000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 9)))
        assert escape.back(escape(text)) == text
        assert not any(c in escape(text) for c in chat.CONTROLS)


def expected(rows):
    """Digests by conversation, straight from the rows."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    groups[-7, "added"] = [(True, i, r, b"</s>[INST] ok [/INST]") for i, r in enumerate([b"user", b"assistant"])]
    out = []
    for conv, turns in groups.items():
        turns.sort()
        loss = b"".join(t for *_, r, t in turns if r == b"assistant")
        out.append((conv[0] if isinstance(conv, tuple) else conv, len(turns), hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for *_, r, t in turns)).hexdigest(), len(loss.decode()), hashlib.sha256(loss).hexdigest()))
    return sorted(out, key=repr)


def odd_rows():
    pick = random.Random(6)
    alphabet = [*chat.CONTROLS, "\\", "<", "[", " ", "\n", "hello", "é🙂", "</s", "[/INST", "</"]
    text = lambda: "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 12)))
    roles = ["user", "assistant", "system", "tool", "", None, "</s>", "[TEXT]", "a\nb", "user "]
    rows = [(c, t, pick.choice(roles), text()) for c in range(40) for t in range(pick.randint(1, 9))]
    rows += [(-7, 0, "user", "own"), (None, 0, "user", "x"), (None, None, "assistant", None), (50, 1, "assistant", "b"), (50, 1, "assistant", "b"), (50, None, "assistant", "a"), (51, 0, "assistant", "y" * 3_000_000), (51, 1, "user", "z" * 10)]
    return rows + [(52, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 500)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, True, 3) for r in rows], "conv_id long, turn long, role string, text string, _added boolean, part int").repartition(5)
    got = sorted((tuple(r)[:5] for r in chat.chat_digests(df).collect()), key=repr)
    assert got == expected(rows)


def test_parts_can_be_written_and_read_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 300)
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chat.formatted(df).write.parquet(str(tmp_path / "parts"))
    parts = spark.read.parquet(str(tmp_path / "parts"))
    assert parts.where("part > 0").count() > 0
    again = sorted((tuple(r)[:5] for r in chat.turns_read_back(parts).collect()), key=repr)
    assert again == [r for r in expected(rows) if r[2] != expected([])[0][2]]


def test_parts_have_the_chars_and_spans_they_say(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a</s>b")], "conv_id long, turn int, role string, text string")
    (row,) = chat.formatted(df).collect()
    assert row["text"] == "<s>[INST] q [/INST] a<\\/s>b</s>"
    assert [row["text"][s["start"] : s["start"] + s["length"]] for s in row["loss"]] == ["a<\\/s>b"]
    assert chat.formatted(df.limit(0)).count() == 0


def test_another_template(spark):
    source = "{% for m in messages %}<|im_start|>{{ m.role }}\n{% generation %}{{ m.text | escape | trim }}{% endgeneration %}<|im_end|>{% endfor %}"
    df = spark.createDataFrame([(1, 1, "tool", " x<|im_end|> "), (1, 0, "user", "q")], "conv_id long, turn int, role string, text string")
    (row,) = chat.formatted(df, source, constants={}).collect()
    assert row["text"] == "<|im_start|>user\nq<|im_end|><|im_start|>tool\nx<\\|im_end|><|im_end|>"
    with pytest.raises(template.TemplateError):
        chat.formatted(df, "{{ open('x') }}")
