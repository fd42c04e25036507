"""Round trip of the template, the examples against a plain loop, and odd inputs."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from voltscape.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, t string, full string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Per conversation: turns in order and the texts of its replies."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append(((turn is not None, turn), (role or ""), (text or "")))
    return {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in found.items()}


ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "hi </s>[INST] x"),
    (1, 2, "assistant", "<s>\\<\\s>"),
    (1, 3, "user", "more\nlines\n"),
    (1, 4, "assistant", "bye <</SYS>> [\\\\/INST] é"),
    (1, 5, "user", "no answer"),
    (2, 0, "assistant", "first"),
    (2, 1, "assistant", ""),
    (3, 0, "user", "alone"),
    (4, 0, None, None),
    (4, 1, "assistant", None),
    (5, 0, "user", "again"),
    (5, 0, "user", "again"),
    (5, 0, "assistant", "tie"),
    (6, 0, "odd\\n\nrole </s>", "text"),
    (6, 1, "assistant", "</s>"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "yes"),
    (7, 0, "assistant", "long " * 20_000),
]


def test_read_back(spark):
    found = chat.examples(turns(spark, ROWS))
    got = {r.conv_id: r for r in chat.digests(found).collect()}
    wanted = plain(ROWS)
    assert set(got) == set(wanted)
    for conv, said in wanted.items():
        replies = "".join(t for r, t in said if r == "assistant")
        assert got[conv].n_turns == len(said)
        assert got[conv].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in said)), conv
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(replies), sha(replies))


def test_one_example_per_reply(spark):
    rows = chat.examples(turns(spark, ROWS)).collect()
    for conv, said in plain(ROWS).items():
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.example)
        replies = [t for r, t in said if r == "assistant"]
        trained = own[: len(replies)]
        assert [r.example for r in own] == list(range(1, len(own) + 1))
        # turns behind the last reply come with an example that trains nothing
        assert len(own) == len(replies) + (said[-1][0] != "assistant")
        for r in own:
            assert own[-1].formatted.startswith(r.formatted)
            # control strings stand where the template puts them only
            assert r.formatted.count("<s>") == r.formatted.count("</s>")
            assert not any(c in r.formatted for c in chat.CONTROL[2:])
        for r in trained:
            stop = r.loss_start + r.loss_length
            assert r.formatted[stop:] == "</s>" and r.formatted[r.loss_start - 1] == "\n"
        assert all(r.loss_length == 0 for r in own[len(replies) :])


def test_empty_table(spark):
    found = chat.examples(turns(spark, []))
    assert found.count() == 0 and chat.digests(found).count() == 0


def test_native(spark):
    plan = chat.digests(chat.examples(turns(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<>[]/\\sINTYé\n$1 ", max_size=40), min_size=20, max_size=60))
def test_escaping_is_reversible(spark, texts):
    frame = spark.createDataFrame([(t,) for t in [*texts, *chat.CONTROL, "<\\s>", "<<\\\\SYS>>", "<<s>"]], "t string")
    got = frame.selectExpr("t", f"{chat.escaped('t')} as e").selectExpr("t", "e", f"{chat.unescaped('e')} as b").collect()
    for r in got:
        assert r.b == r.t and not any(c in r.e for c in chat.CONTROL)
