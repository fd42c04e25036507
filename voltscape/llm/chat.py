"""Chat formatting: every assistant turn becomes an example. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Strings the template uses, or that other templates give a meaning; texts may not hold them bare.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: An opening, any backslashes, the rest. Escaping adds a backslash, unescaping takes one away;
#: whatever backslashes a text has itself, both meet the same places.
_ESCAPE = r"(<<|<|\[)(\\*)(/?(?:s>|INST\]|SYS>>))"
_UNESCAPE = r"(<<|<|\[)\\(\\*)(/?(?:s>|INST\]|SYS>>))"


def escaped(text: str) -> str:
    return f"regexp_replace({text}, r'{_ESCAPE}', r'$1\\\\$2$3')"


def unescaped(text: str) -> str:
    return f"regexp_replace({text}, r'{_UNESCAPE}', '$1$2$3')"


def _role(role: str) -> str:
    """A role as it stands in the template: one line, control strings escaped."""
    line = f"replace(replace(coalesce({role}, ''), '\\\\', '\\\\\\\\'), '\\n', '\\\\n')"
    return escaped(line)


def _role_back(role: str) -> str:
    # two backslashes become one; a backslash and n become a new line
    parts = f"split({unescaped(role)}, r'\\\\\\\\', -1)"
    return f"array_join(transform({parts}, p -> replace(p, '\\\\n', '\\n')), '\\\\')"


def turns_of(formatted: str) -> str:
    """Array of (role, text) read back from formatted turns."""
    bodies = f"filter(split({formatted}, '</s>', -1), p -> p <> '')"
    role, text = "substring_index(substring(p, 4), '\\n', 1)", "substring(p, locate('\\n', p) + 1)"
    return f"transform({bodies}, p -> struct({_role_back(role)} as role, {unescaped(text)} as text))"


def examples(turns: DataFrame, reply_role: str = "assistant") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_length): the training examples of every
    conversation in `turns` (conv_id, turn, role, text, any more).

    Prefix-target expansion: each turn of `reply_role` gives one example, with all turns before
    it as context, and only that reply is trainable: loss_start (code points from 0) and
    loss_length mark it, as escaped text, in `formatted`. Examples count from 1. Turns behind the
    last reply, or a conversation without one, give a last example of the whole conversation with
    nothing to train (loss_length 0), so that all can be read back.

    A turn is `<s>role`, a new line, the text and `</s>`. Control strings inside roles and texts
    get a backslash after their opening, which unescaped() takes away. Turns go by turn, role and
    text, NULL first. A NULL text or role is empty; a NULL conv_id is a conversation; repeated
    rows are turns of their own; an empty table gives an empty result; other columns are ignored.
    A conversation is put together in one task, as its examples are prefixes of it.
    """
    placed = turns.selectExpr(
        "conv_id",
        "turn",
        "coalesce(role, '') as role",
        "coalesce(text, '') as text",
        f"concat('<s>', {_role('role')}, '\\n') as _open",
        f"{escaped("coalesce(text, '')")} as _body",
        f"coalesce(role = '{reply_role}', false) as _reply",
    )
    # each turn ends where the turns up to it end
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    ended = placed.withColumn("_end", F.sum(F.expr("cast(length(_open) + length(_body) + 4 as bigint)")).over(order))
    whole = ended.groupBy("conv_id").agg(
        F.expr("array_sort(collect_list(struct(turn, role, text, _end, _open, _body, _reply))) as t")
    )
    replies = "transform(filter(t, x -> x._reply), x -> struct(x._end as stop, cast(length(x._body) as bigint) as size))"
    rest = "transform(filter(slice(t, -1, 1), x -> not x._reply), x -> struct(x._end as stop, 0L as size))"
    each = whole.selectExpr(
        "conv_id",
        "array_join(transform(t, x -> concat(x._open, x._body, '</s>')), '') as full",
        f"posexplode(concat({replies}, {rest})) as (i, e)",
    )
    return each.selectExpr(
        "conv_id",
        "i + 1 as example",
        "substring(full, 1, cast(e.stop as int)) as formatted",
        "e.stop - 4 - e.size as loss_start",
        "e.size as loss_length",
    )


def digests(found: DataFrame) -> DataFrame:
    """What the examples hold, read back from them: per conversation its turns (from the last
    example, the longest), its trained text (one reply per example) and the formatted size of
    all examples."""
    back = found.selectExpr(
        "conv_id",
        "example",
        "formatted",
        "cast(length(formatted) as bigint) as size",
        f"{unescaped('substring(formatted, cast(loss_start + 1 as int), cast(loss_length as int))')} as reply",
    )
    per = back.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"),
        F.expr("array_join(transform(array_sort(collect_list(struct(example, reply))), x -> x.reply), '') as loss"),
        F.sum("size").alias("formatted_chars"),
    )
    read = per.selectExpr("conv_id", "loss", "formatted_chars", f"{turns_of('last')} as t")
    return read.selectExpr(
        "conv_id",
        "cast(size(t) as bigint) as n_turns",
        "sha2(array_join(transform(t, x -> concat(x.role, '\\n', x.text, '\\n')), ''), 256) as turns_sha256",
        "cast(length(loss) as bigint) as loss_chars",
        "sha2(loss, 256) as loss_sha256",
        "formatted_chars",
    )
