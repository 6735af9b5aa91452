"""Chat formatting from an event log.

Events of a conversation are applied in the order of their sequence numbers:

* ``message``     starts message ``target`` with ``role`` and ``text``;
* ``delta``       appends ``text`` to message ``target`` (streamed output);
* ``edit``        replaces the text of message ``target``;
* ``regenerate``  replaces message ``target`` and discards the messages after it that
  were last set before.

``fold`` does this with grouping and windows: a message's text is that of its last
setting event and the deltas after it. ``render`` marks every turn as
``### role: text</turn>`` and a line end; a backslash is put before every backslash, ``#``
and ``<`` of a role or text, so control strings inside them cannot be taken for marks
and ``parse`` restores them. The loss mask is the text of assistant turns.

No step gathers a conversation: turns stay rows, and ``digest`` reads them back as a
sorted stream, hashing as it goes. A digest of one conversation is sequential, so its
turns pass through one task, which holds one turn at a time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

_SEGMENT = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def message_events(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Finished turns as events: one ``message`` each, numbered by turn (ties by role and
    text, nulls first; repeated rows are turns of their own)."""
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(),
                                             F.col(text).asc_nulls_first())
    n = F.row_number().over(order).cast("long")
    return rows.select(F.col(conv).alias("conv"), n.alias("seq"), F.lit("message").alias("kind"), n.alias("target"),
                       F.col(role).alias("role"), F.col(text).alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """(conv, target, role, text): the final messages. Columns of ``events``: conv, seq, kind,
    target, role, text. Null texts and roles are empty; events on a message that was never
    set only append; unknown kinds and null targets are ignored; a null conv is one
    conversation; of events with equal numbers the one that sorts last by kind and text
    sets, and deltas with the number of the setting event come before it."""
    e = events.filter(F.col("target").isNotNull() & F.col("kind").isin("message", "delta", "edit", "regenerate"))
    e = e.select("conv", "target", F.coalesce("seq", F.lit(-1)).cast("long").alias("seq"), "kind",
                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sets = F.col("kind") != "delta"
    last = F.max(F.when(sets, F.struct("seq", "kind", "text"))).alias("last")
    # text of the deltas after the last setting event, by number
    deltas = F.collect_list(F.when(~sets, F.struct("seq", "text"))).alias("deltas")
    named = F.max(F.when(F.length("role") > 0, F.struct("seq", "role"))).alias("named")
    again = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again")
    m = e.groupBy("conv", "target").agg(last, deltas, named, again)
    since = F.coalesce(F.col("last.seq"), F.lit(-(1 << 62)))
    tail = F.transform(F.array_sort(F.filter("deltas", lambda d: d["seq"] > since)), lambda d: d["text"])
    before = Window.partitionBy("conv").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    m = m.select("conv", "target", F.coalesce("named.role", F.lit("")).alias("role"), since.alias("since"), "again",
                 F.concat(F.coalesce("last.text", F.lit("")), F.concat_ws("", tail)).alias("text"))
    m = m.withColumn("cut", F.max("again").over(before))
    return m.filter(F.col("cut").isNull() | (F.col("since") > F.col("cut"))).select("conv", "target", "role", "text")


def escape(c):
    return F.regexp_replace(c, r"([\\#<:])", r"\\$1")


def render(messages: DataFrame, assistant: str = "assistant") -> DataFrame:
    """(conv, target, segment, loss_start, loss_end): a turn's formatted text and the code
    points of it under the loss mask (start = end outside assistant turns)."""
    role, text = escape(F.col("role")), escape_text(F.col("text"))
    start = F.length(role) + 6
    end = F.when(F.col("role") == assistant, start + F.length(text)).otherwise(start)
    return messages.select("conv", "target", F.concat(F.lit("### "), role, F.lit(": "), text, F.lit("</turn>\n")).alias("segment"),
                           start.cast("long").alias("loss_start"), end.cast("long").alias("loss_end"))


def escape_text(c):
    return F.regexp_replace(c, r"([\\#<])", r"\\$1")


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    m = _SEGMENT.fullmatch(segment)
    if not m:
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    return _ESCAPED.sub(r"\1", m[1]), _ESCAPED.sub(r"\1", m[2])


def digest(rendered: DataFrame, conv_name: str = "conv_id") -> DataFrame:
    """Read formatted conversations back: turns, digests and lengths of each."""
    schema = T.StructType([T.StructField(conv_name, rendered.schema["conv"].dataType), T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        now = None      # [conv, turns, hash, loss chars, loss hash, chars]
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            done = []
            for conv, segment, a, b in zip(*(batch.column(n).to_pylist() for n in ("conv", "segment", "loss_start", "loss_end"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                loss = _ESCAPED.sub(r"\1", segment[a:b])
                now[3] += len(loss)
                now[4].update(loss.encode("utf-8", "replace"))
                now[5] += len(segment)
            if done:
                yield rows(done, kind)
        if now is not None:
            yield rows([now], kind)

    def rows(done, kind):
        cols = list(zip(*[(c, n, h.hexdigest(), k, g.hexdigest(), f) for c, n, h, k, g, f in done]))
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)

    return (rendered.select("conv", "target", "segment", "loss_start", "loss_end").repartition("conv")
            .sortWithinPartitions("conv", "target").mapInArrow(run, schema))
