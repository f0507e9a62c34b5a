"""Chat formatting by event-sourced reconstruction.

A log has one row an event: conv_id, message (its order in the conversation),
seq, kind, role, text.  The kinds are ``start`` (a message begins, with its
role), ``delta`` (text is appended), ``edit`` (the text is replaced),
``regenerate`` (the text so far is discarded) and ``delete``.  An event touches
one message only, so the log is dealt by conversation and message and sorted by
sequence, and a task folds it as a stream with one message in memory; a
conversation that holds a third of all rows is spread over all tasks.

Messages are then rendered in the order of their conversation to one formatted
text with the spans of it that are under the loss mask.  A text of more than
``CHUNK`` characters goes on in further rows, so a conversation that holds a third
of all rows is a stream for its task, too.  Control strings in texts and roles are
escaped with a backslash that reading takes away again, so a text never opens or
ends a turn: reading searches the formatted text for the marks of its turns, and
cuts what was learnt from by the spans; it uses nothing else.

Defined results: a very long message is in memory as a whole, once; a null text is empty, a null role has no name; a null conv_id is
a conversation of its own; a null message number comes first; messages with the
same number are ordered by role and text.  Events of one message with the same
seq are ordered by kind and text.  A message without a start event has no role.
An empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tune

#: Fixed values of the template: begin of conversation, then each role's opening and closing.
BEGIN = "<s>"
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE] ", "[/ROLE]", "</s>")
_CONTROL = re.compile(r"([<\[])(/?(?:s>|INST\]|SYS\]|ROLE\]))")
DELTA = 400
#: Characters of a formatted text in one row.
CHUNK = 1 << 20


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parts(role: str, text: str) -> tuple[str, str, str]:
    """What opens a turn, its escaped text, and what closes it."""
    if role in TURNS:
        a, z = TURNS[role]
        return a, escaped(text), z
    return OTHER[0] + escaped(role) + OTHER[1], escaped(text), OTHER[2]


class Reader:
    """The turns of a formatted text that comes in chunks."""

    def __init__(self):
        self.rest, self.begun, self.seen = "", False, 0

    def feed(self, chunk: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn that the chunk completes."""
        self.rest += chunk
        at = 0
        if not self.begun:
            if len(self.rest) < len(BEGIN):
                return
            if not self.rest.startswith(BEGIN):
                raise ValueError(f"no conversation: {self.rest[:40]!r}")
            self.begun, at = True, len(BEGIN)
        marks = [(None, OTHER[0], OTHER[2]), *((role, *ends) for role, ends in TURNS.items())]
        while at < len(self.rest):
            found = next((m for m in marks if self.rest.startswith(m[1], at)), None)
            if found is None:
                if any(m[1].startswith(self.rest[at : at + len(m[1])]) for m in marks):
                    break  # the opening goes on in the next chunk
                raise ValueError(f"no turn: {self.rest[at : at + 40]!r}")
            role, a, z = found
            end = self.rest.find(z, max(at + len(a), self.seen))
            if end < 0:
                self.seen = max(at + len(a), len(self.rest) - len(z) + 1)
                break
            body = self.rest[at + len(a) : end]
            if role is None:
                role, _, body = body.partition(OTHER[1])
                role = unescaped(role)
            yield role, unescaped(body)
            at, self.seen = end + len(z), 0
        self.rest, self.seen = self.rest[at:], max(0, self.seen - at)

    def end(self) -> None:
        if self.rest or not self.begun:
            raise ValueError("the conversation ends inside a turn")


def log_of(conversations: DataFrame) -> DataFrame:
    """An event log that finished conversations (conv_id, turn, role, text) may come from.

    Each row is a message of a start and streamed deltas.  A hash of its key
    decides what came before: for a quarter of the messages each, a draft that was
    discarded (regenerate), or one that an edit replaced; an eighth stand beside
    a message that was deleted.  Events come last first, as a log is in no order.
    """
    w = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("copy", F.row_number().over(w))
    rows = rows.withColumn("fate", F.pmod(F.xxhash64("conv_id", "turn", "copy"), F.lit(8)))
    rows = rows.withColumn("gone", F.explode(F.when(F.col("fate") == 4, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    n = F.ceil(F.length("text") / DELTA).cast("int")
    again, edit = F.col("fate") < 2, F.col("fate").isin(2, 3)
    # The draft's deltas, then what ends it; an edit brings the first part of the text.
    rows = rows.withColumn("draft", F.when(again | edit, 1 + F.pmod(F.xxhash64("turn", "conv_id"), F.lit(3))).otherwise(0).cast("int"))
    rows = rows.withColumn("first", F.when(again, F.col("draft") + 2).when(edit, F.col("draft") + 1).otherwise(1)).withColumn("end", F.when(edit, F.greatest(n, F.lit(1))).otherwise(n) + F.col("first"))
    seq = F.col("seq")
    rows = rows.withColumn("seq", F.explode(F.reverse(F.sequence(F.lit(0), F.col("end") - F.when(F.col("gone"), 0).otherwise(1)))))
    kind = F.when(seq == 0, "start").when(seq == F.col("end"), "delete").when(edit & (seq == F.col("draft") + 1), "edit").when(again & (seq == F.col("draft") + 1), "regenerate").otherwise("delta")
    part = F.expr(f"substring(text, (seq - first) * {DELTA} + 1, {DELTA})")
    wrong = F.concat(F.lit("draft "), seq.cast("string"), F.reverse(F.substring("text", 1, DELTA)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("gone"), -F.col("copy")).otherwise(F.col("copy")).alias("copy"), seq.cast("long").alias("seq"), kind.alias("kind"), F.when(seq == 0, F.col("role")).alias("role"),
        F.when((seq > 0) & (seq <= F.col("draft")), wrong).when((seq >= F.col("first")) & (seq < F.col("end")), part).alias("text"),
    )


MESSAGE = "conv_id long, turn long, copy int, role string, text string"


def folded(log: DataFrame) -> DataFrame:
    """The final messages of a log: conv_id, turn, copy, role, text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, role, parts, alive = None, None, [], False
        kinds, names = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()], ["conv_id", "turn", "copy", "role", "text"]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)
        for b in batches:
            out = []
            for conv, turn, copy, kind, who, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "copy", "kind", "role", "text"))):
                if key != (conv, turn, copy):
                    if alive:
                        out.append((*key, role, "".join(parts)))
                    key, role, parts, alive = (conv, turn, copy), None, [], True
                if kind == "start":
                    role, parts = who or "", []
                elif kind == "delta":
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
                elif kind == "delete":
                    alive = False
            yield pack(out)
        if alive:
            yield pack([(*key, role, "".join(parts))])

    tune(log.sparkSession)
    keys = ["conv_id", "turn", "copy"]
    return log.repartition(*keys).sortWithinPartitions(*keys, "seq", "kind", "text").select(*keys, "kind", "role", "text").mapInArrow(run, MESSAGE)


class _Writer:
    """Rows (conv_id, chunk, text, loss) of one conversation after another."""

    def __init__(self, size: int):
        self.size, self.rows = size, []
        self.conv, self.no, self.text, self.n, self.loss = None, -1, [], 0, []

    def open(self, conv: int | None) -> None:
        self.close()
        self.conv, self.no = conv, 0
        self._add(BEGIN, False)

    def turn(self, role: str, text: str) -> None:
        a, body, z = parts(role, text)
        self._add(a, False)
        self._add(body, role == "assistant")
        self._add(z, False)

    def _add(self, text: str, learnt: bool) -> None:
        while text:
            room = self.size - self.n
            if len(text) > room:  # cut anywhere but behind the backslash of an escape
                room -= (len(text[:room]) - len(text[:room].rstrip("\\"))) % 2
            now, text = text[:room], text[room:]
            if learnt and now:
                self.loss.append({"start": self.n, "stop": self.n + len(now)})
            self.text.append(now)
            self.n += len(now)
            if text:
                self._end_row()

    def _end_row(self) -> None:
        self.rows.append((self.conv, self.no, "".join(self.text), self.loss))
        self.no, self.text, self.n, self.loss = self.no + 1, [], 0, []

    def close(self) -> None:
        if self.no >= 0 and (self.n or self.no == 0):
            self._end_row()

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["conv_id", "chunk", "text", "loss"])


def formatted(messages: DataFrame, chunk: int | None = None) -> DataFrame:
    """conv_id, chunk, text, loss: each conversation's formatted text, as a rule in one row (chunk 0), and the spans of it to learn from.

    A text of more than ``chunk`` characters goes on in the next rows; spans count from the start of their row.
    """
    size = chunk or CHUNK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(size)
        for b in batches:
            for conv, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
                if out.no < 0 or conv != out.conv:
                    out.open(conv)
                out.turn(role or "", text or "")
                if len(out.rows) > 1000 or len(out.rows) * size > 8 << 20:
                    yield out.batch()
            yield out.batch()
        out.close()
        yield out.batch()

    rows = messages.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy").select("conv_id", "role", "text")
    return rows.mapInArrow(run, "conv_id long, chunk long, text string, loss array<struct<start:long,stop:long>>")


def digests(texts: DataFrame) -> DataFrame:
    """Read formatted conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The digests run along a conversation, so its text passes through one task in order, a chunk at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)
        conv, reader = None, None

        def done() -> tuple:
            reader.end()
            return conv, turns, all_.hexdigest(), learnt, loss.hexdigest(), chars

        for b in batches:
            out = []
            for c, no, text, spans in zip(*(b.column(n).to_pylist() for n in ("conv_id", "chunk", "text", "loss"))):
                if no == 0:
                    if reader:
                        out.append(done())
                    conv, reader, turns, all_, learnt, loss, chars = c, Reader(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                for role, said in reader.feed(text):
                    turns += 1
                    all_.update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescaped(text[s["start"] : s["stop"]])
                    learnt += len(said)
                    loss.update(said.encode())
                chars += len(text)
            yield pack(out)
        if reader:
            yield pack([done()])

    tune(texts.sparkSession)
    rows = texts.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def round_trip(conversations: DataFrame) -> DataFrame:
    """Log, fold, format and write conversations, then read them back into digests."""
    return digests(stored(formatted(folded(log_of(conversations))), "chat"))


#: The digests of a table ``c`` (conv_id, turn, role, text) in DuckDB's SQL.
SQL = r"""
, t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
x AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:s>|INST\]|SYS\]|ROLE\]))', '\1\\\2', 'g') AS shown, regexp_replace(replace(role, '\', '\\'), '([<\[])(/?(?:s>|INST\]|SYS\]|ROLE\]))', '\1\\\2', 'g') AS named FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(shown) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 13 ELSE 18 + length(named) END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id"""
