"""Conversations as training text with a loss mask, and back: a grammar round trip.

    conversation = "<s>" turn* "</s>"
    turn         = "[INST] " text " [/INST]" | "[SYS] " text " [/SYS]" | "[OUT] " text " [/OUT]"
                 | "[ROLE] " role " [TEXT] " text " [/TEXT]"

for the roles user, system, assistant and any other. These eleven strings are control strings. A backslash before one
(or before the backslashes in front of one) makes it plain, so n backslashes and a control string in a text are
written with n + 1. The grammar is read left to right with one control string of look-ahead, so a text has one parse at most.

A turn is written plainly first, parsed again and compared with its source; control strings that the parser met inside of
it are escaped, and again, until the recovered turn is the source. Turns are written one by one and streamed in order, so
neither a conversation nor its text is ever held as a whole: a conversation of any length is a run of rows.

Null texts and roles are empty. Turns go by `turn` (nulls first), then role and text; repeated rows are turns of their own. Rows whose conv_id is
null are one conversation, with a null conv_id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import prepare

BEGIN, END = "<s>", "</s>"
#: Opening and closing control strings of the roles that have their own.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[OUT]", "[/OUT]")}
#: Of any other role: before the role, between role and text, after the text.
OTHER = ("[ROLE]", "[TEXT]", "[/TEXT]")
LEARNT = "assistant"

CONTROL = r"</?s>|\[/?(?:INST|SYS|OUT|TEXT)\]|\[ROLE\]"
_SEEN = re.compile(rf"(\\*)({CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*(?:{CONTROL}))")
_CLOSE = {a: (role, b) for role, (a, b) in MARKS.items()}


class BadFormat(ValueError):
    pass


def escape(text: str) -> str:
    return _SEEN.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str, at: int = 0) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and start and end of the written text, of each turn in a run of whole turns."""
    active = ((m.start(2), m.end(2), m[2]) for m in _SEEN.finditer(text, at) if not m[1])

    def until(start: int, wanted: str) -> tuple[str, int, int]:
        a, z, mark = next(active, (0, 0, ""))
        if mark != wanted or a <= start or text[start] != " " or text[a - 1] != " " or a - 1 < start + 1:
            raise BadFormat(f"{wanted} is missing after {start}")
        return unescape(text[start + 1 : a - 1]), a - 1, z

    while at < len(text):
        a, z, mark = next(active, (0, 0, ""))
        if a != at or not mark:
            raise BadFormat(f"no turn at {at}")
        if mark in _CLOSE:
            role, close = _CLOSE[mark]
        elif mark == OTHER[0]:
            role, _, z = until(z, OTHER[1])
            close = OTHER[2]
        else:
            raise BadFormat(f"{mark} at {at}")
        own, end, at = until(z, close)
        yield role, own, z + 1, end


def written(role: str, text: str) -> tuple[str, int, int]:
    """A turn as text, and start and end of its own text in it; escaped as far as the parser needs it."""
    parts = [role, text]
    while True:
        opening, closing = MARKS.get(role, (f"{OTHER[0]} {parts[0]} {OTHER[1]}", OTHER[2]))
        out = f"{opening} {parts[1]} {closing}"
        try:
            turns = list(parse(out))
        except BadFormat:
            turns = []
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return out, turns[0][2], turns[0][3]
        new = [escape(role), escape(text)]
        if new == parts:
            raise BadFormat(f"no form of {role!r} reads back")
        parts = new


PIECES = "conv_id long, place long, formatted string, start long, stop long, last boolean"


def format_turns(conversations: DataFrame) -> DataFrame:
    """The pieces of each formatted conversation in order, one for each turn; `start` to `stop` of an assistant's is under the loss mask.

    The pieces of a conversation stand side by side in one partition; joined, they are its text. Places count code points within the piece.
    """
    prepare(conversations.sparkSession)
    c = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        held, place = None, 0  # the row before, which is written when it is known to be its conversation's last or not
        names = [x.split()[0] for x in PIECES.split(", ")]

        def piece(row, place, last):
            conv, role, text = row
            out, a, z = written(role, text)
            head = BEGIN if not place else ""
            a, z = (a + len(head), z + len(head)) if role == LEARNT else (None, None)
            return conv, place, head + out + (END if last else ""), a, z, last

        def batch(rows):
            return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names)

        for b in batches:
            rows = []
            for row in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if held is not None:
                    last = held[0] != row[0]
                    rows.append(piece(held, place, last))
                    place = 0 if last else place + 1
                held = row
            if rows:
                yield batch(rows)
        if held is not None:
            yield batch([piece(held, place, True)])

    ordered = c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, PIECES)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says: turns by the grammar, and the text under the loss mask.

    `pieces` must keep the order of format_turns(); hashes grow piece by piece.
    """

    def run(batches):
        turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        for b in batches:
            rows = []
            for conv, place, text, a, z, last in zip(*(b.column(k).to_pylist() for k in ("conv_id", "place", "formatted", "start", "stop", "last")), strict=True):
                if text.startswith(BEGIN) != (place == 0) or last and not text.endswith(END):
                    raise BadFormat(f"conversation {conv} is cut")
                for role, own, _, _ in parse(text[: -len(END)] if last else text, 0 if place else len(BEGIN)):
                    turns.update(f"{role}\n{own}\n".encode("utf-8", "surrogatepass"))
                    counts[0] += 1
                if a is not None:
                    learnt = unescape(text[a:z])
                    loss.update(learnt.encode("utf-8", "surrogatepass"))
                    counts[1] += len(learnt)
                counts[2] += len(text)
                if last:
                    rows.append((conv, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                    turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            if rows:
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in DIGESTS.split(", ")])

    return pieces.mapInArrow(run, DIGESTS)


#: A conversation of control strings only, which every run formats besides.
PROBE = "</s>[INST] ok [/INST]"


def op11_chat_formatting(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(conversations.unionByName(probe)))


_MARKED = CONTROL.replace("'", "''")
ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
s AS (SELECT *, role IN ('user', 'system', 'assistant') AS known,
        len(regexp_extract_all(text, '{_MARKED}')) AS in_text, len(regexp_extract_all(role, '{_MARKED}')) AS in_role FROM c),
l AS (SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 13 ELSE 23 + length(role) + in_role END + length(text) + in_text AS chars FROM s)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + 7)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id"""
