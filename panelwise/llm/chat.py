"""Chat formatting: a finite-state machine over roles, and a declarative template that marks what the loss counts.

Turns are brought together by conversation and sorted by turn; a task then walks through them as a stream and holds one
turn at a time, however long a conversation is. Each turn becomes three segments: what opens it, its text, what closes
it. Joined in order, a conversation's segments are its training text; ``loss`` says which count.

Control strings inside texts are broken by a backslash after their first character, and backslashes are doubled. So no
text can open or close a turn, and :func:`read_back` recovers every turn from the joined text alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelwise.llm.common import bound_batches, col

#: The template: what opens and closes a turn of each role, whether its text counts for the loss, which role may
#: follow which state, and the strings that texts must not contain. ``*`` is any other role; it is named in the opening.
TEMPLATE = {
    "roles": {
        "system": {"open": "<s>[SYS] ", "close": " [/SYS]</s>", "loss": False},
        "user": {"open": "<s>[INST] ", "close": " [/INST]</s>", "loss": False},
        "assistant": {"open": "<s>[ANS] ", "close": " [/ANS]</s>", "loss": True},
        "*": {"open": "<s>[ROLE] {role} [TEXT] ", "close": " [/TEXT]</s>", "loss": False},
    },
    "control": ["<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[/ANS]", "[ROLE]", "[TEXT]", "[/TEXT]"],
    "next": {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
}

SEGMENTS = "segment long, turn long, role string, text string, loss boolean, error string"


def check_template(template: dict) -> None:
    """A control string must be two characters at least and hold no backslash: escaping puts one after its first."""
    if any(len(c) < 2 or "\\" in c for c in template["control"]):
        raise ValueError("control strings need two characters or more, and no backslash")


def escaper(template: dict):
    check_template(template)
    starts = re.compile("(?=" + "|".join(map(re.escape, template["control"])) + ")(.)", re.S)

    def escape(text: str) -> str:
        return starts.sub(r"\1\\", text.replace("\\", "\\\\"))

    return escape


def unescape(text: str) -> str:
    return re.sub(r"\\(.?)", r"\1", text, flags=re.S) if "\\" in text else text


def _walk(template: dict, id_type):
    """Segments of turns that come sorted by conversation and turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, roles, follows = escaper(template), template["roles"], template["next"]
        current, state, segment, turn = object(), "start", 0, 0
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for conv, role, text in zip(ids, batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                if conv != current:
                    current, state, segment, turn = conv, "start", 0, 0
                known = roles.get(role) if role != "*" else None
                shape = known or roles["*"]
                error = None if known and role in follows.get(state, []) else f"{role or 'no role'} after {state}"
                state = role if known else "other"
                opening = shape["open"] if known else shape["open"].replace("{role}", escape(role))
                for part, loss in ((opening, False), (escape(text), shape["loss"]), (shape["close"], False)):
                    for to, value in zip(out, (conv, segment, turn, role, part, loss, error)):
                        to.append(value)
                    segment += 1
                turn += 1
            kinds = (id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["conv_id", "segment", "turn", "role", "text", "loss", "error"])

    return run


def _slices(run, rows: int = 256):
    """``run`` on short batches, so that a task holds few texts at a time."""
    return lambda batches: run(b.slice(i, rows) for b in batches for i in range(0, len(b), rows))


def _sorted_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return (
        conversations.select(col(conv_id).alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def format_conversations(conversations: DataFrame, template: dict = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per segment, sorted inside each conversation: conv_id, segment, turn (its place), role, text, loss, error.

    Turns with the same number are ordered by role, then text (null numbers first); repeated rows are turns of their
    own. Null roles and texts are empty; rows with a null conv_id are one conversation. ``error`` says where a turn does
    not follow the order of roles; such turns are formatted all the same.
    """
    bound_batches(conversations.sparkSession)
    turns = _sorted_turns(conversations, conv_id, turn, role, text)
    kind = turns.schema["conv_id"].dataType
    return turns.mapInArrow(_slices(_walk(template, to_arrow_type(kind))), f"conv_id {kind.simpleString()}, {SEGMENTS}")


def turn_pattern(template: dict) -> re.Pattern:
    """A whole turn, at the beginning of a formatted text."""
    forms = []
    for i, (name, shape) in enumerate(template["roles"].items()):
        opening = re.escape(shape["open"])
        if name == "*":
            opening = opening.replace(re.escape("{role}"), f"(?P<role{i}>.*?)")
        forms.append(f"(?:{opening}(?P<text{i}>.*?){re.escape(shape['close'])})")
    return re.compile("|".join(forms), re.S)


def _read(template: dict, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, names = turn_pattern(template), list(template["roles"])
        current, begun = None, False
        held, turns, digest, counted, loss, chars = "", 0, hashlib.sha256(), 0, hashlib.sha256(), 0

        def total() -> tuple:
            if held:
                raise ValueError(f"conversation {current} does not end with a whole turn")
            return current, turns, digest.hexdigest(), counted, loss.hexdigest(), chars

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            done = []
            for conv, text, counts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss"))):
                if not begun or conv != current:
                    if begun:
                        done.append(total())
                    current, begun = conv, True
                    held, turns, digest, counted, loss, chars = "", 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                held += text
                chars += len(text)
                if counts:
                    plain = unescape(text)
                    counted += len(plain)
                    loss.update(plain.encode())
                while m := pattern.match(held):
                    i = next(i for i in range(len(names)) if m[f"text{i}"] is not None)
                    role = names[i] if names[i] != "*" else unescape(m[f"role{i}"])
                    digest.update(f"{role}\n{unescape(m[f'text{i}'])}\n".encode())
                    turns += 1
                    held = held[m.end() :]
            yield table(done)
        if begun:
            yield table([total()])

    return run


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation, from its segments' joined text and loss flags only: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``segments`` must come straight from :func:`format_conversations`, or be sorted in the same way.
    """
    kind = segments.schema["conv_id"].dataType
    return segments.select("conv_id", "text", "loss").mapInArrow(_slices(_read(template, to_arrow_type(kind)), 1024), f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
