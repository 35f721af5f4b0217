"""Chat formatting from a declarative template, with a state machine over the roles.

A template lists the segments of a turn. Every segment is a literal, the role
or the text, and says for which roles it is trained on. Control strings inside
roles and texts are escaped reversibly, so that the formatted conversation can
be read back without loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """How a turn looks. ``opening role separator text closing`` in this order."""

    opening: str = "### "
    separator: str = ": "
    closing: str = " </turn>\n"
    #: Strings that never occur inside an escaped role or text.
    control: tuple[str, ...] = ("### ", ": ", " </turn>")
    #: Roles whose texts are trained on.
    trained: frozenset[str] = frozenset({"assistant"})
    #: State -> role -> next state. A role without an entry is a fault.
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    #: States in which a conversation may end.
    final: frozenset[str] = frozenset({"asked", "answered"})

    def escaped(self, value: Column) -> Column:
        value = F.replace(value, F.lit(ESCAPE), F.lit(ESCAPE * 2))
        for word in self.control:
            value = F.replace(value, F.lit(word), F.lit(word[0] + ESCAPE + word[1:]))
        return value


TEMPLATE = Template()


def segments(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Every turn as a list of (text, loss) segments; their texts joined are the formatted turn.

    Null roles and texts are empty. A role that the state machine does not know
    is formatted like any other. Extra columns are dropped.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    trained = role.isin(*sorted(template.trained))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.array(
            segment(F.lit(template.opening), no),
            segment(template.escaped(role), no),
            segment(F.lit(template.separator), no),
            segment(template.escaped(text), trained),
            segment(F.lit(template.closing), no),
        ).alias("segments"),
    )


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text) if ESCAPE in text else text


def read_turn(formatted: str, template: Template = TEMPLATE) -> tuple[str, str]:
    """Role and text of one formatted turn, found by the template's marks alone."""
    opening, closing = template.opening, template.closing
    if not (formatted.startswith(opening) and formatted.endswith(closing)):
        raise ValueError(f"not a formatted turn: {formatted[:80]!r}")
    cut = formatted.index(template.separator, len(opening))
    return unescape(formatted[len(opening):cut]), unescape(formatted[cut + len(template.separator):-len(closing)])


SUMMARY = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean, first_fault long")


def summaries(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation, read back from its formatted segments.

    ``valid`` says whether the state machine accepts the roles in turn order,
    ``first_fault`` is the position of the first turn it refuses (null: none).
    Faulty conversations are formatted and counted all the same.

    Turns are ordered by turn, role and text, so ties and repeated rows have one
    order up to equal rows. All rows with a null conv_id are one conversation.
    Texts are formatted where they are read. A digest of a conversation is a
    sequential hash, so its turns pass one task, but as a sorted stream: of a
    conversation of any length only one batch and the hash state are in memory.
    """
    formatted = segments(turns, template)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh(conv):
            return {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0,
                    "loss": hashlib.sha256(), "formatted_chars": 0, "state": "start", "first_fault": None}

        def closed(one):
            valid = one["first_fault"] is None and one["state"] in template.final
            return {"conv_id": one["conv_id"], "n_turns": one["n_turns"], "turns_sha256": one["turns"].hexdigest(),
                    "loss_chars": one["loss_chars"], "loss_sha256": one["loss"].hexdigest(),
                    "formatted_chars": one["formatted_chars"], "valid": valid, "first_fault": one["first_fault"]}

        one = None
        for batch in batches:
            done = []
            for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist()):
                if one is None or one["conv_id"] != conv:
                    if one is not None:
                        done.append(closed(one))
                    one = fresh(conv)
                whole = "".join(p["text"] for p in parts)
                role, text = read_turn(whole, template)
                one["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for part in parts:
                    if part["loss"]:
                        plain = unescape(part["text"])
                        one["loss"].update(plain.encode("utf-8", "surrogatepass"))
                        one["loss_chars"] += len(plain)
                one["formatted_chars"] += len(whole)
                after = template.moves.get(one["state"], {}).get(role)
                if after is None and one["first_fault"] is None:
                    one["first_fault"] = one["n_turns"]
                one["state"] = after or one["state"]
                one["n_turns"] += 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if one is not None:
            yield pa.RecordBatch.from_pylist([closed(one)], schema=arrow)

    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                       ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                       ("valid", pa.bool_()), ("first_fault", pa.int64())])
    return ordered.select("conv_id", "segments").mapInArrow(run, SUMMARY)
