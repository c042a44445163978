"""Chat formatting: a state machine over roles, segments with loss flags, a declarative template.

A template says how a turn is marked, which roles may follow which, which roles carry loss, and which
control strings must never appear unescaped inside a text. ``format_turns`` sorts each conversation
in its partition and streams over it with constant state (the machine's state and the position), so a
conversation that has a third of all rows needs no more memory than a short one. Every turn becomes
one row of segments (text, loss); joined in order they are the training text. ``read_back`` parses
that text again, again as a stream.

Escaping is reversible: a backslash before every backslash and before every control string. A template is
refused if control strings could overlap, or could arise where a text meets the marks around it.

Cases: null texts and roles are empty; a role may hold any characters; rows with a null conversation
are one conversation of their own; equal turns are ordered by role, then text; repeated rows are
repeated turns; a conversation that breaks the turn order is formatted all the same and its first fault
is named; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``opening`` + role + ``after_role`` + text + ``closing``."""

    opening: str = "<|turn|>"
    after_role: str = "\n"
    closing: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state.
    order: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)
    #: Strings that tokenizers and other templates give a meaning to.
    controls: tuple[str, ...] = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")

    def __post_init__(self) -> None:
        if self.opening not in self.controls or self.closing.rstrip("\n") not in self.controls:
            raise ValueError("The marks of a turn must be among the control strings.")
        for one in self.controls:
            if "\\" in one or "\n" in one or not one:
                raise ValueError(f"{one!r} can't be a control string.")
            for cut in range(1, len(one)):
                if any(other.startswith(one[cut:]) for other in self.controls):
                    raise ValueError(f"{one!r} can overlap another control string.")
                if self.closing.startswith(one[cut:]) or (self.opening + self.after_role).endswith(one[:cut]):
                    raise ValueError(f"{one!r} can arise between a text and its marks.")

    def _any(self) -> str:
        return "|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True))

    def escaper(self):
        pattern = re.compile(r"\\|" + self._any())
        return lambda text: pattern.sub(lambda m: "\\" + m[0], text)

    def unescaper(self):
        pattern = re.compile(r"\\(\\|" + self._any() + ")")
        return lambda text: pattern.sub(lambda m: m[1], text)


def escape_role(escape, role: str) -> str:
    """A role has one line: its line breaks become ``\\n``."""
    return escape(role).replace("\n", "\\n")


def unescape_role(unescape, role: str) -> str:
    # An escaped backslash stays a pair until the end, so the n after it is not taken for a line break.
    return "\\".join(unescape(part.replace("\\n", "\n")) for part in role.split("\\\\"))


class Parser:
    """Turns of a formatted text: (role, text, spans of unescaped text) in order."""

    def __init__(self, template: Template):
        self.template, self.unescape = template, template.unescaper()
        self.token = re.compile(r"\\(?:\\|" + template._any() + ")|" + template._any())

    def turns(self, text: str) -> Iterator[tuple[str, str]]:
        t, at = self.template, 0
        while at < len(text):
            if not text.startswith(t.opening, at):
                raise ValueError(f"no turn begins at {at}")
            line = text.index(t.after_role, at)
            body = line + len(t.after_role)
            end = next((m for m in self.token.finditer(text, body) if not m[0].startswith("\\")), None)
            if end is None or not text.startswith(t.closing, end.start()):
                raise ValueError(f"the turn at {at} does not end")
            yield unescape_role(self.unescape, text[at + len(t.opening) : line]), self.unescape(text[body : end.start()])
            at = end.start() + len(t.closing)


_SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
_FORMATTED = "conv_id long, position long, segments array<struct<text: string, loss: boolean>>, state string, fault string"


def format_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, position, segments, state, fault: one row per turn, each conversation's rows together and in order.

    ``state`` is the machine's state after the turn ("broken" from the first fault on).
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = template.escaper()
        here, first, state, position = None, True, "start", 0
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "position", "segments", "state", "fault")}
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if first or conv != here:
                    here, first, state, position = conv, False, "start", 0
                fault, after = None, template.order.get(state, {}).get(role)
                if after is None and state != "broken":
                    fault, after = f"{role or 'no role'} after {state}", "broken"
                state = after or "broken"
                out["conv_id"].append(conv)
                out["position"].append(position)
                out["segments"].append(
                    [
                        {"text": template.opening + escape_role(escape, role) + template.after_role, "loss": False},
                        {"text": escape(text), "loss": role in template.loss_roles},
                        {"text": template.closing, "loss": False},
                    ]
                )
                out["state"].append(state)
                out["fault"].append(fault)
                position += 1
            kinds = (pa.int64(), pa.int64(), pa.list_(_SEGMENT), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _FORMATTED)


_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " valid boolean, fault string"
)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from rows as ``format_turns`` gives them (together and in order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, unescape = Parser(template), template.unescaper()
        names = [c.split()[0] for c in _READ.split(",")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string())
        open_: dict | None = None
        done: list[tuple] = []

        def close(c: dict) -> None:
            valid = c["fault"] is None and c["state"] in template.final
            fault = c["fault"] or (None if valid else f"ends after {c['state']}")
            done.append((c["conv"], c["n"], c["turns"].hexdigest(), c["loss"], c["under"].hexdigest(), c["chars"], valid, fault))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names)
            done.clear()
            return batch

        for batch in batches:
            for conv, segments, state, fault in zip(
                *(batch.column(k).to_pylist() for k in ("conv_id", "segments", "state", "fault")), strict=True
            ):
                if open_ is None or conv != open_["conv"]:
                    if open_ is not None:
                        close(open_)
                    open_ = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": 0, "under": hashlib.sha256(), "chars": 0, "fault": None}
                text = "".join(s["text"] for s in segments)
                open_["chars"] += len(text)
                for role, said in parser.turns(text):
                    open_["n"] += 1
                    open_["turns"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in segments:
                    if s["loss"]:
                        plain = unescape(s["text"])
                        open_["loss"] += len(plain)
                        open_["under"].update(plain.encode("utf-8", "surrogatepass"))
                open_["state"], open_["fault"] = state, open_["fault"] or fault
            if done:
                yield flushed()
        if open_ is not None:
            close(open_)
            yield flushed()

    return formatted.mapInArrow(run, _READ)
