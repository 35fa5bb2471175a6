"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: ``open`` (a message with its role), ``delta`` (more
text), ``edit`` (new whole text) and ``regenerate`` (the message starts over). Events are
cut into range parts by (conversation, sequence); counting the openings up to each event
numbers the messages. Each message is folded by itself and rendered with a template, and
messages are joined into parts of about ``PART`` characters. So a conversation with very
many rows spreads over many tasks; only its digest reads its parts one after the other.
No pass holds more than one message or one part.

The template marks each turn with its role. Control strings inside texts are broken by a
backslash after their first character and backslashes are doubled, so no control string
of the template survives inside a text and unescaping restores it exactly.

Defined results: a null text or role is empty; rows of a conversation sort by turn (null
first), then role, then text, and repeated rows are turns of their own; a null conv_id is a
conversation of its own; events before the first ``open`` of a conversation are ignored; an
empty table gives an empty result; further columns are ignored.
"""

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rookery.operators.ordered import positions, range_parts, running_total
from rookery.plans.scratch import Scratch

# Control strings of the template and of its common relatives.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, AFTER_ROLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>\n"
LEARNED = "assistant"
PIECE, PART = 512, 1 << 20

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.S)

FORMATTED = "conv_id long, part long, n_turns int, formatted string, mask array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def escaped(text: Column) -> Column:
    """``escape`` as a column expression; no control string overlaps another."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log that ends in the given turns: (conv_id, place, seq, kind, payload).

    Texts arrive in deltas. An assistant's message first streams a draft that is
    regenerated; another role's message is posted once and then edited.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    scratch = Scratch(turns.sparkSession, "turns")
    rows = positions(rows, ["conv_id", "turn", "role", "text"], scratch, "placed", per=["conv_id"], name="place")

    def event(kind: str, payload):
        return F.struct(F.lit(kind).alias("kind"), payload.alias("payload"))

    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(F.length("text") / PIECE).cast("int")),
        lambda i: event("delta", F.substring(F.col("text"), i * PIECE + 1, F.lit(PIECE))),
    )
    draft = F.array(event("delta", F.substring("text", 1, 40)), event("regenerate", F.lit("")))
    start = F.array(event("open", F.col("role")))
    learned = F.col("role") == LEARNED
    log = F.when(learned, F.concat(start, draft, pieces)).otherwise(
        F.concat(start, F.array(event("delta", F.lit("…"))), F.array(event("edit", F.lit(""))), pieces)
    )
    events = rows.select("conv_id", "place", F.posexplode(log).alias("seq", "e"))
    return events.select("conv_id", "place", "seq", "e.kind", "e.payload")


ORDER = ("place", "seq")


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted events to messages; the message in progress is carried over batches."""
    key, role, text, done = None, None, [], []
    names = ["conv_id", "n", "role", "text"]

    for batch in batches:
        ids, missing = batch["conv_id"], batch["conv_id"].isna()
        for c, gap, n, kind, payload in zip(ids, missing, batch["n"], batch["kind"], batch["payload"], strict=True):
            this = (None if gap else int(c), int(n))
            if this != key:
                if key is not None:
                    done.append((*key, role, "".join(text)))
                key, text = this, []
            if kind == "open":
                role = payload
            elif kind == "delta":
                text.append(payload)
            elif kind == "edit":
                text = [payload]
            elif kind == "regenerate":
                text = []
        if done:
            yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
            done.clear()
    if key is not None:
        yield pd.DataFrame([(*key, role, "".join(text))], columns=names).astype({"conv_id": "Int64"})


def reconstruct(events: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(conv_id, n, role, text): final messages, numbered from 0 in each conversation."""
    scratch = Scratch(events.sparkSession, "events")
    wanted = events.select("conv_id", *order, "kind", F.coalesce("payload", F.lit("")).alias("payload"))
    whole = ["conv_id", *order]
    parts = range_parts(wanted, whole, scratch, "parts")
    opened = running_total(parts, whole, F.when(F.col("kind") == "open", 1).otherwise(0), "opened", per=["conv_id"])
    numbered = opened.where("opened > 0").withColumn("n", F.col("opened") - 1)
    dealt = numbered.repartition("conv_id", "n").sortWithinPartitions("conv_id", "n", *order)
    return dealt.select("conv_id", "n", "kind", "payload").mapInPandas(_fold, "conv_id long, n long, role string, text string")


def _gathered(rows: Iterator[tuple], schema: str, size: Callable[[tuple], int]) -> Iterator[pd.DataFrame]:
    """Rows as frames of about ``PART`` characters or a thousand rows, not a frame a row."""
    names = [field.split()[0] for field in schema.split(", ")]
    some, held = [], 0

    def frame():
        return pd.DataFrame(some, columns=names).astype({"conv_id": "Int64"})

    for row in rows:
        some.append(row)
        held += size(row)
        if held >= PART or len(some) >= 1000:
            yield frame()
            some, held = [], 0
    if some:
        yield frame()


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Sorted rendered turns to the rows of their parts."""
    key, turns, out, size, mask = None, 0, [], 0, []
    for batch in batches:
        missing = batch["conv_id"].isna()
        columns = (batch[c] for c in ("part", "head", "body", "learned"))
        for c, gap, part, head, body, learned in zip(batch["conv_id"], missing, *columns, strict=True):
            this = (None if gap else int(c), int(part))
            if this != key:
                if key is not None:
                    yield *key, turns, "".join(out), mask
                key, turns, out, size, mask = this, 0, [], 0, []
            if learned and body:
                mask.append({"start": size + len(head), "end": size + len(head) + len(body)})
            out += (head, body, CLOSE)
            size += len(head) + len(body) + len(CLOSE)
            turns += 1
    if key is not None:
        yield *key, turns, "".join(out), mask


def _join_turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _gathered(_parts(batches), FORMATTED, lambda row: len(row[3]))


def render(messages: DataFrame) -> DataFrame:
    """Formatted parts of conversations in ascending order, with the spans that a loss covers.

    ``mask`` spans count code points of ``formatted``, end exclusive. A part takes the turns
    that begin in its ``PART`` characters of the conversation, all of them whole.
    """
    scratch = Scratch(messages.sparkSession, "messages")
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(AFTER_ROLE))
    turns = messages.select(
        "conv_id", "n", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == LEARNED).alias("learned")
    )
    parts = range_parts(scratch.save(turns, "turns"), ["conv_id", "n"], scratch, "parts")
    size = F.length("head") + F.length("body") + len(CLOSE)
    placed = running_total(parts, ["conv_id", "n"], size, "end", per=["conv_id"])
    placed = placed.withColumn("part", F.floor((F.col("end") - size) / PART).cast("long"))
    dealt = placed.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "n")
    return dealt.select("conv_id", "part", "head", "body", "learned").mapInPandas(_join_turns, FORMATTED)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


PARSED = "conv_id long, part long, n_turns long, turns string, loss string, chars long"


def _turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn; a control string of the template never stands inside one."""
    at = 0
    while at < len(text):
        role_end = text.find(AFTER_ROLE, at)
        end = text.find(CLOSE, role_end)
        if not text.startswith(OPEN, at) or role_end < 0 or end < 0:
            raise ValueError("a formatted part does not parse")
        yield unescape(text[at + len(OPEN) : role_end]), unescape(text[role_end + len(AFTER_ROLE) : end])
        at = end + len(CLOSE)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, mask in zip(batch["formatted"], batch["mask"], strict=True):
            turns = [f"{role}\n{said}\n" for role, said in _turns_of(text)]
            loss = "".join(unescape(text[span["start"] : span["end"]]) for span in mask)
            rows.append((len(turns), "".join(turns), loss, len(text)))
        out = pd.DataFrame(rows, columns=["n_turns", "turns", "loss", "chars"])
        out.insert(0, "part", batch["part"].to_numpy())
        out.insert(0, "conv_id", batch["conv_id"].astype("Int64").to_numpy())
        yield out


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """One row for each conversation, from its parsed parts in order."""
    conv, known, turns, loss, count, learned, chars = None, False, None, None, 0, 0, 0
    for batch in batches:
        missing = batch["conv_id"].isna()
        columns = (batch[c] for c in ("n_turns", "turns", "loss", "chars"))
        for c, gap, n, said, kept, size in zip(batch["conv_id"], missing, *columns, strict=True):
            c = None if gap else int(c)
            if not known or c != conv:
                if known:
                    yield conv, count, turns.hexdigest(), learned, loss.hexdigest(), chars
                known, conv, count, learned, chars = True, c, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            turns.update(said.encode())
            loss.update(kept.encode())
            count, learned, chars = count + int(n), learned + len(kept), chars + int(size)
    if known:
        yield conv, count, turns.hexdigest(), learned, loss.hexdigest(), chars


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _gathered(_digests(batches), DIGESTS, lambda row: 0)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the parts again: counts and digests of each conversation."""
    parsed = formatted.select("conv_id", "part", "formatted", "mask").mapInPandas(_parse, PARSED)
    dealt = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.select("conv_id", "n_turns", "turns", "loss", "chars").mapInPandas(_digest, DIGESTS)
