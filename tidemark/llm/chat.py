"""Chat formatting with loss masks: a conversation is rendered whole, encoded once, and its turns matched to tokens.

The template puts each turn between control strings. Texts may hold such strings themselves: after every "<"
that is followed by backslashes and a "|", or by "|" at once, one more backslash is put in, and taken out again
when the output is read, so no text can end its turn and every text comes back as it was.

The encoder gives each token's code points. Turns and tokens are both sorted, so a turn's tokens are found by two
binary searches; a token that reaches over a turn's edge counts for the part inside.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import AddedToken, Tokenizer

#: Fixed strings of the template.
START, END, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"
BATCH = 1 << 23
ROLE = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
ROLE_BACK = {v[1]: k for k, v in ROLE.items()}
FORMATTED = "conv_id long, n_turns long, text string, ids array<int>, mask array<boolean>, loss_spans array<struct<start: long, end: long>>"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns and the code points of each turn's text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{''.join(ROLE.get(c, c) for c in role)}\n"
        body = escaped(text)
        out += [head, body, END, "\n"]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(END) + 1
    return "".join(out), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    turns = []
    for turn in text.split(START)[1:]:
        head, _, body = turn.removesuffix("\n").removesuffix(END).partition("\n")
        turns.append((re.sub(r"\\(.)", lambda m: ROLE_BACK[m[1]], head), unescaped(body)))
    return turns


def masked(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> tuple[list[bool], list[tuple[int, int]]]:
    """Tokens that hold a part of a span, and the parts held, joined where they touch. Both come sorted."""
    starts, ends = [a for a, _ in offsets], [b for _, b in offsets]
    mask, held = [False] * len(offsets), []
    for a, b in spans:
        first, last = bisect_right(ends, a), bisect_left(starts, b)
        own = len(held)
        for i in range(first, last):
            lo, hi = max(a, starts[i]), min(b, ends[i])
            if lo >= hi:
                continue
            mask[i] = True
            if len(held) > own and held[-1][1] >= lo:
                held[-1] = (held[-1][0], max(held[-1][1], hi))
            else:
                held.append((lo, hi))
    return mask, held


def encoder(content: str) -> Tokenizer:
    """A vocabulary of the tokenizers library with the template's strings as tokens of their own."""
    found = Tokenizer.from_str(content)
    found.add_special_tokens([AddedToken(s, normalized=False, special=True) for s in (START, END)])
    return found


def formatted(conversations: DataFrame, vocabulary: str, learned: str = LEARNED) -> DataFrame:
    """(conv_id, n_turns, text, ids, mask, loss_spans) of every conversation (conv_id, turn, role, text).

    Rows are put in order of turn, rows without turn last, ties by role and text; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without conv_id are one conversation. mask says which tokens the loss
    is taken of; loss_spans are the code points of `learned` texts that tokens cover, one span for each such
    text unless it is empty. Other columns are not looked at. An empty table gives an empty table.

    A conversation is one text that is encoded at once, so it is held by one task, however long it is. The
    vocabulary file is read by the driver and sent to the workers; its size is fixed (under 2 MB).
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = conversations.sparkSession.sparkContext.broadcast(f.read())
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").isNull().alias("last"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    whole = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def rows(out: list[tuple]) -> pa.RecordBatch:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), span)
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "n_turns", "text", "ids", "mask", "loss_spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value).encode
        for batch in batches:
            out, held = [], 0
            for id_, roles, texts in zip(*(batch.column(i) for i in range(3)), strict=True):
                turns = list(zip(roles.as_py(), texts.as_py(), strict=True))
                all_, spans = rendered(turns)
                found = encode(all_, add_special_tokens=False)
                mask, loss = masked(found.offsets, [s for s, (role, _) in zip(spans, turns, strict=True) if role == learned])
                out.append((id_.as_py(), len(turns), all_, found.ids, mask, [{"start": a, "end": b} for a, b in loss]))
                held += len(all_) + 5 * len(mask)
                if held > BATCH:
                    yield rows(out)
                    out, held = [], 0
            if out:
                yield rows(out)

    return whole.mapInArrow(run, FORMATTED)


def read_back(found: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from what formatted() put out."""
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, text, spans in zip(*(batch.column(i) for i in range(3)), strict=True):
                text = text.as_py()
                turns = parsed(text)
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in spans.as_py())
                told = "".join(f"{role}\n{body}\n" for role, body in turns)
                digest = lambda x: sha256(x.encode("utf-8", "replace")).hexdigest()
                out.append((id_.as_py(), len(turns), digest(told), len(loss), digest(loss), len(text)))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return found.select("conv_id", "text", "loss_spans").mapInArrow(run, kinds)
