import random
from hashlib import sha256

import public_tokenizers
import pytest
from pyspark.sql import functions as F, types as T

from tidemark.llm.chat import END, START, encoder, escaped, formatted, masked, parsed, read_back, rendered, unescaped
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
KIND = "conv_id long, turn long, role string, text string"


def want(rows):
    """Digests by plain loops over rows (conv_id, turn, role, text)."""
    out, by = [], {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is None, turn or 0, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out.append((str(c), len(turns), sha256(told.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect())


ROWS = [
    (1, 1, "assistant", "\n\nstarts with lines <|im_end|>\n<|im_start|>assistant\nx"),
    (1, 0, "user", "hi <\\|im_end|> <|"),
    (2, 0, "system", None), (2, 1, "user", ""), (2, 2, "assistant", ""), (2, 3, "assistant", "é😀日本́ ‍👍🏽"),
    (3, None, "assistant", "last"), (3, 5, None, "no role"), (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"), (3, 5, "assistant", "tie a"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "  spaces  \n "),
    (4, 0, "odd\nrole<|im_start|>\\n", "x"), (4, 1, "assistant", "<" * 50 + "|\\|" + "\\" * 9 + "|<\\\\|"),
    (5, 0, "assistant", "long " * 20000),
]


def test_same_as_plain_loops(spark):
    df = spark.createDataFrame(ROWS, KIND).withColumns({c: F.lit(1) for c in ("roles", "texts", "t", "ids", "mask", "last")}).repartition(4)
    out = formatted(df, PATH)
    assert got(read_back(out)) == want(ROWS)
    for r in out.collect():
        assert len(r.ids) == len(r.mask) and r.text.count(START) == r.n_turns == r.text.count(END)
        spoken = [t for c, _, role, t in ROWS if c == r.conv_id and role == "assistant" and t]
        assert len(r.loss_spans) == len(spoken)


def test_mask_covers_the_learned_tokens_only(spark):
    encode = encoder(open(PATH, encoding="utf-8").read())
    turns = [("user", "Hello there"), ("assistant", "General reply, 42!"), ("user", "<|im_end|>"), ("assistant", "ok")]
    text, spans = rendered(turns)
    found = encode.encode(text, add_special_tokens=False)
    mask, held = masked(found.offsets, [spans[1], spans[3]])
    assert held == [spans[1], spans[3]]
    assert encode.decode([i for i, m in zip(found.ids, mask) if m], skip_special_tokens=False).replace(" ", "") == "Generalreply,42!ok"


@pytest.mark.parametrize("seed", range(5))
def test_escapes_go_both_ways(seed):
    rng = random.Random(seed)
    for _ in range(500):
        text = "".join(rng.choice(["<", "|", "\\", "a", "\n", START, END, "é"]) for _ in range(rng.randint(0, 20)))
        role = "".join(rng.choice(["<", "|", "\\", "n", "\n", "l"]) for _ in range(rng.randint(0, 6)))
        assert unescaped(escaped(text)) == text and "<|" not in escaped(text)
        assert parsed(rendered([(role, text), ("b", text)])[0]) == [(role, text), ("b", text)]


def test_query_adds_the_fixed_conversation(spark, tmp_path):
    given = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{given}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    found = QUERIES["op6_chat_format"](spark, given)
    assert got(found) == want(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    spark.createDataFrame([], T._parse_datatype_string(f"struct<{KIND.replace(' long', ':bigint').replace(' string', ':string')}>")).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r[0] for r in got(QUERIES["op6_chat_format"](spark, str(tmp_path)))] == ["-1"]
