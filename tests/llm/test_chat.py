from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.oracle_harness import compare, duck
from tillsight.llm import chat, queries
from tillsight.llm.oracles import CHAT

SF = "/root/testdata/sf0.001"
NASTY = ["<|", "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|im_part|>", "\\", "\\\\", "<\\|", "<\\\\|", "</s>", "<\\/s>", "[INST]", "[\\INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "<", "|", "é😀", "\n", "", " ", "user", "$1", "\\E"]


def nasty_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(12):
        for turn in range(rng.randrange(1, 8)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 9)))
            role = rng.choice(["user", "assistant", "assistant", "system", "<|im_sep|>\\odd\n", ""])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_round_trip(spark, seed):
    rows = nasty_rows(seed)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(frame).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_mask")))
    got = {r.conv_id: r for r in out.collect()}
    for conv, own in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        own = [(role, text) for _, _, role, text in own]
        r = got[conv]
        assert [(t.role, t.text) for t in r.back] == own
        assert r.loss == "".join(t for role, t in own if role == "assistant")
        inside = "".join(r.formatted[m.start : m.start + m.length] for m in r.loss_mask)
        assert "<|" not in inside and "[INST]" not in inside and "</s>" not in inside
        # One header for each run of one role.
        assert r.formatted.count(chat.START) == len([*itertools.groupby(own, key=lambda t: t[0])])


def test_query_matches_sql(spark):
    result = compare(spark, duck(SF), "op6", queries.op6_chat_formatting, CHAT, SF)
    assert result["columns_match"] and result["match"], result


def test_sql_on_nasty_texts(spark, tmp_path):
    rows = nasty_rows(7) + [(50, 0, "user", None), (50, 1, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/x")
    import shutil
    from pathlib import Path

    shutil.copy(next(Path(f"{tmp_path}/x").glob("*.parquet")), f"{tmp_path}/conversations.parquet")
    result = compare(spark, duck(str(tmp_path)), "op6", queries.op6_chat_formatting, CHAT, str(tmp_path))
    assert result["match"], result


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (1, 5, "assistant", "b"), (1, 5, "assistant", "b"), (1, 2, "user", "x" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = {r.conv_id: r for r in chat.format_chats(frame).collect()}
    assert out[None].formatted == "<|im_start|><|im_sep|><|im_end|><|im_start|>user<|im_sep|>a<|im_end|>"
    assert out[1].formatted.endswith("<|im_start|>assistant<|im_sep|>b<|im_part|>b<|im_end|>") and len(out[1].loss_mask) == 2
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_hashes(spark, tmp_path):
    rows = [(4, 1, "assistant", "É<|"), (4, 0, "user", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    r = {x.conv_id: x for x in queries.op6_chat_formatting(spark, str(tmp_path)).collect()}
    assert r[4].turns_sha256 == hashlib.sha256("user\nhi\nassistant\nÉ<|\n".encode()).hexdigest()
    assert r[4].loss_chars == 3 and r[4].loss_sha256 == hashlib.sha256("É<|".encode()).hexdigest()
    assert r[-1].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest() and r[-1].n_turns == 2
