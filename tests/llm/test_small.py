"""Chat formatting, token counts and source mixing against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from edge import empty, frame, rows
from pyspark.sql import functions as F

from sensorspark.llm import chat, mixing
from sensorspark.llm.token_cache import TokenCache
from sensorspark.session import fresh_path

TALK = [
    (1, 0, "system", "be <|im_end|> brief"), (1, 1, "user", "hi <\\|im_start|>"), (1, 2, "assistant", "yes\n<\\\\| no <|"), (1, 3, "user", None),
    (1, 4, "assistant", "ünd 漢"), (1, 5, "user", "left over"), (2, 0, "user", "a"), (2, 0, "assistant", "tie"), (3, 0, None, "no \\ role"),
    (3, 1, "odd\nro<|le\\n", "x"), (None, None, "assistant", ""), (4, 0, "assistant", "alone <|im_end|>\n<|im_start|>assistant\nme"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, "z") for r in TALK], "conv_id long, turn long, role string, text string, piece string")
    formatted = chat.turns(df)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    by = defaultdict(list)
    for r in sorted(TALK, key=lambda r: (r[0] or -9, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by[r[0]].append((r[2] or "", r[3] or ""))
    assert set(got) == set(by)
    full = {}
    for r in formatted.orderBy("conv_id", "ordinal").collect():
        full[r.conv_id] = full.get(r.conv_id, "") + r.piece
    for conv, turns in by.items():
        row, loss = got[conv], "".join(t for r, t in turns if r == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert full[conv].count(chat.START) == full[conv].count(chat.END) == len(turns)
    texts = chat.render(formatted).collect()
    assert len(texts) == sum(r == "assistant" for t in by.values() for r, _ in t) == chat.examples(formatted).count()
    for conv in by:
        assert sum(len(x.text) for x in texts if x.conv_id == conv) == got[conv].formatted_chars
    for x in texts:
        reply = chat.unescape(x.text[x.loss_begin : x.loss_end])
        assert reply == [t for r, t in by[x.conv_id] if r == "assistant"][x.example]
        assert x.text[x.loss_end :] == chat.END + "\n" and full[x.conv_id].startswith(x.text)
    assert chat.read_back(chat.turns(df.limit(0))).count() == 0


def test_chat_is_read_from_expanded_examples(spark, monkeypatch):
    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    formatted = chat.turns(df)
    texts = chat.render(formatted, rest=True).collect()
    whole = {}
    for r in formatted.orderBy("conv_id", "ordinal").collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.piece
    # Every turn lies in the last text of its conversation, also behind the last reply.
    assert {r.conv_id: r.text for r in texts} == whole
    assert sorted(r.conv_id for r in texts if r.example is None) == [1, 2, 3]
    render = chat.render
    # Another text in the contexts, of the same length, is noticed.
    monkeypatch.setattr(chat, "render", lambda f, **k: render(f, **k).withColumn("text", F.when(F.col("example") == 1, F.replace("text", F.lit("brief"), F.lit("BRIEF"))).otherwise(F.col("text"))))
    with pytest.raises(Exception, match="another context"):
        chat.read_back(formatted).collect()


def test_token_counts_and_cache(spark):
    path, model = fresh_path(spark, "counts"), public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = frame(spark)
    want = sorted(((r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or ""))) for r in rows()), key=str)
    for _ in range(2):
        cache = TokenCache(spark, path, model)
        assert sorted(map(tuple, cache.counts(docs).collect()), key=str) == want
    assert spark.read.parquet(path).count() == len({r[1] or "" for r in rows()})
    other = TokenCache(spark, path, public_tokenizers.path("byte_bpe_50k.json"))
    import tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in other.counts(docs).collect()}
    assert all(got[(r[0], len((r[1] or "").encode()))] == len(t.encode(r[1] or "", add_special_tokens=False).ids) for r in rows())
    assert other.counts(empty(spark)).count() == 0


def test_mix_meets_every_budget(spark):
    source = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate([(5, "a"), (7, "a"), (100, "b"), (1, "b"), (40, "c"), (3, None), (0, "d"), (11, "a")] * 9)]
    df = spark.createDataFrame([(i, t, "en", s, 3, "clash") for i, t, s in source], "doc_id long, text string, lang string, source string, taken int, mix_key string")
    out = mixing.mix(df)
    rows_ = out.collect()
    size = defaultdict(int)
    for _, t, s in source:
        size[s] += len(re.findall(r"\S+", t))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, open_ = {}, set(order)
    total = 1.5 * sum(size.values())
    while True:
        left = total - sum(goal.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * size[s]}
        if not above:
            goal |= share
            break
        goal |= {s: 2.0 * size[s] for s in above}
        open_ -= above
        if not open_:
            break
    taken = defaultdict(int)
    for r in rows_:
        assert r.source_size == size[r.source] and abs(r.target - goal[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in size)
    assert sorted(map(str, rows_)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert mixing.mix(frame(spark)).count() == len(rows()) and mixing.mix(empty(spark)).count() == 0
