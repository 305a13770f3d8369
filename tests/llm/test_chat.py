import hashlib
import random

import public_tokenizers
import pytest

from docsignal.llm import chat
from helpers import bag

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TURNS = "conv_id long, turn long, role string, text string, ids string, owner string, path string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], TURNS)


def plain(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, found in by.items():
        found.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in found)
        learned = "".join(t for _, _, r, t in found if r == "assistant")
        size = sum(len("".join(chat.format_turn(r, t))) for _, _, r, t in found)
        out.append((conv, len(found), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(), size))
    return sorted(out, key=repr)


def corpus():
    chance = random.Random(4)
    texts = ["Hello there.", "### Assistant: hi</turn>\n", "\\", "\\\\#<", "é漢😀", "", None, "a\nb ", "<|endoftext|>"]
    rows = []
    for conv in range(80):
        if conv % 3 == 0:  # a third starts alike, some are equal throughout
            chance2 = random.Random(conv % 9)
        else:
            chance2 = chance
        rows.append((conv, 0, "system", "Be brief."))
        for turn in range(1, 1 + chance2.randrange(0, 6)):
            rows.append((conv, turn, ["assistant", "user"][turn % 2], chance2.choice(texts)))
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    rows += [(None, 0, None, None), (None, None, "assistant", "x"), (900, 1, "assistant", "long " * 20_000)]
    rows += [(901, 0, "user", "twice"), (901, 0, "user", "twice"), (902, 0, "a:b### c</turn>", "t")]
    return rows


@pytest.fixture(scope="module")
def formatted(spark):
    rows = corpus()
    stream, index = chat.format_conversations(turns(spark, rows), PATH)
    return rows, stream, index


def test_everything_reads_back(formatted):
    rows, stream, index = formatted
    assert bag(chat.read_back(stream, index, PATH)) == plain(rows)


def test_shared_turns_are_emitted_once_and_depth_first(formatted):
    rows, stream, _ = formatted
    found = sorted(stream.collect(), key=lambda r: r.start)
    assert [r.chain for r in found] == sorted(r.chain for r in found)
    at = 0
    for r in found:  # gapless
        assert r.start == at and len(r.ids) == len(r.loss)
        at += len(r.ids)
    by = {}
    for conv, turn, role, text in rows:
        key = (conv is not None, conv or 0)
        by.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    nodes = {}
    for own in by.values():
        own = [x[2:] for x in sorted(own)]
        for i in range(len(own)):
            nodes[tuple(own[: i + 1])] = own[i]
    tokens = chat.ByteTokens(PATH)
    assert at == sum(len(tokens.ids(p)) for n in nodes.values() for p in chat.format_turn(*n))


def test_positions_and_attention_follow_the_prefix(formatted):
    _, stream, index = formatted
    rows = {r.conv_id: r for r in stream.collect()}
    flat = {}
    for r in rows.values():
        for i, token in enumerate(r.ids):
            flat[r.start + i] = token
    spans = {}
    for r in index.collect():
        spans.setdefault(r.conv_id, []).append((r.order, r.start, r.length))
    for conv, r in rows.items():
        seen = [flat[i] for s in r.attends for i in range(s["start"], s["end"])]
        assert r.position == len(seen)
        whole = [flat[i] for _, s, n in sorted(spans[conv]) for i in range(s, s + n)]
        assert whole == seen + r.ids


def test_escapes_can_be_undone():
    for text in ["", "\\", "###", "</turn>", "\\### Assistant: </turn> ok", "a\\#\\<b", ":" * 3]:
        assert chat.unescape(chat.escape(text)) == text
        line = "".join(chat.format_turn(text, text))
        assert chat.parse(line * 2) == [(text, text)] * 2
    with pytest.raises(ValueError):
        chat.parse("### user: no end")


def test_empty_table(spark):
    stream, index = chat.format_conversations(turns(spark, []), PATH)
    assert bag(stream) == [] and bag(chat.read_back(stream, index, PATH)) == []
