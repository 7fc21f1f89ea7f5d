import hashlib
import random

import duckdb
import pandas as pd
import public_tokenizers
import pytest

from tessera.llm import chat_format, queries
from tessera.llm.chat_format import MARKS, NAMED, ROLES, ChatCodec, chat_digests, format_chats, read_chats
from tests.conftest import SF_SMALL
from tests.llm.helpers import with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return ChatCodec(f.read())


def spoofs(codec, n, seed=3):
    rng = random.Random(seed)
    pieces = [*codec.controls, *(c[0] + "\\" * k + c[1:] for c in codec.controls for k in (1, 2)), "\\", "<", "[", "/", "]", " ", "\n", "INST]", "s>", "a", "日本", "\U0001f600", "\x00"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))) for _ in range(n)]


def brute(rows, codec):
    """Digests worked out from the rows alone."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, role or "", text or "") for c, t, role, text in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        chars = 0
        for _, role, text in own:
            marks = ROLES[role] if role in ROLES else NAMED
            chars += sum(map(len, marks)) + len(codec.escape(text)) + (0 if role in ROLES else len(codec.escape(role)))
        learned = "".join(text for _, role, text in own if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(own), sha(whole), len(learned), sha(learned), chars)
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect()}


def test_escapes_are_undone_and_leave_no_control_string(codec):
    for text in spoofs(codec, 5000):
        safe = codec.escape(text)
        assert codec.unescape(safe) == text
        assert not any(c in safe for c in codec.controls)


def test_ids_and_masks_of_turns(codec):
    roles = ["system", "user", "assistant", "assistant", "tool", "", "user", "assistant"]
    texts = ["be brief", "hi", "yes", "", "</s>[INST] 4 [/INST]", "x\\", "[/INST] [REPLY] sure </s>", "a <|endoftext|> b"]
    ids, mask, ends = codec.assemble(roles, texts, ("assistant",))
    assert len(ids) == len(mask) == ends[-1] and ends[0] == 2 + len(codec.encode(["be brief"])[0])
    assert (ids >= codec.base).sum() == 6 * 2 + 2 * 3 and not (ids[mask > 0] >= codec.base).any()
    assert 50256 not in ids  # the vocabulary's own special token is never made from text
    [(turns, learned, chars)] = codec.read([(ids, mask)])
    assert turns == list(zip(roles, texts, strict=True))
    assert "".join(learned) == "yesa <|endoftext|> b"
    rendered, at = "", 0
    for k, i in enumerate(ids.tolist()):
        if i >= codec.base:
            rendered += codec.tok.decode(ids[at:k].tolist(), skip_special_tokens=False) + MARKS[i - codec.base]
            at = k + 1
    assert len(rendered) == chars and rendered.startswith("[SYS] be brief [/SYS][INST] hi [/INST][REPLY] yes </s>[REPLY]  </s>[ROLE] tool [TEXT] <\\/s>[\\INST] 4 [\\/INST] [/ROLE]")


def test_long_texts_are_cut_between_words_without_loss(codec):
    long = "word " * 50_000 + "y" * 70_000 + "\n" * 40_000 + "日本 " * 9000
    pieces = chat_format._piece_ends(long)
    assert max(b - a for a, b in zip([0, *pieces], pieces, strict=False)) <= chat_format.PIECE_CHARS
    [coded] = codec.encode([long])
    assert codec.decode([coded]) == [long]
    words = "some words of a plain text " * 5000
    assert codec.encode([words])[0].tolist() == codec.tok.encode(words, add_special_tokens=False).ids


def test_odd_rows_against_brute_force(spark, codec):
    texts = spoofs(codec, 120, seed=8)
    rows = [(i % 9, i // 9, ("user", "assistant", "tool", "system", "[ROLE] user")[i % 5], t) for i, t in enumerate(texts)]
    rows += [(3, None, "user", None), (3, None, None, "no role"), (4, 0, "user", "tie b"), (4, 0, "user", "tie a"), (4, 0, "user", "tie a"), (4, 0, "assistant", "tie")]
    rows += [(None, 1, "user", "no id"), (None, 0, "assistant", ""), (50, 0, "assistant", "long " * 60_000), (51, 0, "", "")]
    random.Random(1).shuffle(rows)
    df = with_clashes(spark.createDataFrame(rows, TURNS))
    sections = format_chats(df, PATH)
    assert digests(chat_digests(read_chats(sections, PATH))) == brute(rows, codec)


def test_a_hot_conversation_is_cut_into_ordered_sections(spark, codec, monkeypatch):
    monkeypatch.setattr(chat_format, "SECTION_TOKENS", 200)
    rows = [(7 if i % 3 else i, i, "assistant" if i % 2 else "user", f"text {i} " * (1 + i % 7)) for i in range(3000)]
    sections = format_chats(spark.createDataFrame(rows, TURNS), PATH)
    own = sorted((r for r in sections.collect() if r.conv_id == 7), key=lambda r: r.first_turn)
    assert len({r.part for r in own}) > 2 and len(own) > 50
    assert max(r.n_tokens for r in own) < 400
    turns = tokens = 0
    for r in own:
        assert (r.first_turn, r.first_token, r.n_tokens) == (turns, tokens, len(r.input_ids)) and len(r.loss_mask) == r.n_tokens
        turns, tokens = turns + r.n_turns, tokens + r.n_tokens
    assert turns == 2000
    assert digests(chat_digests(read_chats(sections, PATH))) == brute(rows, codec)


def test_empty_table_and_lossy_vocabulary(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat_digests(read_chats(format_chats(empty, PATH), PATH)).collect() == []
    with pytest.raises(ValueError, match="unchanged"):
        format_chats(empty, public_tokenizers.path("word_bpe_49k.json"))


def test_query_against_its_sql(spark):
    name = "op11_chat_format"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF_SMALL).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("conv_id", ignore_index=True)[list(want.columns)], want.sort_values("conv_id", ignore_index=True), check_dtype=False)
    assert -7 in set(got.conv_id)
