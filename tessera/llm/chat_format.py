"""Chat formatting by token-level assembly.

Every text (and every role that has no mark of its own) is encoded by itself;
reserved ids above the vocabulary are spliced between the encoded texts, so no
text can ever produce a mark.  Loss masks are prefix sums of +1 where a
learned text begins and -1 where it ends.  So that the *rendered* text can't be
misread either, control strings inside texts are escaped: a backslash goes in
after their first character (``[INST]`` becomes ``[\\INST]``, and what looks
like an escape gets one more backslash), which is undone exactly on reading.

Turns are range-partitioned on (conversation, turn), so a conversation of any
length is cut into ordered runs of turns ("sections") of bounded token counts
and no conversation is gathered whole.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, shuffle_width, store, text_slices

#: Marks around a text, by role; other roles are written out between the first two of NAMED.
ROLES = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[REPLY] ", " </s>")}
NAMED = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
MARKS = (*(m for pair in ROLES.values() for m in pair), *NAMED)

#: A section ends with the turn that reaches so many tokens.
SECTION_TOKENS = 8192
#: Texts are encoded in pieces of at most so many code points.
PIECE_CHARS = 32768

SECTION = "conv_id long, part int, first_turn long, first_token long, n_turns long, n_tokens long, input_ids array<int>, loss_mask array<tinyint>"


def _piece_ends(text: str, limit: int = PIECE_CHARS) -> list[int]:
    """Where to cut a long text: before a single space between words if there is one, else anywhere."""
    ends, at = [], 0
    while len(text) - at > limit:
        cut = text.rfind(" ", at + limit // 2, at + limit)
        while cut > 0 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", at + limit // 2, cut)
        at = cut if cut > 0 else at + limit
        ends.append(at)
    return [*ends, len(text)]


class ChatCodec:
    """Encodes turns to ids and masks, and reads them back.  The vocabulary must give texts back unchanged."""

    def __init__(self, definition: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_buffer(definition)
        self.tok.encode_special_tokens = True
        self.tok.no_truncation()
        self.tok.no_padding()
        self.base = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        self.ids = {mark: self.base + i for i, mark in enumerate(MARKS)}
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.controls = sorted({m.strip() for m in MARKS} | {"<s>", "</s>"} | {t for t in added if len(t) > 1})
        if any("\\" in c for c in self.controls):
            raise ValueError("a control string must not hold a backslash")
        heads: dict[str, list[str]] = {}
        for c in self.controls:
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        rest = {h: "(?:" + "|".join(tails) + ")" for h, tails in heads.items()}
        self._plain = re.compile("|".join(rf"{re.escape(h)}(?=\\*{r})" for h, r in rest.items()))
        self._escaped = re.compile("|".join(rf"({re.escape(h)})\\(?=\\*{r})" for h, r in rest.items()))

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0], text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text, escaped; long texts go in pieces, so memory is bounded by the ids."""
        pieces, owner = [], []
        for i, text in enumerate(texts):
            text, at = self.escape(text), 0
            for end in _piece_ends(text):
                pieces.append(text[at:end])
                owner.append(i)
                at = end
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for first in range(0, len(pieces), 64):
            got = self.tok.encode_batch(pieces[first : first + 64], add_special_tokens=False)
            for i, enc in zip(owner[first : first + 64], got, strict=True):
                out[i].append(np.array(enc.ids, dtype=np.int32))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def decode(self, runs: list[np.ndarray]) -> list[str]:
        """Escaped texts of runs of ids."""
        return self.tok.decode_batch([r.tolist() for r in runs], skip_special_tokens=False)

    def assemble(self, roles: list[str], texts: list[str], loss_roles: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all turns in a row, the loss mask, and where each turn ends."""
        contents: list[str] = []
        for role, text in zip(roles, texts, strict=True):
            contents += [text] if role in ROLES else [role, text]
        coded = iter(self.encode(contents))
        mark = {m: np.array([i], dtype=np.int32) for m, i in self.ids.items()}
        parts: list[np.ndarray] = []
        learned: list[int] = []  # numbers of the parts under the mask
        last = np.zeros(len(roles), dtype=np.int64)  # number of each turn's last part
        for k, role in enumerate(roles):
            if role in ROLES:
                parts += [mark[ROLES[role][0]], next(coded), mark[ROLES[role][1]]]
            else:
                parts += [mark[NAMED[0]], next(coded), mark[NAMED[1]], next(coded), mark[NAMED[2]]]
            last[k] = len(parts) - 1
            if role in loss_roles:
                learned.append(len(parts) - 2)
        sizes = np.array([len(p) for p in parts])
        ends, under = np.cumsum(sizes), np.array(learned, dtype=np.int64)
        step = np.zeros(int(ends[-1]) + 1, dtype=np.int8)
        np.add.at(step, ends[under] - sizes[under], 1)
        np.add.at(step, ends[under], -1)
        return np.concatenate(parts), np.cumsum(step[:-1], dtype=np.int8), ends[last]

    def read(self, sections: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[list[tuple[str, str]], list[str], int]]:
        """Per section: its (role, text) turns, the texts under its mask, and the length of its rendered text."""
        known = {self.ids[a]: (role, self.ids[b]) for role, (a, b) in ROLES.items()}
        first, middle, end = (self.ids[m] for m in NAMED)
        runs: list[np.ndarray] = []
        shapes = []
        for ids, mask in sections:
            at = np.flatnonzero(ids >= self.base)
            marks = ids[at].tolist()
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
            turns, i = [], 0
            while i < len(marks):
                if marks[i] in known and marks[i + 1] == known[marks[i]][1]:
                    turns.append((known[marks[i]][0], 1))
                    i += 2
                elif marks[i] == first and marks[i + 1 : i + 3] == [middle, end]:
                    turns.append((None, 2))
                    i += 3
                else:
                    raise ValueError("ids are no row of turns")
            pairs = [(a + 1, b) for a, b, m in zip(at[:-1], at[1:], marks, strict=False) if m in known or m in (first, middle)]
            runs += [ids[a:b] for a, b in pairs]
            learned = edge.reshape(-1, 2)
            runs += [ids[a:b] for a, b in learned]
            shapes.append((turns, len(pairs), len(learned), sum(len(MARKS[m - self.base]) for m in marks)))
        texts, at, out = self.decode(runs), 0, []
        for turns, n, n_learned, chars in shapes:
            own, learned = texts[at : at + n], texts[at + n : at + n + n_learned]
            at += n + n_learned
            chars += sum(map(len, own))
            plain = iter(self.unescape(t) for t in own)
            read = [(role if size == 1 else next(plain), next(plain)) for role, size in turns]
            out.append((read, [self.unescape(t) for t in learned], chars))
        return out

    def check(self) -> None:
        probe = ["".join(self.controls) + "".join(f"{c[0]}\\{c[1:]} \\{c}\\" for c in self.controls), " a  b\n\n\tÉé ß日本\U0001f600\x00 ", ""]
        if [self.unescape(t) for t in self.decode(self.encode(probe))] != probe:
            raise ValueError("this vocabulary does not give texts back unchanged")


_CODECS: dict[int, ChatCodec] = {}


def _codec(definition: bytes) -> ChatCodec:
    key = hash(definition)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = ChatCodec(definition)
    return _CODECS[key]


def _shared(spark, vocabulary: str):
    with open(vocabulary, "rb") as f:
        definition = f.read()
    _codec(definition).check()
    return spark.sparkContext.broadcast(definition)


def format_chats(
    turns: DataFrame,
    vocabulary: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Conversations as token ids with loss masks: one row per section, a run of neighbouring turns.

    Returns ``conv_id, part, first_turn, first_token`` (numbers of the
    section's first turn and token within its conversation, which order the
    sections), ``n_turns, n_tokens, input_ids, loss_mask``.  A section ends with
    the turn that reaches ``SECTION_TOKENS`` tokens, so only a single long turn
    can make a long row.

    ``vocabulary`` is the path of a tokenizer definition (JSON) on the driver;
    its bytes are broadcast.  Null texts and roles are empty.  Rows without a
    conversation id make one conversation (null).  Rows of equal turn number,
    repeated rows too, all stay, ordered by role and the MD5 of the text; null
    turn numbers come first.  Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = turns.sparkSession
    ship_package(spark)
    shared = _shared(spark, vocabulary)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    order = ["conv_id", "turn", "role", "tie"]  # the tie keeps whole texts out of the partitioner's sample
    rows = rows.withColumn("tie", F.md5(F.col("text").cast("binary")))
    ranged = rows.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    ranged = ranged.select("conv_id", F.spark_partition_id().alias("part"), "role", "text")

    def write(batches):
        codec = _codec(shared.value)
        conv, n_turns, n_tokens = object(), 0, 0  # what this part has of the present conversation
        for batch in batches:
            convs, parts = batch.column(0).to_pylist(), batch.column(1)
            for first, n in text_slices(batch.column(3)):
                own = convs[first : first + n]
                ids, mask, ends = codec.assemble(batch.column(2).slice(first, n).to_pylist(), batch.column(3).slice(first, n).to_pylist(), loss_roles)
                out = {f: [] for f in ("conv", "turn", "token", "turns", "tokens", "ids", "mask")}
                begin, start = 0, 0  # turn and token at which the section begins
                for k in range(n):
                    end = int(ends[k])
                    if k + 1 < n and own[k + 1] == own[k] and end - start < SECTION_TOKENS:
                        continue
                    if own[k] != conv:
                        conv, n_turns, n_tokens = own[k], 0, 0
                    for f, v in zip(out, (conv, n_turns, n_tokens, k + 1 - begin, end - start, ids[start:end], mask[start:end]), strict=True):
                        out[f].append(v)
                    n_turns, n_tokens, begin, start = n_turns + k + 1 - begin, n_tokens + end - start, k + 1, end
                size = len(out["conv"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(out["tokens"])]), pa.int32())
                longs = [pa.array(out[f], pa.int64()) for f in ("conv", "turn", "token", "turns", "tokens")]
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out[f]))) for f in ("ids", "mask")]
                cols = [longs[0], parts.slice(first, 1).take(pa.array([0] * size)), *longs[1:], *lists]
                yield pa.RecordBatch.from_arrays(cols, ["conv_id", "part", "first_turn", "first_token", "n_turns", "n_tokens", "input_ids", "loss_mask"])

    sections = store(ranged.mapInArrow(write, SECTION), "chat-sections")
    # Conversations that lie in several parts: at most two of them a part have rows here, so the table is bounded by the parts.
    per_part = sections.groupBy("conv_id", "part").agg(F.sum("n_turns").alias("turns"), F.sum("n_tokens").alias("tokens"))
    several = per_part.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("id"))
    split = per_part.join(several, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = split.select(F.col("conv_id").alias("id"), F.col("part").alias("at"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("turns", "tokens")])
    joined = sections.join(F.broadcast(carry), F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("at")), "left")
    added = {f"first_{c}": F.col(f"first_{c}") + F.coalesce(F.col(f"{c}s"), F.lit(0)) for c in ("turn", "token")}
    return joined.withColumns(added).select(*sections.columns)


def read_chats(sections: DataFrame, vocabulary: str) -> DataFrame:
    """Read formatted sections back: ``conv_id, first_turn, n_turns, turns, learned, formatted_chars``.

    ``turns`` is the section's (role, text) structs, ``learned`` the texts
    under its loss mask, both unescaped; ``formatted_chars`` is the length of
    the rendered section.
    """
    spark = sections.sparkSession
    ship_package(spark)
    shared = _shared(spark, vocabulary)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def scan(batches):
        codec = _codec(shared.value)
        for whole in batches:
            sizes = np.cumsum(whole.column(2).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // (64 * SECTION_TOKENS))) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                batch = whole.slice(a, b - a)
                got = codec.read([(i.values.to_numpy(), m.values.to_numpy()) for i, m in zip(batch.column(3), batch.column(4), strict=True)])
                turns = [[{"role": r, "text": t} for r, t in x[0]] for x in got]
                cols = [batch.column(0), batch.column(1), pa.array([len(t) for t in turns], pa.int64())]
                cols += [pa.array(turns, kind), pa.array([x[1] for x in got], pa.list_(pa.string())), pa.array([x[2] for x in got], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["conv_id", "first_turn", "n_turns", "turns", "learned", "formatted_chars"])

    rows = sections.select("conv_id", "first_turn", "n_tokens", "input_ids", "loss_mask")
    return rows.mapInArrow(scan, "conv_id long, first_turn long, n_turns long, turns array<struct<role string, text string>>, learned array<string>, formatted_chars long")


def chat_digests(read: DataFrame) -> DataFrame:
    """One row per conversation of :func:`read_chats`: counts and SHA-256 digests of its turns and learned texts.

    A digest runs through a conversation in order, so its sections meet in one
    task; they are streamed through it, and only the state of the hash is held.
    """
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    rows = read.select("conv_id", "first_turn", "n_turns", text.alias("text"), F.concat_ws("", "learned").alias("learned"), "formatted_chars")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches):
        state, conv = None, None
        done: list[tuple] = []

        def flush():
            if state:
                done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def rows_out():
            cols = list(zip(*done, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in batches:
            for i in range(len(batch)):
                own = batch.column(0)[i].as_py()
                if state is None or own != conv:
                    flush()
                    state, conv = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], own
                learned = batch.column(4)[i].as_py()
                state[0] += batch.column(2)[i].as_py()
                state[1].update(batch.column(3)[i].as_buffer())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += batch.column(5)[i].as_py()
            if done:
                yield rows_out()
                done.clear()
        flush()
        if done:
            yield rows_out()

    return ordered.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
