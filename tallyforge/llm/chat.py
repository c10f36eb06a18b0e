"""Chat formatting at token level: segments encoded one by one, reserved ids spliced in, loss masks from prefix sums.

A turn becomes  <|turn|> role <|text|> text </s> , where the three markers are reserved ids that no text can produce. Role and
text are encoded as ordinary text. Control strings inside them are broken by a backslash after their first character and
backslashes are doubled, so the joined text has no control string but the template's and the way back is exact.

The output has one row a turn, so that a conversation of any length needs no row, group or task of its own size: token ids,
the place of the row's first token in the conversation (a running sum of segment lengths), and the span of tokens that count
for the loss. ``loss_mask`` expands the span into zeros and ones.

Defined cases: null role or text is empty; null turns come first; equal turns are ordered by role, then text; repeated rows are
turns of their own; a null conv_id is one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import per_worker, text_of

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
MARKERS = (TURN, TEXT, END)
#: Control strings of common templates; texts that hold them are escaped too.
CONTROLS = (*MARKERS, "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's byte-pair encoding cuts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def escape(text: str, controls: tuple[str, ...] = CONTROLS) -> str:
    text = text.replace("\\", "\\\\")
    for c in controls:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


class Coder:
    """Byte-pair encoding with the markers' ids behind the vocabulary's."""

    def __init__(self, ranks: bytes):
        import tiktoken

        pairs = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})
        self.reserved = {m: max(pairs.values()) + 1 + i for i, m in enumerate(MARKERS)}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self.encoding.decode(ids)


def _ranks(df: DataFrame, vocabulary: str):
    """The vocabulary file (under 1 MB), read by the driver and sent to the workers once."""
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def format_conversations(conversations: DataFrame, vocabulary: str = VOCABULARY, loss_roles: tuple[str, ...] = ("assistant",),
                         controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """conv_id, position (from 0), token_ids, first_token, loss_start, loss_end; one row a turn.

    ``loss_start`` and ``loss_end`` count tokens from the start of the conversation and hold the text of ``loss_roles``;
    they are equal for other roles. ``controls`` must contain the markers.
    """
    ranks = _ranks(conversations, vocabulary)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                text_of("role").alias("role"), text_of("text").alias("text"))

    def encode(batches):
        coder = per_worker("ranks", str(vocabulary), lambda: Coder(ranks.value))
        r = coder.reserved
        for batch in batches:
            ids, before, inside = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                role_, text_ = escape(role, controls), escape(text, controls)
                head, body = [r[TURN], *coder.encode(role_), r[TEXT]], coder.encode(text_)
                ids.append([*head, *body, r[END]])
                before.append(len(head))
                inside.append(len(body) if role in loss_roles else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32())), *(pa.array(x, pa.int64()) for x in (before, inside))],
                names=["conv_id", "turn", "role", "text", "token_ids", "before", "inside"])

    coded = rows.mapInArrow(encode, "conv_id long, turn long, role string, text string, token_ids array<int>, before long, "
                                    "inside long")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = coded.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("position"), "token_ids",
        (F.sum(F.size("token_ids")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.size("token_ids")).alias("first_token"),
        "before", "inside")
    start = F.col("first_token") + F.col("before")
    return placed.select("conv_id", "position", "token_ids", "first_token", start.alias("loss_start"),
                         (start + F.col("inside")).alias("loss_end"))


def loss_mask(formatted: DataFrame) -> DataFrame:
    """Adds ``loss_mask``: for each token of the row 1 where it counts for the loss, else 0."""
    ones = (F.col("loss_end") - F.col("loss_start")).cast("int")
    before = (F.col("loss_start") - F.col("first_token")).cast("int")
    return formatted.withColumn("loss_mask", F.concat(
        F.array_repeat(F.lit(0), before), F.array_repeat(F.lit(1), ones),
        F.array_repeat(F.lit(0), F.size("token_ids") - before - ones)))


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, position, role, text, loss_text, formatted_chars of each turn, from its token ids and loss mask alone.

    ``loss_text`` is what the mask covers, unescaped; null where it covers nothing. ``formatted_chars`` is the length of the
    turn in the template, markers and escapes included.
    """
    ranks = _ranks(formatted, vocabulary)

    def decode(batches):
        coder = per_worker("ranks", str(vocabulary), lambda: Coder(ranks.value))
        for batch in batches:
            roles, texts, covered, chars = [], [], [], []
            for ids, mask in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                cut, end = ids.index(coder.reserved[TEXT]), ids.index(coder.reserved[END])
                if ids[0] != coder.reserved[TURN] or end != len(ids) - 1:
                    raise ValueError(f"not a turn: {ids[:20]}")
                role, text = coder.decode(ids[1:cut]), coder.decode(ids[cut + 1:end])
                marked = [i for i, m in zip(ids, mask) if m]
                roles.append(unescape(role))
                texts.append(unescape(text))
                covered.append(unescape(coder.decode(marked)) if marked else None)
                chars.append(len(role) + len(text) + sum(map(len, MARKERS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.string()) for x in (roles, texts, covered)),
                 pa.array(chars, pa.int64())],
                names=["conv_id", "position", "role", "text", "loss_text", "formatted_chars"])

    return loss_mask(formatted).select("conv_id", "position", "token_ids", "loss_mask").mapInArrow(
        decode, "conv_id long, position long, role string, text string, loss_text string, formatted_chars long")


def conversation_digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; one row a conversation, read back from the tokens.

    A conversation's turns run through one hash in order, a row at a time, so a very long one needs no memory of its size.
    """
    def digest(batches):
        none = object()
        conv, out = none, []

        def row():
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars

        def batch_of(found):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for r in batch.to_pylist():
                if conv is none or r["conv_id"] != conv:
                    if conv is not none:
                        out.append(row())
                    conv, n, chars, formatted_chars = r["conv_id"], 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                n += 1
                turns.update(f"{r['role']}\n{r['text']}\n".encode())
                loss.update((r["loss_text"] or "").encode())
                chars += len(r["loss_text"] or "")
                formatted_chars += r["formatted_chars"]
            if out:
                yield batch_of(out)
                out = []
        if conv is not none:
            yield batch_of([row()])

    return read_back(formatted, vocabulary).repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
