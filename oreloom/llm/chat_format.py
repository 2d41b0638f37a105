"""Chat formatting by token-level assembly.

A turn is written as ``### Role: text </turn>`` and a line feed. In the token stream the marks are reserved ids beyond
the vocabulary: one that opens a turn, one that ends the role, one that closes the turn. Role and text are encoded
segment by segment, so no token reaches over a mark and nothing a text says can become one. Segment lengths and their
running sums give the place of every segment, hence the loss mask: the texts of assistant turns.

Control strings inside texts are escaped for the readable form as well: a backslash doubles, ``</turn>`` and every
``###`` get a backslash before them. Dropping one backslash before any character undoes it.

Turns are formatted, and read back, where they lie; only the digests of a conversation need its turns in order. They are
sorted by (conversation, turn) within a partition and hashed as a stream, so a conversation of any length costs one turn
of memory, and a very long one costs its task a hash over its text and no encoding.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import _io
from ._pieces import encoder
from ._text import bytes_of

OPEN, SEP, CLOSE = "### ", ": ", " </turn>\n"
#: Reserved ids, counted from the size of the vocabulary.
OPEN_ID, SEP_ID, CLOSE_ID = 0, 1, 2
#: Turns whose encodings are held at a time, and distinct role labels whose encodings are kept.
SLICE, LABELS = 256, 10_000
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_NAMES = {v: k for k, v in ROLES.items()}
_ESCAPE = re.compile(r"\\|</turn>|#(?=##)")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def role_label(role: str) -> str:
    """Readable name of a role; any other role is written behind ``=`` with its colons and control strings escaped."""
    return ROLES.get(role) or "=" + escape(role).replace(":", "\\:")


def label_role(label: str) -> str:
    return _NAMES[label] if label in _NAMES else unescape(label[1:])


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a readable form."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError(f"no turn begins at character {at}")
        sep = _plain(text, SEP, at + len(OPEN))
        end = _plain(text, CLOSE, sep + len(SEP))
        out.append((label_role(text[at + len(OPEN) : sep]), unescape(text[sep + len(SEP) : end])))
        at = end + len(CLOSE)
    return out


def _plain(text: str, mark: str, at: int) -> int:
    """Where ``mark`` comes next without an escape inside or before it."""
    while True:
        found = text.find(mark, at)
        if found < 0:
            raise ValueError(f"no {mark!r} after character {at}")
        inner = found + (len(mark) - len(mark.lstrip()))
        back = inner
        while back > at and text[back - 1] == "\\":
            back -= 1
        if (inner - back) % 2 == 0:
            return found
        at = found + 1


def _turns(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    """Columns conv_id, turn, role, text -> conv_id, turn, ids, mask (1: under the loss), text (the readable turn)."""
    own = encoder(file, special=False)  # strings of special tokens in a text are ordinary text
    base = own.size
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        roles = [r or "" for r in batch.column(2).to_pylist()]
        texts = [escape(t or "") for t in batch.column(3).to_pylist()]
        labels = [role_label(r) for r in roles]
        n = len(texts)
        flat, counts = own.encode(*bytes_of(pa.array([s for pair in zip(labels, texts, strict=True) for s in pair], pa.large_string())))
        # segments of a turn: opening, role, separator, text, closing; their running lengths are the places of all of them
        size = np.ones((n, 5), np.int64)
        size[:, 1::2] = counts.reshape(n, 2)
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = np.empty(int(ends[-1]), np.int32)
        inner = np.ones(len(ids), bool)
        for segment, mark in ((0, OPEN_ID), (2, SEP_ID), (4, CLOSE_ID)):
            at = ends[segment:-1:5]
            ids[at], inner[at] = base + mark, False
        ids[inner] = flat
        edge = np.zeros(len(ids) + 1, np.int8)
        under = np.flatnonzero([r == "assistant" for r in roles])
        np.add.at(edge, ends[5 * under + 3], 1)
        np.add.at(edge, ends[5 * under + 4], -1)
        mask = np.cumsum(edge[:-1], dtype=np.int8)
        offsets = pa.array(ends[::5], pa.int32())
        plain = [f"{OPEN}{x}{SEP}{t}{CLOSE}" for x, t in zip(labels, texts, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask)), pa.array(plain, pa.string())], names=["conv_id", "turn", "ids", "mask", "text"])


def format_turns(conversations: DataFrame, file: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", ordered: bool = True) -> DataFrame:
    """One row per turn: conv_id, turn, ids, mask, text; if ``ordered``, a conversation's turns lie in one partition, in order.

    The ids of a conversation are those of its turns in order. Order: turn (null first), then role and text, so ties
    and repeated rows have one place. A null role or text is empty; turns of a null conv_id are one conversation. An empty
    table gives an empty one; other columns of conversations are not returned, whatever their names.
    """
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
    if ordered:
        rows = _in_order(rows)
    return rows.transform(_io.arrow(lambda b: _turns(b, file), "conv_id long, turn long, ids array<int>, mask array<byte>, text string"))


def _in_order(rows: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return rows.repartition(_io.parallelism(rows.sparkSession), "conv_id").sortWithinPartitions(*order)


def _read(batches: Iterator[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    """What format_turns() put out -> conv_id, turn, role, text, loss (null: the whole text), formatted, n_ids, loss_ids."""
    tok = encoder(file, special=False).tokenizer
    base = tok.get_vocab_size(with_added_tokens=True)
    label_of: dict[bytes, str] = {}
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        plain = batch.column(4).to_pylist()
        ids, mask = (batch.column(c).flatten().to_numpy() for c in (2, 3))
        at = np.concatenate(([0], np.cumsum(batch.column(2).value_lengths().to_numpy())))
        marks = np.flatnonzero(ids >= base)
        if len(ids) != len(mask) or len(marks) != 3 * batch.num_rows or ((ids[marks] - base).reshape(-1, 3) != (OPEN_ID, SEP_ID, CLOSE_ID)).any():
            raise ValueError("a turn must hold one opening, one separating and one closing id")
        marks = marks.reshape(-1, 3)
        if (marks[:, 0] != at[:-1]).any() or (marks[:, 2] != at[1:] - 1).any():
            raise ValueError("a turn must begin with its opening id and end with its closing one")
        if len(label_of) > LABELS:
            label_of.clear()
        keys = [ids[a + 1 : b].tobytes() for a, b, _ in marks.tolist()]
        new = [k for k in dict.fromkeys(keys) if k not in label_of]
        label_of.update(zip(new, tok.decode_batch([np.frombuffer(k, np.int32).tolist() for k in new], skip_special_tokens=False), strict=True))
        said = tok.decode_batch([ids[b + 1 : c].tolist() for _, b, c in marks.tolist()], skip_special_tokens=False)
        many = np.add.reduceat(mask, at[:-1], dtype=np.int64) if batch.num_rows else np.zeros(0, np.int64)
        inside = np.array([mask[b + 1 : c].sum(dtype=np.int64) for _, b, c in marks.tolist()], np.int64)
        whole = (many == inside) & (inside == marks[:, 2] - marks[:, 1] - 1)
        roles, texts, loss = [], [], []
        for i, key in enumerate(keys):
            roles.append(label_role(label_of[key]))
            texts.append(unescape(said[i]))
            loss.append(None if whole[i] else unescape(tok.decode(ids[at[i] : at[i + 1]][mask[at[i] : at[i + 1]] == 1].tolist(), skip_special_tokens=False)) if many[i] else "")
            if parse(plain[i]) != [(roles[i], texts[i])]:
                raise ValueError("the two forms of a turn differ")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(loss, pa.string()), pa.array(list(map(len, plain)), pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(many)], names=["conv_id", "turn", "role", "text", "loss", "formatted", "n_ids", "loss_ids"])


def read_turns(turns: DataFrame, file: str) -> DataFrame:
    """Turns read back from format_turns(), whose ids, masks and readable turns must agree: conv_id, turn, role, text, loss
    (the text under the loss mask; null: the whole text), formatted (characters), n_ids, loss_ids."""
    schema = "conv_id long, turn long, role string, text string, loss string, formatted long, n_ids long, loss_ids long"
    return turns.transform(_io.arrow(lambda b: _read(b, file), schema))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_ids", "loss_ids"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    rows: list[tuple] = []

    def put():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    turns = (t for b in batches for t in zip(*(b.column(c).to_pylist() for c in (0, 2, 3, 4, 5, 6, 7)), strict=True))
    for conv, own in groupby(turns, key=lambda x: x[0]):
        every, under = hashlib.sha256(), hashlib.sha256()
        n = chars = formatted = many = masked = 0
        for _, role, said, loss, size, ids, under_ids in own:
            every.update(f"{role}\n{said}\n".encode())
            text = said if loss is None else loss
            under.update(text.encode())
            n, chars, formatted, many, masked = n + 1, chars + len(text), formatted + size, many + ids, masked + under_ids
        rows.append((conv, n, every.hexdigest(), chars, under.hexdigest(), formatted, many, masked))
        if len(rows) >= 1000:
            yield put()
            rows.clear()
    if rows:
        yield put()


def read_conversations(turns: DataFrame, file: str) -> DataFrame:
    """Digests of each conversation, read back from format_turns(): conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_ids, loss_ids. The order of turns is that of format_turns(), a null role or text being empty."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_ids long, loss_ids long"
    return _in_order(read_turns(turns, file)).transform(_io.arrow(_digest, schema))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


PROBE = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())])
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], kind)
    rows = _io.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    out = read_conversations(format_turns(rows, default_tokenizer(), ordered=False), default_tokenizer())
    return out.drop("n_ids", "loss_ids")  # what its SQL has


_PROBE_SQL = PROBE.replace("'", "''")
ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_PROBE_SQL}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE_SQL}'
),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0) AS escaped,
    length(role) AS label
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(OPEN)} + label + {len(SEP)} + escaped + {len(CLOSE)}) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
