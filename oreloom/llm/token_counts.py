"""Token counts that follow edits.

A document is cut into pre-tokens, the units the tokenizer encodes one by one. They are found for a batch of texts at
once, from the class of every character, and each distinct one is encoded once a batch. A document keeps the characters
and tokens of its pre-tokens in slots of about ``CHUNK``, and a segment tree over the slots holds the sums of both: totals,
sums of ranges and the place of a character come from the tree. Only the slots that an edit touches become strings.

An edit descends by characters to the first pre-token that touches the edited place and goes one further back (a run of
white space is split by what follows it), re-scans from there until a new boundary meets an old one behind the edit,
re-encodes only those pre-tokens and updates the sums on the path to the root. From a common boundary on, the scan depends
on the rest of the text alone, so everything behind it stays as it is. A slot that overflows shares its pre-tokens with
the smallest part of the tree that has room, and only that part is summed again; a full tree doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io
from ._pieces import BYTE_LETTERS, PATTERN, ByteEncoder, code_points, kind_of, pretoken_starts
from ._text import parts

#: Pre-tokens of a slot at first and at most.
CHUNK, FULL = 64, 128
#: Characters of a scan window beyond a match on which the match does not depend.
_AHEAD = 3
_CACHE = 200_000
_COUNTERS: dict[str, Counter] = {}
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Number of tokens of pre-tokens, each distinct one encoded once.

    Right for byte-level BPE files that cut by PATTERN and change no text before; others are refused.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        if kind_of(self.tokenizer) is not ByteEncoder:
            raise ValueError(f"{file} does not cut texts by the byte-level pattern")
        self.scan = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if new:
            if len(known) > _CACHE:
                known.clear()
                new = list(dict.fromkeys(pieces))
            tokenize = self.tokenizer.model.tokenize  # a pre-token in the byte alphabet is what the model sees
            for p in new:
                known[p] = len(tokenize(p.encode().decode("latin-1").translate(BYTE_LETTERS)))
        return list(map(known.__getitem__, pieces))

    def leaves(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(characters, tokens) of every pre-token of whole UTF-8 texts, and the range of pre-tokens of each text."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        code, chars_at, place = code_points(data, at)
        starts = pretoken_starts(code, chars_at[:-1])
        edges = np.append(starts, len(code))
        cut = edges if place is None else place[edges]
        own = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        counts = np.array(self.count(own.dictionary.to_pylist()), np.int64)
        return np.diff(edges), counts[own.indices.to_numpy()], np.searchsorted(starts, chars_at)


def counter(file: str) -> Counter:
    if file not in _COUNTERS:
        _COUNTERS[file] = Counter(file)
    return _COUNTERS[file]


class TokenTree:
    """The pre-tokens of one document under edits. ``lengths`` and ``counts`` are those of its pre-tokens, where known."""

    def __init__(self, text: str, counter: Counter, lengths: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.counter, self.reencoded = counter, 0
        if lengths is None:
            raw = np.frombuffer(text.encode(), np.uint8)
            lengths, counts, _ = counter.leaves(raw, np.array([0, len(raw)]))
        self._source, self._lengths, self._counts = text, lengths, counts
        n = -(-len(lengths) // CHUNK)
        self.size = 1 << max(0, n - 1).bit_length()
        pad = [0] * (self.size - n)
        if n > 1:
            cut = np.arange(0, len(lengths), CHUNK)
            chars, tokens = np.add.reduceat(lengths, cut).tolist(), np.add.reduceat(counts, cut).tolist()
        else:
            chars, tokens = ([int(lengths.sum())], [int(counts.sum())]) if n else ([], [])
        self._at = [0, *accumulate(chars)]
        #: node k has the children 2k and 2k + 1; the slots are the nodes from ``size`` on
        self.chars, self.tokens = [0] * self.size + chars + pad, [0] * self.size + tokens + pad
        self._touched: dict[int, tuple[str, list[int], list[int]]] = {i: ("", [], []) for i in range(n, self.size)}
        self._sum(1)

    def _slot(self, i: int) -> tuple[str, list[int], list[int]]:
        """(text, lengths, counts) of a slot; those no edit has touched are cut from the document when asked for."""
        own = self._touched.get(i)
        if own is None:
            lo = i * CHUNK
            own = self._source[self._at[i] : self._at[i + 1]], self._lengths[lo : lo + CHUNK].tolist(), self._counts[lo : lo + CHUNK].tolist()
        return own

    def _put(self, i: int, text: str, lengths: list[int], counts: list[int]) -> None:
        self._touched[i] = text, lengths, counts
        self.chars[self.size + i], self.tokens[self.size + i] = len(text), sum(counts)

    def _sum(self, node: int) -> None:
        """Sum the nodes under ``node`` again, and those on its path to the root."""
        chars, tokens = self.chars, self.tokens
        lo, hi = node, node + 1
        while lo < self.size:
            lo, hi = 2 * lo, 2 * hi
        while lo > node:
            lo, hi = lo // 2, hi // 2
            for k in range(lo, hi):
                chars[k], tokens[k] = chars[2 * k] + chars[2 * k + 1], tokens[2 * k] + tokens[2 * k + 1]
        while node > 1:
            node //= 2
            chars[node], tokens[node] = chars[2 * node] + chars[2 * node + 1], tokens[2 * node] + tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def leaves(self) -> int:
        whole = (self.size - len(self._touched)) * CHUNK
        last = -(-len(self._lengths) // CHUNK) - 1
        if last >= 0 and last not in self._touched:
            whole += len(self._lengths) - (last + 1) * CHUNK
        return whole + sum(len(x[1]) for x in self._touched.values())

    @property
    def text(self) -> str:
        return "".join(self._slot(i)[0] for i in range(self.size))

    @property
    def chunks(self) -> list[list[tuple[int, int]]]:
        return [list(zip(*self._slot(i)[1:], strict=True)) for i in range(self.size)]

    def _descend(self, char: int) -> tuple[int, int, int]:
        """(slot, characters before it, tokens before it) of the first slot that ends at ``char`` or later."""
        k, begin, tokens = 1, 0, 0
        while k < self.size:
            k *= 2
            if begin + self.chars[k] < char:
                begin, tokens = begin + self.chars[k], tokens + self.tokens[k]
                k += 1
        return k - self.size, begin, tokens

    def _find(self, char: int) -> tuple[int, int, int]:
        """(slot, pre-token, its first character) of the one before the first that ends at ``char`` or later."""
        slot, begin, _ = self._descend(char)
        i, lengths = 0, self._slot(slot)[1]
        while i < len(lengths) and begin + lengths[i] < char:
            begin += lengths[i]
            i += 1
        if i:
            return slot, i - 1, begin - lengths[i - 1]
        if begin:
            slot, begin, _ = self._descend(begin)
            lengths = self._slot(slot)[1]
            return slot, len(lengths) - 1, begin + sum(lengths[:-1])
        return slot, 0, begin

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters start .. end by ``text``; both are moved into the document if they lie outside."""
        start = min(max(start, 0), self.length)
        end = min(max(end, start), self.length)
        slot, leaf, begin = self._find(start)
        last, before, _ = self._descend(min(end + 1, self.length))
        own = [self._slot(i) for i in range(slot, last + 1)]
        known = before + self.chars[self.size + last]  # old characters up to the last slot in sight
        while True:
            lengths = [x for s in own for x in s[1]]
            base = begin - sum(lengths[:leaf])
            old = "".join(s[0] for s in own)
            window = old[begin - base : start - base] + text + old[end - base :]
            shift = len(text) - (end - start)
            safe = start + len(text) - begin
            ends = {e + shift - begin: k for k, e in enumerate(accumulate(lengths, initial=base)) if e >= end}  # old boundaries in the window
            whole = known >= self.length
            pieces: list[str] = []
            stop = None
            for m in self.counter.scan.finditer(window):
                if not whole and m.end() > len(window) - _AHEAD:
                    break
                pieces.append(m[0])
                if m.end() >= safe and m.end() in ends:
                    stop = ends[m.end()]
                    break
            else:
                stop = len(lengths)
            if stop is not None:
                break
            following, _, _ = self._descend(known + 1)  # nothing met yet: one more slot in sight
            own += [self._slot(i) for i in range(last + 1, following + 1)]
            last, known = following, known + self.chars[self.size + following]
        self.reencoded += sum(map(len, pieces))
        merged = lengths[:leaf] + list(map(len, pieces)) + lengths[stop:]
        old_counts = [x for s in own for x in s[2]]
        counts = old_counts[:leaf] + self.counter.count(pieces) + old_counts[stop:]
        self._replace(slot, last, old[: begin - base] + window, merged, counts)

    def _replace(self, first: int, last: int, text: str, lengths: list[int], counts: list[int]) -> None:
        """Put these pre-tokens in place of the slots first .. last."""
        node_lo, node_hi = self.size + first, self.size + last
        while node_lo != node_hi:
            node_lo, node_hi = node_lo // 2, node_hi // 2
        node = node_lo
        lo, width = first, last - first + 1
        if len(lengths) > FULL * width:  # climb to the smallest part of the tree with room
            rest_lo, rest_hi = [], []
            while True:
                depth = self.size.bit_length() - node.bit_length()
                lo, width = (node << depth) - self.size, 1 << depth
                rest_lo = [self._slot(i) for i in range(lo, first)]
                rest_hi = [self._slot(i) for i in range(last + 1, lo + width)]
                held = len(lengths) + sum(len(s[1]) for s in (*rest_lo, *rest_hi))
                if held <= CHUNK * 3 // 2 * width or node == 1:
                    break
                node //= 2
            around = [*rest_lo, (text, lengths, counts), *rest_hi]
            text = "".join(s[0] for s in around)
            lengths, counts = [x for s in around for x in s[1]], [x for s in around for x in s[2]]
            if held > CHUNK * 3 // 2 * width:  # the whole tree is full
                while held > CHUNK * width:
                    width *= 2
                self.size, self._touched = width, {}
                self.chars, self.tokens = [0] * (2 * width), [0] * (2 * width)
        n, at, begun = len(lengths), 0, 0
        used = min(width, max(1, -(-n // CHUNK))) if n <= CHUNK * width else width
        for j in range(width):
            upto = n if j >= used - 1 else n * (j + 1) // used
            size = sum(lengths[at:upto])
            self._put(lo + j, text[begun : begun + size], lengths[at:upto], counts[at:upto])
            at, begun = upto, begun + size
        self._sum(node)

    def _before(self, char: int) -> int:
        """Tokens of the pre-tokens that begin before ``char``."""
        if char <= 0:
            return 0
        slot, begin, tokens = self._descend(min(char, self.length))
        for length, count in zip(*self._slot(slot)[1:], strict=True):
            if begin >= char:
                break
            begin, tokens = begin + length, tokens + count
        return tokens

    def count_between(self, start: int, end: int) -> int:
        """Tokens of the pre-tokens that begin in start .. end."""
        return max(0, self._before(end) - self._before(start))


def recount(docs: DataFrame, file: str, id_col: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """One row per row of docs: id_col, n_tokens before the edits, n_edits, tokens_after, pretokens_after, chars_after,
    reencoded_chars.

    ``edits`` is an array of (start, end, text), applied in order, each in characters of the text as the edits before
    it left it. A null text is empty; a null array is no edit; a null start is 0, a null end the start and a null
    replacement empty. Places outside the text are moved to its ends. Repeated rows are counted alike, an empty table
    gives an empty one, and no column of docs but id_col is returned, whatever its name.
    """
    names = ["n_tokens", "n_edits", "tokens_after", "pretokens_after", "chars_after", "reencoded_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(file)
        for batch in batches:
            rows, texts, scripts = [], batch.column(1), batch.column(2).to_pylist()
            for lo, data, at in parts(texts):
                lengths, counts, of = own.leaves(data, at)
                raw = data.tobytes()
                for i in range(len(at) - 1):
                    script = [e for e in scripts[lo + i] or () if e is not None]
                    a, b = int(of[i]), int(of[i + 1])
                    tree = TokenTree(raw[at[i] : at[i + 1]].decode(), own, lengths[a:b], counts[a:b])
                    before = tree.total
                    for e in script:
                        start = e["start"] or 0
                        tree.edit(start, start if e["end"] is None else e["end"], e["text"] or "")
                    rows.append((before, len(scripts[lo + i] or ()), tree.total, tree.leaves, tree.length, tree.reencoded))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names)))], names=[id_col, *names])

    own = docs.select(F.col(id_col), F.col(text), F.col(edits).cast(EDITS).alias("_edits"))
    return own.transform(_io.arrow(run, _io.schema_with(own.select(id_col), *(f"{n} bigint" for n in names))))


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs with the array ``edits`` from an edit table (id_col, seq, start, end, text), in the order of seq, start, end, text."""
    script = edits.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "text"))), lambda e: F.struct(e["start"].cast("int").alias("start"), e["end"].cast("int").alias("end"), e["text"].alias("text"))).alias("edits"))
    return docs.drop("edits").join(script, id_col, "left")


def revision(text: Column) -> Column:
    """The edit script of the registered query: an insertion inside the first third, a deletion around the middle, a
    replacement near the end and a sentence appended."""
    n = F.coalesce(F.length(text), F.lit(0))
    edit = lambda a, b, t: F.struct(F.floor(a).cast("int").alias("start"), F.floor(b).cast("int").alias("end"), F.lit(t).alias("text"))
    return F.array(edit(n / 3, n / 3, "re-vised 2nd "), edit(n / 2, n / 2 + 24, ""), edit(n * 0.9, n * 0.9 + 5, "'ll 10x"), edit(n * 2 + 64, n * 2 + 64, "\n\nEnd of record."))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _io.table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", revision(F.col("text")))
    return recount(docs, default_tokenizer())
