"""Sum-of-squares online packing of token sequences into fixed windows.

Documents arrive one by one. A window's level is its number of tokens; ``count[l]`` windows are open
at level ``l`` (0 and full ones don't count). A piece of ``s`` tokens goes to the level for which the
sum of ``count[l]^2`` afterwards is smallest; a new window is level 0. Documents of a window or more
first fill whole windows; only the rest is placed. Every Spark partition is one instance: its state
is the level array and the open windows. At its end, open windows are poured together by cutting, and
what remains is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quire.llm.common import kept

WINDOW = 2048
END_ID = 1
#: Chunks, and bytes of chunks and ids, of a generation of what a worker remembers; there are two.
MEMO, MEMO_BYTES = 200_000, 8_000_000

_TAIL = b".,;:!?"
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-įı-ɏ]+")  # but for the dotted capital I, whose lower case is two letters
# the byte-level alphabet: printable bytes stand for themselves, others follow from U+0100 on
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SYMBOL = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes, memoising white-space-free chunks.

    For tokenizers whose normaliser and pre-tokenizer drop white space, never join across it, fold
    case and split letters from punctuation; construction compares a probe with a direct encoding.
    Chunks of Latin letters skip the normaliser: their lower-cased bytes go to the model at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}  # the generation before: what is still used comes back from it
        self.held = 0
        for probe in ("It's 12 o'clock,\nél <|endoftext|> nächster\tTag 'll a", "FOO, Über?! öé:; foo.. ' x", "Ça été\x0bœuvre"):
            assert self.ids([probe.encode()])[0] == np.array(self.direct(probe), "<u4").tobytes(), "this tokenizer needs whole texts"

    def direct(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, chunks: Iterable[bytes]) -> None:
        memo, tokenize, slow = self.memo, self.tokenizer.model.tokenize, []
        for c in chunks:
            low = c.lower()
            core = low.rstrip(_TAIL)
            if not _LETTERS.fullmatch(core.decode()):
                slow.append(c)
                continue
            got = memo.get(core) or self.old.get(core)
            if got is None:
                word = core.decode().lower()
                symbols = word if word.isascii() else "".join([_BYTE_SYMBOL[b] for b in word.encode()])
                memo[core] = got = array("I", [t.id for t in tokenize(symbols)]).tobytes()
            tail = low[len(core) :]
            if tail and tail not in memo:
                memo[tail] = np.array(self.direct(tail.decode()), "<u4").tobytes()
            memo[c] = got + memo[tail] if tail else got
        if slow:
            for c, e in zip(slow, self.tokenizer.encode_batch_fast([c.decode() for c in slow], add_special_tokens=False), strict=True):
                memo[c] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        out = []
        for text in texts:
            memo, chunks = self.memo, (text or b"").split()
            got = list(map(memo.get, chunks))
            if None in got:
                missing = {c for c, g in zip(chunks, got, strict=True) if g is None}
                if len(memo) + 3 * len(missing) > MEMO or self.held > MEMO_BYTES:
                    self.old, self.memo, self.held, missing = memo, {}, 0, set(chunks)
                    memo = self.memo
                back = {c: self.old[c] for c in missing if c in self.old}
                memo.update(back)
                self.learn(missing - back.keys())
                self.held += sum(len(c) + len(memo[c]) for c in missing)
                got = [memo[c] for c in chunks]
            out.append(b"".join(got))
        return out


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return kept(("packing", path), lambda: Encoder(path))


class SumOfSquares:
    """Online packer of one partition; pieces are opaque and have a length in tokens."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, piece, size: int) -> list | None:
        """Put a piece of 1..window-1 tokens; the window's pieces if it is now full.

        Moving a window from level l to l+s changes the sum of squares by
        2(count[l+s] - count[l]) + 2, opening one by 2 count[s] + 1, and filling one up by 1 - 2 count[l].
        """
        c, w = self.count, self.window
        levels = np.flatnonzero(c[1 : w - size + 1]) + 1
        best, cost = 0, 2 * c[size] + 1
        if len(levels):
            after = levels + size
            change = np.where(after == w, 1 - 2 * c[levels], 2 * (c[after % w] - c[levels]) + 2)
            i = len(levels) - 1 - int(np.argmin(change[::-1]))  # of equal ones the fullest
            if change[i] <= cost:
                best = int(levels[i])
        held = self.open[best].pop() if best else []
        if best:
            c[best] -= 1
        held.append((piece, size))
        if best + size == w:
            return held
        self.open[best + size].append(held)
        c[best + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """The windows still open, fullest first."""
        for level in range(self.window - 1, 0, -1):
            yield from self.open[level]


def powers(n: int) -> list[int]:
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def pack_documents(docs: Iterator[tuple[object, bytes]], window: int = WINDOW) -> Iterator[tuple]:
    """(document, ids, start, length, sequence, offset) of every piece, sequences counted from 0.

    ``docs``: a handle and its ids, 4 bytes each. Only documents of open windows are held.
    """
    packer, sequence = SumOfSquares(window), 0

    def emit(pieces):
        nonlocal sequence
        offset = 0
        for (doc, ids, start), size in pieces:
            yield doc, ids, start, size, sequence, offset
            offset += size
        sequence += 1

    for doc, ids in docs:
        n = len(ids) // 4
        whole = n - n % window
        for start in range(0, whole, window):
            yield from emit([((doc, ids, start), window)])
        if n > whole:
            full = packer.place((doc, ids, whole), n - whole)
            if full:
                yield from emit(full)
    # windows still open keep what they hold; the emptiest are taken apart to fill up the fullest
    opened, spare = list(packer.rest()), deque()
    at, end = 0, len(opened)
    while at < end:
        held = opened[at]
        room = window - sum(size for _, size in held)
        while room and (spare or end > at + 1):
            if not spare:
                end -= 1
                spare.extend(opened[end])
            (doc, ids, start), size = spare.popleft()
            take = min(size, room)
            held.append(((doc, ids, start), take))
            room -= take
            if take < size:
                spare.appendleft(((doc, ids, start + take), size - take))
        at += 1
        if room:
            spare.extendleft(reversed(held))
        else:
            yield from emit(held)
    for target in powers(sum(size for _, size in spare)):
        held, room = [], target
        while room:
            (doc, ids, start), size = spare.popleft()
            take = min(size, room)
            held.append(((doc, ids, start), take))
            room -= take
            if take < size:
                spare.appendleft(((doc, ids, start + take), size - take))
        yield from emit(held)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A null text is empty and consists of its end id. Every input row is packed, repeated rows and
    null ids included; an empty table gives no pieces. Sequence ids are the partition's number times
    2^33 plus a count, so a retried task gives the same ones. Padding: none, save in no window at all
    (windows are full or hold a power of two). Sequences, not pieces, depend on the partitioning.
    """
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        encode, base = encoder(tokenizer_path).ids, TaskContext.get().partitionId() << 33

        def read():
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1).cast(pa.binary())
                for at in range(0, len(texts), 64):
                    for i, ids in enumerate(encode(texts.slice(at, 64).to_pylist()), at):
                        yield keys[i], ids + end

        rows: list[tuple] = []

        def flush():
            ids = pa.array([r[0] for r in rows], type=rows[0][0].type)
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in zip(*(r[1:] for r in rows)))], names=[id_col, *names])

        for key, ids, start, size, sequence, offset in pack_documents(read(), window):
            rows.append((key, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), len(ids) // 4, base + sequence, offset))
            if len(rows) >= 5000:
                yield flush()
                rows.clear()
        if rows:
            yield flush()

    src = docs.select(id_col, docs[text_col].cast("string").alias("__text"))
    return src.mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{n} bigint" for n in names))
