"""Packing by minimum bin slack.

Documents are tokenised and cut into whole windows and a rest. A window is
filled by the multiset of remaining lengths that comes closest to its capacity:
the longest rest is put in, a subset-sum over the counts of the other lengths
(one bit per reachable sum) finds the best fill, and backtracking over the bit
sets gives how often each length is used. The fill is repeated while the counts
allow. Every group of some ten thousand pieces is packed on its own, so a task
holds only that group, and its loss of space is part of one window.

Defined cases: null text is empty and has the end token alone; repeated rows are
pieces of their own; texts of any length are tokenised in chunks cut at blanks;
an empty table gives no pieces; extra columns aren't returned.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import stage, table


@dataclass(frozen=True)
class Pack:
    """Production parameters. `tokenizer` is a file that every executor can read."""

    tokenizer: str = public_tokenizers.path("word_bpe_49k.json")
    end: int = 1
    size: int = 2048
    group: int = 50_000
    cached_words: int = 600_000


#: Characters whose case and class are plain, so that a text of them can be split here as the tokenizer splits it.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: The word_bpe_49k splitter, for small plain letters.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\r a-zß-öø-ÿ0-9]+")


#: What stands for each byte in the vocabulary: visible ones for themselves, the rest in order from 256.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_REST = [b for b in range(256) if b not in _SHOWN]
BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(_REST)}


class Words(dict):
    """Token ids of texts, from remembered ids of the chunks between blanks.

    The tokenizer's normaliser and splitter never reach over a blank or a line
    end. Chunks of plain characters are split here as the tokenizer does it, and
    the ids of their parts are remembered too; others go through it whole. Ids
    are little-endian unsigned 32-bit numbers.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join([BYTES[b] for b in part.encode()])
            tokens = [t.id for t in self.tokenizer.model.tokenize(shown)]
            ids = self.parts[part] = struct.pack(f"<{len(tokens)}I", *tokens)
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk) and "<|" not in chunk:  # no special token either
            ids = b"".join([self.part(p) for p in SPLIT.findall(chunk.lower())])
        else:
            whole = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(whole)}I", *whole)
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        for held in (self, self.parts):
            if len(held) > self.limit:
                held.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def pieces(docs: DataFrame, pack: Pack = Pack(), with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens[, ids]): whole windows, then the rest."""
    end, size = np.array([pack.end], dtype="<u4").tobytes(), 4 * pack.size
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(pack.tokenizer, pack.cached_words)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                out: list[list] = [[] for _ in fields]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = words.encode(text or "") + end
                    for lo in range(0, len(ids), size):
                        piece = ids[lo : lo + size]
                        row = [doc_id, lo // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4]
                        row += [np.frombuffer(piece, dtype="<i4")] * with_ids
                        for column, x in zip(out, row, strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text").mapInArrow(cut, ddl)


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How often to use each length so that the sum is as large as it can be within the capacity."""
    reach, steps = 1, []
    whole, top = (1 << (capacity + 1)) - 1, 1 << capacity
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        before, step, left = reach, 1, min(counts[length], capacity // length)
        while left > 0:  # counts in powers of two
            take = min(step, left)
            reach |= (reach << (take * length)) & whole
            left, step = left - take, step * 2
        if reach != before:
            steps.append((length, before))
            if reach & top:
                break
    rest, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> rest & 1:
            rest, n = rest - length, n + 1
        if n:
            used[length] = n
    return used


def fills(lengths: np.ndarray, size: int) -> Iterator[tuple[list[int], int]]:
    """(lengths of a window, how many such windows) until all the lengths are used."""
    values, n = np.unique(lengths, return_counts=True)
    counts = dict(zip(values.tolist(), n.tolist(), strict=True))
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        used = best_fill({k: v for k, v in counts.items() if v}, size - longest) if longest < size else {}
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // v for k, v in used.items())
        for k, v in used.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
        yield [k for k, v in used.items() for _ in range(v)], times


def _packed(rows: pa.Table, size: int, ids: Iterator[int]) -> list[pa.RecordBatch]:
    lengths = rows["length"].to_numpy()
    order = np.argsort(lengths, kind="stable")
    starts = dict(zip(*(x.tolist() for x in np.unique(lengths[order], return_index=True)), strict=True))
    sequence, offset = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
    for window, times in fills(lengths, size):
        for _ in range(times):
            number, at = next(ids), 0
            for length in window:
                row = order[starts[length]]
                starts[length] += 1
                sequence[row], offset[row] = number, at
                at += length
    rows = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    return rows.to_batches()


def pack_pieces(cut: DataFrame, pack: Pack = Pack()) -> DataFrame:
    """Pieces with sequence_id and offset; sequence ids are unique, and count up within a group."""
    cut = stage(cut, "pieces")
    tasks = max(1, -(-cut.count() // pack.group))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = count(TaskContext.get().partitionId() << 36), [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= pack.group:
                yield from _packed(pa.Table.from_batches(held), pack.size, ids)
                held, n = [], 0
        if n:
            yield from _packed(pa.Table.from_batches(held), pack.size, ids)

    ddl = ", ".join(f"{c} {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long"
    return cut.repartition(tasks).mapInArrow(fill, ddl)


def pack_documents(docs: DataFrame, pack: Pack = Pack(), with_ids: bool = False) -> DataFrame:
    return pack_pieces(pieces(docs, pack, with_ids), pack)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op10_pack": (op10, None)}
