"""Packing of tokenised documents into training sequences of fixed length.

Bounded-space online best fit: each task keeps a fixed number of open sequences. A bitset has a bit
for every amount of free space that some open sequence has, so the fullest sequence with enough room
is one shift and one lowest bit away. When too many are open, the fullest closes first.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import stored

CAPACITY = 2048
END = 0
OPEN = 1024
#: Strings that the vocabulary's JSON file makes one id wherever they stand in a text.
SPECIAL = {"<|endoftext|>": 50256}
#: Pieces a task packs. A task's last sequences may stay part empty, so tasks are not too small.
TASK_PIECES = 200_000
#: Pieces that a task looks at together; the longest of them are placed first.
RUN = 4000
#: Sequence numbers of one task.
TASK_NUMBERS = 33
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = f"{PIECES}, sequence_id bigint, offset bigint"


class BytePairEncoder:
    """Ids of a byte-level vocabulary, given as lines of base64 token and rank.

    The rank file's library gives the ids of the JSON file of the same name several times as fast,
    but its splitting pattern gives up on runs of some hundred thousand white spaces. Texts with
    such runs go to the library of the JSON file, which is loaded when the first is met. Strings of
    special tokens are ordinary text to both, or with ``special`` their ids, as in the JSON file.
    """

    def __init__(self, path: str, special: bool = False):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.path, self.special, self.plain = path, SPECIAL if special else {}, None
        self.fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self._plain().encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain(self):
        from tokenizers import Tokenizer

        if self.plain is None:
            self.plain = Tokenizer.from_file(self.path.removesuffix(".tiktoken") + ".json")
            self.plain.encode_special_tokens = not self.special
        return self.plain

    def decode(self, ids) -> str:
        return self.fast.decode_bytes(ids).decode()


def cut_places(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, which holds the rest."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total])]


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    special: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, ended by id 0.

    ``vocabulary`` is a rank file with the JSON file of the same vocabulary beside it. A null text
    counts as empty, so it is the end id alone; a document of at most ``capacity`` ids is one piece.
    ``special`` takes strings of special tokens in a text for their ids, as the JSON file does unasked.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BytePairEncoder(vocabulary, special)
        names = ["piece", "start", "length", "ids_crc32"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows, found = [], []
            for row, value in enumerate(batch.column(1)):
                ids = encoder.encode(value.as_py() or "")
                data = np.append(ids, END).astype("<u4")
                for piece, (start, length) in enumerate(cut_places(len(data), capacity)):
                    rows.append(row)
                    found.append((piece, start, length, zlib.crc32(data[start : start + length])))
            own = batch.column(0).take(pa.array(rows, pa.int32()))
            columns = zip(*found) if found else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [own, *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", *names]
            )

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, PIECES
    )


class OpenBins:
    """Open sequences of one task, found by free space."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN):
        self.capacity, self.most = capacity, most
        self.bits, self.count, self.made = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        number = self.by_space[space].pop()
        if not self.by_space[space]:
            self.bits &= ~(1 << space)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence number, offset) for a piece of ``length`` ids."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} ids cannot be placed in {self.capacity}")
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.by_space[left].append(number)
            self.bits |= 1 << left
            self.count += 1
            if self.count > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - space


def packed(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, its place there.

    Pieces are stored, counted and dealt to tasks by a hash, which also fixes the order in which a
    task meets them; a repeated task therefore packs alike. Of each ``RUN`` pieces that arrive the
    longest are placed first, so that short ones fill what they leave. Offsets leave no gaps from 0 on.
    Repeated rows are packed one by one. No pieces give no rows.
    """
    pieces = stored(pieces, "pieces")
    tasks = max(1, math.ceil(pieces.count() / task_pieces))
    order = F.xxhash64("doc_id", "piece", "length", "ids_crc32")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        first = TaskContext.get().partitionId() << TASK_NUMBERS
        for batch in batches:
            for start in range(0, batch.num_rows, RUN):
                run = batch.slice(start, RUN)
                lengths = run.column("length").to_numpy()
                numbers, offsets = np.empty((2, len(lengths)), np.int64)
                for i in np.argsort(-lengths, kind="stable"):
                    numbers[i], offsets[i] = bins.place(int(lengths[i]))
                yield pa.RecordBatch.from_arrays(
                    [*run.columns, pa.array(numbers + first), pa.array(offsets)],
                    [*run.schema.names, "sequence_id", "offset"],
                )

    dealt = pieces.repartition(tasks, order).sortWithinPartitions(order, "doc_id", "piece", "length", "ids_crc32")
    return dealt.mapInArrow(pack, PLACED)
