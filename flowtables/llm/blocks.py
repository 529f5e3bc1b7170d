"""Documents in packed blocks, and an exchange that tells which keys occur in several documents.

The two operators that remove repeats work on the same frame: a block holds some megabytes of
whole documents, tasks turn a block into arrays, and only packed arrays are shuffled. Blocks
are written once to shared storage, so a retried task sees the same documents under the same
number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from flowtables.llm.common import id_text, pack, partitions_for, unpack
from flowtables.session import scratch_path

#: Bytes of text in a block; a longer document has a block of its own.
BLOCK_BYTES = 4 << 20
_BLOCKS = "block long, doc_ids array<long>, sizes binary, data binary"
#: Stands for a null id, which counts as larger than all others.
LAST = np.int64(2**63 - 1)


@dataclass
class Block:
    """Documents one after the other: their ids, and where each begins and ends in the bytes."""

    ids: list[int | None]
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    @property
    def order(self) -> np.ndarray:
        """Ids for comparison."""
        return np.array([LAST if i is None else i for i in self.ids], np.int64)


def stage_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents as blocks and return them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            sizes = np.array([len(t) for t in texts], np.int64)
            row = [[number], [ids], [pack(sizes)], [pack(b"".join(texts))]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()))], names=["block", "doc_ids", "sizes", "data"])

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py().encode()
                if ids and size + len(text) > BLOCK_BYTES:
                    yield block()
                    number += 1
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if ids:
            yield block()

    path = scratch_path(docs.sparkSession, "blocks")
    id_text(docs, id_col, text_col).mapInArrow(run, _BLOCKS).write.parquet(path)
    return docs.sparkSession.read.schema(_BLOCKS).parquet(path)


def open_block(table: pa.Table | pa.RecordBatch, i: int = 0) -> Block:
    sizes = unpack(table["sizes"][i].as_py(), np.int64)
    ends = np.cumsum(sizes)
    return Block(table["doc_ids"][i].as_py(), ends - sizes, ends, unpack(table["data"][i].as_py(), np.uint8))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bucket of a mixed 64-bit key; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def part_slices(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the non-empty parts of ascending keys."""
    of = part_of(keys, parts)
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    return list(zip(of[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(of)).tolist())) if len(of) else []


def distinct_keys(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct keys, which of them have more than one document, and each key's place. ``docs`` ascends."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    last = np.append(first[1:] - 1, len(keys) - 1) if len(keys) else first
    place = np.empty(len(keys), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    return ordered[first], docs[order[first]] != docs[order[last]], place


def shared_keys(blocks: DataFrame, keys_of: Callable[[Block], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Which distinct keys of a block occur in two documents: (block, part, live bits).

    ``keys_of`` gives the ascending distinct mixed keys of a block and whether the block has
    each in several documents. A block sends a key once, however often it has it. 40 bits of
    a key are compared within a part, and parts grow in number, not in size: a key without a
    partner is taken for a shared one about once in half a million, which costs work and
    never changes a result.
    """
    parts = partitions_for(blocks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                keys, several = keys_of(open_block(batch, i))
                low, high = (keys & np.uint64(0xFFFFFFFF)).astype("<u4"), (keys >> np.uint64(32) & np.uint64(255)).astype(np.uint8)
                rows = [(part, batch["block"][i].as_py(), b - a, low[a:b].tobytes() + high[a:b].tobytes() + np.packbits(several[a:b]).tobytes()) for part, a, b in part_slices(keys, parts)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["part", "block", "n", "keys"])

    def reply(table: pa.Table) -> pa.Table:
        counts = table["n"].to_numpy()
        data = table["keys"].to_pylist()
        keys = np.concatenate([np.frombuffer(d, "<u4", n).astype(np.uint64) | np.frombuffer(d, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32) for d, n in zip(data, counts)])
        several = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8, offset=5 * n), count=n) for d, n in zip(data, counts)]).astype(bool)
        order = np.argsort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]]))
        sizes = np.diff(np.append(first, len(keys)))
        live = np.empty(len(keys), bool)
        live[order] = np.repeat((sizes > 1) | np.logical_or.reduceat(several[order], first), sizes)
        ends = np.cumsum(counts)
        return pa.table({"block": table["block"], "part": table["part"], "live": pa.array([np.packbits(live[e - n : e]).tobytes() for e, n in zip(ends, counts)], pa.binary())})

    sent = blocks.mapInArrow(send, "part int, block long, n int, keys binary")
    return sent.groupBy("part").applyInArrow(reply, "block long, part int, live binary")


def live_keys(keys: np.ndarray, replies: pa.Table, parts: int) -> np.ndarray:
    """For the ascending keys of a block: whether other documents have them, by the replies."""
    live = np.zeros(len(keys), bool)
    by_part = dict(zip(replies["part"].to_pylist(), replies["live"].to_pylist()))
    for part, a, b in part_slices(keys, parts):
        live[a:b] = np.unpackbits(np.frombuffer(by_part[part], np.uint8), count=b - a)
    return live
