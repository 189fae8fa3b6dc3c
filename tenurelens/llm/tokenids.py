"""Token ids in training order: tokenise, cut to sequences, permute, write fixed-stride shards.

Every sequence has an ordinal 0..N-1: the rows of the checkpointed token table are counted per
partition, and a task numbers its rows from its partition's offset. A keyed Feistel network
over the next even number of bits permutes the ordinals; values outside 0..N-1 are fed back
(cycle-walking), so slots are exactly 0..N-1, each once, and any slot can be computed, or
undone, on its own. Slot s lies in shard s // per_shard at stride s % per_shard: a reader that
stopped at a slot seeks to it.

One shuffle moves the ids to their shards; slots are uniform, so shards are of equal size
whatever the sources look like.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.llm import batches
from tenurelens.llm.scratch import cut

TOKENIZERS = "/opt/tokenizers"
ROUNDS = 6
#: pieces that a worker remembers
CACHE = 150_000

#: white space beyond ASCII, as UTF-8: texts with it are not cut into pieces
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class Vocabulary(NamedTuple):
    """Ranks of a byte-level BPE and its pattern; the id after the last rank ends a text."""

    ranks: dict[bytes, int]
    pattern: str

    @property
    def end(self) -> int:
        return max(self.ranks.values()) + 1

    @property
    def kind(self) -> type:
        return np.uint16 if self.end < 1 << 16 else np.uint32


def vocabulary(folder: str = TOKENIZERS, file: str = "byte_bpe_50k.tiktoken") -> Vocabulary:
    """Read on the driver; tasks get it by broadcast and need no such folder."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", os.path.join(folder, "__init__.py"))
    names = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(names)
    with open(os.path.join(folder, file), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Vocabulary(ranks, names.PATTERN)


class Encoder:
    """Encodes slices of texts, each distinct piece once.

    A piece is a run of ASCII white space with what follows up to the next such run. The
    pattern never joins a character with white space after it, so a text's ids are the ids of
    its pieces.
    """

    def __init__(self, vocab: Vocabulary):
        import tiktoken

        self.encode = tiktoken.Encoding(
            "ranks", pat_str=vocab.pattern, mergeable_ranks=vocab.ranks, special_tokens={}
        ).encode_ordinary
        self.kind = vocab.kind
        self.known: dict[int, bytes] = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of every text."""
        whole = data.tobytes()
        plain = [
            t for t in range(len(offsets) - 1) if WIDE_SPACE.search(whole, offsets[t], offsets[t + 1])
        ] if WIDE_SPACE.search(whole) else []
        space = ~batches.NOT_SPACE[data]
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(opens)
        end = np.r_[start[1:], len(data)]
        hashes, first, which = np.unique(
            batches.span_hashes(data, start, end), return_index=True, return_inverse=True
        )
        if len(self.known) > CACHE:
            self.known.clear()
        pieces = []
        for h, s, e in zip(hashes.tolist(), start[first].tolist(), end[first].tolist(), strict=True):
            ids = self.known.get(h)
            if ids is None:
                ids = np.array(self.encode(whole[s:e].decode("utf-8", "replace")), self.kind).tobytes()
                self.known[h] = ids
            pieces.append(ids)
        width = np.dtype(self.kind).itemsize
        sizes = np.array([len(p) for p in pieces], np.int64) // width
        arena = np.frombuffer(b"".join(pieces), self.kind)
        begins = np.cumsum(sizes) - sizes
        many = sizes[which]
        total = np.r_[0, np.cumsum(many)]
        ids = arena[np.repeat(begins[which] - total[:-1], many) + np.arange(total[-1])]
        cuts = total[np.searchsorted(start, offsets)]
        out = [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for t in plain:
            text = whole[offsets[t] : offsets[t + 1]].decode("utf-8", "replace")
            out[t] = np.array(self.encode(text), self.kind).tobytes()
        return out


def tokenise(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """doc_id and packed ids, with the end id, of every text that has a token."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        end = np.array([shared.value.end], shared.value.kind).tobytes()
        for part in parts:
            for first, data, offsets in batches.slices(part.column(1)):
                ids = [x + end if x else None for x in encoder(data, offsets)]
                rows = part.column(0).slice(first, len(ids))
                got = pa.record_batch([rows, pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                yield got.filter(got.column(1).is_valid())

    return batches.bounded(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def permute(x: np.ndarray, n: int, key: int, undo: bool = False) -> np.ndarray:
    """The keyed bijection of 0..n-1, or its inverse, at the positions x."""
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = batches.mix(np.uint64(key & 0xFFFFFFFFFFFFFFFF) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.asarray(x, np.uint64).copy()
    walking = np.ones(len(out), dtype=bool)
    while walking.any():
        left, right = out[walking] >> half, out[walking] & mask
        if undo:
            for k in keys[::-1]:
                left, right = right ^ (batches.mix(left + k) & mask), left
        else:
            for k in keys:
                left, right = right, left ^ (batches.mix(right + k) & mask)
        out[walking] = (left << half) | right
        walking = out >= np.uint64(n)
    return out.astype(np.int64)


def training_order(
    docs: DataFrame,
    vocab: Vocabulary,
    length: int = 512,
    per_shard: int = 32768,
    key: int = 20,
) -> DataFrame:
    """One row per sequence: slot, shard, stride, doc_id, part, n_tokens, ids (packed).

    A document is cut into sequences of `length` ids, the last one shorter; sequences never mix
    documents. Null and empty texts have no sequence, and an empty table gives an empty result.
    Repeated rows, also of one doc_id, have sequences of their own; a null doc_id stays null.
    Rows of a shard lie in one partition, sorted by slot. The order follows the order of the
    rows in the input files, so the same files and split size give the same order.
    """
    width = np.dtype(vocab.kind).itemsize
    step = length * width
    tokens = cut(tokenise(docs, vocab))
    many = F.ceil(F.octet_length("ids") / step)
    # one number per partition, so the driver's share grows with partitions, not rows
    counts = dict(
        tokens.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(many).cast("long")).toLocalIterator()
    )
    starts, n = {}, 0
    for p in sorted(counts):
        starts[p] = n
        n += counts[p]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts.get(TaskContext.get().partitionId(), 0)
        for part in parts:
            rows, pieces, nth = [], [], []
            for row, ids in enumerate(part.column(1).to_pylist()):
                for i, begin in enumerate(range(0, len(ids), step)):
                    rows.append(row)
                    nth.append(i)
                    pieces.append(ids[begin : begin + step])
            slots = permute(np.arange(at, at + len(rows)), n, key)
            at += len(rows)
            yield pa.record_batch(
                [
                    pa.array(slots, pa.int64()),
                    pa.array(slots // per_shard, pa.int64()),
                    pa.array(slots % per_shard, pa.int64()),
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(nth, pa.int64()),
                    pa.array([len(p) // width for p in pieces], pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                names=["slot", "shard", "stride", "doc_id", "part", "n_tokens", "ids"],
            )

    placed = tokens.mapInArrow(
        run, "slot long, shard long, stride long, doc_id long, part long, n_tokens long, ids binary"
    )
    shards = max(1, -(-n // per_shard))
    return placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")


def write_shards(order: DataFrame, target: str, vocab: Vocabulary, length: int = 512) -> DataFrame:
    """Write shard-<number>.bin files of fixed stride under a URI; (shard, first_slot, n) of each.

    Short sequences are filled with the end id. `target` is any URI that pyarrow can open and
    all executors reach. A file appears under its name only when it is complete, and a task
    that is run again writes the same bytes, so a lost executor does no harm.
    """
    fill = np.array([vocab.end], vocab.kind).tobytes()
    stride = length * len(fill)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root)
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple[int, int, int]] = []
        shard, sink, draft = None, None, ""

        def close() -> None:
            if sink is not None:
                sink.close()
                store.move(draft, f"{root}/shard-{shard:08d}.bin")

        for part in parts:
            for s, slot, ids in zip(*(part.column(c).to_pylist() for c in ("shard", "slot", "ids")), strict=True):
                if s != shard:
                    close()
                    shard, draft = s, f"{root}/.shard-{s:08d}.{attempt}"
                    sink = store.open_output_stream(draft)
                    done.append((s, slot, 0))
                sink.write(ids + fill * ((stride - len(ids)) // len(fill)))
                done[-1] = (s, done[-1][1], done[-1][2] + 1)
        close()
        yield pa.record_batch(
            [pa.array([d[i] for d in done], pa.int64()) for i in range(3)], names=["shard", "first_slot", "n"]
        )

    return cut(order.select("shard", "slot", "ids").mapInArrow(run, "shard long, first_slot long, n long"))


def read_shard(target: str, shard: int, kind: type, length: int = 512, first: int = 0) -> np.ndarray:
    """Sequences of one shard from stride `first` on, one row each."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(target)
    with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as source:
        source.seek(first * length * np.dtype(kind).itemsize)
        return np.frombuffer(source.read(), kind).reshape(-1, length)
