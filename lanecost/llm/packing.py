"""Cost-balanced packing of tokenised documents into fixed-size sequences.

Every document becomes its token ids and an end id. Whole multiples of the
capacity are sequences of their own; what is left of each document is a piece.
Pieces of one buffer are packed by descending length: a piece costs
``linear * n + quadratic * n**2`` (a document attends to itself only) and goes to
the sequence of lowest cost that has room for it. A buffer opens
``ceil(tokens / capacity)`` sequences; a piece that no sequence can hold whole is
cut over the cheapest ones with room, so a buffer wastes less than one sequence.

Tokenising and packing are one narrow stage: nothing is shuffled, a task holds one
buffer, and a lost task is simply run again (sequence ids depend on the partition
and the order of its rows only).
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from lanecost.llm.util import slices


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str | None = None, special: tuple[tuple[str, int], ...] = ()):
    """text -> little-endian uint32 ids, from a ``tokenizers`` JSON file or, several
    times faster, from a ``.tiktoken`` rank file of the same vocabulary. A rank file names
    no special tokens: ``special`` are the strings that are one id, as the JSON file has them."""
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    enc = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    return lambda text: np.asarray(enc.encode_to_numpy(text, allowed_special="all", disallowed_special=()), dtype="<u4")


def balance(lengths: list[int], capacity: int, linear: float, quadratic: float) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """Pack pieces: (number of sequences, [(piece, start in piece, length, sequence,
    offset)]). Descending lengths, ties by position; the cheapest sequence with
    room takes the piece; without one, the cheapest with any room takes a part."""
    total = sum(lengths)
    n = -(-total // capacity)
    cost = np.zeros(n)
    room = np.full(n, capacity, dtype=np.int64)
    out = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[i]
        while left:
            at = int(np.argmin(np.where(room >= left, cost, np.inf)))
            if room[at] < left:
                at = int(np.argmin(np.where(room > 0, cost, np.inf)))
            take = min(left, int(room[at]))
            out.append((i, start, take, at, capacity - int(room[at])))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return n, out


def special_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """(string, id) of the added tokens of a ``tokenizers`` JSON file."""
    with open(path, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"])


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str | None = None,
                   special: tuple[tuple[str, int], ...] = (), id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = 1024, end_id: int = 0, linear: float = 1.0,
                   quadratic: float = 1.0 / 2048, buffer_tokens: int = 1 << 19) -> DataFrame:
    """One row per piece: the id, ``start`` (ids of the document before it),
    ``length``, ``ids`` (binary, little-endian uint32), ``doc_tokens``,
    ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    A null text is empty: its document is the end id alone. Repeated rows are
    documents of their own; a null id stays null; texts of any length are tokenised
    whole; other columns are ignored, whatever their names; an empty table gives no rows. ``buffer_tokens`` bounds what a task packs at once.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    most = max(capacity, buffer_tokens)

    def run(batches):
        encode = encoder(tokenizer, pattern, special)
        seq = TaskContext.get().partitionId() << 36
        end = np.array([end_id], dtype="<u4")
        rows: list[tuple] = []
        held: list[tuple] = []   # (doc id, start, ids, doc tokens) of pieces waiting
        waiting = 0
        id_arrow = None

        def flush():
            nonlocal seq, waiting
            n, placed = balance([len(p[2]) for p in held], capacity, linear, quadratic)
            for i, start, length, at, offset in placed:
                doc, first, ids, tokens = held[i]
                rows.append((doc, first + start, length, ids[start:start + length].tobytes(), tokens, seq + at, offset))
            seq += n
            held.clear()
            waiting = 0

        def emit():
            cols = list(zip(*rows)) or [()] * 7
            types = [id_arrow, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=schema.names)
            rows.clear()
            return out

        def typed():
            nonlocal id_arrow
            for b in batches:
                id_arrow = b.schema.field(0).type
                yield b

        for doc_ids, texts in slices(typed(), 1):
            seen: dict[str, np.ndarray] = {}
            for doc, text in zip(doc_ids, texts):
                text = text or ""
                ids = seen.get(text)
                if ids is None:
                    ids = seen[text] = np.concatenate([encode(text), end])
                tokens = len(ids)
                whole = tokens - tokens % capacity
                for start in range(0, whole, capacity):
                    rows.append((doc, start, capacity, ids[start:start + capacity].tobytes(), tokens, seq, 0))
                    seq += 1
                if whole < tokens:
                    held.append((doc, whole, ids[whole:], tokens))
                    waiting += tokens - whole
                if waiting >= most:
                    flush()
            if len(rows) >= 2000:
                yield emit()
        if held:
            flush()
        if rows:
            yield emit()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
