"""Token ids packed into fixed-length rows, best fit decreasing.

A task tokenises its documents, cuts those over `length` tokens into pieces without loss,
and packs each block of about `block_tokens` tokens: pieces in falling size go to the open
row with the least room that still fits, found by descending a segment tree over the
capacities 0 to `length`. Nothing is shuffled, and a task holds one block.

A packed row: `pack_id`, `n_tokens`, `input_ids` (little-endian ids, padded with `pad`),
`position_ids` (same type, restarting at every piece), `cu_seqlens` (0, then the running
lengths), `doc_ids` and `doc_starts` (each piece's document and its first token's place in that
document). Ids take two bytes where the vocabulary allows it, else four.

Each document ends with the `eos` id, so an empty or null text is a piece of one token
and nothing is lost. The ids are those of the public vocabulary alone: control strings in
a text are ordinary text. Repeated rows are packed each; a null id stays null; very long
documents become many pieces; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.text import keep_columns

#: The file of the public byte-level vocabulary, its free id, and its word pattern: fixed values.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOS = 50256
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LENGTH = 2048
BLOCK_TOKENS = 1 << 22
#: Words whose ids a task remembers.
MEMORY = 200_000
ROWS_OUT = 256


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def id_type(vocabulary_size: int, length: int) -> str:
    return "<u2" if max(vocabulary_size, length) <= 1 << 16 else "<u4"


class WordIds:
    """Ids of a text as bytes, word by word with a memory of words seen.

    The pattern always cuts before a single space that a visible character follows, so cutting at
    spaces first and encoding each part with its space gives the ids of the whole text;
    a text with two spaces in a row, or a space at its end, is encoded whole.
    """

    def __init__(self, ranks: dict[bytes, int], kind: str):
        import tiktoken

        self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.kind = kind
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if "  " in text or text.endswith(" "):
            return np.array(self.encode(text), self.kind).tobytes()
        head, *rest = text.split(" ")
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        first = np.array(self.encode(head), self.kind).tobytes()
        out = list(map(known.get, rest))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    word = rest[i]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(self.encode(" " + word), self.kind).tobytes()
                    out[i] = found
        return first + b"".join(out)


class RoomTree:
    """Open rows by the room they have left; the least room of at least `size` is found in log(length) steps."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.open = bytearray(2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.width
        while node and not self.open[node]:
            self.open[node] = 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The row with the least room of at least `size`, and that room; it is taken out."""
        opened, node = self.open, size + self.width
        if not opened[node]:
            # Up to the first right-hand subtree that has something, then down its left edge.
            while node > 1 and (node & 1 or not opened[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if opened[2 * node] else 2 * node + 1
        room = node - self.width
        row = self.rows[room].pop()
        if not self.rows[room]:
            opened[node] = 0
            node >>= 1
            while node and not (opened[2 * node] or opened[2 * node + 1]):
                opened[node] = 0
                node >>= 1
        return row, room


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece indices; every size is between 1 and `length`."""
    tree, rows = RoomTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            row, room = len(rows), length
            rows.append([])
        else:
            row, room = found
        rows[row].append(i)
        if room - sizes[i]:
            tree.put(room - sizes[i], row)
    return rows


def _pack(pieces: list[tuple], first_id: int, length: int, kind: str, pad: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of `pieces` (document, start, ids)."""
    width = np.dtype(kind).itemsize
    count = np.arange(length, dtype=kind)
    rows = best_fit_decreasing([len(p[2]) // width for p in pieces], length)
    for at in range(0, len(rows), ROWS_OUT):
        out: list[tuple] = []
        for k, row in enumerate(rows[at : at + ROWS_OUT], at):
            held = [pieces[i] for i in row]
            lengths = [len(p[2]) // width for p in held]
            total = sum(lengths)
            ids = b"".join(p[2] for p in held) + np.full(length - total, pad, kind).tobytes()
            places = b"".join(count[:n].tobytes() for n in lengths) + bytes(width * (length - total))
            ends = [0, *np.cumsum(lengths).tolist()]
            out.append((first_id + k, total, ids, places, ends, [p[0] for p in held], [p[1] for p in held]))
        names = ["pack_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), None, pa.list_(pa.int64())]
        columns = [pa.array(c, k) if k else list(c) for c, k in zip(zip(*out), kinds)]
        columns[5] = pa.array(columns[5], pa.list_(pieces[0][3]))
        yield pa.record_batch(columns, names)


def pack_tokens(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    eos: int = EOS,
    pad: int = EOS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Packed rows of every document of `df` (`doc_id`, `text`); `vocabulary` is read where the driver runs."""
    with open(vocabulary, "rb") as file:
        data = file.read()
    shared = df.sparkSession.sparkContext.broadcast(data)  # the vocabulary file: under 2 MB
    kind = id_type(max(eos, pad) + 1, length)
    id_sql = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode: Callable[[str], bytes] = WordIds(read_ranks(shared.value), kind)
        width, end = np.dtype(kind).itemsize, np.array([eos], kind).tobytes()
        next_id = TaskContext.get().partitionId() << 33
        pieces, held = [], 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for doc, text in zip(ids.to_pylist(), texts):
                tokens = encode(text.as_py() or "") + end
                for at in range(0, len(tokens), length * width):
                    pieces.append((doc, at // width, tokens[at : at + length * width], ids.type))
                held += len(tokens) // width
                if held >= block_tokens:
                    yield from _pack(pieces, next_id, length, kind, pad)
                    next_id += len(pieces)
                    pieces, held = [], 0
        if pieces:
            yield from _pack(pieces, next_id, length, kind, pad)

    schema = (
        "pack_id bigint, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
        f"doc_ids array<{id_sql}>, doc_starts array<bigint>"
    )
    return keep_columns(df, ["doc_id", "text"]).mapInArrow(run, schema)


def unpacked(packed: DataFrame, kind: str = "<u2") -> DataFrame:
    """The pieces again: `doc_id, start, ids` with `ids` an array of token ids."""

    def run(batches):
        for batch in batches:
            docs, starts, ids = [], [], []
            for row in batch.to_pylist():
                tokens = np.frombuffer(row["input_ids"], kind)
                for d, s, a, b in zip(row["doc_ids"], row["doc_starts"], row["cu_seqlens"], row["cu_seqlens"][1:]):
                    docs.append(d)
                    starts.append(s)
                    ids.append(tokens[a:b].astype(np.int32))
            yield pa.record_batch(
                [pa.array(docs, batch.schema.field("doc_ids").type.value_type), pa.array(starts, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "start", "ids"],
            )

    element = packed.schema["doc_ids"].dataType.elementType.simpleString()
    return packed.mapInArrow(run, f"doc_id {element}, start bigint, ids array<int>")
