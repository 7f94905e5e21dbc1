"""Token output in training order: a keyed permutation deals sequences to fixed-stride shards.

Texts become token ids, an end token after each, cut into sequences of `length` ids; the last
one of a text is filled up with end tokens. Every sequence has a dense number (tasks count
theirs, an offset per task makes them global), and a keyed Feistel network, walked until it
falls below the number of sequences, turns it into its slot. Shard s holds the slots from
s * per_shard on, in order, each record of the same size, so any slot is read by one seek.

Rules for odd input: null and empty texts give no sequences; strings of special tokens are
ordinary text; texts of any length are encoded whole; repeated rows give sequences of their
own; columns other than doc_id and text are ignored; an empty table gives no sequences.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe import UNSAFE_SPACE, Recent
from tagloom.llm.common import id_text, table
from tagloom.session import new_folder

LENGTH = 512
PER_SHARD = 16_384
KEY = 20_240_229
ROUNDS = 6
CACHED_WORDS = 300_000
CACHED_LENGTH = 40


class Encoder:
    """Ids of texts by a file of ranks, and a table of words already encoded."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.ordinary = coding.encode_ordinary
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.words = Recent(CACHED_WORDS)

    def _ids(self, text: str) -> bytes:
        return np.array(self.ordinary(text), self.kind).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, as little-endian numbers."""
        if not text:
            return b""
        if UNSAFE_SPACE.search(text):
            return self._ids(text)
        first, *rest = text.split(" ")
        parts = [self._ids(first)]
        for word in rest:
            found = self.words.young.get(word)
            if found is None:
                found = self.words.get(word)
                if found is None:
                    found = self._ids(" " + word)
                    if len(word) <= CACHED_LENGTH:
                        self.words.put(word, found)
            parts.append(found)
        return b"".join(parts)


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def sequences(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """task, place (dense in its task), doc_id, part, n_tokens (without filling), record."""
    path = path or default_path()

    def run(batches):
        from pyspark import TaskContext

        task, place = TaskContext.get().partitionId(), 0
        model = load(path)
        wide = model.kind.itemsize
        end = np.array([model.end], model.kind).tobytes()
        names = ["task", "place", "doc_id", "part", "n_tokens", "record"]
        for batch in batches:
            ids, parts, sizes, records = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = model.encode(text.as_py())
                if not data:
                    continue
                data += end
                for part, at in enumerate(range(0, len(data), length * wide)):
                    record = data[at : at + length * wide]
                    ids.append(doc)
                    parts.append(part)
                    sizes.append(len(record) // wide)
                    records.append(record + end * (length - len(record) // wide))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, task, np.int64)),
                    pa.array(np.arange(place, place + n, dtype=np.int64)),
                    pa.array(ids, pa.int64()),
                    pa.array(parts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(records, pa.binary()),
                ],
                names,
            )
            place += n

    schema = "task long, place long, doc_id long, part long, n_tokens long, record binary"
    return id_text(docs).mapInArrow(run, schema)


def permute(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of numbers below n: a bijection of 0..n-1 that the key decides."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64) for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ k) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return left << np.uint64(half) | right

    out = once(numbers.astype(np.uint64))
    while True:
        outside = np.flatnonzero(out >= np.uint64(n))
        if not len(outside):
            return out.astype(np.int64)
        out[outside] = once(out[outside])


def in_training_order(
    docs: DataFrame,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
    path: str | None = None,
) -> DataFrame:
    """slot, shard, offset, doc_id, part, n_tokens, record: a partition per shard, by slot.

    The sequences are written once to the shared folder. Offsets are one number per task.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "sequences")
    made = sequences(docs, length, path)
    made.write.option("compression", "zstd").parquet(folder)
    made = spark.read.schema(made.schema).parquet(folder)
    counts = sorted((r["task"], r["count"]) for r in made.groupBy("task").count().collect())
    n = sum(c for _, c in counts)
    upto = np.cumsum([0, *[c for _, c in counts]])
    offsets = np.zeros(max([t for t, _ in counts], default=0) + 1, np.int64)
    for (task, _), offset in zip(counts, upto):
        offsets[task] = offset
    sent = spark.sparkContext.broadcast(offsets)

    def run(batches):
        for batch in batches:
            number = sent.value[batch.column(0).to_numpy()] + batch.column(1).to_numpy()
            slot = permute(number, n, key)
            wide = len(batch.column(5)[0].as_py()) if batch.num_rows else 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(slot),
                    pa.array((slot // per_shard).astype(np.int32)),
                    pa.array(slot % per_shard * wide),
                    *batch.columns[2:],
                ],
                ["slot", "shard", "offset", "doc_id", "part", "n_tokens", "record"],
            )

    schema = "slot long, shard int, offset long, doc_id long, part long, n_tokens long, record binary"
    dealt = made.mapInArrow(run, schema)
    shards = max(1, -(-n // per_shard))
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write a file per shard under a shared folder; shard, path, n_records, crc32.

    A shard is written under another name and then renamed, so a file that is there is whole;
    a task that runs again leaves such a file alone.
    """

    def run(batches):
        from pyspark import TaskContext
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        shard, held, crc, n, out, temporary = None, None, 0, 0, None, ""
        for batch in batches:
            for own, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard is None:
                    shard = own
                    held = f"{root}/shard-{shard:06d}.bin"
                    temporary = f"{held}.{TaskContext.get().taskAttemptId()}"
                    there = store.get_file_info(held).type != fs.FileType.NotFound
                    out = None if there else store.open_output_stream(temporary)
                elif own != shard:
                    raise ValueError("a partition must hold one shard")
                crc, n = zlib.crc32(record, crc), n + 1
                if out:
                    out.write(record)
        if out:
            out.close()
            store.move(temporary, held)
        if shard is not None:
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": held, "n_records": n, "crc32": crc}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("crc32", pa.int64())]),
            )

    return ordered.select("shard", "record").mapInArrow(
        run, "shard int, path string, n_records long, crc32 long"
    )


def read_records(path: str, first: int, n: int, length: int = LENGTH, kind: str = "<u2") -> np.ndarray:
    """n records of a shard from the given one on, by one seek."""
    stride = length * np.dtype(kind).itemsize
    with open(path, "rb") as f:
        f.seek(first * stride)
        return np.frombuffer(f.read(n * stride), kind).reshape(-1, length)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_training_order(table(spark, sf_dir, "documents"))
