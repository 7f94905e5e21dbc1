"""Byte-level BPE: encoding by a queue of merge ranks over a linked list of symbols, and decoding.

Rules for odd input: a null text is an empty one (no tokens, empty decoded text); texts of
any length are encoded whole; repeated rows each give a row; columns other than `doc_id` and
`text` are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import gc
import hashlib
import json
from array import array
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.common import by_document, id_text, kept, table

#: How texts are cut before merging (the pattern of the public byte-level BPE).
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Where cutting at a single space first would cut a run of white space differently.
UNSAFE_SPACE = regex.compile(r"\p{White_Space} (?:\p{White_Space}|\Z)")

#: Entries that each generation of a worker's tables holds.
CACHED_PIECES = 200_000
CACHED_WORDS = 100_000
#: Longer pieces are merged each time.
CACHED_LENGTH = 40
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones stand for themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Recent:
    """A table that forgets what has not been asked for lately: a full generation grows old."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Bpe:
    """Vocabulary and merges of a tokenizer file, and tables of pieces already merged."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        to_byte = {letter: b for b, letter in enumerate(letters)}
        self.byte_ids = [vocab[letter] for letter in letters]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            key = vocab[a] << ID_BITS | vocab[b]
            self.merges.setdefault(key, rank << ID_BITS | vocab[a + b])
        self.bytes_of = {i: bytes(to_byte[c] for c in word) for word, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: word.encode() for word, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
            if self.added
            else None
        )
        self.pieces = regex.compile(PIECES).findall
        self.merged = Recent(CACHED_PIECES)
        self.spaced = Recent(CACHED_WORDS)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece: the lowest rank merges first, the leftmost of equal ranks."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        get = self.merges.get
        pair = [-1] * n  # what the symbol at i and the next one merge to, under its rank
        heap = []
        for i in range(n - 1):
            found = get(ids[i] << ID_BITS | ids[i + 1])
            if found is not None:
                pair[i] = found
                heap.append(found >> ID_BITS << 40 | i)
        if not heap:
            return ids
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFFFF
            found = pair[i]
            if found < 0 or found >> ID_BITS != entry >> 40:
                continue  # stale: one of the two symbols has changed
            j = after[i]
            ids[i] = new = found & ID_MASK
            ids[j] = pair[j] = pair[i] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = get(new << ID_BITS | ids[k])
                if found is not None:
                    pair[i] = found
                    heappush(heap, found >> ID_BITS << 40 | i)
            h = before[i]
            if h >= 0:
                pair[h] = -1
                found = get(ids[h] << ID_BITS | new)
                if found is not None:
                    pair[h] = found
                    heappush(heap, found >> ID_BITS << 40 | h)
        return [i for i in ids if i >= 0]

    def _piece(self, piece: str) -> bytes:
        found = self.merged.get(piece)
        if found is None:
            found = array("I", self.merge(piece.encode())).tobytes()
            if len(piece) <= CACHED_LENGTH:
                self.merged.put(piece, found)
        return found

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pieces(text)))

    def _word(self, word: str) -> bytes:
        """Ids of a space and the text up to the next one."""
        found = self.spaced.get(word)
        if found is None:
            found = self._pieces(" " + word)
            if len(word) <= CACHED_LENGTH:
                self.spaced.put(word, found)
        return found

    def _plain(self, text: str) -> bytes:
        if UNSAFE_SPACE.search(text):
            return self._pieces(text)
        first, *words = text.split(" ")
        get = self.spaced.young.get
        parts = [self._pieces(first)]
        for word in words:
            found = get(word)
            if found is None:
                found = self._word(word)
                get = self.spaced.young.get
            parts.append(found)
        return b"".join(parts)

    def encode(self, text: str | None) -> array:
        """Token ids of a whole text, as unsigned 32-bit integers."""
        ids = array("I")
        if not text:
            return ids
        parts = self.split_added(text) if self.split_added else [text]
        for part in parts:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                ids.frombytes(self._plain(part))
        return ids

    def decode(self, ids) -> str:
        """The text of token ids: their strings joined; bytes that are no text become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _table(path: str) -> str:
    return f"bpe {path}"


def load(path: str) -> Bpe:
    """The tokenizer of a file, kept by each worker until another operator's task begins there."""

    def read() -> Bpe:
        model = Bpe(path)
        gc.freeze()  # the vocabulary and merges stay; no need to walk them at each collection
        return model

    return kept(_table(path), read)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and `ids`, the token ids of every whole text."""
    path = path or default_path()
    return by_document(
        id_text(docs), lambda: lambda text: (load(path).encode(text).tolist(),), "ids array<long>",
        holds=_table(path),
    )


def decode(encoded: DataFrame, path: str | None = None, keep: str = "doc_id") -> DataFrame:
    """`keep` and `text` from the column `ids`."""
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    path = path or default_path()

    def run(batches):
        for batch in batches:
            model = load(path)
            texts = [model.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], [keep, "text"]
            )

    schema = StructType([encoded.schema[keep], StructField("text", StringType())])
    return encoded.select(keep, "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every text; doc_id, number of tokens, and digests of ids and decoded text."""
    path = path or default_path()

    def row():
        model = load(path)

        def one(text):
            ids = model.encode(text)
            return (
                len(ids),
                hashlib.sha256(little_endian(ids)).hexdigest(),
                hashlib.sha256(model.decode(ids).encode()).hexdigest(),
            )

        return one

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_document(id_text(docs), row, schema, holds=_table(path))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
