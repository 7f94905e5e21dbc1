"""What the operators leave under the shared folder."""

from __future__ import annotations

import random
from pathlib import Path

from tagloom.llm import pii
from tagloom.llm.common import numbered
from tagloom.session import scratch_root


def _scratch_bytes(spark) -> int:
    root = Path(scratch_root(spark).removeprefix("file://"), "tagloom")
    return sum(p.stat().st_size for p in root.rglob("*.parquet"))


def _texts(n: int) -> list[str]:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    return [" ".join(rng.choices(words, k=200)) + f" write to a{i}@b.org" for i in range(n)]


def test_redaction_writes_no_texts(spark):
    texts = _texts(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    before = _scratch_bytes(spark)
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {i: t.replace(f"a{i}@b.org", "<EMAIL>") for i, t in enumerate(texts)}
    assert _scratch_bytes(spark) - before < sum(map(len, texts)) / 20


def test_numbered_rows_are_packed(spark):
    texts = _texts(400)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = numbered(docs)
    assert sorted((r["doc_id"], r["text"]) for r in rows.collect()) == list(enumerate(texts))
    assert len({r["row"] for r in rows.collect()}) == len(texts)
    assert all(name.endswith(".zstd.parquet") for name in rows.inputFiles())
