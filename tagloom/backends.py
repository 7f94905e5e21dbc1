"""Local model callables: deterministic stand-ins, and an exact token counter.

They let every job run and be checked without a network. A real model takes
their place as a callable with the same signature.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from hashlib import md5

import numpy as np

TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0d\x20]")


@lru_cache(maxsize=1 << 16)
def _bucket(token: str, dim: int) -> int:
    return int(md5(token.encode()).hexdigest()[:8], 16) % dim


class HashingEmbedder:
    """Token counts in hashed buckets, scaled to about unit length.

    Components are whole multiples of 1/4096, so dot products are exact in
    float64 and come out the same in every summation order.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: list[str]) -> list[list[float]]:
        return [self._vector(t) for t in texts]

    def _vector(self, text: str) -> list[float]:
        totals = [0] * self.dim
        for token, n in Counter(TOKEN.findall(text)).items():
            totals[_bucket(token, self.dim)] += n
        counts = np.array(totals, dtype=np.float64)
        length = np.sqrt(float((counts * counts).sum())) or 1.0
        return (np.floor(counts / length * 4096.0 + 0.5) / 4096.0).tolist()


class EchoGenerator:
    """Replies with the lines of the text in the prompt, as a numbered list."""

    def __call__(self, prompts: list[list[dict]], temperature: float, limits: list[int]) -> list[str]:
        return [self._reply(messages[-1]["content"]) for messages in prompts]

    @staticmethod
    def _reply(content: str) -> str:
        lines = content.split("\n\n", 1)[1].split("\n")
        return "\n".join(f"{i}. {line}" for i, line in enumerate(lines, 1))


class HashJudge:
    """Rates a prompt by its hash: one in five scores is above 50.

    About one reply in twenty has no score at temperature 0, about one in two
    hundred never has one; the others come in four shapes.
    """

    def __call__(self, prompts: list[list[dict]], temperature: float, limits: list[int]) -> list[str]:
        return [self._reply(messages[-1]["content"], temperature) for messages in prompts]

    @staticmethod
    def _reply(content: str, temperature: float) -> str:
        digest = md5(content.encode()).hexdigest()
        good, value, mute, shape = (int(digest[i : i + 4], 16) for i in (0, 4, 8, 12))
        if mute % 200 == 0 or (mute % 200 < 10 and temperature == 0):
            return "I cannot say."
        score = 51 + value % 50 if good % 5 == 0 else value % 51
        return [
            f"Score: {score}",
            f" {score}/100 ",
            f"{score}",
            f"The card was read.\nScore: {score} of 100",
        ][shape % 4]


class FailsByHash:
    """A model that refuses every call with one of certain inputs in it, but takes them alone."""

    def __init__(self, model, one_in: int = 7):
        self.model, self.one_in = model, one_in

    def __call__(self, items: list, *options) -> list:
        if len(items) > 1 and any(self._refused(item) for item in items):
            raise ConnectionError("refused")
        return self.model(items, *options)

    def _refused(self, item) -> bool:
        text = item if isinstance(item, str) else item[-1]["content"]
        return int(md5(text.encode()).hexdigest()[:8], 16) % self.one_in == 0


class TiktokenCounter:
    """Exact token counts of a named encoding; needs its vocabulary file on the executors."""

    def __init__(self, encoding: str = "cl100k_base"):
        self.encoding = encoding

    def __call__(self, texts: list[str]) -> list[int]:
        import tiktoken

        encoder = tiktoken.get_encoding(self.encoding)
        return [len(tokens) for tokens in encoder.encode_batch(texts)]
