"""Parameters of the jobs, resolved on the driver before a plan is built."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from tagloom import fixed


@dataclass(frozen=True)
class EmbedParams:
    local_model: bool = True
    local_limit: int = fixed.EMBED_MAX_TOKENS_LOCAL
    remote_limit: int = fixed.EMBED_MAX_TOKENS_REMOTE
    batch_size: int = 256
    attempts: int = 3
    wait: float = fixed.GENERATE_WAIT_SECONDS
    # Number of tasks that call the model at once; None means all cores where
    # the input has few splits, and its own splits otherwise.
    parallelism: int | None = None

    @property
    def token_limit(self) -> int:
        """Longest note that is kept."""
        return self.local_limit if self.local_model else self.remote_limit

    @property
    def truncate_tokens(self) -> int | None:
        """Truncation limit; texts for a remote model are never truncated."""
        return self.local_limit if self.local_model else None


@dataclass(frozen=True)
class ChatParams:
    max_tokens: int = fixed.CHAT_MAX_TOKENS
    buffer: int = fixed.CHAT_TOKEN_BUFFER
    batch_size: int = 32
    attempts: int = 3
    wait: float = fixed.GENERATE_WAIT_SECONDS
    parallelism: int | None = None  # as above; None means all cores


@dataclass(frozen=True)
class SelectParams:
    max_poor_run: int = fixed.MAX_POOR_MATCH_RUN
    token_budget: int = fixed.MAX_TOKENS_PER_OBJECTIVE
    card_kind: str = "flash card"
    metric: str = "dot"
    mode: str = "eager"  # or "lazy": no judge call the walk would not make


@dataclass(frozen=True)
class TagParams:
    high: int = fixed.HIGH_CUTOFF
    medium: int = fixed.MEDIUM_CUTOFF
    minimal: int = fixed.MINIMAL_CUTOFF
    per: Sequence[str] = ("guid",)
    dedupe: bool = False


@dataclass(frozen=True)
class Params:
    embed: EmbedParams = EmbedParams()
    chat: ChatParams = ChatParams()
    select: SelectParams = SelectParams()
    tag: TagParams = TagParams()


# A model callable is plain Python, picklable, and works on a whole batch.
Embedder = Callable[[list[str]], list[list[float]]]
Chat = Callable[[list[list[dict]], float, list[int]], list[str]]
Tokenizer = Callable[[list[str]], list[int]]
