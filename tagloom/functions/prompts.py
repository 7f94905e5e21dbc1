"""Prompts and their token budgets."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tagloom import fixed
from tagloom.functions.text import token_count


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fill(template: str, parts: dict[str, Column]) -> Column:
    """Put columns in the place of the {names} of a fixed template."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(
        *[parts[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    )


def messages(system: str, user: Column) -> Column:
    """Chat messages as array<struct<role, content>>."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def rating_text(objective: Column | str, card: Column | str, kind: str = "flash card") -> Column:
    return _fill(
        fixed.RATE_USER.replace("{kind}", kind).replace("{Kind}", kind.capitalize()),
        {"objective": _col(objective), "card": _col(card)},
    )


def rating_prompt(objective: Column | str, card: Column | str, kind: str = "flash card") -> Column:
    return messages(fixed.RATE_SYSTEM, rating_text(objective, card, kind))


def generation_text(text: Column | str) -> Column:
    return _fill(fixed.GENERATE_USER, {"text": _col(text)})


def generation_prompt(text: Column | str) -> Column:
    return messages(fixed.GENERATE_SYSTEM, generation_text(text))


def prompt_text(msgs: Column | str) -> Column:
    """Message contents joined by single spaces."""
    return F.array_join(F.transform(_col(msgs), lambda m: m["content"]), " ")


def prompt_tokens(msgs: Column | str) -> Column:
    """Tokens of all message contents (a space after the last one adds none)."""
    return token_count(prompt_text(msgs))


def fixed_tokens(template: str, system: str, kind: str = "flash card") -> int:
    """Tokens of a prompt whose inserted texts are empty.

    Inserted texts are set off by white space, so the tokens of a filled prompt
    are this number plus the tokens of the inserted texts.
    """
    bare = template.replace("{kind}", kind).replace("{Kind}", kind.capitalize())
    bare = re.sub(r"\{\w+\}", "", bare)
    return len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0d\x20]", f"{system} {bare}"))


def rating_fixed_tokens(kind: str = "flash card") -> int:
    return fixed_tokens(fixed.RATE_USER, fixed.RATE_SYSTEM, kind)


def generation_fixed_tokens() -> int:
    return fixed_tokens(fixed.GENERATE_USER, fixed.GENERATE_SYSTEM)


def remaining_tokens(
    tokens: Column | str,
    max_tokens: int = fixed.CHAT_MAX_TOKENS,
    buffer: int = fixed.CHAT_TOKEN_BUFFER,
) -> Column:
    """Completion tokens left after the prompt and the buffer."""
    return F.lit(max_tokens) - _col(tokens) - F.lit(buffer)


def fits_strict(
    tokens: Column | str,
    max_tokens: int = fixed.CHAT_MAX_TOKENS,
    buffer: int = fixed.CHAT_TOKEN_BUFFER,
) -> Column:
    """False when fewer than `buffer` completion tokens are left."""
    return remaining_tokens(tokens, max_tokens, buffer) >= buffer


def remaining_clamped(
    tokens: Column | str,
    max_tokens: int = fixed.CHAT_MAX_TOKENS,
    buffer: int = fixed.CHAT_TOKEN_BUFFER,
) -> Column:
    """Completion tokens, never fewer than `buffer`."""
    return F.greatest(remaining_tokens(tokens, max_tokens, buffer), F.lit(buffer))
