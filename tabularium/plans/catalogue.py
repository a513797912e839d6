"""The query modules of the core."""

from __future__ import annotations

from types import ModuleType

from tabularium.plans import commerce, editions, register, texts


def modules() -> list[ModuleType]:
    return [editions, register, commerce, texts]
