"""What is asked of the world outside (text extraction, models, catalogues), as protocols with offline stand-ins.

A provider is called for batches of distinct inputs within mapInPandas; a call that fails for good gives a row with an
error, so that one document's fault is its own."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

#: HTTP answers after which a request is worth repeating.
RETRYABLE = frozenset((408, 429, *range(500, 600)))


class ProviderError(Exception):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


class TextProvider(Protocol):
    name: str

    def __call__(self, request: str) -> str | None: ...


def retrying(call: Callable[[str], str | None], attempts: int = 3, least: float = 1.0, most: float = 8.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str | None]:
    """The call, repeated after timeouts, lost connections and retryable answers, with random waits that double."""

    def run(request: str) -> str | None:
        for n in range(attempts):
            try:
                return call(request)
            except (TimeoutError, ConnectionError, ProviderError) as e:
                if n + 1 == attempts or isinstance(e, ProviderError) and e.status not in RETRYABLE:
                    raise
                sleep(random.uniform(least, max(least, min(most, least * 2**n))))
        return None

    return run


@dataclass(frozen=True)
class ContextLimits:
    first_images: int | None = None
    last_images: int | None = None
    first_pages: int | None = None
    last_pages: int | None = None

    def __post_init__(self) -> None:
        if any(v is not None and v < 0 for v in (self.first_images, self.last_images, self.first_pages, self.last_pages)):
            raise ValueError("limits can't be negative")


@dataclass(frozen=True)
class PipelineConfig:
    first_pages: int = 5
    last_pages: int = 3
    extractor: str = "echo"
    selector: str = "first"
    search_methods: tuple[str, ...] = ()
    max_results: int = 3
    limits: ContextLimits = ContextLimits()
    client: dict[str, str | None] = field(default_factory=dict)
    #: Where answers of providers are kept for later runs; not part of what a run is known by.
    cache: str | None = None

    def to_json(self) -> str:
        """The config as JSON, with secrets redacted and nulls left out."""
        hide = lambda k, v: "<redacted>" if any(s in k.lower() for s in ("key", "secret", "token")) else v
        client = {k: hide(k, v) for k, v in self.client.items() if v is not None}
        return json.dumps({**{k: v for k, v in self.__dict__.items() if k not in ("client", "limits", "cache")}, "limits": self.limits.__dict__, "client": client}, sort_keys=True)


REGISTRY: dict[str, Callable[[], TextProvider]] = {}


def register(name: str, make: Callable[[], TextProvider]) -> None:
    REGISTRY[name] = make


def factory(name: str) -> Callable[[], TextProvider]:
    """What makes the provider. Resolved on the driver and sent along, so that what is registered there serves executors."""
    if name not in REGISTRY:
        raise ValueError(f"no such provider: {name}")
    return REGISTRY[name]


def provider(name: str) -> TextProvider:
    return factory(name)()


@dataclass(frozen=True)
class Echo:
    """Answers a request with itself: the offline extractor and search method."""

    name: str = "echo"

    def __call__(self, request: str) -> str | None:
        return request


register("echo", Echo)


def ask(requests: DataFrame, key: str, request: str, name: str, attempts: int = 3) -> DataFrame:
    """key, response, error: the provider's answers."""
    make = factory(name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = retrying(make(), attempts)
        for pdf in batches:
            got, bad = [], []
            for x in pdf[request]:
                try:
                    got.append(call(x))
                    bad.append(None)
                except Exception as e:
                    got.append(None)
                    bad.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({key: pdf[key], "response": pd.Series(got, dtype=object), "error": pd.Series(bad, dtype=object)})

    kind = requests.schema[key].dataType.simpleString()
    return requests.select(key, request).mapInPandas(run, f"{key} {kind}, response string, error string")
