"""What a run is configured with: secrets, clients, methods, and the shape of what a model is asked for."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StructType

#: The names under which secrets are kept.
SECRETS = {"openai": {"api_key": "OPENAI_API_KEY", "project": "OPENAI_PROJECT_ID"}, "ollama": {"host": "OLLAMA_HOST"}}
SEARCH_KEYS = {"googlebooks": "GOOGLE_BOOKS_API_KEY"}


@dataclass(frozen=True)
class GoogleBooksClient:
    api_key: str
    max_results: int = 5


@dataclass(frozen=True)
class HardcoverClient:
    api_key: str
    per_page: int = 5
    page: int = 1
    base_url: str = "https://api.hardcover.app/v1/graphql"

    @property
    def offset(self) -> int:
        return max((self.page - 1) * self.per_page, 0)


def read_secrets(path: str) -> dict:
    if not os.path.exists(path):
        raise FileNotFoundError(f"no secrets file: {path}")
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def client_config(provider: str, secrets: dict) -> dict[str, str | None]:
    """The settings of a provider's client; a provider that isn't known is an error."""
    if provider not in SECRETS:
        raise ValueError(f"no such provider: {provider}")
    return {k: secrets.get(name) for k, name in SECRETS[provider].items()}


def default_search_methods(secrets: dict) -> tuple[str, ...]:
    """The catalogues that there is a key for."""
    return tuple(m for m, key in SEARCH_KEYS.items() if secrets.get(key))


def default_ocr_methods(model: str | None = None) -> tuple[str, ...]:
    return ("native", "tesseract", *([f"ollama:{model}"] if model else []))


def writer_binary(given: str | None = None, variable: str = "METADATA_WRITER", fallback: str | None = None) -> str:
    """Where an outside writer is: as given, else as the environment says, else the fallback."""
    for path in (given, os.environ.get(variable), fallback):
        if path and os.path.exists(path):
            return path
    raise FileNotFoundError(f"no metadata writer; name one or set {variable}")


def json_schema(kind: DataType) -> dict:
    """The JSON schema of a Spark type."""
    if isinstance(kind, StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind.fields}, "required": [f.name for f in kind.fields if not f.nullable]}
    if isinstance(kind, ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    names = {BooleanType: "boolean", IntegerType: "integer", LongType: "integer", DoubleType: "number", FloatType: "number"}
    return {"type": names.get(type(kind), "string")}


def scrub(x):
    """A payload without lone surrogates, which no encoding can carry; nested lists and dictionaries too."""
    if isinstance(x, str):
        return x.encode("utf-8", "ignore").decode("utf-8")
    if isinstance(x, dict):
        return {scrub(k): scrub(v) for k, v in x.items()}
    return [scrub(v) for v in x] if isinstance(x, (list, tuple)) else x


def messages(blocks: dict, images: list[str] | None = None) -> list[dict]:
    """A chat's messages: the prompt, then the other blocks as one text, with base64 images."""
    text = "\n\n".join(b for b in (blocks.get("path"), blocks.get("metadata"), *blocks.get("ocr", ())) if b and b.strip())
    user = {"role": "user", "content": text} | ({"images": list(images)} if images else {})
    return [scrub({"role": "system", "content": blocks.get("prompt") or ""}), scrub(user)]
