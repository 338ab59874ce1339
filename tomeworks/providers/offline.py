"""Stand-ins that need neither network nor models: plain functions of their request, so that plans can be run and tested."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from .base import register


@dataclass(frozen=True)
class Outline:
    """Reads a record off the page texts: the first line is the title, the first words of nine or more letters in
    alphabetic order are the keywords."""

    name: str = "outline"
    n_keywords: int = 10

    def __call__(self, request: str) -> str | None:
        texts = [b.partition("\n")[2] for b in json.loads(request).get("ocr", ())]
        lines = [s.strip() for t in texts for s in t.split("\n") if s.strip()]
        words = sorted({w for t in texts for w in re.findall(r"[a-z]{9,}", t.lower())})
        return json.dumps({"title": lines[0] if lines else None, "keywords": words[: self.n_keywords], "title_confidence": 0.5 if lines else 0.0}, ensure_ascii=False)


@dataclass(frozen=True)
class EchoSearch:
    """A search that finds what it was asked for."""

    name: str = "naive"

    def __call__(self, request: str) -> str | None:
        asked = json.loads(request)
        items = [asked["info"]][: asked["max_results"]]
        return json.dumps({"source": self.name, "query": asked["info"].get("title"), "result_count": len(items), "items": items}, ensure_ascii=False)


@dataclass(frozen=True)
class FirstCandidate:
    """The record as read, with gaps filled from the first item of each candidate in turn."""

    name: str = "first"

    def __call__(self, request: str) -> str | None:
        asked = json.loads(request)
        out = {k: v for k, v in (asked.get("info") or {}).items() if not k.endswith("_confidence")}
        for payload in asked.get("candidates") or ():
            for item in json.loads(payload).get("items", ())[:1]:
                for k, v in item.items():
                    if not k.endswith("_confidence") and out.get(k) in (None, "", []):
                        out[k] = v
        if isinstance(out.get("author"), str):
            out["author"] = [out["author"]]
        return json.dumps(out, ensure_ascii=False, sort_keys=True)


for _make in (Outline, EchoSearch, FirstCandidate):
    register(_make.name, _make)
