"""Teacher clients for ``mapInArrow``: one session per task, requests in a bounded pool, an offline stand-in for tests."""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# Runtimes and where they listen.
COMPLETIONS = {"lmstudio": "http://127.0.0.1:1234/v1", "llamacpp": "http://127.0.0.1:8080/v1", "openai-compatible": "http://127.0.0.1:8000/v1"}
OLLAMA = "http://127.0.0.1:11434"


@dataclass(frozen=True)
class TeacherConfig:
    runtime: str = "lmstudio"
    model: str = ""
    base_url: str = ""
    max_tokens: int = 2048
    temperature: float = 0.95
    top_p: float = 0.98
    timeout_s: float = 900
    parallel: int = 8
    headers: dict = field(default_factory=dict)


def _post(url: str, body: dict, config: TeacherConfig) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **config.headers})
    with urllib.request.urlopen(request, timeout=config.timeout_s) as r:
        return json.load(r)


class Completions:
    """Plain completions; a refusal of the endpoint (status 400 or above) and any media go to chat completions."""

    def __init__(self, config: TeacherConfig, post=_post):
        self.config, self.post = config, post
        self.url = (config.base_url or COMPLETIONS[config.runtime]).rstrip("/")

    def _body(self) -> dict:
        c = self.config
        return {"model": c.model, "max_tokens": c.max_tokens, "temperature": c.temperature, "top_p": c.top_p, "stream": False}

    def generate(self, prompt: str, content: list[dict] | None = None) -> str:
        if not content:
            try:
                return self.post(f"{self.url}/completions", {**self._body(), "prompt": prompt}, self.config)["choices"][0]["text"]
            except urllib.error.HTTPError:
                pass
        got = self.post(f"{self.url}/chat/completions", {**self._body(), "messages": [{"role": "user", "content": content or prompt}]}, self.config)
        return got["choices"][0]["message"]["content"]


# Runtimes that take text alone.
TEXT_ONLY = ("ollama",)


class Ollama:
    """The raw generate endpoint; it takes no media."""

    def __init__(self, config: TeacherConfig, post=_post):
        self.config, self.post = config, post
        self.url = (config.base_url or OLLAMA).rstrip("/")

    def generate(self, prompt: str, content: list[dict] | None = None) -> str:
        if content:
            raise RuntimeError("this runtime takes no media")
        c = self.config
        body = {"model": c.model, "prompt": prompt, "raw": True, "stream": False, "options": {"temperature": c.temperature, "top_p": c.top_p, "num_predict": c.max_tokens}}
        return self.post(f"{self.url}/api/generate", body, c)["response"]


class Offline:
    """Deterministic text derived from the prompt, for tests."""

    def __init__(self, config: TeacherConfig):
        self.config = config

    def generate(self, prompt: str, content: list[dict] | None = None) -> str:
        return f"reply {hashlib.sha256(prompt.encode()).hexdigest()[:16]} with {len(content or [])} parts"


def make_client(config: TeacherConfig):
    if config.runtime in COMPLETIONS:
        return Completions(config)
    if config.runtime == "ollama":
        return Ollama(config)
    if config.runtime == "offline":
        return Offline(config)
    raise ValueError(f"unknown runtime {config.runtime!r}")


def generated(prompts: DataFrame, config: TeacherConfig, make=make_client) -> DataFrame:
    """(id, text): an answer per row of (id, prompt, content), where content is null or an array of (type, value) parts.

    Each task makes one client; requests of a batch run in parallel and keep their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make(config)
        with ThreadPoolExecutor(max(1, config.parallel)) as pool:
            for b in batches:
                rows = b.to_pylist()
                parts = [[{"type": p["type"], p["type"]: p["value"]} for p in r["content"]] if r.get("content") and len(r["content"]) > 1 else None for r in rows]
                texts = list(pool.map(client.generate, [r["prompt"] for r in rows], parts))
                yield pa.RecordBatch.from_arrays([pa.array([r["id"] for r in rows], pa.string()), pa.array(texts, pa.string())], ["id", "text"])

    return prompts.select("id", "prompt", "content").mapInArrow(run, "id string, text string")


def ready(url: str, timeout_s: float = 5, get=urllib.request.urlopen) -> bool:
    """Whether a server answers /models or /health with any status below 500."""
    for path in ("/models", "/health"):
        try:
            with get(url.rstrip("/") + path, timeout=timeout_s) as r:
                if r.status < 500:
                    return True
        except urllib.error.HTTPError as e:
            if e.code < 500:
                return True
        except OSError:
            continue
    return False
