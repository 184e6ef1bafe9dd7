"""A chat-completion service as a scorer: requests built from messages, retried, one session per partition."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable


class ScoreError(Exception):
    pass


def endpoint(url: str) -> str:
    """The completions address of a service's base URL."""
    url = url.rstrip("/")
    return url if url.endswith("/chat/completions") else f"{url}/chat/completions" if url.endswith("/v1") else f"{url}/v1/chat/completions"


def payload(model: str, messages: list[dict], temperature: float, max_tokens: int, json_mode: bool = False) -> dict:
    return {"model": model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens, **({"response_format": {"type": "json_object"}} if json_mode else {})}


def headers(key: str) -> dict[str, str]:
    return {"Content-Type": "application/json", **({"Authorization": f"Bearer {key}"} if key else {})}


def content(body: str) -> str:
    try:
        said = json.loads(body)["choices"][0]["message"]["content"]
    except (ValueError, LookupError, TypeError) as e:
        raise ScoreError(f"no message in the answer: {body[:300]}") from e
    if not isinstance(said, str) or not said.strip():
        raise ScoreError("an empty message")
    return said


def post(url: str, data: bytes, head: dict[str, str], timeout: float) -> tuple[int, str]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, head), timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def client(url: str, model: str, key: str = "", temperature: float = 0.0, max_tokens: int = 1024, json_mode: bool = True, timeout: float = 120, retries: int = 4, send: Callable = post, sleep: Callable = time.sleep) -> Callable[[list[dict]], str]:
    """messages -> answer. Server errors, throttling, broken connections and bodies without a message are tried again; other refusals are not."""

    def ask(messages: list[dict]) -> str:
        data, last = json.dumps(payload(model, messages, temperature, max_tokens, json_mode)).encode(), ""
        for attempt in range(retries + 1):
            try:
                status, body = send(endpoint(url), data, headers(key), timeout)
            except OSError as e:
                status, body = 599, str(e)
            if status < 400:
                try:
                    return content(body)
                except ScoreError as e:
                    last = str(e)
            elif status < 500 and status != 429:
                raise ScoreError(f"refused with {status}: {body[:300]}")
            else:
                last = f"{status}: {body[:300]}"
            if attempt < retries:
                sleep(min(2**attempt, 16) * (1 + random.random() / 4))
        raise ScoreError(f"gave up after {retries + 1} attempts: {last}")

    return ask
