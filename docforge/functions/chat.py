"""A chat server behind the adapter: one JSON object for a text, asked to mend its answer once."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable

from docforge.functions.adapters import TransportError

EXTRACT = "Return one JSON object with the keys case_type, docket_number, docket_date, legal_relationship, presiding_judge, parties, confidence_by_field, evidence_by_field, warnings, reasoning_summary. Text:\n{}"
MEND = "The following was to be one JSON object. Return it as valid JSON and nothing else:\n{}"


class ModelError(TransportError):
    """The server gave no usable answer."""


def post(url: str, body: dict, token: str = "", timeout: float = 180.0) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **({"Authorization": f"Bearer {token}"} if token else {})})
    with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310  the caller's own server
        try:
            return json.loads(answer.read())
        except ValueError as problem:
            raise TransportError(f"the answer is no JSON: {problem}") from problem


def content_of(answer: dict) -> str:
    """The message of an answer in either of the usual shapes: ``choices`` of messages, or one ``message``."""
    message = answer["choices"][0]["message"] if answer.get("choices") else answer.get("message") or {}
    if not isinstance(message.get("content"), str):
        raise ModelError("an answer without content")
    return message["content"]


def as_object(text: str) -> dict:
    """A JSON object, without the fence around it."""
    inner = text.strip().removeprefix("```json").removeprefix("```").removesuffix("```")
    value = json.loads(inner)
    if not isinstance(value, dict):
        raise ModelError("not a JSON object")
    return value


def chat_model(url: str, name: str, prompt: str = EXTRACT, token: str = "", tokens: int = 2048, timeout: float = 180.0, send: Callable[..., dict] = post) -> Callable[[], Callable[[str], str]]:
    """A loader for ``adapters.call_service``, which keeps several calls under way, or ``apply_model``: text to the JSON text of an object (see ``functions.payload``)."""

    def load() -> Callable[[str], str]:
        def ask(message: str) -> str:
            return content_of(send(url, {"model": name, "messages": [{"role": "user", "content": message}], "temperature": 0.0, "max_tokens": tokens, "stream": False}, token=token, timeout=timeout))

        def answer(text: str) -> str:
            first = ask(prompt.replace("{}", text, 1))
            try:
                return json.dumps(as_object(first), ensure_ascii=False)
            except (ValueError, ModelError):
                return json.dumps(as_object(ask(MEND.replace("{}", first, 1))), ensure_ascii=False)

        return answer

    return load
