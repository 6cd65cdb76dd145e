"""A client of chat completions for writers and judges; judges read private texts, so theirs has to stay on local hosts."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from quern.sources.web import Reply, Session, Stopped, is_local_endpoint


@dataclass(frozen=True)
class Completion:
    text: str
    finish: str | None
    model: str
    usage: dict


def parsed(reply: Reply) -> Completion:
    """A ValueError, which is tried again, where the body has no message content; null content is an empty text."""
    said = json.loads(reply.body)
    try:
        choice = said["choices"][0]
        content = choice["message"]["content"]
    except (KeyError, IndexError, TypeError):
        raise ValueError("the body has no message content") from None
    return Completion(content or "", choice.get("finish_reason"), said.get("model") or "", said.get("usage") or {})


@dataclass
class ChatClient:
    url: str
    model: str
    session: Session
    key: str | None = None
    max_tokens: int = 1500
    thinking: bool = True
    extra: dict[str, Any] = field(default_factory=dict)

    def complete(self, messages: list[dict[str, str]], temperature: float, top_p: float | None = None) -> Completion:
        asked = {"model": self.model, "messages": messages, "max_tokens": self.max_tokens, "temperature": temperature}
        asked |= {} if top_p is None else {"top_p": top_p}
        asked |= {} if self.thinking else {"chat_template_kwargs": {"enable_thinking": False}}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        out = self.session.request(f"{self.url.rstrip('/')}/chat/completions", absent=(), parse=parsed, headers=headers, data=json.dumps(asked | self.extra).encode())
        return out if out.model else Completion(out.text, out.finish, self.model, out.usage)


def key_from(variable: str) -> str | None:
    """The key in an environment variable; one that is named has to be set."""
    if variable and not os.environ.get(variable):
        raise Stopped(f"the environment variable {variable} is not set")
    return os.environ[variable] if variable else None


def writer_client(writer: dict, **session: Any) -> ChatClient:
    """A client for a writer of the configuration."""
    return ChatClient(writer["base_url"], writer["model"], Session(rpm=float(writer.get("rpm", 0)), **session), key_from(writer.get("api_key_env", "")), int(writer.get("max_tokens", 1500)), not writer.get("disable_thinking", False), dict(writer.get("extra_body", {})))


def judge_client(judge: dict, **session: Any) -> ChatClient:
    """A client for the judge of the configuration; an address that isn't local is refused."""
    if not is_local_endpoint(judge["base_url"]):
        raise Stopped("the judge's address isn't local, and judges read private texts")
    return ChatClient(judge["base_url"], judge["model"], Session(rpm=float(judge.get("rpm", 0)), **session), max_tokens=int(judge.get("max_tokens", 8)), thinking=not judge.get("disable_thinking", True))


def answering(client: Callable[[], ChatClient], messages: Callable[[str], list[dict[str, str]]], temperature: float = 0.0) -> Callable[[], Callable[[str, str], str]]:
    """What operators.judge asks with: once a partition a client, then for each text its reply."""

    def start() -> Callable[[str, str], str]:
        own = client()
        return lambda _, text: own.complete(messages(text), temperature).text

    return start
