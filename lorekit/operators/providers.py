"""Model clients: a chat endpoint over HTTP, and a table of fixed answers."""

from __future__ import annotations

import json
import urllib.request
from dataclasses import dataclass, field

from lorekit.plans.config import ModelConfig


@dataclass
class ChatEndpoint:
    """A server with the usual chat-completions interface; made in each worker from its settings."""

    config: ModelConfig
    timeout: float = 120.0

    def complete(self, prompt: str) -> str:
        c = self.config
        if not c.api_base:
            raise ValueError("a model needs an api_base")
        body = {"model": c.model, "messages": [{"role": "user", "content": prompt}], "temperature": c.temperature, "max_tokens": c.max_tokens}
        request = urllib.request.Request(f"{c.api_base.rstrip('/')}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {c.api_key}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.load(reply)["choices"][0]["message"]["content"]


@dataclass
class FixedAnswers:
    """The answer whose key stands in the prompt, else the default: for tests and dry runs."""

    answers: dict[str, str] = field(default_factory=dict)
    default: str = '{"experiences": []}'

    def complete(self, prompt: str) -> str:
        return next((a for key, a in self.answers.items() if key in prompt), self.default)


def provider_of(config: ModelConfig):
    """A factory for extract.complete(): the endpoint of the settings, or empty answers where none is named."""
    return (lambda: ChatEndpoint(config)) if config.api_base else FixedAnswers
