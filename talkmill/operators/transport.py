"""Calls of a language model: requests, retries, and the map over rows."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.sources.config import Api


class Transport(Protocol):
    def send(self, request: dict[str, Any], timeout: float) -> tuple[int, str]:
        """(HTTP status, body); raises TimeoutError or ConnectionError."""


@dataclass
class HttpTransport:
    endpoint: str
    key: str

    def send(self, request: dict[str, Any], timeout: float) -> tuple[int, str]:
        call = urllib.request.Request(self.endpoint, json.dumps(request).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(call, timeout=timeout) as got:
                return got.status, got.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, ""
        except TimeoutError:
            raise
        except OSError as e:
            raise ConnectionError(str(e)) from e


def seconds(attempt: int, base: float = 2, most: float = 120) -> float:
    return min(base * 2**attempt, most)


def request(cfg: Api, messages: list[dict[str, str]]) -> dict[str, Any]:
    return {"model": cfg.model, "messages": messages, "temperature": cfg.temperature, "max_tokens": cfg.max_tokens, "reasoning": {"effort": "none"}}


def request_column(cfg: Api, messages: Column) -> Column:
    """The same as a column of JSON."""
    return F.to_json(
        F.struct(F.lit(cfg.model).alias("model"), messages.alias("messages"), F.lit(cfg.temperature).alias("temperature"), F.lit(cfg.max_tokens).alias("max_tokens"), F.struct(F.lit("none").alias("effort")).alias("reasoning"))
    )


@dataclass
class Reply:
    value: Any
    status: str
    attempts: int

    @property
    def ok(self) -> bool:
        return self.status == "ok"


def _content(body: str) -> Any:
    """The reply's JSON, with fences gone. ValueError asks for another try; anything else gives up."""
    text = json.loads(body)["choices"][0]["message"]["content"]
    return json.loads(text.replace("```json", "").replace("```", "").strip())


def call(cfg: Api, transport: Transport, messages: list[dict[str, str]], sleep: Callable[[float], None] = time.sleep) -> Reply:
    """Tries until there is JSON. 429 waits a step longer than server errors, timeouts, lost connections and bad JSON; other
    statuses and replies without content give up at once; the last failure waits as well."""
    status = "exhausted"
    for attempt in range(cfg.max_retries):
        try:
            code, body = transport.send(request(cfg, messages), cfg.batch_timeout)
        except (TimeoutError, ConnectionError):
            sleep(seconds(attempt))
            continue
        except Exception:  # noqa: BLE001  a transport may raise anything; such calls give up
            return Reply(None, "error", attempt + 1)
        if code == 429 or code >= 500:
            sleep(seconds(attempt + (code == 429)))
        elif code >= 400:
            return Reply(None, f"http {code}", attempt + 1)
        else:
            try:
                return Reply(_content(body), "ok", attempt + 1)
            except ValueError:
                sleep(seconds(attempt))
            except Exception:  # noqa: BLE001
                return Reply(None, "no content", attempt + 1)
    return Reply(None, status, cfg.max_retries)


def require_key(cfg: Api) -> str:
    key = cfg.api_key()
    if not key:
        raise ValueError(f"no API key: set {cfg.api_key_env}")
    return key


def map_calls(rows: DataFrame, cfg: Api, transport: Transport, keys: list[str], system: str = "system", user: str = "user", sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(keys, raw, status, attempts) of a call for each row; as many tasks as workers. Write the result before using it
    twice: calls cost, and need not repeat themselves."""
    kept = rows.select(*keys, F.col(system).alias("_system"), F.col(user).alias("_user")).repartition(cfg.workers(), *keys)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[: len(keys)]), "raw string, status string, attempts int"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [call(cfg, transport, ([{"role": "system", "content": s}] if s else []) + [{"role": "user", "content": u}], sleep) for s, u in zip(frame["_system"], frame["_user"])]
            yield frame[keys].assign(raw=[json.dumps(r.value, ensure_ascii=False) if r.ok else None for r in got], status=[r.status for r in got], attempts=[r.attempts for r in got])

    return kept.mapInPandas(run, schema)
