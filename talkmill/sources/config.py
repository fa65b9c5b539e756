"""Configuration: plain dataclasses, checked section by section when a command asks for one.

A section that a command doesn't use is not checked, so a configuration without pretraining sources is fine for the rest."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any, get_type_hints


class ConfigError(ValueError):
    pass


def _check(good: bool, message: str) -> None:
    if not good:
        raise ConfigError(message)


def _positive(section: object, *names: str) -> None:
    for n in names:
        _check(getattr(section, n) > 0, f"{n} must be positive")


@dataclass
class Paths:
    unprocessed_data_dir: str = "data/unprocessed"
    refined_data_dir: str = "data/refined"
    removed_data_dir: str = "data/removed"
    local_dataset: str = "data/refined/merged.jsonl"
    hf_dataset: str = ""

    def check(self) -> None:
        pass


@dataclass
class Model:
    name: str = ""
    max_seq_length: int = 2048
    load_in_4bit: bool = True

    def check(self) -> None:
        _positive(self, "max_seq_length")


@dataclass
class Source:
    path: str
    probability: float
    split: str = "train"
    config: str | None = None
    column: str = "text"

    def check(self) -> None:
        _positive(self, "probability")


@dataclass
class Pretraining:
    datasets: list[Source] = field(default_factory=list)
    max_examples: int = 500_000
    output_dir: str = "./checkpoints/cpt"
    checkpoint: str = "./checkpoints/cpt_final"
    learning_rate: float = 5e-6
    epochs: int = 1
    lora_r: int = 16
    lora_alpha: int = 32
    batch_size: int = 4
    grad_accum: int = 4

    def check(self) -> None:
        _positive(self, "max_examples", "lora_r", "batch_size", "grad_accum", "epochs", "learning_rate")
        _check(self.lora_alpha >= self.lora_r, "lora_alpha must not be below lora_r")
        _check(bool(self.datasets), "datasets must not be empty")
        for d in self.datasets:
            d.check()
        check_probabilities([d.probability for d in self.datasets])


@dataclass
class Finetuning:
    output_dir: str = "./checkpoints/sft"
    checkpoint: str = "./checkpoints/sft_final"
    learning_rate: float = 2e-4
    epochs: int = 3
    batch_size: int = 4
    grad_accum: int = 4
    eval_split: float | None = None

    def check(self) -> None:
        _positive(self, "batch_size", "grad_accum", "epochs", "learning_rate")
        _check(self.eval_split is None or 0 < self.eval_split < 1, "eval_split must lie between 0 and 1")


def dotenv(path: str = ".env") -> dict[str, str]:
    """NAME=value lines of a file; quotes around a value and what begins with # after it go. {} if there is no file."""
    found: dict[str, str] = {}
    if not os.path.exists(path):
        return found
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if not equals or name.startswith("#"):
            continue
        value = value.strip()
        if value[:1] in ("'", '"') and (end := value.find(value[0], 1)) > 0:
            value = value[1:end]
        else:
            value = value.split(" #", 1)[0].rstrip()
        found[name.strip()] = value
    return found


@dataclass
class Api:
    endpoint: str = "https://openrouter.ai/api/v1/chat/completions"
    api_key_env: str = "OPENROUTER_API_KEY"
    model: str = "CHANGE_ME"
    temperature: float = 0.9
    max_tokens: int = 4000
    batch_size: int = 20
    batch_timeout: int = 120
    max_retries: int = 5
    max_workers: int | None = None
    prompt: str = ""

    def check(self) -> None:
        _check(0 <= self.temperature <= 2, "temperature must lie between 0 and 2")
        _positive(self, "max_tokens", "batch_size", "batch_timeout", "max_retries")
        _check(self.max_workers is None or self.max_workers > 0, "max_workers must be positive")

    def workers(self) -> int:
        return self.max_workers or min(32, 4 * (os.cpu_count() or 1))

    def api_key(self) -> str | None:
        """From the environment, else from a .env file in the working folder."""
        return os.environ.get(self.api_key_env) or dotenv().get(self.api_key_env)

    def configured(self) -> None:
        """A model and a prompt are set."""
        _check(self.model != "CHANGE_ME", "the model is not set")
        _check(bool(self.prompt.strip()), "the prompt is not set")


@dataclass
class Generation(Api):
    pass


@dataclass
class Refinement(Api):
    temperature: float = 0.1
    max_tokens: int = 1000
    batch_size: int = 40


@dataclass
class Export:
    path: str = "./export/model"
    quantization_method: str = "q4_k_m"

    def check(self) -> None:
        pass


@dataclass
class Topic:
    topic: str
    count: int

    def check(self) -> None:
        _positive(self, "count")


def check_probabilities(p: list[float], tolerance: float = 0.01) -> None:
    total = sum(p)
    _check(abs(total - 1.0) <= tolerance, f"probabilities sum to {total}, not 1")


def _typed(kind: type, name: str, value: Any) -> Any:
    """YAML reads 5e-6 as text; numbers that are text are taken as numbers."""
    want = get_type_hints(kind)[name]
    if value is None or not isinstance(value, (str, int, float)) or isinstance(value, bool):
        return value
    try:
        if want in (float, float | None):
            return float(value)
        if want in (int, int | None):
            _check(float(value) == int(float(value)), f"{name} must be a whole number")
            return int(float(value))
    except ValueError as e:
        raise ConfigError(f"{name}: {e}") from e
    return value


def _section(kind: type, data: dict | None) -> Any:
    """Unknown names are passed over."""
    known = {f.name for f in fields(kind)}
    try:
        return kind(**{k: _typed(kind, k, v) for k, v in (data or {}).items() if k in known})
    except TypeError as e:
        raise ConfigError(f"{kind.__name__}: {e}") from e


_SECTIONS = {"paths": Paths, "model": Model, "cpt_training": Pretraining, "sft_training": Finetuning, "generation": Generation, "refinement": Refinement, "export": Export}


class Config:
    def __init__(self, data: dict | None = None):
        data = data or {}
        self._sections = {name: _section(kind, data.get(name)) for name, kind in _SECTIONS.items()}
        cpt = self._sections["cpt_training"]
        cpt.datasets = [d if isinstance(d, Source) else _section(Source, d) for d in cpt.datasets]
        #: a topic is a record, or a list of its name and count
        self.topics = [_section(Topic, {"topic": t[0], "count": t[1]} if isinstance(t, (list, tuple)) else t) for t in data.get("topics") or []]

    def __getitem__(self, name: str) -> Any:
        """A section that has been checked."""
        section = self._sections[name]
        section.check()
        if name == "generation":
            for t in self.topics:
                t.check()
            _check(bool(self.topics) or not section.prompt, "a generation prompt needs topics")
        return section

    def check_all(self) -> "Config":
        for name in _SECTIONS:
            self[name]
        return self


def load(path: str | None = None, default: str = "configs/config.yaml") -> Config:
    """From a YAML file; without a path, from the default one if it is there, else the defaults."""
    import yaml

    where = Path(path or default)
    if not where.exists():
        if path is not None:
            raise FileNotFoundError(where)
        return Config()
    return Config(yaml.safe_load(where.read_text(encoding="utf-8")))


def topic_rows(spark, topics: list[Topic]):
    """(topic_idx from 1, topic, count)."""
    return spark.createDataFrame([(i, t.topic, t.count) for i, t in enumerate(topics, 1)], "topic_idx int, topic string, count int")
