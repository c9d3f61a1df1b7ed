"""Configuration: typed groups with defaults, read from YAML with paths relative to the file."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path


@dataclass
class Paths:
    input_csv: str = "data/input/concept_pairs.csv"
    work_dir: str = "data/work"
    review_dir: str = "data/review"
    output_dir: str = "data/output"
    cache_dir: str = "data/cache"
    relation_aliases_file: str | None = "relation_aliases.yaml"


@dataclass
class Wikipedia:
    language: str = "en"
    min_sentences: int = 5
    search_results: int = 8
    max_pages: int = 10
    request_delay_seconds: float = 0.15
    request_timeout_seconds: float = 30.0
    max_sentence_chars: int = 900
    min_sentence_chars: int = 25
    allow_pairs_below_minimum: bool = False
    user_agent: str = "quern/0.1"


@dataclass
class Models:
    relation_model: str = "gpt-4.1"
    ranking_model: str = "gpt-4.1"
    embedding_model: str = "text-embedding-3-large"
    max_retries: int = 5
    relation_context_char_limit: int = 24_000


@dataclass
class Embedding:
    batch_size: int = 64
    context_similarity_threshold: float = 0.5


@dataclass
class MaxDiff:
    subset_size: int = 4
    target_appearances_per_relation: int = 4
    score_offset: float = 1.1
    seed: int = 42


@dataclass
class Questions:
    target_count: int = 4
    questions_per_stem: int = 1
    total_questions: int | None = None
    seed: int = 42
    require_context_pass: bool = True
    tie_tolerance: float = 1e-10
    max_sampling_attempts_per_question: int = 200


@dataclass
class RelationFilter:
    auto_accept_base_relation: bool = True
    auto_reject_unsupported: bool = False


@dataclass
class Config:
    paths: Paths = field(default_factory=Paths)
    wikipedia: Wikipedia = field(default_factory=Wikipedia)
    openai: Models = field(default_factory=Models)
    embedding: Embedding = field(default_factory=Embedding)
    maxdiff: MaxDiff = field(default_factory=MaxDiff)
    questions: Questions = field(default_factory=Questions)
    relation_filter: RelationFilter = field(default_factory=RelationFilter)

    def resolve_paths(self, base: Path) -> Config:
        for f in fields(self.paths):
            value = getattr(self.paths, f.name)
            if value is not None and "://" not in value and not Path(value).is_absolute():
                setattr(self.paths, f.name, str((base / value).resolve()))
        return self

    def ensure_directories(self) -> None:
        for name in ("work_dir", "review_dir", "output_dir", "cache_dir"):
            if "://" not in getattr(self.paths, name):  # a store named by a URI makes its folders when they are written
                Path(getattr(self.paths, name)).mkdir(parents=True, exist_ok=True)


def _fill(target, values: dict) -> None:
    known = {f.name for f in fields(target)}
    for name, value in (values or {}).items():
        if name not in known:
            continue
        current = getattr(target, name)
        if is_dataclass(current):
            _fill(current, value)
        else:
            setattr(target, name, value)


def load_config(path: str | Path = "config.yaml") -> Config:
    """Configuration of a YAML file; its directories are created."""
    import yaml

    file = Path(path).resolve()
    if not file.exists():
        raise FileNotFoundError(f"no configuration file at {file}")
    config = Config()
    _fill(config, yaml.safe_load(file.read_text(encoding="utf-8")) or {})
    config.resolve_paths(file.parent).ensure_directories()
    return config
