"""Typed settings. ``from_mapping`` accepts the nested dicts found in build config files."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any


def config_hash(config: Mapping[str, Any]) -> str:
    """sha256 of the sorted-key JSON form of a config mapping."""
    text = json.dumps(config, sort_keys=True, ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


@dataclass(frozen=True)
class FrameColumns:
    """Logical name -> physical column of the frames table."""

    episode: str = "episode_index"
    frame: str = "frame_index"
    timestamp: str = "timestamp"
    task: str = "task_index"
    sensor_timestamp: str | None = None
    instruction: str | None = None

    @property
    def required(self) -> list[str]:
        return [self.episode, self.frame, self.timestamp, self.task]


@dataclass(frozen=True)
class EpisodeFilter:
    """An explicit list wins; otherwise ``count`` episodes from ``start``; neither means all."""

    episodes: tuple[int, ...] = ()
    start: int = 0
    count: int = 0

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], count_keys: Sequence[str] | None = None) -> EpisodeFilter:
        keys = count_keys or ("episode_filter_count", "episode_limit")
        count = next((config[key] for key in keys if key in config), 0)
        return cls(
            tuple(int(e) for e in config.get("episode_filter") or ()),
            int(config.get("episode_filter_start") or 0),
            int(count or 0),
        )

    def values(self) -> list[int]:
        if self.episodes:
            return list(self.episodes)
        return list(range(self.start, self.start + self.count)) if self.count > 0 else []


@dataclass(frozen=True)
class WindowSpec:
    """Inclusive frame offsets of the two windows around an anchor frame."""

    observation_start_offset: int = -10
    observation_end_offset: int = 0
    action_start_offset: int = 1
    action_end_offset: int = 10

    @property
    def roles(self) -> dict[str, tuple[int, int]]:
        return {
            "observation": (self.observation_start_offset, self.observation_end_offset),
            "action": (self.action_start_offset, self.action_end_offset),
        }

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> WindowSpec:
        return cls(**{name: int(config[name]) for name in cls.__dataclass_fields__ if name in config})


@dataclass(frozen=True)
class SyncConfig:
    columns: FrameColumns = FrameColumns()
    episodes: EpisodeFilter = EpisodeFilter()
    stride: int = 30
    window: WindowSpec = WindowSpec()
    max_gap_seconds: float = 0.25
    sync_rule: str = "frame_window_timestamp_validation_v1"
    source_table: str = "raw.frames"

    def __post_init__(self) -> None:
        if self.stride < 1:
            raise ValueError("stride must be at least 1")

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> SyncConfig:
        quality = config.get("quality", {})
        source = config.get("source", {})
        table = f"{source.get('namespace', 'raw')}.{source.get('frames_table', 'frames')}"
        return cls(
            columns=FrameColumns(**config["columns"]),
            episodes=EpisodeFilter.from_mapping(config),
            stride=int(config.get("frame_stride", cls.stride)),
            window=WindowSpec.from_mapping(config.get("window", {})),
            max_gap_seconds=float(quality.get("max_timestamp_gap_seconds", cls.max_gap_seconds)),
            sync_rule=quality.get("sync_rule", cls.sync_rule),
            source_table=table,
        )


@dataclass(frozen=True)
class AnnotationRule:
    """Extra instruction texts for every source instruction equal to ``match_text``."""

    match_text: str
    texts: tuple[str, ...]
    annotation_type: str = "paraphrase"
    task_label: str | None = None
    object_label: str | None = None
    scene_label: str | None = None
    is_active: bool = True


@dataclass(frozen=True)
class AnnotationConfig:
    version: str
    policy: str
    created_at_utc: str
    language: str = "en"
    created_by: str = "annotation_builder"
    source_type: str = "source_task"
    task_label: str | None = None
    object_label: str | None = None
    scene_label: str | None = None
    rules: tuple[AnnotationRule, ...] = ()
    require_status: str | None = None

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], created_at_utc: str) -> AnnotationConfig:
        default_task = config.get("default_task_label")
        rules = []
        for entry in config.get("additional_annotations", []):
            # only the task label falls back to the default; the other two stay empty
            fields = {"task_label": default_task, **entry}
            fields["texts"] = tuple(entry.get("texts", ()))
            rules.append(AnnotationRule(**fields))
        return cls(
            version=config["annotation_version"],
            policy=config["annotation_policy"],
            created_at_utc=created_at_utc,
            language=config.get("language", cls.language),
            created_by=config.get("created_by", cls.created_by),
            source_type=config.get("source_annotation_type", cls.source_type),
            task_label=default_task,
            object_label=config.get("default_object_label"),
            scene_label=config.get("default_scene_label"),
            rules=tuple(rules),
            require_status=config.get("require_sync_status"),
        )


@dataclass(frozen=True)
class ManifestConfig:
    require_status: str | None = "ok"
    annotation_table: str | None = "annotations.instructions"
    annotation_version: str | None = None
    annotation_active_only: bool = True
    # the episode always joins; "source_instruction_id" may be added
    join_columns: tuple[str, ...] = ("episode_id",)

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> ManifestConfig:
        return cls(
            require_status=config.get("require_sync_status"),
            annotation_table=config.get("annotation_table"),
            annotation_version=config.get("annotation_version"),
            annotation_active_only=bool(config.get("annotation_active_only", True)),
            join_columns=tuple(config.get("annotation_join_columns", ("episode_id",))),
        )


@dataclass(frozen=True)
class FrameManifestConfig:
    """Manifest taken straight from frames, without sync statistics."""

    stride: int = 30
    episodes: tuple[int, ...] = ()
    window: WindowSpec = field(default_factory=WindowSpec)

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> FrameManifestConfig:
        return cls(
            stride=int(config.get("frame_stride", cls.stride)),
            episodes=tuple(int(e) for e in config.get("episode_filter") or ()),
            window=WindowSpec.from_mapping(config.get("window", {})),
        )
