"""Typed settings of the trajectory pipeline.

Keys may carry their unit (`position_threshold_m`), and a pose's transform and the gripper may be sections of their own, as in
the dataset pipelines' own files. Unknown keys are errors. Sections of back-ends (encoders, sensors, viewers) have no effect
here: `load` keeps their names, for a command to tell; keys of a viewer (`visualization_*`) likewise.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

#: What a key may end with besides its name, and what keys of viewers begin with.
UNITS, VIEWER = ("_m", "_rad"), "visualization_"


def _plain(values: dict[str, Any] | None, known: set[str]) -> dict[str, Any]:
    """Keys by their names here: without a unit, and without those of viewers."""
    out = {}
    for k, v in (values or {}).items():
        name = next((k.removesuffix(u) for u in UNITS if k not in known and k.removesuffix(u) in known), k)
        if name in out:
            raise ValueError(f"{name} is given twice")
        if not k.startswith(VIEWER):
            out[name] = v
    return out


def _only(section: dict[str, Any], key: str, value: str, where: str) -> None:
    """A choice that has one value here."""
    if section.pop(key, value) != value:
        raise ValueError(f"{where}.{key}: only {value}")


def _build(kind: type, values: dict[str, Any] | None, where: str):
    values = _plain(values, {f.name for f in fields(kind)})
    known = {f.name: f for f in fields(kind)}
    if unknown := sorted(values.keys() - known.keys()):
        raise ValueError(f"{where}: unknown keys {', '.join(unknown)}")
    return kind(**values)


@dataclass(frozen=True)
class Trajectory:
    action_offset_frames: int = 1
    observed_width: tuple[float, float] = (0.0, 0.1)
    gripper_radians: tuple[float, float] = (0.0, 1.0)
    clip: bool = True
    translation: tuple[float, float, float] | None = None
    rotation_deg: tuple[float, float, float] = (0.0, 0.0, 0.0)
    translation_frame: str = "rotated_local"

    @staticmethod
    def of(values: dict[str, Any] | None) -> dict[str, Any]:
        """The keys of sections `pose_transform` and `gripper` as those of this class."""
        out = dict(values or {})
        _only(out, "tail_policy", "repeat_last", "trajectory")
        move, grip = dict(out.pop("pose_transform", None) or {}), dict(out.pop("gripper", None) or {})
        if move.pop("enabled", bool(move)):
            _only(move, "rotation_order", "intrinsic_xyz", "trajectory.pose_transform")
            turn = move.pop("rotation_deg", (0.0, 0.0, 0.0))
            out |= {"translation": tuple(move.pop("translation_m", (0.0, 0.0, 0.0))), "rotation_deg": tuple(turn[a] for a in "xyz") if isinstance(turn, dict) else tuple(turn)}
            out |= {"translation_frame": move.pop("translation_frame", "rotated_local")}
            if move:
                raise ValueError(f"trajectory.pose_transform: unknown keys {', '.join(sorted(move))}")
        _only(grip, "mapping", "linear", "trajectory.gripper")
        # the sections' names in a calibration file, whose numbers are observed_width and gripper_radians here
        grip = {k: v for k, v in grip.items() if k not in ("distance_section", "radians_section")}
        return out | grip

    def __post_init__(self):
        if self.action_offset_frames < 0:
            raise ValueError("action_offset_frames must not be negative")


@dataclass(frozen=True)
class Smoothing:
    enabled: bool = False
    window_size: int = 5
    passes: int = 1
    preserve_endpoint_frames: int = 2

    def __post_init__(self):
        if self.window_size < 3 or self.window_size % 2 == 0:
            raise ValueError("window_size must be odd and 3 at least")


@dataclass(frozen=True)
class StepLimit:
    enabled: bool = False
    percentile: float = 95
    position_tolerance_mm: float = 0.01
    rotation_tolerance_deg: float = 0.01
    preserve_endpoint_frames: int = 1
    max_sweeps: int = 3000
    storage_margin: float = 0.999

    def __post_init__(self):
        if self.position_tolerance_mm < 0 or self.rotation_tolerance_deg < 0:
            raise ValueError("tolerances must not be negative")


@dataclass(frozen=True)
class Trim:
    enabled: bool = False
    position_threshold: float = 0.005
    rotation_threshold_deg: float = 3.0
    gripper_threshold: float = 0.05
    pre_roll_frames: int = 0
    post_roll_frames: int = 0
    min_episode_frames: int = 32
    min_active_frames: int = 1


@dataclass(frozen=True)
class Sparsification:
    enabled: bool = False
    prefix_frames: int = 50
    prefix_min_spacing: float = 0.001
    turn_angle_threshold_deg: float = 3.0
    turn_context_frames: int = 2
    min_turn_context_distance: float = 0.0005
    dense_step_threshold: float = 0.0015
    max_kept_step: float = 0.003
    max_position_error: float = 0.0005
    max_rotation_error_deg: float = 0.3
    gripper_change_threshold: float = 0.02
    max_consecutive_removed: int = 1


@dataclass(frozen=True)
class Place:
    """Where a run reads and writes, if its command does not say so."""

    root: str | None = None
    chunks_size: int = 1000
    overwrite: bool = False


@dataclass(frozen=True)
class Settings:
    trajectory: Trajectory = field(default_factory=Trajectory)
    smoothing: Smoothing = field(default_factory=Smoothing)
    step_limit: StepLimit = field(default_factory=StepLimit)
    trim: Trim = field(default_factory=Trim)
    turn_sparsification: Sparsification = field(default_factory=Sparsification)
    fps: int = 30
    source: str | None = None
    output: Place = field(default_factory=Place)
    prompt: str | None = None
    unused: tuple[str, ...] = ()

    @staticmethod
    def of(values: dict[str, Any], strict: bool = True) -> Settings:
        """strict: a section that is none of these is an error; else its name is kept in `unused`."""
        kinds = {"trajectory": Trajectory, "smoothing": Smoothing, "step_limit": StepLimit, "trim": Trim, "turn_sparsification": Sparsification}
        unknown = sorted(values.keys() - kinds.keys() - {"fps", "source", "output", "task"})
        if unknown and strict:
            raise ValueError(f"unknown sections {', '.join(unknown)}")
        values = values | {"trajectory": Trajectory.of(values.get("trajectory"))}
        parts = {k: _build(kind, values.get(k), k) for k, kind in kinds.items()}
        task, source = dict(values.get("task") or {}), dict(values.get("source") or {})
        return Settings(
            **parts, fps=values.get("fps", 30), source=source.get("root"), output=_build(Place, values.get("output"), "output"), prompt=task.get("prompt"), unused=tuple(unknown),
        )


def load(path: str, strict: bool = False) -> Settings:
    import yaml

    with open(path) as f:
        values = yaml.safe_load(f)
    if not isinstance(values, dict):
        raise ValueError(f"{path}: a mapping is expected")
    return Settings.of(values, strict)


def safe_output(output: str, *sources: str) -> str:
    """output, if it isn't a source, in one, or around one, and lies deep enough to be replaced."""
    import os

    out = os.path.abspath(output)
    if len(out.strip("/").split("/")) < 3:
        raise ValueError(f"{output} is too near the root")
    for s in map(os.path.abspath, sources):
        if out == s or out.startswith(s + "/") or s.startswith(out + "/"):
            raise ValueError(f"{output} overlaps {s}")
    return out
