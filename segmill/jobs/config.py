"""Settings of a segmentation run, with presets and checks."""

from __future__ import annotations

from dataclasses import dataclass, replace

from segmill.functions.protected import PROTECTED
from segmill.functions.scores import checked_stride

MODES = ("threshold", "fixed", "random")
GENERATORS = ("mersenne", "hash")
#: Named sizes of segments, in tokens.
PRESETS = {
    "short": {"fixed_segment_tokens": 64, "random_min_tokens": 64, "random_max_tokens": 128},
    "base": {"fixed_segment_tokens": 128, "random_min_tokens": 64, "random_max_tokens": 256},
    "long": {"fixed_segment_tokens": 256, "random_min_tokens": 128, "random_max_tokens": 512},
}


@dataclass(frozen=True)
class SegmentConfig:
    mode: str = "threshold"
    tau: float | None = None  # threshold mode needs one when it runs; full_run() estimates it
    fixed_segment_tokens: int = 128
    random_min_tokens: int = 64
    random_max_tokens: int = 256
    random_seed: int = 42
    random_generator: str = "mersenne"
    max_length: int = 8192
    min_step_tokens: int = 12
    min_step_chars: int = 8
    relocation_window: int = 3
    window: int = 4096
    stride: int | None = None
    limit_rows: int | None = None
    long_policy: str = "window"
    special_tokens: tuple[str, ...] = ()
    protected_strings: tuple[str, ...] = PROTECTED

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")
        if self.random_generator not in GENERATORS:
            raise ValueError(f"random_generator must be one of {GENERATORS}, not {self.random_generator!r}")
        if self.long_policy not in ("window", "skip"):
            raise ValueError("long_policy must be 'window' or 'skip'")
        for name in ("fixed_segment_tokens", "random_min_tokens", "random_max_tokens", "max_length", "min_step_tokens", "min_step_chars", "window"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        checked_stride(self.window, self.stride)
        if not all(self.protected_strings):
            raise ValueError("a protected string must not be empty")
        if self.random_min_tokens > self.random_max_tokens:
            raise ValueError("random_min_tokens must not exceed random_max_tokens")
        if self.mode == "fixed" and self.fixed_segment_tokens < self.min_step_tokens:
            raise ValueError("fixed_segment_tokens must be at least min_step_tokens")
        if self.mode == "random" and self.random_min_tokens < self.min_step_tokens:
            raise ValueError("random_min_tokens must be at least min_step_tokens")

    @classmethod
    def preset(cls, name: str, **changes) -> SegmentConfig:
        return cls(**{**PRESETS[name], **changes})

    def with_(self, **changes) -> SegmentConfig:
        return replace(self, **changes)
