"""Parameters of the transcript operators. They may come from environment variables of the same upper-case names."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    # Names and defaults, so that one environment means the same everywhere.
    language: str = "korean"
    word_chunk_seconds: float = 0.0
    word_chunk_stride_seconds: float = 5.0
    speaker_label_format: str = "화자{index}"
    unknown_speaker_label: str = "화자미상"
    num_speakers: int = 2
    min_speakers: int = 2
    speaker_merge_max_gap: float = 1.0
    speaker_merge_max_chars: int = 300
    overlap_tie_tolerance: float = 0.05
    speaker_smooth_max_chunks: int = 2
    speaker_smooth_max_seconds: float = 0.8
    speaker_smooth_max_gap: float = 0.05
    timestamp_reset_tolerance: float = 0.5
    timeline_coverage_min_ratio: float = 0.9
    min_missing_speech_seconds: float = 1.0
    missing_speech_retry_padding_seconds: float = 0.5
    missing_speech_max_retry_seconds: float = 20.0
    word_coverage_padding_seconds: float = 0.15
    speech_coverage_gap: float = 0.10
    word_coverage_gap: float = 0.05
    missing_speech_retry_loops: int = 1
    recovered_center_tolerance: float = 0.5
    min_retry_word_probability: float = 0.35
    turn_gap_ms: int = 1000
    max_input_tokens: int = 8192
    output_token_margin: int = 256
    output_token_ratio: float = 0.5
    max_new_tokens: int = 12288
    min_new_tokens: int = 128
    max_inference_seconds: float = 600.0
    inference_tokens_per_second: float = 20.0
    truncated_tail_chars: int = 300

    def __post_init__(self) -> None:
        for name in ("speaker_merge_max_gap", "overlap_tie_tolerance", "timestamp_reset_tolerance", "missing_speech_max_retry_seconds"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} can't be negative")
        if self.missing_speech_max_retry_seconds == 0:
            raise ValueError("missing_speech_max_retry_seconds must be positive")
        if "{index}" not in self.speaker_label_format:
            raise ValueError("speaker_label_format needs {index}")

    @classmethod
    def from_environment(cls, environment: dict[str, str] | None = None) -> Config:
        """The defaults with what the environment sets; a value of the wrong type is an error."""
        environment = os.environ if environment is None else environment
        found = {}
        for f in fields(cls):
            text = environment.get(f.name.upper())
            if text is not None and text.strip():
                found[f.name] = type(f.default)(text)
        return cls(**found)


DEFAULT = Config()
