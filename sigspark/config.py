"""Settings shared by all operators.

The defaults are fixed values: results only agree with earlier runs of the
same pipeline while they stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

# Class words in matching order, and the two word lists.
CLASSES = ("kick", "snare", "hat", "tom")
BLACK_WORDS = ("roll", "stomp", "enhancer")
IGNORE_WORDS = ("that",)

REASONS = (
    "unreadable",
    "blacklisted",
    "ignored",
    "unlabelled",
    "unreadable_trim",
    "too_long",
    "too_quiet",
)


@dataclass(frozen=True)
class Settings:
    # signal
    sample_rate: int = 22050
    frame_length: int = 2048
    hop_divisor: int = 4
    max_frames: int = 44
    min_rms: float = 0.02
    max_seconds: float = 5.0
    # onsets
    onset_hop: int = 110  # sample_rate / 200
    onset_silence: float = 1.0
    onset_margin: float = 0.01
    onset_delta: float = 0.07
    onset_pre_max: int = 6
    onset_average: int = 20
    onset_wait: int = 6
    # features
    loud_share: float = 0.02
    n_cepstral: int = 13
    n_mels: int = 128
    tensor_width: int = 256
    # preparation
    cap_per_class: int = 750
    test_share: float = 0.25
    validation_share: float = 0.1
    impute_rounds: int = 25
    impute_tolerance: float = 1e-3
    # augmentation
    min_per_class: int = 800
    pitch_steps: tuple = (-5, -4, -3, -2, -1, 0, 1, 2, 3, 4)
    stretch_factors: tuple = (0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4)
    # models
    forest_trees: int = 500
    boost_rounds: int = 200
    boost_rate: float = 0.1
    boost_depth: int = 3
    neighbours: int = 5
    net_layers: tuple = (64, 32, 16)
    net_epochs: int = 300
    net_batch: int = 16
    patience: int = 10
    # every random choice is a hash of this and a row id, so runs repeat
    seed: int = 7


DEFAULT = Settings()
