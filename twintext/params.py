"""Parameters of a preparation run, with the defaults of the original recipe."""

from __future__ import annotations

from dataclasses import dataclass

# Names of the special tokens. Their ids follow the learned
# tokens, and padding sits between start and end.
START_TOKEN = "<START>"
END_TOKEN = "<END>"
PADDING_TOKEN = "<PAD>"
UNKNOWN_TOKEN = "<UNK>"

BYTE_TOKENS = 256


def special_tokens(vocab_size: int = 500) -> dict[str, int]:
    """Ids of the special tokens behind ``vocab_size`` learned ones."""
    names = (START_TOKEN, PADDING_TOKEN, END_TOKEN)
    return {name: vocab_size + k for k, name in enumerate(names)}


@dataclass(frozen=True)
class PrepParams:
    """Knobs of corpus preparation and example building."""

    # Split shares, limits, seed and sizes of the recipe.
    train_ratio: float = 0.5
    val_ratio: float = 0.25
    test_ratio: float = 0.25
    max_length: int = 300
    seed: int = 1
    vocab_size: int = 500
    batch_size: int = 64
    log_every: int = 1000
    epochs: int = 10
    # Rows to keep of each split; all of them unless a cap is asked for.
    max_train_size: int | None = None
    max_val_size: int | None = None
    max_test_size: int | None = None

    @property
    def start_id(self) -> int:
        return special_tokens(self.vocab_size)[START_TOKEN]

    @property
    def pad_id(self) -> int:
        return special_tokens(self.vocab_size)[PADDING_TOKEN]

    @property
    def end_id(self) -> int:
        return special_tokens(self.vocab_size)[END_TOKEN]

    def cap(self, split: str) -> int | None:
        return {
            "train": self.max_train_size,
            "val": self.max_val_size,
            "test": self.max_test_size,
        }[split]


SPLITS = ("train", "val", "test")
