"""Constants and settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values ---------------------------------------------------------
# These must be exactly what trained models and existing data expect.

ROLE_USER = "user"
ROLE_MODEL = "model"
REPLY_ROLES = ("model", "assistant")
KNOWN_ROLES = ("user", "model", "assistant")

BOS = "<bos>"
EOS = "<eos>"
PAD = "<pad>"
TURN_OPEN = "<start_of_turn>"
TURN_CLOSE = "<end_of_turn>"

STOP_MARKERS = (TURN_CLOSE, EOS)
SPECIAL_TOKENS = (BOS, EOS, PAD, TURN_OPEN, TURN_CLOSE)

CMD_RESET = "/reset"
CMD_EXIT = "/exit"

EVAL_PROMPTS = (
    "Hey, how's your day going?",
    "What do you think about pineapple on pizza?",
    "I had a rough week honestly.",
    "Got any plans for the weekend?",
    "Do you ever get nervous before a big meeting?",
)

NO_REPEAT_NGRAM = 3
REPLY_CAP = 60
CHAT_REPLY_CAP = 80

TRAIN_BATCH = 32
DEVICE_BATCH = 16
TRAIN_EPOCHS = 3
WARMUP_SHARE = 0.03
TRAIN_MAX_UNITS = 1024
DRY_RUN_MAX_UNITS = 512
DRY_RUN_ROWS = 64
KEEP_CHECKPOINTS = 2
# --- End of fixed values --------------------------------------------------


# What a persona should not say; audits take any other list.
ASSISTANT_PHRASES = (
    "as an AI",
    "as a language model",
    "I am programmed to",
    "I can help you",
    "I'm here to help",
    "how may I assist",
    "I don't have feelings",
)

# More messages than any conversation has.
WHOLE = 1 << 30


@dataclass(frozen=True)
class PrepareConfig:
    """Knobs of the corpus preparation.

    A conversation is one row, however long. ``part_messages`` can be set lower
    to store long conversations as several rows numbered by ``part``, each of
    which starts with a user turn and ends on a reply; operators then work on
    the parts.
    ``block_rows`` bounds one window group when a single conversation holds a
    large share of a turn table.
    """

    min_chars: int = 2
    max_chars: int = 500
    min_turns: int = 2
    val_fraction: float = 0.05
    seed: int = 42
    part_messages: int = WHOLE
    block_rows: int = 65536

    def __post_init__(self) -> None:
        if self.part_messages < 2 or self.part_messages % 2:
            raise ValueError("part_messages must be even, so that parts end on a reply")
        if self.min_turns < 1:
            raise ValueError("min_turns must be at least 1")
        if self.block_rows < 1:
            raise ValueError("block_rows must be positive")

    @property
    def min_kept(self) -> int:
        """Fewest messages a kept conversation can have (always user + reply)."""
        return max(2, self.min_turns)


@dataclass(frozen=True)
class ChatTemplate:
    """Delimiters of the chat format."""

    bos: str = BOS
    turn_open: str = TURN_OPEN
    turn_close: str = TURN_CLOSE
    reply_role: str = ROLE_MODEL
    reply_roles: tuple[str, ...] = REPLY_ROLES


DEFAULT_TEMPLATE = ChatTemplate()
