"""Preparation of conversations as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.config import DEFAULT_TEMPLATE, ChatTemplate, PrepareConfig
from dialogprep.functions.hashing import in_hash_share
from dialogprep.functions.template import render_chat
from dialogprep.operators.prepare import prepare_dialogs

DEFAULT = PrepareConfig()


def prepare_stream(
    dialogs: DataFrame, cfg: PrepareConfig = DEFAULT, tpl: ChatTemplate = DEFAULT_TEMPLATE
) -> DataFrame:
    """Prepared, rendered and split conversations of a stream of dialogues.

    Stateless: a conversation arrives whole. An exact hold-out needs the total,
    which a stream does not have, so ids are held out by hash share.
    """
    held_out = in_hash_share(F.col("conv_id"), cfg.seed, cfg.val_fraction)
    return (
        prepare_dialogs(dialogs, cfg)
        .withColumn("text", render_chat(F.col("messages"), tpl=tpl, with_bos=F.col("part") == 0))
        .withColumn("split", F.when(held_out, "val").otherwise("train"))
    )
