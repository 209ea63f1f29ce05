"""Dialogue corpora on Spark: repair, cut, split, render, size, evaluate.

Every public function takes and returns a DataFrame or a Column; see the
README for the table of operators.
"""

from dialogprep.config import DEFAULT_TEMPLATE, ChatTemplate, PrepareConfig

__all__ = ["ChatTemplate", "DEFAULT_TEMPLATE", "PrepareConfig"]
