"""The queries of the text operators."""

from framelake.llm import (  # noqa: F401
    chat, disclosure, forest, language, mixing, negatives, periodic, pieces, pitman, secrets, spaced, syncmers, templates)
from framelake.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
