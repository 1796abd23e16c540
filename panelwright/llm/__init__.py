"""Operators for large text corpora and their queries; nothing else in the
library imports this subpackage."""

import sys

from pyspark import cloudpickle

from panelwright.llm import (  # noqa: F401
    byte_bpe,
    chat,
    decontamination,
    exact,
    extraction,
    filter_audit,
    parity_join,
    quality,
    simhash,
    token_alignment,
    token_counts,
    toxicity,
    warc,
)
from panelwright.llm.base import CORPUS

# Functions of this subpackage travel to the executors by value, so that the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CORPUS"]
