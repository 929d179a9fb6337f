"""Operators for training-data pipelines. Nothing outside this folder imports them."""

from goldseam.llm import (  # noqa: F401
    bpe,
    filteraudit,
    hostrules,
    htmltext,
    licences,
    ngramjoin,
    packing,
    passages,
    quality,
    secrets,
    spelling,
    tokenfiles,
    topk,
)
from goldseam.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
