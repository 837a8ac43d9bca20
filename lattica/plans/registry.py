"""Modality registry: a type's reader and its DataFrame-to-DataFrame plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Modality:
    read: Callable[[SparkSession, str], DataFrame]
    plan: Callable[[DataFrame, dict], DataFrame]


_known: dict[str, Modality] = {}


def register(kind: str, modality: Modality) -> None:
    if kind in _known:
        raise ValueError(f"{kind} is registered already")
    _known[kind] = modality


def process(spark: SparkSession, kind: str, path: str, settings: dict) -> DataFrame:
    if kind not in _known:
        raise KeyError(f"unknown modality {kind!r}; known: {sorted(_known)}")
    m = _known[kind]
    return m.plan(m.read(spark, path), settings)
