"""Words and spreading of text work, shared by the text operators."""

from __future__ import annotations

import unicodedata

import regex
from pyspark.sql import DataFrame

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_UNSEEN = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")


def plain(text: str) -> str:
    """Text in NFKD without accents and invisible format characters, in one case."""
    if text.isascii():
        return text.lower()
    return _UNSEEN.sub("", unicodedata.normalize("NFKD", _UNSEEN.sub("", unicodedata.normalize("NFKD", text)).casefold()))


def words(text: str | None) -> list[str]:
    """Runs of letters and digits; case, accents, compatibility forms, format characters, punctuation don't count."""
    return _WORD.findall(plain(text)) if text else []


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions for Python work to use all cores, where a small table comes in fewer files."""
    least = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)
