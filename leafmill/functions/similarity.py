"""Text functions that Spark has no expression for, over Arrow batches: accents and gestalt similarity."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

LABEL = T.StructType([T.StructField("field", T.StringType()), T.StructField("similarity", T.DoubleType())])


def plain(text: str) -> str:
    """NFKD without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def label_text(text: str) -> str:
    """A page label's normal form: no accents, lower case, zero read as o, other characters to single spaces."""
    return re.sub("[^a-z0-9]+", " ", plain(text).lower().replace("0", "o")).strip()


def date_text(text: str) -> str:
    """A date item's normal form; zeros and date separators stay."""
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9/.\-\s]", " ", plain(text.lower()))).strip()


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def most_ratio(a: str, b: str) -> float:
    """What ratio() cannot exceed: characters in common, in any order."""
    return SequenceMatcher(None, a, b).quick_ratio()


class Labels:
    """Labels in a normal form (ASCII) and how near texts can come to them."""

    def __init__(self, labels: list[str]) -> None:
        self.labels = labels
        self.lengths = np.array([len(x) for x in labels])
        self.counts = self.counted(labels)

    @staticmethod
    def counted(texts: list[str]) -> np.ndarray:
        """How often each ASCII character is in each text."""
        raw = [t.encode("ascii") for t in texts]
        row = np.repeat(np.arange(len(raw)), np.array([len(x) for x in raw], int))
        return np.bincount(row * 128 + np.frombuffer(b"".join(raw), np.uint8), minlength=128 * len(raw)).reshape(-1, 128).astype(np.int16)

    def bounds(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters in common with each label, in any order, and the ratio that they allow: ratio() is that at most."""
        seen = np.flatnonzero(self.counts.any(axis=0))
        own, length = self.counted(texts)[:, seen], np.array([len(t) for t in texts], int)
        common = np.stack([np.minimum(own, c).sum(axis=1) for c in self.counts[:, seen]], axis=1).astype(int)
        return common, 2.0 * common / np.maximum(length[:, None] + self.lengths, 1)

    def best(self, texts: list[str], least: float = 0.0) -> list[float]:
        """The largest ratio of each text to a label; 0 where none can reach least."""
        out = []
        for t, bound in zip(texts, self.bounds(texts)[1]):
            top = 0.0
            for j in np.argsort(-bound, kind="stable").tolist() if bound.max() >= least else []:
                if bound[j] <= top:
                    break
                top = max(top, ratio(t, self.labels[j]))
            out.append(top if t else 0.0)
        return out


def label_similarity(text: str, label: str) -> float:
    """1 if the label is in the text, 0.95 for the reverse from four characters on, else the larger of gestalt ratio and shared words."""
    if not text or not label:
        return 0.0
    if label in text:
        return 1.0
    if text in label and len(text) >= 4:
        return 0.95
    words = set(label.split())
    return max(ratio(text, label), len(set(text.split()) & words) / len(words))


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    return texts.map(plain, na_action="ignore")


@F.pandas_udf(T.StringType())
def normal_label(texts: pd.Series) -> pd.Series:
    return texts.map(label_text, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def gestalt(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def best_label(labels: dict[str, list[str]], least: float = 0.58):
    """A function of texts to (field, similarity) of their best label, null below least; labels by field, in order of preference."""
    known = {f: [label_text(x) for x in xs] for f, xs in labels.items()}

    @F.pandas_udf(LABEL)
    def best(texts: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        for t in texts.dropna().unique():
            n = label_text(t)
            score, field = max(((max(label_similarity(n, x) for x in xs), f) for f, xs in known.items()), key=lambda y: y[0])
            memo[t] = (field, score) if score >= least else (None, None)
        return pd.DataFrame([memo.get(t, (None, None)) for t in texts], columns=["field", "similarity"])

    return best
