"""What surrounds models: batches of images through a detector or recogniser that the caller brings, and items from their nested results."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

ITEM = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("confidence", "x1", "y1", "x2", "y2")]]))


def first_value(x, key: str):
    """The value of a key at any depth, depth first; a null is taken for absent below the level at which it stands."""
    if isinstance(x, dict):
        if key in x:
            return x[key]
        x = list(x.values())
    if isinstance(x, list):
        return next((v for v in (first_value(y, key) for y in x) if v is not None), None)
    return None


def number(x) -> float | None:
    try:
        return None if x is None or isinstance(x, bool) else float(x)
    except (TypeError, ValueError):
        return None


def box_of(value) -> list[float] | None:
    """x1, y1, x2, y2 of a flat list of four numbers or more, or around a polygon's points."""
    if not isinstance(value, list) or not value:
        return None
    if all(isinstance(p, list) for p in value):
        points = [(number(p[0]), number(p[1])) for p in value if len(p) >= 2]
        if not points or any(None in p for p in points):
            return None
        xs, ys = zip(*points)
        return [min(xs), min(ys), max(xs), max(ys)]
    four = [number(v) for v in value[:4]]
    return four if len(four) == 4 and None not in four else None


def items_in(result: str | None) -> list[dict]:
    """The items of one result: texts with their scores and boxes by place; what is missing or unreadable is null."""
    try:
        tree = json.loads(result or "null")
    except ValueError:
        return []
    texts, scores, boxes, polygons = (first_value(tree, f"rec_{k}") for k in ("texts", "scores", "boxes", "polys"))
    at = lambda xs, i: xs[i] if isinstance(xs, list) and i < len(xs) else None
    out = []
    for i, text in enumerate(texts if isinstance(texts, list) else []):
        box = box_of(at(boxes, i)) or box_of(at(polygons, i)) or [None] * 4
        out.append({"text": str(text), "confidence": number(at(scores, i)), **dict(zip(("x1", "y1", "x2", "y2"), box))})
    return out


@F.pandas_udf(ITEM)
def found_items(results: pd.Series) -> pd.Series:
    return results.map(items_in)


def items_of(results: DataFrame) -> DataFrame:
    """sample_id, pos, text, confidence and box of the items in JSON results (sample_id, result)."""
    each = results.select("sample_id", F.posexplode(found_items("result")).alias("pos", "i"))
    return each.select("sample_id", F.col("pos").cast("long").alias("pos"), "i.*")


RESULT = "sample_id string, status string, result string, text_count long, mean_confidence double, elapsed_seconds double, error string"


def recognised(images: DataFrame, load: Callable[[], Callable[[bytes], object]]) -> DataFrame:
    """Each image (sample_id, content) through a model that load() makes once in each worker: its result as JSON, counts, time, and errors as data."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            rows = []
            for sample, content in zip(frame["sample_id"], frame["content"]):
                began = time.perf_counter()
                try:
                    if content is None:
                        raise FileNotFoundError("no image")
                    result, error = json.dumps(model(bytes(content)), ensure_ascii=False), None
                    status = "success"
                except FileNotFoundError as e:
                    result, status, error = None, "image_missing", str(e)
                except Exception as e:  # a model's failure on one image is that image's result
                    result, status, error = None, "error", f"{type(e).__name__}: {e}"
                found = items_in(result)
                sure = [i["confidence"] for i in found if i["confidence"] is not None]
                rows.append((sample, status, result, len(found), sum(sure) / len(sure) if sure else None, time.perf_counter() - began, error))
            yield pd.DataFrame(rows, columns=["sample_id", "status", "result", "text_count", "mean_confidence", "elapsed_seconds", "error"])

    return images.select("sample_id", "content").mapInPandas(run, RESULT)


DETECTION = "sample_id string, status string, class string, confidence double, x1 double, y1 double, x2 double, y2 double, error string"
#: Least confidence of a detection; a fixed value.
LEAST_CONFIDENCE = 0.25


def detected(images: DataFrame, load: Callable[[], Callable[[bytes], list[tuple[str, float, list[float]]]]], classes: tuple[str, ...] = ("passport_page", "mrz")) -> DataFrame:
    """The most confident detection of each class in each image, by a model from content to (class, confidence, box); an image without any, and a failure, is one row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            rows = []
            for sample, content in zip(frame["sample_id"], frame["content"]):
                try:
                    found = [x for x in model(bytes(content)) if x[0] in classes and x[1] >= LEAST_CONFIDENCE]
                    best = [max((x for x in found if x[0] == c), key=lambda x: x[1]) for c in classes if any(x[0] == c for x in found)]
                    rows += [(sample, "success", c, p, *map(float, box[:4]), None) for c, p, box in best] or [(sample, "nothing_found", *[None] * 7)]
                except Exception as e:  # as above
                    rows.append((sample, "image_read_failed" if content is None else "unexpected_error", *[None] * 6, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["sample_id", "status", "class", "confidence", "x1", "y1", "x2", "y2", "error"])

    return images.select("sample_id", "content").mapInPandas(run, DETECTION)
