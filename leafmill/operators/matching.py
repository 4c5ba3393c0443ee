"""Near-duplicate identities and fuzzy labels: what needs gestalt similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from leafmill.functions.similarity import best_label, gestalt
from leafmill.sources.tables import written

#: Labels of page fields; fixed values.
FIELD_LABELS = {
    "passport_number": ["passport no", "passport no.", "passport number", "document no", "document number", "numero de passeport", "no de passeport", "numero de pasaporte", "passport nr"],
    "surname": ["surname", "family name", "last name", "nom", "apellido", "apellidos"],
    "given_names": ["given name", "given names", "given name(s)", "first name", "first names", "prenoms", "prenom", "nombre", "nombres"],
    "nationality": ["nationality", "nationalite", "nacionalidad", "citizenship"],
    "date_of_birth": ["date of birth", "birth date", "date de naissance", "fecha de nacimiento", "datum urodzenia", "geburtsdatum"],
    "sex": ["sex", "gender", "sexe", "sexo", "geschlecht"],
    "date_of_expiry": ["date of expiry", "expiry date", "date of expiration", "expiration date", "date d expiration", "date dexpiration", "fecha de caducidad", "fecha de vencimiento", "valid until", "valid thru"],
}


def labelled_items(items: DataFrame, least: float = 0.58) -> DataFrame:
    """items with the field whose label their text resembles best, over distinct texts only."""
    texts = items.select("text").distinct().withColumn("m", best_label(FIELD_LABELS, least)("text"))
    return items.join(texts, "text", "left").select(*items.columns, F.col("m.field").alias("label_field"), F.col("m.similarity").alias("label_similarity"))


def bits(of: str) -> Column:
    """64 bits of which each value of an array, given as SQL, sets one."""
    return F.expr(f"aggregate({of}, 0L, (m, x) -> m | shiftleft(1L, cast(pmod(xxhash64(x), 64) as int)))")


def character_bits(text: str) -> Column:
    """Bits of a column's characters, each with how often it has come before. One character more or less changes one bit at most."""
    before = f"substr({text}, 1, i)"
    return bits(f"transform(sequence(1, greatest(length({text}), 1)), i -> concat(substr({text}, i, 1), length(replace({before}, substr({text}, i, 1), '')) - i))")


def bigram_bits(text: str) -> Column:
    """Bits of a column's pairs of neighbouring characters, its ends included. One character more or less changes three bits at most."""
    return bits(f"transform(sequence(1, length({text}) + 1), i -> substr(concat(' ', {text}, ' '), i, 2))")


def near_duplicate_identities(rows: DataFrame, most: int = 200, least: float = 6.0) -> DataFrame:
    """Pairs of samples of different identities that look alike: 3 for the birth date, 2.5 for the expiry, 2.5 for a surname ratio of 0.9,
    3 for a passport number ratio of 0.85. A pair below both dates reaches 5.5 at most, so pairs meet by equal dates, and no others need be made.

    Samples of equal values are compared once. A ratio of x leaves (1 - x) of both texts' characters unmatched at most, which bounds how many bits of their
    characters and bigrams can differ, and so the score. Pairs whose bound is below least are dropped within the join. Of the others those of the highest bound
    are scored first, and the rest only while they can still come before the most best pairs.
    """
    ratios, dates = {"surname": 0.9, "passport_number": 0.85}, ["date_of_birth", "date_of_expiry"]
    values = ["passport_number", "surname", *dates]
    equal = Window.partitionBy(*values)
    r = rows.select("sample_id", "suggested_id", *values, F.min("sample_id").over(equal).alias("look"), (F.min("suggested_id").over(equal) != F.max("suggested_id").over(equal)).alias("mixed"))
    kinds = {"characters": character_bits, "bigrams": bigram_bits, "length": F.length}
    told = written(r.select("*", *[F.when(F.col("sample_id") == F.col("look"), f(c)).alias(f"{c}_{k}") for c in ratios for k, f in kinds.items()]), "looks")
    looks, samples = told.where("sample_id = look").drop("sample_id", "suggested_id"), told.select("sample_id", "suggested_id", *values, "look")
    sided = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    same = lambda c: F.coalesce(F.col(f"left_{c}") == F.col(f"right_{c}"), F.lit(False))
    like = lambda c: F.coalesce(gestalt(F.when(F.col(f"may_{c}"), F.col(f"left_{c}")), F.col(f"right_{c}")) >= ratios[c], F.lit(False))

    def may(c: str) -> Column:
        differ = lambda k: F.bit_count(F.col(f"left_{c}_{k}").bitwiseXOR(F.col(f"right_{c}_{k}")))
        unmatched = F.floor((F.col(f"left_{c}_length") + F.col(f"right_{c}_length")) * (1 - ratios[c]) + 1e-6)
        return F.coalesce((differ("bigrams") <= 3 * unmatched) & (differ("characters") <= unmatched), F.lit(False))

    def score(alike: Callable[[str], Column]) -> Column:
        points = lambda when, n: F.when(when, n).otherwise(0.0)
        return points(same("date_of_birth"), 3.0) + points(same("date_of_expiry"), 2.5) + points(alike("surname"), 2.5) + points(alike("passport_number"), 3.0)

    left, right = sided(looks, "left"), sided(looks, "right")
    on = lambda c: (F.col(f"left_{c}") == F.col(f"right_{c}")) & (score(may) >= least) & ((F.col("left_look") != F.col("right_look")) | F.col("left_mixed"))
    pairs = left.join(right, on("date_of_birth")).unionByName(left.join(right, on("date_of_expiry") & ~same("date_of_birth")))
    kept = [f"{side}_{c}" for side in ("left", "right") for c in ("look", *values)]
    met = written(pairs.select(*kept, *[may(c).alias(f"may_{c}") for c in ratios]), "met").withColumn("bound", score(lambda c: F.col(f"may_{c}")))

    def best(pairs: DataFrame) -> DataFrame:
        scored = pairs.select("left_look", "right_look", score(like).alias("hint_score")).where(F.col("hint_score") >= least)
        each = scored.join(sided(samples, "left"), "left_look").join(sided(samples, "right"), "right_look")
        each = each.where((F.col("left_sample_id") < F.col("right_sample_id")) & (F.col("left_suggested_id") != F.col("right_suggested_id")))
        return first(each.select(*[f"{side}_{c}" for side in ("left", "right") for c in samples.columns if c != "look"], "hint_score"))

    first = lambda df: df.orderBy(F.desc("hint_score"), "left_sample_id", "right_sample_id").limit(most)
    bounds = sorted((b for b, in met.select("bound").distinct().collect()), reverse=True)
    found = best(met.limit(0))
    for bound, below in zip(bounds, [*bounds[1:], None]):
        found = written(first(found.unionByName(best(met.where(F.col("bound") == bound)))), "found")
        if below is not None and found.where(F.col("hint_score") > below).count() >= most:
            break
    return first(found)
