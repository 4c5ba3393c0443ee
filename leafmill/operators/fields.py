"""Page fields from recognised items: labels by similarity, typed values beside them or in the same item, best per variant, consensus and record.

Items: sample_id, variant, vi, pos, text, x1, y1, x2, y2, confidence. All joins are within a variant of a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions import scalars as S
from leafmill.functions.dialect import SPARK, operator
from leafmill.functions.mining import inline_values, label_table, page_date
from leafmill.operators.matching import FIELD_LABELS

LEAST_SIMILARITY = 0.58
FEW_TEXTS, LOW_CONFIDENCE = 5, 0.8


def typed(field: Column, text: Column) -> Column:
    """The normal form of a value for its field; null where it is none."""
    trimmed = F.expr(S.value_trimmed(SPARK, "text"))
    letters = F.regexp_count(trimmed, F.lit(r"\p{L}"))
    day = page_date(text)
    named = (F.length(trimmed) >= 2) & day.isNull()
    by_field = F.when(field == "passport_number", F.expr(S.passport_normal(SPARK, "text"))).when(field.startswith("date"), day).when(field == "sex", F.expr(S.sex_normal(SPARK, S.value_trimmed(SPARK, "text"))))
    return by_field.when(field.isin("surname", "given_names"), F.when(named & (letters >= 2), F.upper(trimmed))).when(field == "nationality", F.when(named & (letters >= 1), F.upper(trimmed)))


def labelled(items: DataFrame) -> DataFrame:
    """items with the fields (and similarities) that their text labels; texts are looked at once."""
    texts = items.select(F.col("text").alias("label_text")).distinct().withColumn("labels", label_table(FIELD_LABELS, LEAST_SIMILARITY)("label_text"))
    return items.join(texts, F.col("text").eqNullSafe(F.col("label_text"))).select(*items.columns, "labels")


def typed_values(items: DataFrame) -> DataFrame:
    """Items that label nothing, once for each field that their text can be a value of; texts are looked at once."""
    texts = items.where((F.size("labels") == 0) & (F.trim("text") != "")).select("text").distinct()
    each = texts.select("text", F.explode(F.array(*[F.lit(f) for f in FIELD_LABELS])).alias("field")).withColumn("value", typed(F.col("field"), F.col("text"))).where("value is not null")
    return items.join(each, "text")


def field_candidates(items: DataFrame) -> DataFrame:
    """The best value of each field in each variant of a sample, the first of equals: sample_id, variant, vi, field, value, method, score."""
    known = labelled(items)
    box = F.struct("x1", "y1", "x2", "y2")
    key = ["sample_id", "variant", "vi", "field"]
    labels = known.select("sample_id", "variant", "vi", F.col("pos").alias("lpos"), "text", "confidence", box.alias("a"), F.explode("labels").alias("field", "similarity"))
    own = labels.withColumn("value", inline_values(FIELD_LABELS)("text", "field")).where("value is not null")
    inline = own.select(*key, "value", F.lit("inline").alias("method"), (7 + 2 * F.col("similarity") + F.coalesce("confidence", F.lit(0.0))).alias("score"), F.struct(F.lit(0).alias("stage"), "lpos", F.lit(0).alias("vpos")).alias("turn"))
    values = typed_values(known).select("sample_id", "variant", "vi", "field", "value", F.col("pos").alias("vpos"), F.coalesce("confidence", F.lit(0.0)).alias("c"), box.alias("b"))
    pairs = labels.join(values, key).withColumn("place", F.expr(S.field_score(SPARK, "a", "b"))).where(F.col("place") > -999)
    sure = F.greatest("c", F.lit(0.0)) - F.when(F.col("c") < 0.35, 0.8).otherwise(0.0)
    near = F.greatest(F.lit(0.0), 1.5 - 0.2 * F.abs(F.col("vpos") - F.col("lpos")))
    spatial = pairs.select(*key, "value", F.lit("spatial").alias("method"), (F.col("place") + 2.3 * F.col("similarity") + sure + near).alias("score"), F.struct(F.lit(1).alias("stage"), "lpos", "vpos").alias("turn"))
    order = F.struct(F.round("score", 9), -F.col("turn.stage"), -F.col("turn.lpos"), -F.col("turn.vpos"))
    best = inline.unionByName(spatial).groupBy(*key).agg(F.max_by(F.struct("value", "method", "score"), order).alias("best"))
    return best.select(*key, "best.value", "best.method", F.round("best.score", 9).alias("score"))


def usable_variants(results: DataFrame) -> DataFrame:
    """Variants (sample_id, variant, status, text_count, selected) whose recognition succeeded with items; where a sample has none, the selected one."""
    good = F.coalesce((F.col("status") == "success") & (F.col("text_count") > 0), F.lit(False))
    some = results.groupBy("sample_id").agg(F.bool_or(good).alias("some"))
    return results.join(some, "sample_id").where(F.when(F.col("some"), good).otherwise(F.coalesce("selected", F.lit(False)))).select(*results.columns)


@operator
def page_variants(d, results):
    """The page variant to read of each sample: the enhanced one; where that is weak (no success, under five texts, confidence unknown or under 0.8) the
    better of it and the colour one; where that is weak too, the best of all three. The first wins ties. Results: sample_id, variant, status, text_count, mean_confidence."""
    strong = f"coalesce(status = 'success' and text_count >= {FEW_TEXTS} and mean_confidence >= {d.num(LOW_CONFIDENCE)}, false)"
    score = d.rounded(f"cast(case when status = 'success' then text_count + 20 * coalesce(mean_confidence, {d.num(0)}) else {d.num(-1000)} end as double)", 9)
    of = lambda v: f"coalesce(max(case when variant = '{v}' then {score} end), {d.num(-1000)}) as {v}_score, coalesce(max(case when variant = '{v}' and {strong} then 1 end), 0) = 1 as {v}_strong"
    wide = f"select sample_id, {of('enhanced')}, {of('color')}, {of('grayscale')} from {results} group by sample_id"
    two = f"select *, color_score > enhanced_score as color_leads, greatest(enhanced_score, color_score) as two from ({wide}) as q"
    tried = f"select *, case when enhanced_strong then 1 when case when color_leads then color_strong else enhanced_strong end then 2 else 3 end as attempted from ({two}) as q"
    leader = "case when color_leads then 'color' else 'enhanced' end"
    return f"""select sample_id, case when attempted = 1 then 'enhanced' when attempted = 3 and grayscale_score > two then 'grayscale' else {leader} end as selected_variant,
        case when attempted = 1 then enhanced_score when attempted = 3 then greatest(two, grayscale_score) else two end as candidate_score, cast(attempted as bigint) as attempted from ({tried}) as q"""
