"""Scores: sums of DOUBLE terms in a fixed order, so that boundaries fall as they do when added one by one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sample vocabularies; a caller gives its own.
REGIONS = ["germany", "france", "canada", "japan", "brazil", "india"]
POSITIONS = ["director", "head", "chief", "manager", "president"]
INDUSTRIES = ["international", "clinic", "laboratory", "university"]
URGENT, PRODUCT = "high", "analyzer"
REGION_LEVELS = {"high": (0.9, ["germany", "france", "japan"]), "medium": (0.6, ["canada"]), "low": (0.3, ["brazil", "india"])}
EQUIPMENT = ["analyzer", "reagent", "sequencer", "centrifuge", "kit"]
URGENT_WORDS, NORMAL_WORDS = ["high", "urgent", "asap"], ["medium", "normal"]
#: Marks of a failed extraction and of useful content.
ERROR_MARKS = ["[ОШИБКА", "[ERROR", "ТРЕБУЕТСЯ", "[НЕПОДДЕРЖИВАЕМЫЙ ФОРМАТ"]
USEFUL = [r"\+7[0-9]{10}", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", r"[0-9]+[.,][0-9]+", r"[А-Я][а-я]+ [А-Я][а-я]+"]


def _d(x: float) -> Column:
    return F.lit(float(x))


def _add(score: Column, test: Column, amount: float) -> Column:
    """score plus an amount if the test holds. Adding 0.0 changes no sum, and the score so far is written once, not twice."""
    return score + F.when(test, _d(amount)).otherwise(_d(0))


def _any(c: Column, words: list[str]) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    hit = F.lit(False)
    for w in words:
        hit = hit | low.contains(w)
    return hit


def band(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.6, "medium").otherwise("low")


def confidence(c: Column) -> Column:
    """A number within [0, 1]; anything else is 0."""
    x = F.coalesce(c.cast("string").try_cast("double"), _d(0))
    return F.greatest(_d(0), F.least(_d(1), F.when(F.isnan(x), _d(0)).otherwise(x)))


def contact_priority(city, position, organization, urgency, product, email, phone, conf, regions=None, positions=None, industries=None, urgent=None, products=None) -> Column:
    """struct(score, level, reasons) of a contact; urgency and product are null where the business context is not an object."""
    tests = [
        (_any(city, regions or REGIONS), 0.15, F.concat(F.lit("priority region: "), city)),
        (_any(position, positions or POSITIONS), 0.2, F.concat(F.lit("important position: "), position)),
        (_any(organization, industries or INDUSTRIES), 0.15, F.concat(F.lit("priority industry: "), organization)),
        (_any(urgency, urgent or [URGENT]), 0.1, F.lit("high urgency")),
        (_any(product, products or [PRODUCT]), 0.2, F.lit("interest in the key product")),
    ]
    score, reasons = _d(0.5), []
    for test, amount, reason in tests:
        score = _add(score, test, amount)
        reasons.append(F.when(test, reason))
    mail = F.length(F.coalesce(email, F.lit(""))) > 0
    full = mail & (F.length(F.coalesce(phone, F.lit(""))) > 0)
    score = _add(_add(score, mail, 0.05), full, 0.05)
    sure, unsure = conf > 0.9, conf < 0.7
    score = score + F.when(sure, _d(0.05)).when(unsure, _d(-0.1)).otherwise(_d(0))
    reasons += [F.when(full, F.lit("complete contact data")), F.when(sure, F.lit("high confidence")).when(unsure, F.lit("low confidence"))]
    score = F.greatest(_d(0), F.least(_d(1), score))
    return F.struct(score.alias("score"), band(score).alias("level"), F.filter(F.array(*reasons), lambda r: r.isNotNull()).alias("reasons"))


def region_priority(region: Column, levels=None) -> Column:
    """struct(score, level, region) by the first listed region that the text contains; unknown for an empty text."""
    low = F.lower(F.trim(F.coalesce(region, F.lit(""))))
    row = lambda s, level, name: F.struct(_d(s).alias("score"), F.lit(level).alias("level"), name.alias("region"))
    out = F.when(low == "", row(0.1, "unknown", F.lit(None).cast("string")))
    for level, (score, names) in (levels or REGION_LEVELS).items():
        for name in names:
            out = out.when(low.contains(name), row(score, level, F.lit(name.title())))
    return out.otherwise(row(0.1, "very low", region))


def regional_contact_priority(region: Column, equipment: Column, budget: Column, urgency: Column, levels=None, kinds=None, urgent_words=None, normal_words=None) -> Column:
    """struct(score, level, factors): the level is taken before the score is capped."""
    info = region_priority(region, levels)
    relevant, low = _any(equipment, kinds or EQUIPMENT), F.lower(F.coalesce(urgency, F.lit("")))
    paid, urgent, normal = F.coalesce(budget, F.lit(False)), low.isin(urgent_words or URGENT_WORDS), low.isin(normal_words or NORMAL_WORDS)
    score = _add(_add(info["score"] * _d(0.4), relevant, 0.3), paid, 0.15)
    score = score + F.when(urgent, _d(0.15)).when(normal, _d(0.08)).otherwise(_d(0))
    level = F.when(score >= 0.8, "critical").when(score >= 0.6, "high").when(score >= 0.4, "medium").when(score >= 0.2, "low").otherwise("minimal")
    factors = F.array(F.concat(F.lit("region_"), F.regexp_replace(info["level"], " ", "_")), F.when(relevant, F.lit("equipment_relevant")), F.when(paid, F.lit("budget_mentioned")), F.when(urgent, F.lit("urgent_request")).when(normal, F.lit("normal_request")))
    return F.struct(F.least(score, _d(1)).alias("score"), level.alias("level"), F.filter(factors, lambda f: f.isNotNull()).alias("factors"))


def text_quality(text: Column, method: Column) -> Column:
    """struct(score, level, length, useful): not clamped, 1.2 at most; an empty text scores 0.

    What is measured is an array of one struct, through which the optimiser doesn't look: each pattern is tried once, however many fields are read.
    """
    useful = text.rlike("|".join(p for p in USEFUL if "@" not in p))
    for p in USEFUL:
        if "@" in p:
            useful = F.when(useful, F.lit(True)).when(text.contains("@"), text.rlike(p)).otherwise(F.lit(False))
    measured = F.array(F.struct(F.length(F.trim(text)).alias("length"), F.length(text).alias("whole"), useful.alias("useful"), *[text.contains(mark).alias(f"mark{i}") for i, mark in enumerate(ERROR_MARKS)], method.alias("method")))

    def scored(m: Column) -> Column:
        score = _add(_d(1.0), m["length"] < 50, -0.3)
        for i in range(len(ERROR_MARKS)):
            score = _add(score, m[f"mark{i}"], -0.4)
        score = score + F.when(m["method"] == "ocr", _d(-0.5)).when(m["method"] == "description", _d(-0.4)).otherwise(_d(0))
        return F.struct(_add(score, m["useful"], 0.2).alias("s"), (F.coalesce(m["whole"], F.lit(0)) == 0).alias("empty"), m["length"].alias("length"), m["useful"].alias("useful"))

    def told(m: Column) -> Column:
        s = m["s"]
        level = F.when(s >= 0.8, "excellent").when(s >= 0.6, "good").when(s >= 0.4, "fair").when(s >= 0.2, "poor").otherwise("failed")
        return F.struct(
            F.when(m["empty"], _d(0)).otherwise(F.bround(s, 2)).alias("score"), F.when(m["empty"], "failed").otherwise(level).alias("level"),
            F.when(m["empty"], 0).otherwise(m["length"]).alias("length"), F.when(m["empty"], False).otherwise(m["useful"]).alias("useful"),
        )

    return F.get(F.transform(F.transform(measured, scored), told), F.lit(0))
