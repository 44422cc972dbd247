"""Amounts of money and quantities in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Symbols and words of currencies, and magnitude words.
CURRENCIES = {"$": "USD", "usd": "USD", "dollar": "USD", "dollars": "USD", "€": "EUR", "eur": "EUR", "euro": "EUR", "euros": "EUR", "£": "GBP", "gbp": "GBP", "pound": "GBP", "pounds": "GBP", "¥": "JPY", "yen": "JPY", "birr": "ETB"}
MAGNITUDES = {"hundred": 1e2, "thousand": 1e3, "k": 1e3, "million": 1e6, "m": 1e6, "mm": 1e6, "mn": 1e6, "billion": 1e9, "b": 1e9, "bn": 1e9, "trillion": 1e12, "tn": 1e12}
#: Words that make an amount a lower bound, an upper bound or a guess.
LOWER, UPPER, ABOUT = ("over", "more than", "at least", "above", "exceeding"), ("under", "less than", "at most", "up to", "below"), ("about", "around", "nearly", "almost", "approximately", "some")
_NUMBER = r"([0-9][0-9,]*(?:[.][0-9]+)?)"


def _lookup(key: Column, table: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def _alternatives(words) -> str:
    return "|".join(sorted((w.replace("$", "[$]") for w in words), key=lambda w: -len(w)))


def amount(text: Column) -> Column:
    """STRUCT<currency, amount, min, max> of the first amount of money in a text; null without one.

    A bound word before it leaves min or max open; a guess leaves both; else both are the amount.
    """
    t = F.lower(text)
    magnitude = r" ?(" + _alternatives(MAGNITUDES) + r")?\b"
    front = r"(" + _alternatives(c for c in CURRENCIES) + r") ?" + _NUMBER + magnitude
    back = _NUMBER + magnitude + r" ?(" + _alternatives(c for c in CURRENCIES if len(c) > 1) + r")\b"
    is_front, is_back = t.rlike(front), t.rlike(back)
    number = F.when(is_front, F.regexp_extract(t, front, 2)).otherwise(F.regexp_extract(t, back, 1))
    word = F.when(is_front, F.regexp_extract(t, front, 3)).otherwise(F.regexp_extract(t, back, 2))
    unit = F.when(is_front, F.regexp_extract(t, front, 1)).otherwise(F.regexp_extract(t, back, 3))
    value = F.regexp_replace(number, ",", "").cast("decimal(20,4)").cast("double") * F.coalesce(_lookup(word, MAGNITUDES), F.lit(1.0))
    before = F.when(is_front, F.call_function("substring_index", t, unit, F.lit(1))).otherwise(F.call_function("substring_index", t, number, F.lit(1)))
    ends = lambda words: before.rlike(r"(?:^| )(?:" + "|".join(words) + r") *$")
    low = F.when(ends(UPPER) | ends(ABOUT), F.lit(None).cast("double")).otherwise(value)
    high = F.when(ends(LOWER) | ends(ABOUT), F.lit(None).cast("double")).otherwise(value)
    return F.when(is_front | is_back, F.struct(_lookup(unit, CURRENCIES).alias("currency"), value.alias("amount"), low.alias("min"), high.alias("max")))


def quantity(text: Column) -> Column:
    """STRUCT<val, min_val, max_val, trend, time_interval> of the first quantity: percentages, ranges, bounds and rates."""
    t = F.lower(text)
    pair = "(?:between|from) " + _NUMBER + "(?: percent|%)? (?:and|to) " + _NUMBER
    single = _NUMBER
    num = lambda pattern, k: F.regexp_replace(F.regexp_extract(t, pattern, k), ",", "").cast("double")
    is_pair = t.rlike(pair)
    value = F.when(~is_pair, num(single, 1))
    low = F.when(is_pair, num(pair, 1)).when(t.rlike("(?:over|more than|at least|above) " + _NUMBER), value)
    high = F.when(is_pair, num(pair, 2)).when(t.rlike("(?:under|less than|at most|up to|below) " + _NUMBER), value)
    trend = F.when(t.rlike(r"\b(?:increas|rise|rose|grow|grew|up)"), "Increase").when(t.rlike(r"\b(?:decreas|fall|fell|declin|drop|down)"), "Decrease")
    interval = F.nullif(F.regexp_extract(t, r"(?:per|each|every|a) (second|minute|hour|day|week|month|quarter|year)\b", 1), F.lit(""))
    return F.when(t.rlike(single), F.struct(value.alias("val"), low.alias("min_val"), high.alias("max_val"), trend.alias("trend"), interval.alias("time_interval")))
